"""Feeds packed as rows of larger files stream as those of a file each do."""

import os
import tempfile

from gazette.streaming.feeds import stream_articles


def _drained(stream):
    out = tempfile.mkdtemp(prefix="gz-out-")
    query = stream.writeStream.format("parquet").option("checkpointLocation", tempfile.mkdtemp(prefix="gz-ck-")).option("path", out).trigger(availableNow=True).start()
    assert query.awaitTermination(240)
    return stream.sparkSession.read.schema(stream.schema).parquet(out).collect()


FEED = """<?xml version="1.0" encoding="{}"?><rss version="2.0"><channel><title>T</title>
<item><title>Rust é {}</title><link>http://a/{}</link><pubDate>Tue, 10 Jun 2025 04:00:00 GMT</pubDate><description>d</description></item>
<item><title>Rust without a date</title><link>http://a/0</link><description>d</description></item></channel></rss>"""


def test_packed_feeds_are_those_of_folders(spark):
    texts = {f"f{i}": FEED.format(enc, i, i).encode(enc) for i, enc in enumerate(["utf-8", "iso-8859-1", "utf-16", "windows-1252", "utf-8"])} | {"bad": b"<rss", "none": b""}
    folders, packed = tempfile.mkdtemp(prefix="gz-folders-"), tempfile.mkdtemp(prefix="gz-packed-")
    for name, content in texts.items():
        os.mkdir(f"{folders}/feed={name}")
        with open(f"{folders}/feed={name}/f.xml", "wb") as f:
            f.write(content)
    rows = [(name, bytearray(content)) for name, content in texts.items()]
    spark.createDataFrame(rows, "feed string, content binary").coalesce(1).write.mode("overwrite").parquet(packed)
    sources = spark.createDataFrame([(i, name, f"source {name}") for i, name in enumerate(texts)], "source_ord int, url string, name string")
    options = {"keywords": ["rust"], "on_bad_entry": "drop_entry"}
    by_folder = _drained(stream_articles(spark, folders, sources, feed_folders=True, **options))
    by_row = _drained(stream_articles(spark, packed, sources, packed=True, **options))
    assert sorted(by_row) == sorted(by_folder)
    assert sorted((r.title, r.source) for r in by_row) == [(f"Rust é {i}", f"source f{i}") for i in range(5)]


def test_the_query_lands_fewer_files_than_feeds(spark):
    from __spark_entry__ import queries
    from gazette.session import ensure_checkpoint_dir

    sf = tempfile.mkdtemp(prefix="gz-sf-")
    docs = [(i, f"the title {i}\ntext", f"wire-{i % 40}") for i in range(128)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(3, 0)], "doc_id long, quality int").write.parquet(f"{sf}/labels.parquet")
    tables = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables")
    before = set(os.listdir(tables)) if os.path.isdir(tables) else set()
    got = queries()["stream_articles"](spark, sf)
    assert sorted((r.title, r.link, r.source) for r in got.collect()) == sorted((f"the title {i}", f"doc://{i}", f"wire-{i % 40}") for i in range(128) if i != 3)
    new = [t for t in os.listdir(tables) if t not in before and not t.endswith("_checkpoint")]
    most = max(sum(x.startswith("part-") for _, _, files in os.walk(f"{tables}/{t}") for x in files) for t in new)
    assert most <= 8  # 80 feeds of 40 sources
