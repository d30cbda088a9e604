import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from gazette.sources import history as hs
from gazette.streaming.feeds import stream_articles, suppress_repeats
from tests.conftest import SF001


def _reports(spark):
    rows = [(d, f"# Daily Reading List - {d}\r\n\r\n## Title {d}\r\n\r\nx\r\n\r\n---\r\n\r\n")
            for d in ["2025-06-01", "2025-06-02", "2025-06-08"]]
    return spark.createDataFrame(rows, "d string, markdown string").select(
        F.col("d").alias("digest_id"), F.to_date("d").alias("digest_date"), "markdown")


def test_report_table_window_is_today_inclusive(spark):
    path = tempfile.mkdtemp(prefix="gz-reports-")
    hs.write_reports(_reports(spark), path)
    got = sorted(r.headline for r in hs.read_headlines(spark, path, "2025-06-08", 7).collect())
    assert got == ["Title 2025-06-02", "Title 2025-06-08"]  # 06-01 is exactly 7 days back: out
    hs.write_reports(_reports(spark).filter("digest_id = '2025-06-08'"), path)  # re-run of one day
    assert hs.read_report_table(spark, path).count() == 3


def test_two_digests_of_one_day_stay_apart(spark):
    path = tempfile.mkdtemp(prefix="gz-two-")
    rows = [(u, f"# R\n\n## {u} title\n\n---\n\n") for u in ("ann", "bob")]
    df = spark.createDataFrame(rows, "digest_id string, markdown string").withColumn("digest_date", F.lit("2025-06-08").cast("date"))
    hs.write_reports(df, path)
    hs.write_reports(df.filter("digest_id = 'bob'"), path)  # a re-run of one digest
    assert hs.read_report_table(spark, path).count() == 2
    got = {(r.digest_id, r.headline) for r in hs.read_headlines(spark, path, "2025-06-08", 7).collect()}
    assert got == {("ann", "ann title"), ("bob", "bob title")}


def test_dry_run_makes_no_report(spark):
    from gazette.plans.digest import DigestConfig, digest_stage_counts, run_digest

    arts = spark.createDataFrame([("d", i, f"rust item {i}", f"l{i}", "s", f"src{i % 2}", None) for i in range(6)], "digest_id string, seq long, title string, link string, summary string, source string, comments_link string")
    arts = arts.withColumn("digest_date", F.lit("2025-06-08").cast("date"))
    assert run_digest(arts, DigestConfig(keywords=["rust"], dry_run=True)).count() == 0
    counts = {r.stage: r.n_rows for r in digest_stage_counts(arts, DigestConfig(keywords=["rust"], similarity_threshold=0.99)).collect()}
    assert counts == {"input": 6, "negative_keywords": 6, "keywords": 6, "novelty": 6, "grouping": 6, "limit": 5}


def test_flat_report_files(spark):
    path = tempfile.mkdtemp(prefix="gz-flat-")
    for name, body in [("reading_list_20250608.md", "## A\r\n## B\n"), ("reading_list_20250607.md.old", "## Old\n"),
                       ("reading_list_20250530.md", "## Far\n")]:
        with open(os.path.join(path, name), "w", newline="") as f:
            f.write(body)
    got = sorted(r.headline for r in hs.read_headlines(spark, path, dt.date(2025, 6, 8), 7, layout="files").collect())
    assert got == ["A", "B"]


RSS = """<rss version="2.0"><channel><title>T</title>
<item><title>Rust news</title><link>http://a/1?utm=x</link><pubDate>Tue, 10 Jun 2025 04:00:00 GMT</pubDate><description>d</description></item>
<item><title>Other</title><link>http://a/2</link><pubDate>Tue, 10 Jun 2025 05:00:00 GMT</pubDate><description>d</description></item>
</channel></rss>"""
RSS2 = RSS.replace("Other", "Rust again").replace("http://a/2", "http://a/1?utm=y")


def test_stream_matches_batch_and_suppresses_repeats(spark):
    src = tempfile.mkdtemp(prefix="gz-feeds-")
    for name, body in [("f1.xml", RSS), ("f2.xml", RSS2)]:
        with open(os.path.join(src, name), "w") as f:
            f.write(body)
    sources = spark.createDataFrame([(0, "f1.xml", "one"), (1, "f2.xml", "two")], "source_ord int, url string, name string")
    arts = suppress_repeats(stream_articles(spark, src, sources, ["rust"]))
    q = (arts.writeStream.format("memory").queryName("gz_stream_out")
         .option("checkpointLocation", tempfile.mkdtemp(prefix="gz-ckpt-")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    rows = spark.sql("SELECT clean_url, title FROM gz_stream_out").collect()
    assert sorted(r.clean_url for r in rows) == ["http://a/1"]


def test_entry_and_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0 and "block" in df.columns
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 50
    assert os.path.isdir(SF001)


def test_undated_repeats_are_suppressed(spark):
    src = tempfile.mkdtemp(prefix="gz-undated-")
    for name in ("f1.xml", "f2.xml"):
        with open(os.path.join(src, name), "w") as f:
            f.write(RSS.replace("Tue, 10 Jun 2025 04:00:00 GMT", "no date").replace("Tue, 10 Jun 2025 05:00:00 GMT", "none"))
    sources = spark.createDataFrame([(0, "f1.xml", "one"), (1, "f2.xml", "two")], "source_ord int, url string, name string")
    arts = suppress_repeats(stream_articles(spark, src, sources, ["rust"]))
    q = (arts.writeStream.format("memory").queryName("gz_undated").option("checkpointLocation", tempfile.mkdtemp(prefix="gz-ckpt-")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert spark.sql("SELECT clean_url FROM gz_undated").count() == 1


def test_the_digest_runs_on_each_day_of_a_stream_with_its_history(spark):
    from gazette.plans.digest import DigestConfig
    from gazette.streaming.feeds import daily_digest_fn, run_daily_digests

    src, out, table = (tempfile.mkdtemp(prefix=f"gz-{x}4-") for x in ("feeds", "out", "table"))
    sources = spark.createDataFrame([(0, "f1.xml", "one"), (1, "f2.xml", "two")], "source_ord int, url string, name string")
    responses = spark.createDataFrame([("feeds", 0, "said")], "digest_id string, seq long, text string")
    pages = spark.createDataFrame([("http://a/2", "page", None)], "url string, text string, image_url string")
    checkpoint = tempfile.mkdtemp(prefix="gz-ck4-")

    def land_and_run(name, text):
        with open(os.path.join(src, name), "w") as f:
            f.write(text)
        fn = daily_digest_fn(DigestConfig(keywords=[""]), out, table, pages=pages, responses=responses)
        run_daily_digests(stream_articles(spark, src, sources, [""]), fn, checkpoint).awaitTermination(120)
        return {(str(r.digest_date), r.headline) for r in hs.read_headlines(spark, out, "2025-06-12", 7).collect()}

    first = land_and_run("f1.xml", RSS)
    assert first == {("2025-06-10", "Rust news"), ("2025-06-10", "Other")}
    later = RSS.replace("10 Jun", "12 Jun").replace("Other", "New thing")
    # "Rust news" was in an earlier report: the history hides it two days later
    assert land_and_run("f2.xml", later) == first | {("2025-06-12", "New thing")}


def test_foreach_batch_daily_digests_write_reports(spark):
    from gazette.operators import filters as flt
    from gazette.operators import render as rd
    from gazette.streaming.feeds import run_daily_digests

    src = tempfile.mkdtemp(prefix="gz-feeds3-")
    with open(os.path.join(src, "f1.xml"), "w") as f:
        f.write(RSS)
    sources = spark.createDataFrame([(0, "f1.xml", "one")], "source_ord int, url string, name string")
    out = tempfile.mkdtemp(prefix="gz-out-")

    def digest(batch, epoch):
        day = batch.withColumn("digest_date", F.to_date("published")).withColumn("digest_id", F.col("digest_date").cast("string"))
        top = flt.dry_run(flt.top_n(day, 5, rank_col="final_rank"))
        hs.write_reports(rd.render_reports(top), out)

    q = run_daily_digests(stream_articles(spark, src, sources, [""]), digest, tempfile.mkdtemp(prefix="gz-ck3-"))
    q.awaitTermination(120)
    heads = sorted(r.headline for r in hs.read_headlines(spark, out, "2025-06-10", 1).collect())
    assert heads == ["Other", "Rust news"]


def _drain(df, name):
    q = df.writeStream.format("memory").queryName(name).option("checkpointLocation", tempfile.mkdtemp(prefix="gz-ck-")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name).collect()


def test_a_day_in_two_batches_is_one_report_and_replays_change_nothing(spark):
    from gazette.plans.digest import DigestConfig
    from gazette.streaming.feeds import daily_digest_fn, landed_articles

    out, table = tempfile.mkdtemp(prefix="gz-out5-"), tempfile.mkdtemp(prefix="gz-table5-")
    schema = "digest_id string, seq long, title string, link string, published timestamp, summary string, source string, comments_link string"
    at = dt.datetime(2025, 6, 10, 4)

    def batch(*rows):
        return spark.createDataFrame([("d", i, t, f"l{i}", p, "s", f"src{i}", None) for i, t, p in rows], schema)

    fn = daily_digest_fn(DigestConfig(keywords=[""], max_articles=9, dry_run=True), out, table)
    one, two = batch((0, "rivers rise", at), (1, "stones fall", at), (9, "undated", None)), batch((2, "clouds part", at), (3, "trains halt", at), (4, "a day later", at + dt.timedelta(days=1)))

    def reports():
        return {str(r.digest_date): r.markdown for r in hs.read_report_table(spark, out).collect()}

    fn(one, 0)
    fn(two, 1)
    made = reports()
    assert set(made) == {"2025-06-10", "2025-06-11"}
    assert all(t in made["2025-06-10"] for t in ("rivers rise", "stones fall", "clouds part", "trains halt"))
    fn(two, 1)  # a replay
    assert reports() == made
    fn(batch((1, "stones fall again", at)), 2)  # a later form of an article replaces it
    assert "## stones fall again\n" in reports()["2025-06-10"] and "## stones fall\n" not in reports()["2025-06-10"]
    kept = landed_articles(spark, table, one.schema)
    assert [r.title for r in kept.filter("digest_date IS NULL").collect()] == ["undated"] and kept.count() == 6


def test_repeats_are_counted_and_expire(spark):
    from gazette.streaming.repeats import track_repeats

    landing = tempfile.mkdtemp(prefix="gz-rep-")
    schema = "digest_id string, seq long, link string, published timestamp"
    day = lambda d, h=0: dt.datetime(2025, 6, d, h)
    first = [("d", 1, "http://a/x?1", day(1)), ("d", 2, "http://a/x?2", day(2)), ("d", 3, None, day(2)), ("d", 4, None, day(2)), ("d", 5, "http://b/", day(2))]
    second = [("d", 6, "http://a/x", day(9)), ("d", 7, "http://c/", day(12)), ("d", 8, "http://a/x", day(10))]
    third = [("d", 9, "http://late/", day(3)), ("d", 10, "http://end/", day(28))]  # the first is older than the watermark
    stream = track_repeats(spark.readStream.schema(schema).parquet(landing), lookback_days=7)
    ck, out = tempfile.mkdtemp(prefix="gz-ck-"), tempfile.mkdtemp(prefix="gz-repout-") + "/o"
    for rows in (first, second, third):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        q = stream.writeStream.format("parquet").option("checkpointLocation", ck).option("path", out).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
    got = sorted((r.event, r.seq, r.clean_url, r.repeats) for r in spark.read.parquet(out).collect())
    a, b, c = "http://a/x", "http://b/", "http://c/"
    want = [("first", i, u, 0) for i, u in ((1, a), (3, None), (4, None), (5, b), (6, a), (7, c), (10, "http://end/"))]
    want += [("closed", 1, a, 1), ("closed", 3, None, 0), ("closed", 4, None, 0), ("closed", 5, b, 0), ("closed", 6, a, 1), ("closed", 7, c, 0)]
    assert got == sorted(want, key=lambda x: (x[0], x[1]))


def test_windows_of_any_length():
    import numpy as np

    from gazette.streaming.repeats import windows

    rng = np.random.default_rng(5)
    for opened in (None, 3):
        for _ in range(50):
            times = np.sort(rng.integers(0, 60, rng.integers(0, 30)))
            want, first, n = [], opened, -1 if opened is not None else None
            held = {-1: 0} if opened is not None else {}
            for i, t in enumerate(times.tolist()):
                if first is None or t >= first + 7:
                    first, n = t, i
                    held[n] = 0
                held[n] += 1
            assert list(windows(times, opened, 7)) == list(held.items())


def test_report_files_replace_whole_files_and_list_failures(spark):
    path = tempfile.mkdtemp(prefix="gz-files-")
    rows = [("d", "2025-06-08", "# R\n\n## A\n\n---\n\n"), ("d", "2025-06-07", "## B"), ("d", "2025-06-06", None), ("d", None, "## C\n"), ("x", "2025-06-05", "## D\n"), ("y", "2025-06-05", "## E\n")]
    df = spark.createDataFrame(rows, "digest_id string, d string, markdown string").withColumn("digest_date", F.to_date("d"))
    got = hs.write_report_files(df, path)
    assert got == [(None, "no date or text"), ("reading_list_20250605.md", "several reports for one file"), ("reading_list_20250606.md", "no date or text"), ("reading_list_20250607.md", None), ("reading_list_20250608.md", None)]
    with open(f"{path}/reading_list_20250608.md", newline="") as f:
        assert f.read() == rows[0][2]
    heads = {r.headline for r in hs.read_headlines(spark, path, dt.date(2025, 6, 8), 7, layout="files").collect()}
    assert heads == {"A", "B"}
    new = df.filter("d = '2025-06-08'").withColumn("markdown", F.lit("## A2\n"))
    assert hs.write_report_files(new, path) == [("reading_list_20250608.md", None)]
    broken = df.filter("d = '2025-06-07'").withColumn("markdown", F.lit("## bad\n"))
    os.rename(f"{path}/reading_list_20250607.md", f"{path}/kept")
    os.mkdir(f"{path}/reading_list_20250607.md")  # a folder in the way is set aside like a file
    assert hs.write_report_files(broken, path) == [("reading_list_20250607.md", None)]
    assert hs.write_report_files(df.filter("d = '2025-06-05'"), path, by_digest=True) == [("x/reading_list_20250605.md", None), ("y/reading_list_20250605.md", None)]
    failing = F.udf(lambda x: 1 / 0, "string")  # the writing job itself fails: nothing is replaced
    assert hs.write_report_files(new.withColumn("markdown", F.lit("## N\n")), path) == [("reading_list_20250608.md", None)]
    try:
        hs.write_report_files(new.withColumn("markdown", failing("markdown")), path)
    except Exception:  # rendering fails before any file is touched
        pass
    assert not [x for x in os.listdir(path) if x.startswith(".staging")]
    assert {r.headline for r in hs.read_headlines(spark, path, dt.date(2025, 6, 8), 1, layout="files").collect()} == {"N"}


def test_a_source_of_ones_own_in_batch_and_stream(spark):
    from gazette.sources.custom import EntrySource, entry_format

    class Wire(EntrySource):
        def __init__(self, name, n):
            self.name, self.n = name, n

        def latest(self):
            return self.n

        def fetch(self, start, end):
            return ((f"{self.name} {i}", f"l{i}", dt.datetime(2025, 6, 1), "s", None) for i in range(start, end))

    class Broken(Wire):
        def fetch(self, start, end):
            yield from super().fetch(start, end)
            raise OSError("gone")

    spark.dataSource.register(entry_format("wires", [Wire("a", 3), Broken("b", 5), Wire("c", 2)], per_partition=2))
    batch = spark.read.format("wires").load()
    assert batch.rdd.getNumPartitions() == 2
    rows = sorted(tuple(r) for r in batch.collect())
    assert [(r[0], r[1], r[2]) for r in rows] == [("a", 0, 0), ("a", 0, 1), ("a", 0, 2), ("c", 2, 0), ("c", 2, 1)]  # b's failure is its own
    assert sorted(map(tuple, _drain(spark.readStream.format("wires").load(), "gz_wires"))) == rows
