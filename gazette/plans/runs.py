"""Registered queries that run streams, sinks and hooks over the driver tables, with their oracles.

The streams read files that Spark lands from the tables below the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gazette.functions.vectors import EmbeddingStore, hashed_bow_encoder
from gazette.operators import enrich as en
from gazette.operators import render as rd
from gazette.operators.history_index import HistoryIndex, novelty_by_index
from gazette.plans import catalog as ct
from gazette.plans import flagship as fs
from gazette.plans import oracle as sq
from gazette.plans.catalog import register
from gazette.plans.oracle import sql
from gazette.plans.stored import join_on, new_path, stored
from gazette.sources import history as hs
from gazette.sources import tables as tb
from gazette.sources.custom import ENTRIES, EntrySource, entry_format
from gazette.streaming import feeds as sf_feeds
from gazette.streaming.repeats import GROUPS, track_repeats

STREAM_SECONDS = 1800


def _finish(query) -> None:
    """Wait for an available-now query; a failure of it is raised here."""
    if not query.awaitTermination(STREAM_SECONDS):
        query.stop()
        raise TimeoutError("the stream has not finished")


def _drained(stream, out_schema: str | None = None):
    """All rows of an available-now stream, by a file sink."""
    out = new_path(stream.sparkSession)
    _finish(stream.writeStream.format("parquet").option("checkpointLocation", f"{out}_checkpoint").option("path", out).trigger(availableNow=True).start())
    return stream.sparkSession.read.schema(out_schema or stream.schema).parquet(out)


# ---------------------------------------------------------------- feeds as they land
@register("stream_articles")
def q_stream_articles(spark, sf):
    """Landed feed files through the streaming front end: scan, isolation, keywords."""
    files = ct.landed_feeds(spark, sf)
    path = new_path(spark)
    files.select("feed", F.encode("value", "UTF-8").alias("content")).write.parquet(path)
    sources = stored(ct.feed_sources(files))
    arts = sf_feeds.stream_articles(spark, path, sources, ct.KW_POSITIVE, ct.KW_NEGATIVE, on_bad_entry="drop_entry", packed=True)
    return _drained(arts.select("seq", "title", "link", F.md5("summary").alias("summary_md5"), "source", "comments_link"))


@sql("stream_articles")
def _():
    keep = f"NOT {sq._any(ct.KW_NEGATIVE)} AND {sq._any(ct.KW_POSITIVE)}"
    return f"""SELECT seq, title, link, summary_md5, source, comments_link FROM ({sq.ORACLE['feed_scan']})
    WHERE link IN (SELECT 'doc://' || CAST(doc_id AS VARCHAR) FROM documents WHERE {keep})"""


REPEAT_DAYS = 7
EVENTS_PER_GROUP = 50_000  # more groups of links for more events, so that none grows


@register("stream_repeats")
def q_stream_repeats(spark, sf):
    """First arrivals and repeats of what a user does, by link and event time; some events have no link."""
    ev = tb.read_table(spark, sf, "events")
    link = F.concat(F.lit("https://site.example/"), F.col("event_type"), F.lit("/"), F.col("user_id").cast("string"), F.lit("?e="), F.col("event_id").cast("string"))
    path = new_path(spark)
    ev.select(
        F.lit("events").alias("digest_id"), F.col("event_id").alias("seq"), F.when(F.col("event_id") % 97 != 0, link).alias("link"), F.col("ts").cast("timestamp").alias("published")
    ).write.parquet(path)
    arrivals = spark.readStream.schema("digest_id string, seq long, link string, published timestamp").parquet(path)
    groups = max(GROUPS, ev.count() // EVENTS_PER_GROUP)
    return _drained(track_repeats(arrivals, REPEAT_DAYS, groups=groups)).select("event", "clean_url", "seq", "repeats")


@sql("stream_repeats")
def _():
    days = f"INTERVAL {REPEAT_DAYS} DAY"
    return f"""
WITH RECURSIVE k AS (
  SELECT event_id, ts, CASE WHEN event_id % 97 <> 0 THEN 'https://site.example/' || event_type || '/' || CAST(user_id AS VARCHAR) END AS url FROM events),
a AS (SELECT *, coalesce(url, CAST(event_id AS VARCHAR)) AS g FROM k),
walk(g, first) AS (
  SELECT g, min(ts) FROM a GROUP BY g
  UNION ALL
  SELECT w.g, min(a.ts) FROM walk w JOIN a ON a.g = w.g AND a.ts >= w.first + {days} GROUP BY w.g, w.first),
w AS (SELECT g, first, lead(first) OVER (PARTITION BY g ORDER BY first) AS next FROM walk),
f AS (
  SELECT w.g, w.first, w.next, min(a.event_id) FILTER (WHERE a.ts = w.first) AS seq, any_value(a.url) AS url, count(*) - 1 AS repeats
  FROM w JOIN a ON a.g = w.g AND a.ts >= w.first AND a.ts < w.first + {days} GROUP BY ALL)
SELECT 'first' AS event, url AS clean_url, seq, CAST(0 AS BIGINT) AS repeats FROM f
UNION ALL
SELECT 'closed', url, seq, CAST(repeats AS BIGINT) FROM f WHERE next IS NOT NULL OR first + {days} < (SELECT max(ts) FROM events) - INTERVAL 1 DAY"""


@register("stream_daily_digest")
def q_stream_daily_digest(spark, sf):
    """A day that arrives in two batches: the reports hold both, as those of one batch run do."""
    arts = fs.flagship_articles(spark, sf).drop("digest_date", "embedding").withColumn("published", F.lit(fs.AS_OF).cast("timestamp"))
    reports, table, landing = (new_path(spark) for _ in range(3))
    before = F.date_sub(F.lit(fs.AS_OF).cast("date"), 1)
    lines = F.array_join(F.transform(F.array_sort(F.collect_list("headline")), lambda h: F.concat(F.lit("## "), h, F.lit("\n"))), "")
    digests = arts.select("digest_id").distinct()
    past = fs.flagship_headlines(spark, sf).agg(lines.alias("markdown"))  # the benchmark's titles, as yesterday's report of every digest
    for_all = join_on(digests.withColumn("_one", F.lit(1)), past.withColumn("_one", F.lit(1)), ["_one"]).drop("_one")
    hs.write_reports(for_all.withColumn("digest_date", before), reports)
    digest = sf_feeds.daily_digest_fn(fs.FLAGSHIP, reports, table)
    for half in (0, 1):
        arts.filter(F.col("seq") % 2 == half).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(arts.schema).parquet(landing)
        _finish(sf_feeds.run_daily_digests(stream, digest, f"{landing}_checkpoint"))
    made = hs.read_report_table(spark, reports).filter(F.col("digest_date") == F.lit(fs.AS_OF).cast("date"))
    # the table's text files end in a line break of their own
    whole = F.regexp_replace("markdown", r"\n\z", "")
    return made.select("digest_id", F.md5(whole).alias("report_md5"), F.length(whole).cast("bigint").alias("n_chars"))


@sql("stream_daily_digest")
def _():
    return sq.ORACLE["daily_digest"]


# ---------------------------------------------------------------- a source, a sink and hooks of one's own
class NumberedEntries(EntrySource):
    """Every ``of``-th number from ``first`` on, as entries without text of their own."""

    def __init__(self, name: str, first: int, of: int, numbers: int):
        self.name, self.first, self.of, self.numbers = name, first, of, numbers

    def latest(self) -> int:
        return len(range(self.first, self.numbers, self.of))

    def fetch(self, start, end):
        for i in range(start, end):
            number = self.first + i * self.of
            yield f"document {number}", f"doc://{number}", None, None, f"conv://{number}"


@register("custom_source")
def q_custom_source(spark, sf):
    """Entries of three sources of one's own, read as a stream, with the texts of the documents that they link."""
    docs = tb.read_table(spark, sf, "documents")
    numbers = (docs.agg(F.max("doc_id").alias("n")).head()["n"] or 0) + 1
    name = f"numbered_{numbers}"
    spark.dataSource.register(entry_format(name, [NumberedEntries(f"wire {i}", i, 3, numbers) for i in range(3)]))
    entries = _drained(spark.readStream.format(name).load(), ENTRIES)
    linked = docs.select(F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("link"), "text")
    return join_on(entries, linked, ["link"]).select("source", "source_ord", "entry_ord", "title", "link", F.md5("text").alias("text_md5"))


@sql("custom_source")
def _():
    return """SELECT 'wire ' || CAST(doc_id % 3 AS VARCHAR) AS source, CAST(doc_id % 3 AS INTEGER) AS source_ord, doc_id // 3 AS entry_ord,
      'document ' || CAST(doc_id AS VARCHAR) AS title, 'doc://' || CAST(doc_id AS VARCHAR) AS link, md5(text) AS text_md5 FROM documents"""


@register("report_files")
def q_report_files(spark, sf):
    """One Markdown file per day, written and read back."""
    path = f"{ct.report_path(spark)}/files"
    failed = [x for x in hs.write_report_files(ct.event_reports(spark, sf), path) if x[1] is not None]
    if failed:
        raise RuntimeError(f"reports not written: {failed[:3]}")
    files = hs.read_report_files(spark, path)
    return files.select(F.date_format("digest_date", "yyyy-MM-dd").alias("digest_id"), F.md5("markdown").alias("report_md5"), F.length("markdown").cast("bigint").alias("n_chars"))


@sql("report_files")
def _():
    return sq.ORACLE["reports"]


@register("parsed_reports")
def q_parsed_reports(spark, sf):
    """Articles read back from rendered reports."""
    p = rd.parse_reports(ct.event_reports(spark, sf))
    return p.select("digest_id", F.col("position").cast("bigint").alias("position"), "title", "source", "link", F.size("related").cast("bigint").alias("n_related"), F.length("body").cast("bigint").alias("body_chars"))


@sql("parsed_reports")
def _():
    body = "'Summary not generated in dry run mode' || chr(10) || chr(10) || '### Why Should I Care?' || chr(10) || chr(10) || 'Insights not generated in dry run mode' || chr(10) || chr(10)"
    return f"""SELECT digest_id, r AS position, source || ' ' || CAST(seq AS VARCHAR) AS title, source, 'event://' || CAST(seq AS VARCHAR) AS link,
      CAST(0 AS BIGINT) AS n_related, CAST(length({body}) AS BIGINT) AS body_chars
    FROM (SELECT {sq.EVENT_DIGEST} AS digest_id, event_id AS seq, event_type AS source, row_number() OVER (PARTITION BY {sq.EVENT_DIGEST} ORDER BY event_id) AS r FROM events)
    WHERE r <= {ct.REPORT_N}"""


def _answer(prompt: str) -> str:
    """A generator that fails on some prompts."""
    if "ad" in prompt[:40].lower():
        raise ValueError("no answer")
    return f"Answer to {prompt[:60]}"


@register("generated")
def q_generated(spark, sf):
    """Answers of a generator hook for every page's prompt; a failing call leaves the error texts of its row."""
    prompts = en.build_prompts(ct.page_articles(spark, sf).withColumn("bundle", F.lit(None).cast("string")), "{title} by {source}\n{content}")
    out = en.generate(prompts, _answer)
    return out.select("seq", "generated_summary", "why_care")


@sql("generated")
def _():
    prompt = "title || ' by ' || coalesce(source, 'None') || chr(10)"
    return f"""SELECT seq, CASE WHEN bad THEN 'Error generating summary' ELSE 'Answer to ' || substr(p, 1, 60) END AS generated_summary,
      CASE WHEN bad THEN 'Error generating insights' ELSE '' END AS why_care
    FROM (SELECT seq, {prompt} AS p, contains(lower(substr({prompt}, 1, 40)), 'ad') AS bad FROM {sq.PAGE_ART})"""


@register("custom_blocks")
def q_custom_blocks(spark, sf):
    """Reports by a block template of one's own."""
    top = ct.flt.top_n(tb.events_articles(spark, sf), ct.REPORT_N, order=["seq"], rank_col="final_rank").withColumn("digest_date", F.to_date("digest_id"))
    line = lambda **cols: F.concat(F.col("final_rank").cast("string"), F.lit(". "), F.col("title"), F.lit(" ("), F.col("source"), F.lit(")\n"))
    return rd.render_reports(top, title="Events", block=line).select("digest_id", "markdown")


@sql("custom_blocks")
def _():
    return f"""SELECT digest_id, '# Events - ' || digest_id || chr(10) || chr(10) || string_agg(CAST(r AS VARCHAR) || '. ' || source || ' ' || CAST(seq AS VARCHAR) || ' (' || source || ')' || chr(10), '' ORDER BY r) AS markdown
    FROM (SELECT {sq.EVENT_DIGEST} AS digest_id, event_id AS seq, event_type AS source, row_number() OVER (PARTITION BY {sq.EVENT_DIGEST} ORDER BY event_id) AS r FROM events)
    WHERE r <= {ct.REPORT_N} GROUP BY digest_id"""


# ---------------------------------------------------------------- counts and vectors that come with a run
@register("stage_totals")
def q_stage_totals(spark, sf):
    """Rows behind every stage, observed in the jobs of one run."""
    arts = ct.embedding_candidates(spark, sf).withColumn("digest_date", F.col("as_of"))
    cfg = ct.dg.DigestConfig(
        keywords=["item"], negative_keywords=["item 1"], novelty_lookback_days=ct.LOOKBACK, novelty_similarity_threshold=ct.SIM_T, similarity_threshold=ct.SIM_T, max_articles=ct.BAL_N
    )
    totals = ct.flt.StageTotals()
    stored(ct.dg.rank_and_select(arts, cfg, ct.embedding_headlines(spark, sf), totals))
    rows = [(i, stage, n) for i, (stage, n) in enumerate(totals.rows())]
    return spark.createDataFrame(rows, "stage_ord int, stage string, n_rows long")


@sql("stage_totals")
def _():
    return f"SELECT stage_ord, stage, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM ({sq.ORACLE['digest_stage_counts']}) GROUP BY stage_ord, stage"


@register("embedding_store")
def q_embedding_store(spark, sf):
    """Title vectors by way of the store: a run over half of the documents, then one over all."""
    arts = tb.documents_articles(spark, sf).drop("embedding")
    store = EmbeddingStore(new_path(spark), f"bow-{ct.ENCODER_DIM}", hashed_bow_encoder(ct.ENCODER_DIM))
    store.embed(arts.filter("seq % 2 = 0"))
    vectors, _ = store.embed(arts)
    places = vectors.select("seq", F.posexplode("embedding").alias("place", "weight")).filter("weight <> 0")
    return places.select("seq", F.col("place").cast("bigint").alias("place"), F.round("weight", 9).alias("weight"))


@sql("embedding_store")
def _():
    return sq.ORACLE["title_embedding"]


@register("novelty_indexed")
def q_novelty_indexed(spark, sf):
    """The novelty filter by way of an index of the history, filled in two runs."""
    index, heads = HistoryIndex(new_path(spark), pivots=16), ct.embedding_headlines(spark, sf)
    early = F.col("digest_date") < F.date_add(F.lit(ct.HIST_BASE).cast("date"), 4)
    index.add(heads.filter(early))
    index.add(heads.filter(~early))
    out = novelty_by_index(ct.embedding_candidates(spark, sf), index, lookback_days=ct.LOOKBACK, threshold=ct.SIM_T)
    return out.select("seq", "source")


@sql("novelty_indexed")
def _():
    return sq.ORACLE["novelty_filter"]
