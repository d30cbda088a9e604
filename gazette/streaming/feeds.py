"""Structured Streaming forms of the digest front end.

* :func:`stream_articles` — landed feed files as they arrive → parsed,
  isolated, keyword-filtered articles (stateless, the batch column functions);
* :func:`suppress_repeats` — exact repeats by clean URL inside the lookback,
  with a watermark bounding the dedup state (:mod:`gazette.streaming.repeats`
  counts them as well);
* :func:`run_daily_digests` — ``foreachBatch`` that adds a micro-batch to the
  article table and rebuilds the digest of every day it touches from all
  articles of that day, with the reports of the days before as history.  Both
  sinks overwrite what a replayed batch wrote, so a replay changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.functions.text import any_keyword
from gazette.functions.urls import clean_url
from gazette.functions.vectors import embed
from gazette.operators.render import render_reports
from gazette.plans.digest import DigestConfig, enrich, rank_and_select
from gazette.plans.stored import path_exists, stored
from gazette.sources.feeds import assign_seq, decoded_files, isolate_feeds, parse_feeds
from gazette.sources.history import read_headlines, write_reports


def read_feed_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, feed_folders: bool = False, packed: bool = False) -> DataFrame:
    """``(feed, value)`` of the feed files that land at ``path``: each by itself, or ``packed`` as rows
    ``(feed, content)`` of Parquet files, as listing and opening every small file takes milliseconds."""
    folder = ", feed string" if feed_folders else ""
    if packed:
        reader = spark.readStream.format("parquet").schema("feed string, content binary")
    else:
        reader = spark.readStream.format("binaryFile").schema(f"path string, modificationTime timestamp, length long, content binary{folder}")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return decoded_files(reader.load(path), feed=F.col("feed") if feed_folders or packed else None)


def stream_articles(
    spark: SparkSession,
    path: str,
    sources: DataFrame,
    keywords: Sequence[str],
    negative_keywords: Sequence[str] = (),
    on_bad_entry: str = "drop_feed",
    digest_id: str = "feeds",
    feed_folders: bool = False,
    packed: bool = False,
) -> DataFrame:
    """Streaming articles with the same semantics as the batch scan + filters.  A feed is named by
    its file, by the ``feed=`` folder that holds it, or by its row where files are ``packed``."""
    files = read_feed_stream(spark, path, feed_folders=feed_folders, packed=packed)
    entries = isolate_feeds(parse_feeds(files), on_bad_entry)
    arts = assign_seq(entries, sources, digest_id=digest_id)
    keep = ~any_keyword(negative_keywords) & any_keyword(keywords)
    return arts.filter(keep)


def suppress_repeats(articles: DataFrame, lookback_days: int = 7, ts: str = "published") -> DataFrame:
    """Drop a later arrival of the same clean URL seen within the watermark.  An article
    without a date counts as seen when it arrives (``seen_at``); one without a link is
    nobody's repeat."""
    own = F.concat_ws(" ", F.lit("no link"), "digest_id", F.col("seq").cast("string"))
    return (
        articles.withColumn("clean_url", clean_url(F.col("link")))
        .withColumn("seen_at", F.coalesce(F.col(ts), F.current_timestamp()))
        .withColumn("_key", F.coalesce("clean_url", own))
        .withWatermark("seen_at", f"{lookback_days} days")
        .dropDuplicatesWithinWatermark(["_key"])
        .drop("_key")
    )


def land_articles(batch: DataFrame, epoch: int, path: str, stream: str = "feeds") -> None:
    """Add a micro-batch to the article table, below its day, stream and epoch.

    A replayed epoch overwrites its own files only.  ``stream`` names one checkpoint: epochs
    of another one start anew and need a name of their own.  Articles without a date stay in
    the table (``digest_date`` NULL) and are in no report."""
    keyed = batch.withColumns({"digest_date": F.to_date("published"), "stream": F.lit(stream), "epoch": F.lit(epoch).cast("long")})
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("digest_date", "stream", "epoch").parquet(path)


def landed_articles(spark: SparkSession, path: str, batch_schema: T.StructType) -> DataFrame:
    """The article table.  Of articles of one ``(digest_id, seq)`` and day, the last one landed counts."""
    kinds = {"digest_date": T.DateType(), "stream": T.StringType(), "epoch": T.LongType()}
    given = [f for f in batch_schema.fields if f.name not in kinds]
    table = spark.read.schema(T.StructType([*given, *(T.StructField(k, t) for k, t in kinds.items())])).parquet(path)
    last = Window.partitionBy("digest_date", "digest_id", "seq").orderBy(F.desc("epoch"), "stream")
    return table.withColumn("_r", F.row_number().over(last)).filter("_r = 1").drop("_r", "stream", "epoch")


def daily_digest_fn(cfg: DigestConfig, report_path: str, article_path: str, stream: str = "feeds", **enrichment: DataFrame) -> Callable[[DataFrame, int], None]:
    """A ``digest_fn``: the batch pipeline on each day that a micro-batch touches.

    A day's articles come from the table at ``article_path``, to which the batch is added
    first, so a day may arrive in any number of batches.  Reports of the days before
    (``report_path``) are the history, each digest seeing its own; a day's own report is not.
    Days follow one another, as each is history to the next; reports of later days that
    were written before are not rebuilt.  ``enrichment`` is passed to the enrichment step
    (pages, responses, ...).
    """

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        here = stored(batch)
        days = [r["d"] for r in here.select(F.to_date("published").alias("d")).distinct().orderBy("d").collect()]  # of one batch: a few
        if not days:
            return
        land_articles(here, epoch, article_path, stream)
        for at in (d for d in days if d is not None):
            today = landed_articles(spark, article_path, here.schema).filter(F.col("digest_date") == F.lit(at))
            history = None
            if path_exists(spark, report_path):  # else no report yet
                past = stored(read_headlines(spark, report_path, str(at), cfg.novelty_lookback_days + 1).filter(F.col("digest_date") < F.lit(at)))
                history = embed(past, "headline", encoder=cfg.encoder)
            top = enrich(rank_and_select(today, cfg, history), cfg, **enrichment)
            write_reports(render_reports(top, title=cfg.title, block=cfg.block), report_path)

    return run


def run_daily_digests(
    articles: DataFrame,
    digest_fn: Callable[[DataFrame, int], DataFrame],
    checkpoint: str,
    trigger: dict | None = None,
):
    """Start a query that hands every micro-batch to ``digest_fn(batch, epoch)``
    (e.g. the batch pipeline writing reports with dynamic partition overwrite)."""
    writer = articles.writeStream.foreachBatch(digest_fn).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()
