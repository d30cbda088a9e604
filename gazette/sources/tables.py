"""Landed tables and their mapping onto the canonical ``articles`` shape.

Every reader is a lazy ``spark.read.parquet`` followed by projections only, so
column pruning and filter pushdown reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def first_line(col: str = "text"):
    return F.substring_index(F.col(col), "\n", 1)


def documents_articles(spark: SparkSession, sf_dir: str, digest: str | Column = "documents", source: str = "source") -> DataFrame:
    """``documents`` as one digest (or one per value of a column): title = first line of text, summary = text."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        (F.lit(digest) if isinstance(digest, str) else digest).alias("digest_id"),
        F.col("doc_id").alias("seq"),
        first_line("text").alias("title"),
        F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("link"),
        F.lit(None).cast("timestamp").alias("published"),
        F.col("text").alias("summary"),
        F.col(source).alias("source"),
        F.lit(None).cast("string").alias("comments_link"),
        F.lit(None).cast("array<double>").alias("embedding"),
    )


def embeddings_articles(spark: SparkSession, sf_dir: str, digest: str = "embeddings") -> DataFrame:
    """``embeddings`` as one digest: seq = vec_id, source = label."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(
        F.lit(digest).alias("digest_id"),
        F.col("vec_id").alias("seq"),
        F.concat(F.lit("item "), F.col("vec_id").cast("string")).alias("title"),
        F.concat(F.lit("vec://"), F.col("vec_id").cast("string")).alias("link"),
        F.lit(None).cast("timestamp").alias("published"),
        F.lit("").alias("summary"),
        F.col("label").cast("string").alias("source"),
        F.lit(None).cast("string").alias("comments_link"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )


def events_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as one digest per day: seq = event_id, source = event_type."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.date_format(F.col("ts"), "yyyy-MM-dd").alias("digest_id"),
        F.col("event_id").alias("seq"),
        F.concat(F.col("event_type"), F.lit(" "), F.col("event_id").cast("string")).alias("title"),
        F.concat(F.lit("event://"), F.col("event_id").cast("string")).alias("link"),
        F.col("ts").alias("published"),
        F.coalesce(F.col("props"), F.lit("")).alias("summary"),
        F.col("event_type").alias("source"),
        F.lit(None).cast("string").alias("comments_link"),
        F.lit(None).cast("array<double>").alias("embedding"),
    )


def pages_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
