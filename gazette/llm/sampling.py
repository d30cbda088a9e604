"""Bounded, seeded samples of labelled documents for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.llm.common import unit


def sample_per_label(rows: DataFrame, label: str, per_label: int, seed: str) -> DataFrame:
    """At most ``per_label`` documents of each label, those of smallest seeded hash of ``doc_id``: ``doc_id`` and label.

    ``rows`` needs only ``doc_id`` and ``label``; equal rows count once.  Rows are first thinned by their
    hash to about three times the bound for each label, so the exact cut sorts a
    bounded number of rows however large a label is.
    """
    rows = rows.select("doc_id", label).distinct()
    draw: Column = unit(F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")))
    sizes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).select(F.col(label).alias("_label"), "_n")
    thinned = rows.withColumn("_u", draw).join(sizes, F.col(label).eqNullSafe(F.col("_label")))
    thinned = thinned.where(F.col("_u") * F.col("_n") <= 3 * per_label)
    first = F.row_number().over(Window.partitionBy(label).orderBy("_u", "doc_id"))
    return thinned.withColumn("_r", first).where(F.col("_r") <= per_label).drop("_u", "_n", "_label", "_r")
