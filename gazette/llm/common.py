"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.session import ensure_checkpoint_dir

#: Rows of text that one Arrow batch holds at most; bounds a Python worker's memory.
TEXT_BATCH_ROWS = 128
#: Rows up to which an id table or a per-site table is broadcast (a few tens of MB).
BROADCAST_ROWS = 1_000_000


def text_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small, whatever the texts' lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))


def free_name(columns: Sequence[str], base: str) -> str:
    """``base``, with underscores before it until no column has that name."""
    while base.lower() in {c.lower() for c in columns}:
        base = f"_{base}"
    return base


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but runs the plan once, keeps column
    pruning, and gives later joins a true size.  A lost executor costs nothing:
    the files are in shared storage.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a table whose counted ``rows`` stay within ``limit``;
    beyond it the planner's shuffle join is used."""
    return F.broadcast(df) if rows <= limit else df


def group_key(col: Column) -> Column:
    """A non-null string key of a nullable column; NULL and every value differ."""
    return F.when(col.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), col.cast("string")))


def unit(hashed: Column) -> Column:
    """A signed 64-bit hash as a number in [0, 1)."""
    return (F.shiftrightunsigned(hashed, 11).cast("double")) * F.lit(2.0**-53)


def with_prefix(
    df: DataFrame, group: str, at: str, order: Sequence[str], sums: dict[str, str], rows: int, rows_per_bucket: int = 20_000
) -> DataFrame:
    """Add exclusive running sums inside each group, without one task per group.

    ``at`` is a column in [0, 1) that is about uniform inside a group and
    non-decreasing in the wanted order; ``order`` is the full order.  Each group is
    cut into equal intervals of ``at``; an interval is summed in one task and shifted
    by the totals of the intervals before it.  ``sums`` maps new columns to the summed
    column (``None``: counts rows).  The result does not depend on the interval count.
    """
    n = max(8, -(-rows // rows_per_bucket))
    what = {out: F.lit(1).cast("long") if col is None else F.col(col) for out, col in sums.items()}
    cut = df.withColumn("_b", F.least(F.floor(F.col(at) * n), F.lit(n - 1)).cast("int"))
    totals = cut.groupBy(group, "_b").agg(*[F.sum(v).alias(f"_{k}") for k, v in what.items()])
    before = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select(
        F.col(group).alias("_g"), F.col("_b").alias("_gb"), *[F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(f"_{k}") for k in what]
    )
    inside = Window.partitionBy(group, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_in_{k}") for k, v in what.items()])
    joined = local.join(shift, (F.col(group) == F.col("_g")) & (F.col("_b") == F.col("_gb")))
    kept = [c for c in df.columns]
    return joined.select(*kept, *[(F.col(f"_in_{k}") + F.col(f"_{k}")).alias(k) for k in what])
