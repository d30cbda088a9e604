"""Intermediate tables in the shared checkpoint folder, and joins that keep NULL keys."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.session import ensure_checkpoint_dir


def new_path(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet below the checkpoint folder and read back: the
    plan runs once, the lineage ends, and later joins know the table's true size
    (a small one is broadcast by the planner, a large one shuffled)."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, whatever the store, and a maker of its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file, or a folder that is not empty."""
    fs, make = file_system(spark, path)
    return fs.exists(make(path)) and len(fs.listStatus(make(path))) > 0


def fresh(df: DataFrame) -> DataFrame:
    """The same columns under new attribute ids, for a join or cogroup with a table of the same origin."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL; the keys appear once, from ``left``."""
    side = right.withColumnsRenamed({k: f"_on_{k}" for k in keys})
    same: Column = reduce(lambda a, b: a & b, [left[k].eqNullSafe(side[f"_on_{k}"]) for k in keys])
    return left.join(side, same, how).drop(*[f"_on_{k}" for k in keys])
