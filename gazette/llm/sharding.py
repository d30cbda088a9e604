"""Sharding by proportional stratified interleaving.

The rows of each source are shuffled by a seeded hash and ranked; a row's
fractional rank is ``(rank + offset) / rows of its source``, with an offset in
[0, 1) of each source's own (else all one-row sources would stand in the middle).
Sorted by fractional rank, any stretch of the rows holds each source in about its
share; the sorted rows are cut into shards of equal counts, at most one apart.

Ranks and positions come from ``with_prefix``: neither a source nor the whole
table is ever one task, and the text leaves the plan after its size and checksum.

Defined cases: a NULL text counts as empty (size 1, checksum 0); NULL sources are
a source of their own; the order within a source is by hash, then ``doc_id``,
checksum and size, so repeated rows stand side by side and reruns agree; with
fewer rows than shards the last shards stay empty; an empty table gives an empty
result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import group_key, materialize, unit, with_prefix

SHARDS = 16


def shard(docs: DataFrame, shards: int = SHARDS, seed: str = "shard") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(
        F.col("doc_id").cast("long"),
        group_key(F.col("source")).alias("_key"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    slim = materialize(slim.withColumn("_u", unit(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text_crc32")))))
    sources = materialize(slim.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("_key", "_k"))
    rows = sources.agg(F.sum("_n").alias("n")).head()["n"] or 0
    ties = ["doc_id", "text_crc32", "size"]
    ranked = with_prefix(slim, "_key", "_u", ["_u", *ties], {"_rank": None}, rows)
    offset = unit(F.xxhash64(F.lit(seed), F.col("_key")))
    at = (F.col("_rank") + offset) / F.col("_n")
    placed = ranked.join(sources, F.col("_key") == F.col("_k")).select("doc_id", "size", "text_crc32", "_key", at.alias("_at"), F.lit(0).alias("_all"))
    spread = materialize(placed)
    seated = with_prefix(spread, "_all", "_at", ["_at", "_key", *ties], {"_position": None}, rows)
    number = F.floor(F.col("_position") * shards / F.lit(max(rows, 1)))
    first = F.ceil(number * F.lit(rows) / shards)
    return seated.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        number.cast("int").alias("shard"),
        (F.col("_position") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
