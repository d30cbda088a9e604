"""Mixing sources to target weights by Sainte-Lague apportionment.

A document's size is its number of words.  Each source has a weight; together
the sources share as many words as there are.  A target stops at ``MOST_REPEATS``
times its source's size, the excess is shared again by weight until no target is
above its stop.

The mix is cut into blocks of ``BLOCK_WORDS`` words.  Blocks are awarded to the
sources one by one by the highest quotient ``target / (2 * won + 1)``.  Dealt out in
this order, each shard has an integer quota of blocks of each source (``shard_quotas``;
Sainte-Lague is house-monotone: a quota is the difference of two apportionments, which
a divisor search finds without awarding singly).

A source lays its documents end to end in seeded order and cuts that line into
blocks.  Its quota takes whole passes over the line and then a run of consecutive
blocks from a seeded start; the shards cut what it takes by their quotas, one behind the
other.  So the words that a shard takes of a document (``shard_words``) are a matter of
offsets, ``taken`` is their sum, and no block is ever a row.  Offsets come from
``with_prefix``: no source is one task.
Only one row per source reaches the driver: names, sizes and quotas, the mix's
configuration; more than ``MOST_SOURCES`` raise.

Defined cases: NULL texts and texts without a word have size 0 and nothing is
taken; NULL sources are a source of their own, last in order; a source without
words has target 0; the order inside a source is by a seeded hash, ties by
``doc_id``, so reruns agree; repeated rows each count; an empty table gives an
empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import broadcast_if_small, group_key, materialize, unit, with_prefix

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 16
SHARDS = 16
#: Sources that a mix can be planned for; bounds what reaches the driver.
MOST_SOURCES = 100_000


def word_targets(sizes: Sequence[int], weights: Sequence[float], most: int = MOST_REPEATS) -> np.ndarray:
    """Words of each source: shares by weight, none above ``most`` times its size."""
    size, weight = np.array(sizes, np.float64), np.array(weights, np.float64)
    target, open_ = np.zeros(len(size)), np.ones(len(size), bool)
    rest = size.sum()
    while open_.any():
        share = rest * weight / weight[open_].sum()
        full = open_ & (share > most * size)
        if not full.any():
            target[open_] = share[open_]
            break
        target[full] = most * size[full]
        rest -= target[full].sum()
        open_ &= ~full
    return target


def sainte_lague(votes: np.ndarray, seats: int) -> np.ndarray:
    """Seats of each party; ties go to the first."""
    won = np.zeros(len(votes), np.int64)
    if seats <= 0 or not (votes > 0).any():
        return won
    low, high = 0.0, 4 * float(votes.max())  # divisors that give too many seats, and none
    for _ in range(200):
        middle = (low + high) / 2
        if np.floor(votes / middle + 0.5).sum() > seats:
            low = middle
        else:
            high = middle
    won = np.floor(votes / high + 0.5).astype(np.int64)
    queue = [(-v / (2 * w + 1), i) for i, (v, w) in enumerate(zip(votes, won)) if v > 0]
    heapq.heapify(queue)
    for _ in range(seats - int(won.sum())):
        _, i = heapq.heappop(queue)
        won[i] += 1
        heapq.heappush(queue, (-votes[i] / (2 * won[i] + 1), i))
    return won


def shard_quotas(targets: np.ndarray, shards: int = SHARDS, block: int = BLOCK_WORDS) -> np.ndarray:
    """Blocks of each shard (row) and source (column)."""
    seats = int(round(float(targets.sum()) / block))
    upto = [sainte_lague(targets, seats * k // shards) for k in range(shards + 1)]
    return np.diff(np.stack(upto), axis=0)


def plan(sources: list[tuple], weight_of: Callable[[int], float], shards: int = SHARDS, block: int = BLOCK_WORDS, seed: str = "mix") -> list[tuple]:
    """``(key, size, target, cuts, start)`` of each source of ``(key, size)``, in order: ``cuts`` are the words
    that it has given before each shard, and in all."""
    sizes = [s for _, s in sources]
    targets = word_targets(sizes, [weight_of(i) for i in range(len(sizes))])
    blocks = np.cumsum(shard_quotas(targets, shards, block), axis=0).T if sizes else []
    out = []
    for (key, size), target, upto in zip(sources, targets, blocks):
        cuts = [0, *(min(int(quota) * block, MOST_REPEATS * size) for quota in upto)]
        start = xxhash.xxh64_intdigest(f"{seed}:{key}") % max(1, -(-size // block)) * block
        out.append((key, size, float(target), cuts, start))
    return out


def n_words(text) -> F.Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a whole text; NULL has none."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.size(words).cast("long")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, shards: int = SHARDS, block: int = BLOCK_WORDS, seed: str = "mix") -> DataFrame:
    """``doc_id, size, source_size, target, taken, shard_words`` of every row: the words that the mix takes, and
    each shard of it."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string").alias("_source"), n_words(F.col("text").cast("string")).alias("size"))
    slim = materialize(slim.select("doc_id", group_key(F.col("_source")).alias("_key"), "size"))
    found = slim.groupBy("_key").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: name groups of them as sources")
    in_order = sorted(found, key=lambda r: (r["_key"][0] == "0", r["_key"]))  # "0": NULL, last
    planned = plan([(r["_key"], r["size"]) for r in in_order], lambda i: weights[i % len(weights)], shards, block, seed)
    table = spark.createDataFrame(planned, "_k string, source_size long, target double, _cuts array<long>, _start long")
    hashed = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))
    placed = with_prefix(slim.withColumn("_at", unit(hashed)), "_key", "_at", ["_at", "doc_id", "size"], {"_from": "size"}, sum(r["rows"] for r in found))
    joined = placed.join(broadcast_if_small(table, len(planned)), F.col("_key") == F.col("_k"))
    line, passes = F.col("source_size"), F.floor(F.element_at("_cuts", -1) / F.greatest(F.col("source_size"), F.lit(1)))

    def shared(first, last):
        """Words of the document in the line's stretch from first to last."""
        return F.greatest(F.lit(0), F.least(F.col("_from") + F.col("size"), last) - F.greatest(F.col("_from"), first))

    def given(words):
        """Words of the document among the first ``words`` that its source gives: whole passes, then the run."""
        whole = F.floor(words / F.greatest(line, F.lit(1)))
        end = F.col("_start") + words - passes * line
        run = shared(F.col("_start"), F.least(end, line)) + shared(F.lit(0), end - line)
        return F.when(whole < passes, whole * F.col("size") + shared(F.lit(0), words - whole * line)).otherwise(passes * F.col("size") + run).cast("long")

    before = joined.withColumn("_given", F.transform("_cuts", given))
    parts = F.zip_with(F.slice("_given", 2, shards), F.slice("_given", 1, shards), lambda upto, already: upto - already)
    return before.select("doc_id", "size", "source_size", "target", F.element_at("_given", -1).alias("taken"), parts.alias("shard_words"))
