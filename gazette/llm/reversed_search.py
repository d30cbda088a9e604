"""Ranked lexical search with the roles reversed: documents stream past an index of the queries.

A set of query items is small beside the corpus, so the inverted index is built over
the items' terms and broadcast: term -> items that hold it.  One pass over the texts
counts the terms of each document that any item holds, and its length.  Corpus
statistics (documents, terms, document frequencies) are sums over those counts.  A
second pass streams the counts through the index: every document adds its term scores
to the items that hold the terms, and every task keeps a bounded heap of the best
documents of each item.  The heaps meet in two steps: those of some tasks first.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII;
only A-Z are lower-cased.  All sums are 64-bit integers, so no order changes a score.

Size of the broadcast: items are dealt by a hash of their id into blocks, until none
holds more than ``BLOCK_POSTINGS`` pairs of item and term (an item that has more by
itself is a block).  Each block is a pass of its own over the corpus.

Defined cases: a NULL, empty or term-free text is no document of the statistics and is
never returned; rows of equal ``item_id`` (NULL among them) are one item with the terms
of all; items without terms, or without a match, have no rows; equal scores go by
ascending ``doc_id``, NULL last; repeated documents count and rank as often as they
stand there; texts of any length are counted whole; empty tables give no rows; other
columns of both tables are left aside.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazette.llm.common import materialize, text_batches

#: Pairs of item and term in one broadcast index (some tens of MB on a worker).
BLOCK_POSTINGS = 200_000
#: Documents scored at once; bounds a task's matrix of scores.
BATCH_DOCS = 256
#: Groups in which the tasks' heaps first meet.
MERGE_GROUPS = 64

# Bytes of terms as they are counted; every other byte separates.
_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order, with repeats."""
    return text.translate(_TERMS).split()


def _item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item, term``: distinct, from whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                terms = sorted(set(terms_of(batch.column("text")[i].as_py() or b"")))
                ids = pa.array([batch.column("item")[i].as_py()] * len(terms), batch.column("item").type)
                yield pa.RecordBatch.from_arrays([ids, pa.array(terms, pa.binary())], names=["item", "term"])

    given = items.select(F.col(item_id).alias("item"), F.col(text).cast("string").cast("binary").alias("text"))
    kind = given.schema["item"].dataType.simpleString()
    return given.mapInArrow(run, f"item {kind}, term binary").distinct()


def _blocks(pairs: DataFrame) -> list[list]:
    """The pairs of item and term, block by block; each block is one bounded list."""
    sizes = pairs.groupBy("item").count()
    largest = sizes.agg(F.max("count"), F.sum("count")).first()
    if not largest[1]:
        return []
    limit, n = max(BLOCK_POSTINGS, largest[0]), -(-largest[1] // BLOCK_POSTINGS)
    block = lambda n: F.pmod(F.xxhash64("item"), F.lit(n))
    while n > 1 and sizes.groupBy(block(n)).agg(F.sum("count").alias("n")).agg(F.max("n")).first()[0] > limit:
        n *= 2
    return [pairs.where(block(n) == i) for i in range(n)]


def _count_terms(docs: DataFrame, vocabulary, doc_id: str, text: str) -> DataFrame:
    """``doc_id, n, terms, tfs``: a document's length in terms, and its counts of the terms in ``vocabulary``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            lengths, sizes, terms, tfs = [], [], [], []
            for value in batch.column("text"):
                found = terms_of(value.as_py() or b"")
                hits = [(known[t], c) for t, c in Counter(found).items() if t in known]
                lengths.append(len(found))
                sizes.append(len(hits))
                terms += [t for t, _ in hits]
                tfs += [c for _, c in hits]
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lengths, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    return given.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>").where("n > 0")


class _Best:
    """The best documents of each item that a task has seen, in bounded heaps."""

    def __init__(self, items: int, k: int):
        self.k, self.heaps, self.floor = k, [[] for _ in range(items)], np.zeros(items, np.int64)

    def offer(self, ids: list, scores: np.ndarray) -> None:
        """``scores`` by document and item.  Of equals, a heap keeps the smaller id."""
        docs, items = np.nonzero((scores > 0) & (scores >= self.floor))
        for d, i, score in zip(docs.tolist(), items.tolist(), scores[docs, items].tolist()):
            heap, own = self.heaps[i], ids[d]
            entry = (score, own is not None, -own if own is not None else 0)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.floor[i] = heap[0][0]

    def rows(self) -> list[tuple]:
        return [(i, -own if known else None, score) for i, heap in enumerate(self.heaps) for score, known, own in heap]


def _score(index, k: int):
    """Streams the counts of documents through the index; at the end, the heaps of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, postings, weight, items, documents, terms = index.value
        best = _Best(items, k)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_DOCS):
                part = batch.slice(at, BATCH_DOCS)
                sizes = np.diff(part.column("terms").offsets.to_numpy())
                term = part.column("terms").flatten().to_numpy().astype(np.int64)
                tf = part.column("tfs").flatten().to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(part.num_rows), sizes)
                m = 10 + 90 * part.column("n").to_numpy() * documents // terms
                value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
                held = first[term + 1] - first[term]
                ends = np.cumsum(held)
                where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[term] - (ends - held), held)
                scores = np.zeros((part.num_rows, items), np.int64)
                np.add.at(scores.reshape(-1), np.repeat(doc * items, held) + postings[where], np.repeat(value, held))
                best.offer(part.column("doc_id").to_pylist(), scores)
        rows = best.rows()
        names = ["place", "doc_id", "score"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))], names=names)

    return run


def _top(df: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, pairs: DataFrame, k: int, doc_id: str, text: str) -> DataFrame:
    """Ranked documents of one block of items; the block's index is bounded."""
    spark = docs.sparkSession
    rows = pairs.collect()  # at most a block
    items = sorted({r.item for r in rows}, key=lambda x: (x is None, x if x is not None else 0))
    place = {x: i for i, x in enumerate(items)}
    terms = {t: i for i, t in enumerate(sorted({bytes(r.term) for r in rows}))}
    counts = materialize(_count_terms(docs, spark.sparkContext.broadcast(terms), doc_id, text))
    total = counts.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
    df = np.zeros(len(terms), np.int64)
    for r in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most a block
        df[r.term] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * total.documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    by_term = sorted((terms[bytes(r.term)], place[r.item]) for r in rows)
    first = np.searchsorted([t for t, _ in by_term], np.arange(len(terms) + 1))
    index = first, np.array([i for _, i in by_term], np.int64), weight, len(items), total.documents, total.terms
    heaps = counts.mapInArrow(_score(spark.sparkContext.broadcast(index), k), "place int, doc_id long, score long")
    some = _top(heaps.withColumn("task", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))), ["place", "task"], k)
    kind = pairs.schema["item"].dataType
    names = spark.createDataFrame([(i, x) for x, i in place.items()], f"place int, item_id {kind.simpleString()}")
    return _top(some, ["place"], k).join(F.broadcast(names), "place").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of the highest scores above 0 of every item."""
    text_batches(docs.sparkSession)
    pairs = materialize(_item_terms(items, item_id, text))
    found = [_search_block(docs, block, k, doc_id, text) for block in _blocks(pairs)]
    if not found:
        return docs.sparkSession.createDataFrame([], f"item_id {pairs.schema['item'].dataType.simpleString()}, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
