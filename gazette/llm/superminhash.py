"""MinHash near-dedup with SuperMinHash signatures.

A document's set holds its distinct five-word shingles (words of
``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; with one to four words the whole
sequence is the one shingle), held as 64-bit hashes.  Every shingle draws a random permutation of the
128 signature slots and one rank per level; level ``j`` competes for the slot at
place ``j`` of the permutation with a value in ``[j, j + 1)``, so a slot filled
on a lower level can never improve and a document stops as soon as all its
slots are filled (Ertl, "SuperMinHash").  The draws run level by level over all
shingles of a batch in numpy.

Then, in Spark:

1. equal sets collapse to one class, represented by its smallest ``doc_id``;
2. 32 bands of 4 slots give candidate buckets (two sets of similarity 0.75 miss
   each other in all bands with probability below 1e-5);
3. each bucket links its members to its smallest id, confirmed on full sets, and
   the links are grouped by union-find (``components``);
4. buckets that still hold several groups compare all members of different groups by
   longer signatures, in blocks of bounded size.  Members of pairs that may reach the
   threshold are confirmed on full sets inside bounded blocks of sets, all at once:
   shared shingles are counted for a whole block, and only one link for each joined group
   leaves it, so no table of pairs is made however many documents are almost alike.
   First this is done for the most alike pair of each two groups (two large groups meet
   by one link), then for what is left.

So every candidate pair of a band is either inside one group already or compared.

Defined cases: NULL and empty texts (no word) have ``n_shingles`` 0 and link with
nothing; rows of one ``doc_id`` count as one document; a NULL ``doc_id`` links
with nothing, has a NULL ``component_id`` and is kept; ties do not arise (the
smallest id of a group stays); an empty table gives an empty result.  Extra
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import broadcast_if_small, materialize, text_batches
from gazette.llm.components import components

SLOTS = 128
BANDS = 32
#: Pairs beyond a bucket's first member are compared by longer signatures of one byte a slot.
FINE_SLOTS = 1024
#: Slots of these that must agree before a pair is confirmed on full sets; a pair of
#: similarity 0.75 agrees on fewer with probability below 1e-6 (mean 769, deviation under 14).
LEAST_AGREEING = 699
#: Members of one bucket that are compared with each other in one step.
BLOCK_ROWS = 512
#: Shingles of a block whose sets are compared (and one set, if that has more).
BLOCK_SHINGLES = 200_000
#: Shingles that more members of two blocks hold are counted by a matrix product, the others by their pairs.
COMMON_SHINGLE = 32

_STEP = 0x9E3779B97F4A7C15
_GOLDEN = np.uint64(_STEP)
_LOW = np.uint64(0xFFFFFFFF)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a whole text's shingles."""
    words = text.encode().lower().split() if text else []  # bytes: A-Z and \x20 \x09-\x0D only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(size, len(words))
    out = np.full(len(h) - k + 1, np.uint64(k), np.uint64)
    for i in range(k):
        out = _mix(out * _GOLDEN + h[i : len(h) - k + 1 + i])
    return np.unique(out)


#: Bytes of permutations that a worker holds at once.
_PLACES_BYTES = 32 << 20


def superminhash(values: np.ndarray, owner: np.ndarray, owners: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures, one row per owner, of the hashes that each owner holds (sorted by owner):
    per slot the winning level in the high and its rank in the low 32 bits."""
    kind = np.uint8 if slots <= 256 else np.uint16
    room = max(1, _PLACES_BYTES // (slots * np.dtype(kind).itemsize))
    signature = np.full((owners, slots), _EMPTY, np.uint64)
    starts = np.searchsorted(owner, np.arange(owners + 1))
    first = 0
    while first < owners:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + room, side="right")) - 1)
        part = slice(starts[first], starts[last])
        signature[first:last] = _levels(values[part], owner[part] - first, last - first, slots, kind)
        first = last
    return signature


def _levels(values: np.ndarray, owner: np.ndarray, owners: int, slots: int, kind: type) -> np.ndarray:
    signature = np.full(owners * slots, _EMPTY, np.uint64)
    place = None
    for level in range(slots):
        draw = _mix(values + np.uint64(_STEP * (level + 1) & 0xFFFFFFFFFFFFFFFF))
        pick = level + (((draw & _LOW) * np.uint64(slots - level)) >> np.uint64(32)).astype(np.int64)
        value = np.uint64(level << 32) | (draw >> np.uint64(32))
        at = np.arange(len(values))
        if place is None:
            slot = pick
        else:
            slot = place[at, pick].astype(np.int64)
            place[at, pick] = place[:, level]
        np.minimum.at(signature, owner * slots + slot, value)
        open_ = (signature.reshape(owners, slots) == _EMPTY).any(axis=1)[owner]
        if not open_.any():
            break
        values, owner = values[open_], owner[open_]
        if place is None:
            place = np.tile(np.arange(slots, dtype=kind), (len(values), 1))
            place[np.arange(len(values)), pick[open_]] = 0
        else:
            place = place[open_]
    return signature.reshape(owners, slots)


def _signed(sets: list[np.ndarray], slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the sets that hold anything, and their signatures."""
    sizes = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return full, np.empty((0, slots), np.uint64)
    owner = np.repeat(np.arange(len(full)), sizes[full])
    return full, superminhash(np.concatenate([sets[i] for i in full]), owner, len(full), slots)


FEATURES = "doc_id long, n_shingles long, set_key string, signature binary"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        sets = [shingle_set(t) for t in texts]
        keys: list = [None] * len(sets)
        marks: list = [None] * len(sets)
        for i, signature in zip(*_signed(sets, SLOTS)):
            keys[i] = xxhash.xxh3_128_hexdigest(sets[i].tobytes())
            marks[i] = signature.astype(np.uint32).tobytes()  # the ranks; equal ranks of two levels are as rare as equal hashes
        sizes = pa.array([len(s) for s in sets], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [ids, sizes, pa.array(keys, pa.string()), pa.array(marks, pa.binary())],
            names=["doc_id", "n_shingles", "set_key", "signature"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t).view(np.int64) for t in batch.column(1).to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "shingles"])


def _fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t) for t in batch.column(1).to_pylist()]
        marks: list = [None] * len(sets)
        for i, signature in zip(*_signed(sets, FINE_SLOTS)):
            marks[i] = signature.astype(np.uint8).tobytes()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.binary())], names=["doc_id", "fine"])


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_key, signature`` of every document."""
    text_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_features, FEATURES)


def _may_reach(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of the documents whose ``_id`` is given."""
    ids = materialize(ids.distinct())
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.join(broadcast_if_small(ids, ids.count()), texts["doc_id"] == ids["_id"], "left_semi")


def confirm(pairs: DataFrame, docs: DataFrame, percent: int = 75) -> DataFrame:
    """The pairs ``(a, b)`` of a written table whose full shingle sets reach the similarity."""
    sets = materialize(_texts_of(pairs.select(F.explode(F.array("a", "b")).alias("_id")), docs).mapInArrow(_sets, "doc_id long, shingles array<long>"))
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("_sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("_sb"))
    common = F.size(F.array_intersect("_sa", "_sb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", F.size("_sa").alias("_na"), F.size("_sb").alias("_nb"), common.alias("_common"))
    return joined.where(F.col("_common") * 100 >= (F.col("_na") + F.col("_nb") - F.col("_common")) * percent).select("a", "b").distinct()


def _compare_blocks(least: int, percent: int, best: bool):
    """Members of pairs of different groups in one block pair whose signatures may reach the threshold;
    ``best``: of the most alike pair of each two groups.  Pairs of two rows that are ``done`` are left out."""

    def members(g) -> np.ndarray:
        fine = np.frombuffer(b"".join(g["fine"]), np.uint8).reshape(len(g), -1)
        bands = np.frombuffer(b"".join(g["signature"]), np.uint32).reshape(len(g), BANDS, -1)
        band = g["band"].iat[0]
        ids, group, n, done = g["id"].to_numpy(), g["grp"].to_numpy(), g["n"].to_numpy(), g["done"].to_numpy()
        block, bi, bj = g["blk"].to_numpy(), g["bi"].iat[0], g["bj"].iat[0]
        lo, hi = np.flatnonzero(block == bi), np.flatnonzero(block == bj)
        found_a, found_b, alike = [], [], []
        for i in lo:
            with_ = hi[(ids[hi] > ids[i]) if bi == bj else slice(None)]
            with_ = with_[(group[with_] != group[i]) & ~(done[with_] & done[i])]
            with_ = with_[np.minimum(n[with_], n[i]) * 100 >= np.maximum(n[with_], n[i]) * percent]
            with_ = with_[(bands[with_] == bands[i]).all(axis=2).argmax(axis=1) == band]  # a pair counts in the first bucket it shares
            agree = (fine[with_] == fine[i]).sum(axis=1)
            with_, agree = with_[agree >= least], agree[agree >= least]
            found_a.append(np.full(len(with_), i))
            found_b.append(with_)
            alike.append(agree)
        a, b = np.concatenate(found_a or [np.empty(0, np.int64)]), np.concatenate(found_b or [np.empty(0, np.int64)])
        if best and len(a):
            lo_group, hi_group = np.minimum(group[a], group[b]), np.maximum(group[a], group[b])
            order = np.lexsort((ids[b], ids[a], -np.concatenate(alike), hi_group, lo_group))
            new = np.concatenate([[True], (np.diff(lo_group[order]) != 0) | (np.diff(hi_group[order]) != 0)])
            a, b = a[order[new]], b[order[new]]
        return np.unique(ids[np.concatenate([a, b])])

    def solve(g):
        found = members(g)
        return {"key": np.full(len(found), g["key"].iat[0]), "id": found}

    return _by_block(solve, ["key", "id"])


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Number of shingles that each two of the sets share."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, token, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.lexsort((owner, token))
    owner, held = owner[order], held[token[order]]
    out, pairs, waiting = np.zeros(n * n, np.int64), [], 0
    for d in range(2, COMMON_SHINGLE + 1):  # the holders of each rarer shingle, pair by pair
        who = owner[held == d].reshape(-1, d)
        for i in range(d - 1 if len(who) else 0):
            pairs.append((who[:, i, None] * n + who[:, i + 1 :]).ravel())
            waiting += len(pairs[-1])
            if waiting > 4_000_000:
                out, pairs, waiting = out + np.bincount(np.concatenate(pairs), minlength=n * n), [], 0
    if pairs:
        out += np.bincount(np.concatenate(pairs), minlength=n * n)
    out = out.reshape(n, n)
    out += out.T
    common = held > COMMON_SHINGLE
    columns = np.unique(token[order][common], return_inverse=True)[1]
    who, width = owner[common], 4096
    for first in range(0, columns.max() + 1 if len(columns) else 0, width):
        part = (columns >= first) & (columns < first + width)
        dense = np.zeros((n, width), np.float32)
        dense[who[part], columns[part] - first] = 1
        out += (dense @ dense.T).astype(np.int64)
    return out


def _confirm_blocks(percent: int):
    """Links between groups of which members in one block pair reach the similarity: each group to the
    smallest one that it is joined with there."""

    def solve(g):
        sets = [np.asarray(s).view(np.uint64) for s in g["shingles"]]
        size, group = np.array([len(s) for s in sets]), g["grp"].to_numpy()
        common = _shared(sets)
        block, bi, bj = g["blk"].to_numpy(), g["bi"].iat[0], g["bj"].iat[0]
        a, b = np.nonzero((block == bi)[:, None] & (block == bj) & (group[:, None] != group) & (common * 100 >= (size[:, None] + size - common) * percent))
        names, place = np.unique(group, return_inverse=True)
        root = np.arange(len(names))
        while len(a):
            low = np.minimum(root[place[a]], root[place[b]])
            new = root.copy()
            np.minimum.at(new, place[a], low)
            np.minimum.at(new, place[b], low)
            if (new == root).all():
                break
            root = new
        moved = np.flatnonzero(root != np.arange(len(names)))
        return {"a": names[root[moved]], "b": names[moved]}

    return _by_block(solve, ["a", "b"])


def _by_block(solve, columns: list[str]):
    """Calls ``solve`` on the rows of each ``(key, bi, bj)`` of a sorted partition."""

    def run(frames):
        import pandas as pd

        def solved(rows):
            parts = [solve(g) for _, g in rows.groupby(["key", "bi", "bj"], sort=False) if len(g) > 1]
            return pd.DataFrame({c: np.concatenate([p[c] for p in parts] or [np.empty(0, np.int64)]).astype(np.int64) for c in columns}).drop_duplicates()

        rest = None  # rows of the last block pair, which the next batch may go on with
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            if not len(frame):
                continue
            last = frame.iloc[-1]
            tail = (frame["key"] == last["key"]) & (frame["bi"] == last["bi"]) & (frame["bj"] == last["bj"])
            rest = frame[tail]
            yield solved(frame[~tail])
        if rest is not None:
            yield solved(rest)

    return run


def _open_rows(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of buckets that hold several groups, with their group ``grp``."""
    placed = rows.join(groups, rows["id"] == groups["node"], "left").select(*[rows[c] for c in rows.columns], F.coalesce("root", "id").alias("grp"))
    several = placed.groupBy("key").agg(F.min("grp").alias("_lo"), F.max("grp").alias("_hi"), F.count(F.lit(1)).alias("_rows")).where("_lo <> _hi")
    return placed.join(several.select(F.col("key").alias("_key"), "_rows"), F.col("key") == F.col("_key")).drop("_key")


def _dealt(rows: DataFrame, blocks: Column, columns: list[str]) -> DataFrame:
    """``rows`` once for each block pair ``(bi, bj)`` of their ``key`` that they take part in, with their block ``blk``."""
    cut = rows.withColumn("_blocks", blocks).withColumn("blk", F.pmod(F.xxhash64("id"), F.col("_blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    return cut.withColumn("_other", other).select("key", F.least("blk", "_other").alias("bi"), F.greatest("blk", "_other").alias("bj"), "blk", "id", *columns)


def _candidates(rows: DataFrame, groups: DataFrame, done: DataFrame | None, block_rows: int, percent: int, best: bool) -> DataFrame:
    """``key, id`` of members of pairs between the groups of a bucket that may reach the threshold."""
    open_ = _open_rows(rows, groups)
    if done is None:
        open_ = open_.withColumn("done", F.lit(False))
    else:
        seen = done.select(F.col("key").alias("_k"), F.col("id").alias("_i"), F.lit(True).alias("done"))
        open_ = open_.join(seen, (F.col("key") == F.col("_k")) & (F.col("id") == F.col("_i")), "left").withColumn("done", F.coalesce("done", F.lit(False)))
    dealt = _dealt(open_, F.ceil(F.col("_rows") / block_rows), ["band", "n", "signature", "fine", "grp", "done"])
    sorted_ = dealt.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")
    return sorted_.mapInPandas(_compare_blocks(LEAST_AGREEING, percent, best), "key long, id long").distinct()


def _confirmed(members: DataFrame, groups: DataFrame, sets: DataFrame, block_rows: int, percent: int) -> DataFrame:
    """``a, b``: groups that members of one bucket (``key, id, n``) join, confirmed on full sets in blocks."""
    placed = members.join(groups, members["id"] == groups["node"], "left").select("key", "id", "n", F.coalesce("root", "id").alias("grp"))
    sums = placed.groupBy("key").agg(F.sum("n").alias("_n"), F.count(F.lit(1)).alias("_m"), F.min("grp").alias("_lo"), F.max("grp").alias("_hi")).where("_lo <> _hi")
    placed = placed.join(sums.select(F.col("key").alias("_key"), "_n", "_m"), F.col("key") == F.col("_key"))
    dealt = _dealt(placed, F.greatest(F.ceil(F.col("_n") / BLOCK_SHINGLES), F.ceil(F.col("_m") / block_rows)), ["grp"])
    held = dealt.join(sets, F.col("id") == F.col("doc_id")).drop("doc_id")
    sorted_ = held.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")
    return sorted_.mapInPandas(_confirm_blocks(percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = 75, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    seen = materialize(signatures(docs))
    named = seen.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    classes = materialize(
        named.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.max("n_shingles").alias("n"), F.first("signature").alias("signature"))
    )
    width = SLOTS // BANDS * 4
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("signature", b * width + 1, width)) for b in range(BANDS)])
    slim = classes.select("id", "n", F.posexplode(keys).alias("band", "key"))
    buckets = slim.groupBy("key").agg(F.min(F.struct("id", "n")).alias("c"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    shared = materialize(slim.join(buckets.select("key", "c"), "key"))
    star = (
        shared.where((F.col("id") != F.col("c.id")) & _may_reach(F.col("n"), F.col("c.n"), percent))
        .select(F.col("c.id").alias("a"), F.col("id").alias("b"))
        .distinct()
    )
    star = materialize(star)
    links = materialize(confirm(star, docs, percent))
    roots = components(links, "a", "b")
    left = materialize(_open_rows(shared.select("key", "band", "id", "n"), roots).select("key", "band", "id", "n"))
    fine = _texts_of(left.select(F.col("id").alias("_id")), docs).mapInArrow(_fine, "doc_id long, fine binary").where("fine IS NOT NULL")
    signed = fine.join(classes.select("id", "signature"), F.col("doc_id") == F.col("id")).drop("id").dropDuplicates(["doc_id"])
    left = materialize(left.join(signed, F.col("id") == F.col("doc_id")).drop("doc_id"))
    done = None  # members of a bucket that were confirmed with each other
    for best in (True, False):
        found = materialize(_candidates(left, roots, done, block_rows, percent, best))
        members = found.join(left.select("key", "id", "n"), ["key", "id"])
        sets = _texts_of(found.select(F.col("id").alias("_id")), docs).mapInArrow(_sets, "doc_id long, shingles array<long>")
        more = _confirmed(members, roots, materialize(sets.dropDuplicates(["doc_id"])), block_rows, percent)
        roots = components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(more), "a", "b")
        done = found

    keyed = seen.select("doc_id", "n_shingles", F.coalesce("set_key", F.concat(F.lit("#"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("_key"))
    rep = classes.join(roots, classes["id"] == roots["node"], "left").select(F.col("set_key").alias("_set"), F.coalesce("root", "id").alias("_root"))
    out = keyed.join(rep, F.col("_key") == F.col("_set"), "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("_root", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
