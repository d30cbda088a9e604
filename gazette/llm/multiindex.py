"""Embedding near-dedup with an inverted multi-index.

A vector (scaled to length 1) is cut into two halves, each with a codebook of its
own; the pair of nearest centroids is the vector's cell in the product grid.  Two
vectors of cosine ``c`` are at most ``sqrt(2 - 2c)`` apart, so a neighbour can only
lie in another cell if it crosses the planes between the two cells' centroids.
For each half the distance to such a plane is known; with the centroids of both
halves in order of that distance (the multi-sequence order) a vector visits cells
until the sum of the squared distances leaves the bound.

The bound follows from the target recall.  For recall 1 it is ``2 - 2c`` itself and no
neighbour can be missed, but in many dimensions most cells lie within it.  Below 1, the
default, it is measured on the fitting sample: the way that neighbours really have to go,
of pairs of sample vectors at the cosine and of pairs made exactly at it, with offsets of
the sample's own spread and of all directions alike; the bound is the ``recall`` quantile
of the kind that goes furthest.  Made pairs are the farthest that count as neighbours, so
most links are found with more than that probability.

Of two cells only one visits the other (the one less than half a turn before it), so
a pair meets once.  Cells are cut into blocks of bounded rows; every block pair is
one numpy product in double precision, and gives per vector its number of links and
the smallest id it is connected with inside the block: never pairs.  ``components``
joins these.  Equal vectors of one label are one entry with a count.

The codebooks are fitted on a bounded, seeded sample (``SAMPLE_ROWS``) and every
row is indexed; their size follows the number of rows.

Defined cases: rows whose label or vector is NULL, and vectors that are empty, zero
or hold NULL or non-finite components link with nothing; so do vectors of
different lengths, and rows of a NULL ``vec_id`` (NULL component, kept).  Equal
rows count as vectors of their own.  An empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import materialize, unit
from gazette.llm.components import components

LEAST_COSINE = 0.93
#: Share of neighbours at the very cosine whose cells are visited; 1: all, by the exact bound.
RECALL = 0.9999
#: Pairs of each kind on which the bound is measured.
MEASURED_PAIRS = 20_000
SAMPLE_ROWS = 16_384
#: Rows of a cell, and of its visitors, that meet in one task.
HOME_ROWS, VISITOR_ROWS = 1024, 2048
#: Rows that a cell of all labels should hold; sets the codebooks' size.
ROWS_PER_CELL = 4096
LEAST_CODES, MOST_CODES = 4, 256


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles, with a key that is equal for equal vectors; NULL where unusable."""
    for batch in batches:
        vectors, keys = [], []
        usable = [i is not None and l is not None for i, l in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        for ok, v in zip(usable, batch.column(2)):
            x = None
            if ok and v.is_valid and v.values.null_count == 0:
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # -0.0 is 0.0
                if not (len(x) and np.isfinite(x).all() and x.any() and np.isfinite(x @ x) and x @ x > 0):
                    x = None
            vectors.append(None if x is None else x.tobytes())
            keys.append(None if x is None else xxhash.xxh3_128_hexdigest(vectors[-1]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(keys, pa.string()), pa.array(vectors, pa.binary())], names=["vec_id", "label", "key", "v"]
        )


def _unit_rows(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _codebook(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's k-means from evenly spaced rows of the sample (which is in random order)."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        mine = ((centres**2).sum(axis=1) - 2 * (x @ centres.T)).argmin(axis=1)
        for c in range(len(centres)):
            if (mine == c).any():
                centres[c] = x[mine == c].mean(axis=0)
    return centres


@dataclass
class Grid:
    """The product grid of vectors of one length."""

    halves: tuple[np.ndarray, np.ndarray]
    bound: float

    def crossings(self, x: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid, and squared distance to the plane between it and each other one."""
        c = self.halves[half]
        far = (x**2).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c**2).sum(axis=1)
        own = far.argmin(axis=1)
        apart = np.sqrt(np.maximum(((c[:, None, :] - c[None, :, :]) ** 2).sum(axis=2), 1e-300))
        plane = (far - far[np.arange(len(x)), own][:, None]) / (2 * apart[own])
        plane[np.arange(len(x)), own] = 0
        return own, np.maximum(plane, 0) ** 2

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Own cell of each row; then row and cell of every visit, the own cell's included."""
        cut = (x.shape[1] + 1) // 2
        (i, bi), (j, bj) = self.crossings(x[:, :cut], 0), self.crossings(x[:, cut:], 1)
        width = len(self.halves[1])
        cells = len(self.halves[0]) * width
        home = i * width + j
        order = np.argsort(bi, axis=1), np.argsort(bj, axis=1)
        rows, found = [], []
        for a in range(bi.shape[1]):  # multi-sequence: the a-th centroid of the first half with all that stay in the bound
            first = order[0][:, a]
            left = self.bound - bi[np.arange(len(x)), first]
            if (left < 0).all():
                break
            inside = np.take_along_axis(bj, order[1], axis=1) <= left[:, None]
            r, b = np.nonzero(inside)
            rows.append(r)
            found.append(first[r] * width + order[1][r, b])
        row, cell = np.concatenate(rows), np.concatenate(found)
        turn = (cell - home[row]) % cells
        forward = (2 * turn < cells) | ((2 * turn == cells) & (home[row] < cell))
        return home, row[forward], cell[forward]


def _made_pairs(x: np.ndarray, spread: np.ndarray, least: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of the sample, and one at exactly the cosine ``least`` from each, off in a direction drawn by ``spread``."""
    a = x[rng.integers(0, len(x), MEASURED_PAIRS)]
    off = rng.normal(size=(MEASURED_PAIRS, len(spread))) @ spread
    off -= (off * a).sum(axis=1, keepdims=True) * a
    length = np.linalg.norm(off, axis=1, keepdims=True)
    some = length[:, 0] > 1e-9
    return a[some], least * a[some] + math.sqrt(max(0.0, 1 - least * least)) * off[some] / length[some]


def _ways(grid: Grid, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distance across cell borders from each row of ``a`` to the cell of the same row of ``b``."""
    cut = (a.shape[1] + 1) // 2
    out = np.zeros(len(a))
    for half, part in ((0, slice(0, cut)), (1, slice(cut, None))):
        to = grid.crossings(b[:, part], half)[0]
        out += grid.crossings(a[:, part], half)[1][np.arange(len(a)), to]
    return out


def bound_of(grid: Grid, x: np.ndarray, least: float, recall: float) -> float:
    """Square of the way across cell borders beyond which no cell is visited."""
    whole = (2 - 2 * least) * (1 + 1e-9) + 1e-12
    if recall >= 1 or len(x) < 2:
        return whole
    rng = np.random.default_rng(17)
    deviations = (x - x.mean(axis=0)) / math.sqrt(len(x))
    # a factor of the sample's covariance; all directions alike
    kinds = [_made_pairs(x, np.linalg.qr(deviations, mode="r"), least, rng), _made_pairs(x, np.eye(x.shape[1]), least, rng)]
    asked = x[:2048]  # the sample is in random order
    i, j = np.nonzero(np.triu(asked @ x.T >= least, 1))
    if len(i):
        drawn = rng.permutation(len(i))[:MEASURED_PAIRS]
        kinds.append((asked[i[drawn]], x[j[drawn]]))
    ways = [np.concatenate([_ways(grid, a, b), _ways(grid, b, a)]) for a, b in kinds if len(a)]
    return min(whole, max((float(np.quantile(w, recall, method="higher")) for w in ways), default=whole) * (1 + 1e-9) + 1e-12)


def fit(sample: list[bytes], codes: int, least: float, recall: float) -> dict[int, Grid]:
    """A grid for each length of vector in the sample."""
    grids = {}
    for size in sorted({len(v) for v in sample}):
        x = _unit_rows([v for v in sample if len(v) == size])
        cut = (x.shape[1] + 1) // 2
        grids[size] = Grid((_codebook(x[:, :cut], codes), _codebook(x[:, cut:], codes)), 0.0)
        grids[size].bound = bound_of(grids[size], x, least, recall)
    return grids


_DEALT = "label string, size int, cell int, home boolean, resident boolean, id long, n long, v binary"


def _assign(grids: dict[int, Grid]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, ids, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "id", "n"))
            raw = np.array(batch.column("v").to_pylist(), object)
            sizes = np.array([len(v) for v in raw], np.int64)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                grid = grids.get(int(size))
                if grid is None:  # a length that the sample does not have: one cell
                    home, row, cell = np.zeros(len(own), np.int64), np.arange(len(own)), np.zeros(len(own), np.int64)
                else:
                    home, row, cell = grid.visits(_unit_rows(list(raw[own])))
                at = own[np.concatenate([np.arange(len(own)), row])]
                cells = np.concatenate([home, cell]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(label[at], pa.string()),
                        pa.array(np.full(len(at), size, np.int32)),
                        pa.array(cells),
                        pa.array(np.arange(len(at)) < len(own)),
                        pa.array(np.concatenate([np.ones(len(own), bool), cell == home[row]])),
                        pa.array(ids[at], pa.int64()),
                        pa.array(n[at], pa.int64()),
                        pa.array(raw[at], pa.binary()),
                    ],
                    names=["label", "size", "cell", "home", "resident", "id", "n", "v"],
                )

    return run


def _compare(least: float):
    """Per vector of a block pair: weighted number of links, smallest connected id."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        home, away = block[block["home"]], block[~block["home"]]
        if not len(home) or not len(away):
            return pd.DataFrame({"id": [], "links": [], "root": []}).astype("int64")
        ids = np.concatenate([home["id"], away["id"]])
        weight = np.concatenate([home["n"], away["n"]])
        cosine = _unit_rows(list(away["v"])) @ _unit_rows(list(home["v"])).T
        a, b = np.nonzero(cosine >= least)
        b_id, a_id = home["id"].to_numpy()[b], away["id"].to_numpy()[a]
        met = ~away["resident"].to_numpy()[a] | (a_id < b_id)  # inside a cell each pair once, nobody with itself
        a, b = a[met] + len(home), b[met]
        links = np.bincount(a, weights=weight[b], minlength=len(ids)) + np.bincount(b, weights=weight[a], minlength=len(ids))
        _, place = np.unique(ids, return_inverse=True)  # a resident stands on both sides
        root = np.unique(ids)
        while len(a):
            low = np.minimum(root[place[a]], root[place[b]])
            new = root.copy()
            np.minimum.at(new, place[a], low)
            np.minimum.at(new, place[b], low)
            if (new == root).all():
                break
            root = new
        some = links > 0
        return pd.DataFrame({"id": ids[some], "links": links[some].astype(np.int64), "root": root[place[some]]})

    return run


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE, recall: float = RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vec_id, label, embedding``."""
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    slim = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>"))
    rows = materialize(slim.mapInArrow(_clean, "vec_id long, label string, key string, v binary"))
    classes = materialize(
        rows.where("key IS NOT NULL").groupBy("label", "key").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v"))
    )
    total = classes.count()
    seeded = classes.withColumn("_u", unit(F.xxhash64(F.lit("codebook"), F.col("key")))).where(F.col("_u") * max(total, 1) <= 1.5 * SAMPLE_ROWS)
    sample = [r["v"] for r in seeded.orderBy("_u", "key").limit(SAMPLE_ROWS).select("v").collect()]
    codes = min(MOST_CODES, max(LEAST_CODES, math.ceil(math.sqrt(total / ROWS_PER_CELL))))
    dealt = materialize(classes.select("label", "id", "n", "v").mapInArrow(_assign(fit(sample, codes, least, recall)), _DEALT))

    cell = ["label", "size", "cell"]
    counts = dealt.groupBy(*cell).agg(F.sum(F.col("home").cast("long")).alias("_homes"), F.count(F.lit(1)).alias("_all"))
    parts = counts.where("_homes > 0").select(
        *[F.col(c).alias(f"_{c}") for c in cell], F.ceil(F.col("_homes") / HOME_ROWS).alias("_hb"), F.ceil((F.col("_all") - F.col("_homes")) / VISITOR_ROWS).alias("_vb")
    )
    met = dealt.join(parts, (F.col("label") == F.col("_label")) & (F.col("size") == F.col("_size")) & (F.col("cell") == F.col("_cell")))
    hashed = F.xxhash64("id")
    hs = F.when(F.col("home"), F.array(F.pmod(hashed, F.col("_hb")))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("_hb") - 1))
    met = met.withColumn("_h", F.explode(hs))
    vs = F.when(F.col("home"), F.sequence(F.lit(0).cast("long"), F.col("_vb") - 1)).otherwise(F.array(F.pmod(hashed, F.col("_vb"))))
    met = met.withColumn("_v", F.explode(vs)).select(*cell, "_h", "_v", "home", "resident", "id", "n", "v")
    found = materialize(met.groupBy(*cell, "_h", "_v").applyInPandas(_compare(least), "id long, links long, root long"))

    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select("id", "root"), "id", "root")
    named = classes.select(F.col("label").alias("_l"), F.col("key").alias("_k"), "id", "n").join(links, "id", "left").join(roots, F.col("id") == F.col("node"), "left")
    keyed = rows.select("vec_id", F.coalesce("label", F.lit("")).alias("label"), F.coalesce("key", F.concat(F.lit("#"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))).alias("key"))
    out = keyed.join(named, (F.col("label") == F.col("_l")) & (F.col("key") == F.col("_k")), "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("root", "id", "vec_id"))
    return out.select(
        "vec_id",
        F.coalesce(F.col("n") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
