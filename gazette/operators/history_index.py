"""Headline vectors kept by day and cell, so that novelty reads only what can decide.

The index is a table of headlines partitioned by day; a day's rows are sorted by the cell of
their vector, the nearest of a fixed set of pivots, so Parquet skips the row groups of other
cells.  Each row keeps the angle to its pivot.  A candidate can reach a threshold only
in cells whose range of angles lies within the threshold's angle of its own angle to the
pivot (triangle inequality: nothing is lost).  A day's candidates read the cells that any of
them can reach, and each is compared within its own cells only.

The pivots are drawn once, from a hashed sample of the first headlines that are added (each the
farthest from those before, at most ``MOST_PIVOTS``); later days keep them.  Adding a day again replaces it.  Vectors of another
width than the pivots' are in one cell of their own, which is always read; headlines
without a cosine (zero, missing) are left out, as they match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gazette.functions.vectors import SIM_DIGITS, units_by_width
from gazette.operators.cells import SLACK, key_schema
from gazette.operators.simjoin import DEFAULT_BLOCK_ROWS, cross_similarity
from gazette.plans.stored import join_on, path_exists, stored

#: Pivots of an index: bounds what the driver and every task hold.
MOST_PIVOTS = 256
#: Cell of vectors of another width than the pivots'.
OTHER = -1


def _angles(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ pivots.T, -1, 1))


class HistoryIndex:
    """``path``: the folder of the index.  ``keys``: columns that a headline and a candidate must share."""

    def __init__(self, path: str, keys: Sequence[str] = (), pivots: int = 64):
        self.path, self.keys, self.pivots = path.rstrip("/"), list(keys), min(pivots, MOST_PIVOTS)

    def _around(self, spark: SparkSession) -> np.ndarray | None:
        if not path_exists(spark, f"{self.path}/pivots"):
            return None
        rows = spark.read.parquet(f"{self.path}/pivots").orderBy("place").collect()  # at most MOST_PIVOTS
        return np.array([r["unit"] for r in rows]) if rows else None

    def _draw(self, headlines: DataFrame) -> np.ndarray | None:
        spark = headlines.sparkSession
        drawn = headlines.select("embedding", F.xxhash64("headline", "digest_date").alias("_h")).orderBy("_h").limit(4 * MOST_PIVOTS).toPandas()
        found = units_by_width(drawn["embedding"])
        if not found:
            return None
        _, unit = max(found.values(), key=lambda x: len(x[0]))
        taken, nearest = [0], unit @ unit[0]
        while len(taken) < min(self.pivots, len(unit)) and nearest.min() < 1 - 1e-9:  # the one farthest from those taken
            taken.append(int(nearest.argmin()))
            nearest = np.maximum(nearest, unit @ unit[taken[-1]])
        unit = unit[taken]
        rows = pd.DataFrame({"place": range(len(unit)), "unit": [u.tolist() for u in unit]})
        spark.createDataFrame(rows, "place int, unit array<double>").write.parquet(f"{self.path}/pivots")
        return unit

    def add(self, headlines: DataFrame) -> None:
        """Add ``(keys…, digest_date, headline, embedding)``; a day that was added before is replaced."""
        spark = headlines.sparkSession
        around = self._around(spark)
        around = self._draw(headlines) if around is None else around
        names = [*self.keys, "digest_date", "headline"]
        schema = f"{key_schema(headlines, names)}, embedding array<double>, cell int, angle double"

        def place(batches):
            for rows in batches:
                for width, (at, unit) in units_by_width(rows["embedding"]).items():
                    own = around is not None and width == around.shape[1]
                    angles = _angles(unit, around) if own else np.zeros((len(at), 1))
                    cell = angles.argmin(axis=1) if own else np.full(len(at), OTHER)
                    yield rows.iloc[at][names].assign(embedding=list(unit), cell=cell, angle=angles.min(axis=1))

        placed = headlines.select(*names, F.col("embedding").cast("array<double>").alias("embedding")).mapInPandas(place, schema)
        dealt = placed.repartition("digest_date").sortWithinPartitions("digest_date", "cell")
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("digest_date").parquet(f"{self.path}/headlines")

    def read(self, spark: SparkSession) -> DataFrame | None:
        if not path_exists(spark, f"{self.path}/headlines"):  # nothing added yet
            return None
        table = spark.read.parquet(f"{self.path}/headlines")
        return table.withColumn("digest_date", F.col("digest_date").cast("date"))

    def reach(self, candidates: DataFrame, threshold: float, days: DataFrame) -> DataFrame:
        """``candidates`` (with ``embedding``) and ``_cells``: those that can hold a headline at ``threshold``, by the
        ranges of angles in ``days``, rows of the index; NULL without a cosine."""
        spark = candidates.sparkSession
        around = self._around(spark)
        ranges = days.groupBy("cell").agg(F.min("angle").alias("lo"), F.max("angle").alias("hi")).collect()  # one row per cell
        lo, hi = (np.array([r[c] for r in ranges if r["cell"] != OTHER]) for c in ("lo", "hi"))
        cells = np.array([r["cell"] for r in ranges if r["cell"] != OTHER], int)
        other = any(r["cell"] == OTHER for r in ranges)
        most = np.arccos(np.clip(round(threshold, SIM_DIGITS) - 10.0**-SIM_DIGITS, -1, 1)) + SLACK

        def run(batches):
            for rows in batches:
                out: list = [None] * len(rows)
                for width, (at, unit) in units_by_width(rows["embedding"]).items():
                    own = around is not None and width == around.shape[1]
                    angles = _angles(unit, around)[:, cells] if own and len(cells) else np.zeros((len(at), 0))
                    near = (angles <= hi + most) & (angles >= lo - most) if angles.shape[1] else np.zeros((len(at), 0), bool)
                    for i, row in zip(at, near):
                        out[i] = cells[row].tolist() if own else [OTHER] * other
                yield rows.assign(_cells=out)

        return candidates.mapInPandas(run, f"{key_schema(candidates, candidates.columns)}, _cells array<int>")


def novelty_by_index(
    df: DataFrame,
    index: HistoryIndex,
    lookback_days: int = 7,
    threshold: float = 0.85,
    as_of: str | Column = "as_of",
    id_cols: Sequence[str] = ("digest_id", "seq"),
    on_zero_vector: str = "drop",
    block_rows: int = DEFAULT_BLOCK_ROWS,
    rows_read: Observation | None = None,
) -> DataFrame:
    """Candidates whose best cosine to the headlines of their window is ``< threshold``: the rows of
    ``novelty_filter``, from the part of the index that can decide.  ``rows_read`` counts that part as ``n``."""
    if on_zero_vector not in ("drop", "keep"):
        raise ValueError(on_zero_vector)
    spark, keys = df.sparkSession, index.keys
    table = index.read(spark)
    if table is None or lookback_days < 1:
        return df
    asof = F.col(as_of) if isinstance(as_of, str) else as_of
    cands = df.select(*id_cols, *[k for k in keys if k not in id_cols], "embedding", asof.alias("_as_of"))
    span = cands.agg(F.date_sub(F.min("_as_of"), lookback_days - 1).alias("first"), F.max("_as_of").alias("last")).head()
    if span["first"] is None:
        return df
    window = table.filter(F.col("digest_date").between(span["first"], span["last"]))
    reached = stored(index.reach(cands, threshold, window))
    cells = [r["c"] for r in reached.select(F.explode("_cells").alias("c")).distinct().collect()]  # at most MOST_PIVOTS + 1
    part = window.filter(F.col("cell").isin(cells))
    part = part.observe(rows_read, F.count(F.lit(1)).alias("n")) if rows_read is not None else part
    day = F.explode(F.sequence("digest_date", F.date_add("digest_date", lookback_days - 1)))
    hist = stored(part.select(*keys, "digest_date", "headline", "cell", "embedding")).select(
        *keys, day.alias("_hd"), F.col("cell").alias("_cell"), F.xxhash64(*keys, "digest_date", "headline").alias("_hid"), "embedding"
    )
    left = reached.select(*id_cols, *[k for k in keys if k not in id_cols], "embedding", F.col("_as_of").alias("_hd"), F.explode("_cells").alias("_cell"))
    best = cross_similarity(left, hist, key=[*keys, "_hd", "_cell"], mode="max", left_cols=list(id_cols), right_id="_hid", block_rows=block_rows)
    drop = best.filter(F.col("max_sim") >= F.lit(threshold)).select(*id_cols)
    if on_zero_vector == "drop":  # as long as there is a headline in the window
        days = window.select(*keys, "digest_date").distinct()
        none = reached.filter(F.col("_cells").isNull()).select(*id_cols, *[F.col(k).alias(f"_k_{k}") for k in keys], "_as_of")
        seen = days.select(*[F.col(k).alias(f"_k_{k}") for k in keys], day.alias("_as_of")).distinct()
        drop = drop.unionByName(join_on(none, seen, [*[f"_k_{k}" for k in keys], "_as_of"], "left_semi").select(*id_cols))
    return join_on(df, drop.distinct(), list(id_cols), "left_anti")
