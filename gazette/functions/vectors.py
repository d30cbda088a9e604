"""Vector helpers: scaling to length 1 and the default title encoder.

Pairwise work goes through block products with numpy, in
:mod:`gazette.operators.simjoin`.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gazette.plans.stored import path_exists, stored


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + x * x))


def normalize_vec(a) -> Column:
    """``a`` scaled to length 1 (NULL for a zero vector); its length is computed once."""
    v = _c(a)
    return F.transform(F.array(norm(v)), lambda n: F.when(n > 0, F.transform(v, lambda x: x / n)))[0]


#: Digits to which cosines and their means are rounded before they are compared.
SIM_DIGITS = 12


def no_rows(columns: Sequence[str]) -> pd.DataFrame:
    """No rows, in a form that converts to columns of any type."""
    return pd.DataFrame({c: np.empty(0, object) for c in columns})


def units_by_width(vectors: pd.Series) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Width → places of the vectors of that width that have a cosine, and these scaled to length 1.

    A missing vector, a zero vector and one with a NULL or non-finite component have none."""
    widths = np.array([-1 if v is None else len(v) for v in vectors], dtype=np.int64)
    out = {}
    for width in np.unique(widths[widths > 0]).tolist():
        at = np.flatnonzero(widths == width)
        m = np.array([np.asarray(v, dtype=np.float64) for v in vectors.iloc[at]])
        with np.errstate(invalid="ignore", over="ignore"):
            n = np.linalg.norm(m, axis=1)
        ok = np.isfinite(n) & (n > 0)
        if ok.any():
            out[width] = at[ok], m[ok] / n[ok, None]
    return out


def stack(series: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a pandas array column → (unit-row matrix, valid mask).

    Zero or missing vectors get a zero row and ``valid=False`` (their cosine is
    undefined and never passes a threshold test).
    """
    vals = list(series.values)
    if not vals:
        return np.zeros((0, 0)), np.zeros(0, dtype=bool)
    dim = next((len(v) for v in vals if v is not None), 0)
    m = np.zeros((len(vals), dim), dtype=np.float64)
    for k, v in enumerate(vals):
        if v is not None and len(v) == dim:
            m[k] = v
    n = np.linalg.norm(m, axis=1)
    valid = n > 0
    m[valid] /= n[valid, None]
    return m, valid


# Fixed value: what stands between tokens (runs of letters, digits and underscores).
TOKEN_SPLIT = r"[^\p{L}\p{N}_]+"


def hashed_bow_encoder(dim: int = 256):
    """Default deterministic title encoder: a hashed bag of words scaled to length 1,
    as a column expression.  A token counts in the place that the first 32 bits of its
    MD5 give.  Plug a pandas UDF of a model in its place for semantic embeddings."""

    def encode(title: Column) -> Column:
        tokens = F.filter(F.split(F.lower(F.coalesce(title, F.lit(""))), TOKEN_SPLIT), lambda t: t != "")
        places = F.transform(tokens, lambda t: F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint") % dim)

        def counted(at: Column) -> Column:
            # places in order: a place's count is the way from its first position to the next place's
            own = F.array_distinct(at)
            first = F.transform(own, lambda p: F.array_position(at, p))
            behind = F.concat(F.slice(first, F.lit(2), F.size(first)), F.array((F.size(at) + 1).cast("bigint")))
            held = F.map_from_arrays(own, F.zip_with(first, behind, lambda f, b: (b - f).cast("double")))
            empty = F.array_repeat(F.lit(0.0), dim)
            dense = F.transform(F.array(held), lambda m: F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.coalesce(F.try_element_at(m, i.cast("bigint")), F.lit(0.0))))[0]
            return F.when(F.size(at) == 0, empty).otherwise(F.transform(F.array(dense), lambda c: normalize_vec(c))[0])

        return F.transform(F.array(F.sort_array(places)), counted)[0]

    return encode


def embed(df, col: str = "title", out: str = "embedding", encoder=None):
    """Attach an embedding column computed once from ``col``."""
    enc = encoder or hashed_bow_encoder()
    return df.withColumn(out, enc(F.col(col)))


class EmbeddingStore:
    """Vectors by content: a table of title hash and vector, so that a title is encoded once, whatever
    the number of runs, digests and days that hold it.

    ``model`` names the encoder; vectors of another one are kept apart.  A run adds the titles that the
    table lacks, in one append; two runs at a time may both add a title, of which one vector counts."""

    KINDS = "model string, title_key string, embedding array<double>"

    def __init__(self, path: str, model: str, encoder=None):
        self.path, self.model, self.encoder = path, model, encoder or hashed_bow_encoder()

    def _known(self, spark) -> DataFrame:
        if not path_exists(spark, self.path):  # no run yet
            return spark.createDataFrame([], self.KINDS)
        return spark.read.schema(self.KINDS).parquet(self.path).filter(F.col("model") == self.model)

    def embed(self, df: DataFrame, col: str = "title", out: str = "embedding") -> tuple[DataFrame, int]:
        """``df`` with the vector ``out`` of ``col``, and how many titles had to be encoded for it."""
        spark, key = df.sparkSession, F.sha2(F.coalesce(F.col(col), F.lit("")), 256)
        # one row per title before anything is joined: a title that many rows hold meets the store once
        titles = df.select(key.alias("title_key"), F.coalesce(F.col(col), F.lit("")).alias("title")).dropDuplicates(["title_key"])
        missing = titles.join(self._known(spark).select("title_key"), "title_key", "left_anti")
        added = Observation()
        new = embed(missing, "title", encoder=self.encoder).select(F.lit(self.model).alias("model"), "title_key", F.col("embedding").cast("array<double>").alias("embedding"))
        stored(new.observe(added, F.count(F.lit(1)).alias("n"))).write.mode("append").parquet(self.path)
        vectors = self._known(spark).groupBy(F.col("title_key").alias("_key")).agg(F.first("embedding").alias(out))
        plain = df.drop(out)
        return plain.join(vectors, key == F.col("_key"), "left").drop("_key"), added.get.get("n", 0)
