"""Quality classifier with hierarchical empirical Bayes over sites.

Evidence of a document: a logistic regression over the whole text's shape (byte
frequencies, word lengths, repeated and adjacent equal words), fitted on a
bounded, seeded sample of labelled documents.

Evidence of its site: every document's outcome (its label where there is one,
else the classifier's probability) is summed by path and by host.  The global
rate is the prior of the hosts, each host's posterior mean is the prior of its
paths; the priors' strengths come from the spread between hosts and between
paths (method of moments), so a sparse site shrinks to its parent.

The posterior adds both in log odds: the document's own log odds plus the path
posterior's log odds over the global rate's.  Documents below ``LEAST_POSTERIOR``
are rejected.

Defined cases: a NULL or empty text says nothing (its own log odds are the global
rate's) and is judged by its site alone; NULL host or path is a site of its own;
without labels of both classes all evidence is neutral and every document is
kept; labels that are neither 0 nor 1 and labels of a NULL ``doc_id`` are
ignored, of repeated labels the mean counts; repeated rows are judged alike, and of
several texts of one ``doc_id`` the classifier is fitted on one.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import broadcast_if_small, group_key, materialize, text_batches
from gazette.llm.sampling import sample_per_label

#: Labelled documents of each class that the classifier is fitted on at most.
PER_CLASS = 3000
#: Documents of a lower posterior probability of being good are rejected.
LEAST_POSTERIOR = 0.4
#: Bounds of a prior's strength, in documents.
WEAKEST, STRONGEST = 2.0, 1000.0
#: Log odds that a document's own evidence can carry at most, either way.
MOST_EVIDENCE = 12.0
FEATURES = 256 + 6


def shape(text: str) -> np.ndarray:
    """Byte frequencies of a whole text and six figures of its words."""
    raw = text.encode()
    words = raw.split()
    out = np.zeros(FEATURES, np.float32)
    out[:256] = np.sqrt(np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / max(1, len(raw)))
    n = len(words)
    if n:
        distinct = len(set(words))
        same = sum(map(bytes.__eq__, words[1:], words[:-1]))
        sizes = np.fromiter(map(len, words), np.float32, n)
        upper = sum(c for c in np.bincount(np.frombuffer(raw, np.uint8), minlength=256)[65:91])
        out[256:] = np.log1p(n), np.log(distinct) - 0.7 * np.log(n), same / n, sizes.mean() / 10, sizes.std() / 10, upper / len(raw)
    return out


class Logistic:
    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, bias: float):
        self.mean, self.scale, self.weights, self.bias = mean, scale, weights, bias

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.clip(z.astype(np.float64) @ self.weights + self.bias, -MOST_EVIDENCE, MOST_EVIDENCE)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> Logistic:
    """Logistic regression by iteratively reweighted least squares."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = np.hstack([np.clip((x - mean) / scale, -8, 8).astype(np.float64), np.ones((len(x), 1))])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        v = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((z * v[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(mean, scale, w[:-1], float(w[-1]))


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [shape(t).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("good"), pa.array(rows, pa.binary())], names=["doc_id", "good", "x"])


def outcomes(labels: DataFrame, quality: str = "quality") -> DataFrame:
    """``_id, good``: one labelled outcome of each document, 0 to 1."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(quality).isin(0, 1))
    return usable.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.avg(quality).alias("good"))


def fit_on(docs: DataFrame, known: DataFrame, per_class: int = PER_CLASS) -> Logistic | None:
    """Fit on a bounded sample of labelled documents; None without both classes."""
    text_batches(docs.sparkSession)
    texts = docs.where(F.col("text") != "").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ids = docs.select(F.col("doc_id").cast("long")).distinct()
    there = known.withColumn("good", F.round("good")).join(ids, F.col("_id") == F.col("doc_id"))
    sample = materialize(sample_per_label(there.select("doc_id", "good"), "good", per_class, "quality").select(F.col("doc_id").alias("_id"), "good"))
    rows = texts.join(broadcast_if_small(sample, sample.count()), F.col("doc_id") == F.col("_id"))
    shapes = rows.select("doc_id", "good", "text").mapInArrow(_shapes, "doc_id long, good double, x binary")
    found = shapes.groupBy("doc_id").agg(F.min("good").alias("good"), F.min("x").alias("x")).toPandas()  # one row of each document
    found = found.sort_values("doc_id", ignore_index=True)
    if found["good"].nunique() < 2:
        return None
    return fit(np.frombuffer(b"".join(found["x"]), np.float32).reshape(-1, FEATURES), found["good"].to_numpy(np.float64))


def evidence(docs: DataFrame, model: Logistic | None) -> DataFrame:
    """``docs`` (``doc_id``, ``text`` and other columns) with ``log_odds`` in place of the text; NULL: none."""
    text_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != "text"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            own: list = [None] * len(texts)
            some = [i for i, t in enumerate(texts) if t] if shared.value else []
            if some:
                for i, value in zip(some, shared.value.log_odds(np.stack([shape(texts[i]) for i in some]))):
                    own[i] = float(value)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(own, pa.float64())], names=[*kept, "log_odds"])

    schema = docs.select(*kept).schema.add("log_odds", "double")
    return docs.select(*kept, F.col("text").cast("string")).mapInArrow(run, schema)


def _logit(p: Column) -> Column:
    inside = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(inside / (1 - inside))


def _strength(mean: float, spread: float) -> float:
    """Documents that a beta prior of this mean and variance is worth."""
    return float(min(STRONGEST, max(WEAKEST, mean * (1 - mean) / spread - 1))) if spread > 0 else STRONGEST


def site_posteriors(judged: DataFrame) -> tuple[DataFrame, float]:
    """``_host, _path, site_good`` of every path and the global rate, from rows of
    ``_host, _path, outcome``.  One aggregation by path; hosts and the globe are sums of it."""
    paths = materialize(judged.groupBy("_host", "_path").agg(F.count("outcome").alias("n"), F.sum("outcome").alias("good")))
    hosts = materialize(paths.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).head()
    rate = (total["good"] or 0) / total["n"] if total["n"] else 0.5

    def spread(sites: DataFrame, mean: Column) -> float:
        """Variance of the sites' rates around ``mean``, without what chance alone adds."""
        own = F.col("good") / F.col("n")
        seen = F.sum(F.col("n") * F.pow(own - mean, 2)) / F.sum("n")
        chance = F.sum(mean * (1 - mean)) / F.sum("n")
        value = sites.where("n > 1").agg((seen - chance).alias("v")).head()["v"]
        return float(value or 0)

    host_strength = _strength(rate, spread(hosts, F.lit(rate)))
    shrunk = hosts.select("_host", ((F.lit(rate * host_strength) + F.coalesce("good", F.lit(0.0))) / (F.lit(host_strength) + F.col("n"))).alias("host_good"))
    placed = paths.join(shrunk, "_host")
    path_strength = _strength(rate, spread(placed, F.col("host_good")))
    site = (F.col("host_good") * path_strength + F.coalesce("good", F.lit(0.0))) / (F.lit(path_strength) + F.col("n"))
    return placed.select("_host", "_path", "host_good", site.alias("site_good")), rate


def judge(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id, source, doc_log_odds, host_good, site_good, posterior, kept`` of every row.

    ``host`` and ``path`` name a document's site; by default its ``source`` and the
    ``lang`` section of that source.
    """
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    known = materialize(outcomes(labels))
    model = fit_on(docs, known, per_class)
    slim = docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), group_key(host).alias("_host"), group_key(path).alias("_path"), "text"
    )
    scored = materialize(evidence(slim, model))
    own = 1 / (1 + F.exp(-F.col("log_odds")))
    outcome = scored.join(known, F.col("doc_id") == F.col("_id"), "left").select("_host", "_path", F.coalesce("good", own).alias("outcome"))
    sites, rate = site_posteriors(outcome)
    sites = materialize(sites).withColumnsRenamed({"_host": "_h", "_path": "_p"})
    placed = scored.join(broadcast_if_small(sites, sites.count()), (F.col("_host") == F.col("_h")) & (F.col("_path") == F.col("_p")))
    base = _logit(F.lit(rate))
    total = F.coalesce("log_odds", base) + _logit(F.col("site_good")) - base
    posterior = 1 / (1 + F.exp(-total)) if model else F.lit(1.0)
    return placed.select("doc_id", "source", F.col("log_odds").alias("doc_log_odds"), "host_good", "site_good", posterior.alias("posterior")).withColumn(
        "kept", F.col("posterior") >= LEAST_POSTERIOR
    )
