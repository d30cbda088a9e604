"""Language ID by nearest centroid over TF-IDF vectors of character n-grams.

A text becomes a vector of hashed three-byte n-grams of its lower-cased letters
(runs of other ASCII characters count as one space), weighted ``log(1 + tf) *
idf`` and scaled to length 1.  Each language is described by several centroids,
found by spherical k-means over its own training vectors; a text gets the
language of the centroid of highest cosine.  A text whose distance from its
nearest centroid goes beyond the distances seen in training is flagged
``rejected``: it keeps its nearest language in ``lang_pred``, a filter drops it.

Document frequencies are counted over all training documents.  The centroids are fitted on
a bounded sample, ``per_language`` documents of each language and ``MOST_TRAINING`` of all;
the model holds ``MOST_CENTROIDS`` x dimensions numbers at most, whatever the corpus' size
and however many languages it names (more than ``MOST_CENTROIDS`` raise).  Every text is
read whole.

Defined cases: NULL texts and texts without a letter give ``und`` with score 0
and are rejected; without any training document every row does; a text with
letters always gets a learned language; ties go to the first language by code
point; repeated rows are each predicted; extra columns are ignored; a NULL
``doc_id`` is never held out and never trained on; of several texts of one
``doc_id`` and language the centroids see one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.llm.common import broadcast_if_small, free_name, materialize, text_batches
from gazette.llm.sampling import sample_per_label

DIMENSIONS = 4096
#: Training documents of each language at most.
PER_LANGUAGE = 600
#: Training documents of all languages together.
MOST_TRAINING = 9_600
CLUSTERS = 4
#: Centroids of all languages together, and so the languages that can be told apart.
MOST_CENTROIDS = 1_600
#: A text is rejected below this share of the least cosine seen in training (one in a thousand left out).
REJECT_SHARE = 0.5
#: A text of fewer n-grams says too little to be far from every language and is not rejected.
LEAST_GRAMS = 20

_LETTER = regex.compile(r"\p{L}")
_LETTERS_ONLY = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_MULTIPLY = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def count_grams(text: str, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Counts of the hashed three-byte n-grams of a whole text."""
    letters = b" ".join(text.lower().encode().translate(_LETTERS_ONLY).split())
    b = np.frombuffer(b" " + letters + b" ", np.uint8).astype(np.uint32)
    h = b[:-2] * _MULTIPLY[0] ^ b[1:-1] * _MULTIPLY[1] ^ b[2:] * _MULTIPLY[2]
    h ^= h >> np.uint32(15)
    return np.bincount((h * _MULTIPLY[0] >> np.uint32(8)) % np.uint32(dimensions), minlength=dimensions)


def _scaled(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(length > 0, length, 1)


def _clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the first vector and the ones farthest from those taken."""
    centres = x[:1]
    while len(centres) < min(k, len(x)):
        far = (x @ centres.T).max(axis=1)
        if far.min() > 1 - 1e-9:
            break
        centres = np.vstack([centres, x[far.argmin()]])
    for _ in range(rounds):
        mine = (x @ centres.T).argmax(axis=1)
        centres = _scaled(np.vstack([x[mine == c].sum(axis=0) if (mine == c).any() else centres[c] for c in range(len(centres))]))
    return centres


@dataclass
class CentroidModel:
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]  # of each centroid
    least: np.ndarray  # least cosine of each centroid

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the nearest centroid, its cosine, and whether the text is rejected."""
        counts = np.stack([count_grams(t, len(self.idf)) for t in texts])
        cosine = _scaled(np.log1p(counts).astype(np.float16) * self.idf).astype(np.float32) @ self.centroids.T
        best = cosine.argmax(axis=1)
        top = cosine[np.arange(len(best)), best]
        return best, np.clip(top.astype(np.float64), 0, 1), (top < self.least[best]) & (counts.sum(axis=1) >= LEAST_GRAMS)


def fit(weights: np.ndarray, languages: list[str], idf: np.ndarray, clusters: int = CLUSTERS) -> CentroidModel:
    """``weights``: log(1 + count) of each n-gram, one row per training text."""
    x = _scaled(weights * idf.astype(np.float32)).astype(np.float32)
    labels = np.array(languages, object)
    clusters = max(1, min(clusters, MOST_CENTROIDS // max(1, len(set(languages)))))
    rows, names, least = [np.zeros((0, weights.shape[1]), np.float32)], [], []
    for name in sorted(set(languages)):
        own = x[labels == name]
        centres = _clusters(own, clusters)
        nearest = (own @ centres.T).max(axis=1)
        rows.append(centres)
        names += [name] * len(centres)
        least += [REJECT_SHARE * float(np.quantile(nearest, 0.001))] * len(centres)
    return CentroidModel(idf, np.vstack(rows).astype(np.float32), names, np.array(least))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each n-gram, summed over the task's rows; under -1 the count of documents."""
    held, n = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            if _LETTER.search(text):
                held += count_grams(text) > 0
                n += 1
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIMENSIONS, dtype=np.int32)), pa.array(np.concatenate([[n], held]))], names=["gram", "n"])


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """The weight of each n-gram by its document frequency over all rows of ``text``: partial sums meet by n-gram."""
    found = texts.select("text").mapInArrow(_frequencies, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(DIMENSIONS + 1, np.int64)
    for r in found:  # one row per n-gram
        counts[r["gram"] + 1] = r["n"]
    return np.log((1 + counts[0]) / (1 + counts[1:])) + 1


def _weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [np.log1p(count_grams(t)).astype(np.float16).tobytes() if _LETTER.search(t) else None for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(rows, pa.binary())], names=["doc_id", "lang", "w"])


def fit_on(docs: DataFrame, train: Column, per_language: int = PER_LANGUAGE) -> CentroidModel:
    """Fit on the rows of ``docs`` that ``train`` selects, the centroids on a bounded sample of them.  The driver
    gets one vector of each document in the sample, not the texts."""
    text_batches(docs.sparkSession)
    usable = docs.where(train & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    usable = usable.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"))
    languages = usable.select("lang").distinct().count()
    if languages > MOST_CENTROIDS:
        raise ValueError(f"{languages} languages; at most {MOST_CENTROIDS} can be told apart")
    per_language = min(per_language, max(1, MOST_TRAINING // max(1, languages)))
    drawn = sample_per_label(usable.select("doc_id", "lang"), "lang", per_language, "langid")
    ids = materialize(drawn.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")))
    rows = usable.join(broadcast_if_small(ids, ids.count()), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")), "left_semi")
    vectors = rows.mapInArrow(_weights, "doc_id long, lang string, w binary").where("w IS NOT NULL")
    sample = vectors.groupBy("doc_id", "lang").agg(F.min("w").alias("w")).toPandas()
    sample = sample.sort_values(["doc_id", "lang"], ignore_index=True)
    weights = np.frombuffer(b"".join(sample["w"]), np.float16).reshape(-1, DIMENSIONS).astype(np.float32)
    return fit(weights, sample["lang"].tolist(), inverse_frequencies(usable))


def predict(docs: DataFrame, model: CentroidModel, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns ``keep`` (all) of ``docs`` with ``lang_pred``, ``score`` and ``rejected``, from the text alone."""
    text_batches(docs.sparkSession)
    kept = [c for c in keep or docs.columns if c not in ("lang_pred", "score", "rejected")]
    string = docs.schema[text].dataType == T.StringType()
    given = text if text in kept and string else free_name(kept, "text")  # a kept text travels once
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x clusters x dimensions numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch.column(given).to_pylist()
            n = len(texts)
            lang, score, rejected = ["und"] * n, np.zeros(n), np.ones(n, bool)
            some = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if m.languages else []
            if some:
                best, top, out = m.predict([texts[i] for i in some])
                score[some], rejected[some] = top, out
                for i, c in zip(some, best):
                    lang[i] = m.languages[c]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                names=[*kept, "lang_pred", "score", "rejected"],
            )

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    schema = T.StructType([*docs.select(*kept).schema.fields, *added])
    extra = [] if given in kept else [F.col(text).cast("string").alias(given)]
    return docs.select(*kept, *extra).mapInArrow(run, schema)


def held_out(doc_id: Column | None = None) -> Column:
    """Whether a document belongs to the fold that training never sees."""
    doc_id = F.col("doc_id") if doc_id is None else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every document, learned on the other folds."""
    model = fit_on(docs, ~held_out(), per_language)
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model, ["doc_id", "held_out"])
