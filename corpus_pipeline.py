"""A training-data pipeline over ``documents``: quality, language, near-duplicates, mix, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last
return the columns of ``docs``.  ``run`` writes each stage's rows below the shared
checkpoint folder and gives them to the next.

Defined cases, of all stages: texts are read whole, whatever their length; extra columns pass
through all stages but the last, also those that are named like a stage's own; an empty table
gives an empty one.
  quality     a NULL or empty text is judged by its site alone; a NULL ``doc_id`` has no label;
              all rows of a ``doc_id`` go if none of them is kept.
  language    a NULL text, or one without letters, goes; repeated rows are each judged.
  near-dups   texts without words are nobody's copy; of the rows of one ``doc_id`` the least (by
              all columns) stays; rows of a NULL ``doc_id`` all stay; ties do not arise.
  mix         documents without words are not taken; a NULL ``source`` is a source of its own;
              rows of one ``doc_id`` (after the stage before, at most NULL ones) repeat alike.
  tokens      a NULL or empty text has no tokens; rows may repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm import bpe, langid, mixing, quality, superminhash
from gazette.llm.common import broadcast_if_small, materialize
from gazette.sources.tables import read_table


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows of the given ``_id``; a NULL ``doc_id`` is never dropped."""
    ids = materialize(ids)
    return docs.join(broadcast_if_small(ids, ids.count()), docs["doc_id"] == ids["_id"], "left_anti")


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns of names that clash with none of a stage's own, and those names."""
    names = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects (all rows of the ``doc_id`` rejected)."""
    judged = quality.judge(docs, read_table(spark, sf_dir, "labels"))
    return _without(docs, judged.groupBy(F.col("doc_id").alias("_id")).agg(F.max("kept").alias("kept")).where("NOT kept").select("_id"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that language ID rejects: no letters, or far from every language."""
    model = langid.fit_on(docs, F.lit(True))
    plain, names = _numbered(docs)
    kept = langid.predict(plain, model, text=names["text"]).where("NOT rejected")
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, and one row of each ``doc_id``."""
    found = materialize(superminhash.near_duplicates(docs))
    kept = _without(docs, found.where("NOT kept").select(F.col("doc_id").alias("_id")).distinct())
    again = materialize(found.where("kept AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).count().where("count > 1").select("_id"))
    n = again.count()
    if not n:
        return kept
    several = kept.join(broadcast_if_small(again, n), kept["doc_id"] == again["_id"], "left_semi")
    first = several.groupBy(F.col("doc_id").alias("_g")).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return _without(kept, again).unionByName(first)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop whole documents so that the sources' words come near their targets."""
    taken = mixing.mix(docs).where("size > 0")
    copies = taken.groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.round(F.col("taken") / F.col("size"))).cast("int").alias("_copies"))
    copies = materialize(copies.where("_copies > 0"))
    plain, names = _numbered(docs)
    joined = plain.join(broadcast_if_small(copies, copies.count()), F.col(names["doc_id"]).eqNullSafe(F.col("_id")))
    repeated = joined.select(*names.values(), F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.select(*[F.col(n).alias(c) for c, n in names.items()])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document and digests of its ids and decoded text."""
    import public_tokenizers

    return bpe.digests(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True)


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("mix", mixed),
    ("tokens", tokens),
]

#: The classifiers, the seeded mix and BPE have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
