from cases import awkward, awkward_rows, none

import corpus_pipeline
from gazette.llm import langid, mixing, quality, superminhash

SF001 = "/root/testdata/sf0.001"
NAMES = ["quality", "language", "near_duplicates", "mix", "tokens"]


def test_stages_on_awkward_rows_and_empty_tables(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    for docs in (awkward(spark), none(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF001)
            if name != "tokens":
                assert out.schema.names == docs.schema.names, name
                assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
            n = out.count()
            assert n if docs.count() else not n, name


def test_decisions_take_effect(spark):
    docs = awkward(spark)
    clean = corpus_pipeline.known_language(spark, docs, SF001)
    ids = {r.doc_id for r in clean.collect()}
    assert not ids & {4, 5, 6, 12} and {1, 2, 3, 7, 8, 9, 11} <= ids
    once = [r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, SF001).collect()]
    assert 1 in once and 2 not in once and 3 not in once and once.count(11) == 1 and once.count(None) == 2
    taken = {r.doc_id: (r["size"], r.taken) for r in mixing.mix(docs).collect() if r.doc_id is not None}
    mixed = [r.doc_id for r in corpus_pipeline.mixed(spark, docs, SF001).collect()]
    for i, (size, words) in taken.items():
        if i != 11:
            assert mixed.count(i) == (int(words / size + 0.5) if size else 0)


def test_run_equals_the_operators_one_after_the_other(spark):
    from gazette.sources.tables import read_table

    docs, labels = read_table(spark, SF001, "documents"), read_table(spark, SF001, "labels")
    out = {r.kept for r in quality.judge(docs, labels).collect()}
    assert out == {True, False}
    good = {r.doc_id for r in quality.judge(docs, labels).where("kept").collect()}
    docs = docs.where(docs.doc_id.isin(*good))
    from pyspark.sql import functions as F

    known = {r.doc_id for r in langid.predict(docs, langid.fit_on(docs, F.lit(True)), ["doc_id"]).where("NOT rejected").collect()}
    docs = docs.where(docs.doc_id.isin(*known))
    once = {r.doc_id for r in superminhash.near_duplicates(docs).where("kept").collect()}
    docs = docs.where(docs.doc_id.isin(*once))
    want = sorted(r.doc_id for r in mixing.mix(docs).where("size > 0").collect() for _ in range(int(r.taken / r["size"] + 0.5)))
    got = corpus_pipeline.run(spark, SF001)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    rows = got.collect()
    assert sorted(r.doc_id for r in rows) == want and all(r.n_tokens == len(r.ids) for r in rows)
    assert len(awkward_rows()) == 35
