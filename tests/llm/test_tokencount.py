import random
import unicodedata

import pytest
from cases import awkward, none
from pyspark.sql import functions as F

from gazette.llm import tokencount

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def counter():
    return tokencount.PrefixCounter(PATH)


@pytest.fixture(scope="module")
def texts(counter):
    rng = random.Random(13)
    letters = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
    pieces = list(counter.score)
    out = ["", None, " ", "Hello  world", "a\nb\tc ", "<s>x</s><unk><0x0A>", "é▁x", "ﬁ Ⅳ", "\x00a", "日本語😀", "a" * 500, "   trailing   "]
    out += [" " * n + x + " " * m for n in (1, 2, 15, 16, 17, 33, 40) for m in (0, 1, 5) for x in ("", "a", "\n", "the")]
    out += ["".join(rng.choices(letters, k=25)) for _ in range(100)]
    out += ["".join(rng.choices("abcdefgh ing'tion,.!19  \n", k=120)) for _ in range(100)]
    out += ["".join(rng.choices(pieces, k=25)).replace("▁", " ") for _ in range(400)]
    return out + ["".join(rng.choices("-=_*#/ \n", k=60)) for _ in range(60)]


def test_counts_equal_the_librarys(counter, library, texts):
    assert [counter.count(t) for t in texts] == [len(library.encode(t or "")) for t in texts]


def test_every_prefix_and_every_budget(counter, library, texts):
    for t in texts[::9]:
        want = [len(library.encode((t or "")[:i])) for i in range(len(t or "") + 1)]
        assert counter.prefixes(t).tolist() == want, t
        for budget in range(0, want[-1] + 2):
            best = max(i for i, n in enumerate(want) if n <= budget)
            assert counter.fit([t], [budget]) == [(want[-1], best, want[best])], (t, budget)


def test_stretch_without_blanks_is_counted_whole(counter, library):
    long = "".join(random.Random(2).choices("abcdeinorst", k=30_000))
    assert counter.count(long) == len(library.encode(long))


def test_forgetting_changes_nothing(monkeypatch, library, texts):
    for name in ("REMEMBERED_STRETCHES", "REMEMBERED_LENGTH", "REMEMBERED_PAIRS"):
        monkeypatch.setattr(tokencount, name, 200 if name == "REMEMBERED_PAIRS" else 3)
    small = tokencount.PrefixCounter(PATH)
    for t in texts[:150]:
        assert small.count(t) == len(library.encode(t or ""))
    assert [r[0] for r in small.fit(texts, [None] * len(texts))] == [len(library.encode(t or "")) for t in texts]
    assert len(small.totals) <= 3


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_digests_of_awkward_rows(spark, library):
    docs = awkward(spark)
    got = tokencount.digests(docs, PATH, limit=50)
    assert got.columns[:4] == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = []
    for r in docs.collect():
        n = len(library.encode(r.text or ""))
        fits = min(len(r.text or ""), 50 * 16)  # no piece is longer
        while len(library.encode((r.text or "")[:fits])) > 50:
            fits -= 1
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 50, fits, len(library.encode((r.text or "")[:fits]))))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert tokencount.digests(none(spark), PATH).count() == 0


def test_stored_tables_answer_without_encoding(spark, library):
    docs = awkward(spark).where("length(text) < 5000 OR text IS NULL")
    stored = tokencount.prefix_counts(docs, PATH)
    assert set(stored.columns) == {*docs.columns, "prefix_tokens"}
    asked = stored.select(
        "text",
        tokencount.tokens_of_first(F.col("prefix_tokens"), F.lit(33)).alias("first"),
        tokencount.longest_within(F.col("prefix_tokens"), F.lit(20)).alias("fits"),
        tokencount.longest_within(F.col("prefix_tokens"), F.lit(None).cast("int")).alias("unknown"),
    )
    for r in asked.collect():
        text = r.text or ""
        assert r.first == len(library.encode(text[:33])) and r.unknown is None
        assert r.fits == max(i for i in range(len(text) + 1) if len(library.encode(text[:i])) <= 20)


def test_budget_column_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "one two three four", 2, 9), (2, "one two", None, 9), (3, None, 0, 9)], "doc_id long, text string, budget int, n_tokens int")
    got = {r.doc_id: r for r in tokencount.counts(docs, PATH, F.col("budget")).collect()}
    assert set(got[1].asDict()) == {"doc_id", "text", "budget", "n_tokens", "fit_chars", "fit_tokens"}
    assert (got[1].n_tokens, got[1].fit_chars, got[1].fit_tokens) == (4, 7, 2)
    assert (got[2].n_tokens, got[2].fit_chars, got[3].n_tokens, got[3].fit_chars) == (2, None, 0, 0)


def test_other_kinds_of_model_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="supported kind"):
        tokencount.PrefixCounter(str(tmp_path / "other.model"))
