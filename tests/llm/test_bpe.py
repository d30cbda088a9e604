import hashlib
import random
import unicodedata

import pytest
from cases import awkward, none

from gazette.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def test_ids_and_text_equal_the_librarys(library):
    rng = random.Random(11)
    letters = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
    texts = ["", None, "Hello  World's 123 don't I'LL", "a" * 3000, "ab" * 500 + "!" * 77, "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "ΑΣ Σ İ é \x85\xa0　x", "\x00\x1c​"]
    texts += ["".join(rng.choices(letters, k=25)) for _ in range(200)]
    texts += ["".join(rng.choices("abcdefgh ing'tion,.!19", k=200)) for _ in range(100)]
    mine = bpe.WordBpe(PATH)
    ids, counts = mine.encode_batch(texts)
    at = 0
    for text, n in zip(texts, counts):
        got = ids[at : at + n]
        at += n
        want = library.encode(text or "", add_special_tokens=False).ids
        assert got.tolist() == want, text
        assert mine.decode(got) == library.decode(want, skip_special_tokens=False)


def test_digests_of_awkward_rows(spark, library):
    df = awkward(spark)
    got = bpe.digests(df, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def want(r):
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        return r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    key = lambda t: (t[0] is None, t)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(want, df.collect()), key=key)
    assert bpe.digests(none(spark), PATH).count() == 0


def test_other_columns_pass_and_clashing_names_give_way(spark):
    df = awkward(spark)  # has a column "ids" of its own
    coded = bpe.decode(bpe.encode(df, PATH), PATH)
    assert set(coded.columns) == {*df.columns, "decoded"} and coded.schema["ids"].dataType.simpleString() == "array<int>"
    row = spark.createDataFrame([(None,), ([-1, 10**6, 320],)], "ids array<int>")
    assert sorted(r.decoded for r in bpe.decode(row, PATH).collect()) == ["", "a</w>"]


def test_forgetting_words_changes_nothing(monkeypatch):
    texts = [f"word{i} another{i % 3}" for i in range(50)]
    whole = bpe.WordBpe(PATH).encode_batch(texts)[0].tolist()
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 3)
    small = bpe.WordBpe(PATH)
    assert [i for t in texts for i in small.encode_batch([t])[0].tolist()] == whole
