import math
import random
import re
from collections import Counter

import pytest
from cases import awkward, none

from gazette.llm import reversed_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    docs = [(d.doc_id, Counter(terms(d.text))) for d in docs]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    N, L = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    wanted = {}
    for r in items:
        wanted.setdefault(r.item_id, set()).update(terms(r.text))
    out = []
    for item, ts in wanted.items():
        scored = []
        for i, c, n in docs:
            m = 100 - 90 + 90 * n * N // L
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def same(got, want):
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "日本", "O'Neil", "A1", "a1", "x_y", "É", "é"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(rng.choices(words, weights, k=rng.randint(1, 80))) for _ in range(300)] + [None, "", " ...!", "w3 " * 20_000, "\x00w1\x7fw2{w3"]
    texts += ["w59 w58"] * 30  # a group of copies: ties
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(None if i % 41 == 0 else i, t) for i, t in zip(ids, texts)]
    docs = spark.createDataFrame(rows + rows[:9], "doc_id long, text string").repartition(7)
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(25)] + [(25, "nowhere"), (26, None), (27, "..."), (None, "w5 W6"), (3, "w59"), (28, "w58 w59 W58")]
    return docs, spark.createDataFrame(items, "item_id int, text string")


def test_equals_brute_force(corpus):
    docs, items = corpus
    same(reversed_search.search(docs, items), brute(docs.collect(), items.collect()))
    same(reversed_search.search(docs, items, k=3), brute(docs.collect(), items.collect(), 3))


def test_blocks_of_items_and_small_batches_change_nothing(corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(reversed_search, "BLOCK_POSTINGS", 40)
    monkeypatch.setattr(reversed_search, "BATCH_DOCS", 5)
    monkeypatch.setattr(reversed_search, "MERGE_GROUPS", 3)
    pairs = reversed_search._item_terms(items, "item_id", "text")
    blocks = [b.collect() for b in reversed_search._blocks(pairs)]
    assert len(blocks) > 3 and all(len(b) <= 40 for b in blocks) and sum(map(len, blocks)) == pairs.count()
    same(reversed_search.search(docs, items), brute(docs.collect(), items.collect()))


def test_awkward_and_empty_tables(spark, corpus):
    docs, items = awkward(spark), spark.createDataFrame([("a", "the river ONE w12", 1), ("b", "日本語 12345", 2)], "item_id string, text string, doc_id int")
    same(reversed_search.search(docs, items), brute(docs.collect(), items.collect()))
    assert reversed_search.search(none(spark), items).count() == 0
    assert reversed_search.search(docs, items.where("false")).count() == 0
    assert reversed_search.search(docs, items.selectExpr("item_id", "'!' AS text")).count() == 0
