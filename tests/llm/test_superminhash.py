import random
from itertools import combinations

import numpy as np
from cases import awkward, none, prose

from gazette.llm import superminhash as S
from gazette.llm.components import components


def brute_force(rows: list[tuple[int, str | None]]) -> dict:
    """doc_id -> (set size, smallest linked id), by comparing all pairs of shingle strings."""
    sets = {}
    for i, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lower).split(" ") if w]
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_signature_is_that_of_one_element_after_the_other():
    """Level by level over all elements equals the published loop over elements."""
    rng = np.random.default_rng(5)
    for size in (1, 3, 17, 200):
        values = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        best = np.full(64, np.uint64(2**64 - 1), np.uint64)
        for v in values:
            place = list(range(64))
            for level in range(64):
                draw = int(S._mix(np.array([(int(v) + S._STEP * (level + 1)) % 2**64], np.uint64))[0])
                k = level + ((draw & 0xFFFFFFFF) * (64 - level) >> 32)
                place[level], place[k] = place[k], place[level]
                best[place[level]] = min(best[place[level]], np.uint64((level << 32) | (draw >> 32)))
        got = S.superminhash(values, np.zeros(len(values), np.int64), 1, 64)[0]
        assert (got == best).all()


def test_signature_estimates_similarity():
    rng = np.random.default_rng(7)
    pool = rng.integers(0, 2**63, 1400, dtype=np.uint64)
    a, b = np.sort(pool[:1200]), np.sort(pool[200:])
    both = S.superminhash(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2, 1024)
    assert abs((both[0] == both[1]).mean() - 1000 / 1400) < 0.05


def test_groups_equal_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    rows = []
    for family in range(12):
        words = prose(family, 40 + 10 * family).split()
        for _ in range(10):
            copy = list(words)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows) * 3 + 1, rng.choice([" ", "\n", "\t "]).join(copy).upper() if rng.random() < 0.2 else " ".join(copy)))
    rows += [(9000 + i, t) for i, t in enumerate(["a", "A", "a b", "a\x0bb", "a b c d", "", None, "   ", "a b", "a b c d e", "a b c d e f", "É", "é"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in S.near_duplicates(df, block_rows=7).collect()}
    assert got == brute_force(rows)
    monkeypatch.setattr(S, "BLOCK_SHINGLES", 300)
    monkeypatch.setattr(S, "COMMON_SHINGLE", 3)
    again = {r.doc_id: (r.n_shingles, r.component_id) for r in S.near_duplicates(df).collect()}
    assert again == got


def test_awkward_rows(spark):
    got = S.near_duplicates(awkward(spark))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = got.collect()
    assert len(rows) == awkward(spark).count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (by[1].component_id, by[2].component_id, by[3].component_id) == (1, 1, 1)
    assert (by[1].kept, by[2].kept, by[3].kept) == (True, False, False)
    for i in (4, 5, 6):
        assert (by[i].n_shingles, by[i].component_id, by[i].kept) == (0, i, True)
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)] * 2
    assert [(r.component_id, r.kept) for r in rows if r.doc_id == 11] == [(11, True)] * 2
    assert by[9].n_shingles > 4000


def test_empty_table(spark):
    assert S.near_duplicates(none(spark)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1, 400)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    links = spark.createDataFrame(chain + star + [(5, 5), (2, 1)], "u long, v long")
    got = {r.node: r.root for r in components(links, "u", "v").collect()}
    assert got == {**{i: 1 for i in range(2, 401)}, **{1000 + i: 1000 for i in range(1, 300)}}


def test_a_family_just_below_the_threshold_makes_no_table_of_pairs(spark, monkeypatch):
    """300 documents of common boilerplate (similarity 0.737): nothing links, and few pairs are joined to confirm them."""
    n, common = 300, [f"c{i}" for i in range(304)]
    rows = [(k, " ".join(common + [f"d{k}x{i}" for i in range(53)])) for k in range(n)]
    seen = []
    real = S.confirm
    monkeypatch.setattr(S, "confirm", lambda pairs, docs, percent: seen.append(pairs.count()) or real(pairs, docs, percent))
    got = {r.doc_id: r.component_id for r in S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: k for k in range(n)}
    print(f"{sum(seen)} pairs joined for {n} documents")
    assert sum(seen) < 5 * n


def test_shared_shingles_of_a_block(monkeypatch):
    rng = np.random.default_rng(9)
    pool = rng.integers(0, 2**63, 500, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, rng.integers(1, 400))) for _ in range(70)] + [pool[:1], pool[:1]]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    for common in (2, 8, 32, 100):
        monkeypatch.setattr(S, "COMMON_SHINGLE", common)
        got = S._shared(sets)
        np.fill_diagonal(got, 0)
        assert (got == np.array(want) * (1 - np.eye(len(sets), dtype=int))).all()
