import numpy as np

from gazette.llm import multiindex as M

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute_force(rows, least=0.93):
    usable = {}
    for at, (i, label, v) in enumerate(rows):
        if i is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, np.float32).astype(np.float64)
        usable[at] = (i, label, x / np.linalg.norm(x))
    links = {at: set() for at in range(len(rows))}
    for a, (_, la, x) in usable.items():
        for b, (_, lb, y) in usable.items():
            if a != b and la == lb and len(x) == len(y) and x @ y >= least:
                links[a].add(b)
    out = []
    for at, (i, _, _) in enumerate(rows):
        seen, todo = {at}, [at]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        root = None if i is None else min(rows[k][0] for k in seen)
        out.append((i, len(links[at]), root, i is None or root == i))
    return sorted(out, key=str)


def families(seed, n_families, size, spread, dimensions=16, labels=3):
    rng = np.random.default_rng(seed)
    rows = []
    for f in range(n_families):
        centre = rng.normal(size=dimensions)
        for k in range(size):
            v = centre + spread * rng.normal(size=dimensions) * np.linalg.norm(centre) / np.sqrt(dimensions)
            rows.append((len(rows) + 10, int(rng.integers(labels)), [float(x) for x in np.float32(v * rng.uniform(0.1, 9))]))
    return rows


def test_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(M, "HOME_ROWS", 16)
    monkeypatch.setattr(M, "VISITOR_ROWS", 16)
    rows = families(1, 12, 25, 0.25) + [(5000 + i, 1, [1.0] + [0.0] * 15) for i in range(40)] + [(6000, 1, [-1.0] + [0.0] * 15), (6001, 1, [2.0] + [0.0] * 15)]
    for recall in (1.0, M.RECALL):
        got = M.near_duplicates(spark.createDataFrame(rows, SCHEMA), recall=recall)
        assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute_force(rows)


def test_recall_on_fine_codebooks(spark, monkeypatch):
    monkeypatch.setattr(M, "ROWS_PER_CELL", 4)
    rows = families(2, 60, 12, 0.3, dimensions=32, labels=1)
    want = {r[0]: r[1] for r in brute_force(rows)}
    got = {r.vec_id: r.n_links for r in M.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(got.values()) >= 0.99 * sum(want.values()) and all(got[i] <= want[i] for i in want)


def test_visits_meet_each_pair_of_cells_once():
    x = np.random.default_rng(3).normal(size=(200, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    grid = M.Grid((x[:5, :4].copy(), x[5:9, 4:].copy()), 100.0)  # a bound that leaves nothing out
    home, row, cell = grid.visits(x)
    visited = set(zip(row.tolist(), cell.tolist()))
    for a in range(0, 200, 7):
        for b in range(0, 200, 11):
            met = ((a, home[b]) in visited) + ((b, home[a]) in visited)
            assert met == (2 if home[a] == home[b] else 1)


def test_awkward_rows(spark):
    e = [1.0, 0.0, 2.0]
    rows = [(1, 1, e), (2, 1, e), (2, 1, e), (3, None, e), (4, 1, None), (5, 1, []), (6, 1, [0.0, 0.0, 0.0]), (7, 1, [1.0, None, 2.0]), (8, 1, [float("nan"), 1.0, 1.0])]
    rows += [(9, 1, [float("inf"), 1.0, 1.0]), (None, 1, e), (10, 1, [1.0, 0.0]), (11, 2, e), (12, 1, [1.0, -0.0, 2.0]), (13, 1, [-1.0, 0.0, -2.0])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "'k' AS key", "2 AS n", "true AS home", "3 AS cell")
    assert sorted((tuple(r) for r in M.near_duplicates(df).collect()), key=str) == brute_force(rows)
    assert M.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_link_is_lost_on_low_dimensional_vectors(spark, monkeypatch):
    monkeypatch.setattr(M, "ROWS_PER_CELL", 1)
    rng = np.random.default_rng(5)
    basis = rng.normal(size=(4, 64))
    rows = [(i, 1, [float(x) for x in np.float32(rng.normal(size=4) @ basis)]) for i in range(1500)]  # rank 4 of 64
    want = brute_force(rows)
    got = sorted((tuple(r) for r in M.near_duplicates(spark.createDataFrame(rows, SCHEMA), recall=1.0).collect()), key=str)
    assert sum(r[1] for r in want) > 5000 and got == want


def spread_by(kind, rng, n, dimensions=64):
    if kind == "isotropic":
        return rng.normal(size=(n, dimensions))
    if kind == "falling":  # a 1/k spectrum
        return rng.normal(size=(n, dimensions)) / np.arange(1, dimensions + 1)
    if kind == "rank 4":
        return rng.normal(size=(n, 4)) @ rng.normal(size=(4, dimensions))
    centres = rng.normal(size=(200, dimensions))
    return centres[rng.integers(0, 200, n)] + 0.2 * rng.normal(size=(n, dimensions))


def test_the_measured_bound_prunes_and_keeps_its_recall():
    """Pairs found by the visits of a fine grid (64 codes a half), and the share of cells visited."""
    for kind in ("isotropic", "falling", "rank 4", "clustered"):
        rng = np.random.default_rng(7)
        x = spread_by(kind, rng, 6000)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        offsets = spread_by(kind, rng, 3000)
        y = x[:3000] + offsets * (0.25 / np.linalg.norm(offsets, axis=1, keepdims=True))  # near copies, off by the same spread
        x = np.vstack([x, y / np.linalg.norm(y, axis=1, keepdims=True)])
        grid = M.fit([v.tobytes() for v in rng.permutation(x)], 64, 0.93, M.RECALL)[64 * 8]
        home, row, cell = grid.visits(x)
        visited = set(zip(row.tolist(), cell.tolist()))
        a, b = np.nonzero(np.triu(x @ x.T >= 0.93, 1))
        found = np.mean([(i, home[j]) in visited or (j, home[i]) in visited for i, j in zip(a[:60_000].tolist(), b[:60_000].tolist())])
        share = len(row) / len(x) / 4096
        print(f"{kind}: recall {found:.5f} of {len(a)} pairs, {share:.2%} of the cells visited")
        assert len(a) > 1000 and found >= 0.99
        assert share <= 0.05 or kind not in ("isotropic", "clustered")
