import hashlib

from cases import LONG, awkward, none, prose
from pyspark.sql import functions as F

from gazette.llm import spotsigs as S


def digits(f):
    return {f[i : i + 8] for i in range(0, len(f), 8)}


def alike(a, b):
    a, b = digits(a), digits(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, got):
    """Digests and likenesses against the definition, on documents in order."""
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    order = sorted(rows, key=key)
    texts = [t or "" for _, t in order]
    assert len(got) == len(rows)
    want = []
    prints = {t: None for t in texts}
    for r in got:
        want.append((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert abs(r.near_edited - alike(r.fingerprint, r.edited_fingerprint)) < 1e-9
    mine = []
    for k, (i, _) in enumerate(order):
        text, after = texts[k], texts[(k + 1) % len(texts)]
        q = len(text) // 4
        mine.append((i, len(text), hashlib.sha256((text[: len(text) - q] + after[:q]).encode()).hexdigest()))
    assert sorted(map(str, mine)) == sorted(str(w[:3]) for w in want)


def test_edited_texts_and_next_documents(spark):
    df = awkward(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    for per_range in (1000, 4):
        seen = S.with_next(df, {"spots": lambda: S.signatures(F.col("text"))}, per_range).collect()
        order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
        want = [(i, t or "", order[(k + 1) % len(order)][1] or "") for k, (i, t) in enumerate(order)]
        assert sorted((str(r.doc_id), r.text, r.next_text) for r in seen) == sorted((str(i), t, n) for i, t, n in want)
    check(rows, S.fingerprints(df).collect())
    assert S.fingerprints(none(spark)).count() == 0
    one = S.fingerprints(df.where("doc_id = 1")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_near_next_is_the_next_fingerprints_likeness(spark):
    rows = [(i, prose(i // 2, 80 + i // 2)) for i in range(30)]
    got = sorted(S.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=lambda r: r.doc_id)
    for k, r in enumerate(got):
        assert abs(r.near_next - alike(r.fingerprint, got[(k + 1) % 30].fingerprint)) < 1e-9
    assert all(got[k].near_next == 1.0 for k in range(0, 30, 2))  # copies


def test_signatures_are_chains_behind_anchors(spark):
    texts = ["The river runs to a stone of paper", "river the of Stone, paper", "the", "stone paper", "one two three four", "", "!!!", LONG]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", S.signatures(F.col("t")).alias("s"))
    got = {r.i: r.s for r in df.collect()}

    def chains(*chain):
        cols = [F.hash(*[F.lit(x) for x in c]) if isinstance(c, tuple) else F.hash(F.lit(c)) for c in chain]
        return sorted(spark.range(1).select(F.array(*cols)).head()[0])

    assert got[0] == chains(("the\x01river", "runs"), ("a\x01stone", "paper"), ("to\x01a", "x"))[0:0] + sorted(chains(("the\x01river", "runs"), ("a\x01stone", "paper"), ("of\x01paper", "")))
    assert got[1] == chains(("of\x01stone", "paper"))
    assert got[2] == chains("the") and got[3] == chains("stone paper") and got[4] == chains("one two three", "two three four")
    assert got[5] == [] and len(got[6]) == 1 and len(got[7]) > 4000


def test_near_pairs_equal_brute_force(spark):
    rows = []
    for family in range(6):
        words = prose(family, 120).split()
        rows += [(len(rows) + k, " ".join(words[: 120 - 6 * k])) for k in range(6)]
    rows += [(900, rows[0][1]), (901, ""), (902, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {r.doc_id: set(r.s) for r in df.select("doc_id", S.signatures(F.coalesce("text", F.lit(""))).alias("s")).collect()}
    members, pairs = S.near_pairs(df, 0.75)
    rep = {r.doc_id: r.rep for r in members.collect()}
    assert rep[900] == rep[0] == 0 and len(rep) == len(rows)
    reps = sorted({r for i, r in rep.items() if sets[i]})
    want = {(a, b) for a in reps for b in reps if a < b and len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b])}
    assert {(r.a, r.b) for r in pairs.collect()} == want and len(want) > 10


def test_stretches_without_anchors_have_signatures(spark):
    body = [f"word{i}" for i in range(400)]
    long, changed = " ".join(body), " ".join(body[:200] + [f"other{i}" for i in range(200)])
    foot = " | ".join(["", "of Stone, paper"])
    few = ["the", "river"] * 3
    texts = [long, long + foot, changed + foot, "ten other words" + foot, " ".join(few + ["to", "be", "or", "not"] * 2), "stone paper the river", "stone the of"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", S.signatures(F.col("t")).alias("s"))
    got = {r.i: set(r.s) for r in df.collect()}
    alike = lambda a, b: len(got[a] & got[b]) / len(got[a] | got[b])
    # a stray anchor adds to the rest of the text and takes nothing from it
    assert len(got[0]) == 398 and len(got[1] - got[0]) <= 4 and got[0] <= got[1]
    assert 0.3 < alike(1, 2) < 0.4 and alike(2, 3) < 0.02
    hashed = {t: spark.range(1).select(F.hash(F.lit(t))).head()[0] for t in ("to be or", "stone paper", "stone the of")}
    assert hashed["stone paper"] in got[5] and got[6] == {hashed["stone the of"]}
    docs = spark.createDataFrame([(1, long + foot), (2, "x")], "doc_id long, text string")
    first = S.fingerprints(docs).orderBy("doc_id").head()
    assert 0.6 < first.near_edited < 0.8  # three quarters of the text stay
