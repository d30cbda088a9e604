import random
import re
from itertools import permutations

import pytest
from cases import awkward, none

from gazette.llm import filteraudit


def fails_of(text: str) -> set[str]:
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    return {
        name
        for name, bad in {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
        }.items()
        if bad
    }


def brute(docs, labels):
    """Runs every order over the rows, one filter after the other."""
    texts = [(d.doc_id, d.lang or "", d.text or "") for d in docs]
    seen = {}
    for i, _, t in texts:
        if i is not None:
            seen[t] = min(i, seen.get(t, i))
    marks = [{x.doc_id for x in labels if x.doc_id is not None and x.quality == 1}, {x.doc_id for x in labels if x.doc_id is not None and x.toxic == 1}]
    rows = [(i, part, fails_of(t) | ({"E"} if i is not None and i > seen[t] else set())) for i, part, t in texts]
    out, shapley = {}, {}
    for part in {r[1] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[1] == part]
            away = []
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[2]]
                redundant = sum(f in r[2] for r in away)
                left = [r for r in left if f not in r[2]]
                away += gone
                unique = sum(r[1] == part and r[2] == {f} for r in rows)
                out[part, "".join(order), step] = (len(left), len(gone), redundant, unique, *(sum(r[0] in m for r in gone) for m in marks))
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    rows = df.collect()
    assert df.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(got) == len(rows)
    return got


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_every_order_equals_running_it(spark):
    rng = random.Random(5)
    kinds = ["w%d" % i for i in range(400)]
    texts = [None, "", " \t", "A B C", "one & two", "x " * 150, " ".join(kinds[:120]), " ".join(kinds[:120]) + " #", " ".join(kinds[:110]).upper(), " ".join(kinds[:99]), " ".join((kinds[:80] * 2)[:100]), " ".join((kinds[:79] * 2)[:100])]
    texts += [" ".join(rng.choices(kinds, k=rng.randint(80, 260))) + rng.choice(["", "|", " A" * 40]) for _ in range(30)]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice(["en", "de", "", None])) for _ in range(250)]
    rows += rows[:20]  # repeated rows: of one id, none is another's repeat
    rows += [(100 + i, texts[6], "fr") for i in range(50)] + [(99, texts[6], "en")]  # a group of copies over two parts
    docs = table(spark, rows)
    labels = spark.createDataFrame([(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(110), *range(0, 110, 3), None]], "doc_id long, quality int, toxic int")
    assert found(filteraudit.audit_texts(docs, labels)) == brute(docs.collect(), labels.collect())


def test_awkward_and_empty_tables(spark):
    docs, labels = awkward(spark), spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    assert found(filteraudit.audit_texts(docs, labels)) == brute(docs.collect(), labels.collect())
    assert found(filteraudit.audit_texts(none(spark), labels)) == {}
    assert found(filteraudit.audit_texts(docs, labels.where("false"))) == brute(docs.collect(), [])


def test_paths_through_the_lattice():
    for n in range(1, 6):
        edges = filteraudit.lattice(n)
        orders = list(permutations(range(n)))
        want = {}
        for order in orders:
            state = 0
            for f in order:
                want[state, f] = want.get((state, f), 0) + 1
                state |= 1 << f
        assert {(s, f): w for s, f, w in edges} == want


def test_other_filters_and_sums(spark):
    """The general form: three filters, a sum of its own, rows of a mask in several pieces."""
    rows = [("p", m, i + 1, m) for m in range(8) for i in range(2)] + [("q", 5, 4, 0)]
    counts = spark.createDataFrame(rows, "part string, mask int, n long, weight long")
    got = {(r.part, r.filter_order, r.step): r for r in filteraudit.audit(counts, ["x", "y", "z"], ["weight"]).collect()}
    assert len(got) == 2 * 6 * 3
    assert (got["q", "xyz", 1].removed, got["q", "zxy", 2].removed, got["q", "zxy", 2].redundant) == (4, 0, 4)
    assert got["p", "xyz", 1].removed == 12 and got["p", "xyz", 1].weight_lost == 2 * (1 + 3 + 5 + 7)
    assert got["p", "xyz", 3].kept == 3 and got["p", "xyz", 1].unique_fails == 3
    assert sum(got["p", "xyz", s].shapley for s in (1, 2, 3)) == 6 * 21  # efficiency: all that any order removes
    with pytest.raises(ValueError, match="at most"):
        filteraudit.audit(counts, list("abcdefgh"), [])
