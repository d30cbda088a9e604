import random
import zlib

import numpy as np
import pytest
from cases import awkward, none

from gazette.llm import mixing, sharding


def awarded_singly(votes, seats):
    """Sainte-Lague seat by seat: the highest quotient wins, ties go to the first."""
    won = np.zeros(len(votes), int)
    for _ in range(seats):
        won[np.argmax(votes / (2 * won + 1))] += 1
    return won


def test_divisor_search_equals_awarding_singly():
    rng = random.Random(2)
    for _ in range(200):
        votes = np.array([rng.choice([0, 1.5, 2, 7, 7.25, 100, 31000]) for _ in range(rng.randrange(1, 8))], float)
        seats = rng.randrange(0, 70)
        if not votes.any():
            assert not mixing.sainte_lague(votes, seats).any()
            continue
        mine, theirs = mixing.sainte_lague(votes, seats), awarded_singly(votes, seats)
        assert mine.sum() == seats
        # equal quotients may go to either party: the multiset of last winning quotients agrees
        last = lambda w: sorted(v / (2 * n - 1) for v, n in zip(votes, w) if n)
        assert np.allclose(last(mine), last(theirs)) or np.isclose(min(last(mine)), min(last(theirs)))


def test_shards_have_integer_quotas_that_add_up():
    targets = np.array([1000.0, 333.3, 20.7, 0.0])
    quotas = mixing.shard_quotas(targets, shards=16, block=4)
    assert quotas.shape == (16, 4) and (quotas >= 0).all()
    assert (quotas.sum(axis=0) == mixing.sainte_lague(targets, round(targets.sum() / 4))).all()
    per_shard = quotas.sum(axis=1)
    assert per_shard.max() - per_shard.min() <= 1


def test_targets_stop_at_three_times_the_size():
    got = mixing.word_targets([10, 1000, 500, 0], [5, 2, 1, 5])
    assert np.allclose(got, [30, 1480 * 2 / 3, 1480 / 3, 0]) and np.isclose(got.sum(), 1510)
    assert np.allclose(mixing.word_targets([1, 1, 100], [5, 2, 1]), [3, 3, 96])
    assert len(mixing.word_targets([], [])) == 0


def brute_targets(sizes, weights, most=3):
    """Shares by weight; sources above their stop are set to it one by one, and the rest shared anew."""
    fixed = {}
    while True:
        open_ = [i for i in range(len(sizes)) if i not in fixed]
        rest = sum(sizes) - sum(fixed.values())
        share = {i: rest * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = [i for i in open_ if share[i] > most * sizes[i]]
        if not over:
            return [fixed.get(i, share.get(i)) for i in range(len(sizes))]
        fixed[over[0]] = most * sizes[over[0]]


def brute_mix(rows, weights=(5, 2, 1), block=16, shards=16, seed="mix"):
    """Awards blocks one by one, deals them to the shards in that order, lays every word of each source
    on a line and takes the words of its blocks one by one."""
    import xxhash

    sizes = {}
    for doc, source, size, u in rows:
        sizes[source] = sizes.get(source, 0) + size
    keys = sorted(sizes, key=lambda k: (k[0] == "0", k))
    targets = brute_targets([sizes[k] for k in keys], [weights[i % 3] for i in range(len(keys))])
    seats = round(sum(targets) / block)
    won, shard_of = [0] * len(keys), [[] for _ in keys]  # shard of each block of a source
    for seat in range(seats):
        i = max(range(len(keys)), key=lambda i: (targets[i] / (2 * won[i] + 1), -i))
        won[i] += 1
        shard_of[i].append(next(k for k in range(shards) if seat < seats * (k + 1) // shards))
    taken = []
    for i, key in enumerate(keys):
        total = sizes[key]
        line = [n for n, r in enumerate(rows) if r[1] == key]
        line.sort(key=lambda n: (rows[n][3], rows[n][0] is not None, rows[n][0] or 0, rows[n][2]))
        of_word = [n for n in line for _ in range(rows[n][2])]
        count = {n: [0] * shards for n in line}
        words = min(won[i] * block, 3 * total)
        start = xxhash.xxh64_intdigest(f"{seed}:{key}") % max(1, -(-total // block)) * block
        for k in range(words):
            whole = words // total * total  # whole passes first, then the run of blocks from the seeded start
            place = k % total if k < whole else (start + k - whole) % total
            count[of_word[place]][shard_of[i][k // block]] += 1
        taken += [(rows[n][0], rows[n][2], total, targets[i], sum(count[n]), count[n]) for n in line]
    return taken


def test_mix_equals_brute_force(spark):
    from pyspark.sql import functions as F

    from gazette.llm.common import group_key, unit

    df = awkward(spark).drop("size")
    rows = [
        (r.doc_id, r.k, r.s, r.u)
        for r in df.select("doc_id", group_key(F.col("source")).alias("k"), mixing.n_words(F.col("text")).alias("s"))
        .withColumn("u", unit(F.xxhash64(F.lit("mix"), F.col("doc_id"), F.col("s"))))
        .collect()
    ]
    got = mixing.mix(awkward(spark))
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken", "shard_words"]
    key = lambda t: (t[0] is None, t[0] or 0, *t[1:])
    first = sorted((tuple(r) for r in got.collect()), key=key)
    want = sorted(brute_mix(rows), key=key)
    assert [(t[0], t[1], t[2], *t[4:]) for t in first] == [(t[0], t[1], t[2], *t[4:]) for t in want]
    by_shard = [sum(t[5][k] for t in first) for k in range(16)]
    assert max(by_shard) - min(by_shard) <= 16 * 3  # blocks of 16 words, short ones at sources' ends
    assert np.allclose([t[3] for t in first], [t[3] for t in want])
    assert all(t[4] <= 3 * t[1] for t in first)
    assert first == sorted((tuple(r) for r in mixing.mix(awkward(spark)).collect()), key=key)
    assert mixing.mix(none(spark)).count() == 0


def test_a_mix_of_too_many_sources_is_refused(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 2)
    with pytest.raises(ValueError, match="more than 2 sources"):
        mixing.mix(awkward(spark))


def test_shards_are_even_gapless_and_proportional(spark):
    df = awkward(spark)
    got = sharding.shard(df)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows, given = got.collect(), df.collect()
    want = sorted((r.doc_id or -1, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in given)
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in rows) == want
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(slots.get(s, [])) for s in range(16)]
    assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sorted(map(str, rows)) == sorted(map(str, sharding.shard(df).collect()))
    assert sharding.shard(none(spark)).count() == 0


def test_every_shard_matches_the_mixture(spark):
    rows = [(i, f"text {i}", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(3200)] + [(5000 + i, "x", f"single{i}") for i in range(160)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    of = {i: s for i, _, s in rows}
    hot, single = [0] * 16, [0] * 16
    for r in got:
        hot[r.shard] += of[r.doc_id] == "hot"
        single[r.shard] += of[r.doc_id].startswith("single")
    assert max(hot) - min(hot) <= 8 and max(single) <= 30 and min(single) >= 1


def test_shards_equal_a_plain_sort_by_fractional_rank(spark):
    from pyspark.sql import functions as F

    from gazette.llm.common import group_key, unit

    more = [(2000 + i, f"text {i % 400}", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(1500)]
    df = awkward(spark).select("doc_id", "text", "source").unionByName(spark.createDataFrame(more, "doc_id long, text string, source string"))
    text = F.coalesce("text", F.lit(""))
    given = df.select("doc_id", group_key(F.col("source")).alias("key"), (F.octet_length(text) + 1).alias("bytes"), F.crc32(text).alias("crc"))
    given = given.withColumns({"u": unit(F.xxhash64(F.lit("shard"), F.col("doc_id"), F.col("crc"))), "off": unit(F.xxhash64(F.lit("shard"), F.col("key")))}).collect()
    ties = lambda r: (r.doc_id is not None, r.doc_id or 0, r.crc, r.bytes)
    at = []
    for key in {r.key for r in given}:
        own = sorted((r for r in given if r.key == key), key=lambda r: (r.u, *ties(r)))
        at += [((rank + r.off) / len(own), r) for rank, r in enumerate(own)]
    at.sort(key=lambda x: (x[0], x[1].key, *ties(x[1])))
    want = []
    for position, (_, r) in enumerate(at):
        shard = position * 16 // len(at)
        want.append((r.doc_id, r.bytes, r.crc, shard, position - -(-shard * len(at) // 16)))
    got = [(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in sharding.shard(df).collect()]
    key = lambda t: (t[0] is None, t[0] or 0, *t[1:])
    assert sorted(got, key=key) == sorted(want, key=key)
