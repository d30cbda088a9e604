from pyspark.sql import functions as F

from gazette.functions.text import INLINE_KEYWORDS, content_key
from gazette.operators import filters as flt
from gazette.plans.stages import Pipeline


def _arts(spark, rows):
    return spark.createDataFrame(rows, "digest_id string, seq long, title string, summary string, source string")


ROWS = [
    ("d", 1, "Rust Release", "compiler news", "a"),
    ("d", 2, "Gardening", "tomatoes and RUST spots", "b"),
    ("d", 3, "Sports", None, "a"),
    ("d", 4, "ÉLAN", "ǅemal", "c"),
]


def test_substring_case_folded_and_null_summary(spark):
    df = _arts(spark, ROWS)
    got = sorted(r.seq for r in flt.keyword_filter(df, ["rust"]).collect())
    assert got == [1, 2]
    assert sorted(r.seq for r in flt.keyword_filter(df, ["port"]).collect()) == [3]


def test_empty_list_keeps_nothing_and_empty_keyword_keeps_all(spark):
    df = _arts(spark, ROWS)
    assert flt.keyword_filter(df, []).count() == 0
    assert flt.keyword_filter(df, [""]).count() == 4
    assert flt.negative_keyword_filter(df, []).count() == 4


def test_negative_is_complement(spark):
    df = _arts(spark, ROWS)
    kws = ["rust", "élan"]
    pos = {r.seq for r in flt.keyword_filter(df, kws).collect()}
    neg = {r.seq for r in flt.negative_keyword_filter(df, kws).collect()}
    assert pos | neg == {1, 2, 3, 4} and not pos & neg


def test_long_keyword_lists(spark):
    df = _arts(spark, ROWS)
    kws = [f"zz{i}" for i in range(INLINE_KEYWORDS + 5)] + ["tomato"]
    assert [r.seq for r in flt.keyword_filter(df, kws).collect()] == [2]
    assert sorted(r.seq for r in flt.negative_keyword_filter(df, kws).collect()) == [1, 3, 4]


def test_matched_keywords_in_configured_order(spark):
    df = _arts(spark, ROWS)
    out = {r.seq: r.m for r in flt.with_matched_keywords(df, ["spots", "RUST", "x"], name="m").collect()}
    assert out[2] == ["spots", "rust"] and out[1] == ["rust"] and out[3] == []


def test_stage_counts_and_chain(spark):
    df = _arts(spark, ROWS)
    counts = {r.stage: r.n_rows for r in flt.stage_counts(df, ["sports"], ["a"]).collect()}
    chained = Pipeline([lambda d: flt.negative_keyword_filter(d, ["sports"]), lambda d: flt.keyword_filter(d, ["a"])]).run(df)
    assert counts == {"input": 4, "negative_keywords": 3, "keywords": chained.count()}


def test_top_n_per_digest(spark):
    df = spark.range(0, 100).select(
        (F.col("id") % 3).cast("string").alias("digest_id"), F.col("id").alias("seq")
    )
    out = flt.top_n(df, 4, rank_col="r").collect()
    assert len(out) == 12
    for d in "012":
        assert sorted(r.seq for r in out if r.digest_id == d) == sorted(range(int(d), 100, 3))[:4]
    assert flt.top_n(df, 0).count() == 0


def test_dry_run_placeholders(spark):
    out = flt.dry_run(_arts(spark, ROWS)).select("generated_summary", "why_care").distinct().collect()
    assert len(out) == 1 and out[0].generated_summary.startswith("Summary not generated")


def test_counts_of_any_chain_of_stages(spark):
    df = _arts(spark, ROWS + [(None, 9, "x", "y", "a")])
    out = flt.count_stages([("input", df), ("rust", flt.keyword_filter(df, ["rust"])), ("none", df.limit(0))])
    got = {(r.digest_id, r.stage): r.n_rows for r in out.collect()}
    assert got == {("d", "input"): 4, ("d", "rust"): 2, ("d", "none"): 0, (None, "input"): 1, (None, "rust"): 0, (None, "none"): 0}


def test_content_key(spark):
    import hashlib

    df = spark.createDataFrame([("u", "x" * 150), ("u", None)], "u string, c string").select(content_key("u", "c").alias("k"))
    assert [r.k for r in df.collect()] == [hashlib.md5(("u" + "x" * 100).encode()).hexdigest(), hashlib.md5(b"u").hexdigest()]
