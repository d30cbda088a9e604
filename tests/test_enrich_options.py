import numpy as np
from pyspark.sql import functions as F

from gazette.operators import enrich as en
from gazette.operators.peel import peel_rank

REL = "array<struct<seq:bigint,title:string,link:string,comments_link:string,similarity:double>>"


def test_peel_reverse(spark):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([("d", i, [float(x) for x in rng.normal(size=4)]) for i in range(10)], "digest_id string, seq long, embedding array<double>")
    fwd = [r.seq for r in peel_rank(df).orderBy("div_rank").collect()]
    rev = [r.seq for r in peel_rank(df, reverse=True).orderBy("div_rank").collect()]
    assert rev == fwd[::-1]


def _arts(spark):
    rows = [
        ("d", 1, "A", "http://p/1", "s1", "src", None, [(2, "B", "http://p/2", None, 1.0), (3, "C", "http://missing", None, 1.0)]),
        ("d", 4, "D", "http://missing-main", "", "src", None, []),
    ]
    return spark.createDataFrame(rows, f"digest_id string, seq long, title string, link string, summary string, source string, comments_link string, related {REL}")


def _pages(spark):
    return spark.createDataFrame(
        [("http://p/1", "main text", None), ("http://p/2", "rel text", "http://img/2.png")], "url string, text string, image_url string"
    )


def test_bundle_literal_and_skip(spark):
    lit = {r.seq: r for r in en.attach_content(_arts(spark), _pages(spark)).collect()}
    assert lit[1].bundle == (
        "Main Article from http://p/1:\nmain text\n\n"
        "Related Article from http://p/2:\nrel text\nRelated Article from http://missing:\nNone"
    )
    assert lit[1].image_url == "http://img/2.png"  # no main image: first related image
    assert lit[4].bundle == "Main Article from http://missing-main:\nNone\n\n"
    skip = {r.seq: r.bundle for r in en.attach_content(_arts(spark), _pages(spark), missing="skip").collect()}
    assert skip[1].endswith("rel text") and "missing" not in skip[1].split("\n\n", 1)[1]


def test_generator_hook_isolates_failures(spark):
    arts = en.build_prompts(en.attach_content(_arts(spark), _pages(spark)), "{title}|{content}")

    def gen(prompt):
        if prompt.startswith("D|"):
            raise RuntimeError("quota")
        return prompt.upper()

    out = {r.seq: (r.generated_summary, r.why_care) for r in en.generate(arts, gen).collect()}
    assert out[1][0].startswith("A|MAIN ARTICLE FROM") and out[1][1] == ""
    assert out[4] == ("Error generating summary", "Error generating insights")
    # content falls back to the feed summary only when the bundle is empty
    p = {r.seq: r.prompt for r in arts.collect()}
    assert p[4].startswith("D|Main Article from")


def test_titles_are_encoded_once(spark):
    import tempfile

    from pyspark.sql import functions as F

    from gazette.functions.vectors import EmbeddingStore, embed, hashed_bow_encoder

    path = tempfile.mkdtemp(prefix="gz-store-") + "/s"
    df = spark.createDataFrame([(1, "red stone"), (2, "red stone"), (3, None), (4, ""), (5, "Blue")], "seq long, title string")
    store = EmbeddingStore(path, "bow", hashed_bow_encoder(16))
    first, n = store.embed(df)
    want = {r.seq: r.embedding for r in embed(df, encoder=hashed_bow_encoder(16)).collect()}
    assert n == 3 and {r.seq: r.embedding for r in first.collect()} == want
    assert store.embed(df)[1] == 0  # a second run encodes nothing
    assert store.embed(df.unionByName(spark.createDataFrame([(6, "green")], df.schema)))[1] == 1
    assert EmbeddingStore(path, "other", hashed_bow_encoder(8)).embed(df)[1] == 3  # another model's vectors
    assert store.embed(df.withColumn("embedding", F.lit(1)))[0].count() == 5 and store.embed(df.limit(0))[0].count() == 0


def test_totals_come_with_the_run(spark):
    from gazette.operators.filters import StageTotals, keyword_filter

    df = spark.createDataFrame([("d", i, f"t{i}", "s") for i in range(7)], "digest_id string, seq long, title string, summary string")
    totals = StageTotals()
    kept = totals.watch("keywords", keyword_filter(totals.watch("input", df), ["t1", "t2"]))
    assert kept.count() == 2 and totals.rows() == [("input", 7), ("keywords", 2)]
