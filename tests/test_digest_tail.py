from gazette.functions.vectors import hashed_bow_encoder
from gazette.plans.digest import DigestConfig, rank_and_select
from gazette.plans.stored import new_path


def test_texts_are_read_for_the_selected_rows_only(spark):
    titles = ["the red fox", "the blue whale", "a green tree", "the old stone", "the red fox"]
    rows = [("d", i, t, f"l{i}", f"text {i}", "s", None) for i, t in enumerate(titles)]
    rows.append(("d", 1, "the blue whale", "l1", "secret", "s", None))  # the same key, but for a word not wanted
    schema = "digest_id string, seq long, title string, link string, summary string, source string, comments_link string"
    path = new_path(spark)
    spark.createDataFrame(rows, schema).selectExpr("*", "DATE'2024-01-30' AS digest_date").write.parquet(path)
    cfg = DigestConfig(keywords=["the "], negative_keywords=["secret"], max_articles=3, encoder=hashed_bow_encoder(32))
    top = rank_and_select(spark.read.parquet(path), cfg)
    assert not [f for f in top.inputFiles() if path in f]  # the last step passes over no whole table again
    found = {r.seq: (r.title, r.summary, [x.seq for x in r.related]) for r in top.collect()}
    assert found == {0: ("the red fox", "text 0", [4]), 1: ("the blue whale", "text 1", []), 3: ("the old stone", "text 3", [])}
