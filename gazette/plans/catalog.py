"""Registered queries: each maps (spark, sf_dir) → DataFrame over the driver
tables, with a DuckDB oracle in :mod:`gazette.plans.oracle` where SQL can
express it.  Doubles are rounded to 9 digits on both sides."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.functions.text import content_key
from gazette.functions.urls import clean_url, resolve_src, url_domain
from gazette.operators import filters as flt
from gazette.plans.positions import positions
from gazette.plans.stored import join_on
from gazette.plans.stages import Pipeline
from gazette.sources import tables as tb

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


# Keyword lists used by the filter queries (ASCII, see FIXTURES.md §B).
KW_POSITIVE = ["the ", "license"]
KW_NEGATIVE = ["and the", "que"]
KW_MATCH_LIST = ["the ", "que", "nder", "and the", "license", "thand"]
KW_STAGE_NEG = ["license", "thand"]
KW_STAGE_POS = ["the ", "nder"]


# ---------------------------------------------------------------- filters
@register("kw_filter")
def q_kw_filter(spark, sf):
    df = tb.documents_articles(spark, sf)
    return flt.keyword_filter(df, KW_POSITIVE).select("seq", "source")


@register("kw_filter_empty")
def q_kw_filter_empty(spark, sf):
    df = tb.documents_articles(spark, sf)
    return flt.keyword_filter(df, []).select("seq", "source")


@register("negative_kw_filter")
def q_negative_kw_filter(spark, sf):
    df = tb.documents_articles(spark, sf)
    return flt.negative_keyword_filter(df, KW_NEGATIVE).select("seq", "source")


@register("kw_matches")
def q_kw_matches(spark, sf):
    df = tb.documents_articles(spark, sf)
    out = flt.with_matched_keywords(df, KW_MATCH_LIST)
    return out.select("seq", F.array_join("matched_keywords", "|").alias("matched"))


@register("filter_chain")
def q_filter_chain(spark, sf):
    chain = Pipeline(
        [
            lambda d: flt.negative_keyword_filter(d, KW_STAGE_NEG),
            lambda d: flt.keyword_filter(d, KW_STAGE_POS),
        ]
    )
    return chain.run(tb.documents_articles(spark, sf)).select("seq", "source")


@register("stage_counts")
def q_stage_counts(spark, sf):
    return flt.stage_counts(tb.documents_articles(spark, sf), KW_STAGE_NEG, KW_STAGE_POS)


@register("top_n")
def q_top_n(spark, sf):
    df = tb.events_articles(spark, sf)
    out = flt.top_n(df, 10, order=["seq"], rank_col="final_rank")
    return out.select("digest_id", "seq", "source", F.col("final_rank").cast("bigint").alias("final_rank"))


@register("dry_run")
def q_dry_run(spark, sf):
    df = flt.top_n(tb.events_articles(spark, sf), 5, order=["seq"])
    return flt.dry_run(df).select("digest_id", "seq", "generated_summary", "why_care")


@register("arrival_seq")
def q_arrival_seq(spark, sf):
    docs = tb.read_table(spark, sf, "documents").select("doc_id", "source")
    names = docs.select("source").distinct()
    # the sources config: registration order = name order
    srcs = positions(names.withColumn("g", F.lit(0)), "g", ["source"], out="source_ord").drop("g")
    df = join_on(docs, srcs, ["source"]).withColumn("digest_id", F.lit("documents"))
    return positions(df, "digest_id", ["source_ord", "doc_id"], out="seq").select(
        "doc_id", "source", F.col("source_ord").cast("bigint").alias("source_ord"), "seq"
    )


# ---------------------------------------------------------------- urls / keys
@register("clean_urls")
def q_clean_urls(spark, sf):
    p = tb.pages_table(spark, sf)
    return p.select("page_id", clean_url("url").alias("clean_url"))


@register("domain_counts")
def q_domain_counts(spark, sf):
    p = tb.pages_table(spark, sf)
    return p.groupBy(url_domain("url").alias("domain")).agg(F.count(F.lit(1)).alias("n_pages"))


@register("resolve_src")
def q_resolve_src(spark, sf):
    p = tb.pages_table(spark, sf)
    links = p.select("page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), F.lit(1))).alias("pos", "href"))
    return links.select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), resolve_src("url", "href").alias("resolved"), resolve_src("url", "href", strict=True).alias("resolved_strict")
    )


@register("content_key")
def q_content_key(spark, sf):
    d = tb.documents_articles(spark, sf)
    return d.select("seq", content_key("link", "summary").alias("content_key"))


# ---------------------------------------------------------------- similarity
from gazette.operators import dedupe as dd  # noqa: E402
from gazette.operators import novelty as nv  # noqa: E402
from gazette.operators.simjoin import self_similarity_edges  # noqa: E402

SIM_T = 0.30  # max cosine in `embeddings` is ~0.5, so the 0.85 default never fires
HIST_BASE = "2025-06-01"  # headline date = base + label
ASOF_SHIFT = 7  # candidate as-of date = headline date + 7 (own day just outside the window)
LOOKBACK = 7


def _r9(c):
    return F.round(F.col(c), 9)


def embedding_headlines(spark, sf):
    """Every embedding row as a published headline dated base + label."""
    e = tb.embeddings_articles(spark, sf)
    return e.select(
        F.date_add(F.lit(HIST_BASE).cast("date"), F.col("source").cast("int")).alias("digest_date"),
        F.col("title").alias("headline"),
        "embedding",
    )


def embedding_candidates(spark, sf):
    e = tb.embeddings_articles(spark, sf)
    return e.withColumn(
        "as_of", F.date_add(F.lit(HIST_BASE).cast("date"), F.col("source").cast("int") + F.lit(ASOF_SHIFT))
    )


@register("cosine_pairs")
def q_cosine_pairs(spark, sf):
    e = tb.embeddings_articles(spark, sf)
    return self_similarity_edges(e, SIM_T).select("i", "j", _r9("sim").alias("sim"))


@register("novelty_filter")
def q_novelty_filter(spark, sf):
    out = nv.novelty_filter(
        embedding_candidates(spark, sf), embedding_headlines(spark, sf), lookback_days=LOOKBACK, threshold=SIM_T
    )
    return out.select("seq", "source")


@register("novelty_scores")
def q_novelty_scores(spark, sf):
    out = nv.max_history_similarity(embedding_candidates(spark, sf), embedding_headlines(spark, sf), lookback_days=LOOKBACK)
    return out.select("seq", _r9("max_history_sim").alias("max_sim"), "best_headline")


@register("history_window")
def q_history_window(spark, sf):
    ev = tb.read_table(spark, sf, "events")
    days = ev.select(F.to_date("ts").alias("d")).distinct()
    rows = None
    for lb in (1, 7, 31):
        w = days.select(F.col("d").alias("as_of"), F.lit(lb).alias("lookback"))
        part = w.join(days, nv.in_window(F.col("d"), F.col("as_of"), lb))  # days: one row per date
        rows = part if rows is None else rows.unionByName(part)
    fname = F.concat(F.lit("reading_list_"), F.date_format("d", "yyyyMMdd"), F.lit(".md"))
    return rows.groupBy("as_of", "lookback").agg(
        F.count(F.lit(1)).alias("n_reports"), F.min(fname).alias("first_file"), F.max(fname).alias("last_file")
    ).select(F.date_format("as_of", "yyyy-MM-dd").alias("as_of"), "lookback", "n_reports", "first_file", "last_file")


@register("dedupe_leaders")
def q_dedupe_leaders(spark, sf):
    g = dd.similarity_groups(tb.embeddings_articles(spark, sf), SIM_T)
    return g.filter("seq = leader_seq").select("seq")


@register("dedupe_leaders_partitioned")
def q_dedupe_leaders_partitioned(spark, sf):
    g = dd.similarity_groups(tb.embeddings_articles(spark, sf), SIM_T, block_rows=128)
    return g.filter("seq = leader_seq").select("seq")


@register("dedupe_groups")
def q_dedupe_groups(spark, sf):
    g = dd.similarity_groups(tb.embeddings_articles(spark, sf), SIM_T)
    return g.select("seq", "leader_seq", _r9("similarity").alias("similarity"))


@register("related_lists")
def q_related_lists(spark, sf):
    d = dd.dedupe_similar(tb.embeddings_articles(spark, sf), SIM_T)
    return d.select(
        "seq",
        F.size("related").cast("bigint").alias("n_related"),
        F.array_join(F.transform("related", lambda r: r["seq"].cast("string")), ",").alias("related_seqs"),
    )


# ---------------------------------------------------------------- ranking
from gazette.operators import peel as pl  # noqa: E402


@register("peel_rank")
def q_peel_rank(spark, sf):
    return pl.peel_rank(tb.embeddings_articles(spark, sf)).select("seq", "div_rank")


@register("peel_rank_rounds")
def q_peel_rank_rounds(spark, sf):
    """The same order from several rounds: most rows stand outside a round's batch."""
    return pl.peel_rank(tb.embeddings_articles(spark, sf), batch_rows=400, picks=128).select("seq", "div_rank")


@register("static_centrality")
def q_static_centrality(spark, sf):
    return pl.peel_rank(tb.embeddings_articles(spark, sf), mode="static").select("seq", "div_rank")


@register("mean_similarity")
def q_mean_similarity(spark, sf):
    out = pl.mean_similarity(tb.embeddings_articles(spark, sf))
    return out.select("seq", _r9("mean_sim").alias("mean_sim"))


# ---------------------------------------------------------------- balancing
from gazette.operators import balance as bl  # noqa: E402

BAL_N = 10


@register("balance_sources")
def q_balance_sources(spark, sf):
    out = bl.balance_sources(tb.events_articles(spark, sf), BAL_N)
    return out.select("digest_id", "seq", "final_rank")


@register("balance_sources_lang")
def q_balance_sources_lang(spark, sf):
    return bl.balance_sources(tb.documents_articles(spark, sf, source="lang"), BAL_N).select("seq", "source", "final_rank")


@register("source_counts")
def q_source_counts(spark, sf):
    return bl.source_counts(tb.events_articles(spark, sf), BAL_N)


@register("overrepresented")
def q_overrepresented(spark, sf):
    return bl.overrepresented_sources(tb.events_articles(spark, sf), BAL_N)


@register("first_per_source")
def q_first_per_source(spark, sf):
    return bl.first_per_source(tb.events_articles(spark, sf))


@register("least_represented")
def q_least_represented(spark, sf):
    return bl.least_represented(tb.events_articles(spark, sf), BAL_N)


# ---------------------------------------------------------------- rendering
from gazette.functions.markdown import extract_headings, normalize_headers  # noqa: E402
from gazette.operators import render as rd  # noqa: E402
from gazette.sources import history as hs  # noqa: E402

REPORT_N = 5


def headed_text(spark, sf):
    """documents text with headings injected by an expression (h1 only, h2 only,
    h1+h2, h3–h6, none, ``#x``, seven hashes, extra whitespace)."""
    d = tb.read_table(spark, sf, "documents")
    t, s, x = tb.first_line("text"), F.col("source"), F.col("text")
    k = F.col("doc_id") % 8
    nl = F.lit("\n")
    body = (
        F.when(k == 0, F.concat(F.lit("# "), t, nl, x))
        .when(k == 1, F.concat(F.lit("## "), t, nl, x))
        .when(k == 2, F.concat(F.lit("# "), t, F.lit("\n## "), s, nl, x))
        .when(k == 3, F.concat(F.lit("### "), t, F.lit("\n#### "), s, F.lit("\n##### a\n###### b\n"), x))
        .when(k == 4, x)
        .when(k == 5, F.concat(F.lit("#x "), t, nl, x))
        .when(k == 6, F.concat(F.lit("####### "), t, nl, x))
        .otherwise(F.concat(F.lit("#   "), t, F.lit("\n##\t"), s, nl, x))
    )
    return d.select(F.col("doc_id").alias("seq"), t.alias("title"), "source", body.alias("headed"))


def event_reports(spark, sf):
    top = flt.top_n(tb.events_articles(spark, sf), REPORT_N, order=["seq"], rank_col="final_rank")
    top = flt.dry_run(top).withColumn("digest_date", F.to_date("digest_id"))
    return rd.render_reports(top)


@register("normalize_headers")
def q_normalize_headers(spark, sf):
    h = headed_text(spark, sf)
    return h.select("seq", F.md5(normalize_headers("headed")).alias("normalized_md5"))


@register("article_blocks")
def q_article_blocks(spark, sf):
    h = headed_text(spark, sf)
    lead = h.groupBy("title").agg(F.min("seq").alias("seq"))
    rel = (
        h.join(lead.withColumnRenamed("seq", "lead"), "title")
        .filter(F.col("seq") > F.col("lead"))
        .groupBy("lead")
        .agg(F.array_sort(F.collect_list(F.struct("seq", "title", F.concat(F.lit("doc://"), F.col("seq").cast("string")).alias("link")))).alias("related"))
    )
    arts = (
        h.join(lead, ["title", "seq"], "left_semi")
        .join(rel.withColumnRenamed("lead", "seq"), "seq", "left")
        .select(
            "seq", "title", "source",
            F.concat(F.lit("doc://"), F.col("seq").cast("string")).alias("link"),
            F.col("headed").alias("generated_summary"),
            F.lit("").alias("why_care"),
            "related",
        )
    )
    return rd.render_blocks(arts).select("seq", F.md5("block").alias("block_md5"))


@register("reports")
def q_reports(spark, sf):
    r = event_reports(spark, sf)
    return r.select("digest_id", F.md5("markdown").alias("report_md5"), F.length("markdown").cast("bigint").alias("n_chars"))


@register("headings")
def q_headings(spark, sf):
    r = event_reports(spark, sf)
    return r.select("digest_id", F.posexplode(extract_headings("markdown")).alias("pos", "headline")).select(
        "digest_id", F.col("pos").cast("bigint").alias("pos"), "headline"
    )


HISTORY_ASOF = "2024-01-30"


@register("history_headlines")
def q_history_headlines(spark, sf):
    """Reports written to a table in the warehouse, read back for a window.  (A report
    holds the top ``REPORT_N`` articles of its digest; so do its headlines.)"""
    path = report_path(spark)
    hs.write_reports(event_reports(spark, sf), path)
    h = hs.read_headlines(spark, path, HISTORY_ASOF, lookback_days=LOOKBACK)
    return h.select(F.date_format("digest_date", "yyyy-MM-dd").alias("digest_date"), "headline")


def report_path(spark):
    """A new report table in the session's warehouse."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/gazette_reports/{uuid.uuid4().hex}"


def reader_of(event_id):
    """Two readers with a digest of their own each day: even and odd events."""
    return F.when(event_id % 2 == 0, F.lit("even")).otherwise(F.lit("odd"))


@register("history_per_digest")
def q_history_per_digest(spark, sf):
    """Each reader's history holds the reader's own reports only."""
    ev = tb.events_articles(spark, sf).withColumn("digest_date", F.to_date("digest_id"))
    ev = ev.withColumn("digest_id", reader_of(F.col("seq")))
    daily = ev.withColumn("_day", F.concat_ws("|", "digest_id", F.col("digest_date").cast("string")))
    top = flt.dry_run(flt.top_n(daily, REPORT_N, order=["seq"], by="_day", rank_col="final_rank")).drop("_day")
    path = report_path(spark)
    hs.write_reports(rd.render_reports(top), path)
    h = hs.read_headlines(spark, path, HISTORY_ASOF, lookback_days=LOOKBACK)
    return h.select("digest_id", F.date_format("digest_date", "yyyy-MM-dd").alias("digest_date"), F.col("pos").cast("bigint").alias("pos"), "headline")


@register("novelty_per_digest")
def q_novelty_per_digest(spark, sf):
    """Candidates are compared with their own digest's headlines only."""
    digest = (F.col("seq") % 2).cast("string")
    cands = embedding_candidates(spark, sf).withColumn("digest_id", digest)
    heads = tb.embeddings_articles(spark, sf).select(
        digest.alias("digest_id"),
        F.date_add(F.lit(HIST_BASE).cast("date"), F.col("source").cast("int")).alias("digest_date"),
        F.col("title").alias("headline"),
        "embedding",
    )
    out = nv.novelty_filter(cands, heads, lookback_days=LOOKBACK, threshold=SIM_T, history_keys=["digest_id"])
    return out.select("digest_id", "seq")


@register("records_json")
def q_records_json(spark, sf):
    return rd.to_records(flt.dry_run(tb.events_articles(spark, sf)))


# ---------------------------------------------------------------- pages / enrichment
from gazette.operators import enrich as en  # noqa: E402
from gazette.operators import pages as pg  # noqa: E402

PROMPT_TEMPLATE = "Title: {title}\nSource: {source}\nLink: {link}\nSummary: {summary}\n\nContent:\n{content}"


def _unescape(c):
    return F.replace(F.replace(c, F.lit("&quot;"), F.lit('"')), F.lit("&amp;"), F.lit("&"))


def page_articles(spark, sf):
    """``pages`` as one digest of articles: title from ``<title>``, comments link
    keyed to the conversation of its number, if there is one."""
    p = tb.pages_table(spark, sf)
    return p.select(
        F.lit("pages").alias("digest_id"),
        F.col("page_id").alias("seq"),
        _unescape(F.regexp_extract("html", r"<title>(.*?)</title>", 1)).alias("title"),
        F.col("url").alias("link"),
        F.lit(None).cast("timestamp").alias("published"),
        F.lit("").alias("summary"),
        url_domain("url").alias("source"),
        F.concat(F.lit("conv://"), F.col("page_id").cast("string")).alias("comments_link"),
        F.lit(None).cast("array<double>").alias("embedding"),
    )


def page_leaders(spark, sf):
    """Exact-title groups: the first page leads, later pages are related."""
    a = page_articles(spark, sf)
    lead = a.groupBy("digest_id", "title").agg(F.min("seq").alias("lead"))
    rel = (
        a.join(lead, ["digest_id", "title"])
        .filter(F.col("seq") > F.col("lead"))
        .groupBy("digest_id", "lead")
        .agg(F.array_sort(F.collect_list(F.struct("seq", "title", "link", "comments_link", F.lit(1.0).alias("similarity")))).alias("related"))
    )
    leaders = a.join(lead.withColumnRenamed("lead", "seq"), ["digest_id", "title", "seq"], "left_semi")
    empty = F.array().cast("array<struct<seq:bigint,title:string,link:string,comments_link:string,similarity:double>>")
    return leaders.join(rel.withColumnRenamed("lead", "seq"), ["digest_id", "seq"], "left").withColumn(
        "related", F.coalesce("related", empty)
    )


def comment_pages(spark, sf):
    """Comment threads rendered as pages from ``conversations`` (one per conv)."""
    c = tb.read_table(spark, sf, "conversations")
    esc = F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    # outer and inner elements by the number of the conversation: each comment selector decides some pages
    kinds = [
        ('<div class="comments">', "</div>", '<div class="comment">', "</div>"),
        ('<section class="a comments">', "</section>", "<article class=comment>", "</article>"),
        ("<div id='discussion'>", "</div>", "<p>", "</p>"),
        ('<div class="x feedback y" title="a > b">', "</div>", "<p>", "</p>"),
        ('<div id="comments">', "</div>", '<DIV CLASS="comment">', "</DIV>"),
    ]
    part = lambda i: F.element_at(F.array(*[F.lit(k[i]) for k in kinds]), (F.col("conv_id") % len(kinds) + 1).cast("int"))
    turns = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", esc.alias("t")))).alias("said"))
    body = F.array_join(F.transform("said", lambda x: F.concat(part(2), x["t"], part(3))), "")
    page = F.concat(part(0), body, part(1))
    return turns.select(
        F.concat(F.lit("conv://"), F.col("conv_id").cast("string")).alias("url"),
        F.concat(F.lit("<html><body>"), page, F.lit("</body></html>")).alias("html"),
    )


def decorated_pages(spark, sf):
    """``pages`` with what they lack, by expression on the page's number: ``og:image`` and
    ``twitter:image`` tags (some empty), images and boilerplate inside the article, comments, and
    hosts that the domain rules name, with and without the elements that these look for."""
    p = tb.pages_table(spark, sf)
    k, number = F.col("page_id") % 6, F.col("page_id").cast("string")
    tech = F.when(F.col("page_id") % 7 == 0, F.floor(F.col("page_id") / 7) % 4)  # kind of techcrunch.com page
    say = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    meta = (
        F.when(k == 0, say('<meta property="og:image" content="/og/', number, '.png">'))
        .when(k == 1, say('<meta property="og:image" content=""><meta name="twitter:image" content="https://t.example/', number, '.png">'))
        .otherwise(F.lit(""))
    )
    article = F.concat(
        F.when(k == 2, say('<img src="/logo/x.png"><img src="/pic/', number, '.png">')).otherwise(F.lit("")),
        F.when(k == 3, F.lit('<div class="box ad"><div>buy</div> this</div><template><p>hidden</p></template>')).otherwise(F.lit("")),
        F.when(k == 4, F.lit("<nav>menu here</nav><footer>small print</footer>")).otherwise(F.lit("")),
        F.when(tech == 1, say('<img alt="a > b" class="size-x wp-post-image" src="/t/', number, '.png">'))
        .when(tech == 2, say('<img class="wp-post-image" src="/author/', number, '.png"><main class="wide template-content"><img src="/other.png"><img src="/wp-content/', number, '.png">words ', number, "</main>"))
        .when(tech == 3, say("<main class='template-content'>tech ", number, '<div class="advertisement">no</div></main>'))
        .otherwise(F.lit("")),
    )
    comments = F.when(F.col("page_id") % 5 == 0, say('<div id="feedback">nice ', number, "</div>")).otherwise(F.lit(""))
    html = F.regexp_replace("html", "(?i)</head>", F.concat(meta, F.lit("</head>")))
    html = F.concat(F.regexp_replace(html, "(?i)<article>", F.concat(F.lit("<article>"), article)), comments)  # behind the last end tag
    url = F.when(F.col("page_id") % 7 == 0, say("https://techcrunch.com/", number)).otherwise(F.col("url"))
    return p.select("page_id", url.alias("url"), html.alias("html"))


def extracted_pages(spark, sf, fields=None, decorated=False):
    pages = decorated_pages(spark, sf) if decorated else tb.pages_table(spark, sf)
    return pg.extract_pages(pages, keep=["page_id"], fields=fields)


def extracted_comments(spark, sf):
    return pg.extract_pages(comment_pages(spark, sf), fields=["comments"])


@register("page_text")
def q_page_text(spark, sf):
    return extracted_pages(spark, sf, ["text"]).select("page_id", "text")


@register("page_text_clean")
def q_page_text_clean(spark, sf):
    return extracted_pages(spark, sf, ["text_rules"], decorated=True).select("page_id", F.col("text_rules").alias("text"))


@register("page_stats")
def q_page_stats(spark, sf):
    x = extracted_pages(spark, sf, decorated=True)
    return x.select(
        "page_id", "title", F.length("text").cast("bigint").alias("text_chars"), F.length("text_rules").cast("bigint").alias("clean_chars"),
        "image_url", "image_rules", F.col("comments").isNotNull().alias("has_comments"),
    )


@register("page_image")
def q_page_image(spark, sf):
    return extracted_pages(spark, sf, ["image_url", "image_rules"], decorated=True).select("page_id", "image_url", "image_rules")


@register("page_comments")
def q_page_comments(spark, sf):
    return extracted_comments(spark, sf).select(F.col("url").alias("comments_link"), "comments")


@register("page_lookup")
def q_page_lookup(spark, sf):
    arts = page_leaders(spark, sf).select("digest_id", "seq", "link").unionByName(
        tb.documents_articles(spark, sf).select("digest_id", "seq", "link")
    )
    joined = en.attach_pages(arts, extracted_pages(spark, sf, ["text", "image_url"]))
    return joined.select("digest_id", "seq", F.col("page_text").isNotNull().alias("has_page"))


def _content(spark, sf):
    pages = extracted_pages(spark, sf, ["text", "image_url"])
    return en.attach_content(page_leaders(spark, sf), pages, extracted_comments(spark, sf))


@register("content_with_comments")
def q_content_with_comments(spark, sf):
    out = en.with_content(page_articles(spark, sf), extracted_pages(spark, sf, ["text", "image_url"]), extracted_comments(spark, sf))
    return out.select("seq", F.md5("content").alias("content_md5"), F.length("content").cast("bigint").alias("n_chars"))


@register("content_bundle")
def q_content_bundle(spark, sf):
    return _content(spark, sf).select(
        "seq", F.size("related").cast("bigint").alias("n_related"), F.md5("bundle").alias("bundle_md5")
    )


@register("image_choice")
def q_image_choice(spark, sf):
    pages = extracted_pages(spark, sf, ["text", "image_url"], decorated=True).drop("url")
    pages = pages.join(tb.pages_table(spark, sf).select("page_id", "url"), "page_id")  # by the links of the articles
    return en.attach_content(page_leaders(spark, sf), pages, None).select("seq", "image_url")


@register("prompts")
def q_prompts(spark, sf):
    p = en.build_prompts(_content(spark, sf), PROMPT_TEMPLATE)
    return p.select("seq", F.md5("prompt").alias("prompt_md5"))


def conversation_responses(spark, sf):
    """Model answers stand-in: the assistant turns of the conversation of the page's number."""
    c = tb.read_table(spark, sf, "conversations").filter(F.col("role") == "assistant")
    turns = F.sort_array(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("t"))))
    said = c.groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda x: x["t"]), "\n").alias("text"))
    a = page_articles(spark, sf).select("digest_id", "seq", F.col("seq").alias("conv_id"))
    return a.join(said, "conv_id").select("digest_id", "seq", "text")


@register("responses")
def q_responses(spark, sf):
    out = en.attach_responses(page_articles(spark, sf), conversation_responses(spark, sf))
    return out.select("seq", F.md5("generated_summary").alias("summary_md5"), "why_care")


# ---------------------------------------------------------------- feeds
from gazette.sources import feeds as fd  # noqa: E402

FEED_ITEMS = 64  # documents per landed feed file: doc_id div 64 within a source


def _xml_escape(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def landed_feeds(spark, sf):
    """``documents`` rendered as RSS 2.0 files (one per source and id block):
    documents without a quality label keep their description, documents
    labelled quality 0 lack one (a bad entry)."""
    d = tb.read_table(spark, sf, "documents")
    lab = tb.read_table(spark, sf, "labels").select("doc_id", "quality")
    d = d.join(lab, "doc_id", "left")
    ts = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("doc_id") * 60)
    pub = F.when(F.col("doc_id") % 2 == 0, F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")).otherwise(
        F.date_format(F.from_utc_timestamp(ts, "+02:00"), "EEE, dd MMM yyyy HH:mm:ss '+0200'")
    )
    desc = F.when(
        F.coalesce(F.col("quality"), F.lit(1)) != 0,
        F.concat(F.lit("<description>"), _xml_escape(F.col("text")), F.lit("</description>")),
    ).otherwise(F.lit(""))
    item = F.concat(
        F.lit("<item><title>"), _xml_escape(tb.first_line("text")), F.lit("</title><link>doc://"), F.col("doc_id").cast("string"),
        F.lit("</link><pubDate>"), pub, F.lit("</pubDate>"), desc,
        F.lit("<comments>conv://"), F.col("doc_id").cast("string"), F.lit("</comments></item>"),
    )
    feed = F.concat(F.col("source"), F.lit("/"), (F.col("doc_id") / FEED_ITEMS).cast("long").cast("string"))
    files = d.groupBy(feed.alias("feed"), "source").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", item.alias("x")))), lambda s: s["x"]), "").alias("items")
    )
    return files.select(
        "feed", "source",
        F.concat(F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>'), F.col("source"), F.lit("</title>"), F.col("items"), F.lit("</channel></rss>")).alias("value"),
    )


def feed_sources(files):
    """Registration order: source name, then block number (one URL per feed file)."""
    block = F.split(F.col("feed"), "/")[1].cast("int")
    names = files.select("feed", "source", block.alias("blk"))
    ordered = positions(names.withColumn("g", F.lit(0)), "g", ["source", "blk"], out="source_ord")
    return ordered.select(F.col("feed").alias("url"), F.col("source_ord").cast("int").alias("source_ord"), F.col("source").alias("name"))


@register("feed_scan")
def q_feed_scan(spark, sf):
    files = landed_feeds(spark, sf)
    entries = fd.isolate_feeds(fd.parse_feeds(files), "drop_entry")
    arts = fd.assign_seq(entries, feed_sources(files), digest_id="feeds")
    return arts.select("seq", "title", "link", "published", F.md5("summary").alias("summary_md5"), "source", "comments_link")


@register("feed_isolation")
def q_feed_isolation(spark, sf):
    files = landed_feeds(spark, sf)
    entries = fd.isolate_feeds(fd.parse_feeds(files), "drop_feed")
    return entries.groupBy("feed").agg(F.count(F.lit(1)).alias("n_entries"))


# ---------------------------------------------------------------- whole run
from gazette.plans import flagship as fs  # noqa: E402


@register("daily_digest")
def q_daily_digest(spark, sf):
    r = fs.flagship_reports(spark, sf)
    return r.select("digest_id", F.md5("markdown").alias("report_md5"), F.length("markdown").cast("bigint").alias("n_chars"))


# ---------------------------------------------------------------- exact bag-of-words cosine
from gazette.operators.bow import token_similarity_edges  # noqa: E402

BOW_T = 0.6


@register("bow_similarity")
def q_bow_similarity(spark, sf):
    e = token_similarity_edges(tb.documents_articles(spark, sf), BOW_T)
    return e.select("i", "j", _r9("sim").alias("sim"))


# ---------------------------------------------------------------- default encoder, all stages
from gazette.functions.vectors import embed, hashed_bow_encoder  # noqa: E402
from gazette.plans import digest as dg  # noqa: E402

ENCODER_DIM = 64


@register("title_embedding")
def q_title_embedding(spark, sf):
    """Non-zero places of the default title vector of every document."""
    d = embed(tb.documents_articles(spark, sf), encoder=hashed_bow_encoder(ENCODER_DIM))
    places = d.select("seq", F.posexplode("embedding").alias("place", "weight")).filter("weight <> 0")
    return places.select("seq", F.col("place").cast("bigint").alias("place"), _r9("weight").alias("weight"))


@register("digest_stage_counts")
def q_digest_stage_counts(spark, sf):
    """Rows behind every stage of the run: keywords on titles, novelty, grouping and limit."""
    arts = embedding_candidates(spark, sf).withColumn("digest_date", F.col("as_of"))
    cfg = dg.DigestConfig(
        keywords=["item"], negative_keywords=["item 1"], novelty_lookback_days=LOOKBACK, novelty_similarity_threshold=SIM_T, similarity_threshold=SIM_T, max_articles=BAL_N
    )
    return dg.digest_stage_counts(arts, cfg, embedding_headlines(spark, sf)).withColumn("stage_ord", F.col("stage_ord").cast("int"))
