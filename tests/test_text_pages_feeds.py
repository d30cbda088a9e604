import re

from pyspark.sql import functions as F

from gazette.functions.markdown import extract_headings, normalize_headers
from gazette.operators import render as rd
from gazette.operators.pages import extract_pages
from gazette.sources.feeds import feed_counts, isolate_feeds, parse_feeds, read_all, read_feed_files


#: text → what header re-levelling makes of it
LEVELLED = {
    "# A\nbody": "### A\nbody",
    "## B\ntext": "### B\ntext",
    "# A\n## B\n### C": "### A\n#### B\n#### C",
    "#### d\n##### e\n###### f": "#### d\n#### e\n#### f",
    "### c\nx": "#### c\nx",
    "#x no\n####### seven": "#x no\n####### seven",
    "#   spaced\n##\ttab": "### spaced\n#### tab",
    "plain\n\ntrailing\n": "plain\n\ntrailing\n",
    "#\u00a0nbsp header": "### nbsp header",
    "#\x1ctitle with separator": "### title with separator",
    "# line\u2028separator": "### line\u2028separator",
    "# carriage\r": "### carriage\r",
}


def test_normalize_headers(spark):
    df = spark.createDataFrame([(c,) for c in LEVELLED], "t string")
    got = {r.t: r.n for r in df.select("t", normalize_headers("t").alias("n")).collect()}
    assert got == LEVELLED
    assert all(not re.search(r"(?m)^## ", g) for g in got.values())


ARTICLE = (
    "digest_id string, final_rank int, title string, source string, link string, image_url string, "
    "generated_summary string, why_care string, related array<struct<seq:bigint,title:string,link:string>>"
)


def test_render_parse_round_trip(spark):
    rows = [
        ("d", 2, "Second", "src", "http://b", None, "# H\nbody", "", []),
        ("d", 1, "First   title", "src", "http://a", "http://img/a.png", "text", "", [(5, "Rel", "http://r")]),
    ]
    df = spark.createDataFrame(
        rows,
        "digest_id string, final_rank int, title string, source string, link string, image_url string, "
        "generated_summary string, why_care string, related array<struct<seq:bigint,title:string,link:string>>",
    ).withColumn("digest_date", F.lit("2025-06-08").cast("date"))
    md = rd.render_reports(df).collect()[0].markdown
    assert md.startswith("# Daily Reading List - 2025-06-08\n\n## First")
    assert md.count("[Read more]") == md.count("---\n") == md.count("*Source:") == 2
    assert "### Related Articles\n\n- [Rel](http://r)\n\n---" in md
    heads = spark.createDataFrame([(md,)], "m string").select(extract_headings("m").alias("h")).collect()[0].h
    assert heads == ["First   title", "Second"]
    parsed = rd.parse_reports(spark.createDataFrame([("d", md)], "digest_id string, markdown string")).orderBy("position").collect()
    assert [p.title for p in parsed] == ["First   title", "Second"]
    assert parsed[0].image_url == "http://img/a.png" and parsed[1].image_url is None
    assert [tuple(x) for x in parsed[0].related] == [("Rel", "http://r")] and parsed[1].related == []
    assert [p.link for p in parsed] == ["http://a", "http://b"]


def test_rules_and_links_in_a_body_survive_the_round_trip(spark):
    body = "before\n\n---\n\n# title\n[Read more](x) of it\n\n---\n"
    rows = [("d", 1, "One", "s", "http://a(1)", None, body, "why", [(5, "R [x](y)", "http://r")]), ("d", 2, "Two", "s", "http://b", None, "", "", [])]
    df = spark.createDataFrame(rows, ARTICLE).withColumn("digest_date", F.lit("2025-06-08").cast("date"))
    parsed = rd.parse_reports(rd.render_reports(df)).orderBy("position").collect()
    assert [(p.title, p.link) for p in parsed] == [("One", "http://a(1)"), ("Two", "http://b")]
    assert parsed[0].body.startswith("before\n\n---\n\n### title\n[Read more](x) of it\n\n---\n")
    assert [tuple(x) for x in parsed[0].related] == [("R [x](y)", "http://r")]


def test_a_block_template_of_ones_own(spark):
    df = spark.createDataFrame([("d", 1, "One", "s", "l", None, "t", "", [])], ARTICLE).withColumn("digest_date", F.lit("2025-06-08").cast("date"))
    out = rd.render_reports(df, block=lambda **cols: F.concat(F.lit("* "), F.col("title"), F.lit("\n"))).head()
    assert out.markdown == "# Daily Reading List - 2025-06-08\n\n* One\n"


def _extract(spark, rows, *fields):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, url string, html string")
    return [r.asDict() for r in extract_pages(df, keep=["i"], fields=fields or None).orderBy("i").collect()]


def test_page_rules_on_handwritten_pages(spark):
    page = (
        '<html><head><meta property="og:image" content=""><meta name="twitter:image" content="/tw.png">'
        "<title>T &amp; U</title></head><body><article><p>One <b>two</p> three"
        "<script>var x='<p>';</script></article><div class=\"comments\"><div class=\"comment\">c1</div>"
        '<div class="comment">c2</div></div></body></html>'
    )
    img = '<html><body><img src=""><img src="a.png"><article></article><p>x</p></body></html>'
    nested = "<body><div class='x post y'><div>in &#8364;&#x1F600;&eacute;&nope;</div>tail<!-- <p>no</p> --></div>out</body>"
    x, y, z, t, none = _extract(
        spark,
        [("https://h.example/p", page), ("https://h.example/p", img), ("u", nested), ("u", "<body><article>a<template><p>hidden</p></template></article>"), ("u", "<html><p>no body</p></html>")],
        "title", "text", "image_url", "comments",
    )
    assert x["title"] == "T & U"
    assert x["text"] == "One\ntwo\nthree"
    assert x["image_url"] == "/tw.png"  # verbatim, relative stays relative
    assert x["comments"] == "c1 c2\n\nc1\n\nc2"  # nested matches repeat
    assert y["image_url"] == "https://h.examplea.png"
    assert y["text"] == "x"  # empty article falls back to body
    assert z["text"] == "in €😀é&nope;\ntail" and z["comments"] is None
    assert t["text"] == "a" and none["text"] is None


def test_no_page_fails_a_job(spark):
    deep = "<body>" + "<li>" * 100_000 + "deep"
    rows = [("http://[x/y", "<img src='a.png'><body><p>t"), (None, None), ("http://a/", ""), ("http://a/", "<article <p>< & &#xFFFFFFF; &#0; &"), ("u", "<div class=comments>" * 50 + "c"), ("u", deep)]
    got = _extract(spark, rows)
    assert got[0]["image_url"] == "http://[xa.png" and got[1]["text"] is None and got[5]["text"] == "deep"
    assert got[4]["comments"] == "\n\n".join(["c"] * 50)


def test_quotes_references_and_nested_boilerplate(spark):
    rows = [
        ("https://h.example/", '<article><img alt="a > b" src="/p.png">text</article>'),
        ("https://h.example/", "<p title=don't>x</p><article data-x='1>2' CLASS=a>y</article>"),
        ("https://h.example/", "<article>AT&amp T &copy 2024 &#146; &#x80; &bogus; &amp;lt; AT&T</article>"),
        ("https://h.example/", '<article>a<div class="ad"><div>x</div>LEAK</div>b<nav>n<nav>m</nav>o</nav>c<div class="ad">rest</article>'),
        ("https://h.example/", "<article></article></article><div class=\"post\">no</div><body>later</body>"),
        ("https://h.example/", '<article><img data-src="/no.png" alt="src=x" src="/yes.png"/>t</article>'),
    ]
    a, b, c, d, e, f = _extract(spark, rows, "text", "image_url", "text_rules")
    assert (a["text"], a["image_url"]) == ("text", "https://h.example/p.png")
    assert b["text"] == "y"
    assert c["text"] == "AT& T © 2024 ’ € &bogus; &lt; AT&T"
    assert d["text_rules"] == "a\nb\nc"
    assert e["text"] == "later"  # the first container is empty: the body's text
    assert f["image_url"] == "https://h.example/yes.png"


def test_pages_take_time_in_their_length(spark):
    """100,000 comments, boilerplate elements or open tags, and 1 MB of blanks."""
    import time

    n = 100_000
    comments = "<body>" + "".join(f'<div class="comment">c{i}</div>' for i in range(n)) + "</body>"
    ads = "<body><article>" + "".join(f'<div class="ad">c{i}</div>t' for i in range(n)) + "</article></body>"
    blanks = "<body><article>a" + " " * 1_000_000 + "b</article></body>"
    started = time.time()
    (x,) = _extract(spark, [("u", comments)], "comments")
    assert x["comments"] == "\n\n".join(f"c{i}" for i in range(n))
    (x,) = _extract(spark, [("u", ads)], "text_rules")
    assert x["text_rules"] == "\n".join("t" * n)
    (x,) = _extract(spark, [("u", blanks)], "text")
    assert len(x["text"]) == 1_000_002
    (x,) = _extract(spark, [("u", "<body>text" + "<a" * 200_000)], "text")  # no tag that ends
    assert x["text"] == "text"
    assert time.time() - started < 90


def test_elements_match_a_stack(spark):
    """Bracket matching by depth equals a stack per name, with ends and starts that lack their partner."""
    import random

    from gazette.functions import html as H

    rng = random.Random(4)
    pages = ["".join(rng.choice(["<div>", "<div>", "</div>", "<p>", "</p>", "x", "<div/>"]) for _ in range(rng.randint(0, 60))) for _ in range(40)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string").withColumn("page", H.parsed(F.col("html")))
    got = {r.i: [(e.name, e["at"], e.end) for e in r.e] for r in df.select("i", H._let(F.col("page"), lambda p: H.elements(p, F.array(F.lit("div"), F.lit("p")))).alias("e")).collect()}
    import re

    for i, page in enumerate(pages):
        tags = re.findall("<[^>]+>", page)
        want = []
        for name in ("div", "p"):
            open_ = []
            for at, t in enumerate(tags, 1):
                if t == f"<{name}>":
                    open_.append(at)
                elif t == f"</{name}>" and open_:
                    want.append((name, open_.pop(), at))
            want += [(name, s, len(tags) + 1) for s in open_]
        assert sorted(got[i], key=lambda e: e[1]) == sorted(want, key=lambda e: e[1])


def test_domain_rules(spark):
    page = "<body><article><nav>menu</nav><p>keep</p><div class=\"box ad\">buy</div><footer>f</footer><img src='/logo.png'><img src='pic.png'></article></body>"
    tech = "<body><main class='a template-content'><img class='wp-post-image' src='/author.png'><img src='/wp-content/x.png'>text</main></body>"
    hero = "<body><img class='big hero-x'><article>t<img src='p.png'></article></body>"
    a, b, c, d = _extract(spark, [("http://example.com/1", page), ("https://techcrunch.com/1", page), ("https://techcrunch.com/2", tech), ("http://e.org/", hero)], "text_rules", "image_rules")
    assert (a["text_rules"], a["image_rules"]) == ("keep", "pic.png")
    assert (b["text_rules"], b["image_rules"]) == (None, None)  # a matching domain rule that misses decides
    assert (c["text_rules"], c["image_rules"]) == ("text", "/wp-content/x.png")
    assert d["image_rules"] is None  # the first existing element decides, even without the attribute


RSS = """<rss version="2.0"><channel><title>T</title>
<item><title>A &amp; B</title><link>http://a/1</link><pubDate>Tue, 10 Jun 2025 04:00:00 +0200</pubDate>
<description><![CDATA[<p>x</p>]]></description><comments>http://a/1#c</comments></item>
<item><title>No summary</title><link>http://a/2</link><pubDate>Tue, 10 Jun 2025 04:00:00 GMT</pubDate></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>E</title><link rel="self" href="http://x/s"/>
<link rel="alternate" href="http://x/1"/><published>2025-06-10T04:00:00Z</published><summary>s</summary></entry></feed>"""


def test_feed_parse_and_isolation(spark):
    files = spark.createDataFrame([("rss", RSS), ("atom", ATOM), ("broken", "<rss><channel><item><title>x")], "feed string, value string")
    e = parse_feeds(files)
    rows = {(r.feed, r.entry_ord): r for r in e.collect()}
    assert rows[("rss", 0)].title == "A & B" and rows[("rss", 0)].comments_link == "http://a/1#c"
    assert str(rows[("rss", 0)].published) == "2025-06-10 02:00:00"
    assert rows[("atom", 0)].link == "http://x/1"
    assert {r.feed for r in isolate_feeds(e, "drop_feed").collect()} == {"atom"}
    assert isolate_feeds(e, "drop_entry").count() == 2


RDF = """<?xml version="1.0"?><!-- <feed > --><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:dc="http://purl.org/dc/elements/1.1/">
<channel><title>x</title></channel><item><title>T</title><link>http://a</link><dc:date>2025-06-10T04:00:00Z</dc:date><description>d</description></item></rdf:RDF>"""


def test_feed_shapes_are_told_by_their_root(spark):
    trick = RSS.replace("<p>x</p>", "see <feed > tag")
    files = spark.createDataFrame([("rdf", RDF), ("trick", trick), ("broken", "<rss><channel>"), ("empty", ""), ("null", None)], "feed string, value string")
    got = parse_feeds(files).collect()
    assert sorted((r.feed, r.title) for r in got) == [("rdf", "T"), ("trick", "A & B"), ("trick", "No summary")]
    counts = {r.feed: (r.parsed, r.n_entries, r.n_complete) for r in feed_counts(files).collect()}
    assert counts == {"rdf": (True, 1, 1), "trick": (True, 2, 1), "broken": (False, 0, 0), "empty": (False, 0, 0), "null": (False, 0, 0)}


def test_declared_encodings(spark, tmp_path):
    (tmp_path / "d.xml").write_bytes(('<?xml version="1.0" encoding="Windows-1252"?>' + RSS.replace("A &amp; B", "it’s 5 €")).encode("windows-1252"))
    for name, charset in (("a", "ISO-8859-1"), ("b", "UTF-16"), ("c", "UTF-8")):
        (tmp_path / f"{name}.xml").write_bytes((f'<?xml version="1.0" encoding="{charset}"?>' + RSS.replace("A &amp; B", "café")).encode(charset))
    got = parse_feeds(read_feed_files(spark, str(tmp_path))).filter("entry_ord = 0").collect()
    assert sorted((r.feed, r.title) for r in got) == [("a.xml", "café"), ("b.xml", "café"), ("c.xml", "café"), ("d.xml", "it’s 5 €")]


def test_custom_sources_keep_registration_order(spark):
    kind = "entry_ord int, title string, link string, published timestamp, summary string, comments_link string"

    def of(*titles):
        return lambda s: s.createDataFrame([(i, t, "l", None if t == "bad" else __import__("datetime").datetime(2025, 1, 1), "s", None) for i, t in enumerate(titles)], kind)

    got = read_all(spark, [("z", of("a", "bad", "b")), ("y", of("c"))]).orderBy("seq").collect()
    assert [(r.source, r.title) for r in got] == [("z", "a"), ("z", "b"), ("y", "c")]


def test_read_feeds_from_files_in_registration_order(spark):
    import os
    import tempfile

    from gazette.sources.feeds import assign_seq, read_feed_files, read_feeds

    path = tempfile.mkdtemp(prefix="gz-landed-")
    with open(os.path.join(path, "b.xml"), "w") as f:
        f.write(RSS.replace("<item><title>No summary</title><link>http://a/2</link><pubDate>Tue, 10 Jun 2025 04:00:00 GMT</pubDate></item>", ""))
    with open(os.path.join(path, "a.xml"), "w") as f:
        f.write(ATOM)
    # registration order puts b.xml first although a.xml sorts first by name
    sources = spark.createDataFrame([(0, "b.xml", "Bee"), (1, "a.xml", "Ay")], "source_ord int, url string, name string")
    arts = read_feeds(spark, path, sources).orderBy("seq").collect()
    assert [(a.source, a.title) for a in arts] == [("Bee", "A & B"), ("Ay", "E")]
    dense = assign_seq(parse_feeds(read_feed_files(spark, path)), sources, dense=True).orderBy("seq_dense").collect()
    assert [d.seq_dense for d in dense] == [1, 2] and dense[0].source == "Bee"
