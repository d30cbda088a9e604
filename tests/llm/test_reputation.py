from pyspark.sql import functions as F

from gazette.llm import reputation as R

RULES = [R.Rule("block", "net"), R.Rule("allow", "example.net", "/en/"), R.Rule("block", "example.com", "/de/"), R.Rule("allow", "org", "/fr/")]
URLS = [
    (1, "http://Www.Example.NET/en/1?x#y", "www.example.net", "/en/1", "example.net/en/", "allow"),
    (2, "https://a.example.net/de/", "a.example.net", "/de/", "net/", "block"),
    (3, "https://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
    (4, "http://example.com/de/a", "example.com", "/de/a", "example.com/de/", "block"),
    (5, "http://example.com/en/a", "example.com", "/en/a", None, "allow"),
    (6, "ftp://x.org/fr/?a://b", "x.org", "/fr/", "org/fr/", "allow"),
    (7, None, "", "", None, "allow"),
    (8, "no scheme.net/", "", "", None, "allow"),
    (9, "http://example.net?en", "example.net", "", None, "allow"),
    (10, "://net/", "net", "/", "net/", "block"),
    (11, "a://b.net/x://c", "b.net", "/x://c", "net/", "block"),
    (12, "http://ÄB.org#f", "Äb.org", "", None, "allow"),
    (13, "", "", "", None, "allow"),
    (None, "http://x.com/\nfr", "x.com", "/\nfr", None, "allow"),
]


def pages(spark):
    return spark.createDataFrame([u[:2] for u in URLS], "page_id long, url string").selectExpr("*", "'z' AS host", "1 AS n", "2 AS bad", "'r' AS rule")


def test_hosts_paths_and_rules(spark):
    none = spark.createDataFrame([], "page_id long, bad int")
    got = R.judge(pages(spark), none, RULES)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    key = lambda t: (t[0] is None, t[0] or 0)
    assert sorted((tuple(r) for r in got.collect()), key=key) == [(u[0], *u[2:]) for u in URLS]
    assert R.judge(pages(spark).limit(0), none, RULES).count() == 0


def test_registered_domains(spark):
    hosts = ["a.b.example.co.uk", "example.com", "x.example.com:8080", "user@x.example.org", "10.0.0.1", "localhost", "", "co.uk"]
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    got = [tuple(r) for r in df.select(R.domain_of(F.col("h")), R.suffix_of(F.col("h"))).collect()]
    assert got == [("example.co.uk", "co.uk"), ("example.com", "com"), ("example.com", "com"), ("example.org", "org"), ("10.0.0.1", "10.0.0.1"), ("localhost", "localhost"), ("", ""), ("co.uk", "co.uk")]


def test_a_host_is_blocked_only_on_credible_evidence(spark):
    urls, marks = [], []

    def site(host, n, bad):
        for k in range(n):
            urls.append((len(urls), f"http://{host}/{k}"))
            marks.append((len(marks), int(k < bad)))

    site("bad.one.com", 200, 150)
    site("good.two.com", 200, 5)
    site("few.three.com", 2, 2)
    for k in range(30):
        site(f"h{k}.site{k}.com", 20, 2)
    site("new.one.com", 0, 0)
    urls.append((len(urls), "http://new.one.com/"))
    marks += [(None, 1), (3, None), (10**6, 1), (0, 1)]
    df = spark.createDataFrame(urls, "page_id long, url string")
    out = R.judge(df, spark.createDataFrame(marks, "page_id long, bad int"), [])
    verdicts = {r.host: r.verdict for r in out.select("host", "verdict").distinct().collect()}
    # two bad pages of two are not enough; a host of a bad domain inherits its reputation
    assert {h for h, v in verdicts.items() if v == "block"} == {"bad.one.com", "new.one.com"}
    assert len(verdicts) == 34


def test_means_lie_between_own_rate_and_prior(spark):
    hosts = spark.createDataFrame([("a.x.com", 100.0, 90.0), ("b.x.com", 2.0, 0.0), ("c.y.com", 100.0, 5.0), ("d.z.org", 50.0, 10.0), ("e.z.org", 0.0, 0.0)], "host string, n double, bad double")
    by = {r.host: r for r in R.reputations(hosts).collect()}
    assert by["a.x.com"].mean < 0.9 and by["c.y.com"].mean > 0.05 and 0 < by["b.x.com"].mean < by["a.x.com"].mean
    assert all(0 <= r.lower <= r.mean <= 1 for r in by.values())


def test_domains_by_the_whole_suffix_list(spark):
    want = {
        "a.shop.com.sg": ("shop.com.sg", "com.sg"),
        "x.uni.edu.au": ("uni.edu.au", "edu.au"),
        "me.github.io": ("me.github.io", "github.io"),
        "a.b.example.co.uk:80": ("example.co.uk", "co.uk"),
        "a.b.c.ck": ("b.c.ck", "c.ck"),  # *.ck
        "a.www.ck": ("www.ck", "ck"),  # !www.ck
        "a.city.kobe.jp": ("city.kobe.jp", "kobe.jp"),
        "a.b.x.kobe.jp": ("b.x.kobe.jp", "x.kobe.jp"),
        "a.b.unlisted-suffix": ("b.unlisted-suffix", "unlisted-suffix"),
        "a.shop.公司.cn": ("shop.公司.cn", "公司.cn"),
        "a.shop.xn--55qx5d.cn": ("shop.xn--55qx5d.cn", "xn--55qx5d.cn"),
        "www.example.com.": ("example.com", "com"),
        "github.io": ("github.io", "github.io"),
        "ck": ("ck", "ck"),
        "u@10.0.0.1:8": ("10.0.0.1", "10.0.0.1"),
        "": ("", ""),
    }
    df = spark.createDataFrame([(h,) for h in want], "host string")
    got = {r.host: (r.domain, r.suffix) for r in R.with_sites(df, R.listed_rules()).collect()}
    assert got == want
    assert len(R.listed_rules()) > 9000
    short = {r.host: r.domain for r in R.with_sites(df, R.suffix_rules(list(R.SECOND_LEVEL))).collect()}
    assert short["a.b.example.co.uk:80"] == "example.co.uk" and short["me.github.io"] == "github.io"
