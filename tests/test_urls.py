from urllib.parse import urlparse, urlunparse

from pyspark.sql import functions as F

from gazette.functions.urls import clean_url, resolve_src, url_domain

URLS = [
    "http://Example.com/a/b?x=1#f",
    "HTTPS://user:pw@host:8080/p;params?q",
    "https://host/path;a/b;c#frag",
    "ftp://h",
    "//cdn.example.com/img.png",
    "no-scheme/path?x",
]


def _py_clean(u):
    p = urlparse(u)
    return urlunparse((p.scheme, p.netloc, p.path, "", "", ""))


def test_clean_and_domain_match_stdlib(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "u string")
    got = df.select("u", clean_url("u").alias("c"), url_domain("u").alias("d")).collect()
    for r in got:
        assert r.c == _py_clean(r.u), r.u
        assert r.d == urlparse(r.u).netloc, r.u


def test_resolve_src_parity_and_strict(spark):
    base = "https://host.example/x/y"
    cases = ["img/a.png", "/a.png", "//cdn/a.png", "data:image/png;base64,AA", "http://o/a.png"]
    df = spark.createDataFrame([(base, s) for s in cases], "u string, s string")
    got = {r.s: (r.p, r.k) for r in df.select("s", resolve_src("u", "s").alias("p"), resolve_src("u", "s", strict=True).alias("k")).collect()}
    assert got["img/a.png"] == ("https://host.exampleimg/a.png", "https://host.example/img/a.png")
    assert got["//cdn/a.png"] == ("https://host.example//cdn/a.png", "https://cdn/a.png")
    assert got["data:image/png;base64,AA"][0] == "data:image/png;base64,AA"
    assert got["http://o/a.png"] == ("http://o/a.png", "http://o/a.png")
