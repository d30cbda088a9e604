"""Landed pages → extracted fields, as column expressions over the page's text.

Each page is one row from scan to output: no shuffle, no Python worker, and only
the extracted columns (never the raw HTML) flow into later joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.functions import html as H
from gazette.functions.urls import url_domain

FIELDS = ("title", "text", "image_url", "comments", "text_rules", "image_rules")


def extract_pages(
    pages: DataFrame,
    url: str = "url",
    html: str = "html",
    keep: Sequence[str] = (),
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """``(keep…, url, <fields>)`` with fields from ``title, text, image_url,
    comments, text_rules, image_rules`` (all by default).

    ``text``/``image_url``/``comments`` follow the live page rules;
    ``text_rules``/``image_rules`` the per-domain rules (domain = URL authority).
    """
    keep = [c for c in keep if c not in (url, html)]
    base = pages.select(*keep, F.col(url).alias("url"), F.col(html).alias("_html"))
    page, at, domain = F.col("_page"), F.col("url"), F.coalesce(url_domain("url"), F.lit(""))
    made = {
        "title": lambda: H.page_title(page),
        "text": lambda: H.page_text(page),
        "image_url": lambda: H.page_image(page, at),
        "comments": lambda: H.page_comments(page),
        "text_rules": lambda: H.domain_text(page, domain),
        "image_rules": lambda: H.domain_image(page, domain),
    }
    cut = base.withColumn("_page", H.parsed(F.col("_html")))
    return cut.select(*keep, "url", *[made[f]().alias(f) for f in FIELDS if fields is None or f in fields])
