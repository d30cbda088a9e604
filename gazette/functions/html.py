"""Page extraction as column expressions over one token array per page.

A page is cut once into its markup and the text between: ``tags`` has a struct for each
start and end tag (place, name, +1 or -1, classes, id), ``nodes`` the text behind each
piece of markup, with character references decoded.  Comments and ``script``,
``style`` and ``template`` elements are one piece of markup with all they hold.  Quotes
are respected: a ``>`` in an attribute ends nothing.

Elements are found by bracket matching over that array.  The depth at each tag is a
running sum; a start tag ends at the next end tag of its name and depth, an end tag
without a start is ignored, and an element without an end reaches to the end of the page.
Sorted by depth, each start is followed by its end, so all elements of a name are
matched by one sort, and what lies inside any of many elements is found by a running sum
over their edges.  Time follows the length of the page (running sums over ``n`` tags in
blocks of ``sqrt(n)``), however deep it nests and however many elements match; there is no
recursion, no Python worker and no shuffle.

Known limits of this form: an element is not ended by its parent's end tag, and a
``template`` ends at the first end tag of its name.  A tag that the page's end cuts off is
not text.  A NULL page gives NULLs.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazette.functions.text import WINDOWS_1252, strip
from gazette.functions.urls import resolve_src

# Page rules (live path).
ARTICLE_SELECTORS = ["article", "div.article", "div.post", "div.entry", "div.content", "div.main", "main"]
IMAGE_META_SELECTORS = [
    'meta[property="og:image"]',
    'meta[name="twitter:image"]',
    'meta[property="og:image:secure_url"]',
    'meta[property="og:image:url"]',
]
COMMENT_SELECTORS = [
    "div.comments", "div.comment", "div#comments", "section.comments", "article.comment",
    "div.discussion", "div#discussion", "div.feedback", "div#feedback",
]

# Domain-rule path (domain substring → content selector, in order).
DOMAIN_CONTENT_RULES = [
    ("nytimes.com", "article"),
    ("techcrunch.com", "main.template-content"),
    ("vox.com", ".c-entry-content"),
    ("theatlantic.com", "article"),
]
GENERIC_CONTENT_SELECTORS = [
    "article", "main", ".post-content", ".article-content", ".story-body", ".entry-content", "#content", ".content",
]
REMOVED_TAGS = ["nav", "header", "footer"]
REMOVED_CLASSES = ["ad", "advertisement"]

# Domain-rule images.
GENERIC_IMAGE_SELECTORS = [
    'meta[property="og:image"]',
    'meta[name="twitter:image"]',
    "img.featured-image",
    "img.article-image",
    'img[class*="hero"]',
    'img[class*="featured"]',
]
TECHCRUNCH = "techcrunch.com"
TECHCRUNCH_IMAGE_SELECTORS = [
    "img.attachment-post-thumbnail.size-post-thumbnail.wp-post-image",
    "img.wp-post-image",
    "img.featured-image",
    'img[class*="post-thumbnail"]',
]
TECHCRUNCH_BODY, TECHCRUNCH_PATHS = "main.template-content", ["wp-content", "techcrunch"]
SKIP_IMAGE_WORDS = ["icon", "logo", "avatar", "author"]
SKIP_AUTHOR_WORDS = ["author", "avatar"]

Predicate = Callable[[Column], Column]

# a quote opens a value only behind "="; possessive, so that nothing is tried twice
_INSIDE = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
MARKUP = rf"(?is)<!--.*?(?:-->|\z)|<(script|style|template)(?=[\s/>]){_INSIDE}>.*?(?:</\1\s*+>|\z)|</?[a-z]{_INSIDE}>|<[!?][^>]*+>"
_NAME = r"^</?([a-zA-Z][^\s/>]*+)"
_REFERENCE = r"^((?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31})(?![a-zA-Z0-9]);?)"
_NO_ELEMENTS = ["script", "style", "template", ""]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once for the row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _raw_attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a start tag as it stands there; empty without a value, NULL without the attribute."""
    other = rf"""(?:[\s/]*+(?!{name}[\s=/>])[^\s=/>]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+)*+"""
    pattern = rf"""(?is)^<[a-z][^\s/>]*+{other}[\s/]*+({name}(?=[\s=/>])(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+)"""

    def unquoted(v: Column) -> Column:
        return F.when(v.rlike("^[\"']"), F.substr(v, F.lit(2), F.length(v) - 2)).otherwise(v)

    found = F.regexp_extract(tag, pattern, 1)
    return F.when(F.contains(F.lower(tag), F.lit(name)), _let(found, lambda m: F.when(m != "", unquoted(F.regexp_replace(m, r"(?s)^[^=]*+(?:=\s*+)?+", "")))))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a start tag, references decoded; NULL where the tag lacks it."""
    return decoded(_raw_attribute(tag, name))


def decoded(text: Column) -> Column:
    """Character references replaced, with or without a semicolon; unknown ones stay."""
    names = F.create_map(*[F.lit(x) for name, point in name2codepoint.items() for x in (name, chr(point))])

    def of(part: Column) -> Column:
        def put(found: Column) -> Column:
            ref = F.rtrim(found, F.lit(";"))
            base16 = F.lower(F.substring(ref, 2, 1)) == "x"
            point = F.when(base16, F.conv(F.substring(ref, 3, 6), 16, 10)).otherwise(F.substring(ref, 2, 7)).cast("int")
            real = point.between(1, 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
            number = F.when(real, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
            value = F.when(ref.startswith("#"), F.translate(number, *WINDOWS_1252)).otherwise(F.try_element_at(names, ref))
            return F.when((ref == "") | value.isNull(), F.concat(F.lit("&"), part)).otherwise(F.concat(value, F.substr(part, F.length(found) + 1)))

        return _let(F.regexp_extract(part, _REFERENCE, 1), put)

    whole = lambda p: F.concat(p[0], F.array_join(F.transform(F.slice(p, F.lit(2), F.size(p)), of), ""))
    return F.when(F.contains(text, F.lit("&")), _let(F.split(text, "&", -1), whole)).otherwise(text)


def parsed(html: Column) -> Column:
    """``struct(nodes, tags, pieces)`` of a page: node ``k`` stands behind the ``k``-th piece of markup (0: before
    any), tags are at 1 to ``pieces``."""

    def tag(raw: Column, i: Column) -> Column:
        classes = F.concat(F.lit(" "), F.regexp_replace(_raw_attribute(raw, "class"), r"\s+", " "), F.lit(" "))
        step = F.when(raw.startswith("</"), -1).when(raw.endswith("/>"), 0).otherwise(1)
        return F.struct(
            (i + 1).alias("at"), F.lower(F.regexp_extract(raw, _NAME, 1)).alias("name"), step.alias("step"),
            F.coalesce(classes, F.lit("")).alias("classes"), F.coalesce(_raw_attribute(raw, "id"), F.lit("")).alias("id"), raw.alias("raw"),
        )

    # a tag that the page's end cuts off is markup: ended here, so that no "<" looks for an end in vain
    cut_off = F.substring_index(html, ">", -1).rlike("<[a-zA-Z/!?]")
    html = F.when(cut_off, F.concat(html, F.lit(">"))).otherwise(html)
    markup = F.regexp_extract_all(html, F.lit(MARKUP), F.lit(0))
    nodes = F.transform(F.split(html, MARKUP, -1), decoded)
    tags = lambda m: F.filter(F.transform(m, tag), lambda t: ~t["name"].isin(_NO_ELEMENTS))
    return F.when(html.isNotNull(), _let(markup, lambda m: F.struct(nodes.alias("nodes"), tags(m).alias("tags"), F.size(m).alias("pieces"))))


def selector(css: str) -> Predicate:
    """Whether a start tag fits ``tag``, ``.class``, ``#id``, ``[attr="v"]`` or ``[attr*="v"]``, or several of them."""
    m = re.fullmatch(r"(\w*)((?:[.#][\w-]+)*)(?:\[([\w:-]+)(\*?=)\"([^\"]*)\"\])?", css)
    if not m:
        raise ValueError(f"unsupported selector {css!r}")
    tag, marks, name, how, value = m.groups()

    def fits(t: Column) -> Column:
        out = t["step"] >= 0
        if tag:
            out = (t["name"] == tag) & out
        for kind, word in re.findall(r"([.#])([\w-]+)", marks):
            out = out & (F.contains(t["classes"], F.lit(f" {word} ")) if kind == "." else t["id"] == word)
        if name:
            own = attribute(t["raw"], name)
            out = out & F.contains(t["raw"], F.lit(value)) & F.coalesce(own == value if how == "=" else F.contains(own, F.lit(value)), F.lit(False))
        return out

    return fits


def any_of(*css: str) -> Predicate:
    tests = [selector(c) for c in css]

    def fits(t: Column) -> Column:
        out = tests[0](t)
        for test in tests[1:]:
            out = out | test(t)
        return out

    return fits


def first(page: Column, fits: Predicate) -> Column:
    """The first start tag that fits; NULL without one."""
    return F.get(F.filter(page["tags"], fits), F.lit(0))


def element(page: Column, start: Column) -> Column:
    """``struct(at, end)`` of the element that a start tag opens: its tags lie between; NULL without a start."""

    def reach(x: Column) -> Column:
        after = F.filter(page["tags"], lambda t: (t["at"] > x["at"]) & (t["name"] == x["name"]) & (t["step"] != 0))
        none = F.struct(F.lit(1).alias("open"), (page["pieces"] + 1).alias("end"))
        step = lambda s, t: F.struct((s["open"] + t["step"]).alias("open"), F.when(s["open"] + t["step"] == 0, t["at"]).otherwise(s["end"]).alias("end"))
        walked = F.aggregate(after, none, lambda s, t: F.when(s["open"] == 0, s).otherwise(step(s, t)))
        return F.when(x.isNotNull(), F.struct(x["at"].alias("at"), F.when(x["step"] == 0, x["at"]).otherwise(walked["end"]).alias("end")))

    return _let(start, reach)


def _held(page: Column, e: Column) -> Column:
    return F.slice(page["nodes"], e["at"] + 1, e["end"] - e["at"])


def _joined(nodes: Column, by: str) -> Column:
    return F.array_join(F.filter(F.transform(nodes, strip), lambda t: t != ""), by)


def text_of(page: Column, e: Column, by: str) -> Column:
    """The non-empty text nodes of an element."""
    return _let(e, lambda x: F.when(x.isNotNull(), _joined(_held(page, x), by)))


def _sums(events: Column) -> Column:
    """The sum of the steps before each event (a struct with ``step``), where a sum below 0 counts as 0.

    In blocks of ``sqrt(n)``: a block's sums follow from the sum before it as ``greatest(low, before + add)``."""
    place, pair = "struct<low:int,add:int>", lambda low, add: F.struct(low.cast("int").alias("low"), add.cast("int").alias("add"))

    def block(part: Column) -> Column:
        zero = F.struct(F.array().cast(f"array<{place}>").alias("each"), pair(F.lit(0), F.lit(0)).alias("all"))
        step = lambda s, e: F.struct(
            F.array_append(s["each"], s["all"]).alias("each"), pair(F.greatest(s["all"]["low"] + e["step"], F.lit(0)), s["all"]["add"] + e["step"]).alias("all")
        )
        return F.aggregate(part, zero, step)

    def joined(v: Column) -> Column:
        before = F.aggregate(
            v["blocks"],
            F.struct(F.array().cast("array<int>").alias("each"), F.lit(0).alias("all")),
            lambda s, b: F.struct(F.array_append(s["each"], s["all"]).alias("each"), F.greatest(b["all"]["low"], s["all"] + b["all"]["add"]).alias("all")),
        )["each"]
        flat = F.flatten(F.transform(v["blocks"], lambda b: b["each"]))
        return _let(before, lambda at: F.transform(flat, lambda x, i: F.greatest(x["low"], F.get(at, F.floor(i / v["width"]).cast("int")) + x["add"])))

    width = F.greatest(F.ceil(F.sqrt(F.size(events))), F.lit(1)).cast("int")
    blocks = lambda w: F.transform(F.sequence(F.lit(0), F.floor((F.size(events) - 1) / w).cast("int")), lambda b: block(F.slice(events, b * w + 1, w)))
    some = _let(width, lambda w: _let(F.struct(blocks(w).alias("blocks"), w.alias("width")), joined))
    return F.when(F.size(events) > 0, some).otherwise(F.array().cast("array<int>"))


def elements(page: Column, names: Column) -> Column:
    """All elements of the tag names in an array: their start tags and ``end``, in the order of their starts."""

    def of(name: Column) -> Column:
        def matched(v: Column) -> Column:
            levels = F.transform(v["own"], lambda t, i: F.struct((F.get(v["sums"], i) + F.when(t["step"] == 1, 1).otherwise(0)).alias("level"), t.alias("tag")))
            known = F.filter(levels, lambda m: m["level"] > 0)  # an end without a start has level 0

            def pairs(m: Column) -> Column:
                after = lambda i: F.get(m, i + 1)
                end = lambda x, i: F.when(after(i)["level"] == x["level"], after(i)["tag"]["at"]).otherwise(page["pieces"] + 1)
                return F.transform(m, lambda x, i: F.struct(x["tag"]["at"].alias("at"), end(x, i).alias("end"), *[x["tag"][c].alias(c) for c in ("name", "step", "classes", "id", "raw")]))

            return F.filter(_let(F.array_sort(known), pairs), lambda e: e["step"] == 1)

        own = F.filter(page["tags"], lambda t: (t["name"] == name) & (t["step"] != 0))
        return _let(own, lambda o: _let(F.struct(o.alias("own"), _sums(o).alias("sums")), matched))

    return F.array_sort(F.flatten(F.transform(names, of)))


def _depths(spans: Column, points: Column) -> Column:
    """``struct(depth, text)`` of each point (``struct(at, text)``) in order: in how many spans (``at`` to ``end``)
    it lies.  A point at ``k`` is what stands behind the ``k``-th piece of markup, or that piece."""
    edge = lambda at, step: F.struct((2 * at).alias("key"), F.lit(step).alias("step"), F.lit(None).cast("string").alias("text"))
    events = F.concat(
        F.transform(spans, lambda s: edge(s["at"], 1)),
        F.transform(spans, lambda s: edge(s["end"], -1)),
        F.transform(points, lambda p: F.struct((2 * p["at"] + 1).alias("key"), F.lit(0).alias("step"), p["text"].alias("text"))),
    )
    both = lambda v: F.transform(v["events"], lambda e, i: F.struct(F.get(v["sums"], i).alias("depth"), e["step"].alias("step"), e["text"].alias("text")))
    summed = _let(F.array_sort(events), lambda e: _let(F.struct(e.alias("events"), _sums(e).alias("sums")), both))
    return F.filter(summed, lambda e: e["step"] == 0)


def page_title(page: Column) -> Column:
    """Text of the first ``title``, blanks at its edges included."""
    held = lambda p: _let(element(p, first(p, selector("title"))), lambda e: F.when(e.isNotNull(), F.array_join(_held(p, e), "")))
    return _let(page, held)


def page_text(page: Column) -> Column:
    """Live-path page text: first existing container of the ordered list, else body."""

    def text(p: Column) -> Column:
        container = F.coalesce(*[first(p, selector(css)) for css in ARTICLE_SELECTORS])
        body = text_of(p, element(p, first(p, selector("body"))), "\n")
        return _let(text_of(p, element(p, container), "\n"), lambda t: F.when(t != "", t).otherwise(body))

    return _let(page, text)


def _sources(page: Column) -> Column:
    """``struct(at, text)`` of the non-empty ``src`` of all images, in order."""
    images = F.filter(page["tags"], selector("img"))
    return F.filter(F.transform(images, lambda t: F.struct(t["at"].alias("at"), attribute(t["raw"], "src").alias("text"))), lambda s: s["text"] != "")


def page_image(page: Column, url: Column) -> Column:
    """First non-empty image of the meta kinds, verbatim, else the first image of the page, resolved."""

    def image(p: Column) -> Column:
        metas = F.array(*[F.struct(first(p, selector(css))["raw"].alias("raw")) for css in IMAGE_META_SELECTORS])
        given = F.filter(F.transform(metas, lambda m: attribute(m["raw"], "content")), lambda c: c != "")
        return F.coalesce(F.get(given, F.lit(0)), resolve_src(url, F.get(_sources(p), F.lit(0))["text"]))

    return _let(page, image)


def page_comments(page: Column) -> Column:
    """Texts of all elements of the comment selectors, nested ones repeated; NULL without any."""
    names = sorted({re.match(r"\w+", css)[0] for css in COMMENT_SELECTORS})
    kinds = [(i, selector(css)) for i, css in enumerate(COMMENT_SELECTORS)]

    def texts(p: Column) -> Column:
        found = lambda e: F.filter(F.array(*[F.when(fits(e), i) for i, fits in kinds]), lambda i: i.isNotNull())
        each = F.transform(elements(p, F.array(*map(F.lit, names))), lambda e: F.transform(found(e), lambda i: F.struct(i.alias("kind"), e["at"].alias("at"), e["end"].alias("end"))))
        said = F.filter(F.transform(F.array_sort(F.flatten(each)), lambda e: _joined(_held(p, e), " ")), lambda t: t != "")
        return F.when(F.exists(p["tags"], any_of(*COMMENT_SELECTORS)), _let(said, lambda t: F.when(F.size(t) > 0, F.array_join(t, "\n\n"))))

    return _let(page, texts)


def domain_text(page: Column, domain: Column) -> Column:
    """Domain-rule text: a matching domain rule decides alone (a miss is NULL)."""
    removed = any_of(*REMOVED_TAGS, *[f".{c}" for c in REMOVED_CLASSES])

    def text(p: Column) -> Column:
        container = F.coalesce(*[first(p, selector(css)) for css in GENERIC_CONTENT_SELECTORS])
        for needle, css in reversed(DOMAIN_CONTENT_RULES):
            container = F.when(F.contains(domain, F.lit(needle)), first(p, selector(css))).otherwise(container)

        def kept(e: Column) -> Column:
            within = lambda t: (t["at"] > e["at"]) & (t["at"] < e["end"])
            names = F.array_distinct(F.transform(F.filter(p["tags"], lambda t: within(t) & removed(t)), lambda t: t["name"]))
            out = F.filter(elements(p, names), lambda x: within(x) & removed(x))
            nodes = F.filter(F.transform(_held(p, e), lambda t, i: F.struct((e["at"] + i).alias("at"), strip(t).alias("text"))), lambda t: t["text"] != "")
            left = F.filter(_depths(out, nodes), lambda x: x["depth"] == 0)
            lines = F.split(F.array_join(F.transform(left, lambda x: x["text"]), "\n"), "\n", -1)
            return F.when(e.isNotNull(), _joined(lines, "\n"))

        return _let(element(p, container), kept)

    return _let(page, text)


def domain_image(page: Column, domain: Column) -> Column:
    """Domain-rule image, by the table of rules above."""
    free_of = lambda words: lambda src: ~F.lower(src).rlike("|".join(words))

    def inside(p: Column, css: list[str], wanted: Predicate) -> Column:
        """The first image wanted inside an element of the selectors."""
        names = F.array(*[F.lit(re.match(r"\w+", c)[0]) for c in css])
        spans = F.filter(elements(p, names), any_of(*css))
        return F.get(F.filter(_depths(spans, _sources(p)), lambda x: (x["depth"] > 0) & wanted(x["text"])), F.lit(0))["text"]

    def image(p: Column) -> Column:
        shown = F.array(*[F.struct(first(p, selector(css))["raw"].alias("raw")) for css in TECHCRUNCH_IMAGE_SELECTORS])
        featured = F.filter(F.transform(shown, lambda x: attribute(x["raw"], "src")), lambda s: (s != "") & free_of(SKIP_AUTHOR_WORDS)(s))
        hosted = inside(p, [TECHCRUNCH_BODY], lambda s: s.rlike("|".join(TECHCRUNCH_PATHS)) & free_of(SKIP_AUTHOR_WORDS)(s))
        # elsewhere the first kind of element that exists decides, with or without the attribute
        kind = F.coalesce(*[first(p, selector(css)) for css in GENERIC_IMAGE_SELECTORS])
        given = _let(kind, lambda t: F.when(t["name"] == "meta", attribute(t["raw"], "content")).otherwise(attribute(t["raw"], "src")))
        other = F.when(kind.isNotNull(), given).otherwise(inside(p, ["article", "main"], free_of(SKIP_IMAGE_WORDS)))
        return F.when(F.contains(domain, F.lit(TECHCRUNCH)), F.coalesce(F.get(featured, F.lit(0)), hosted)).otherwise(other)

    return _let(page, image)
