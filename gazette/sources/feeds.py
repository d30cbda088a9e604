"""Feed scan (RSS 2.0, RSS 1.0 / RDF, Atom), entry mapping, per-feed fault isolation and
arrival order.

Landed feed files are read whole (``wholetext``) and parsed with ``from_xml``,
which keeps the entry ordinal (``posexplode``) and the feed membership that a
``rowTag='item'`` scan would lose.  Namespaces stay on, so prefixed tags such as
``slash:comments`` never shadow ``comments``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.functions.text import WINDOWS_1252
from gazette.plans.positions import positions

RSS_SCHEMA = (
    "channel STRUCT<title: STRING, item: ARRAY<STRUCT<title: STRING, link: STRING, pubDate: STRING, "
    "description: STRING, comments: STRING, comments_link: STRING, comments_url: STRING>>>"
)
ATOM_SCHEMA = (
    "title STRING, entry ARRAY<STRUCT<title: STRING, link: ARRAY<STRUCT<_href: STRING, _rel: STRING>>, "
    "published: STRING, updated: STRING, summary: STRING, comments: STRING>>"
)
RDF_SCHEMA = (
    "item ARRAY<STRUCT<title: STRING, link: STRING, `dc:date`: STRING, date: STRING, description: STRING, comments: STRING>>"
)

# Date layouts tried in order (RFC 822 numeric zone, RFC 822 zone
# name, then ISO 8601 via the default parser).
RFC822_NUMERIC = "d MMM yyyy HH:mm:ss Z"
RFC822_NAMED = "d MMM yyyy HH:mm:ss z"

# Bits reserved for the entry ordinal inside the packed arrival key.
ENTRY_BITS = 32


def parse_feed_date(col: Column) -> Column:
    """RFC 822 (with weekday, numeric offset or zone name) or ISO 8601 → UTC timestamp."""
    stripped = F.trim(F.regexp_replace(col, r"^[A-Za-z]+,\s*", ""))
    return F.coalesce(
        F.try_to_timestamp(stripped, F.lit(RFC822_NUMERIC)),
        F.try_to_timestamp(stripped, F.lit(RFC822_NAMED)),
        F.try_to_timestamp(stripped),
    )


def _root_is(text: Column, name: str) -> Column:
    """Whether the first element of a document has this local name."""
    root = F.regexp_extract(text, r"(?s)\A\uFEFF?(?:\s|<\?.*?\?>|<!--.*?-->|<![^>]*>)*+<(?:[\w.-]+:)?([\w.-]+)", 1)
    return root == name


ENTRY = "array<struct<title:string,link:string,pubDate:string,description:string,comments:string,comments_link:string,comments_url:string>>"


def _entries(text: Column) -> Column:
    """The entries of a feed document of any of the three shapes, as one array; NULL if it can't be read."""
    options = {"mode": "PERMISSIVE"}
    rss, atom, rdf = (F.from_xml(text, schema, options) for schema in (RSS_SCHEMA, ATOM_SCHEMA, RDF_SCHEMA))
    nothing = F.lit(None).cast("string")

    def of_atom(e: Column) -> Column:
        alternate = F.filter(e["link"], lambda l: F.coalesce(l["_rel"], F.lit("alternate")) == "alternate")
        link = F.coalesce(F.get(alternate, F.lit(0))["_href"], F.get(e["link"], F.lit(0))["_href"])
        return F.struct(e["title"], link, F.coalesce(e["published"], e["updated"]), e["summary"], e["comments"], nothing, nothing)

    def of_rdf(e: Column) -> Column:
        return F.struct(e["title"], e["link"], F.coalesce(e["dc:date"], e["date"]), e["description"], e["comments"], nothing, nothing)

    return (
        F.when(_root_is(text, "feed"), F.transform(atom["entry"], of_atom).cast(ENTRY))
        .when(_root_is(text, "RDF"), F.transform(rdf["item"], of_rdf).cast(ENTRY))
        .otherwise(rss["channel"]["item"].cast(ENTRY))
    )


def _complete(e: Column) -> Column:
    return e["title"].isNotNull() & e["link"].isNotNull() & e["pubDate"].isNotNull() & e["description"].isNotNull()


def parse_feeds(files: DataFrame, content_col: str = "value", feed_col: str = "feed") -> DataFrame:
    """One row per feed entry: (feed, entry_ord, title, link, published, summary,
    comments_link, entry_ok, feed_ok); ``feed_ok`` is false when any entry of
    the feed is incomplete.

    RSS 2.0, RSS 1.0 (RDF) and Atom are told apart by their root element.
    ``entry_ok`` is false when title, link, date or summary is missing; a feed
    whose XML does not parse yields no entries (``feed_counts`` lists it).
    """
    # each file is parsed once: both uses below read the bound array.  The whole feed is one
    # row here, so "any bad entry drops the feed" is an array predicate — no shuffle, valid on a stream
    bound = F.explode(F.array(_entries(F.col(content_col)))).alias("_entries")
    parsed = files.select(F.col(feed_col).alias("feed"), bound)
    exploded = parsed.select("feed", F.coalesce(F.forall("_entries", _complete), F.lit(False)).alias("feed_ok"), F.posexplode("_entries").alias("entry_ord", "e"))
    e = F.col("e")
    return exploded.select(
        "feed",
        F.col("entry_ord").cast("long").alias("entry_ord"),
        e["title"].alias("title"),
        e["link"].alias("link"),
        parse_feed_date(e["pubDate"]).alias("published"),
        e["description"].alias("summary"),
        # presence, not emptiness: an empty <comments/> still wins
        F.coalesce(e["comments"], e["comments_link"], e["comments_url"]).alias("comments_link"),
        _complete(e).alias("entry_ok"),
        "feed_ok",
    )


def feed_counts(files: DataFrame, content_col: str = "value", feed_col: str = "feed") -> DataFrame:
    """``(feed, parsed, n_entries, n_complete)`` of every landed file, unreadable ones included."""
    entries = files.select(F.col(feed_col).alias("feed"), F.explode(F.array(_entries(F.col(content_col)))).alias("_entries"))
    n = F.coalesce(F.size("_entries"), F.lit(0))
    complete = F.coalesce(F.size(F.filter("_entries", _complete)), F.lit(0))
    return entries.select(
        "feed",
        F.col("_entries").isNotNull().alias("parsed"),
        F.when(F.col("_entries").isNotNull(), n).otherwise(0).cast("long").alias("n_entries"),
        F.when(F.col("_entries").isNotNull(), complete).otherwise(0).cast("long").alias("n_complete"),
    )


def isolate_feeds(entries: DataFrame, on_bad_entry: str = "drop_feed") -> DataFrame:
    """``drop_feed``: one bad entry empties its whole feed (parity);
    ``drop_entry``: only the bad entry goes."""
    if on_bad_entry == "drop_entry":
        return entries.filter("entry_ok")
    if on_bad_entry != "drop_feed":
        raise ValueError(on_bad_entry)
    return entries.filter("feed_ok")


#: Declared encodings that the engine decodes; others are read as UTF-8.  windows-1252 is Latin-1
#: but for what its bytes 80 to 9F show.
ENCODINGS = {"iso-8859-1": "ISO-8859-1", "latin1": "ISO-8859-1", "us-ascii": "US-ASCII", "utf-16": "UTF-16", "utf-16le": "UTF-16LE", "utf-16be": "UTF-16BE"}
WINDOWS = ["windows-1252", "cp1252", "x-cp1252"]


def decoded_files(files: DataFrame, feed: Column | None = None) -> DataFrame:
    """``(feed, value)`` of binary files: the file name (or ``feed``), and its text by the encoding that
    the byte order mark or the XML declaration names."""
    plain = F.decode(F.substring("content", 1, 200), "ISO-8859-1")
    named = F.lower(F.regexp_extract(plain, r"^<\?xml[^>]*encoding=[\"']([^\"']+)", 1))
    marked = F.hex(F.substring("content", 1, 2)).isin("FFFE", "FEFF")
    text = F.when(named.isin(WINDOWS), F.translate(F.decode("content", "ISO-8859-1"), *WINDOWS_1252)).otherwise(F.decode("content", "UTF-8"))
    for name, charset in ENCODINGS.items():
        text = F.when(named == name, F.decode("content", charset)).otherwise(text)
    text = F.when(marked, F.decode("content", "UTF-16")).otherwise(text)
    name = F.element_at(F.split("path", "/"), -1) if feed is None else feed
    return files.select(name.alias("feed"), F.regexp_replace(text, r"\A\uFEFF", "").alias("value"))


def read_feed_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed XML files, one row per file: (feed = file name, value)."""
    return decoded_files(spark.read.format("binaryFile").load(path))


def read_feeds(
    spark: SparkSession,
    path: str,
    sources: DataFrame,
    digest_id: str | Column = "feeds",
    on_bad_entry: str = "drop_feed",
) -> DataFrame:
    """Landed feeds → canonical articles; ``sources`` maps feed file/URL to name."""
    entries = isolate_feeds(parse_feeds(read_feed_files(spark, path)), on_bad_entry)
    return assign_seq(entries, sources, digest_id=digest_id)


def assign_seq(
    entries: DataFrame,
    sources: DataFrame,
    digest_id: str | Column = "feeds",
    feed_key: str = "feed",
    dense: bool = False,
) -> DataFrame:
    """Attach source names (``sources.url`` matches ``feed_key``) and the arrival
    key: registration order of the source, then entry order.

    The default key packs ``(source_ord, entry_ord)`` into one long — order
    preserving, no shuffle.  ``dense=True`` numbers 1..n per digest with the
    range-partitioned :func:`positions` (no single-task window).
    """
    src = sources.select(F.col("url").alias(feed_key), "source_ord", F.col("name").alias("source"))
    dig = F.lit(digest_id) if isinstance(digest_id, str) else digest_id
    df = entries.join(src, feed_key).withColumn("digest_id", dig)
    df = df.withColumn(
        "seq", F.shiftleft(F.col("source_ord").cast("long"), ENTRY_BITS) + F.col("entry_ord").cast("long")
    )
    if dense:
        df = positions(df, "digest_id", ["source_ord", "entry_ord"], out="seq_dense")
    return df


def read_all(spark: SparkSession, sources: Sequence[tuple[str, Callable[[SparkSession], DataFrame]]], digest_id: str = "feeds") -> DataFrame:
    """Articles of any sources, in the order in which they are named.

    A source is a name and a callable that returns entries ``(entry_ord, title, link,
    published, summary, comments_link)`` from wherever it likes; rows lacking a title,
    link, date or summary are left out, as in feeds.
    """
    out = None
    for place, (name, read) in enumerate(sources):
        e = read(spark)
        part = e.filter(_complete(F.struct("title", "link", F.col("published").alias("pubDate"), F.col("summary").alias("description")))).select(
            F.lit(digest_id).alias("digest_id"),
            (F.shiftleft(F.lit(place).cast("long"), ENTRY_BITS) + F.col("entry_ord").cast("long")).alias("seq"),
            "title", "link", "published", "summary", F.lit(name).alias("source"), "comments_link",
        )
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no sources")
    return out
