"""Document fingerprints from SpotSigs.

Words are runs of letters and digits, lower-cased.  Common words are anchors; an
anchor directly before a content word starts a chain of that word and the next
content word, and anchor and chain make a spot signature.  A text's fingerprint is
its set of spot signatures: their distinct 32-bit hashes in order, eight hex digits
each.  Stretches that anchors do not cover add signatures of their own, whatever the
rest of the text holds: every three content words that follow each other without an
anchor between, every three anchors that do, and the two words of a text that begins
with just two before its first anchor.  So an edit adds and takes signatures but never
changes their kind, and no words go without one but a single word before the first
anchor, the first of just two anchors together and one or two anchors at the end.  A
text of such words only is one signature as a whole, and so is one without words: only
the empty text has an empty fingerprint.  Two fingerprints are as alike as the Jaccard
similarity of their sets; two empty ones are equal.

``near_pairs`` finds alike texts: sets are partitioned by length so that only sets
of one or of neighbouring partitions can reach the threshold, sets meet on the
rarest signatures of each (enough of them that two alike sets must share one), and
the pairs' lengths prune before the sets are compared.  No registered query calls it.

Everything is column expressions and joins; no text is cut short.

Defined cases: a NULL text is empty; documents of one ``doc_id`` are ordered by
text; a NULL ``doc_id`` comes first; with one document, the next document is the
document itself; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.llm.common import broadcast_if_small, materialize

# Common words of English, German, French and Spanish that serve as anchors.
ANCHORS = (
    "a an and are as at be been but by do for from had has have he her his i in is it not of on or she that the their they this to was we were which will with you "
    "auf aus bei das dem den der des die ein eine einen einer er es für im ist mit nicht sich sie sind über um und von war zu zum zur "
    "au aux ce cette dans de du elle en est et il la le les leur mais ne nous ou où par pas pour que qui sa se ses son sur un une vous "
    "al como con del el ella ellos entre esta este lo los las más muy no para pero por se si sin su sus una y"
).split()

#: Rows that are sorted together to find each document's successor.
ROWS_PER_RANGE = 1000
_MARK = "\x01"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once for the row."""
    return F.transform(F.array(value), body)[0]


def _tagged(words: Column) -> Column:
    """Each word with a mark behind it if it is an anchor, else a space."""
    return F.transform(words, lambda w: F.concat(w, F.when(w.isin(*ANCHORS), F.lit(_MARK)).otherwise(F.lit(" "))))


def _spots(tagged: Column) -> Column:
    """Hashes of anchor, content word and next content word, in order, NULL where no anchor stands."""

    def chains(tokens: Column) -> Column:
        following = F.slice(F.transform(tokens, lambda t: F.substring_index(t, _MARK, -1)), F.lit(2), F.size(tokens))
        return F.zip_with(
            tokens, following, lambda t, after: F.when(F.contains(t, F.lit(_MARK)), F.hash(F.substring_index(t, _MARK, -2), F.coalesce(after, F.lit(""))))
        )

    # the last token is what follows the last content word: nothing, or anchors without a chain
    return _let(F.split(F.array_join(tagged, ""), " "), lambda t: _let(F.slice(t, F.lit(1), F.size(t) - 1), chains))


def _plain(chain: Column) -> Column:
    return F.hash(F.rtrim(F.translate(chain, _MARK, " ")))


def _runs(tagged: Column) -> Column:
    """Hashes of every three words in a row that are all content or all anchors, else NULL."""
    two = F.zip_with(tagged, F.slice(tagged, F.lit(2), F.size(tagged)), lambda a, b: F.concat(a, b))
    three = F.zip_with(two, F.slice(tagged, F.lit(3), F.size(tagged)), lambda a, b: F.concat(a, b))
    return F.transform(three, lambda c: F.when(~F.contains(c, F.lit(_MARK)) | ~F.contains(c, F.lit(" ")), _plain(c)))


def _start(tagged: Column) -> Column:
    """Hash of two content words that begin a text and are followed by an anchor or nothing, else NULL."""
    two = F.concat(F.get(tagged, 0), F.get(tagged, 1))
    alone = ~F.contains(two, F.lit(_MARK)) & F.coalesce(F.contains(F.get(tagged, 2), F.lit(_MARK)), F.lit(True))
    return F.when(alone, _plain(two))


def signatures(text: Column) -> Column:
    """The set of signatures of a whole text, ascending ``array<int>``."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def of(t: Column) -> Column:
        whole = F.when(F.size(t) > 0, F.array(_plain(F.array_join(t, "")))).when(text != "", F.array(F.hash(text))).otherwise(F.array().cast("array<int>"))
        return _let(F.array_compact(F.concat(_spots(t), _runs(t), F.array(_start(t)))), lambda s: F.when(F.size(s) > 0, s).otherwise(whole))

    return F.sort_array(F.array_distinct(_let(_tagged(words), of)))


def fingerprint(signature_set: Column) -> Column:
    """Eight hex digits of each signature."""
    digits = F.transform(signature_set, lambda h: F.lpad(F.lower(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0"))
    return F.array_join(digits, "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets."""
    shared = F.size(F.array_intersect(a, b))
    whole = F.size(a) + F.size(b) - shared
    return F.when(whole > 0, shared / whole).otherwise(F.lit(1.0))


def with_next(docs: DataFrame, columns: dict[str, Callable[[], Column]], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``doc_id, text, *columns`` and ``next_*`` of the next row by ``doc_id`` (of the last: the first).

    The rows are cut into ranges of ``doc_id``, each sorted on its own; the first row
    of a range also goes to the range before it as a guest.  ``columns`` are computed
    once per row, behind the shuffle.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    at = F.coalesce(F.col("doc_id").cast("double"), F.lit(-1e300))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).withColumn("_at", at)
    count = ids.count()
    ranges = max(1, math.ceil(count / rows_per_range))
    cuts = ids.approxQuantile("_at", [i / ranges for i in range(1, ranges)], 0.1 / ranges) if ranges > 1 else []
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    splits = splits if len(splits) > 2 else [-math.inf, 0.0, math.inf]
    bucketizer = Bucketizer(splits=splits, inputCol="_at", outputCol="_range")
    firsts = bucketizer.transform(ids).groupBy("_range").agg(F.min("_at").alias("_first"))
    before = Window.orderBy("_range")  # one row per range
    last = firsts.agg(F.max("_range").alias("_last"))
    guests = materialize(
        firsts.crossJoin(F.broadcast(last)).select("_first", F.coalesce(F.lag("_range").over(before), F.col("_last")).alias("_host"))
    )
    own = F.struct(F.col("_range").cast("int").alias("range"), F.lit(False).alias("guest"))
    visit = F.struct(F.col("_host").cast("int").alias("range"), F.lit(True).alias("guest"))
    placed = bucketizer.transform(base.withColumn("_at", at)).join(broadcast_if_small(guests, guests.count()), F.col("_at") == F.col("_first"), "left")
    dealt = placed.select("doc_id", "text", F.explode(F.when(F.col("_host").isNull(), F.array(own)).otherwise(F.array(own, visit))).alias("_seat"))
    dealt = dealt.select("doc_id", "text", F.col("_seat.range").alias("_range"), F.col("_seat.guest").alias("_guest")).repartition("_range")
    made = dealt.select("*", *[make().alias(name) for name, make in columns.items()])
    order = Window.partitionBy("_range").orderBy("_guest", F.col("doc_id").asc_nulls_first(), "text")
    return made.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in ["text", *columns]]).where("NOT _guest").drop("_range", "_guest")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint, that of its edited text, and how alike they and the next one are."""
    seen = with_next(docs, {"spots": lambda: signatures(F.col("text"))})
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), (n - quarter).cast("int")), F.substr("next_text", F.lit(1), quarter))
    both = seen.select("doc_id", n.cast("long").alias("n_chars"), "spots", "next_spots", edited.alias("edited"))
    made = both.withColumn("edited_spots", signatures(F.col("edited")))
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("spots")).alias("fingerprint"),
        fingerprint(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )


def near_pairs(docs: DataFrame, least: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """Alike texts: ``(members, pairs)``.  ``members``: ``doc_id, rep``, the smallest id of an equal
    set; ``pairs``: ``a, b, likeness`` between representatives, a < b."""
    sets = materialize(docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), signatures(F.coalesce("text", F.lit(""))).alias("spots")))
    reps = materialize(sets.where(F.size("spots") > 0).groupBy("spots").agg(F.min("doc_id").alias("rep")))
    members = sets.join(reps, "spots", "left").select("doc_id", F.coalesce("rep", "doc_id").alias("rep"))
    spread = reps.select("rep", F.size("spots").alias("n"), F.explode("spots").alias("spot"))
    seen = spread.groupBy("spot").agg(F.count(F.lit(1)).alias("seen")).where("seen > 1")
    ranked = spread.join(seen, "spot", "left").withColumn("at", F.row_number().over(Window.partitionBy("rep").orderBy(F.coalesce("seen", F.lit(1)), "spot")))
    # two sets of the likeness share one of the first n - ceil(least * n) + 1, and their lengths' partitions are at most one apart
    part = F.floor(F.log("n") / math.log(1 / least) + 1e-9)
    prefix = ranked.where((F.col("seen") > 1) & (F.col("at") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1)).select("rep", "n", "spot", part.alias("part"))
    right = prefix.select(F.col("rep").alias("b"), F.col("n").alias("nb"), "spot", F.explode(F.array(F.col("part") - 1, F.col("part"), F.col("part") + 1)).alias("part"))
    met = prefix.withColumnsRenamed({"rep": "a", "n": "na"}).join(right, ["part", "spot"]).where("a < b")
    met = met.where(F.least("na", "nb") >= F.greatest("na", "nb") * least - 1e-9).select("a", "b").distinct()
    left, other = reps.select(F.col("rep").alias("a"), F.col("spots").alias("sa")), reps.select(F.col("rep").alias("b"), F.col("spots").alias("sb"))
    pairs = met.join(left, "a").join(other, "b").select("a", "b", likeness(F.col("sa"), F.col("sb")).alias("likeness"))
    return members, pairs.where(F.col("likeness") >= least)
