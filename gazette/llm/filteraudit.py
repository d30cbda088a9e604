"""Which of several filters removes what, in every order of applying them.

Every row fails some subset of the filters.  One aggregate per part counts the rows of
each subset, as a bit mask; everything else is read from those counts.  The states of
a run are the subsets of filters already applied, a lattice; an edge applies one more
filter.  The orders that reach a state are counted forward from the empty set, those
that leave it backward from the full one; an edge lies on (reaching x leaving) orders,
so a filter's removals summed over all orders are its edges' removals in those weights
(divided by the number of orders: its Shapley value).  The steps of a single order are
its edges, with the same removals: no order is ever run over the rows.

Column expressions and joins only; the lattice itself is a few numbers on the driver.

Defined cases: a NULL text is the empty text; a condition that is NULL does not fail;
rows without a group value or with a clashing column name are parts like any other
(NULL part: empty string); a NULL ``doc_id`` is nobody's repeat and has no label; rows
repeat as often as they stand there; several label rows of an id count as one, good or
toxic if any is; an empty table gives no rows; texts of any length are judged whole.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Filters at most: the lattice has 2^n states, and the result a row for each step of n! orders.
MOST_FILTERS = 7

# What separates words, and the characters of condition D.
SEPARATORS = "\\x20\\x09-\\x0D"
MARKS = "[#$%&*|]"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_conditions(text: Column) -> dict[str, Column]:
    """Failure conditions A-D of a text that is not NULL; true fails."""
    words = F.filter(F.split(text, f"[{SEPARATORS}]+"), lambda w: w != "")
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike(MARKS),
    }


def lattice(n: int) -> list[tuple[int, int, int]]:
    """Edges ``(state, filter, orders)`` of the subsets of ``n`` filters: forward counts reach a state,
    backward counts leave it, and an edge lies on as many orders as their product."""
    full = (1 << n) - 1
    edges = [(s, f) for s in range(full + 1) for f in range(n) if not s >> f & 1]
    reach, leave = [1] + [0] * full, [0] * full + [1]
    for s, f in edges:  # ascending states: all that reach s are counted before it is left
        reach[s | 1 << f] += reach[s]
    for s, f in reversed(edges):
        leave[s] += leave[s | 1 << f]
    return [(s, f, reach[s] * leave[s | 1 << f]) for s, f in edges]


def mask(conditions: list[Column]) -> Column:
    """Bit ``i`` is set where condition ``i`` holds."""
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)]
    return sum(bits[1:], bits[0]).cast("int")


def audit(counts: DataFrame, names: list[str], sums: list[str]) -> DataFrame:
    """Every step of every order of the filters ``names``, for each ``part``.

    ``counts`` has rows ``part, mask, n`` and the columns ``sums`` (each a count of rows of a kind);
    several rows of a mask add up.  Returns ``part, filter_order, step, kept, removed, redundant,
    unique_fails``, a column ``{sum}_lost`` for each of ``sums``, and ``shapley``: the removals of the step's
    filter summed over all orders.
    """
    n = len(names)
    if n > MOST_FILTERS:
        raise ValueError(f"{n} filters; at most {MOST_FILTERS} have all their orders listed")
    spark = counts.sparkSession
    edges = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(w).alias("orders")) for s, f, w in lattice(n)])
    small = counts.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ["n", *sums]])
    on_edge = small.select("*", F.explode(edges).alias("e")).select("part", "mask", "n", *sums, "e.*")
    bit = F.expr("shiftleft(1, filter)")
    fails, gone = F.col("mask").bitwiseAND(bit) != 0, F.col("mask").bitwiseAND(F.col("state")) != 0
    counted = lambda rows, c="n": F.sum(F.when(rows, F.col(c)).otherwise(0)).cast("long")
    steps = on_edge.groupBy("part", "state", "filter", "orders").agg(
        counted(~gone & ~fails).alias("kept"),
        counted(~gone & fails).alias("removed"),
        counted(gone & fails).alias("redundant"),
        counted(F.col("mask") == bit).alias("unique_fails"),
        *[counted(~gone & fails, c).alias(f"{c}_lost") for c in sums],
    )
    weighed = steps.withColumn("shapley", F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "filter")).cast("long"))
    path = [
        ("".join(names[f] for f in order), step + 1, sum(1 << f for f in order[:step]), order[step])
        for order in permutations(range(n))
        for step in range(n)
    ]
    orders = spark.createDataFrame(path, "filter_order string, step int, state int, filter int")
    return weighed.join(F.broadcast(orders), ["state", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *[f"{c}_lost" for c in sums], "shapley"
    )


def repeats_apart(rows: DataFrame, digest: str, doc_id: str, repeated: int) -> DataFrame:
    """``rows`` (``n`` equal rows each) with ``repeated`` added to the ``mask`` of all but the smallest ``doc_id``
    of each ``digest``, summed over ids.  Groups of copies are counted before they meet: one row each id, then
    one for each kind of row."""
    kinds = [c for c in rows.columns if c not in (doc_id, "n")]
    one = F.when(F.col(doc_id).isNotNull(), F.struct(doc_id, "n"))
    met = rows.groupBy(*kinds).agg(F.sum("n").alias("n"), F.sum(F.when(F.col(doc_id).isNull(), F.col("n")).otherwise(0)).alias("_unknown"), F.min(one).alias("_own"))
    met = met.withColumn("_first", F.min(F.col(f"_own.{doc_id}")).over(Window.partitionBy(digest)))
    met = met.withColumn("_single", F.col("_unknown") + F.when(F.col(f"_own.{doc_id}") == F.col("_first"), F.col("_own.n")).otherwise(0))
    halves = F.array(F.struct(F.col("mask").alias("m"), F.col("_single").alias("k")), F.struct((F.col("mask") + repeated).alias("m"), (F.col("n") - F.col("_single")).alias("k")))
    split = met.select(*kinds, F.explode(halves).alias("h")).where("h.k > 0")
    return split.select(*[c for c in kinds if c not in (digest, "mask")], F.col("h.m").alias("mask"), F.col("h.k").alias("n"))


def audit_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Filters A-D on whole texts and E (a text that a smaller ``doc_id`` has) on ``docs``, by ``lang``,
    with the losses in labelled good and toxic documents."""
    text = F.coalesce(F.col("text"), F.lit(""))
    judged = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), mask(list(text_conditions(text).values())).alias("mask")
    )
    once = judged.groupBy(*judged.columns).agg(F.count(F.lit(1)).alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    # rows without an id match no label and are spread by their text instead of meeting in one task
    spread = once.withColumn("_salt", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0)))
    marked = spread.join(marks.withColumn("_at", F.lit(0).cast("long")), (F.col("doc_id") == F.col("_id")) & (F.col("_salt") == F.col("_at")), "left")
    kinds = marked.select("doc_id", "part", "digest", "mask", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")], "n")
    counts = repeats_apart(kinds, "digest", "doc_id", 1 << 4)
    sums = [F.when(F.col(c) == 1, F.col("n")).otherwise(0).alias(c) for c in ("good", "toxic")]
    return audit(counts.select("part", "mask", "n", *sums), list("ABCDE"), ["good", "toxic"])
