"""Connected components of a link table, with DataFrame joins only.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond"): every round rewires each node's links to
the smallest id it sees, until all links point at their component's smallest
id.  A node of very many links is only ever aggregated to its minimum and joined
back, so the planner can split it; nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).head()
    return row["n"], row["x"]


def components(links: DataFrame, u: str, v: str) -> DataFrame:
    """``(node, root)`` for every node of ``links`` that is not its component's
    smallest id (``root``).  Self links and NULL ends are ignored, repeated links
    count once, an empty table gives an empty result."""
    hi, lo = F.greatest(u, v).alias("a"), F.least(u, v).alias("b")
    edges = materialize(links.where(F.col(u) != F.col(v)).select(hi, lo).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(
            edges.select(F.col("b").alias("x"), F.col("a").alias("y"))
        )
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(lower, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        edges = materialize(small)
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
