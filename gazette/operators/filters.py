"""Keyword filters, top-N, stage counts and the dry-run enrichment.

All of these are narrow transformations or a single partial/final aggregate;
none needs a Python worker.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from gazette.functions.text import any_keyword, matched_keywords
from gazette.plans.stored import join_on

# Placeholder texts the dry-run mode writes instead of a summary.
DRY_RUN_SUMMARY = "Summary not generated in dry run mode"
DRY_RUN_WHY_CARE = "Insights not generated in dry run mode"


def keyword_filter(df: DataFrame, keywords: Sequence[str], cols: Sequence[str] = ("title", "summary")) -> DataFrame:
    """Keep rows matching at least one keyword; an empty list keeps nothing."""
    return df.filter(any_keyword(keywords, cols))


def negative_keyword_filter(
    df: DataFrame, keywords: Sequence[str], cols: Sequence[str] = ("title", "summary")
) -> DataFrame:
    """Drop rows matching any keyword; an empty list keeps everything."""
    return df.filter(~any_keyword(keywords, cols))


def with_matched_keywords(
    df: DataFrame, keywords: Sequence[str], cols: Sequence[str] = ("title", "summary"), name: str = "matched_keywords"
) -> DataFrame:
    return df.withColumn(name, matched_keywords(keywords, cols))


def top_n(df: DataFrame, n: int, order: Sequence[str] = ("seq",), by: str = "digest_id", rank_col: str | None = None):
    """First ``n`` rows of every digest by ``order``.

    ``row_number() <= n`` is planned as a WindowGroupLimit: each map task keeps
    only its local top ``n`` per digest before the shuffle, so a digest of any
    size sends at most ``n`` rows per input partition across the network.
    """
    w = Window.partitionBy(by).orderBy(*[F.col(c) for c in order])
    col = rank_col or "_top_rank"
    out = df.withColumn(col, F.row_number().over(w)).filter(F.col(col) <= F.lit(n))
    return out if rank_col else out.drop(col)


def stage_counts(
    df: DataFrame,
    negative_keywords: Sequence[str],
    keywords: Sequence[str],
    cols: Sequence[str] = ("title", "summary"),
    by: str = "digest_id",
) -> DataFrame:
    """Rows in / out of each filter stage per digest, in one scan and one aggregate."""
    neg = any_keyword(negative_keywords, cols)
    pos = any_keyword(keywords, cols)
    agg = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("input"),
        F.count_if(~neg).alias("negative_keywords"),
        F.count_if(~neg & pos).alias("keywords"),
    )
    return agg.select(
        by,
        F.expr("stack(3, 0, 'input', input, 1, 'negative_keywords', negative_keywords, 2, 'keywords', keywords)").alias(
            "stage_ord", "stage", "n_rows"
        ),
    ).withColumn("n_rows", F.col("n_rows").cast("bigint"))


def count_stages(stages: Sequence[tuple[str, DataFrame]], by: str = "digest_id") -> DataFrame:
    """``(by, stage_ord, stage, n_rows)`` of any chain of stages, given as names and
    frames in order; a digest that a stage empties counts 0 there."""
    first = stages[0][1].select(by).distinct()
    out = None
    for i, (name, frame) in enumerate(stages):
        n = join_on(first, frame.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows")), [by], "left")
        part = n.select(by, F.lit(i).alias("stage_ord"), F.lit(name).alias("stage"), F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"))
        out = part if out is None else out.unionByName(part)
    return out


class StageTotals:
    """Rows behind each stage of a run, observed while the run's own jobs pass them: no scan is added.

    ``watch`` a frame on its way into the next step; ``rows`` gives ``(stage, n_rows)`` in order once the
    jobs have run (it waits for them)."""

    def __init__(self) -> None:
        self._seen: list[tuple[str, Observation]] = []

    def watch(self, stage: str, df: DataFrame) -> DataFrame:
        seen = Observation(f"{stage}-{uuid.uuid4().hex}")
        self._seen.append((stage, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n_rows"))

    def rows(self) -> list[tuple[str, int]]:
        return [(stage, seen.get.get("n_rows", 0)) for stage, seen in self._seen]


def dry_run(df: DataFrame) -> DataFrame:
    """Enrichment stand-in: fixed summary / insight placeholders, no page reads."""
    return df.withColumn("generated_summary", F.lit(DRY_RUN_SUMMARY)).withColumn("why_care", F.lit(DRY_RUN_WHY_CARE))
