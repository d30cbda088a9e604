"""Ordered stage pipeline: a list of ``DataFrame -> DataFrame`` callables.

The driver only composes the lazy plan; Catalyst sees the whole chain and
fuses adjacent filters into one scan-side predicate.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame

Stage = Callable[[DataFrame], DataFrame]


@dataclass
class Pipeline:
    stages: list[Stage] = field(default_factory=list)

    def add(self, stage: Stage) -> "Pipeline":
        self.stages.append(stage)
        return self

    def run(self, df: DataFrame) -> DataFrame:
        return reduce(lambda acc, stage: acc.transform(stage), self.stages, df)


def pipeline(stages: Sequence[Stage]) -> Pipeline:
    return Pipeline(list(stages))
