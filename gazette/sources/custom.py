"""Sources of one's own as a Spark format, for batch and streaming reads.

A source has a name, says how many entries it holds (:meth:`EntrySource.latest`) and gives
those between two ordinals (:meth:`EntrySource.fetch`).  :func:`entry_format` makes a
data source of several: a batch read asks each for all its entries, a stream for those
since the last offset.  One partition reads a group of sources, so sources are
asked by the executors, many at a time; what a stream has read is a JSON offset per source,
and a replayed batch asks for the same ordinals again.

A source that raises gives no entries of that read and does not stop the others
(``on_error='fail'`` raises).
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

ENTRIES = "source string, source_ord int, entry_ord bigint, title string, link string, published timestamp, summary string, comments_link string"


class EntrySource:
    """Override both methods; instances travel to the executors."""

    name = "source"

    def latest(self) -> int:
        """How many entries there are now."""
        raise NotImplementedError

    def fetch(self, start: int, end: int) -> Iterator[tuple]:
        """``(title, link, published, summary, comments_link)`` of the entries ``start`` to ``end - 1``."""
        raise NotImplementedError


@dataclass
class _Span(InputPartition):
    parts: list[tuple[int, int, int]]  # source, start, end


class _Reads:
    def __init__(self, sources: Sequence[EntrySource], per_partition: int, on_error: str):
        self.sources, self.per_partition, self.on_error = list(sources), per_partition, on_error

    def _latest(self) -> dict[str, int]:
        out = {}
        for i, s in enumerate(self.sources):
            try:
                out[str(i)] = int(s.latest())
            except Exception:  # noqa: BLE001 - a source out of reach has nothing new
                if self.on_error == "fail":
                    raise
        return out

    def _spans(self, start: dict, end: dict) -> list[_Span]:
        wanted = [(int(i), start.get(i, 0), n) for i, n in end.items() if n > start.get(i, 0)]
        return [_Span(wanted[at : at + self.per_partition]) for at in range(0, len(wanted), self.per_partition)]

    def read(self, partition: _Span) -> Iterator[tuple]:
        for i, start, end in partition.parts:
            source, rows = self.sources[i], []
            try:
                for n, (title, link, published, summary, comments) in enumerate(source.fetch(start, end), start):
                    rows.append((source.name, i, n, title, link, published, summary, comments))
            except Exception:  # noqa: BLE001 - one source's failure is its own
                if self.on_error == "fail":
                    raise
                continue
            yield from rows


class _Batch(_Reads, DataSourceReader):
    def partitions(self) -> list[_Span]:
        return self._spans({}, self._latest()) or [_Span([])]


class _Stream(_Reads, DataSourceStreamReader):
    def __init__(self, *args):
        super().__init__(*args)
        self.seen: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {"at": "{}"}

    def latestOffset(self) -> dict:
        self.seen = {**self.seen, **self._latest()}
        return {"at": json.dumps(self.seen, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[_Span]:
        return self._spans(json.loads(start["at"]), json.loads(end["at"])) or [_Span([])]

    def commit(self, end: dict) -> None:
        pass


def entry_format(name: str, sources: Sequence[EntrySource], per_partition: int = 1, on_error: str = "drop") -> type[DataSource]:
    """A data source class for ``spark.dataSource.register``, read by ``spark.read.format(name)`` or ``readStream``:
    columns :data:`ENTRIES`, sources in the order of the list."""
    if on_error not in ("drop", "fail"):
        raise ValueError(on_error)

    class Entries(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return ENTRIES

        def reader(self, schema) -> DataSourceReader:
            return _Batch(sources, per_partition, on_error)

        def streamReader(self, schema) -> DataSourceStreamReader:
            return _Stream(sources, per_partition, on_error)

    return Entries
