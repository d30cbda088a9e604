"""Token counts from a table of exact counts at every prefix of a text.

Reads a sentencepiece BPE model with byte fallback.  A piece ``t`` ends the encoding
of a prefix exactly when the encoding of what stands before ``t`` ends in a piece
``s`` and the pair ``s t`` encodes to itself; the counts of all prefixes follow from
left to right, one step a character, without encoding any prefix:

    count(prefix) = count(prefix without t) + 1

No piece of the vocabulary reaches over some places (before a blank that follows
something else; beside a character that only single pieces hold), so the table of a
text is put together from tables of its stretches between such places, and a worker
remembers the tables of frequent stretches.  A character outside the vocabulary
counts one token for each of its UTF-8 bytes.

The table answers how many tokens the first ``n`` characters have and which longest
prefix stays within a budget of tokens, both exactly: a count can fall as a prefix
grows (``wor`` may need more tokens than ``word``), which cutting the ids of the whole
text would miss.

Defined cases: a NULL or empty text has no tokens and no bytes, its table is ``[0]``; a
budget below what the first character needs gives the empty prefix, and a NULL budget
NULL; texts of any length are counted whole, stretches without a blank as well; rows may
repeat, and NULL ids, extra columns and clashing names pass through; an empty table gives
no rows.  Special strings inside a text are plain text, as the library has it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.llm.common import free_name, text_batches

#: Stretches of which a Python worker remembers the counts: it forgets those not met since as
#: many others were.  Longer ones than this many characters are not remembered.
REMEMBERED_STRETCHES = 600_000
REMEMBERED_LENGTH = 40
#: Pairs of pieces of which a worker remembers whether they encode to themselves.
REMEMBERED_PAIRS = 1_000_000
#: The model's mark of a blank.
BLANK = "▁"


class PrefixCounter:
    """Counts of one model.  ``table(stretch)`` has the count at each prefix of a stretch."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules, trained, kinds = model.normalizer_spec, model.trainer_spec, proto.ModelProto.SentencePiece
        plain = not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces and rules.escape_whitespaces
        other = {p.type for p in model.pieces} - {kinds.NORMAL, kinds.BYTE, kinds.CONTROL, kinds.UNKNOWN}
        if trained.model_type != proto.TrainerSpec.BPE or not trained.byte_fallback or trained.treat_whitespace_as_suffix or not plain or other:
            raise ValueError(f"{path} is not a BPE model of the supported kind")
        self.score = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        longer = [p for p in self.score if len(p) > 1]
        if any(BLANK in p.lstrip(BLANK) for p in longer):
            raise ValueError("a piece holds a blank after another character")
        mixed = [self.score[p] for p in longer if len(set(p)) > 1]
        runs = {self.score[p] for p in longer if len(set(p)) == 1}
        if len(set(mixed)) != len(mixed) or runs & set(mixed):  # equal scores are known to keep the rule only in runs of one character
            raise ValueError("two pieces have the same score")
        self.ends = ahocorasick.Automaton()  # all longer pieces that end at each character, longest first
        for p in longer:
            self.ends.add_word(p, (len(p), p, {}))
        self.ends.make_automaton()
        joined = "".join(map(re.escape, sorted({c for p in longer for c in p} - {BLANK})))
        self.stretches = re.compile(f"{BLANK}+[{joined}]*|[{joined}]+|[^{joined}{BLANK}]").findall
        self.pairs = 0
        self.totals: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short string by plain merging: best score first, leftmost of equals."""
        symbols = list(text)
        while True:
            found = [(-self.score[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in self.score]
            if not found:
                return symbols
            i = min(found)[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]

    def _keeps(self, left: str, right: str, known: dict[str, bool]) -> bool:
        """Whether ``left`` and ``right`` (a stretch's first piece has no ``left``) encode to themselves."""
        if self.pairs >= REMEMBERED_PAIRS:
            self.pairs = 0
            for _, _, other in self.ends.values():
                other.clear()
        self.pairs += 1
        keeps = known[left] = self.merged(left + right) == ([left, right] if left else [right])
        return keeps

    def table(self, stretch: str) -> list[int]:
        """Count at each prefix of a stretch, from 0 characters on."""
        counts, last, score = [0], [""], self.score

        def alone(end: int) -> None:
            """Up to ``end``, no longer piece ends a prefix."""
            for c in stretch[len(last) - 1 : end]:
                counts.append(counts[-1] + (1 if c in score else len(c.encode())))
                last.append(c)

        at = 0  # characters whose piece is known
        for end, (size, piece, lefts) in self.ends.iter(stretch):
            if end >= at:
                if end > at:
                    alone(end)
                    at = end
                left = last[end + 1 - size]
                keeps = lefts.get(left)
                if keeps or keeps is None and self._keeps(left, piece, lefts):
                    counts.append(counts[end + 1 - size] + 1)
                    last.append(piece)
                    at = end + 1
        alone(len(stretch))
        return counts

    def cut(self, texts: list[str | None]) -> list[tuple[list[str], list[int]]]:
        """The stretches of each text, and their counts."""
        found = [self.stretches(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        new = set().union(*found).difference(self.totals)
        known = {s: self.older[s] for s in new if s in self.older}
        known.update({s: self.table(s)[-1] for s in new.difference(known)})
        if len(self.totals) + len(known) > REMEMBERED_STRETCHES:
            self.older, totals = self.totals, {**self.totals, **known}
            self.totals = {}
        else:
            totals = self.totals
        totals.update(known)
        out = [(f, list(map(totals.__getitem__, f))) for f in found]
        if self.totals is totals:
            for s in known:
                if len(s) > REMEMBERED_LENGTH:
                    del totals[s]
        return out

    def count(self, text: str | None) -> int:
        return sum(self.cut([text])[0][1])

    def prefixes(self, text: str | None) -> np.ndarray:
        """Exact count of the first 0, 1, ... characters."""
        found, totals = self.cut([text])[0]
        if not found:
            return np.zeros(1, np.int32)
        tables = {s: self.table(s)[1:] for s in set(found)}
        sizes = [len(s) for s in found]
        inner = np.fromiter((n for s in found for n in tables[s]), np.int64, sum(sizes))
        out = inner + np.repeat(np.cumsum([0, *totals[:-1]]), sizes)
        out[0] = 0  # the blank that the model puts before a text is part of its first character
        return out.astype(np.int32)

    def fit(self, texts: list[str | None], budgets: list[int | None]) -> list[tuple[int, int | None, int | None]]:
        """Count of each whole text; characters and count of its longest prefix of at most its budget."""
        return [self._fit(t or "", *cut, b) for t, cut, b in zip(texts, self.cut(texts), budgets)]

    def _fit(self, text: str, found: list[str], totals: list[int], budget: int | None) -> tuple[int, int | None, int | None]:
        whole = sum(totals)
        if budget is None or whole <= budget:
            return (whole, None, None) if budget is None else (whole, len(text), whole)
        at = used = 0
        for s, n in zip(found, totals):
            if used + n > budget:  # every later stretch has a token, so the prefix ends here
                table = self.table(s)
                inside = max((i for i, c in enumerate(table) if used + c <= budget), default=0)
                used, at = used + table[inside], at + inside
                break
            used, at = used + n, at + len(s)
        return (whole, at - 1, used) if at > 1 else (whole, 0, 0)


@lru_cache(maxsize=2)
def _load(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def counts(df: DataFrame, path: str, budget: int | Column | None = None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all), ``n_tokens``, ``fit_chars`` and ``fit_tokens``: length in characters and
    count of the longest prefix of at most ``budget`` tokens (a number or a column).  ``path`` is the model's
    place on every worker; a column of one of the new names is replaced."""
    text_batches(df.sparkSession)
    new = ["n_tokens", "fit_chars", "fit_tokens"]
    kept = [c for c in keep or df.columns if c not in new]
    given, limit = free_name(kept, "text"), free_name(kept, "budget")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _load(path)
        for batch in batches:
            rows = counter.fit(batch.column(given).to_pylist(), batch.column(limit).to_pylist())
            columns = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(c, pa.int64()) for c in columns)], names=[*kept, *new])

    base = df.select(*kept)
    schema = T.StructType([*base.schema.fields, *(T.StructField(c, T.LongType()) for c in new)])
    most = budget if isinstance(budget, Column) else F.lit(budget)
    return df.select(*kept, F.col(text).cast("string").alias(given), most.cast("long").alias(limit)).mapInArrow(run, schema)


def prefix_counts(df: DataFrame, path: str, text: str = "text", out: str = "prefix_tokens") -> DataFrame:
    """All columns and ``out``: the exact count of the first 0, 1, ... characters of ``text``, as an array to
    be stored beside it.  ``tokens_of_first`` and ``longest_within`` answer from it, on the JVM."""
    text_batches(df.sparkSession)
    kept = [c for c in df.columns if c != out]
    given = free_name(kept, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _load(path)
        for batch in batches:
            for i in range(batch.num_rows):  # a table is four times its text: one row a batch
                row = batch.slice(i, 1)
                table = counter.prefixes(row.column(given)[0].as_py())
                lists = pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), pa.array(table))
                yield pa.RecordBatch.from_arrays([*(row.column(c) for c in kept), lists], names=[*kept, out])

    schema = T.StructType([*df.select(*kept).schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    return df.select(*kept, F.col(text).cast("string").alias(given)).mapInArrow(run, schema)


def tokens_of_first(prefix_tokens: Column, chars: Column) -> Column:
    """Tokens of the first ``chars`` characters, of all if there are fewer, from a stored table."""
    return F.element_at(prefix_tokens, F.least(F.greatest(chars, F.lit(0)) + 1, F.size(prefix_tokens)).cast("int"))


def longest_within(prefix_tokens: Column, budget: Column) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens, from a stored table."""
    fits = F.transform(prefix_tokens, lambda n, i: F.when(n <= budget, i))
    return F.when(budget.isNotNull(), F.coalesce(F.array_max(fits), F.lit(0)))


def digests(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document, and what of an overlong one stays within ``limit``."""
    known = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    found = counts(known, path, limit, keep=["doc_id", "n_bytes"])
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_chars", "fit_tokens")
