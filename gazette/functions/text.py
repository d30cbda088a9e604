"""Keyword column builders (substring semantics, case-folded with ``lower``).

A keyword matches a row when it is a substring of the lower-cased title or
the lower-cased summary.  NULL text is treated as the empty string.  All
builders return plain Catalyst expressions, so they fuse into the scan's
whole-stage-codegen span and are pushed below joins by the optimizer.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Keywords up to which a list becomes one OR-chain in generated code.
INLINE_KEYWORDS = 256

#: White space at a text's edges: that of Unicode and the four separators U+001C to U+001F.
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

_SHOWN = {chr(b): bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
#: Control characters that stand for a windows-1252 byte, and what that byte shows (arguments of ``translate``).
WINDOWS_1252 = "".join(c for c in _SHOWN if _SHOWN[c]), "".join(_SHOWN.values())


def strip(text: Column) -> Column:
    """``text`` without white space at its edges, in time linear in the text."""
    return F.btrim(text, F.lit(BLANKS))


def content_key(url: str | Column, content: str | Column, n_chars: int = 100) -> Column:
    """Key of a piece of content: MD5 of its url and the first ``n_chars`` characters (NULL content: none)."""
    u, c = (F.col(x) if isinstance(x, str) else x for x in (url, content))
    return F.md5(F.concat(u, F.coalesce(F.substring(c, 1, n_chars), F.lit(""))))


def _lowered(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.lower(c), F.lit(""))


def normalize_keywords(keywords: Sequence[str]) -> list[str]:
    return [k.lower() for k in keywords]


def keyword_hit(keyword: str, cols: Sequence[str | Column] = ("title", "summary")) -> Column:
    """True when ``keyword`` (already lower-cased) occurs in any of ``cols``."""
    lit = F.lit(keyword)
    return reduce(lambda a, b: a | b, [F.contains(_lowered(c), lit) for c in cols])


def _with_lowered(cols: Sequence[str | Column], body) -> Column:
    """Evaluate ``body(lowered_cols)`` with every column lower-cased exactly once
    per row (bound as a lambda variable), however many keywords test it."""
    packed = F.array(F.struct(*[_lowered(c).alias(f"c{i}") for i, c in enumerate(cols)]))
    return F.transform(packed, lambda row: body([row[f"c{i}"] for i in range(len(cols))]))[0]


def any_keyword(keywords: Sequence[str], cols: Sequence[str | Column] = ("title", "summary")) -> Column:
    """OR of keyword hits over the list; an empty list is ``False``."""
    kws = normalize_keywords(keywords)
    if not kws:
        return F.lit(False)
    if len(kws) > INLINE_KEYWORDS:  # a list literal instead of one expression per keyword
        listed = F.lit(kws)
        return _with_lowered(cols, lambda low: F.exists(listed, lambda k: reduce(lambda a, b: a | b, [F.contains(c, k) for c in low])))
    return _with_lowered(
        cols, lambda low: reduce(lambda a, b: a | b, [F.contains(c, F.lit(k)) for k in kws for c in low])
    )


def matched_keywords(keywords: Sequence[str], cols: Sequence[str | Column] = ("title", "summary")) -> Column:
    """Array of the keywords that match, in configured order (lower-cased)."""
    kws = normalize_keywords(keywords)
    if not kws:
        return F.array().cast("array<string>")

    def body(low):
        return F.array_compact(
            F.array(*[F.when(reduce(lambda a, b: a | b, [F.contains(c, F.lit(k)) for c in low]), F.lit(k)) for k in kws])
        )

    return _with_lowered(cols, body)
