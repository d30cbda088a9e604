"""Repeats of a link in a stream: the first arrival at once, its repeats when their time is over.

An open window is when its URL was first seen and how often since.  The
first article of a URL is emitted when it arrives; one seen less than ``lookback_days``
after it is counted; the next one after that is a first again.  A window closes, with its
count, when the watermark passes its end or a later first arrives.  So an event-time timer
bounds the state by the URLs of one lookback, whatever the length of the stream.

The URLs are dealt out by hash to ``groups`` groups.  A group's state holds the open windows of
its URLs and its timer is due when the first of them ends, so a micro-batch calls Python once
per group and not once per URL, which costs milliseconds each.

Defined cases: an article without a link is a first of its own (its digest and ``seq`` are
its key); one without a date is seen when it arrives; rows of a URL in one micro-batch are
taken by time, then ``digest_id`` and ``seq``, NULL last (the batch's rows of a group are
held at once); a row older than an open window's first counts as its repeat; rows
older than the watermark (``late`` behind the newest) are dropped by the engine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gazette.functions.urls import clean_url

_OUT = "event string, clean_url string, digest_id string, seq bigint, first_seen timestamp, repeats bigint"
# of each open window of a group: the key of its URL, then as in _OUT
_STATE = "keys array<string>, first_us array<bigint>, repeats array<bigint>, digest_ids array<string>, seqs array<bigint>"
_DAY_US = 86_400_000_000

#: Groups of URLs unless said otherwise.
GROUPS = 1024

Open = tuple[int, int, str | None, int | None]  # first_us, repeats, digest_id, seq


def _emitted(out: list[tuple[str, str, Open]]) -> pd.DataFrame:
    """``(event, key, window)`` as rows of _OUT."""
    first = pd.Series([w[0] for _, _, w in out], dtype="int64").astype("datetime64[us]")
    return pd.DataFrame({
        "event": pd.Series([e for e, _, _ in out], dtype=object),
        "clean_url": pd.Series([k[1:] if k[0] == "1" else None for _, k, _ in out], dtype=object),
        "digest_id": pd.Series([w[2] for _, _, w in out], dtype=object),
        "seq": pd.array([w[3] for _, _, w in out], dtype="Int64"),
        "first_seen": first,
        "repeats": pd.Series([0 if e == "first" else w[1] for e, _, w in out], dtype="int64"),
    })


def windows(times: np.ndarray, opened: int | None, length: int) -> Iterator[tuple[int, int]]:
    """Cut sorted ``times`` into windows: ``(place of the first, rows up to its end)``; place -1 continues the
    window that was opened before."""
    at = 0
    if opened is not None:
        at = int(np.searchsorted(times, opened + length))
        yield -1, at
    while at < len(times):
        end = int(np.searchsorted(times, times[at] + length))
        yield at, end - at
        at = end


def _arrivals(rows: pd.DataFrame) -> Iterator[tuple[str, np.ndarray, list, list]]:
    """Key, times, digests and numbers of each URL's rows, by time, digest and number."""
    times = rows["seen_at"].to_numpy().astype("datetime64[us]").astype("int64")
    url, keys = pd.factorize(rows["_key"])
    place, _ = pd.factorize(rows["digest_id"], sort=True)
    place[place < 0] = len(rows)  # NULL last
    seq, none = rows["seq"].to_numpy(), rows["no_seq"].to_numpy()
    order = np.lexsort((seq, none, place, times, url))
    times, digests = times[order], rows["digest_id"].to_numpy()[order]
    numbers = np.where(none, None, seq.astype(object))[order]
    cuts = [0, *(np.flatnonzero(np.diff(url[order])) + 1).tolist(), len(order)]
    for key, start, end in zip(keys, cuts, cuts[1:]):
        yield key, times[start:end], digests[start:end], numbers[start:end]


def _track(length: int):
    def ends_ms(window: Open) -> int:
        return (window[0] + length) // 1000 + 1

    def run(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out, held = [], {}
        if state.exists:
            keys, *columns = state.get
            held = dict(zip(keys, zip(*columns)))
        if not state.hasTimedOut:
            for key, times, digests, numbers in _arrivals(pd.concat(list(batches), ignore_index=True)):
                now = held.get(key)
                for at, n in windows(times, now[0] if now else None, length):
                    if at < 0:
                        now = (now[0], now[1] + n, *now[2:])
                        continue
                    if now:
                        out.append(("closed", key, now))
                    now = (int(times[at]), n - 1, digests[at], numbers[at])
                    out.append(("first", key, now))
                held[key] = now
        passed = state.getCurrentWatermarkMs()
        for key in [k for k, window in held.items() if ends_ms(window) < passed]:
            out.append(("closed", key, held.pop(key)))
        if held:
            state.update((list(held), *map(list, zip(*held.values()))))
            state.setTimeoutTimestamp(max(1, min(map(ends_ms, held.values()))))
        elif state.exists:
            state.remove()
        yield _emitted(out)

    return run


def track_repeats(articles: DataFrame, lookback_days: int = 7, late: str = "1 day", ts: str = "published", groups: int = GROUPS) -> DataFrame:
    """``event`` (``first`` or ``closed``), ``clean_url``, the first article's ``digest_id`` and ``seq``, ``first_seen``
    and its ``repeats`` (0 while the window is open) of a stream of articles.  Append mode.

    ``groups`` stays the same for the life of a checkpoint; more of them keep less in one task at a time."""
    url = clean_url(F.col("link"))
    own = F.concat_ws(" ", F.lit("0"), "digest_id", F.col("seq").cast("string"))
    seq = F.col("seq").cast("long")
    seen = articles.select(
        F.when(url.isNotNull(), F.concat(F.lit("1"), url)).otherwise(own).alias("_key"), F.col("digest_id").cast("string").alias("digest_id"),
        F.coalesce(seq, F.lit(0)).alias("seq"), seq.isNull().alias("no_seq"),  # else one NULL makes doubles of a batch's numbers
        F.coalesce(F.col(ts), F.current_timestamp()).alias("seen_at"),
    )
    grouped = seen.withColumn("_group", F.pmod(F.xxhash64("_key"), F.lit(groups))).withWatermark("seen_at", late).groupBy("_group")
    return grouped.applyInPandasWithState(_track(lookback_days * _DAY_US), _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
