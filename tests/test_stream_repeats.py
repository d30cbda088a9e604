"""Links of a stream share groups, so that Python is not called for each of them."""

import datetime as dt
import os
import random
import tempfile

import numpy as np

from gazette.streaming.repeats import track_repeats, windows

ARRIVALS = "digest_id string, seq long, link string, published timestamp"
START = dt.datetime(2025, 6, 1)
DAY = dt.timedelta(days=1)


def _drained(stream):
    out = tempfile.mkdtemp(prefix="gz-out-")
    query = stream.writeStream.format("parquet").option("checkpointLocation", tempfile.mkdtemp(prefix="gz-ck-")).option("path", out).trigger(availableNow=True).start()
    assert query.awaitTermination(240)
    return stream.sparkSession.read.schema(stream.schema).parquet(out).collect(), query.recentProgress


def _repeats(spark, batches, **options):
    """Rows of ``batches``, each of which arrives by itself; the most rows of state that were held."""
    landing = tempfile.mkdtemp(prefix="gz-land-")
    for place, rows in enumerate(batches):
        at = f"{landing}/{place}"
        spark.createDataFrame(rows, ARRIVALS).coalesce(1).write.parquet(at)
        (name,) = (x for x in os.listdir(at) if x.endswith(".parquet"))
        os.utime(f"{at}/{name}", (1_700_000_000 + 60 * place,) * 2)  # taken in this order
    arrivals = spark.readStream.schema(ARRIVALS).option("maxFilesPerTrigger", 1).parquet(f"{landing}/*")
    rows, progress = _drained(track_repeats(arrivals, 7, **options))
    held = max(p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"])
    return sorted((r.event, r.clean_url, r.seq, r.repeats, r.first_seen) for r in rows), held


def test_links_share_groups_and_count_as_each_by_itself(spark):
    rnd = random.Random(5)
    batches = [
        [("d", 1000 * b + i, f"http://h/{rnd.randrange(60)}?e={i}", START + b * 8 * DAY + dt.timedelta(seconds=rnd.randrange(8 * 86_400))) for i in range(150)]
        for b in range(3)
    ]
    rows = sorted((x for b in batches for x in b), key=lambda x: x[3])
    passed, expected = rows[-1][3] - DAY, []
    for url in {x[2].split("?")[0] for x in rows}:
        mine = [x for x in rows if x[2].split("?")[0] == url]
        times = np.array([x[3] for x in mine], dtype="datetime64[us]").astype("int64")
        cuts = list(windows(times, None, 7 * 86_400_000_000))
        for place, (at, n) in enumerate(cuts):
            expected.append(("first", url, mine[at][1], 0, mine[at][3]))
            if place + 1 < len(cuts) or mine[at][3] + 7 * DAY < passed:
                expected.append(("closed", url, mine[at][1], n - 1, mine[at][3]))
    got, held = _repeats(spark, batches, groups=5)
    assert got == sorted(expected)
    assert held <= 5  # 60 links


def test_a_row_before_the_watermark_and_numbers_beside_null(spark):
    large = 2**53 + 1
    batches = [
        [("d", 1, "http://h/a", START)],
        [("d", 2, "http://h/b", START + 20 * DAY)],
        # not late yet by the watermark of the batch before, but its window's end is behind this one's
        [("d", large, "http://h/c", START + 2 * DAY), ("d", None, "http://h/c", START + 3 * DAY), ("d", large + 2, "http://h/d", START + 20 * DAY)],
    ]
    got, _ = _repeats(spark, batches, groups=1)
    assert got == [
        ("closed", "http://h/a", 1, 0, START),
        ("closed", "http://h/c", large, 1, START + 2 * DAY),
        ("first", "http://h/a", 1, 0, START),
        ("first", "http://h/b", 2, 0, START + 20 * DAY),
        ("first", "http://h/c", large, 0, START + 2 * DAY),
        ("first", "http://h/d", large + 2, 0, START + 20 * DAY),
    ]
