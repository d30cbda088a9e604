"""Digest history: the report sink and the headline scan that feeds novelty.

Preferred layout: reports written as a text table partitioned by
``digest_date`` and ``digest_id`` (dynamic partition overwrite, so re-running a
digest replaces only that day's report of it).  Headlines keep their digest, so
one reader's history never hides articles from another.  Reading the window then prunes partitions.  The flat layout of one
``reading_list_yyyyMMdd.md`` file per day is read too: only exact names count
(``.md.old`` does not), and the date comes from the file name; :func:`write_report_files`
writes it.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.functions.markdown import extract_headings, report_file_date, report_file_name, universal_newlines
from gazette.operators.novelty import in_window
from gazette.plans.stored import file_system, stored


def headlines_from_reports(reports: DataFrame, markdown: str = "markdown", keys=("digest_id",)) -> DataFrame:
    """``(keys…, digest_date, pos, headline)`` from rendered reports."""
    ks = [k for k in keys if k in reports.columns]
    return reports.select(
        *ks, "digest_date", F.posexplode(extract_headings(universal_newlines(F.col(markdown)))).alias("pos", "headline")
    )


REPORT_TABLE = "value string, digest_date date, digest_id string"


def write_reports(reports: DataFrame, path: str) -> None:
    """One text file per day and digest under ``digest_date=…/digest_id=…``; a re-run
    replaces the digests it writes and leaves all others."""
    (
        reports.select(F.col("markdown").alias("value"), "digest_date", F.col("digest_id").cast("string"))
        .repartition("digest_date", "digest_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("digest_date", "digest_id")
        .text(path)
    )


def read_report_table(spark: SparkSession, path: str) -> DataFrame:
    """The partitioned report table: ``(digest_id, digest_date, markdown)``."""
    files = spark.read.schema(REPORT_TABLE).text(path, wholetext=True)
    return files.select("digest_id", "digest_date", F.col("value").alias("markdown"))


def write_report_files(reports: DataFrame, path: str, by_digest: bool = False) -> list[tuple[str, str | None]]:
    """One ``reading_list_yyyyMMdd.md`` per day in ``path`` (with ``by_digest`` in a folder per digest):
    the files, each with None or what went wrong.

    Reports are written to a staging folder first, by the cluster; when all are there, each file is
    moved into place by the driver (as many moves as days).  A file that exists is replaced only by
    a whole one: if writing or a move fails, the file of before stays and the failure is listed, not
    raised.  A report without a date or text, or one of several for the same file, is listed and left
    out.  A text that does not end in a line break gets one."""
    spark = reports.sparkSession
    folder = F.concat(F.col("digest_id").cast("string"), F.lit("/")) if by_digest else F.lit("")
    named = reports.select(F.concat(folder, report_file_name(F.col("digest_date"))).alias("file"), F.col("markdown"))
    known = F.col("file").isNotNull() & F.col("markdown").isNotNull()
    single = F.count(F.lit(1)).over(Window.partitionBy("file")) == 1
    judged = stored(named.withColumn("error", F.when(~known, F.lit("no date or text")).when(~single, F.lit("several reports for one file"))))
    out = [(r["file"], r["error"]) for r in judged.filter("error IS NOT NULL").select("file", "error").distinct().collect()]
    staging = f"{path.rstrip('/')}/.staging-{uuid.uuid4().hex}"
    fs, make = file_system(spark, path)
    good = judged.filter("error IS NULL").select(F.regexp_replace("markdown", r"\n\z", "").alias("value"), F.md5("file").alias("_at"), "file")
    names = {r["_at"]: r["file"] for r in good.select("_at", "file").collect()}  # one per day
    try:
        good.drop("file").repartition("_at").write.partitionBy("_at").text(staging)
    except Exception as e:  # noqa: BLE001 - listed for every file; those of before stay
        fs.delete(make(staging), True)
        return out + [(name, f"not written: {type(e).__name__}") for name in names.values()]
    for at, name in names.items():
        to, kept = make(f"{path.rstrip('/')}/{name}"), make(f"{staging}/_at={at}/before")
        try:
            part = next(s.getPath() for s in fs.listStatus(make(f"{staging}/_at={at}")) if s.getPath().getName().startswith("part-"))
            fs.mkdirs(to.getParent())
            if fs.exists(to) and not fs.rename(to, kept):
                raise OSError("the file of before could not be set aside")
            if not fs.rename(part, to):
                raise OSError("could not be moved")
            out.append((name, None))
        except Exception as e:  # noqa: BLE001 - one file's failure is its own
            if fs.exists(kept) and not fs.exists(to):
                fs.rename(kept, to)
            out.append((name, str(e).splitlines()[0]))
    fs.delete(make(staging), True)
    return sorted(out, key=lambda x: (x[0] or "", x[1] or ""))


def read_report_files(spark: SparkSession, path: str, as_of: dt.date | None = None, lookback_days: int | None = None):
    """Flat ``reading_list_yyyyMMdd.md`` files → ``(digest_date, markdown)``.

    With ``as_of`` the file list is the ``lookback_days`` names of the window
    that exist (checked on the driver: at most ``lookback_days`` paths), so only
    those files are opened.
    """
    if as_of is not None:
        names = [f"{path.rstrip('/')}/reading_list_{(as_of - dt.timedelta(days=i)).strftime('%Y%m%d')}.md" for i in range(lookback_days)]
        fs, make = file_system(spark, path)
        existing = [name for name in names if fs.exists(make(name))]
        if not existing:
            return spark.createDataFrame([], "digest_date date, markdown string")
        df = spark.read.text(existing, wholetext=True)
    else:
        df = spark.read.text(path, wholetext=True)
    named = df.select(report_file_date(F.col("_metadata.file_name")).alias("digest_date"), F.col("value").alias("markdown"))
    return named.filter(F.col("digest_date").isNotNull())


def read_headlines(
    spark: SparkSession,
    path: str,
    as_of: dt.date | str | Column,
    lookback_days: int = 7,
    layout: str = "table",
) -> DataFrame:
    """Headlines (``## `` titles) of the reports inside the window
    ``as_of - lookback < digest_date <= as_of`` (today inclusive)."""
    asof_col = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")
    if layout == "table":
        reports = read_report_table(spark, path)
    elif layout == "files":
        d = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
        reports = read_report_files(spark, path, d, lookback_days)
    else:
        raise ValueError(layout)
    reports = reports.filter(in_window(F.col("digest_date"), asof_col, lookback_days))
    return headlines_from_reports(reports)


__all__ = [
    "headlines_from_reports",
    "read_headlines",
    "read_report_files",
    "read_report_table",
    "report_file_name",
    "write_report_files",
    "write_reports",
]
