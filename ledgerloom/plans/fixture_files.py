"""Input files written from the driver tables, for the scan, load and sink queries.

The driver's Parquet tables hold no CSV, JSON or log files, so these writers
produce them (with Spark, in parallel) under a fresh folder below the shared
checkpoint root; the registered queries then run the real readers and loads
over them. Row content follows ``fixtures`` exactly, so the oracle SQL of the
derived tables also describes what is read back.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixtures as fx
from .. import schemas as S
from ..session import scratch_path
from ..sources import files, readers

# Processing day of the file fixtures (fixed value; the oracle SQL uses the same).
FILE_DAY = "2025-05-13"
NEXT_DAY = "2025-05-14"


def _report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.report(fx.read_table(spark, sf_dir, "orders"), keep=["o_orderkey"])


def _csv(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    w = df.write.mode("overwrite").option("header", True).option("escape", '"')
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(path)


def write_report_days(spark: SparkSession, sf_dir: str) -> str:
    """All report rows as CSVs in FILE_DAY's folder, and a full copy in the next day's.

    Reading one day must return every row exactly once: a row read from the
    other day's copy would show up as a duplicate.
    """
    root = scratch_path(spark, "report-csv")
    rows = _report_rows(spark, sf_dir).select(
        *[F.col(f"`{c}`") for c in S.REQUIRED_REPORT_COLUMNS])
    _csv(rows, files.day_folder(root, FILE_DAY))
    time.sleep(1.1)     # file times of some stores are whole seconds
    _csv(rows, files.day_folder(root, NEXT_DAY))
    return root


def write_report_headers(spark: SparkSession, sf_dir: str) -> str:
    """All report rows in FILE_DAY's folder, in files with three headers: in order, reversed, and with further columns."""
    root = scratch_path(spark, "report-headers")
    rows = _report_rows(spark, sf_dir)
    names = S.REQUIRED_REPORT_COLUMNS
    for k, columns in enumerate((names, names[::-1], ["o_orderkey", *names[3:], *names[:3]])):
        _csv(rows.where(f"o_orderkey % 3 = {k}").select(*[F.col(f"`{c}`") for c in columns]), f"{files.day_folder(root, FILE_DAY)}part{k}")
    return root


def write_report_folders(spark: SparkSession, sf_dir: str) -> str:
    """The older delivery layout for FILE_DAY, with full copies where none may be read.

    ``backup_jobs_report_a/batch=backup_job_report_<n>/`` holds every row once;
    ``backup_jobs_report_a/extra/`` (no file marker in the path) and
    ``misc_reports/`` (no folder marker) each hold a full copy that must be skipped. So must
    ``backup_jobs_report_a/aaa_summary/``, whose files have another header.
    """
    root = scratch_path(spark, "report-folders")
    day = files.day_folder(root, FILE_DAY)
    rows = _report_rows(spark, sf_dir)
    cols = [F.col(f"`{c}`") for c in S.DETAIL_REPORT_COLUMNS]
    batch = F.concat(F.lit(files.REPORT_FILE_MARKER), (F.col("o_orderkey") % 3).cast("string"))
    _csv(rows.select(*cols, batch.alias("batch")), f"{day}backup_jobs_report_a", "batch")
    _csv(rows.select(*cols), f"{day}backup_jobs_report_a/extra")
    _csv(rows.select(*cols), f"{day}misc_reports")
    _csv(rows.select(F.lit("1").alias("x"), F.lit("2").alias("y")), f"{day}backup_jobs_report_a/aaa_summary")
    return root


def write_pageview_json(spark: SparkSession, sf_dir: str) -> str:
    """Nested page-view JSON, the lines of four kinds.

    Plain objects, one-element arrays (event id divisible by 5), objects whose
    ``visitor_details`` is no object (by 9, not by 5: those events load without details) and
    further lines that are no JSON at all (one per event divisible by 100).
    """
    path = scratch_path(spark, "pageview-json")
    events = fx.read_table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    nested = fx.pageview_nested(events, keep=["event_id"])
    eid, plain = F.col("event_id"), F.struct(*S.PAGEVIEW_JSON.fieldNames())
    half = F.struct(*S.PAGEVIEW_JSON.fieldNames()[:-1], F.lit("no details").alias("visitor_details"))
    line = (F.when(eid % 5 == 0, F.concat(F.lit("["), F.to_json(plain), F.lit("]")))
            .when(eid % 9 == 0, F.to_json(half)).otherwise(F.to_json(plain)))
    lines = nested.select(F.explode(F.when(eid % 100 == 0, F.array(line, F.concat(F.lit("{broken "), eid.cast("string"))))
                                    .otherwise(F.array(line))).alias("value"))
    lines.write.mode("overwrite").text(path)
    return path


def write_log_files(spark: SparkSession, sf_dir: str) -> str:
    """One text file per virtual log file, lines in order.

    Lines of one log go to one task (``repartition`` by file) and are sorted
    there; ``partitionBy`` puts each log in its own folder named after it.
    """
    root = scratch_path(spark, "backup-logs")
    lines = fx.log_lines(fx.read_table(spark, sf_dir, "events"))
    (lines.repartition("file_path").sortWithinPartitions("file_path", "line_no")
     .select("file_path", "value")
     .write.mode("overwrite").partitionBy("file_path").text(root))
    return root


#: A log's name and a part's number in the paths of ``write_log_part``.
LOG_PART = r"file_path=([^/]+)/part=(\d+)/"


def write_log_part(spark: SparkSession, sf_dir: str, root: str, part: int, parts: int = 3) -> None:
    """Deliver one of ``parts`` stretches of every log to ``root``: its lines in order, in one file."""
    lines = fx.log_lines(fx.read_table(spark, sf_dir, "events"))
    n = F.count(F.lit(1)).over(Window.partitionBy("file_path"))
    place = F.row_number().over(Window.partitionBy("file_path").orderBy("line_no")) - 1
    cut = lines.select("file_path", "line_no", "value", F.floor(place * parts / n).alias("part")).where(F.col("part") == part)
    (cut.repartition("file_path").sortWithinPartitions("file_path", "line_no").select("file_path", "part", "value")
     .write.mode("append").partitionBy("file_path", "part").text(root))


def write_damaged_logs(spark: SparkSession, sf_dir: str) -> str:
    """The log files, and beside them copies that cannot be read; ``<root>-listing`` lists all of them.

    ``broken-<log>``: compressed and cut off half-way. ``gone-<log>``: deleted after the listing. Both are copies of host 0's logs.
    """
    root = scratch_path(spark, "damaged-logs")
    lines = fx.log_lines(fx.read_table(spark, sf_dir, "events"))
    hosts = F.col("file_path").startswith("hana-0-")
    for kind, rows, codec in (("", lines, "none"), ("broken-", lines.where(hosts), "gzip"), ("gone-", lines.where(hosts), "none")):
        (rows.withColumn("file_path", F.concat(F.lit(kind), "file_path")).repartition("file_path").sortWithinPartitions("file_path", "line_no")
         .select("file_path", "value")
         .write.mode("append").option("compression", codec).partitionBy("file_path").text(root))
    jvm = spark.sparkContext._jvm
    path_of = jvm.org.apache.hadoop.fs.Path
    fs = path_of(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.globStatus(path_of(f"{root}/file_path=broken-*/part-*")):
        source = fs.open(status.getPath())
        half = source.readNBytes(status.getLen() // 2)
        source.close()
        target = fs.create(path_of(status.getPath().toString().replace("/part-", "/cut-")))
        target.write(half)
        target.close()
        fs.delete(status.getPath(), False)
    readers.list_logs(spark, root, glob=None).write.parquet(f"{root}-listing")
    for status in fs.globStatus(path_of(f"{root}/file_path=gone-*")):
        fs.delete(status.getPath(), True)
    return root


def log_name(path_col: str = "file_path"):
    """The log's name from a fixture file path (``.../file_path=<name>/part-...``)."""
    return F.regexp_extract(F.col(path_col), r"file_path=([^/]+)/", 1)


def file_day_ts():
    return F.lit(FILE_DAY).cast("timestamp_ntz")
