"""End-to-end loads: the three ingestion jobs and the load checks after them.

Each job reads once, transforms lazily and writes once; the written row count
comes from the write job itself (an ``Observation``), not from a second scan.
The processing date is always a parameter (default: today in UTC).
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import logs, report, verify
from ..session import scratch_path
from ..sinks import tables
from ..sources import files, readers

log = logging.getLogger(__name__)


class NoInputError(RuntimeError):
    """The load found nothing to read (no folder, no matching file, no session)."""


@dataclass
class LoadResult:
    table: str
    rows_written: int
    corrupt_rows: int = 0
    skipped_files: int = 0


def report_fact_frame(spark: SparkSession, base: str, as_of=None) -> DataFrame:
    """The processing day's report CSVs (any ``.csv`` below the day folder) as fact rows."""
    folder = files.day_folder(base, as_of)
    if not files.path_exists(spark, folder):
        raise NoInputError(f"no report folder {folder}")
    raw = _read_reports(spark, folder)
    return report.backup_fact_report(raw, as_of=str(files.processing_date(as_of)))


def report_fact_by_header(spark: SparkSession, base: str, as_of=None) -> DataFrame:
    """:func:`report_fact_frame` for a day whose files have different headers (one more look at each file's first line)."""
    folder = files.day_folder(base, as_of)
    if not files.path_exists(spark, folder):
        raise NoInputError(f"no report folder {folder}")
    raw = readers.read_report_csv_by_header(spark, folder, S.REQUIRED_REPORT_COLUMNS)
    return report.backup_fact_report(raw, as_of=str(files.processing_date(as_of)))


def _read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Report CSVs below ``path``; a folder with no CSV at all is "no input"."""
    try:
        return readers.read_report_csv(spark, path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            raise NoInputError(f"no report CSV under {path}") from e
        raise


def load_report_fact(spark: SparkSession, base: str, table: str, location: str,
                     as_of=None) -> LoadResult:
    """Report CSVs of one day appended to the backup fact table (created if absent)."""
    tables.create_table_if_absent(spark, table, S.BACKUP_FACT, location)
    rows = tables.append_by_name(report_fact_frame(spark, base, as_of), table)
    log.info("appended %d report rows to %s", rows, table)
    return LoadResult(table, rows)


def report_detail_frame(spark: SparkSession, base: str, as_of=None, as_of_ts=None) -> DataFrame:
    """Detail rows from the day's ``backup_jobs_report_*`` folders (older layout).

    Files are selected from the listing, before any is read: marker in the path, ``.csv``,
    not empty. One selected file gives the header; the read declares it, and the same
    selection as a filter on the file's metadata keeps the others closed.
    """
    folders = files.report_folders(base, as_of)
    if not files.path_exists(spark, folders):
        raise NoInputError(f"no report folders {folders}")
    one = files.report_files(files.list_files(spark, folders)).orderBy("file_path").first()
    if one is None:
        raise NoInputError(f"no report file selected under {folders}")
    schema = readers.read_report_csv(spark, one["file_path"], recursive=False).schema
    path = F.lower(F.col("_metadata.file_path"))
    raw = readers.read_report_csv(spark, folders, schema=schema).where(
        path.contains(files.REPORT_FILE_MARKER) & path.endswith(files.CSV_SUFFIX)
        & (F.col("_metadata.file_size") > 0))
    return report.report_detail(raw, as_of=str(files.processing_date(as_of)), as_of_ts=as_of_ts)


def load_report_detail(spark: SparkSession, base: str, table: str, location: str,
                       as_of=None, overwrite: bool = False) -> LoadResult:
    rows = tables.load_table(report_detail_frame(spark, base, as_of), table, location, overwrite)
    return LoadResult(table, rows)


def log_pieces(spark: SparkSession, log_root: str, glob: str | None = files.LOG_FILE_GLOB,
               listing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Session pieces of the logs below ``log_root``, and ``file_path, reason`` of the files that yield nothing.

    A file that cannot be read does not fail the load. The logs are read as they are first; only when that
    fails on a file are they read again with each file held against the ``listing`` (of
    :func:`readers.list_logs`, taken beforehand; default: now). A file listed but gone is reported too.
    """
    known = readers.list_logs(spark, log_root, glob) if listing is None else listing
    try:
        there = readers.list_logs(spark, log_root, glob) if listing is not None else known
        pieces = logs.stored_pieces(readers.read_backup_log(spark, log_root, glob))
        unread = known.join(there, "file_path", "left_anti").select("file_path", F.lit("vanished").alias("reason"))
    except Exception as e:  # Spark reports it as its own or as a Java error
        if not readers.failed_on_a_file(e):
            raise
        log.warning("a log file under %s cannot be read; reading again file by file", log_root)
        lines, unread = readers.read_logs_apart(spark, log_root, known, glob)
        pieces = logs.stored_pieces(lines)
    return pieces, logs.skipped_files(pieces).unionByName(unread)


def log_frames(spark: SparkSession, log_root: str, as_of=None, glob: str | None = files.LOG_FILE_GLOB,
               listing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Every ``.log`` file below ``log_root`` as backup-session fact rows, and the files that yield nothing."""
    if not files.path_exists(spark, log_root):
        raise NoInputError(f"no log folder {log_root}")
    pieces, skipped = log_pieces(spark, log_root, glob, listing)
    return logs.backup_fact_log(logs.sessions_of(pieces), as_of=str(files.processing_date(as_of))), skipped


def log_fact_frame(spark: SparkSession, log_root: str, as_of=None) -> DataFrame:
    return log_frames(spark, log_root, as_of)[0]


def load_log_fact(spark: SparkSession, log_root: str, table: str, location: str,
                  as_of=None) -> LoadResult:
    """Log sessions appended to the backup fact table; no session at all is an error.

    Skipped files (undated differential backup, not UTF-8, or unreadable) are counted, and the first
    few are named in the log."""
    tables.create_table_if_absent(spark, table, S.BACKUP_FACT, location)
    fact, skipped = log_frames(spark, log_root, as_of)
    n = skipped.count()
    if n:
        named = [f"{r.file_path} ({r.reason})" for r in skipped.orderBy("file_path").limit(20).collect()]
        log.warning("%d log files skipped under %s: %s", n, log_root, ", ".join(named))
    rows = tables.append_by_name(fact, table)
    if rows == 0:
        raise NoInputError(f"no backup session found under {log_root}")
    return LoadResult(table, rows, skipped_files=n)


def flatten_pageviews(spark: SparkSession, input_path: str, output_path: str,
                      recursive: bool = False, corrupt_path: str | None = None) -> LoadResult:
    """Page-view JSON flattened to Parquet at ``output_path`` (append).

    Input and output roots must differ. The JSON is read and parsed once, into a table in the shared folder
    that holds rows and the text of records that do not parse, wholly or in part; both outputs are written from it, so
    they cannot disagree. Such records are always kept at ``corrupt_path`` (default: ``<output_path>_corrupt``).
    """
    if output_path.rstrip("/").startswith(input_path.rstrip("/") + "/") and recursive:
        raise ValueError("output folder lies inside the recursively read input folder")
    raw = readers.read_pageview_json(spark, input_path, recursive)
    seen, path = Observation("pageview-json"), scratch_path(spark, "pageview-parsed")
    raw.observe(seen, F.count(F.col(readers.CORRUPT_COLUMN)).alias("corrupt")).write.parquet(path)
    ok, bad = readers.split_corrupt(spark.read.schema(raw.schema).parquet(path))
    rows = tables.write_parquet(readers.flatten_pageview(ok), output_path)
    corrupt = int(seen.get.get("corrupt", 0))
    if corrupt:
        kept = corrupt_path or f"{output_path.rstrip('/')}_corrupt"
        tables.write_parquet(bad, kept)
        log.warning("%d page-view records under %s do not parse; kept at %s", corrupt, input_path, kept)
    return LoadResult(output_path, rows, corrupt)


def load_checks(spark: SparkSession, table: str) -> dict[str, DataFrame]:
    """The checks run after a load: total, rows by component, a ten-row sample."""
    fact = spark.table(table)
    return {"total": verify.total_rows(fact),
            "by_component": verify.rows_by_component(fact),
            "sample": verify.sample_hosts(fact)}
