"""File selection and file metadata as data.

Selection happens where Spark lists files — a date-templated folder, a glob on
folder names and ``pathGlobFilter`` on file names — so files that are not
selected are never opened, not even for CSV header inference. Spark's listing
already leaves out zero-byte files. Listings are DataFrames from the
``binaryFile`` source with the ``content`` column pruned: only paths, sizes and
modification times are read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Name markers of the backup-report delivery layout.
REPORT_FOLDER_MARKER = "backup_jobs_report_"
REPORT_FILE_MARKER = "backup_job_report_"
CSV_SUFFIX = ".csv"
LOG_SUFFIX = ".log"


def no_case_glob(text: str) -> str:
    """Glob that matches ``text`` in any letter case (``csv`` -> ``[cC][sS][vV]``)."""
    return "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in text)


CSV_FILE_GLOB = "*" + no_case_glob(CSV_SUFFIX)
LOG_FILE_GLOB = "*" + LOG_SUFFIX
REPORT_FILE_GLOB = "*" + no_case_glob(REPORT_FILE_MARKER) + CSV_FILE_GLOB


def processing_date(as_of: dt.date | dt.datetime | str | None = None) -> dt.date:
    """The processing day: ``as_of`` or today in UTC."""
    if as_of is None:
        return dt.datetime.now(dt.timezone.utc).date()
    if isinstance(as_of, str):
        return dt.date.fromisoformat(as_of[:10])
    return as_of.date() if isinstance(as_of, dt.datetime) else as_of


def day_folder(base: str, as_of: dt.date | dt.datetime | str | None = None) -> str:
    """``base/YYYY/MM/DD/`` for the processing day."""
    return f"{base.rstrip('/')}/{processing_date(as_of):%Y/%m/%d}/"


def report_folders(base: str, as_of=None) -> str:
    """Glob over the day's report folders (name contains the marker, any case)."""
    return f"{day_folder(base, as_of)}*{no_case_glob(REPORT_FOLDER_MARKER)}*/"


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None,
               recursive: bool = True) -> DataFrame:
    """File listing as rows: ``file_path, file_name, file_size, file_modification_time``.

    An input path that does not exist gives an empty listing, not an error.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        df = reader.load(path)
    except AnalysisException as e:  # a missing folder means "no input" for a daily load
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame(
            [], "file_path string, file_name string, file_size bigint, "
                "file_modification_time timestamp")
    return df.select(
        F.col("path").alias("file_path"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("file_modification_time"),
    )


def report_files(listing: DataFrame) -> DataFrame:
    """Non-empty listed files whose path holds the report file marker and ends in ``.csv`` (any case)."""
    path = F.lower("file_path")
    return listing.where(path.contains(REPORT_FILE_MARKER) & path.endswith(CSV_SUFFIX) & (F.col("file_size") > 0))


def files_newest_first(listing: DataFrame) -> DataFrame:
    """The listing ordered by modification time, newest first (ties by path).

    Only the listing is ordered: the rows read from the files do not depend on it.
    """
    return listing.orderBy(F.col("file_modification_time").desc(), F.col("file_path"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` (file, folder or glob) matches anything, via Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(hconf)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def path_state(spark: SparkSession, path: str) -> str:
    """Size and latest modification time of a file, or of the files of a folder; empty if there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return ""
    return f"{fs.getContentSummary(p).getLength()}@{max(s.getModificationTime() for s in [fs.getFileStatus(p), *fs.listStatus(p)])}"
