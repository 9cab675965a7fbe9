"""Readers of the mart's raw inputs: report CSVs, page-view JSON, backup logs, consent.

Each reader returns a lazy DataFrame; file options are fixed here so that every
job reads the same way.
"""

from __future__ import annotations

import csv
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..schemas import MissingColumnsError
from ..session import scratch_path
from .files import CSV_FILE_GLOB, LOG_FILE_GLOB

CORRUPT_COLUMN = "_corrupt_record"


# ------------------------------------------------------------------ report CSV

def read_report_csv(spark: SparkSession, paths: str | list[str], glob: str | None = CSV_FILE_GLOB,
                    recursive: bool = True, multi_line: bool = True,
                    schema: T.StructType | None = None) -> DataFrame:
    """Backup-report CSVs: header row, every column a string, quoted multi-line fields.

    ``"`` inside a quoted field is escaped by doubling it. ``enforceSchema`` is off
    so a file whose header differs from the first file's fails the read instead of
    having its columns silently misassigned. A multi-line CSV file is read by one
    task (it cannot be split), so parallelism comes from the number of files;
    ``multi_line=False`` lets Spark split large files when the producer never
    puts a line break inside a field.
    """
    reader = (spark.read.option("header", True).option("inferSchema", False)
              .option("multiLine", multi_line).option("escape", '"').option("quote", '"')
              .option("enforceSchema", False).option("mode", "PERMISSIVE")
              .option("recursiveFileLookup", recursive))
    if schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.csv(paths)


#: Different headers a folder may have; each is one read.
MOST_HEADERS = 100


def report_headers(spark: SparkSession, paths: str | list[str], glob: str | None = CSV_FILE_GLOB,
                   recursive: bool = True) -> DataFrame:
    """``header`` (its line as text) and ``source_file`` of every CSV; a header is one line.

    Only the first split of each file is looked at, and one row a file leaves a task."""
    reader = spark.read.option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(paths).where("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("source_file"), "value", F.monotonically_increasing_id().alias("at"))
    return lines.groupBy("source_file").agg(F.min_by("value", "at").alias("header"))


def read_report_csv_by_header(spark: SparkSession, paths: str | list[str], required: list[str], glob: str | None = CSV_FILE_GLOB,
                              recursive: bool = True, multi_line: bool = True) -> DataFrame:
    """The ``required`` columns of report CSVs whose headers differ: other orders, further columns.

    Each group of files with one header is read by name, with the options of :func:`read_report_csv`. A group that
    lacks a required column refuses the batch before anything is read.
    """
    groups = report_headers(spark, paths, glob, recursive).groupBy("header").agg(F.collect_list("source_file").alias("files"), F.count("*").alias("n"))
    known = [r.header for r in groups.select("header").limit(MOST_HEADERS + 1).collect()]
    if len(known) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers below {paths}")
    columns = {h: next(csv.reader([h.removeprefix("\ufeff")]), []) for h in known}
    for header, names in columns.items():
        missing = [c for c in required if c not in names]
        if missing:
            raise MissingColumnsError(f"missing required columns: {missing} in header {header!r}")
        if len(set(names)) < len(names):
            raise MissingColumnsError(f"columns named twice in header {header!r}")
    out = None
    for header, names in columns.items():
        files = [f for r in groups.where(F.col("header") == header).select("files").collect() for f in r.files]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        part = read_report_csv(spark, [url_path(f) for f in files], None, False, multi_line, schema).select(*[F.col(f"`{c}`") for c in required])
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in required]))
    return out


def url_path(encoded: str) -> str:
    """The path that ``_metadata.file_path`` holds URL-encoded."""
    return unquote(encoded)


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the source file's path, size and modification time to every row."""
    return df.select("*",
                     F.col("_metadata.file_path").alias("source_file"),
                     F.col("_metadata.file_size").alias("source_file_size"),
                     F.col("_metadata.file_modification_time").alias("source_file_modified"))


# -------------------------------------------------------------- page-view JSON

def read_pageview_json(spark: SparkSession, paths: str | list[str], recursive: bool = False,
                       glob: str | None = None) -> DataFrame:
    """Page-view JSON lines under the declared nested schema.

    Missing fields are NULL; of several objects on one line only the first is
    kept; blank lines are skipped. A line that is an array gives a row per element.
    A record that does not parse keeps its text in ``_corrupt_record``; its fields that did
    parse keep their values. :func:`split_corrupt` sorts them out. ``recursive`` must be
    asked for explicitly: without it only the folder itself and ``key=value`` subfolders are read.

    Lines are parsed with ``from_json`` over a text scan, so any query may use the
    corrupt-record column, including a plain ``count()`` of the valid rows.
    """
    schema = T.StructType(S.PAGEVIEW_JSON.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    reader = spark.read.option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    text = reader.text(paths)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    one = F.from_json("value", schema, options)
    # An array is cut into its elements' texts, and each is parsed like a line of its own.
    elements = F.from_json("value", T.ArrayType(T.StringType()))
    broken = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in S.PAGEVIEW_JSON.fields],
                      F.col("value").alias(CORRUPT_COLUMN))
    many = F.when(elements.isNull(), F.array(broken)).otherwise(
        F.transform(elements, lambda e: F.from_json(e, schema, options)))
    is_array = F.ltrim("value").startswith("[")
    return (text.where(F.trim("value") != "")
            .select(F.explode(F.when(is_array, many).otherwise(F.array(one))).alias("_j"),
                    F.col("_metadata.file_path").alias("_source_file"))
            .select("_j.*", "_source_file"))


def split_corrupt(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to load, corrupt records as ``record, source_file, loaded``).

    A corrupt record with any usable field is loaded with what it has (``loaded``) and listed
    as corrupt as well; one without is only listed.
    """
    fields = [f.name for f in S.PAGEVIEW_JSON.fields if not isinstance(f.dataType, T.StructType)]
    fields += [f"visitor_details.{f.name}" for f in S.VISITOR_DETAILS.fields]
    usable = F.coalesce(*[F.col(name) for name in fields]).isNotNull()
    corrupt = F.col(CORRUPT_COLUMN).isNotNull()
    ok = raw.where(~corrupt | usable).drop(CORRUPT_COLUMN, "_source_file")
    bad = raw.where(corrupt).select(F.col(CORRUPT_COLUMN).alias("record"),
                                    F.col("_source_file").alias("source_file"), usable.alias("loaded"))
    return ok, bad


def flatten_pageview(nested: DataFrame) -> DataFrame:
    """The six ``visitor_details`` fields lifted to top level (NULL struct -> NULL fields)."""
    top = ["account_hashid", "session_hashid", "consent_hashid", "page_url", "timestamp"]
    inner = [f.name for f in S.VISITOR_DETAILS.fields]
    return nested.select(*top, *[F.col(f"visitor_details.{n}").alias(n) for n in inner])


def typed_pageview(flat: DataFrame, timestamp_format: str | None = None) -> DataFrame:
    """Flat page views typed for the reporting views (extension).

    ``timestamp`` text becomes a ``TIMESTAMP_NTZ`` (NULL when unparsable), which
    also fills ``created_at``; ``year/month/day`` are its date parts as strings.
    """
    text = F.col("timestamp")
    parsed = (F.try_to_timestamp(text, F.lit(timestamp_format)) if timestamp_format
              else F.try_to_timestamp(text))
    ts = parsed.cast("timestamp_ntz")
    return flat.select(
        "account_hashid", "session_hashid", "consent_hashid", "page_url",
        ts.alias("created_at"), ts.alias("timestamp"),
        F.date_format(ts, "yyyy").alias("year"), F.date_format(ts, "MM").alias("month"),
        F.date_format(ts, "dd").alias("day"),
    )


# ----------------------------------------------------------------- backup logs

def read_backup_log(spark: SparkSession, paths: str | list[str], glob: str | None = LOG_FILE_GLOB,
                    recursive: bool = True) -> DataFrame:
    """Backup log files as ``(file_path, chunk, split_line, value, undecodable)``, one row per line.

    ``chunk`` is the byte offset of the file split that holds the line; splits of one file
    never overlap, and each is read by one task in line order. ``split_line`` orders the lines of
    one split (and nothing else): ``monotonically_increasing_id`` over the rows the
    split's task makes. No shuffle is needed to read or order the lines.
    """
    reader = spark.read.option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return log_lines(with_split(reader.text(paths)))


def log_lines(split_rows: DataFrame) -> DataFrame:
    """Ordered log lines from :func:`with_split` rows (batch, or one stream batch); must sit on the scan.

    For a stream, call it inside ``foreachBatch``: the micro-batch is a plain scan of its files.
    """
    return split_python_lines(split_rows).select(
        "file_path", "chunk", F.monotonically_increasing_id().alias("split_line"), "value", "undecodable")


# The line breaks Python's str.splitlines() knows beyond \n, \r and
# \r\n (which the text source already splits on): \v, \f, \x1c, \x1d, \x1e,
# \x85, U+2028, U+2029.
EXTRA_LINE_BREAKS = "[\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"


def split_python_lines(lines: DataFrame) -> DataFrame:
    """Split physical lines further where Python's ``splitlines`` would, in order, in place.

    ``undecodable`` flags parts of a physical line that is not valid UTF-8. A separator at
    the end of a line leaves an empty last part, which matches no rule.
    """
    # Byte-level tests first: only lines that hold a break pay for the split.
    has_break = F.lit(False)
    for ch in EXTRA_LINE_BREAKS[1:-1]:
        has_break = has_break | F.col("value").contains(ch)
    parts = F.when(has_break, F.split("value", EXTRA_LINE_BREAKS)).otherwise(F.array("value"))
    # Splitting decodes the line, so byte validity is judged on the physical line.
    return lines.select("file_path", "chunk", (~F.is_valid_utf8("value")).alias("undecodable"),
                        F.explode(parts).alias("value"))


def with_split(text: DataFrame) -> DataFrame:
    """``(file_path, chunk, value)`` from a text scan (batch or streaming)."""
    return text.select(F.col("_metadata.file_path").alias("file_path"),
                       F.col("_metadata.file_block_start").alias("chunk"), "value")


# File name endings that Hadoop's text reader decompresses.
COMPRESSED_SUFFIXES = [".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate"]
#: Compressed files above this size are not tried whole (a try holds the decompressed file).
TRIED_WHOLE = 128 << 20


def list_logs(spark: SparkSession, paths: str | list[str], glob: str | None = LOG_FILE_GLOB,
              recursive: bool = True) -> DataFrame:
    """``file_path, file_size`` of the log files there are now, written down (later changes of the folder do not show)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("ignoreMissingFiles", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(paths).select("_metadata.file_path", "_metadata.file_size")
    path = scratch_path(spark, "log-listing")
    files.write.parquet(path)
    return spark.read.schema(files.schema).parquet(path)


def failed_on_a_file(error: BaseException) -> bool:
    """Whether a job failed because one of its input files could not be read."""
    return "FAILED_READ_FILE" in str(error)


def read_logs_apart(spark: SparkSession, paths: str | list[str], listing: DataFrame, glob: str | None = LOG_FILE_GLOB,
                    recursive: bool = True) -> tuple[DataFrame, DataFrame]:
    """Lines of the listed logs that can be read whole, and ``file_path, reason`` of the others.

    Spark's tolerant reader stops a broken file where it breaks and says nothing, so what was read is
    held against the listing. The lines are read once and written to the shared folder with
    their bytes. Only ``\\n`` ends a physical line here (``\\r`` is split off like the other breaks), so that an
    uncompressed file was read whole iff its bytes add up to its size (less a byte order mark).
    A compressed file is tried whole, without its text: a file that breaks then gives no row.
    One of more than ``TRIED_WHOLE`` compressed bytes is not tried and listed. A broken file gives no line at all.
    """
    def tolerant(**how) -> DataFrame:
        reader = spark.read.option("recursiveFileLookup", recursive).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
        return (reader.option("pathGlobFilter", glob) if glob else reader).text(paths, **how)

    physical = with_split(tolerant(lineSep="\n"))
    parts = F.split("value", "\r\n?|" + EXTRA_LINE_BREAKS)
    lines = physical.select("file_path", "chunk", F.col("value").alias("line"), F.posexplode(parts).alias("nth", "value")).select(
        "file_path", "chunk", F.monotonically_increasing_id().alias("split_line"), "value",
        (~F.is_valid_utf8("line")).alias("undecodable"), F.when(F.col("nth") == 0, F.octet_length("line") + 1).otherwise(0).alias("bytes"))
    path = scratch_path(spark, "log-lines-apart")
    lines.write.parquet(path)
    stored = spark.read.schema(lines.schema).parquet(path)

    def ends(column: str) -> Column:
        found = F.lit(False)
        for suffix in COMPRESSED_SUFFIXES:
            found = found | F.col(column).endswith(suffix)
        return found

    tried = tolerant(wholetext=True) \
        .where(ends("_metadata.file_path") & (F.col("_metadata.file_size") <= TRIED_WHOLE)) \
        .select(F.col("_metadata.file_path").alias("file_path"), F.lit(True).alias("tried"))
    there = list_logs(spark, paths, glob, recursive).select("file_path", F.lit(True).alias("there"))
    read = stored.groupBy("file_path").agg(F.sum("bytes").alias("bytes"))
    whole = F.when(ends("file_path"), F.col("tried")).otherwise(F.col("bytes") >= F.col("file_size") - 3)
    reason = (F.when(F.coalesce(whole, F.col("file_size") == 0, F.lit(False)), F.lit(None))
              .when(F.col("there").isNull(), "vanished")
              .when(ends("file_path") & (F.col("file_size") > TRIED_WHOLE), "compressed and too large to be tried whole")
              .otherwise("cannot be read to its end"))
    checked = listing.join(read, "file_path", "left").join(tried, "file_path", "left").join(there, "file_path", "left") \
        .select("file_path", reason.alias("reason"))
    path = scratch_path(spark, "logs-checked")
    checked.write.parquet(path)
    checked = spark.read.schema(checked.schema).parquet(path)
    good = checked.where("reason IS NULL").select("file_path")
    return stored.drop("bytes").join(good, "file_path", "left_semi"), checked.where("reason IS NOT NULL")


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``line_number``: the 1-based position of each line in its file.

    The logs are scanned once, into a table in the shared folder. The position is the line's
    index in its split plus the line count of the file's earlier splits; only one
    summary row per split is shuffled, never the text.
    """
    path = scratch_path(lines.sparkSession, "log-lines")
    lines.write.parquet(path)
    stored = lines.sparkSession.read.schema(lines.schema).parquet(path)
    sizes = stored.groupBy("file_path", "chunk").agg(F.count(F.lit(1)).alias("_n"),
                                                     F.min("split_line").alias("_first"))
    earlier = Window.partitionBy("file_path").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    carry = sizes.select("file_path", "chunk",
                         (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_carry"))
    return (stored.join(carry, ["file_path", "chunk"], "inner")
            .withColumn("line_number", F.col("_carry") + F.col("split_line") + 1)
            .drop("_carry"))


# ------------------------------------------------------------- consent table

def read_consent(spark: SparkSession, name: str) -> DataFrame:
    """The partitioned consent table by catalog name.

    Its partitions are registered, so a filter on ``account_hashid/year/month/day`` is
    answered by the catalog and only the folders that match are listed.
    """
    return spark.table(name)


def read_consent_path(spark: SparkSession, root: str) -> DataFrame:
    """The partitioned consent files by path, for a folder without a table.

    The declared schema keeps ``year='05'`` a string instead of the inferred int ``5``.
    The driver lists every folder first; prefer the table.
    """
    return spark.read.schema(S.CONSENT).parquet(root)
