"""Backup sessions from multi-session backup log lines, as one distributed job.

Input: one row per log line, ``(file_path, chunk, line_no, value)``. ``line_no``
(non-negative) orders the lines of a file; ``chunk`` labels runs of consecutive lines (a split
of the file, or a fixed range of line numbers) so that no window ever has to hold
a whole file: one very long file is spread over as many tasks as it has chunks.
Lines read from files come with ``split_line`` instead, which orders the lines of one split;
``chunk`` is then the split's byte offset, and ``line_no`` follows from both.

Session rules (the parser's carried state, restated over sets):

* lines containing ``LOGBCKUP`` are dropped first;
* a line starting with ``yyyy-MM-dd`` puts that date in force (last one wins);
* a backint file line whose name ends in ``_0_1`` ignores the rest of its line
  (its date still counts); any other file line sets the backup type and name —
  differential names are built from the date in force at that line, and a
  differential line with no date in force makes the whole file yield nothing;
* host, status, end date and size are last-value-wins; size is not summed;
* a ``SAVE DATA finished`` line closes the session only if a date is in force;
  otherwise nothing is reset and the state carries on;
* lines after the last close are an unfinished session and are dropped.

A finish line closes iff some dated line lies between the previous finish line
(closing or not) and itself: a finish that closed nothing had no date behind it.
Inside one chunk this decides every finish but the chunk's first, which may
also close on a date handed over from earlier chunks. So the plan is:

1. the facts of each line are extracted where the line is read, lines without one are
   dropped, and one exchange on ``(file, chunk)`` carries the facts, not the text; running
   windows and an aggregate in the same tasks fold them into *pieces* — one row per
   session run inside a chunk (a whole session, or a chunk's head or tail);
2. the pieces (about one row per session) are written to the shared
   checkpoint folder, so nothing below reads the logs again;
3. the boundary pieces (at most three per chunk) carry a summary of their chunk. What a chunk hands
   on (last date, last finish, last close) combines associatively, so one exchange of the boundary
   pieces by file and a running maximum over them give every chunk what all earlier ones hand
   to it; in the same tasks the sessions that cross chunk borders are assembled. Whole
   sessions stay where they are. No window or group ever holds a file's lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.report import parse_period_date
from ..session import scratch_path

# Line shapes and defaults of the backup log. Patterns carry
# (?U) so that \w, \d and \S are Unicode-aware, as in Python's re.
DROP_MARKER = "LOGBCKUP"
DATE_PATTERN = r"(?U)^(\d{4}-\d{2}-\d{2})"
FILE_PATTERN = r"(?U)/usr/sap/HDB/SYS/global/hdb/backint/DB_HDB/([\w\d_-]+)"
HOST_PATTERN = r"(?U)state of service: .*?, (\S+):"
DIFFERENTIAL_COMMAND = "command: BACKUP DATA FOR HDB USING DIFFERENTIAL"
DIFFERENTIAL_FILE_MARKER = "databackup_differential"
SUCCESS_TEXT = "SAVE DATA finished successfully"
ERROR_TEXT = "SAVE DATA finished with error: [447] backup could not be completed"
SIZE_PATTERN = r"(?U)progress of service: .*?, volume: (\d+), 100% (\d+)/\d+"
FINISH_TEXT = "SAVE DATA finished"
IGNORED_FILE_SUFFIX = "_0_1"
DIFFERENTIAL_NAME_SUFFIX = "_07-30"
FULL_BACKUP_NAME = "COMPLETE_DATA_BACKUP"
TYPE_FULL = "full"
TYPE_DIFFERENTIAL = "differential"
STATUS_SUCCESSFUL = "successful"
STATUS_FAILED = "failed"
RESOURCE_TYPE = "HANA"
COMPONENT_TYPE = "HANA"
DEFAULT_SIZE = 0.0

KEY = ["file_path", "chunk"]


def _nullif_empty(c: Column) -> Column:
    return F.when(c != "", c)


def line_events(lines: DataFrame) -> DataFrame:
    """Per-line facts after dropping ``LOGBCKUP`` lines (steps 1-2).

    Columns beyond the input: ``line_date`` (string), ``backup_file``,
    ``ignored`` (``_0_1`` file line), ``differential`` (NULL on non-file lines),
    ``hostname``, ``status``, ``end_date``, ``size_bytes``, ``finished``, and
    ``undecodable`` (the line is not UTF-8; kept from the reader when given).
    """
    v = F.col("value")
    if "undecodable" not in lines.columns:
        lines = lines.withColumn("undecodable", ~F.is_valid_utf8(v))
    fname = _nullif_empty(F.regexp_extract(v, FILE_PATTERN, 1))
    ignored = F.coalesce(fname.endswith(IGNORED_FILE_SUFFIX), F.lit(False))
    acts = ~F.col("ignored")
    is_file = acts & F.col("backup_file").isNotNull()
    status = (F.when(acts & v.contains(SUCCESS_TEXT), F.lit(STATUS_SUCCESSFUL))
              .when(acts & v.contains(ERROR_TEXT), F.lit(STATUS_FAILED)))
    # A line that is not UTF-8 stays even with the marker: it drops its whole file later.
    return (lines.where(~v.contains(DROP_MARKER) | F.col("undecodable"))
            .withColumn("line_date", _nullif_empty(F.regexp_extract(v, DATE_PATTERN, 1)))
            .withColumn("backup_file", fname)
            .withColumn("ignored", ignored)
            .select(
                *lines.columns, "line_date", "backup_file", "ignored",
                F.when(is_file, F.col("backup_file").contains(DIFFERENTIAL_FILE_MARKER)
                       | v.contains(DIFFERENTIAL_COMMAND)).alias("differential"),
                F.when(acts, _nullif_empty(F.regexp_extract(v, HOST_PATTERN, 1))).alias("hostname"),
                status.alias("status"),
                F.when(status.isNotNull(), F.col("line_date")).alias("end_date"),
                F.when(acts, _nullif_empty(F.regexp_extract(v, SIZE_PATTERN, 2))
                       .try_cast("double")).alias("size_bytes"),
                (acts & v.contains(FINISH_TEXT)).alias("finished"),
            ))


def _last(value: Column, order: str = "line_no", when: Column | None = None) -> Column:
    """Last non-NULL ``value`` by ``order`` (or the value at the last row where ``when``)."""
    cond = value.isNotNull() if when is None else when
    return F.max_by(value, F.when(cond, F.col(order)))


def _diff_name(in_force: Column) -> Column:
    return F.concat(F.translate(in_force, "-", "_"), F.lit(DIFFERENTIAL_NAME_SUFFIX))


def line_facts(lines: DataFrame) -> DataFrame:
    """The lines that carry a fact, without their text, ordered by ``line_no`` in their file (by ``at`` in their chunk).

    Of lines read from files (``split_line``), ``line_no = 2 * chunk + rank in the split``: a
    split of the bytes B to E holds at most ``E - B + 1`` lines, so its last number is
    below ``2 * E``, the first of the next split.
    """
    facts = ["line_date", "differential", "hostname", "status", "size_bytes"]
    ev = line_events(lines)
    some = F.col("finished") | F.col("undecodable")
    for c in facts:
        some = some | F.col(c).isNotNull()
    order = "line_no" if "line_no" in lines.columns else "split_line"
    # A generator keeps the filter above the extraction: pushed below, each of its tests would run the patterns again.
    one = F.struct(*KEY, F.col(order).alias("at"), *facts, "end_date", "finished", "undecodable")
    ev = ev.select(F.explode(F.array(one)).alias("e")).select("e.*").where(some)
    if order == "line_no":
        return ev.withColumn("line_no", F.col("at"))
    # the windows of the pieces run in the same order, so lines are sorted once
    return ev.withColumn("line_no", F.col("chunk") * 2 + F.row_number().over(Window.partitionBy(*KEY).orderBy("at")) - 1)


def session_pieces(lines: DataFrame) -> DataFrame:
    """Lines folded into pieces: one row per session run inside one chunk.

    One exchange on ``(file_path, chunk)``; the windows and the aggregate that
    follow run in the tasks that received the lines. Per line, within its chunk:

    * ``ld``  last dated line so far (inclusive), ``pf`` previous finish line;
    * ``ca``  the finish closes judging by the chunk alone: a dated line lies
      after the previous finish. Exact for every finish but the chunk's first
      (``f1``), which may also close on a date carried from earlier chunks;
    * ``pc``  previous such close; ``piece`` = ``pc``, or ``-1`` up to ``f1``
      and ``-2`` after it while no local close has happened;
    * ``lif`` date in force from this chunk alone (exact once ``pc`` is set).

    A piece ``>= 0`` with a close is a whole session; the other pieces (at
    most three per chunk) continue or are continued by other chunks. A line
    that is not valid UTF-8 marks its piece, and with it the whole file, bad.
    """
    ev = line_facts(lines)
    run = Window.partitionBy(*KEY).orderBy("at")
    incl = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    excl = run.rowsBetween(Window.unboundedPreceding, -1)
    dated = F.col("line_date").isNotNull()
    w1 = ev.select(
        *KEY, "at", "line_no", "line_date", "end_date", "hostname", "status", "size_bytes",
        "finished", "differential", "undecodable",
        F.max(F.when(dated, F.struct(F.col("line_no").alias("at"), F.col("line_date").alias("d"))))
         .over(incl).alias("ld"),
        F.max(F.when(F.col("finished"), F.col("line_no"))).over(excl).alias("pf"))
    ca = (F.col("finished") & F.col("ld").isNotNull()
          & (F.col("pf").isNull() | (F.col("ld.at") > F.col("pf"))))
    w2 = w1.withColumn("ca", F.coalesce(ca, F.lit(False)))
    w2 = w2.withColumn("pc", F.max(F.when(F.col("ca"), F.col("line_no"))).over(excl))
    lif = F.when(F.col("ld").isNotNull() & (F.col("pc").isNull() | (F.col("ld.at") > F.col("pc"))),
                 F.col("ld.d"))
    is_file = F.col("differential").isNotNull()
    diff = F.coalesce(F.col("differential"), F.lit(False))
    per_line = w2.select(
        *KEY, "line_no", "line_date", "end_date", "hostname", "status", "size_bytes",
        "finished", "ca", "ld",
        F.coalesce(F.col("pc"), F.when(F.col("pf").isNull(), F.lit(-1)).otherwise(F.lit(-2)))
         .alias("piece"),
        is_file.alias("is_file"),
        F.when(is_file, F.when(diff, F.lit(TYPE_DIFFERENTIAL)).otherwise(F.lit(TYPE_FULL)))
         .alias("type_at"),
        F.when(is_file, F.when(diff, _diff_name(lif)).otherwise(F.lit(FULL_BACKUP_NAME)))
         .alias("name_at"),
        (diff & lif.isNull()).alias("undated_diff"),
        "undecodable",
    )
    pieces = per_line.groupBy(*KEY, "piece").agg(
        F.min("line_no").alias("first_line"),
        F.max(F.when(F.col("ca"), F.col("line_no"))).alias("close_at"),
        F.max(F.when(F.col("finished"), F.col("line_no"))).alias("fin_at"),
        F.max("ld").alias("ld"),
        _last(F.col("line_date")).alias("start_s"),
        _last(F.col("end_date")).alias("end_s"),
        _last(F.col("hostname")).alias("hostname"),
        _last(F.col("status")).alias("status"),
        _last(F.col("size_bytes")).alias("size"),
        _last(F.col("type_at"), when=F.col("is_file")).alias("backup_type"),
        _last(F.col("name_at"), when=F.col("is_file")).alias("name_local"),
        _last(F.col("undated_diff"), when=F.col("is_file")).alias("name_needs_carry"),
        F.bool_or("undated_diff").alias("undated_diff"),
        F.bool_or("undecodable").alias("undecodable"),
    )
    # What the chunk hands on, on each of its boundary pieces (the first of them is always -1).
    chunk = Window.partitionBy(*KEY)
    head = F.col("piece") == -1
    handed = F.struct(
        F.max("ld").over(chunk).alias("date"), F.max("fin_at").over(chunk).alias("finish"), F.max("close_at").over(chunk).alias("close"),
        F.max(F.when(head, F.col("fin_at"))).over(chunk).alias("f1"),
        F.bool_or(head & F.col("close_at").isNotNull()).over(chunk).alias("f1_local"),
        F.bool_or(((F.col("piece") >= 0) & F.col("undated_diff")) | F.col("undecodable")).over(chunk).alias("bad"),
        F.bool_or("undecodable").over(chunk).alias("undecodable"))
    return pieces.withColumn("handed", F.when((F.col("piece") < 0) | F.col("close_at").isNull(), handed))


def boundary_pieces(pieces: DataFrame) -> DataFrame:
    """The boundary pieces with what earlier chunks of their file hand to them; one exchange, by file.

    ``cif`` date in force at the chunk's start (a dated line after the last
    finish), ``f1_closes`` whether its first finish closes, ``c_pc`` the last
    close before it, ``file_bad`` whether any chunk drops the file (a line that
    is not UTF-8, or a differential line with no date in force). Each of these is a running
    maximum over the chunks before (a chunk's own rows are outside the frame).
    """
    b = pieces.where("handed IS NOT NULL")
    file = Window.partitionBy("file_path")
    earlier = file.orderBy("chunk").rangeBetween(Window.unboundedPreceding, -1)
    first = F.col("piece") == -1                    # one row speaks for its chunk
    b = b.select("*", F.max(F.when(first, F.col("handed.date"))).over(earlier).alias("c_ld"),
                 F.max(F.when(first, F.col("handed.finish"))).over(earlier).alias("c_lf"))
    carried_date = F.col("c_ld").isNotNull() & (F.col("c_lf").isNull()
                                                | (F.col("c_ld.at") > F.col("c_lf")))
    b = b.withColumn("cif", F.when(carried_date, F.col("c_ld.d")))
    b = b.withColumn("f1_closes", F.col("handed.f1").isNotNull()
                     & (F.col("handed.f1_local") | F.col("cif").isNotNull()))
    last_close = F.greatest(F.col("handed.close"), F.when(F.col("f1_closes"), F.col("handed.f1")))
    # A head line with no date of its own chunk is in force only with a carried date.
    bad = (F.col("handed.bad")
           | (first & F.col("undated_diff") & F.col("cif").isNull())
           | ((F.col("piece") == -2) & F.col("undated_diff") & (F.col("f1_closes") | F.col("cif").isNull())))
    return b.withColumn("c_pc", F.max(F.when(first, last_close)).over(earlier)) \
        .withColumn("file_bad", F.bool_or(F.coalesce(bad, F.lit(False))).over(file))


def spanning_sessions(boundary: DataFrame) -> DataFrame:
    """Sessions that cross chunk borders, assembled from the boundary pieces.

    A boundary piece is a chunk's head (``-1``, ``-2``) or its unfinished tail.
    Each is keyed by the close that precedes its session; the session's close is
    the one piece that ends it.
    """
    head_a, head_b = F.col("piece") == -1, F.col("piece") == -2
    # Date in force for lines that saw no date of their own chunk.
    carried = (F.when(head_a, F.col("cif"))
               .when(head_b & ~F.col("f1_closes"), F.col("cif")))
    key = (F.when(F.col("piece") >= 0, F.col("piece"))
           .when(head_b & F.col("f1_closes"), F.col("handed.f1"))
           .otherwise(F.coalesce(F.col("c_pc"), F.lit(-1))))
    ends = (F.when(head_a & F.col("f1_closes"), F.col("handed.f1"))
            .when(head_b, F.col("close_at")))
    name = F.when(F.col("name_needs_carry") & (F.col("backup_type") == TYPE_DIFFERENTIAL),
                  _diff_name(carried)).otherwise(F.col("name_local"))
    parts = boundary.where(~F.col("file_bad")).select(
        "file_path", "first_line", "start_s", "end_s", "hostname", "status", "size",
        "backup_type", key.alias("skey"), ends.alias("ends"), name.alias("backup_name"))
    return parts.groupBy("file_path", "skey").agg(
        F.max("ends").alias("close_line"),
        *[_last(F.col(c), "first_line").alias(c)
          for c in ("start_s", "end_s", "hostname", "status", "size")],
        _last(F.col("backup_type"), "first_line").alias("backup_type"),
        _last(F.col("backup_name"), "first_line",
              when=F.col("backup_type").isNotNull()).alias("backup_name"),
    )


def stored_pieces(lines: DataFrame) -> DataFrame:
    """:func:`session_pieces` written to the shared folder (about one row per session): the several
    small steps that read them do not read the logs again."""
    pieces = session_pieces(lines)
    path = scratch_path(pieces.sparkSession, "session-pieces")
    pieces.write.parquet(path)
    return pieces.sparkSession.read.schema(pieces.schema).parquet(path)


def sessions(lines: DataFrame) -> DataFrame:
    """One row per closed backup session; the lines are read and their facts shuffled once.

    Columns: ``file_path, close_line, report_period_start, report_period_end,
    hostname, backup_type, backup_name, status, backup_size_bytes``.
    """
    return sessions_of(stored_pieces(lines))


def skipped_files(pieces: DataFrame) -> DataFrame:
    """``file_path, reason`` of the files that yield nothing because of one of their lines."""
    bad = boundary_pieces(pieces).where("file_bad")
    return bad.groupBy("file_path").agg(F.when(F.bool_or("handed.undecodable"), "not UTF-8")
                                        .otherwise("differential backup without a date").alias("reason"))


def sessions_of(pieces: DataFrame) -> DataFrame:
    """:func:`sessions` from pieces."""
    boundary = boundary_pieces(pieces)
    local = (pieces.where((F.col("piece") >= 0) & F.col("close_at").isNotNull())
             .select("file_path", F.col("close_at").alias("close_line"), "start_s", "end_s",
                     "hostname", "status", "size", "backup_type",
                     F.col("name_local").alias("backup_name")))
    bad_files = boundary.where("file_bad").select("file_path").distinct()
    spanning = spanning_sessions(boundary).where(F.col("close_line").isNotNull()).drop("skey")
    closed = local.join(bad_files, "file_path", "left_anti").unionByName(spanning)
    return (closed.select(
                "file_path", "close_line",
                parse_period_date("start_s").alias("report_period_start"),
                parse_period_date("end_s").alias("report_period_end"),
                "hostname",
                F.coalesce("backup_type", F.lit(TYPE_FULL)).alias("backup_type"),
                "backup_name",
                F.coalesce("status", F.lit(STATUS_FAILED)).alias("status"),
                F.coalesce("size", F.lit(DEFAULT_SIZE)).alias("backup_size_bytes"),
            ))


def backup_fact_log(sessions_df: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """Sessions conformed to the 10-column backup fact."""
    load_date = (F.current_date() if as_of is None
                 else F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of)
    return sessions_df.select(
        "report_period_start", "report_period_end",
        F.lit(RESOURCE_TYPE).alias("resource_type"),
        F.lit(COMPONENT_TYPE).alias("component_type"),
        "backup_name", "hostname", "backup_type", "status",
        F.col("backup_size_bytes").cast("double").alias("backup_size_bytes"),
        load_date.alias("load_date"),
    )


def sessions_by_status(sessions_df: DataFrame) -> DataFrame:
    """Session counts by backup type and status."""
    return sessions_df.groupBy("backup_type", "status").agg(F.count(F.lit(1)).alias("sessions"))
