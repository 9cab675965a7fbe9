"""Backup logs that grow between runs: sessions of a log delivered part by part.

A log arrives as numbered parts (``x.log.0``, ``x.log.1``, …), each with whole lines, over many
runs. A session may begin in one part and end in a later one, so a run hands on, per log, what the
next lines depend on: the last date, the last finish line, the last close, the fields of the open session, and
whether the log is to be dropped. This state is one row per log. The lines of a
part are never seen again.

The micro-batch goes through the batch sessionizer's split-local pieces
(:func:`..operators.logs.session_pieces`); the state of the logs in the batch joins them as the
pieces of a split before all others, and the prefix scan of
:func:`..operators.logs.boundary_pieces` does the rest. So a part of any size is spread over its
splits, and no task holds a log. (Keyed operators such as ``applyInPandasWithState`` would
bring all lines of a log to one task.)

State and sessions of batch ``n`` are written to folders ``batch=n`` with overwrite, and
batch ``n`` reads only states of earlier batches: a batch that is run again after a failure replaces its own
output. A batch writes the states of its own logs only.

Defined results: once all parts are there, the sessions are those of the whole log. Lines after the
last close wait for later parts. A line that is not UTF-8, or an undated differential line, drops the whole
log, also the sessions of earlier parts. So does a part that is missing, repeated or later than its
successor (``reason`` says which); parts count from 0, and a part
without any line counts as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import logs
from ..session import scratch_path
from ..sources import readers

#: Name of a part: the log's path, and the number of the part.
PART_NAME = r"^(.*\.log)\.(\d+)$"
#: A part's lines are numbered from its number times this: twice the bytes of a part stay below it.
PART_LINES = 1 << 42
MAX_FILES = 10_000

_OPEN = "start_s string, end_s string, hostname string, status string, size double, backup_type string, backup_name string"
STATE = ("file_path string, last_part long, reason string, date struct<at: bigint, d: string>, finish long, close long, "
         + _OPEN)
_OPEN_FIELDS = [c.split()[0] for c in _OPEN.split(", ")]
OUT_OF_ORDER = "part missing, repeated or out of order"
UNDATED = "differential backup without a date"
NOT_UTF8 = "not UTF-8"


def numbered(pieces: DataFrame, part_name: str = PART_NAME) -> DataFrame:
    """Pieces of parts as pieces of their logs: ``file_path`` becomes the log's, and line numbers and splits follow the part's number."""
    by = F.regexp_extract("file_path", part_name, 2).cast("long") * PART_LINES

    def date(c: Column) -> Column:
        return F.when(c.isNotNull(), F.struct((c["at"] + by).alias("at"), c["d"].alias("d")))

    handed = F.col("handed")
    moved = handed
    for name in ("finish", "close", "f1"):
        moved = moved.withField(name, handed[name] + by)
    return pieces.withColumns({
        "chunk": F.col("chunk") + by, "piece": F.when(F.col("piece") >= 0, F.col("piece") + by).otherwise(F.col("piece")),
        **{c: F.col(c) + by for c in ("first_line", "close_at", "fin_at")}, "ld": date(F.col("ld")),
        "handed": F.when(handed.isNotNull(), moved.withField("date", date(handed["date"]))),
        "file_path": F.regexp_extract("file_path", part_name, 1)})


def carried_pieces(state: DataFrame, like: DataFrame) -> DataFrame:
    """The state of logs as pieces of a split before all others: one that speaks for it, and the open session."""
    bad = F.col("reason").isNotNull()
    handed = F.struct(F.col("date"), F.col("finish"), F.col("close"), F.lit(None).cast("long").alias("f1"),
                      F.lit(False).alias("f1_local"), bad.alias("bad"), F.coalesce(F.col("reason") == NOT_UTF8, F.lit(False)).alias("undecodable"))
    fixed = {"chunk": F.lit(-1), "first_line": F.lit(-1), "undated_diff": F.lit(False), "undecodable": F.lit(False),
             "name_needs_carry": F.lit(False), "handed": handed}
    open_session = fixed | {c: F.col(c) for c in _OPEN_FIELDS if c != "backup_name"} | {
        "name_local": F.col("backup_name"), "piece": F.coalesce("close", F.lit(-1))}

    def row(values: dict[str, Column]) -> Column:
        return F.struct(*[(F.col("file_path") if f.name == "file_path" else values.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
                          for f in like.schema])

    return state.select(F.explode(F.array(row(fixed | {"piece": F.lit(-1)}), row(open_session))).alias("p")).select("p.*")


def latest_state(spark: SparkSession, output_path: str, before: int | None = None) -> DataFrame:
    """The newest state of every log, of the batches before ``before``."""
    rows = spark.read.schema(STATE + ", batch long").parquet(f"{output_path}/state")
    if before is not None:
        rows = rows.where(F.col("batch") < before)
    return rows.groupBy("file_path").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "file_path"]), "batch").alias("s")) \
        .select("file_path", "s.*").drop("batch")


def next_state(pieces: DataFrame, arrived: DataFrame, before: DataFrame) -> DataFrame:
    """The state after a batch, of the logs that have parts in it (``arrived``: ``file_path, first, last, n``)."""
    boundary = logs.boundary_pieces(pieces)
    last_close = F.greatest("handed.close", F.when(F.col("f1_closes"), F.col("handed.f1")))
    facts = boundary.groupBy("file_path").agg(
        F.max("handed.date").alias("date"), F.max("handed.finish").alias("finish"), F.max(last_close).alias("close"),
        F.bool_or("file_bad").alias("bad"), F.bool_or("handed.undecodable").alias("undecodable"))
    unfinished = logs.spanning_sessions(boundary).where("close_line IS NULL").select("file_path", "skey", *_OPEN_FIELDS)
    known = before.select("file_path", F.col("last_part").alias("known_part"), F.col("reason").alias("known_reason"))
    after = F.coalesce("known_part", F.lit(-1))
    rows = arrived.join(known, "file_path", "left").join(facts, "file_path", "left") \
        .withColumn("skey", F.coalesce("close", F.lit(-1))).join(unfinished, ["file_path", "skey"], "left")
    reason = F.coalesce(
        "known_reason", F.when((F.col("first") != after + 1) | (F.col("last") != after + F.col("n")), F.lit(OUT_OF_ORDER)),
        F.when(F.col("undecodable"), F.lit(NOT_UTF8)), F.when(F.col("bad"), F.lit(UNDATED)))
    return rows.select("file_path", F.greatest(after, "last").alias("last_part"), reason.alias("reason"),
                       "date", "finish", "close", *_OPEN_FIELDS)


def load_growing_logs(spark: SparkSession, parts_dir: str, output_path: str, checkpoint: str, part_name: str = PART_NAME,
                      max_files: int = MAX_FILES) -> None:
    """Load the parts that arrived since the last run; at most ``max_files`` of them in one batch.

    Sessions go to ``output_path/sessions``, states to ``output_path/state``. Parts that one
    batch holds may have come in any order; a batch takes the oldest first.
    """
    spark.createDataFrame([], STATE).write.mode("overwrite").parquet(f"{output_path}/state/batch=-1")
    stream = spark.readStream.option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files).text(parts_dir)
    is_part = F.col("file_path").rlike(part_name)

    def load(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()            # the names of the parts, at most max_files, from the one scan
        rows = batch.where(is_part).observe(seen, F.collect_set("file_path").alias("names"))
        new = numbered(logs.session_pieces(readers.log_lines(rows)), part_name)
        path = scratch_path(spark, "grown-pieces")
        new.write.parquet(path)
        if spark.read.schema(new.schema).parquet(path).isEmpty():   # no fact at all: the adaptive plan drops the scan and what it observed
            names = [r[0] for r in batch.where(is_part).select("file_path").distinct().collect()]
        else:
            names = seen.get["names"]
        number = F.regexp_extract("name", part_name, 2).cast("long")
        arrived = spark.createDataFrame([(x,) for x in names], "name string") \
            .groupBy(F.regexp_extract("name", part_name, 1).alias("file_path")) \
            .agg(F.min(number).alias("first"), F.max(number).alias("last"), F.count_distinct(number).alias("n"))
        before = latest_state(spark, output_path, batch_id).join(arrived, "file_path", "left_semi")
        carried_pieces(before, new).write.mode("append").parquet(path)
        pieces = spark.read.schema(new.schema).parquet(path)
        logs.sessions_of(pieces).write.mode("overwrite").parquet(f"{output_path}/sessions/batch={batch_id}")
        next_state(pieces, arrived, before).write.mode("overwrite").parquet(f"{output_path}/state/batch={batch_id}")

    (readers.with_split(stream).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def sessions(spark: SparkSession, output_path: str) -> DataFrame:
    """All closed sessions so far, of the logs that are not dropped."""
    dropped = latest_state(spark, output_path).where("reason IS NOT NULL").select("file_path")
    return spark.read.parquet(f"{output_path}/sessions").drop("batch").join(dropped, "file_path", "left_anti")


def dropped_logs(spark: SparkSession, output_path: str) -> DataFrame:
    """``file_path, reason`` of the logs that yield nothing."""
    return latest_state(spark, output_path).where("reason IS NOT NULL").select("file_path", "reason")
