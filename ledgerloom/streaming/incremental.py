"""Incremental loads with Structured Streaming (extension).

The daily jobs list "today's folder" (or every log file) and append whatever is
there, so a rerun loads the same files twice. A file-source stream run with the
available-now trigger instead reads every file not yet recorded in its
checkpoint, writes it exactly once (Parquet file sink, or idempotent per-batch
folders for ``foreachBatch``), and stops. Checkpoints live under the session's
shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schemas as S
from ..operators import logs, report
from ..session import scratch_path
from ..sources import files, readers


def report_csv_schema(columns: list[str] | None = None) -> T.StructType:
    """All-string schema of the report CSV header (streams need a declared schema)."""
    cols = columns or S.REQUIRED_REPORT_COLUMNS
    return T.StructType([T.StructField(c, T.StringType()) for c in cols])


def report_csv_stream(spark: SparkSession, input_dir: str, columns: list[str] | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of report CSVs with the batch reader's options."""
    reader = (spark.readStream.schema(report_csv_schema(columns))
              .option("header", True).option("multiLine", True).option("escape", '"')
              .option("enforceSchema", False).option("recursiveFileLookup", True)
              .option("pathGlobFilter", files.CSV_FILE_GLOB))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(input_dir)


def run_available_now(df: DataFrame, output_path: str, checkpoint: str | None = None,
                      partition_by: list[str] | None = None, output_mode: str = "append") -> str:
    """Write a streaming DataFrame to Parquet until the input available now is done."""
    spark = df.sparkSession
    ckpt = checkpoint or scratch_path(spark, "stream-checkpoint")
    writer = (df.writeStream.format("parquet").outputMode(output_mode)
              .option("checkpointLocation", ckpt).option("path", output_path)
              .trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start().awaitTermination()
    return ckpt


def load_report_fact_incremental(spark: SparkSession, input_dir: str, output_path: str,
                                 checkpoint: str, as_of=None,
                                 columns: list[str] | None = None) -> DataFrame:
    """New report files since the last run, conformed to the fact, appended once.

    Returns the fact rows at ``output_path`` (all runs so far).
    """
    stream = report_csv_stream(spark, input_dir, columns)
    fact = report.backup_fact_report(stream, as_of=str(files.processing_date(as_of)))
    run_available_now(fact, output_path, checkpoint)
    return spark.read.schema(S.BACKUP_FACT).parquet(output_path)


def load_log_fact_incremental(spark: SparkSession, log_dir: str, output_path: str,
                              checkpoint: str, as_of=None,
                              glob: str | None = files.LOG_FILE_GLOB) -> DataFrame:
    """Backup sessions of the ``.log`` files not loaded by an earlier run.

    A log file is self-contained, so each micro-batch — the files that arrived
    since the last run — goes through the batch sessionizer as is. Batch ``n``
    is written to ``output_path/batch_id=n`` with overwrite, so a batch that is
    re-run after a failure replaces its own output instead of adding to it.
    Returns the fact rows at ``output_path`` (all runs so far).
    """
    load_date = str(files.processing_date(as_of))
    reader = spark.readStream.option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = readers.with_split(reader.text(log_dir))

    def load(batch: DataFrame, batch_id: int) -> None:
        fact = logs.backup_fact_log(logs.sessions(readers.log_lines(batch)), as_of=load_date)
        fact.write.mode("overwrite").parquet(f"{output_path}/batch_id={batch_id}")

    (stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(output_path).select(*S.BACKUP_FACT_COLUMNS)
