"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

import ledgerloom
from ledgerloom.session import scratch_path

#: Arrow batches handed to Python stay below this many bytes, whatever the texts' lengths.
BATCH_BYTES = 16 << 20
#: Rows a file of narrow rows gets at least, where their number is known beforehand.
PART_ROWS = 50_000


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches of long texts by bytes, not only by rows, and let Python workers import this package."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc, root = spark.sparkContext, Path(ledgerloom.__file__).resolve().parent
    if str(root.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_ledgerloom_sent", False):
        return
    # not on the workers' path: send the sources along, as --py-files would
    target = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-py-"), "ledgerloom.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    sc.addPyFile(target)
    sc._ledgerloom_sent = True


def table(df: DataFrame, name: str, most_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads the files instead of recomputing
    Python stages, and later jobs see exactly the rows that were written. ``most_rows``, a bound
    of the number of (narrow) rows, keeps small results from being written as many tiny files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df if most_rows is None else df.coalesce(1 + most_rows // PART_ROWS)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the strings of ``column`` in one slice take about ``limit`` bytes (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at = np.concatenate([[0], np.cumsum(sizes)])
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(at, at[start] + limit, side="right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def with_rows(docs: DataFrame) -> DataFrame:
    """One struct column ``_row`` of all columns: rows pass through Python whole, whatever their columns are called."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def row_batches(batches: Iterator[pa.RecordBatch], limit: int = 4 << 20) -> Iterator[tuple[pa.Array, dict[str, pa.Array]]]:
    """Slices of ``with_rows`` batches by the size of the texts: the structs, and their fields by name."""
    for batch in batches:
        rows = batch.column("_row")
        names = [f.name for f in rows.type]
        fields = dict(zip(names, rows.flatten()))
        for part in slices([pa.RecordBatch.from_arrays([rows, *fields.values()], ["_row", *names])], "text", limit):
            yield part.column(0), dict(zip(names, part.columns[1:]))
