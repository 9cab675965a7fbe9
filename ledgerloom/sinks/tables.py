"""Catalog tables and Parquet outputs of the mart.

Loads append and never de-duplicate: running a load twice stores its rows twice,
as the daily jobs do. Every write reports the rows it wrote through an
``Observation`` filled by the write job itself, so the input is not read a
second time to count it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators import views
from ..session import scratch_path
from . import folders


class ColumnMismatchError(ValueError):
    """The batch's columns are not those of the table; nothing is written."""


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_table_if_absent(spark: SparkSession, name: str, schema: T.StructType, location: str,
                           partition_by: list[str] | None = None) -> bool:
    """Create an empty Parquet table at ``location`` unless ``name`` exists.

    Returns ``True`` when the table was created. No rows are written: the
    declared schema alone defines the table, so a later append by name works
    even if the first batch is empty.
    """
    if table_exists(spark, name):
        return False
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{parts} "
              f"LOCATION '{_quoted(location)}'")
    return True


def _counted(df: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    obs = Observation(label)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _rows(obs: Observation) -> int:
    return int(obs.get.get("rows", 0))


def append_by_name(df: DataFrame, name: str, location: str | None = None) -> int:
    """Append ``df`` to table ``name``, matching columns by name; returns rows written.

    The table is created from ``df`` (at ``location`` when given) if it does not
    exist. Columns of ``df`` are put in the table's order first, so a batch with
    its columns in another order lands in the right columns. A batch whose columns
    are not the table's is refused.
    """
    spark = df.sparkSession
    if table_exists(spark, name):
        known = spark.table(name).columns
        unknown, missing = [c for c in df.columns if c not in known], [c for c in known if c not in df.columns]
        if unknown or missing:
            raise ColumnMismatchError(f"{name}: unknown columns {unknown}, missing columns {missing}")
        df = df.select(*[F.col(f"`{c}`") for c in known])
    counted, obs = _counted(df, f"append:{name}")
    writer = counted.write.mode("append").format("parquet")
    if location and not table_exists(spark, name):
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return _rows(obs)


def insert_by_position(df: DataFrame, name: str, overwrite: bool = False) -> int:
    """``INSERT INTO name SELECT * FROM df``: columns matched by position.

    Position is the contract here: a batch with its columns in another order
    lands in the wrong columns (or fails on a type mismatch). Prefer
    :func:`append_by_name` unless the source is already in table order.
    """
    counted, obs = _counted(df, f"insert:{name}")
    counted.write.insertInto(name, overwrite=overwrite)
    return _rows(obs)


def overwrite_table(df: DataFrame, name: str, location: str | None = None, keep_old: bool = False) -> int:
    """Replace table ``name`` with ``df``: rows **and** schema are replaced.

    With a ``location`` the new rows are first written to a fresh folder below it (``v-<id>``); a write
    that fails leaves table and files as they were. Then the table is pointed at the new folder: one catalog
    change where the columns stay, drop and create (of the catalog's entry only) where they differ. The folders of
    earlier versions go afterwards, or stay for readers that have begun (``keep_old``; :func:`drop_old_versions`).
    Rows that a table held directly at ``location`` before its first staged overwrite are such a version too.
    """
    counted, obs = _counted(df, f"overwrite:{name}")
    if location is None:
        counted.write.mode("overwrite").format("parquet").saveAsTable(name)
        return _rows(obs)
    spark = df.sparkSession
    target = f"{location.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"
    counted.write.mode("error").parquet(target)
    if table_exists(spark, name) and not _partitioned(spark, name) \
            and [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in df.schema]:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_quoted(target)}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")       # the files of a table with a location stay
        create_table_if_absent(spark, name, df.schema, target)
    refresh(spark, name)
    if not keep_old:
        drop_old_versions(spark, name, location)
    return _rows(obs)


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}


def table_location(spark: SparkSession, name: str) -> str:
    return _described(spark, name)["Location"]


def _partitioned(spark: SparkSession, name: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(name))


def drop_old_versions(spark: SparkSession, name: str, location: str) -> int:
    """Delete what lies below ``location`` but the folder the table points at; returns how many entries went."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    current, root = path_of(table_location(spark, name)), path_of(location)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.makeQualified(current).getParent().toString() != fs.makeQualified(root).toString():
        return 0                                # the table points elsewhere: nothing here is known to be old
    old = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName() != current.getName()]
    for path in old:
        fs.delete(path, True)
    return len(old)


def load_table(df: DataFrame, name: str, location: str | None = None,
               overwrite: bool = False) -> int:
    """The daily load: append by name, or replace the table when ``overwrite``."""
    return overwrite_table(df, name, location) if overwrite else append_by_name(df, name, location)


def write_parquet(df: DataFrame, path: str, mode: str = "append") -> int:
    """Parquet files at ``path`` without partition folders; additive by default."""
    counted, obs = _counted(df, f"parquet:{path}")
    counted.write.mode(mode).parquet(path)
    return _rows(obs)


def spread_for_write(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Distribute rows on the partition columns before a partitioned write.

    ``REBALANCE``: all rows of a folder go to one task, and AQE
    splits a hot one (one account with a third of the rows) over several tasks.
    """
    return df.hint("rebalance", *partition_by)


@contextmanager
def _folders_spread(spark: SparkSession) -> Iterator[None]:
    """While a partitioned write runs, its shuffle partitions stay as they are dealt.

    Such a write costs what its folders cost, and AQE would pack them by bytes: one or two tasks for ten thousands of
    folders of a few rows. As all rows of a folder lie in one shuffle partition, more tasks make no more files; a hot
    folder is split as before.
    """
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], mode: str = "append",
                      max_records_per_file: int | None = None, spread_by: list[str] | None = None) -> int:
    """Parquet files in ``k=v`` folders (Snappy), e.g. the consent layout.

    Rows are spread on the partition columns first (:func:`spread_for_write`; on ``spread_by``,
    the first of them, where given): few open files per task, and a hot folder is split over several tasks.
    """
    counted, obs = _counted(spread_for_write(df, spread_by or partition_by), f"partitioned:{path}")
    writer = counted.write.mode(mode).partitionBy(*partition_by).option("compression", "snappy")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    with _folders_spread(df.sparkSession):
        writer.parquet(path)
    return _rows(obs)


#: Consent rows are dealt by account: a task has all days of its accounts, so that the commit, which the driver does
#: alone, moves a folder an account and need not merge the days of several tasks one by one.
CONSENT_SPREAD = S.CONSENT_PARTITION_COLUMNS[:1]


def consent_rows(df: DataFrame) -> DataFrame:
    """``df`` in the consent table's columns and types; absent ones NULL."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in S.CONSENT.fields])


def _write_consent_folders(df: DataFrame, root: str) -> DataFrame:
    """Consent rows appended below the local ``root`` in the table layout; what was written, a row a file."""
    rows = spread_for_write(consent_rows(df), CONSENT_SPREAD).sortWithinPartitions(*S.CONSENT_PARTITION_COLUMNS)
    with _folders_spread(df.sparkSession):
        return folders.write_folders(rows, root, S.CONSENT_PARTITION_COLUMNS)


def write_consent(df: DataFrame, path: str, mode: str = "append") -> int:
    """Consent rows as files in the table layout ``account_hashid/year/month/day``, without a table."""
    root = folders.local_path(df.sparkSession, path)
    if root is None or mode != "append":
        return write_partitioned(consent_rows(df), path, S.CONSENT_PARTITION_COLUMNS, mode, spread_by=CONSENT_SPREAD)
    return folders.rows_written(_write_consent_folders(df, root))


def load_consent(df: DataFrame, name: str, location: str) -> int:
    """Consent rows appended to the partitioned table ``name`` (created at ``location`` if absent).

    Every new partition is registered, so readers by name see it: by the insert itself, or, where the folders are on a
    local or mounted disk (:mod:`folders`), right after they are written.
    """
    spark = df.sparkSession
    create_table_if_absent(spark, name, S.CONSENT, location, S.CONSENT_PARTITION_COLUMNS)
    root = _consent_root(spark, name)
    if root is None:
        with _folders_spread(spark):
            return insert_by_position(spread_for_write(consent_rows(df), CONSENT_SPREAD), name)
    written = _write_consent_folders(df, root)
    _add_missing(spark, name, S.CONSENT_PARTITION_COLUMNS, written.select("partition"))
    refresh(spark, name)        # folders that were there have new files
    return folders.rows_written(written)


def _consent_root(spark: SparkSession, name: str) -> str | None:
    """The local folder of a Parquet table with the consent table's columns, None for any other table."""
    about, fields = _described(spark, name), [(f.name, f.dataType) for f in spark.table(name).schema]
    if about.get("Provider", "").lower() != "parquet" or fields != [(f.name, f.dataType) for f in S.CONSENT] \
            or [c.name for c in spark.catalog.listColumns(name) if c.isPartition] != S.CONSENT_PARTITION_COLUMNS:
        return None
    return folders.local_path(spark, about["Location"])


def partition_names(spark: SparkSession, name: str) -> DataFrame:
    """``partition``: the catalog's partitions of a table (``k=v/k=v``)."""
    return spark.sql(f"SHOW PARTITIONS {name}")


def recover_partitions(spark: SparkSession, name: str, drop_missing: bool = False) -> tuple[int, int]:
    """Add the ``k=v`` folders that other jobs wrote below the table's location to the catalog, all at once.

    Returns (partitions added, partitions dropped); with ``drop_missing`` those whose folder is gone are dropped.
    The whole location is walked (in parallel); :func:`add_partitions` looks at some folders only.
    """
    before = partition_names(spark, name)
    path = scratch_path(spark, "partitions-before")
    before.write.parquet(path)
    before = spark.read.schema("partition string").parquet(path)
    spark.sql(f"MSCK REPAIR TABLE {name} {'SYNC' if drop_missing else 'ADD'} PARTITIONS")
    after = partition_names(spark, name)
    return after.join(before, "partition", "left_anti").count(), before.join(after, "partition", "left_anti").count()


def add_partitions(spark: SparkSession, name: str, batch: int = 500, **known: str) -> int:
    """Add the folders below the table's location that match the ``known`` partition values (say, of one day); returns how many.

    Only folders of these values are listed, and only those the catalog does not know are added, ``batch`` a statement.
    """
    keys = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    unknown = sorted(set(known) - set(keys))
    if unknown:
        raise ColumnMismatchError(f"{name} is not partitioned by {unknown}")
    jvm, root = spark.sparkContext._jvm, table_location(spark, name)
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    folders = "/".join(f"{k}={escape(known[k]) if k in known else '*'}" for k in keys)
    try:
        found = spark.read.format("binaryFile").load(f"{root}/{folders}")
    except AnalysisException as e:              # no such folder
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    pattern = "/(" + "/".join(f"{k}=[^/]*" for k in keys) + ")/[^/]+$"
    return _add_missing(spark, name, keys, found.select(F.regexp_extract("path", pattern, 1).alias("partition")), batch)


def _add_missing(spark: SparkSession, name: str, keys: list[str], folders_found: DataFrame, batch: int = 500) -> int:
    """Add those of the folders (``partition``: ``k=v/k=v``) that the catalog does not know, ``batch`` a statement."""
    new = folders_found.distinct().join(partition_names(spark, name), "partition", "left_anti")
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    added, held = 0, []

    def add() -> None:
        if held:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(held))

    for row in new.toLocalIterator():
        values = [(k, part.split("=", 1)[1]) for k, part in zip(keys, row.partition.split("/"))]
        values = [(k, unescape(v) if "%" in v else v) for k, v in values]
        held.append("PARTITION (" + ", ".join(f"`{k}` = '{_quoted(v)}'" for k, v in values) + ")")
        added += 1
        if len(held) == batch:
            add()
            held = []
    add()
    return added


def write_bucketed(df: DataFrame, name: str, location: str, keys: list[str], buckets: int) -> int:
    """Replace table ``name`` by ``df`` in ``buckets`` buckets by ``keys``, one sorted file a bucket.

    Tables with the same number of buckets by the same keys are joined and grouped by these keys without a shuffle.
    Rows of one key share a bucket: fold what repeats (:func:`views.page_sessions`, :func:`views.consent_accounts`) first.
    """
    counted, obs = _counted(df.repartition(buckets, *keys), f"bucketed:{name}")
    counted.write.mode("overwrite").format("parquet").option("path", location) \
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return _rows(obs)


def refresh(spark: SparkSession, name: str) -> None:
    """Drop cached file listings of ``name`` (needed only after writes by other jobs)."""
    spark.catalog.refreshTable(name)


def register_views(spark: SparkSession, consent: DataFrame, pageview: DataFrame,
                   prefix: str = "") -> list[str]:
    """Register the four reporting views as temporary views; returns their names."""
    made = {
        "consent_device_stats": views.consent_device_stats(consent),
        "consent_hourly_stats": views.consent_hourly_stats(consent),
        "dashboard_summary_stats": views.dashboard_summary_stats(pageview),
        "page_visit_stats": views.page_visit_stats(pageview, consent),
    }
    for name, df in made.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in made]


def create_persistent_views(spark: SparkSession, consent_table: str, pageview_table: str,
                            prefix: str = "v_") -> list[str]:
    """``CREATE OR REPLACE VIEW`` for the four views over two catalog tables."""
    names = []
    for name, sql in views.VIEW_SQL.items():
        body = sql.format(consent=consent_table, pageview=pageview_table)
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}{name} AS {body}")
        names.append(prefix + name)
    return names
