"""Session defaults and the shared scratch location.

Results are pinned to UTC so that hour buckets and date strings do not depend on
the machine that runs them. ANSI mode stays on (the Spark 4 default); every cast of
untrusted input text goes through a ``try_*`` function instead.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.compression.codec": "snappy",
}

#: Tasks a core that list the folders of a partitioned table.
LISTING_TASKS_A_CORE = 4
#: What opening a file counts for when scans of tables of many small files are cut into tasks, in bytes.
SMALL_FILE_COST = 128 << 10
_OPEN_COST, _PACKED = "spark.sql.files.openCostInBytes", "spark.ledgerloom.smallFilesPacked"


def get_spark(master: str | None = None, app_name: str = "ledgerloom",
              shuffle_partitions: int | None = None,
              extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the mart's defaults.

    ``master`` is left to ``spark-submit`` when ``None``. ``shuffle_partitions``
    should be sized to the data: about one partition per 128-256 MB of shuffle
    output on a cluster, the number of cores for local runs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    pin_session(spark)
    return spark


def pin_session(spark: SparkSession) -> None:
    """Apply the runtime-settable defaults to an existing session.

    Folders are listed by a few tasks a core, many folders a task: Spark's default is up to 10,000 tasks, one for
    a few folders of a table with ten thousands of partitions. A number that the user has set stays.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    listing = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if spark.conf.get(listing) == "10000":
        spark.conf.set(listing, str(LISTING_TASKS_A_CORE * spark.sparkContext.defaultParallelism))
    if spark.conf.get(_PACKED, "") == "true":
        spark.conf.unset(_OPEN_COST)
        spark.conf.unset(_PACKED)


def pack_small_files(spark: SparkSession) -> None:
    """Until the next :func:`pin_session`, scans put many small files into a task.

    Spark counts an opened file as 4 MB: with splits of 16 MB each task would read four files, and a table with
    ten thousands of folders would take thousands of tasks. A number that the user has set stays.
    """
    if spark.conf.get(_OPEN_COST) in ("4194304", "4194304b", "4MB"):
        spark.conf.set(_OPEN_COST, str(SMALL_FILE_COST))
        spark.conf.set(_PACKED, "true")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor can reach, and a
    session without it is an error. Only a local session (runs and tests) without
    it gets a folder of our own, registered as the checkpoint directory.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="ledgerloom-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared checkpoint root.

    All of one application's folders lie under one, which the file system deletes
    when the driver ends, whoever made the session.
    """
    sc = spark.sparkContext
    home = f"{checkpoint_root(spark)}/ledgerloom/{sc.applicationId}"
    if not getattr(sc, "_ledgerloom_home", None):
        path = sc._jvm.org.apache.hadoop.fs.Path(home)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        sc._ledgerloom_home = home
    return f"{home}/{name}-{uuid.uuid4().hex[:12]}"
