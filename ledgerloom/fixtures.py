"""Mart inputs derived from the driver tables (``events``, ``orders``).

The benchmark data has no consent, page-view, backup-report or backup-log
tables, so they are derived here column by column from ``events`` and
``orders``. Derivations are narrow projections (no shuffle): they scale with the
source tables and keep every row. ``FIXTURES.md`` gives the same derivations
as SQL, which the DuckDB oracle uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas as S

#: Events after which new log files begin (fixed value; the oracle SQL uses the same).
LOG_EVENTS = 1_000_000
LOG_PATH_PREFIX = "/usr/sap/HDB/SYS/global/hdb/backint/DB_HDB/"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _parts(ts: Column) -> list[Column]:
    return [F.date_format(ts, "yyyy").alias("year"),
            F.date_format(ts, "MM").alias("month"),
            F.date_format(ts, "dd").alias("day")]


def _session_hashid() -> Column:
    return F.concat(F.lit("s"), F.col("user_id").cast("string"), F.lit("-"),
                    F.date_format("ts", "dd"))


def _hashid(prefix: str, col: Column) -> Column:
    return F.concat(F.lit(prefix), col.cast("string"))


def consent(events: DataFrame, orgs_per_account: bool = False) -> DataFrame:
    """Consent rows: ``signup`` and ``click`` events.

    With ``orgs_per_account`` the organization comes from the event rather than
    the user, so one account spans several organizations (join tests).
    """
    org_src = F.col("event_id") if orgs_per_account else F.col("user_id")
    eid = F.col("event_id")
    return events.where(F.col("event_type").isin("signup", "click")).select(
        eid.cast("int").alias("consent_id"),
        (org_src % 5).cast("int").alias("organization_id"),
        (F.col("user_id") % 17).cast("int").alias("website_id"),
        F.when(eid % 11 == 0, F.lit(None).cast("string"))
         .otherwise(_hashid("c", eid % 997)).alias("consent_hashid"),
        F.when(eid % 4 == 0, "IN").when(eid % 4 == 1, "US").when(eid % 4 == 2, "DE")
         .alias("ip_country"),
        F.when(eid % 7 == 0, "Desktop").when(eid % 7 == 1, "Tablet")
         .when(eid % 7 == 2, "Mobile").when(eid % 7 == 3, "Laptop")
         .when(eid % 7 == 4, "SmartTV").when(eid % 7 == 5, "desktop")
         .alias("device_name"),
        _session_hashid().alias("session_hashid"),
        F.col("ts").alias("created_at"),
        _hashid("a", F.col("user_id")).alias("account_hashid"),
        *_parts(F.col("ts")),
    )


def pageview(events: DataFrame) -> DataFrame:
    """Typed page-view rows (the page-view table shape): ``view`` events."""
    eid = F.col("event_id")
    return events.where(F.col("event_type") == "view").select(
        _hashid("a", F.col("user_id")).alias("account_hashid"),
        _session_hashid().alias("session_hashid"),
        F.when(eid % 3 == 0, F.lit(None).cast("string"))
         .otherwise(_hashid("c", eid % 997)).alias("consent_hashid"),
        F.when(eid % 13 == 0, F.lit(None).cast("string"))
         .otherwise(_hashid("/p/", eid % 50)).alias("page_url"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("timestamp"),
        *_parts(F.col("ts")),
    )


def pageview_nested(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Raw page-view records as the JSON producer emits them.

    ``timestamp`` is an ISO-8601 string; ``visitor_details`` is a struct that is
    absent on every tenth event.
    """
    eid = F.col("event_id")
    details = F.struct(
        F.concat_ws(".", F.lit("10"), (F.col("user_id") % 256).cast("string"),
                    (eid % 256).cast("string"), F.lit("1")).alias("ip_address"),
        F.when(eid % 4 == 0, "IN").when(eid % 4 == 1, "US").when(eid % 4 == 2, "DE")
         .alias("ip_country"),
        _hashid("r", F.col("user_id") % 7).alias("ip_region"),
        F.when(eid % 5 == 0, F.lit(None).cast("string"))
         .otherwise(_hashid("city", F.col("user_id") % 11)).alias("city"),
        F.when(eid % 3 == 0, "mobile").when(eid % 3 == 1, "desktop")
         .otherwise("tablet").alias("device_type"),
        F.lit("UTC").alias("timezone"),
    )
    return events.where(F.col("event_type") == "view").select(
        _hashid("a", F.col("user_id")).alias("account_hashid"),
        _session_hashid().alias("session_hashid"),
        F.when(eid % 3 == 0, F.lit(None).cast("string"))
         .otherwise(_hashid("c", eid % 997)).alias("consent_hashid"),
        F.when(eid % 13 == 0, F.lit(None).cast("string"))
         .otherwise(_hashid("/p/", eid % 50)).alias("page_url"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.when(eid % 10 == 0, F.lit(None).cast(S.VISITOR_DETAILS))
         .otherwise(details).alias("visitor_details"),
        *[F.col(c) for c in (keep or [])],
    )


def report(orders: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Backup-report rows with the CSV header names, all strings.

    Contains on purpose: unparsable end dates, NULL and upper-case resource ARNs,
    an ARN with neither ``instance/`` nor ``db:``, and non-numeric sizes.
    """
    key = F.col("o_orderkey")
    cust = F.col("o_custkey").cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return orders.select(
        F.when(F.col("o_orderstatus") == "F", "COMPLETED")
         .when(F.col("o_orderstatus") == "O", "RUNNING").otherwise("FAILED")
         .alias(S.COL_JOB_STATUS),
        F.when(key % 3 == 0, "RDS").otherwise("EC2").alias(S.COL_RESOURCE_TYPE),
        F.concat(day, F.lit("T00:00:00Z")).alias(S.COL_PERIOD_START),
        F.when(key % 29 == 0, "n/a").otherwise(F.concat(day, F.lit("T23:59:59Z")))
         .alias(S.COL_PERIOD_END),
        F.when(key % 31 == 0, F.lit(None).cast("string"))
         .when(key % 23 == 0, "arn:aws:ec2:r:1:instance/i-XYZ")
         .when(key % 19 == 0, "arn:aws:dynamodb:r:1:table/t")
         .when(key % 3 == 0, F.concat(F.lit("arn:aws:rds:r:1:db:db-"), cust))
         .otherwise(F.concat(F.lit("arn:aws:ec2:r:1:instance/i-0"), cust))
         .alias(S.COL_RESOURCE_ARN),
        F.when(key % 3 == 0, F.concat(F.lit("arn:aws:rds:r:1:snapshot:s-"), key.cast("string")))
         .otherwise(F.concat(F.lit("arn:aws:ec2:r::image/ami-0"), key.cast("string")))
         .alias(S.COL_RECOVERY_POINT_ARN),
        F.when(key % 37 == 0, "unknown")
         .otherwise((F.floor("o_totalprice").cast("bigint") * F.lit(1000000)).cast("string"))
         .alias(S.COL_SIZE_BYTES),
        *[F.col(c) for c in (keep or [])],
    )


def log_lines(events: DataFrame, chunk_lines: int = 1 << 16) -> DataFrame:
    """Backup-log lines, one per event, in virtual files of bounded size (20 hosts x 30 days
    per million events, about 1,700 lines each).

    ``line_no`` (the event id) orders lines within a file; ``chunk`` groups
    ``chunk_lines`` consecutive line numbers so that one very long file is
    still spread over many tasks.
    """
    eid = F.col("event_id")
    etype = F.col("event_type")
    stamp = F.when(eid % 4 == 3, F.lit(" ")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00 '"))
    message = (
        F.when(eid % 41 == 0, "LOGBCKUP SAVE DATA finished successfully")
        .when((etype == "signup") & (eid % 7 == 0), LOG_PATH_PREFIX + "COMPLETE_0_1")
        .when((etype == "signup") & (eid % 2 == 0), LOG_PATH_PREFIX + "COMPLETE_DATA_BACKUP_0_0")
        .when(etype == "signup", LOG_PATH_PREFIX + "2024_databackup_differential_0_3")
        .when(etype == "click", F.concat(
            F.lit("state of service: nameserver, host"),
            (F.col("user_id") % 9).cast("string"), F.lit(":30001, volume: 1")))
        .when(etype == "view", F.concat(
            F.lit("progress of service: indexserver, volume: 3, 100% "),
            (eid * 1024).cast("string"), F.lit("/"), (eid * 1024).cast("string")))
        .when((etype == "purchase") & (eid % 3 == 0),
              "SAVE DATA finished with error: [447] backup could not be completed")
        .when(etype == "purchase", "SAVE DATA finished successfully")
        .otherwise("command: BACKUP DATA FOR HDB USING BACKINT")
    )
    return events.select(
        F.concat(F.lit("hana-"), (F.col("user_id") % 20).cast("string"), F.lit("-"),
                 F.date_format("ts", "dd"), F.lit("-"),
                 F.floor(eid / F.lit(LOG_EVENTS)).cast("string"), F.lit(".log")).alias("file_path"),
        F.floor(eid / F.lit(chunk_lines)).cast("bigint").alias("chunk"),
        eid.cast("bigint").alias("line_no"),
        F.concat(stamp, message).alias("value"),
    )
