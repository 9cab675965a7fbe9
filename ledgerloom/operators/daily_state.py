"""Daily upkeep of the page-view dashboard without reading all page views again.

Each load of page views is folded to *state rows*, which can be folded again with those of any other load: per
account and day one row with its page count, and one row for each distinct session and each distinct
consent. Distinct counts over several loads are then counts of distinct state rows, exactly, also when
page views of a day arrive late. State files lie in ``date_day=…/load_id=…`` folders: a load that is
run again replaces its own folders, and a query about some days opens the folders of these days only.
Rows of one account are spread over its sessions before they are counted, as in the plain view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import day_string

KEYS = ["account_hashid", "date_day", "year", "month", "day"]
STATE = T.StructType([T.StructField(c, T.StringType()) for c in ("account_hashid", "year", "month", "day", "kind", "value")]
                     + [T.StructField("pageviews", T.LongType()), T.StructField("date_day", T.StringType()),
                        T.StructField("load_id", T.StringType())])


def daily_state(pageview: DataFrame) -> DataFrame:
    """State rows of some page views: ``kind`` is ``pages`` (with the count), ``session`` or ``consent`` (with ``value``)."""
    facts = F.array(F.struct(F.lit("pages").alias("kind"), F.lit(None).cast("string").alias("value"), F.col("page_url").isNotNull().cast("long").alias("n")),
                    F.struct(F.lit("session").alias("kind"), F.col("session_hashid").alias("value"), F.lit(0).cast("long").alias("n")),
                    F.struct(F.lit("consent").alias("kind"), F.col("consent_hashid").alias("value"), F.lit(0).cast("long").alias("n")))
    rows = pageview.select("account_hashid", day_string(F.col("created_at")).alias("date_day"), "year", "month", "day",
                           F.explode(facts).alias("f")).where("f.kind = 'pages' OR f.value IS NOT NULL")
    return rows.groupBy(*KEYS, F.col("f.kind").alias("kind"), F.col("f.value").alias("value")).agg(F.sum("f.n").alias("pageviews"))


def write_load(pageview: DataFrame, path: str, load_id: str) -> None:
    """Store the state of one load; the same ``load_id`` again replaces the days that it has."""
    state = daily_state(pageview).withColumn("load_id", F.lit(load_id))
    (state.hint("rebalance", "date_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date_day", "load_id").parquet(path))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(path)


def dashboard_of_state(state: DataFrame) -> DataFrame:
    """``dashboard_summary_stats`` of all loads in ``state``; a filter on ``date_day`` is pushed to the folders."""
    once = state.groupBy(*KEYS, "kind", "value").agg(F.sum("pageviews").alias("pageviews"))
    return once.groupBy(*KEYS).agg(
        F.sum("pageviews").alias("pageviews"), F.count_if(F.col("kind") == "session").alias("unique_visitors"),
        F.count_if(F.col("kind") == "consent").alias("consent_count")) \
        .select("account_hashid", "date_day", "pageviews", "unique_visitors", "consent_count", "year", "month", "day")
