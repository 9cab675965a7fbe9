"""Load checks over the backup fact: totals, mixes, distinct values, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def total_rows(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count(F.lit(1)).alias("records"))


def rows_by_component(fact: DataFrame) -> DataFrame:
    return fact.groupBy("component_type").agg(F.count(F.lit(1)).alias("records"))


def rows_by_load_day(detail: DataFrame) -> DataFrame:
    """Rows per day of ``file_last_modified``, newest first (named ``load_date``)."""
    return (detail.groupBy(F.to_date("file_last_modified").alias("load_date"))
            .agg(F.count(F.lit(1)).alias("records"))
            .orderBy(F.col("load_date").desc()))


def sample_hosts(fact: DataFrame, n: int = 10) -> DataFrame:
    """A ``n``-row look at host, name and component.

    Any ``n`` rows would do; a total order on the three output columns makes the
    answer reproducible. This is a top-k, not a full sort:
    each task keeps its best ``n`` and only those reach the final merge.
    """
    return (fact.select("hostname", "backup_name", "component_type")
            .orderBy("hostname", "backup_name", "component_type").limit(n))


def distinct_components(fact: DataFrame) -> DataFrame:
    return fact.select("component_type").distinct()


def distinct_host_pairs(fact: DataFrame) -> DataFrame:
    return fact.select("hostname", "backup_name").distinct()
