"""Backup-report normalisation: raw CSV rows to the conformed fact or detail rows."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..schemas import MissingColumnsError
from ..functions import (extract_host, map_component, map_status, parse_period_date,
                         size_bytes, size_gib)

log = logging.getLogger(__name__)

# Constant backup types of the two report jobs.
FACT_BACKUP_TYPE = "COMPLETE"
DETAIL_BACKUP_TYPE = "full"


def missing_columns(df: DataFrame, required: list[str] | None = None) -> list[str]:
    required = S.REQUIRED_REPORT_COLUMNS if required is None else required
    present = set(df.columns)
    return [c for c in required if c not in present]


def validate_required(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Reject the batch if any required column is missing (schema only, no job)."""
    missing = missing_columns(df, required)
    if missing:
        raise MissingColumnsError(f"missing required columns: {missing}")
    return df


def project_available(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Keep the required columns that are present, in required order; warn on the rest."""
    required = S.DETAIL_REPORT_COLUMNS if required is None else required
    missing = missing_columns(df, required)
    if missing:
        log.warning("missing columns in source data: %s", missing)
    return df.select(*[F.col(f"`{c}`") for c in required if c in df.columns])


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _as_date(as_of: Column | str | None) -> Column:
    if as_of is None:
        return F.current_date()
    return F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of


def backup_fact_report(raw: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """Report rows conformed to the 10-column backup fact (newer job).

    One projection: Catalyst collapses it into the scan's stage. Unparsable
    dates and sizes become NULL.
    """
    validate_required(raw)
    host = extract_host(_q(S.COL_RESOURCE_ARN))
    return raw.select(
        parse_period_date(_q(S.COL_PERIOD_START)).alias("report_period_start"),
        parse_period_date(_q(S.COL_PERIOD_END)).alias("report_period_end"),
        _q(S.COL_RESOURCE_TYPE).alias("resource_type"),
        map_component(_q(S.COL_RECOVERY_POINT_ARN)).alias("component_type"),
        host.alias("backup_name"),
        host.alias("hostname"),
        F.lit(FACT_BACKUP_TYPE).alias("backup_type"),
        map_status(_q(S.COL_JOB_STATUS)).alias("status"),
        size_bytes(_q(S.COL_SIZE_BYTES)).alias("backup_size_bytes"),
        _as_date(as_of).alias("load_date"),
    )


def report_detail(raw: DataFrame, as_of: Column | str | None = None,
                  as_of_ts: Column | str | None = None) -> DataFrame:
    """Report rows as detail records (older job): sizes in GiB, a load timestamp.

    ``file_last_modified`` holds the load time ``as_of_ts`` (default: now), as in
    the original job; a file's true modification time is available from
    :func:`ledgerloom.sources.files.list_files`.
    """
    validate_required(raw, S.DETAIL_REPORT_COLUMNS)
    if as_of_ts is None:
        ts = F.current_timestamp().cast("timestamp_ntz")
    elif isinstance(as_of_ts, str):
        ts = F.to_timestamp_ntz(F.lit(as_of_ts))
    else:
        ts = as_of_ts.cast("timestamp_ntz")
    return project_available(raw).select(
        map_status(_q(S.COL_JOB_STATUS)).alias("job_status"),
        _q(S.COL_RESOURCE_TYPE).alias("resource_type"),
        parse_period_date(_q(S.COL_PERIOD_START)).alias("report_period_start"),
        parse_period_date(_q(S.COL_PERIOD_END)).alias("report_period_end"),
        extract_host(_q(S.COL_RESOURCE_ARN)).alias("resource_id"),
        size_gib(_q(S.COL_SIZE_BYTES)).alias("size_gb"),
        F.lit(DETAIL_BACKUP_TYPE).alias("backup_type"),
        ts.alias("file_last_modified"),
        _as_date(as_of).alias("load_date"),
    )
