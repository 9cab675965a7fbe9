"""Normalisation rules of the backup-report CSV."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that are fixed by the data.
STATUS_COMPLETED = "COMPLETED"
STATUS_SUCCESSFUL = "SUCCESSFUL"
AMI_MARKER = "image/ami-"
AMI_PATTERN = r"image/(ami)-[^/]+"
COMPONENT_OTHER = "RDS"
INSTANCE_MARKER = "instance/"
INSTANCE_PATTERN = r"instance/(i-[a-f0-9]+)"
DB_MARKER = "db:"
DB_PATTERN = r"db:([^/]+)"
BYTES_PER_GIB = 1024 * 1024 * 1024


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def map_status(job_status: Column | str) -> Column:
    """``COMPLETED`` becomes ``SUCCESSFUL``; anything else (NULL too) is unchanged."""
    s = _c(job_status)
    return F.when(s == STATUS_COMPLETED, F.lit(STATUS_SUCCESSFUL)).otherwise(s)


def map_component(recovery_point_arn: Column | str) -> Column:
    """``AMI`` for machine-image recovery points, else ``RDS`` (NULL included).

    The value comes from the pattern's group, upper-cased, so an ARN that holds
    the marker but does not match the pattern yields ``''``.
    """
    arn = _c(recovery_point_arn)
    return (F.when(arn.contains(AMI_MARKER), F.upper(F.regexp_extract(arn, AMI_PATTERN, 1)))
            .otherwise(F.lit(COMPONENT_OTHER)))


def extract_host(resource_arn: Column | str) -> Column:
    """Instance id for ``instance/`` ARNs, database name for ``db:`` ARNs, else the ARN.

    ``instance/`` is tested first. An unmatched pattern yields ``''`` (not NULL);
    NULL stays NULL.
    """
    arn = _c(resource_arn)
    return (F.when(arn.contains(INSTANCE_MARKER), F.regexp_extract(arn, INSTANCE_PATTERN, 1))
            .when(arn.contains(DB_MARKER), F.regexp_extract(arn, DB_PATTERN, 1))
            .otherwise(arn))


def parse_period_date(text: Column | str) -> Column:
    """Date from the first ten characters (``yyyy-MM-dd``); NULL when not a date."""
    return F.try_to_date(F.substring(_c(text), 1, 10), "yyyy-MM-dd")


def size_bytes(text: Column | str) -> Column:
    """Byte count as double; NULL for text that is not a number."""
    return _try_double(_c(text))


def _try_double(col: Column) -> Column:
    return col.try_cast("double")


def size_gib(text: Column | str) -> Column:
    """Size in GiB rounded to two places (HALF_UP); NULL for non-numbers."""
    return F.round(_try_double(_c(text)) / F.lit(BYTES_PER_GIB), 2)
