"""Declared schemas of the mart's entities."""

from pyspark.sql import types as T


class MissingColumnsError(ValueError):
    """The report batch lacks required columns; nothing is loaded."""


# Conformed backup fact: output of both the report-CSV and the log pipelines.
BACKUP_FACT = T.StructType([
    T.StructField("report_period_start", T.DateType()),
    T.StructField("report_period_end", T.DateType()),
    T.StructField("resource_type", T.StringType()),
    T.StructField("component_type", T.StringType()),
    T.StructField("backup_name", T.StringType()),
    T.StructField("hostname", T.StringType()),
    T.StructField("backup_type", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("backup_size_bytes", T.DoubleType()),
    T.StructField("load_date", T.DateType()),
])
BACKUP_FACT_COLUMNS = [f.name for f in BACKUP_FACT.fields]

# Header names of the daily backup-report CSV (fixed values).
COL_JOB_STATUS = "Job Status"
COL_RESOURCE_TYPE = "Resource Type"
COL_PERIOD_START = "Report Time Period Start"
COL_PERIOD_END = "Report Time Period End"
COL_RESOURCE_ARN = "Resource ARN"
COL_SIZE_BYTES = "Backup Size in Bytes"
COL_RECOVERY_POINT_ARN = "Recovery Point ARN"

# Required by the newer job (seven) and the older job (six), fixed values.
REQUIRED_REPORT_COLUMNS = [
    COL_JOB_STATUS, COL_RESOURCE_TYPE, COL_PERIOD_START, COL_PERIOD_END,
    COL_RESOURCE_ARN, COL_SIZE_BYTES, COL_RECOVERY_POINT_ARN,
]
DETAIL_REPORT_COLUMNS = [
    COL_PERIOD_START, COL_PERIOD_END, COL_JOB_STATUS, COL_RESOURCE_TYPE,
    COL_RESOURCE_ARN, COL_SIZE_BYTES,
]

# Nested page-view JSON record.
VISITOR_DETAILS = T.StructType([
    T.StructField("ip_address", T.StringType()),
    T.StructField("ip_country", T.StringType()),
    T.StructField("ip_region", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("timezone", T.StringType()),
])
PAGEVIEW_JSON = T.StructType([
    T.StructField("account_hashid", T.StringType()),
    T.StructField("session_hashid", T.StringType()),
    T.StructField("consent_hashid", T.StringType()),
    T.StructField("page_url", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("visitor_details", VISITOR_DETAILS),
])
PAGEVIEW_FLAT_COLUMNS = [
    "account_hashid", "session_hashid", "consent_hashid", "page_url", "timestamp",
    "ip_address", "ip_country", "ip_region", "city", "device_type", "timezone",
]

# Consent table: data columns, then string partition columns.
CONSENT = T.StructType([
    T.StructField("consent_id", T.IntegerType()),
    T.StructField("organization_id", T.IntegerType()),
    T.StructField("website_id", T.IntegerType()),
    T.StructField("consent_hashid", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("ip_country", T.StringType()),
    T.StructField("ip_region", T.StringType()),
    T.StructField("gcp_preference", T.StringType()),
    T.StructField("device_name", T.StringType()),
    T.StructField("storage_item", T.StringType()),
    T.StructField("user_preferences", T.StringType()),
    T.StructField("accepted_at", T.TimestampType()),
    T.StructField("session_hashid", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("account_hashid", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("day", T.StringType()),
])
CONSENT_PARTITION_COLUMNS = ["account_hashid", "year", "month", "day"]
