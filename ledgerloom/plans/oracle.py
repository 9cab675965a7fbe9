"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The views are stated as plain SQL (the page visits as the plain join), the fixtures are the
derivations of ``FIXTURES.md``, and the log sessions use a plain per-file window formulation
rather than the chunked scan.
"""

from __future__ import annotations

_PARTS = ("strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, "
          "strftime(ts, '%d') AS day")

CONSENT = f"""
SELECT cast(event_id AS INTEGER) AS consent_id,
  cast(user_id % 5 AS INTEGER) AS organization_id,
  cast(user_id % 17 AS INTEGER) AS website_id,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE 'c' || cast(event_id % 997 AS VARCHAR) END AS consent_hashid,
  CASE event_id % 4 WHEN 0 THEN 'IN' WHEN 1 THEN 'US' WHEN 2 THEN 'DE' ELSE NULL END AS ip_country,
  CASE event_id % 7 WHEN 0 THEN 'Desktop' WHEN 1 THEN 'Tablet' WHEN 2 THEN 'Mobile'
       WHEN 3 THEN 'Laptop' WHEN 4 THEN 'SmartTV' WHEN 5 THEN 'desktop' ELSE NULL END AS device_name,
  's' || cast(user_id AS VARCHAR) || '-' || strftime(ts, '%d') AS session_hashid,
  ts AS created_at, 'a' || cast(user_id AS VARCHAR) AS account_hashid, {_PARTS}
FROM events WHERE event_type IN ('signup', 'click')"""

CONSENT_MULTI_ORG = CONSENT.replace("cast(user_id % 5 AS INTEGER)", "cast(event_id % 5 AS INTEGER)")

PAGEVIEW = f"""
SELECT 'a' || cast(user_id AS VARCHAR) AS account_hashid,
  's' || cast(user_id AS VARCHAR) || '-' || strftime(ts, '%d') AS session_hashid,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'c' || cast(event_id % 997 AS VARCHAR) END AS consent_hashid,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE '/p/' || cast(event_id % 50 AS VARCHAR) END AS page_url,
  ts AS created_at, ts AS "timestamp", {_PARTS}
FROM events WHERE event_type = 'view'"""

PAGEVIEW_FLAT = """
SELECT 'a' || cast(user_id AS VARCHAR) AS account_hashid,
  's' || cast(user_id AS VARCHAR) || '-' || strftime(ts, '%d') AS session_hashid,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'c' || cast(event_id % 997 AS VARCHAR) END AS consent_hashid,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE '/p/' || cast(event_id % 50 AS VARCHAR) END AS page_url,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp",
  CASE WHEN event_id % 10 = 0 OR (event_id % 9 = 0 AND event_id % 5 <> 0) THEN NULL ELSE
    '10.' || cast(user_id % 256 AS VARCHAR) || '.' || cast(event_id % 256 AS VARCHAR) || '.1' END AS ip_address,
  CASE WHEN event_id % 10 = 0 OR (event_id % 9 = 0 AND event_id % 5 <> 0) THEN NULL ELSE
    CASE event_id % 4 WHEN 0 THEN 'IN' WHEN 1 THEN 'US' WHEN 2 THEN 'DE' ELSE NULL END END AS ip_country,
  CASE WHEN event_id % 10 = 0 OR (event_id % 9 = 0 AND event_id % 5 <> 0) THEN NULL ELSE 'r' || cast(user_id % 7 AS VARCHAR) END AS ip_region,
  CASE WHEN event_id % 10 = 0 OR (event_id % 9 = 0 AND event_id % 5 <> 0) OR event_id % 5 = 0 THEN NULL ELSE 'city' || cast(user_id % 11 AS VARCHAR) END AS city,
  CASE WHEN event_id % 10 = 0 OR (event_id % 9 = 0 AND event_id % 5 <> 0) THEN NULL ELSE
    CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END END AS device_type,
  CASE WHEN event_id % 10 = 0 OR (event_id % 9 = 0 AND event_id % 5 <> 0) THEN NULL ELSE 'UTC' END AS timezone
FROM events WHERE event_type = 'view'"""

REPORT = """
SELECT CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS "Job Status",
  CASE WHEN o_orderkey % 3 = 0 THEN 'RDS' ELSE 'EC2' END AS "Resource Type",
  strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' AS "Report Time Period Start",
  CASE WHEN o_orderkey % 29 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T23:59:59Z' END
    AS "Report Time Period End",
  CASE WHEN o_orderkey % 31 = 0 THEN NULL
       WHEN o_orderkey % 23 = 0 THEN 'arn:aws:ec2:r:1:instance/i-XYZ'
       WHEN o_orderkey % 19 = 0 THEN 'arn:aws:dynamodb:r:1:table/t'
       WHEN o_orderkey % 3 = 0 THEN 'arn:aws:rds:r:1:db:db-' || cast(o_custkey AS VARCHAR)
       ELSE 'arn:aws:ec2:r:1:instance/i-0' || cast(o_custkey AS VARCHAR) END AS "Resource ARN",
  CASE WHEN o_orderkey % 3 = 0 THEN 'arn:aws:rds:r:1:snapshot:s-' || cast(o_orderkey AS VARCHAR)
       ELSE 'arn:aws:ec2:r::image/ami-0' || cast(o_orderkey AS VARCHAR) END AS "Recovery Point ARN",
  CASE WHEN o_orderkey % 37 = 0 THEN 'unknown'
       ELSE cast(cast(floor(o_totalprice) AS BIGINT) * 1000000 AS VARCHAR) END AS "Backup Size in Bytes",
  cast(o_orderdate AS DATE) AS delivery_day
FROM orders"""

LOG = """
SELECT 'hana-' || cast(user_id % 20 AS VARCHAR) || '-' || strftime(ts, '%d') || '-' || cast(event_id // 1000000 AS VARCHAR) || '.log' AS file_path,
  event_id AS line_no,
  CASE WHEN event_id % 4 = 3 THEN ' ' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00 ' END ||
  CASE WHEN event_id % 41 = 0 THEN 'LOGBCKUP SAVE DATA finished successfully'
    WHEN event_type = 'signup' AND event_id % 7 = 0
      THEN '/usr/sap/HDB/SYS/global/hdb/backint/DB_HDB/COMPLETE_0_1'
    WHEN event_type = 'signup' AND event_id % 2 = 0
      THEN '/usr/sap/HDB/SYS/global/hdb/backint/DB_HDB/COMPLETE_DATA_BACKUP_0_0'
    WHEN event_type = 'signup'
      THEN '/usr/sap/HDB/SYS/global/hdb/backint/DB_HDB/2024_databackup_differential_0_3'
    WHEN event_type = 'click'
      THEN 'state of service: nameserver, host' || cast(user_id % 9 AS VARCHAR) || ':30001, volume: 1'
    WHEN event_type = 'view'
      THEN 'progress of service: indexserver, volume: 3, 100% ' || cast(event_id * 1024 AS VARCHAR)
           || '/' || cast(event_id * 1024 AS VARCHAR)
    WHEN event_type = 'purchase' AND event_id % 3 = 0
      THEN 'SAVE DATA finished with error: [447] backup could not be completed'
    WHEN event_type = 'purchase' THEN 'SAVE DATA finished successfully'
    ELSE 'command: BACKUP DATA FOR HDB USING BACKINT' END AS value
FROM events"""


def _with(**ctes: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items()) + "\n"


# ---------------------------------------------------------------- views (Q1-Q4)

_Q1 = """
SELECT organization_id, website_id, count(consent_hashid) AS unique_consents,
  CASE WHEN device_name IN ('Desktop', 'Tablet', 'Mobile', 'Laptop') THEN device_name ELSE 'Unknown' END
    AS device_name,
  year, month, day, cast(hour(created_at) AS INTEGER) AS hour,
  date_trunc('hour', created_at) AS timestamp_hour
FROM {src} GROUP BY 1, 2, 4, 5, 6, 7, 8, 9"""

_Q2 = """
SELECT organization_id, website_id, count(consent_hashid) AS unique_consents, ip_country,
  year, month, day, cast(hour(created_at) AS INTEGER) AS hour,
  strftime(created_at, '%Y-%m-%d %H:00:00') AS timestamp_hour
FROM consent GROUP BY 1, 2, 4, 5, 6, 7, 8, 9"""

_Q3 = """
SELECT account_hashid, strftime(cast(created_at AS TIMESTAMP), '%Y-%m-%d') AS date_day,
  count(page_url) AS pageviews, count(DISTINCT session_hashid) AS unique_visitors,
  count(DISTINCT consent_hashid) AS consent_count, year, month, day
FROM pageview GROUP BY 1, 2, 6, 7, 8"""

_Q4 = """
SELECT c.organization_id, c.website_id, pv.account_hashid, count(pv.page_url) AS pageviews,
  count(DISTINCT pv.session_hashid) AS unique_visitors, pv.year, pv.month, pv.day,
  cast(hour(pv."timestamp") AS INTEGER) AS hour, cast(pv."timestamp" AS DATE) AS date_day,
  strftime(pv."timestamp", '%Y-%m-%d %H:00:00') AS timestamp_hour
FROM pageview pv INNER JOIN consent c ON pv.account_hashid = c.account_hashid
GROUP BY 1, 2, 3, 6, 7, 8, 9, 10, 11"""

_J1 = """
SELECT pv.account_hashid, pv.session_hashid, pv.consent_hashid, pv.page_url, pv.created_at,
  pv."timestamp", pv.year, pv.month, pv.day, c.organization_id, c.website_id, c.consent_rows
FROM pageview pv INNER JOIN (
  SELECT account_hashid, organization_id, website_id, count(*) AS consent_rows
  FROM consent WHERE account_hashid IS NOT NULL GROUP BY 1, 2, 3) c
ON pv.account_hashid = c.account_hashid"""

SQL: dict[str, str] = {
    "consent_device_stats": _with(consent=CONSENT) + _Q1.format(src="consent"),
    "consent_hourly_stats": _with(consent=CONSENT) + _Q2,
    "dashboard_summary_stats": _with(pageview=PAGEVIEW) + _Q3,
    "page_visit_stats": _with(pageview=PAGEVIEW, consent=CONSENT) + _Q4,
    "page_visit_stats_multi_org": _with(pageview=PAGEVIEW, consent=CONSENT_MULTI_ORG) + _Q4,
    "join_pageview_consent": _with(pageview=PAGEVIEW, consent=CONSENT) + _J1,
}


# ------------------------------------------------------- report normalisation

_FACT_REPORT = """
SELECT CAST(try_strptime(substring("Report Time Period Start", 1, 10), '%Y-%m-%d') AS DATE) AS report_period_start,
  CAST(try_strptime(substring("Report Time Period End", 1, 10), '%Y-%m-%d') AS DATE) AS report_period_end,
  "Resource Type" AS resource_type,
  CASE WHEN contains("Recovery Point ARN", 'image/ami-')
       THEN upper(regexp_extract("Recovery Point ARN", 'image/(ami)-[^/]+', 1)) ELSE 'RDS' END AS component_type,
  {host} AS backup_name, {host} AS hostname, 'COMPLETE' AS backup_type,
  CASE WHEN "Job Status" = 'COMPLETED' THEN 'SUCCESSFUL' ELSE "Job Status" END AS status,
  try_cast("Backup Size in Bytes" AS DOUBLE) AS backup_size_bytes,
  current_date AS load_date
FROM report"""

_HOST = """(CASE WHEN contains("Resource ARN", 'instance/') THEN regexp_extract("Resource ARN", 'instance/(i-[a-f0-9]+)', 1)
  WHEN contains("Resource ARN", 'db:') THEN regexp_extract("Resource ARN", 'db:([^/]+)', 1)
  ELSE "Resource ARN" END)"""

FACT_REPORT = _FACT_REPORT.format(host=_HOST)

DETAIL = f"""
SELECT CASE WHEN "Job Status" = 'COMPLETED' THEN 'SUCCESSFUL' ELSE "Job Status" END AS job_status,
  "Resource Type" AS resource_type,
  CAST(try_strptime(substring("Report Time Period Start", 1, 10), '%Y-%m-%d') AS DATE) AS report_period_start,
  CAST(try_strptime(substring("Report Time Period End", 1, 10), '%Y-%m-%d') AS DATE) AS report_period_end,
  {_HOST} AS resource_id,
  round(try_cast("Backup Size in Bytes" AS DOUBLE) / 1073741824, 2) AS size_gb,
  'full' AS backup_type, CAST(current_date AS TIMESTAMP) AS file_last_modified, current_date AS load_date
FROM report"""

# ----------------------------------------------------------- backup log sessions
# Plain per-file windows: segments between finish lines, closes, sessions.

LOG_EVENTS = r"""
ev AS (
  SELECT file_path, line_no, value,
    nullif(regexp_extract(value, '^(\d{4}-\d{2}-\d{2})', 1), '') AS line_date,
    nullif(regexp_extract(value, '/usr/sap/HDB/SYS/global/hdb/backint/DB_HDB/([\w\d_-]+)', 1), '') AS backup_file
  FROM log WHERE NOT contains(value, 'LOGBCKUP')),
ev2 AS (SELECT *, coalesce(ends_with(backup_file, '_0_1'), false) AS ignored FROM ev),
lines AS (
  SELECT file_path, line_no, value, line_date, backup_file, ignored,
    CASE WHEN NOT ignored AND backup_file IS NOT NULL
         THEN contains(backup_file, 'databackup_differential')
              OR contains(value, 'command: BACKUP DATA FOR HDB USING DIFFERENTIAL') END AS differential,
    CASE WHEN NOT ignored THEN nullif(regexp_extract(value, 'state of service: .*?, (\S+):', 1), '') END AS hostname,
    CASE WHEN ignored THEN NULL
         WHEN contains(value, 'SAVE DATA finished successfully') THEN 'successful'
         WHEN contains(value, 'SAVE DATA finished with error: [447] backup could not be completed') THEN 'failed'
    END AS status,
    CASE WHEN NOT ignored THEN try_cast(nullif(regexp_extract(value,
         'progress of service: .*?, volume: (\d+), 100% (\d+)/\d+', 2), '') AS DOUBLE) END AS size_bytes,
    NOT ignored AND contains(value, 'SAVE DATA finished') AS finished
  FROM ev2)"""

LINE_EVENTS_SELECT = """
SELECT file_path, line_no, value, line_date, backup_file, ignored, differential, hostname, status,
  CASE WHEN status IS NOT NULL THEN line_date END AS end_date, size_bytes, finished
FROM lines"""

SESSIONS_TAIL = """,
s1 AS (SELECT *, CASE WHEN status IS NOT NULL THEN line_date END AS end_date,
  coalesce(sum(CASE WHEN finished THEN 1 ELSE 0 END) OVER (PARTITION BY file_path ORDER BY line_no
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM lines),
s2 AS (SELECT *, finished AND bool_or(line_date IS NOT NULL) OVER (PARTITION BY file_path, seg) AS closes FROM s1),
s3 AS (SELECT *, coalesce(sum(CASE WHEN closes THEN 1 ELSE 0 END) OVER (PARTITION BY file_path ORDER BY line_no
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sid FROM s2),
s4 AS (SELECT *, last_value(line_date IGNORE NULLS) OVER (PARTITION BY file_path, sid ORDER BY line_no
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS in_force FROM s3),
g AS (
  SELECT file_path, sid,
    max(CASE WHEN closes THEN line_no END) AS close_line,
    bool_or(coalesce(differential AND in_force IS NULL, false)) AS bad,
    arg_max(line_date, line_no) FILTER (WHERE line_date IS NOT NULL) AS start_s,
    arg_max(end_date, line_no) FILTER (WHERE end_date IS NOT NULL) AS end_s,
    arg_max(hostname, line_no) FILTER (WHERE hostname IS NOT NULL) AS hostname,
    arg_max(CASE WHEN differential THEN 'differential' ELSE 'full' END, line_no)
      FILTER (WHERE differential IS NOT NULL) AS backup_type,
    arg_max(CASE WHEN differential THEN replace(in_force, '-', '_') || '_07-30' ELSE 'COMPLETE_DATA_BACKUP' END, line_no)
      FILTER (WHERE differential IS NOT NULL) AS backup_name,
    arg_max(status, line_no) FILTER (WHERE status IS NOT NULL) AS status,
    arg_max(size_bytes, line_no) FILTER (WHERE size_bytes IS NOT NULL) AS size_bytes
  FROM s4 GROUP BY 1, 2),
sessions AS (
  SELECT file_path, close_line,
    CAST(try_strptime(start_s, '%Y-%m-%d') AS DATE) AS report_period_start,
    CAST(try_strptime(end_s, '%Y-%m-%d') AS DATE) AS report_period_end,
    hostname, coalesce(backup_type, 'full') AS backup_type, backup_name,
    coalesce(status, 'failed') AS status, coalesce(size_bytes, 0.0) AS backup_size_bytes
  FROM g WHERE close_line IS NOT NULL AND file_path NOT IN (SELECT file_path FROM g WHERE bad))
"""

FACT_LOG_SELECT = """
SELECT report_period_start, report_period_end, 'HANA' AS resource_type, 'HANA' AS component_type,
  backup_name, hostname, backup_type, status, backup_size_bytes, current_date AS load_date
FROM sessions"""


def _log_with(extra: str = "") -> str:
    return f"WITH log AS ({LOG}),{LOG_EVENTS}{extra}"


_SESSIONS_WITH = _log_with(SESSIONS_TAIL)
_UNION_WITH = (f"WITH log AS ({LOG}), report AS ({REPORT}),{LOG_EVENTS}{SESSIONS_TAIL}, "
               f"fact AS ({FACT_REPORT} UNION ALL {FACT_LOG_SELECT})\n")

SQL.update({
    "map_status": _with(report=REPORT) + """
SELECT "Job Status" AS job_status,
  CASE WHEN "Job Status" = 'COMPLETED' THEN 'SUCCESSFUL' ELSE "Job Status" END AS status FROM report""",
    "map_component": _with(report=REPORT) + """
SELECT "Recovery Point ARN" AS recovery_point_arn,
  CASE WHEN contains("Recovery Point ARN", 'image/ami-')
       THEN upper(regexp_extract("Recovery Point ARN", 'image/(ami)-[^/]+', 1)) ELSE 'RDS' END AS component_type
FROM report""",
    "extract_host": _with(report=REPORT) + f"""
SELECT "Resource ARN" AS resource_arn, {_HOST} AS hostname FROM report""",
    "parse_period": _with(report=REPORT) + """
SELECT "Report Time Period Start" AS period_start, "Report Time Period End" AS period_end,
  CAST(try_strptime(substring("Report Time Period Start", 1, 10), '%Y-%m-%d') AS DATE) AS report_period_start,
  CAST(try_strptime(substring("Report Time Period End", 1, 10), '%Y-%m-%d') AS DATE) AS report_period_end
FROM report""",
    "size_gib": _with(report=REPORT) + """
SELECT "Backup Size in Bytes" AS size_text, try_cast("Backup Size in Bytes" AS DOUBLE) AS backup_size_bytes,
  round(try_cast("Backup Size in Bytes" AS DOUBLE) / 1073741824, 2) AS size_gb FROM report""",
    "hour_parts": _with(consent=CONSENT) + """
SELECT created_at, cast(hour(created_at) AS INTEGER) AS hour, date_trunc('hour', created_at) AS hour_start,
  strftime(created_at, '%Y-%m-%d %H:00:00') AS hour_string, strftime(created_at, '%Y-%m-%d') AS day_string,
  CAST(created_at AS DATE) AS date_day FROM consent""",
    "backup_fact_report": _with(report=REPORT) + FACT_REPORT,
    "report_detail": _with(report=REPORT) + DETAIL,
    "project_available": _with(report=REPORT) + """
SELECT "Report Time Period Start", "Report Time Period End", "Job Status", "Resource Type", "Resource ARN",
  "Backup Size in Bytes" FROM report""",
    "verify_by_load_day": _with(report=REPORT, detail=DETAIL) + """
SELECT CAST(file_last_modified AS DATE) AS load_date, count(*) AS records FROM detail GROUP BY 1""",
    "backup_log_events": _log_with() + LINE_EVENTS_SELECT,
    "backup_sessions": _SESSIONS_WITH + "SELECT * FROM sessions",
    "backup_fact_log": _SESSIONS_WITH + FACT_LOG_SELECT,
    "backup_sessions_by_status": _SESSIONS_WITH
        + "SELECT backup_type, status, count(*) AS sessions FROM sessions GROUP BY 1, 2",
    "backup_fact_union": _UNION_WITH + "SELECT * FROM fact",
    "verify_total": _UNION_WITH + "SELECT count(*) AS records FROM fact",
    "verify_by_component": _UNION_WITH
        + "SELECT component_type, count(*) AS records FROM fact GROUP BY 1",
    "verify_sample": _UNION_WITH + """
SELECT hostname, backup_name, component_type FROM fact
ORDER BY hostname NULLS FIRST, backup_name NULLS FIRST, component_type NULLS FIRST LIMIT 10""",
    "distinct_component": _UNION_WITH + "SELECT DISTINCT component_type FROM fact",
    "distinct_host_pair": _UNION_WITH + "SELECT DISTINCT hostname, backup_name FROM fact",
})

# ------------------------------------------------- files, loads, sinks, stream
# File fixtures hold the derived rows above; the processing day is fixed.

FILE_DAY = "2025-05-13"
_ON_DAY = f"DATE '{FILE_DAY}' AS load_date"
_REPORT_CSV = 'SELECT * EXCLUDE (delivery_day, o_orderkey) FROM report'
_REPORT_K = REPORT.replace("FROM orders", ", o_orderkey FROM orders")
_FACT_ON_DAY = FACT_REPORT.replace("current_date AS load_date", _ON_DAY)

_CONSENT_TABLE = """
SELECT consent_id, organization_id, website_id, consent_hashid, CAST(NULL AS VARCHAR) AS ip_address,
  ip_country, CAST(NULL AS VARCHAR) AS ip_region, CAST(NULL AS VARCHAR) AS gcp_preference, device_name,
  CAST(NULL AS VARCHAR) AS storage_item, CAST(NULL AS VARCHAR) AS user_preferences,
  CAST(NULL AS TIMESTAMP) AS accepted_at, session_hashid, created_at, account_hashid, year, month, day
FROM consent"""

_PAGEVIEW_JSON_TOP = """
SELECT 'a' || cast(user_id AS VARCHAR) AS account_hashid,
  's' || cast(user_id AS VARCHAR) || '-' || strftime(ts, '%d') AS session_hashid,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'c' || cast(event_id % 997 AS VARCHAR) END AS consent_hashid,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE '/p/' || cast(event_id % 50 AS VARCHAR) END AS page_url,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp", event_id % 10 = 0 OR (event_id % 9 = 0 AND event_id % 5 <> 0) AS visitor_details_missing
FROM events WHERE event_type = 'view'"""

SQL.update({
    "backup_fact_union": _UNION_WITH + "SELECT * FROM fact",
    "scan_report_csv": _with(report=_REPORT_K) + _REPORT_CSV,
    "select_day_folder": _with(report=REPORT) + _FACT_ON_DAY,
    "select_report_files": _with(report=REPORT) + DETAIL.replace(
        "CAST(current_date AS TIMESTAMP) AS file_last_modified, current_date AS load_date",
        f"TIMESTAMP '{FILE_DAY} 00:00:00' AS file_last_modified, {_ON_DAY}"),
    "file_metadata": """
SELECT '2025/05/13' AS day_folder, count(*) AS records, true AS files_non_empty FROM orders
UNION ALL
SELECT '2025/05/14' AS day_folder, count(*) AS records, true AS files_non_empty FROM orders""",
    "files_newest_first": """
SELECT '2025/05/14' AS day_folder, 1 AS newest_rank UNION ALL SELECT '2025/05/13' AS day_folder, 2 AS newest_rank""",
    "scan_pageview_json": _PAGEVIEW_JSON_TOP,
    "corrupt_pageview_json": """
SELECT * FROM (
  SELECT true AS loaded, count(*) AS records FROM events
  WHERE event_type = 'view' AND event_id % 9 = 0 AND event_id % 5 <> 0
  UNION ALL
  SELECT false AS loaded, count(*) AS records FROM events WHERE event_type = 'view' AND event_id % 100 = 0)
WHERE records > 0""",
    "consent_partition_days": _with(
        all_consent=CONSENT, consent="SELECT * FROM all_consent WHERE year = '2024' AND day IN ('05', '15', '25')") + _Q2,
    "persistent_device_view": _with(consent=CONSENT) + _Q1.format(src="consent"),
    "persistent_page_visit_view": _with(pageview=PAGEVIEW, consent=CONSENT) + _Q4,
    "consent_hourly_stats_ordered": _with(consent=CONSENT) + _Q2,
    "page_visit_stats_ordered": _with(pageview=PAGEVIEW, consent=CONSENT) + _Q4,
    "skipped_log_files": _SESSIONS_WITH + """
SELECT DISTINCT file_path AS log_name, 'differential backup without a date' AS reason FROM g WHERE bad""",
    "flatten_pageview": PAGEVIEW_FLAT,
    "write_flat_parquet": PAGEVIEW_FLAT,
    "pageview_typed": _with(pageview=PAGEVIEW) + "SELECT * FROM pageview",
    "scan_backup_log": f"""WITH log AS ({LOG})
SELECT file_path AS log_name, row_number() OVER (PARTITION BY file_path ORDER BY line_no) AS line_number,
  value FROM log""",
    "backup_fact_from_files": _SESSIONS_WITH + FACT_LOG_SELECT.replace("current_date AS load_date", _ON_DAY),
    "write_consent_partitioned": _with(consent=CONSENT) + _CONSENT_TABLE,
    "scan_consent_partition": _with(consent=CONSENT) + _Q1.format(src="consent"),
    "append_by_name": _with(report=REPORT) + FACT_REPORT,
    "insert_by_position": _SESSIONS_WITH + FACT_LOG_SELECT,
    "overwrite_table": _with(report=REPORT) + DETAIL,
    "stream_report_fact": _with(report=REPORT) + _FACT_ON_DAY,
    "stream_log_fact": _SESSIONS_WITH + FACT_LOG_SELECT.replace("current_date AS load_date", _ON_DAY),
    "growing_log_sessions": _SESSIONS_WITH + FACT_LOG_SELECT.replace("current_date AS load_date", _ON_DAY),
})

_FOREIGN = """
SELECT consent_id, organization_id, website_id, consent_hashid, CAST(NULL AS VARCHAR) AS ip_address,
  ip_country, CAST(NULL AS VARCHAR) AS ip_region, CAST(NULL AS VARCHAR) AS gcp_preference, device_name,
  CAST(NULL AS VARCHAR) AS storage_item, CAST(NULL AS VARCHAR) AS user_preferences,
  CAST(NULL AS TIMESTAMP) AS accepted_at, session_hashid, created_at, account_hashid, year, month, day
FROM consent WHERE day = '15' OR CAST(substring(account_hashid, 2) AS BIGINT) % 2 = 0"""

_REQUIRED = ["Job Status", "Resource Type", "Report Time Period Start", "Report Time Period End",
             "Resource ARN", "Backup Size in Bytes", "Recovery Point ARN"]

SQL.update({
    "unreadable_log_files": _SESSIONS_WITH + """
SELECT DISTINCT file_path AS log_name, 'differential backup without a date' AS reason FROM g WHERE bad
UNION ALL
SELECT DISTINCT 'broken-' || file_path AS log_name, 'cannot be read to its end' AS reason FROM log WHERE starts_with(file_path, 'hana-0-')
UNION ALL
SELECT DISTINCT 'gone-' || file_path AS log_name, 'vanished' AS reason FROM log WHERE starts_with(file_path, 'hana-0-')""",
    "sessions_beside_unreadable_files": _SESSIONS_WITH + FACT_LOG_SELECT.replace("current_date AS load_date", _ON_DAY),
    "foreign_partitions": _with(consent=CONSENT) + _CONSENT_TABLE,
    "foreign_partitions_of_a_day": _with(consent=CONSENT) + _FOREIGN,
    "page_visit_days": _with(all_views=PAGEVIEW, consent=CONSENT,
                             pageview="SELECT * FROM all_views WHERE year = '2024' AND day IN ('05', '15', '25')") + _Q4,
    "page_visit_bucketed": _with(pageview=PAGEVIEW, consent=CONSENT) + _Q4,
    "reports_with_mixed_headers": _with(report=REPORT) + _FACT_ON_DAY,
    "dashboard_from_daily_state": _with(pageview=PAGEVIEW) + _Q3,
    "validated_report": "SELECT '' AS missing, count(*) AS records FROM orders" + "".join(
        f" UNION ALL SELECT '{c}' AS missing, 0 AS records" for c in _REQUIRED),
    "project_available_missing": _with(report=REPORT) + """
SELECT "Report Time Period Start", "Report Time Period End", "Job Status", "Resource Type", "Backup Size in Bytes" FROM report""",
    "load_counts": _SESSIONS_WITH + """
SELECT false AS existed, true AS exists_now, (SELECT count(*) FROM orders) AS report_rows, (SELECT count(*) FROM sessions) AS log_rows,
  2 * (SELECT count(*) FROM orders) + (SELECT count(*) FROM sessions) AS rows_after_refresh""",
})
