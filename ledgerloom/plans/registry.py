"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver tables (or data Spark derives from them) whole;
nothing is capped or sampled.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixtures as fx
from .. import schemas as S
from ..functions import (extract_host, hour_of, hour_start, hour_string, day_string,
                         map_component, map_status, parse_period_date, size_bytes, size_gib,
                         to_day)
from ..operators import daily_state, logs, report, verify, views
from ..session import pack_small_files, scratch_path
from ..sinks import tables
from ..sources import files, readers
from ..streaming import growing, incremental
from . import fixture_files as ff
from . import jobs

Query = Callable[[SparkSession, str], DataFrame]

_WRITTEN: dict[tuple[str, str, str], str] = {}


def _written(spark, sf_dir, writer):
    """What ``writer`` made of an input folder, made once per session and state of the given tables.

    Queries only read it, so the keys that share an input share one copy.
    """
    state = ",".join(files.path_state(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in ("events", "orders"))
    key = (spark.sparkContext.applicationId, f"{sf_dir}?{state}", writer.__name__)
    if key not in _WRITTEN:
        _WRITTEN[key] = writer(spark, sf_dir)
    return _WRITTEN[key]


def _table_name(kind: str) -> str:
    return f"ledgerloom_{kind}_{uuid.uuid4().hex[:10]}"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.read_table(spark, sf_dir, "events")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.read_table(spark, sf_dir, "orders")


def q_consent_device_stats(spark, sf_dir):
    return views.consent_device_stats(fx.consent(_events(spark, sf_dir)))


def q_consent_hourly_stats(spark, sf_dir):
    return views.consent_hourly_stats(fx.consent(_events(spark, sf_dir)))


def q_dashboard_summary_stats(spark, sf_dir):
    return views.dashboard_summary_stats(fx.pageview(_events(spark, sf_dir)))


def q_page_visit_stats(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return views.page_visit_stats(fx.pageview(ev), fx.consent(ev))


def q_page_visit_stats_multi_org(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return views.page_visit_stats(fx.pageview(ev), fx.consent(ev, orgs_per_account=True))


def q_join_pageview_consent(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return views.join_pageview_consent(fx.pageview(ev), fx.consent(ev))


def _report(spark, sf_dir):
    return fx.report(_orders(spark, sf_dir))


def _q(name):
    return F.col(f"`{name}`")


def q_map_status(spark, sf_dir):
    return _report(spark, sf_dir).select(_q(S.COL_JOB_STATUS).alias("job_status"),
                                         map_status(_q(S.COL_JOB_STATUS)).alias("status"))


def q_map_component(spark, sf_dir):
    return _report(spark, sf_dir).select(
        _q(S.COL_RECOVERY_POINT_ARN).alias("recovery_point_arn"),
        map_component(_q(S.COL_RECOVERY_POINT_ARN)).alias("component_type"))


def q_extract_host(spark, sf_dir):
    return _report(spark, sf_dir).select(_q(S.COL_RESOURCE_ARN).alias("resource_arn"),
                                         extract_host(_q(S.COL_RESOURCE_ARN)).alias("hostname"))


def q_parse_period(spark, sf_dir):
    return _report(spark, sf_dir).select(
        _q(S.COL_PERIOD_START).alias("period_start"), _q(S.COL_PERIOD_END).alias("period_end"),
        parse_period_date(_q(S.COL_PERIOD_START)).alias("report_period_start"),
        parse_period_date(_q(S.COL_PERIOD_END)).alias("report_period_end"))


def q_size_gib(spark, sf_dir):
    return _report(spark, sf_dir).select(
        _q(S.COL_SIZE_BYTES).alias("size_text"),
        size_bytes(_q(S.COL_SIZE_BYTES)).alias("backup_size_bytes"),
        size_gib(_q(S.COL_SIZE_BYTES)).alias("size_gb"))


def q_hour_parts(spark, sf_dir):
    ts = F.col("created_at")
    return fx.consent(_events(spark, sf_dir)).select(
        ts, hour_of(ts).alias("hour"), hour_start(ts).alias("hour_start"),
        hour_string(ts).alias("hour_string"), day_string(ts).alias("day_string"),
        to_day(ts).alias("date_day"))


def q_backup_fact_report(spark, sf_dir):
    return report.backup_fact_report(_report(spark, sf_dir))


def _detail(spark, sf_dir):
    # Load time pinned to the start of the processing day, so reruns agree.
    return report.report_detail(_report(spark, sf_dir),
                                as_of_ts=F.current_date().cast("timestamp_ntz"))


def q_report_detail(spark, sf_dir):
    return _detail(spark, sf_dir)


def q_project_available(spark, sf_dir):
    return report.project_available(_report(spark, sf_dir))


def q_verify_by_load_day(spark, sf_dir):
    return verify.rows_by_load_day(_detail(spark, sf_dir))


def _log_lines(spark, sf_dir):
    return fx.log_lines(_events(spark, sf_dir))


def q_backup_log_events(spark, sf_dir):
    return logs.line_events(_log_lines(spark, sf_dir)).drop("chunk", "undecodable")


def _sessions(spark, sf_dir):
    return logs.sessions(_log_lines(spark, sf_dir))


def q_backup_sessions(spark, sf_dir):
    return _sessions(spark, sf_dir)


def q_backup_fact_log(spark, sf_dir):
    return logs.backup_fact_log(_sessions(spark, sf_dir))


def q_backup_sessions_by_status(spark, sf_dir):
    return logs.sessions_by_status(_sessions(spark, sf_dir))


def _loaded(spark, name: str) -> DataFrame:
    """The rows of a table that a query made; the table goes, its files stay for the reader."""
    location = [r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r["col_name"] == "Location"][0]
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).parquet(location)


def _write_fact_table(spark, sf_dir) -> str:
    """Both pipelines appended by name into one table created empty first."""
    name = _table_name("fact")
    tables.create_table_if_absent(spark, name, S.BACKUP_FACT, scratch_path(spark, "fact-table"))
    tables.append_by_name(report.backup_fact_report(_report(spark, sf_dir)), name)
    tables.append_by_name(logs.backup_fact_log(_sessions(spark, sf_dir)), name)
    return name


def q_backup_fact_union(spark, sf_dir):
    return _loaded(spark, _write_fact_table(spark, sf_dir))


def _check(spark, sf_dir, which: str) -> DataFrame:
    """One of the load checks over the loaded table."""
    name = _written(spark, sf_dir, _write_fact_table)
    return jobs.load_checks(spark, name)[which]


def q_verify_total(spark, sf_dir):
    return _check(spark, sf_dir, "total")


def q_verify_by_component(spark, sf_dir):
    return _check(spark, sf_dir, "by_component")


def q_verify_sample(spark, sf_dir):
    return _check(spark, sf_dir, "sample")


def q_distinct_component(spark, sf_dir):
    return verify.distinct_components(spark.table(_written(spark, sf_dir, _write_fact_table)))


def q_distinct_host_pair(spark, sf_dir):
    return verify.distinct_host_pairs(spark.table(_written(spark, sf_dir, _write_fact_table)))


# ---------------------------------------------------------- files, loads, sinks

def q_scan_report_csv(spark, sf_dir):
    root = _written(spark, sf_dir, ff.write_report_days)
    return readers.read_report_csv(spark, files.day_folder(root, ff.FILE_DAY))


def q_select_day_folder(spark, sf_dir):
    root = _written(spark, sf_dir, ff.write_report_days)
    return jobs.report_fact_frame(spark, root, as_of=ff.FILE_DAY)


def q_select_report_files(spark, sf_dir):
    root = _written(spark, sf_dir, ff.write_report_folders)
    return jobs.report_detail_frame(spark, root, as_of=ff.FILE_DAY, as_of_ts=ff.file_day_ts())


def q_file_metadata(spark, sf_dir):
    """Rows per delivery day, taken from each row's source file path."""
    root = _written(spark, sf_dir, ff.write_report_days)
    rows = readers.with_source_file(readers.read_report_csv(spark, f"{root}/*/*/*/"))
    day = F.regexp_extract("source_file", r"/(\d{4}/\d{2}/\d{2})/[^/]+$", 1)
    return rows.groupBy(day.alias("day_folder")).agg(
        F.count(F.lit(1)).alias("records"),
        (F.min("source_file_size") > 0).alias("files_non_empty"))


def q_files_newest_first(spark, sf_dir):
    """Delivery days by their newest file; the days were written one after the other."""
    root = _written(spark, sf_dir, ff.write_report_days)
    listing = files.files_newest_first(files.list_files(spark, root, glob=files.CSV_FILE_GLOB))
    day = F.regexp_extract("file_path", r"/(\d{4}/\d{2}/\d{2})/[^/]+$", 1)
    newest = listing.groupBy(day.alias("day_folder")).agg(F.max("file_modification_time").alias("at"))
    return newest.select("day_folder", F.row_number().over(Window.orderBy(F.desc("at"))).alias("newest_rank"))


def _pageview_json(spark, sf_dir):
    path = _written(spark, sf_dir, ff.write_pageview_json)
    ok, _ = readers.split_corrupt(readers.read_pageview_json(spark, path))
    return ok


def q_scan_pageview_json(spark, sf_dir):
    return _pageview_json(spark, sf_dir).select(
        "account_hashid", "session_hashid", "consent_hashid", "page_url", "timestamp",
        F.coalesce(*[F.col(f"visitor_details.{f.name}") for f in S.VISITOR_DETAILS.fields]).isNull()
        .alias("visitor_details_missing"))


def q_corrupt_pageview_json(spark, sf_dir):
    """Records that do not parse, wholly or in part, as kept aside."""
    path = _written(spark, sf_dir, ff.write_pageview_json)
    _, bad = readers.split_corrupt(readers.read_pageview_json(spark, path))
    return bad.groupBy("loaded").agg(F.count(F.lit(1)).alias("records"))


def q_flatten_pageview(spark, sf_dir):
    return readers.flatten_pageview(_pageview_json(spark, sf_dir))


def q_write_flat_parquet(spark, sf_dir):
    src = _written(spark, sf_dir, ff.write_pageview_json)
    out = scratch_path(spark, "pageview-flat")
    jobs.flatten_pageviews(spark, src, out)
    return spark.read.parquet(out)


def q_pageview_typed(spark, sf_dir):
    return readers.typed_pageview(readers.flatten_pageview(_pageview_json(spark, sf_dir)))


def q_scan_backup_log(spark, sf_dir):
    lines = readers.read_backup_log(spark, _written(spark, sf_dir, ff.write_log_files), glob=None)
    return readers.number_lines(lines).select(
        ff.log_name().alias("log_name"), "line_number", "value")


def q_backup_fact_from_files(spark, sf_dir):
    root = _written(spark, sf_dir, ff.write_log_files)
    lines = readers.read_backup_log(spark, root, glob=None)
    return logs.backup_fact_log(logs.sessions(lines), as_of=ff.FILE_DAY)


def _write_consent_table(spark, sf_dir):
    """The partitioned consent table, loaded through the catalog."""
    name = _table_name("consent")
    tables.load_consent(fx.consent(_events(spark, sf_dir)), name, scratch_path(spark, "consent-table"))
    return name


def _consent_table(spark, sf_dir) -> str:
    """The loaded consent table's name; its files are small and many, and its scans pack them."""
    name = _written(spark, sf_dir, _write_consent_table)
    pack_small_files(spark)
    return name


def _consent(spark, sf_dir):
    return readers.read_consent(spark, _consent_table(spark, sf_dir))


def _wall_clock(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("accepted_at", "created_at")})


def q_write_consent_partitioned(spark, sf_dir):
    return _wall_clock(_consent(spark, sf_dir))


def q_scan_consent_partition(spark, sf_dir):
    """The device view over the whole partitioned table, read by name."""
    return views.consent_device_stats(_consent(spark, sf_dir))


def q_consent_partition_days(spark, sf_dir):
    """The hourly view over some days: the partition predicate is answered by the catalog."""
    rows = _consent(spark, sf_dir).where("year = '2024' AND day IN ('05', '15', '25')")
    return views.consent_hourly_stats(rows)


def _write_pageview_table(spark, sf_dir):
    name = _table_name("pageview")
    fx.pageview(_events(spark, sf_dir)).write.option("path", scratch_path(spark, "pageview-table")).saveAsTable(name)
    return name


def _persistent_view(spark, sf_dir, view: str) -> DataFrame:
    """A persistent view over the two catalog tables."""
    pageview, consent = _written(spark, sf_dir, _write_pageview_table), _consent_table(spark, sf_dir)
    tables.create_persistent_views(spark, consent, pageview, prefix=f"{consent}_")
    return spark.table(f"{consent}_{view}")


def q_persistent_device_view(spark, sf_dir):
    return _persistent_view(spark, sf_dir, "consent_device_stats")


def q_persistent_page_visit_view(spark, sf_dir):
    return _persistent_view(spark, sf_dir, "page_visit_stats")


def q_consent_hourly_stats_ordered(spark, sf_dir):
    return views.consent_hourly_stats(fx.consent(_events(spark, sf_dir)), ordered=True)


def q_page_visit_stats_ordered(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return views.page_visit_stats(fx.pageview(ev), fx.consent(ev), ordered=True)


def q_skipped_log_files(spark, sf_dir):
    """Log files that yield nothing, and why."""
    pieces = logs.stored_pieces(readers.read_backup_log(spark, _written(spark, sf_dir, ff.write_log_files), glob=None))
    return logs.skipped_files(pieces).select(ff.log_name().alias("log_name"), "reason")


def _damaged(spark, sf_dir):
    root = _written(spark, sf_dir, ff.write_damaged_logs)
    return jobs.log_pieces(spark, root, glob=None, listing=spark.read.parquet(f"{root}-listing"))


def q_unreadable_log_files(spark, sf_dir):
    """Log files that yield nothing among broken and vanished ones, and why."""
    return _damaged(spark, sf_dir)[1].select(ff.log_name().alias("log_name"), "reason")


def q_sessions_beside_unreadable_files(spark, sf_dir):
    """The sessions of all other log files."""
    return logs.backup_fact_log(logs.sessions_of(_damaged(spark, sf_dir)[0]), as_of=ff.FILE_DAY)


def _write_foreign_consents(spark, sf_dir) -> str:
    """Accounts of even users loaded through the table; those of odd users landed by another job as plain files."""
    rows = fx.consent(_events(spark, sf_dir))
    odd = F.substring("account_hashid", 2, 20).cast("long") % 2 == 1
    name, location = _table_name("foreign"), scratch_path(spark, "foreign-consents")
    tables.load_consent(rows.where(~odd), name, location)
    tables.write_consent(rows.where(odd), location)
    return name


def q_foreign_partitions(spark, sf_dir):
    """The whole consent table by name, after the folders of another job were discovered."""
    name = _write_foreign_consents(spark, sf_dir)
    tables.recover_partitions(spark, name)
    pack_small_files(spark)
    return _wall_clock(readers.read_consent(spark, name))


def q_foreign_partitions_of_a_day(spark, sf_dir):
    """The same, after one day's folders of another job were added."""
    name = _write_foreign_consents(spark, sf_dir)
    tables.add_partitions(spark, name, day="15")
    pack_small_files(spark)
    return _wall_clock(readers.read_consent(spark, name))


def q_page_visit_days(spark, sf_dir):
    """Page visits of some days over the two catalog tables; the accounts seen prune the consent table."""
    pageview, consent = _written(spark, sf_dir, _write_pageview_table), _consent_table(spark, sf_dir)
    return views.page_visits_of_days(spark, consent, pageview, "year = '2024' AND day IN ('05', '15', '25')")


#: Buckets of the folded page views and consents (a fixed value for these inputs).
BUCKETS = 8


def _write_page_sessions(spark, sf_dir) -> str:
    name = _table_name("page_sessions")
    tables.write_bucketed(views.page_sessions(fx.pageview(_events(spark, sf_dir))), name, scratch_path(spark, "page-sessions"),
                          ["account_hashid"], BUCKETS)
    return name


def _write_consent_accounts(spark, sf_dir) -> str:
    name = _table_name("consent_accounts")
    tables.write_bucketed(views.consent_accounts(fx.consent(_events(spark, sf_dir))), name, scratch_path(spark, "consent-accounts"),
                          ["account_hashid"], BUCKETS)
    return name


def q_page_visit_bucketed(spark, sf_dir):
    """Page visits from two tables bucketed by account."""
    return views.page_visits_of_folded(spark.table(_written(spark, sf_dir, _write_page_sessions)),
                                       spark.table(_written(spark, sf_dir, _write_consent_accounts)))


def q_reports_with_mixed_headers(spark, sf_dir):
    """The day's facts from files with different headers."""
    return jobs.report_fact_by_header(spark, _written(spark, sf_dir, ff.write_report_headers), as_of=ff.FILE_DAY)


def _write_daily_state(spark, sf_dir) -> str:
    """Page views in three loads that touch the same days, the second one run twice."""
    path = scratch_path(spark, "daily-state")
    rows = fx.pageview(_events(spark, sf_dir)).withColumn("third", F.pmod(F.xxhash64("account_hashid", "created_at"), F.lit(3)))
    for k in (0, 1, 1, 2):
        daily_state.write_load(rows.where(F.col("third") == k), path, f"load-{k}")
    return path


def q_dashboard_from_daily_state(spark, sf_dir):
    """The dashboard folded from the states of the loads."""
    return daily_state.dashboard_of_state(daily_state.read_state(spark, _written(spark, sf_dir, _write_daily_state)))


def q_validated_report(spark, sf_dir):
    """Report rows that pass the check of the required columns, and what it says with one of them away."""
    rows = _report(spark, sf_dir)
    found = [report.validate_required(rows).groupBy().agg(F.lit("").alias("missing"), F.count(F.lit(1)).alias("records"))]
    for column in S.REQUIRED_REPORT_COLUMNS:
        less = rows.drop(column)
        try:
            report.validate_required(less)
        except report.MissingColumnsError:
            found.append(less.groupBy().agg(F.lit(", ".join(report.missing_columns(less))).alias("missing"), F.lit(0).cast("long").alias("records")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def q_project_available_missing(spark, sf_dir):
    """The projection of reports that lack a column."""
    return report.project_available(_report(spark, sf_dir).drop(S.COL_RESOURCE_ARN))


def q_load_counts(spark, sf_dir):
    """Existence and row counts around two loads, and after another job's files became known by a refresh."""
    name, location = _table_name("counts"), scratch_path(spark, "counts-table")
    before = tables.table_exists(spark, name)
    tables.create_table_if_absent(spark, name, S.BACKUP_FACT, location)
    fact = report.backup_fact_report(_report(spark, sf_dir))
    first, second = tables.append_by_name(fact, name), tables.append_by_name(logs.backup_fact_log(_sessions(spark, sf_dir)), name)
    tables.write_parquet(fact, location)        # another job, past the catalog
    tables.refresh(spark, name)
    return spark.table(name).groupBy().agg(
        F.lit(before).alias("existed"), F.lit(tables.table_exists(spark, name)).alias("exists_now"), F.lit(first).cast("long").alias("report_rows"),
        F.lit(second).cast("long").alias("log_rows"), F.count(F.lit(1)).alias("rows_after_refresh"))


def q_append_by_name(spark, sf_dir):
    name = _table_name("append")
    tables.create_table_if_absent(spark, name, S.BACKUP_FACT, scratch_path(spark, "append-table"))
    fact = report.backup_fact_report(_report(spark, sf_dir))
    tables.append_by_name(fact.select(*reversed(fact.columns)), name)
    return _loaded(spark, name)


def q_insert_by_position(spark, sf_dir):
    name = _table_name("insert")
    tables.create_table_if_absent(spark, name, S.BACKUP_FACT, scratch_path(spark, "insert-table"))
    tables.insert_by_position(logs.backup_fact_log(_sessions(spark, sf_dir)), name)
    return _loaded(spark, name)


def q_overwrite_table(spark, sf_dir):
    name = _table_name("overwrite")
    location = scratch_path(spark, "overwrite-table")
    tables.append_by_name(report.backup_fact_report(_report(spark, sf_dir)), name, location)
    tables.overwrite_table(_detail(spark, sf_dir), name, location)
    return _loaded(spark, name)


def q_stream_report_fact(spark, sf_dir):
    root = _written(spark, sf_dir, ff.write_report_days)
    out = scratch_path(spark, "stream-fact")
    return incremental.load_report_fact_incremental(
        spark, files.day_folder(root, ff.FILE_DAY), out, scratch_path(spark, "stream-ckpt"),
        as_of=ff.FILE_DAY)


def q_stream_log_fact(spark, sf_dir):
    root = _written(spark, sf_dir, ff.write_log_files)
    return incremental.load_log_fact_incremental(
        spark, root, scratch_path(spark, "stream-log-fact"), scratch_path(spark, "stream-log-ckpt"),
        as_of=ff.FILE_DAY, glob=None)


def q_growing_log_sessions(spark, sf_dir):
    """Every log delivered in three parts, a run after each: the sessions of the whole logs."""
    root, out, checkpoint = (scratch_path(spark, f"growing-{x}") for x in ("logs", "out", "ckpt"))
    for part in range(3):
        ff.write_log_part(spark, sf_dir, root, part)
        growing.load_growing_logs(spark, root, out, checkpoint, part_name=ff.LOG_PART)
    return logs.backup_fact_log(growing.sessions(spark, out), as_of=ff.FILE_DAY)


QUERIES: dict[str, Query] = {
    "consent_device_stats": q_consent_device_stats,
    "consent_hourly_stats": q_consent_hourly_stats,
    "dashboard_summary_stats": q_dashboard_summary_stats,
    "page_visit_stats": q_page_visit_stats,
    "page_visit_stats_multi_org": q_page_visit_stats_multi_org,
    "join_pageview_consent": q_join_pageview_consent,
    "map_status": q_map_status,
    "map_component": q_map_component,
    "extract_host": q_extract_host,
    "parse_period": q_parse_period,
    "size_gib": q_size_gib,
    "hour_parts": q_hour_parts,
    "backup_fact_report": q_backup_fact_report,
    "report_detail": q_report_detail,
    "project_available": q_project_available,
    "verify_by_load_day": q_verify_by_load_day,
    "backup_log_events": q_backup_log_events,
    "backup_sessions": q_backup_sessions,
    "backup_fact_log": q_backup_fact_log,
    "backup_sessions_by_status": q_backup_sessions_by_status,
    "verify_total": q_verify_total,
    "verify_by_component": q_verify_by_component,
    "verify_sample": q_verify_sample,
    "distinct_component": q_distinct_component,
    "distinct_host_pair": q_distinct_host_pair,
    "backup_fact_union": q_backup_fact_union,
    "scan_report_csv": q_scan_report_csv,
    "select_day_folder": q_select_day_folder,
    "select_report_files": q_select_report_files,
    "file_metadata": q_file_metadata,
    "files_newest_first": q_files_newest_first,
    "scan_pageview_json": q_scan_pageview_json,
    "corrupt_pageview_json": q_corrupt_pageview_json,
    "flatten_pageview": q_flatten_pageview,
    "write_flat_parquet": q_write_flat_parquet,
    "pageview_typed": q_pageview_typed,
    "scan_backup_log": q_scan_backup_log,
    "backup_fact_from_files": q_backup_fact_from_files,
    "write_consent_partitioned": q_write_consent_partitioned,
    "scan_consent_partition": q_scan_consent_partition,
    "consent_partition_days": q_consent_partition_days,
    "persistent_device_view": q_persistent_device_view,
    "persistent_page_visit_view": q_persistent_page_visit_view,
    "consent_hourly_stats_ordered": q_consent_hourly_stats_ordered,
    "page_visit_stats_ordered": q_page_visit_stats_ordered,
    "skipped_log_files": q_skipped_log_files,
    "unreadable_log_files": q_unreadable_log_files,
    "sessions_beside_unreadable_files": q_sessions_beside_unreadable_files,
    "foreign_partitions": q_foreign_partitions,
    "foreign_partitions_of_a_day": q_foreign_partitions_of_a_day,
    "page_visit_days": q_page_visit_days,
    "page_visit_bucketed": q_page_visit_bucketed,
    "reports_with_mixed_headers": q_reports_with_mixed_headers,
    "dashboard_from_daily_state": q_dashboard_from_daily_state,
    "validated_report": q_validated_report,
    "project_available_missing": q_project_available_missing,
    "load_counts": q_load_counts,
    "append_by_name": q_append_by_name,
    "insert_by_position": q_insert_by_position,
    "overwrite_table": q_overwrite_table,
    "stream_report_fact": q_stream_report_fact,
    "stream_log_fact": q_stream_log_fact,
    "growing_log_sessions": q_growing_log_sessions,
}
