"""Catalog sinks (K1-K11) and the available-now streaming load."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerloom import fixtures as fx
from ledgerloom import schemas as S
from ledgerloom.operators import report
from ledgerloom.sinks import tables
from ledgerloom.sources import readers
from ledgerloom.streaming import incremental

SF = "/root/testdata/sf0.001"


def _name(kind):
    return f"t_{kind}_{uuid.uuid4().hex[:8]}"


def _fact(spark):
    return report.backup_fact_report(fx.report(fx.read_table(spark, SF, "orders")), as_of="2025-05-13")


def test_create_if_absent_then_append_by_name_twice(spark, tmp_dir):
    name = _name("fact")
    assert tables.create_table_if_absent(spark, name, S.BACKUP_FACT, f"{tmp_dir}/t")
    assert tables.table_exists(spark, name)
    assert not tables.create_table_if_absent(spark, name, S.BACKUP_FACT, f"{tmp_dir}/t")
    assert spark.table(name).count() == 0 and spark.table(name).columns == S.BACKUP_FACT_COLUMNS
    fact = _fact(spark)
    n = fact.count()
    assert tables.append_by_name(fact.select(*reversed(fact.columns)), name) == n
    assert tables.append_by_name(fact, name) == n           # reruns duplicate rows
    back = spark.table(name)
    assert back.count() == 2 * n
    assert back.exceptAll(fact.unionByName(fact)).count() == 0


def test_insert_by_position_uses_position(spark, tmp_dir):
    name = _name("pos")
    spark.sql(f"CREATE TABLE {name} (a string, b string) USING parquet LOCATION '{tmp_dir}/p'")
    df = spark.createDataFrame([("x", "y")], "b string, a string")
    assert tables.insert_by_position(df, name) == 1
    assert spark.table(name).collect()[0].asDict() == {"a": "x", "b": "y"}


def test_overwrite_replaces_rows_and_schema(spark, tmp_dir):
    name = _name("ow")
    tables.append_by_name(_fact(spark), name, f"{tmp_dir}/ow")
    detail = spark.createDataFrame([("only",)], "c string")
    assert tables.overwrite_table(detail, name, f"{tmp_dir}/ow") == 1
    assert spark.table(name).columns == ["c"] and spark.table(name).count() == 1


def test_partitioned_consent_layout_and_pruning(spark, tmp_dir):
    consent = fx.consent(fx.read_table(spark, SF, "events"))
    n = tables.write_consent(consent, f"{tmp_dir}/consent")
    assert n == consent.count()
    folders = [d for d in os.listdir(f"{tmp_dir}/consent") if not d.startswith((".", "_"))]
    assert folders and all(d.startswith("account_hashid=") for d in folders)
    inner = os.listdir(f"{tmp_dir}/consent/{folders[0]}")
    assert all(d.startswith("year=") for d in inner)
    back = readers.read_consent_path(spark, f"{tmp_dir}/consent")
    assert dict(back.dtypes)["year"] == "string" and back.count() == n
    q = back.where("day = '15'")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "(day" in plan
    assert q.count() == consent.where("day = '15'").count()


def test_register_views(spark):
    ev = fx.read_table(spark, SF, "events")
    names = tables.register_views(spark, fx.consent(ev), fx.pageview(ev), prefix="v_")
    assert all(spark.catalog.tableExists(n) for n in names)
    assert spark.sql("SELECT count(*) FROM v_page_visit_stats").collect()[0][0] > 0


def test_available_now_stream_loads_each_file_once(spark, tmp_dir):
    rows = fx.report(fx.read_table(spark, SF, "orders")).select(
        *[F.col(f"`{c}`") for c in S.REQUIRED_REPORT_COLUMNS])
    first, second = rows.where("`Resource Type` = 'RDS'"), rows.where("`Resource Type` = 'EC2'")
    first.write.option("header", True).csv(f"{tmp_dir}/in/a")
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    got = incremental.load_report_fact_incremental(spark, f"{tmp_dir}/in", out, ckpt, as_of="2025-05-13")
    assert got.count() == first.count()
    second.write.option("header", True).csv(f"{tmp_dir}/in/b")
    got = incremental.load_report_fact_incremental(spark, f"{tmp_dir}/in", out, ckpt, as_of="2025-05-13")
    assert got.count() == rows.count()                     # the first files were not loaded again
    expected = report.backup_fact_report(rows, as_of="2025-05-13")
    assert got.exceptAll(expected).count() == 0


def test_consent_table_by_name_registers_and_prunes_partitions(spark, tmp_dir):
    consent = fx.consent(fx.read_table(spark, SF, "events"))
    name = _name("consent")
    assert tables.load_consent(consent, name, f"{tmp_dir}/consent") == consent.count()
    back = readers.read_consent(spark, name)
    assert back.count() == consent.count() and dict(back.dtypes)["created_at"] == "timestamp"
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == \
        consent.select("account_hashid", "year", "month", "day").distinct().count()
    q = back.where("day = '15'")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "CatalogFileIndex" in plan or "InMemoryFileIndex" in plan
    assert q.count() == consent.where("day = '15'").count()
    assert tables.load_consent(consent, name, f"{tmp_dir}/consent") and back.count() >= consent.count()


def test_append_refuses_other_columns(spark, tmp_dir):
    name = _name("cols")
    spark.createDataFrame([(1, 2)], "a int, b int").write.option("path", f"{tmp_dir}/c").saveAsTable(name)
    for batch in (spark.createDataFrame([(1, 2, 3)], "a int, b int, extra int"), spark.createDataFrame([(1,)], "a int")):
        with pytest.raises(tables.ColumnMismatchError):
            tables.append_by_name(batch, name)
    assert spark.table(name).count() == 1


def test_refresh_sees_files_written_by_another_job(spark, tmp_dir):
    name = _name("refresh")
    spark.createDataFrame([(1,)], "a int").write.option("path", f"{tmp_dir}/r").saveAsTable(name)
    assert spark.table(name).count() == 1
    spark.createDataFrame([(2,)], "a int").write.mode("append").parquet(f"{tmp_dir}/r")
    tables.refresh(spark, name)
    assert spark.table(name).count() == 2


def test_available_now_log_load_reads_each_file_once(spark, tmp_dir):
    d = "2024-05-01T00:00:00+00:00 "
    def log(path, host):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(d + f"state of service: n, {host}:1, v\n SAVE DATA finished successfully\n")
    log(f"{tmp_dir}/logs/a/1.log", "h1")
    out, ckpt = f"{tmp_dir}/fact", f"{tmp_dir}/ckpt"
    got = incremental.load_log_fact_incremental(spark, f"{tmp_dir}/logs", out, ckpt, as_of="2024-05-02")
    assert [r.hostname for r in got.collect()] == ["h1"]
    log(f"{tmp_dir}/logs/b/2.log", "h2")
    got = incremental.load_log_fact_incremental(spark, f"{tmp_dir}/logs", out, ckpt, as_of="2024-05-02")
    assert sorted(r.hostname for r in got.collect()) == ["h1", "h2"]
    assert got.columns == S.BACKUP_FACT_COLUMNS


def test_persistent_views_equal_dataframe_views(spark, tmp_dir):
    from ledgerloom.operators import views
    ev = fx.read_table(spark, SF, "events")
    consent, pageview = fx.consent(ev, orgs_per_account=True), fx.pageview(ev)
    ct, pt = _name("consent"), _name("pageview")
    consent.write.option("path", f"{tmp_dir}/c").saveAsTable(ct)
    pageview.write.option("path", f"{tmp_dir}/p").saveAsTable(pt)
    names = tables.create_persistent_views(spark, ct, pt, prefix=f"{ct}_")
    expected = {
        "consent_device_stats": views.consent_device_stats(consent),
        "consent_hourly_stats": views.consent_hourly_stats(consent),
        "dashboard_summary_stats": views.dashboard_summary_stats(pageview),
        "page_visit_stats": views.page_visit_stats(pageview, consent),
    }
    for name in names:
        got, want = spark.table(name), expected[name[len(ct) + 1:]]
        assert got.columns == want.columns and got.dtypes == want.dtypes, name
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name


def test_partitioned_write_is_rebalanced(spark):
    consent = fx.consent(fx.read_table(spark, SF, "events"))
    plan = tables.spread_for_write(consent, S.CONSENT_PARTITION_COLUMNS)._jdf.queryExecution().optimizedPlan()
    assert "RebalancePartitions" in plan.toString()


def _parts(root):
    """Files by folder, and the tasks that wrote below each account."""
    files, tasks = {}, {}
    for folder, _, names in os.walk(root):
        for part in (n for n in names if n.startswith("part-")):
            files.setdefault(folder, []).append(part)
            tasks.setdefault(os.path.relpath(folder, root).split(os.sep)[0], set()).add(part.split("-")[1])
    return files, tasks


@pytest.mark.parametrize("through_table", [True, False])
def test_many_small_folders_are_written_by_many_tasks(spark, tmp_dir, through_table):
    consent = fx.consent(fx.read_table(spark, SF, "events"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before, root = spark.conf.get(key), f"{tmp_dir}/consent"
    n = tables.load_consent(consent, _name("consent"), root) if through_table else tables.write_consent(consent, root)
    files, tasks = _parts(root)
    assert n == consent.count() and spark.conf.get(key) == before
    assert len(files) == consent.select(*S.CONSENT_PARTITION_COLUMNS).distinct().count()
    assert all(len(f) == 1 for f in files.values())                   # more tasks, not more files
    assert len(set.union(*tasks.values())) > 2                        # few bytes, but many folders
    assert all(len(t) == 1 for t in tasks.values())                   # the commit moves whole accounts


def test_failed_partitioned_write_restores_the_setting(spark, tmp_dir):
    consent = fx.consent(fx.read_table(spark, SF, "events"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    tables.write_consent(consent, f"{tmp_dir}/c")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.write_consent(consent, f"{tmp_dir}/c", mode="error")
    assert spark.conf.get(key) == before


def test_folders_are_listed_by_few_tasks(spark, tmp_dir):
    consent = fx.consent(fx.read_table(spark, SF, "events"))
    name, sc = _name("consent"), spark.sparkContext
    tables.load_consent(consent, name, f"{tmp_dir}/consent")
    group = uuid.uuid4().hex
    sc.setJobGroup(group, "read")
    try:
        assert readers.read_consent(spark, name).count() == consent.count()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert 0 < max(s.numTasks for s in stages if s) < 32


def test_listing_tasks_set_by_the_user_stay(spark):
    from ledgerloom.session import LISTING_TASKS_A_CORE, pin_session
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    try:
        spark.conf.set(key, "77")
        pin_session(spark)
        assert spark.conf.get(key) == "77"
    finally:
        spark.conf.unset(key)
        pin_session(spark)
    assert spark.conf.get(key) == str(LISTING_TASKS_A_CORE * spark.sparkContext.defaultParallelism)


def _consent_of(spark, accounts):
    rows = [(i, a, "2024", "05", f"{1 + i % 3:02d}") for i, a in enumerate(accounts)]
    df = spark.createDataFrame(rows, "consent_id int, account_hashid string, year string, month string, day string")
    return tables.consent_rows(df.withColumn("created_at", F.expr("timestamp'2024-05-01 23:59:59.123456' + make_interval(0, 0, 0, consent_id)")))


@pytest.mark.parametrize("through_table", [True, False])
def test_consent_folders_on_a_local_disk_start_no_processes(spark, tmp_dir, through_table):
    # Hadoop's local file system starts a chmod for every folder and file that it makes, and writes a .crc beside each file
    consent, root = fx.consent(fx.read_table(spark, SF, "events")), f"{tmp_dir}/consent"
    assert (tables.load_consent(consent, _name("consent"), root) if through_table else tables.write_consent(consent, root)) == consent.count()
    names = [n for _, _, found in os.walk(root) for n in found]
    assert not [n for n in names if n.startswith(".part-")] and "_SUCCESS" in names
    assert not [d for d in os.listdir(root) if d.startswith("_staging")]
    back, want = spark.read.schema(S.CONSENT).parquet(root), tables.consent_rows(consent)
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0


def test_consent_folders_are_those_of_spark(spark, tmp_dir):
    odd = [None, "", "a b", "ä/ö", "x=1", "50%", "{b}[c]^", "'q'\"", "c:\\d", "*?#", "\t\x01\x7f", *map(chr, range(1, 256))]
    consent = _consent_of(spark, odd)
    tables.write_consent(consent, f"{tmp_dir}/arrow")
    tables.write_consent(consent, f"{tmp_dir}/spark", mode="error")         # any other mode: Spark's writer
    folders = [{os.path.relpath(d, root) for d, _, names in os.walk(root) if any(n.startswith("part-") for n in names)}
               for root in (f"{tmp_dir}/arrow", f"{tmp_dir}/spark")]
    assert folders[0] == folders[1]
    name = _name("consent")
    assert tables.load_consent(consent, name, f"{tmp_dir}/table") == len(odd)
    back = spark.read.schema(S.CONSENT).parquet(f"{tmp_dir}/spark")
    for got in (spark.table(name), spark.read.schema(S.CONSENT).parquet(f"{tmp_dir}/arrow")):
        assert got.exceptAll(back).count() == 0 and back.exceptAll(got).count() == 0
    assert spark.table(name).where("account_hashid = '50%'").count() == 1
    one = [os.path.join(d, n) for root in ("arrow", "spark") for d, _, names in os.walk(f"{tmp_dir}/{root}") for n in names if n.startswith("part-")]
    import pyarrow.parquet as pq
    assert len({str([(c.name, c.physical_type) for c in pq.ParquetFile(p).schema]) for p in one}) == 1


def test_consent_is_appended_to_folders_that_are_there(spark, tmp_dir):
    name = _name("consent")
    for accounts, rows in ((["a", "b"] * 3, 6), (["b", "c"] * 3, 12), (["a"], 13)):
        assert tables.load_consent(_consent_of(spark, accounts), name, f"{tmp_dir}/c") == len(accounts)
        assert spark.table(name).count() == rows
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 9
    assert tables.recover_partitions(spark, name) == (0, 0)


def test_a_folder_larger_than_a_row_group(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(tables.folders, "ROW_GROUP_BYTES", 4000)
    consent = tables.consent_rows(spark.range(50_000).select(
        F.col("id").cast("int").alias("consent_id"), F.lit("hot").alias("account_hashid"), F.lit("2024").alias("year"),
        F.lit("05").alias("month"), F.lit("01").alias("day"), F.lit("c").alias("consent_hashid")))
    assert tables.write_consent(consent, f"{tmp_dir}/c") == 50_000
    back = spark.read.schema(S.CONSENT).parquet(f"{tmp_dir}/c")
    assert back.exceptAll(consent).count() == 0 and back.count() == 50_000


def test_a_failed_consent_load_leaves_nothing(spark, tmp_dir):
    name = _name("consent")
    tables.load_consent(_consent_of(spark, ["a", "b"]), name, f"{tmp_dir}/c")
    with pytest.raises(Exception, match="too long"):        # one task fails when it has written other folders
        tables.load_consent(_consent_of(spark, [*(f"n{i}" for i in range(50)), "x" * 300]), name, f"{tmp_dir}/c")
    assert sorted(os.listdir(f"{tmp_dir}/c")) == ["_SUCCESS", "account_hashid=a", "account_hashid=b"]
    assert spark.table(name).count() == 2


def test_a_consent_table_with_other_columns_keeps_sparks_insert(spark, tmp_dir):
    name = _name("consent")
    wide = S.CONSENT.fields[0].__class__("consent_id", S.T.LongType())
    tables.create_table_if_absent(spark, name, S.T.StructType([wide, *S.CONSENT.fields[1:]]), f"{tmp_dir}/c", S.CONSENT_PARTITION_COLUMNS)
    assert tables.load_consent(_consent_of(spark, ["a", "b"]), name, f"{tmp_dir}/c") == 2
    assert spark.table(name).schema["consent_id"].dataType == S.T.LongType() and spark.table(name).count() == 2


def test_scans_of_many_small_files_take_few_tasks(spark):
    from ledgerloom.plans import registry
    from ledgerloom.session import pack_small_files, pin_session
    cost, size = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"
    pin_session(spark)
    before = spark.conf.get(cost)
    spark.conf.set(size, "16m")
    try:
        df = registry.QUERIES["write_consent_partitioned"](spark, SF)
        folders = df.select(*S.CONSENT_PARTITION_COLUMNS).distinct().count()
        assert folders > 200 and df.rdd.getNumPartitions() <= max(4, folders // 50)
        pin_session(spark)                  # the next query
        assert spark.conf.get(cost) == before
        spark.conf.set(cost, "64k")         # a number that the user has set
        pack_small_files(spark)
        pin_session(spark)
        assert spark.conf.get(cost) == "64k"
    finally:
        spark.conf.unset(cost)
        spark.conf.unset(size)
        pin_session(spark)
