"""File sources: CSV options and selection, JSON schema/corrupt rows, log line order."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.plans import jobs
from ledgerloom.sources import files, readers

HEADER = ",".join(f'"{c}"' for c in S.REQUIRED_REPORT_COLUMNS)


def _write(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(text)


def _row(status="COMPLETED", arn="arn:aws:ec2:r:1:instance/i-0a", size="1024"):
    return (f'{status},EC2,2025-05-13T00:00:00Z,2025-05-13T23:59:59Z,{arn},{size},'
            f'arn:aws:ec2:r::image/ami-1')


def test_csv_quoted_multiline_and_doubled_quotes(spark, tmp_dir):
    body = HEADER + "\n" + 'COMPLETED,EC2,2025-05-13T00:00:00Z,2025-05-13T23:59:59Z,' \
        '"arn:aws:ec2:r:1:instance/i-0a\nsecond ""line""",1,x\n'
    _write(f"{tmp_dir}/a.csv", body)
    rows = readers.read_report_csv(spark, tmp_dir).collect()
    assert len(rows) == 1
    assert rows[0][S.COL_RESOURCE_ARN] == 'arn:aws:ec2:r:1:instance/i-0a\nsecond "line"'


def test_csv_with_other_column_order_fails(spark, tmp_dir):
    _write(f"{tmp_dir}/a.csv", HEADER + "\n" + _row() + "\n")
    cols = list(reversed(S.REQUIRED_REPORT_COLUMNS))
    _write(f"{tmp_dir}/b.csv", ",".join(cols) + "\n" + ",".join(["v"] * len(cols)) + "\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        readers.read_report_csv(spark, tmp_dir).collect()


def test_day_folder_and_file_selection(spark, tmp_dir):
    day = files.day_folder(tmp_dir, "2025-05-13")
    _write(f"{day}x/r1.CSV", HEADER + "\n" + _row(size="1") + "\n")
    _write(f"{day}r2.csv", HEADER + "\n" + _row(size="2") + "\n")
    _write(f"{day}empty.csv", "")
    _write(f"{day}notes.txt", "not,a,report\n1,2,3\n")
    _write(f"{files.day_folder(tmp_dir, '2025-05-14')}r3.csv", HEADER + "\n" + _row(size="3") + "\n")
    sizes = sorted(r.backup_size_bytes for r in
                   jobs.report_fact_frame(spark, tmp_dir, as_of="2025-05-13").collect())
    assert sizes == [1.0, 2.0]
    with pytest.raises(jobs.NoInputError):
        jobs.report_fact_frame(spark, tmp_dir, as_of="2025-06-01")
    _write(f"{files.day_folder(tmp_dir, '2025-06-02')}notes.txt", "no csv here\n")
    with pytest.raises(jobs.NoInputError):
        jobs.report_fact_frame(spark, tmp_dir, as_of="2025-06-02")


def test_report_folders_layout(spark, tmp_dir):
    day = files.day_folder(tmp_dir, "2025-05-13")
    _write(f"{day}Backup_Jobs_Report_1/backup_job_report_a.csv", HEADER + "\n" + _row(size="1") + "\n")
    _write(f"{day}Backup_Jobs_Report_1/other.csv", HEADER + "\n" + _row(size="2") + "\n")
    _write(f"{day}misc/backup_job_report_b.csv", HEADER + "\n" + _row(size="3") + "\n")
    rows = jobs.report_detail_frame(spark, tmp_dir, as_of="2025-05-13").collect()
    assert [r.size_gb for r in rows] == [0.0]


def test_unselected_files_are_never_opened(spark, tmp_dir):
    folder = f"{files.day_folder(tmp_dir, '2025-05-13')}backup_jobs_report_1"
    _write(f"{folder}/aaa_summary.csv", "x,y\n1,2\n")
    _write(f"{folder}/backup_job_report_0.csv", "")
    _write(f"{folder}/backup_job_report_1.csv", HEADER + "\n" + _row(size=str(2 << 30)) + "\n")
    rows = jobs.report_detail_frame(spark, tmp_dir, as_of="2025-05-13").collect()
    assert [r.size_gb for r in rows] == [2.0]


def test_overwrite_with_nothing_selected_keeps_the_table(spark, tmp_dir):
    folder = f"{files.day_folder(tmp_dir, '2025-05-13')}backup_jobs_report_1"
    _write(f"{folder}/backup_job_report_1.csv", HEADER + "\n" + _row() + "\n")
    args = (spark, tmp_dir, "kept_detail", f"{tmp_dir}/detail")
    assert jobs.load_report_detail(*args, as_of="2025-05-13", overwrite=True).rows_written == 1
    _write(f"{files.day_folder(tmp_dir, '2025-05-14')}backup_jobs_report_1/aaa_summary.csv", "x,y\n1,2\n")
    with pytest.raises(jobs.NoInputError):
        jobs.load_report_detail(*args, as_of="2025-05-14", overwrite=True)
    assert spark.table("kept_detail").count() == 1


def test_listing_is_metadata_only(spark, tmp_dir):
    _write(f"{tmp_dir}/a/1.csv", "x\n1\n")
    _write(f"{tmp_dir}/b/2.CSV", "x\n1\n2\n")
    _write(f"{tmp_dir}/b/3.txt", "x\n")
    listing = files.list_files(spark, tmp_dir, glob=files.CSV_FILE_GLOB)
    assert sorted(r.file_name for r in listing.collect()) == ["1.csv", "2.CSV"]
    assert "content" not in str(listing._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1])
    newest = files.files_newest_first(listing).collect()
    assert newest[0].file_modification_time >= newest[-1].file_modification_time
    assert files.list_files(spark, f"{tmp_dir}/missing").count() == 0


JSON_OK = ('{"account_hashid":"a1","session_hashid":"s1","consent_hashid":"c1","page_url":"/p",'
           '"timestamp":"2024-01-02T03:04:05Z","visitor_details":{"ip_country":"IN","city":"X"}}')
JSON_NO_STRUCT = '{"account_hashid":"a2","page_url":"/q","timestamp":"bad"}'


def test_json_schema_missing_struct_and_corrupt_lines(spark, tmp_dir):
    _write(f"{tmp_dir}/in/p.json", "\n".join([JSON_OK, JSON_NO_STRUCT, "{not json",
                                               JSON_OK + " " + JSON_NO_STRUCT]) + "\n")
    _write(f"{tmp_dir}/in/plain/q.json", JSON_OK + "\n")
    ok, bad = readers.split_corrupt(readers.read_pageview_json(spark, f"{tmp_dir}/in"))
    flat = readers.flatten_pageview(ok)
    rows = sorted(flat.collect(), key=lambda r: r.account_hashid)
    # two objects on one line: only the first is kept; plain subfolder not read
    assert [r.account_hashid for r in rows] == ["a1", "a1", "a2"]
    assert rows[2].city is None and rows[2].ip_country is None
    assert rows[0].ip_country == "IN" and rows[0].device_type is None
    assert bad.count() == 1
    assert bad.collect()[0].loaded is False
    ok_rec, _ = readers.split_corrupt(readers.read_pageview_json(spark, f"{tmp_dir}/in", recursive=True))
    assert ok_rec.count() == 4
    typed = readers.typed_pageview(flat).orderBy("account_hashid").collect()
    assert str(typed[0].timestamp) == "2024-01-02 03:04:05"
    assert typed[-1].timestamp is None and (typed[0].year, typed[0].month, typed[0].day) == ("2024", "01", "02")


def test_json_arrays_and_half_good_records(spark, tmp_dir):
    half = '{"account_hashid":"half","page_url":"/p","visitor_details":"oops"}'
    _write(f"{tmp_dir}/in/p.json", "\n".join([f"[{JSON_OK},{JSON_NO_STRUCT}]", " [ ]", half, "[1, 2", JSON_OK]) + "\n")
    ok, bad = readers.split_corrupt(readers.read_pageview_json(spark, f"{tmp_dir}/in"))
    rows = sorted((r.account_hashid, r.page_url, r.city) for r in readers.flatten_pageview(ok).collect())
    assert rows == [("a1", "/p", "X"), ("a1", "/p", "X"), ("a2", "/q", None), ("half", "/p", None)]
    assert sorted((r.record, r.loaded) for r in bad.collect()) == [("[1, 2", False), (half, True)]


def test_flatten_job_counts_corrupt_lines(spark, tmp_dir):
    _write(f"{tmp_dir}/in/p.json", "\n".join([JSON_OK, "{oops", JSON_NO_STRUCT]) + "\n")
    res = jobs.flatten_pageviews(spark, f"{tmp_dir}/in", f"{tmp_dir}/out",
                                 corrupt_path=f"{tmp_dir}/bad")
    assert (res.rows_written, res.corrupt_rows) == (2, 1)
    assert spark.read.parquet(f"{tmp_dir}/out").columns == S.PAGEVIEW_FLAT_COLUMNS
    assert spark.read.parquet(f"{tmp_dir}/bad").count() == 1
    jobs.flatten_pageviews(spark, f"{tmp_dir}/in", f"{tmp_dir}/out2")
    assert spark.read.parquet(f"{tmp_dir}/out2_corrupt").collect()[0].record == "{oops"


def test_log_line_order_across_many_splits(spark, tmp_dir):
    n = 3000
    _write(f"{tmp_dir}/logs/a.log", "".join(f"line {i:05d}\n" for i in range(n)))
    _write(f"{tmp_dir}/logs/sub/b.log", "".join(f"other {i:05d}\n" for i in range(n // 2)))
    _write(f"{tmp_dir}/logs/c.txt", "ignored\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        lines = readers.read_backup_log(spark, f"{tmp_dir}/logs")
        assert lines.select("chunk").distinct().count() > 10
        got = readers.number_lines(lines).select(
            F.element_at(F.split("file_path", "/"), -1).alias("f"), "line_number", "value").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    by_file = {}
    for r in got:
        by_file.setdefault(r.f, []).append(r)
    assert sorted(by_file) == ["a.log", "b.log"]
    for f, rows in by_file.items():
        rows.sort(key=lambda r: r.line_number)
        assert [r.line_number for r in rows] == list(range(1, len(rows) + 1))
        assert [int(r.value.split()[1]) for r in rows] == list(range(len(rows)))


def test_line_with_very_many_parts(spark, tmp_dir):
    d = "2024-05-01T00:00:00+00:00 "
    _write(f"{tmp_dir}/logs/a.log", "\x0c".join(["x"] * 70_000) + "\n" + d + "SAVE DATA finished successfully\n")
    lines = readers.read_backup_log(spark, f"{tmp_dir}/logs")
    assert readers.number_lines(lines).agg(F.max("line_number")).first()[0] == 70_001
    assert jobs.log_fact_frame(spark, f"{tmp_dir}/logs").count() == 1


def test_log_job_from_files_with_small_splits(spark, tmp_dir):
    d = "2024-05-01T00:00:00+00:00 "
    text = "".join([
        d + "state of service: n, hostA:1, v\n",
        " progress of service: s, volume: 1, 100% 10/10\n" * 200,
        " SAVE DATA finished successfully\n",
        " state of service: n, hostB:1, v\n" * 200,
        d + "SAVE DATA finished with error: [447] backup could not be completed\n",
    ])
    _write(f"{tmp_dir}/logs/h.log", text)
    with open(f"{tmp_dir}/logs/bad.log", "wb") as f:  # not UTF-8: the file yields nothing
        f.write((d + "x\n").encode() + b"\xff\xfe broken\n"
                + (d + "SAVE DATA finished successfully\n").encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        fact, skipped = jobs.log_frames(spark, f"{tmp_dir}/logs", as_of="2024-05-02")
        rows = fact.collect()
        assert [(r.file_path.split("/")[-1], r.reason) for r in skipped.collect()] == [("bad.log", "not UTF-8")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    rows = sorted(rows, key=lambda r: r.hostname)
    assert [(r.hostname, r.status, r.backup_size_bytes) for r in rows] == \
        [("hostA", "successful", 10.0), ("hostB", "failed", 0.0)]
    assert str(rows[1].report_period_end) == "2024-05-01"


def test_log_line_order_with_small_files_packed_together(spark, tmp_dir):
    for f in range(40):
        _write(f"{tmp_dir}/logs/d{f % 4}/f{f:02d}.log", "".join(f"{f} {i}\n" for i in range(7 + f)))
    lines = readers.read_backup_log(spark, f"{tmp_dir}/logs")
    assert lines.rdd.getNumPartitions() < 40            # several files share a partition
    got = readers.number_lines(lines).collect()
    by_file = {}
    for r in got:
        by_file.setdefault(r.file_path, []).append(r)
    assert len(by_file) == 40
    for rows in by_file.values():
        rows.sort(key=lambda r: r.line_number)
        assert [int(r.value.split()[1]) for r in rows] == list(range(len(rows)))
        assert [r.line_number for r in rows] == list(range(1, len(rows) + 1))


def test_flatten_refuses_output_inside_recursive_input(spark, tmp_dir):
    _write(f"{tmp_dir}/in/p.json", JSON_OK + "\n")
    with pytest.raises(ValueError):
        jobs.flatten_pageviews(spark, f"{tmp_dir}/in", f"{tmp_dir}/in/processed", recursive=True)


def test_log_lines_split_like_python_splitlines(spark, tmp_dir):
    from ledgerloom.operators import logs
    d = "2024-05-01T00:00:00+00:00 "
    text = (d + "state of service: n, hostA:1, v\x0c SAVE DATA finished successfully\n"
            + d + "x  LOGBCKUP\x0b state of service: n, hostB:1, v\x85"
            + d + "SAVE DATA finished with error: [447] backup could not be completed\n")
    _write(f"{tmp_dir}/logs/u.log", text)
    lines = readers.read_backup_log(spark, f"{tmp_dir}/logs")
    assert lines.count() == len(text.splitlines())
    got = sorted((r.hostname, r.status, r.report_period_end and str(r.report_period_end))
                 for r in logs.sessions(lines).collect())
    assert got == [("hostA", "successful", None), ("hostB", "failed", "2024-05-01")]
