"""The scheduled loads end to end through the command line."""

import os

import pytest

from ledgerloom.plans import cli, jobs
from ledgerloom import schemas as S

HEADER = ",".join(S.REQUIRED_REPORT_COLUMNS)
ROW = ("COMPLETED,EC2,2025-05-13T00:00:00Z,2025-05-13T23:59:59Z,arn:aws:ec2:r:1:instance/i-0a,"
       "1073741824,arn:aws:ec2:r::image/ami-1")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_report_and_log_loads_share_one_table(spark, tmp_dir):
    _write(f"{tmp_dir}/reports/2025/05/13/r.csv", HEADER + "\n" + ROW + "\n" + ROW + "\n")
    _write(f"{tmp_dir}/logs/a/h.log",
           "2024-05-01T00:00:00+00:00 state of service: n, hostA:1, v\n"
           " SAVE DATA finished successfully\n")
    table, loc = "cli_fact", f"{tmp_dir}/fact"
    out = cli.main(["load-report", "--base", f"{tmp_dir}/reports", "--table", table,
                    "--location", loc, "--date", "2025-05-13"])
    assert out["rows_written"] == 2
    assert cli.main(["load-logs", "--logs", f"{tmp_dir}/logs", "--table", table,
                     "--location", loc, "--date", "2025-05-13"])["rows_written"] == 1
    checks = cli.main(["checks", "--table", table])
    assert checks["total"] == [{"records": 3}]
    assert sorted((r["component_type"], r["records"]) for r in checks["by_component"]) == \
        [("AMI", 2), ("HANA", 1)]
    with pytest.raises(jobs.NoInputError):
        cli.main(["load-report", "--base", f"{tmp_dir}/reports", "--table", table,
                  "--location", loc, "--date", "2025-05-14"])


def test_flatten_json(spark, tmp_dir):
    _write(f"{tmp_dir}/in/p.json", '{"account_hashid":"a","visitor_details":{"city":"c"}}\nnope\n')
    out = cli.main(["flatten-json", "--input", f"{tmp_dir}/in", "--output", f"{tmp_dir}/out"])
    assert (out["rows_written"], out["corrupt_rows"]) == (1, 1)
    assert spark.read.parquet(f"{tmp_dir}/out").collect()[0].city == "c"


def test_log_load_without_sessions_is_an_error(spark, tmp_dir):
    _write(f"{tmp_dir}/logs/h.log", " state of service: n, hostA:1, v\n SAVE DATA finished successfully\n")
    with pytest.raises(jobs.NoInputError):          # undated finish closes nothing
        cli.main(["load-logs", "--logs", f"{tmp_dir}/logs", "--table", "cli_empty",
                  "--location", f"{tmp_dir}/t"])
    with pytest.raises(jobs.NoInputError):
        cli.main(["load-logs", "--logs", f"{tmp_dir}/missing", "--table", "cli_empty",
                  "--location", f"{tmp_dir}/t"])


def test_detail_load_append_then_overwrite(spark, tmp_dir):
    header = ",".join(S.DETAIL_REPORT_COLUMNS)
    row = "2025-05-13T00:00:00Z,2025-05-13T23:59:59Z,COMPLETED,RDS,arn:aws:rds:r:1:db:main,2147483648"
    _write(f"{tmp_dir}/r/2025/05/13/backup_jobs_report_x/backup_job_report_1.csv",
           header + "\n" + row + "\n")
    args = ["load-detail", "--base", f"{tmp_dir}/r", "--table", "cli_detail",
            "--location", f"{tmp_dir}/detail", "--date", "2025-05-13"]
    assert cli.main(args)["rows_written"] == 1
    assert cli.main(args)["rows_written"] == 1
    assert spark.table("cli_detail").count() == 2                 # appends keep duplicates
    assert cli.main(args + ["--overwrite"])["rows_written"] == 1
    rows = spark.table("cli_detail").collect()
    assert len(rows) == 1 and rows[0].resource_id == "main" and rows[0].size_gb == 2.0
    assert rows[0].job_status == "SUCCESSFUL" and str(rows[0].load_date) == "2025-05-13"


def test_views_command(spark, tmp_dir):
    from ledgerloom import fixtures as fx
    ev = fx.read_table(spark, "/root/testdata/sf0.001", "events")
    fx.consent(ev).write.option("path", f"{tmp_dir}/c").saveAsTable("cli_consent")
    fx.pageview(ev).write.option("path", f"{tmp_dir}/p").saveAsTable("cli_pageview")
    out = cli.main(["views", "--consent-table", "cli_consent", "--pageview-table", "cli_pageview",
                    "--prefix", "cli_v_"])
    assert len(out["views"]) == 4
    assert spark.table("cli_v_page_visit_stats").count() > 0
