"""Report normalisation rules (R1-R7, P1/P2) on hand-written edge rows."""

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.functions import (extract_host, map_component, map_status, parse_period_date,
                                  size_bytes, size_gib)
from ledgerloom.operators import report


def _one(spark, col_fn, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(col_fn(F.col("x"))).collect()]


def test_map_status(spark):
    assert _one(spark, map_status, ["COMPLETED", "completed", "FAILED", None]) == \
        ["SUCCESSFUL", "completed", "FAILED", None]


def test_map_component_null_is_rds(spark):
    got = _one(spark, map_component, ["arn:aws:ec2:r::image/ami-0abc", "arn:rds:snapshot:x",
                                      None, "x image/ami-"])
    # the last one holds the marker but not the pattern: '' upper-cased
    assert got == ["AMI", "RDS", "RDS", ""]


def test_extract_host(spark):
    got = _one(spark, extract_host, [
        "arn:aws:ec2:r:1:instance/i-0abc12", "arn:aws:ec2:r:1:instance/i-XYZ",
        "arn:aws:rds:r:1:db:mydb", "arn:aws:rds:r:1:cluster-db:c1/x",
        "arn:aws:dynamodb:r:1:table/t", "arn:aws:s3:::bucket/key", None])
    # 'dynamodb:' contains 'db:' too, so it takes the database branch
    assert got == ["i-0abc12", "", "mydb", "c1", "r:1:table", "arn:aws:s3:::bucket/key", None]


def test_periods_and_sizes(spark):
    assert _one(spark, parse_period_date, ["2025-05-13T00:00:00Z", "n/a", "2025-13-01", None]) == \
        [__import__("datetime").date(2025, 5, 13), None, None, None]
    assert _one(spark, size_bytes, ["1073741824", "unknown", "", None]) == \
        [1073741824.0, None, None, None]
    assert _one(spark, size_gib, ["1073741824", "5368709120", "1610612736", "x"]) == \
        [1.0, 5.0, 1.5, None]


def _raw(spark, drop=None):
    cols = [c for c in S.REQUIRED_REPORT_COLUMNS if c != drop]
    row = {S.COL_JOB_STATUS: "COMPLETED", S.COL_RESOURCE_TYPE: "EC2",
           S.COL_PERIOD_START: "2025-05-13T00:00:00Z", S.COL_PERIOD_END: "2025-05-13T23:59:59Z",
           S.COL_RESOURCE_ARN: "arn:aws:ec2:r:1:instance/i-0abc",
           S.COL_SIZE_BYTES: "2147483648", S.COL_RECOVERY_POINT_ARN: "arn:aws:ec2:r::image/ami-1"}
    schema = ", ".join(f"`{c}` string" for c in cols)
    return spark.createDataFrame([tuple(row[c] for c in cols)], schema)


@pytest.mark.parametrize("missing", S.REQUIRED_REPORT_COLUMNS)
def test_missing_required_column_rejects_batch(spark, missing):
    with pytest.raises(report.MissingColumnsError):
        report.backup_fact_report(_raw(spark, drop=missing))


def test_fact_row(spark):
    r = report.backup_fact_report(_raw(spark), as_of="2025-05-14").collect()[0].asDict()
    assert r["hostname"] == r["backup_name"] == "i-0abc"
    assert (r["component_type"], r["status"], r["backup_type"]) == ("AMI", "SUCCESSFUL", "COMPLETE")
    assert r["backup_size_bytes"] == 2147483648.0
    assert str(r["load_date"]) == "2025-05-14"
    assert report.backup_fact_report(_raw(spark)).columns == S.BACKUP_FACT_COLUMNS


def test_project_available_keeps_present_columns(spark):
    df = _raw(spark, drop=S.COL_SIZE_BYTES)
    out = report.project_available(df)
    assert out.columns == [c for c in S.DETAIL_REPORT_COLUMNS if c != S.COL_SIZE_BYTES]


def test_detail_row(spark):
    r = report.report_detail(_raw(spark), as_of="2025-05-14",
                             as_of_ts="2025-05-14 06:00:00").collect()[0].asDict()
    assert r["size_gb"] == 2.0 and r["backup_type"] == "full" and r["resource_id"] == "i-0abc"
    assert str(r["file_last_modified"]) == "2025-05-14 06:00:00"


# ---------------------------------------------------------------- property test
import re  # noqa: E402

from hypothesis import given, settings, strategies as st  # noqa: E402

_FRAGMENTS = ["arn:aws:", "ec2:", "rds:", "instance/", "i-", "I-", "0a9f", "XYZ", "db:", "cluster-",
              "image/", "ami-", "AMI-", "snapshot:", "/", ":", "x", "dynamodb:", "table/", ""]
_texts = st.one_of(st.none(), st.lists(st.sampled_from(_FRAGMENTS), max_size=6).map("".join))


def _host_model(s):
    if s is None:
        return None
    if "instance/" in s:
        m = re.search(r"instance/(i-[a-f0-9]+)", s)
        return m.group(1) if m else ""
    if "db:" in s:
        m = re.search(r"db:([^/]+)", s)
        return m.group(1) if m else ""
    return s


def _component_model(s):
    if s is not None and "image/ami-" in s:
        m = re.search(r"image/(ami)-[^/]+", s)
        return m.group(1).upper() if m else ""
    return "RDS"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(_texts, _texts, st.sampled_from(["COMPLETED", "FAILED", "completed", None])),
                min_size=1, max_size=40))
def test_rules_match_python_statement(spark, rows):
    df = spark.createDataFrame(rows, "arn string, rp string, status string")
    got = df.select(extract_host("arn"), map_component("rp"), map_status("status")).collect()
    want = [(_host_model(a), _component_model(r), "SUCCESSFUL" if s == "COMPLETED" else s)
            for a, r, s in rows]
    assert [tuple(g) for g in got] == want
