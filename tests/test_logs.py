"""Log sessions: the chunked formulation against logs composed from known sessions."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom import fixtures as fx
from ledgerloom.operators import logs
from log_scripts import FILES as P, scripts


def _spark_sessions(spark, rows, chunk_lines):
    df = spark.createDataFrame(rows, "file_path string, line_no long, value string")
    df = df.withColumn("chunk", F.floor(F.col("line_no") / chunk_lines).cast("long"))
    got = logs.sessions(df).collect()
    return sorted(((r.file_path, r.close_line,
                    r.report_period_start and r.report_period_start.isoformat(),
                    r.report_period_end and r.report_period_end.isoformat(),
                    r.hostname, r.backup_type, r.backup_name, r.status, r.backup_size_bytes)
                   for r in got), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sessions_of_composed_logs(spark, seed):
    rows, expected = scripts(seed, 40)
    assert len(expected) > 40
    for chunk_lines in (1, 2, 5, 1 << 20):
        assert _spark_sessions(spark, rows, chunk_lines) == expected, chunk_lines


def test_rules_on_hand_written_file(spark):
    d = "2024-05-01T00:00:00+00:00 "
    rows = [(f"h.log", i, t) for i, t in enumerate([
        " SAVE DATA finished successfully",            # undated finish: closes nothing
        " state of service: n, hostX:1, v",            # carries on
        d + P + "COMPLETE_DATA_BACKUP_0_0",
        " progress of service: s, volume: 1, 100% 10/10",
        " progress of service: s, volume: 2, 100% 20/20",  # last wins, not summed
        " SAVE DATA finished successfully",            # closes (date in force), no end date
        d + P + "y_0_1 SAVE DATA finished successfully",  # _0_1: only the date counts
        " " + P + "z_databackup_differential_0_2",      # date in force from the line above
        d + "SAVE DATA finished with error: [447] backup could not be completed",
        d + "state of service: n, tail:1, v",          # unfinished tail: dropped
    ])]
    assert _spark_sessions(spark, rows, 3) == [
        ("h.log", 5, "2024-05-01", None, "hostX", "full", "COMPLETE_DATA_BACKUP", "successful", 20.0),
        ("h.log", 8, "2024-05-01", "2024-05-01", None, "differential", "2024_05_01_07-30", "failed", 0.0)]


def test_undated_differential_drops_whole_file(spark):
    d = "2024-05-01T00:00:00+00:00 "
    rows = [("bad.log", 0, d + "SAVE DATA finished successfully"),
            ("bad.log", 1, " " + P + "a_databackup_differential_0_0"),
            ("good.log", 0, d + "SAVE DATA finished successfully")]
    assert _spark_sessions(spark, rows, 1) == [
        ("good.log", 0, "2024-05-01", "2024-05-01", None, "full", None, "successful", 0.0)]
    lines = spark.createDataFrame(rows, "file_path string, line_no long, value string").withColumn("chunk", F.lit(0))
    skipped = logs.skipped_files(logs.stored_pieces(lines)).collect()
    assert [tuple(r) for r in skipped] == [("bad.log", "differential backup without a date")]


def test_fixture_session_mix(spark):
    ev = fx.read_table(spark, "/root/testdata/sf0.01", "events")
    s = logs.sessions(fx.log_lines(ev, chunk_lines=7))
    mix = {(r.backup_type, r.status): r.sessions
           for r in logs.sessions_by_status(s).collect()}
    assert mix == {("full", "successful"): 793, ("full", "failed"): 385,
                   ("differential", "successful"): 158, ("differential", "failed"): 86}
    assert s.select("file_path").distinct().count() == 463
    assert s.where("report_period_start = report_period_end").count() == 1137
    assert s.where("report_period_end IS NULL").count() == 285


def test_pieces_read_lines_once_and_shuffle_no_text(spark, tmp_dir):
    from ledgerloom.sources import readers
    for f in range(3):
        with open(f"{tmp_dir}/h{f}.log", "w") as out:
            out.write(("2024-05-01T00:00:00+00:00 SAVE DATA finished successfully\n" + "nothing\n" * 9) * 5)
    pieces = logs.session_pieces(readers.read_backup_log(spark, tmp_dir))
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    shuffled = re.search(r"Exchange\s*\nInput \[\d+\]: (.*)", pieces._jdf.queryExecution().explainString(mode)).group(1)
    assert "line_date#" in shuffled and "value#" not in shuffled
    assert logs.line_facts(readers.read_backup_log(spark, tmp_dir)).count() == 15
    assert len(logs.sessions(readers.read_backup_log(spark, tmp_dir)).collect()) == 15


def test_unicode_word_characters_as_in_python(spark):
    d = "2024-05-01T00:00:00+00:00 "
    rows = [("u.log", 0, d + P + "databäckup_0_1"),              # ignored: name ends in _0_1
            ("u.log", 1, " state of service: n, hôst-é:1, v"),
            ("u.log", 2, " SAVE DATA finished successfully")]
    got = _spark_sessions(spark, rows, 1 << 20)
    assert len(got) == 1 and got[0][4] == "hôst-é" and got[0][6] is None


from hypothesis import given, settings, strategies as st  # noqa: E402

@settings(max_examples=15, deadline=None)
@given(seed=st.integers(0, 1 << 30), chunk=st.sampled_from([1, 2, 3, 7]))
def test_sessions_of_composed_logs_hypothesis(spark, seed, chunk):
    rows, expected = scripts(seed, 3)
    if rows:
        assert _spark_sessions(spark, rows, chunk) == expected
