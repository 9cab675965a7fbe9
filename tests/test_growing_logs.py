"""Logs delivered part by part: the sessions of the whole log, whatever the cuts."""

import os
import random

import pytest

from ledgerloom.streaming import growing
from log_scripts import FILES as P, scripts

DATE = "2024-05-01T00:00:00+00:00 "


def _deliver(folder, name, part, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.{part}", "w", newline="") as out:
        out.writelines(line + "\n" for line in lines)


def _fields(rows):
    return sorted((tuple(r[c] if c not in ("report_period_start", "report_period_end") else r[c] and r[c].isoformat() for c in (
        "file_path", "report_period_start", "report_period_end", "hostname", "backup_type", "backup_name", "status",
        "backup_size_bytes")) for r in rows), key=repr)


def _named(rows):
    return [r.asDict() | {"file_path": r.file_path.rsplit("/", 1)[1]} for r in rows]


@pytest.mark.parametrize("seed, max_files", [(1, 10_000), (7, 3)])
def test_three_deliveries_give_the_sessions_of_the_whole_logs(spark, tmp_dir, seed, max_files):
    rows, expected = scripts(seed, 12)
    rng = random.Random(seed)
    by_file = {}
    for name, _, text in rows:
        by_file.setdefault(name, []).append(text)
    assert len(expected) > 10
    names = {name: f"f{i}.log" for i, name in enumerate(sorted(by_file))}
    parts = {}
    for name, lines in by_file.items():
        cuts = sorted(rng.sample(range(1, len(lines)), min(2, len(lines) - 1)))
        parts[name] = [lines[a:b] for a, b in zip([0, *cuts], [*cuts, len(lines)])]
    source, out = f"{tmp_dir}/logs", f"{tmp_dir}/out"
    for k in range(3):
        for name, cut in parts.items():
            if k < len(cut):
                _deliver(source, names[name], k, cut[k])
        growing.load_growing_logs(spark, source, out, f"{tmp_dir}/ckpt", max_files=max_files)
    got = _named(growing.sessions(spark, out).collect())
    want = [(names[e[0]], *e[2:]) for e in expected]
    assert _fields(got) == sorted(want, key=repr)
    growing.load_growing_logs(spark, source, out, f"{tmp_dir}/ckpt")        # nothing new
    assert growing.sessions(spark, out).count() == len(want)


def test_open_session_date_and_size_carry_over(spark, tmp_dir):
    source, out = f"{tmp_dir}/logs", f"{tmp_dir}/out"
    parts = [[DATE + "state of service: n, hostX:1, v", " progress of service: s, volume: 1, 100% 10/10"],
             ["nothing of interest"],
             [" " + P + "z_databackup_differential_0_2", " progress of service: s, volume: 1, 100% 20/20"],
             [" SAVE DATA finished successfully", " SAVE DATA finished successfully"]]
    for k, lines in enumerate(parts):
        _deliver(source, "a.log", k, lines)
        growing.load_growing_logs(spark, source, out, f"{tmp_dir}/ckpt")
        assert growing.sessions(spark, out).count() == (k == 3)
    assert _fields(_named(growing.sessions(spark, out).collect())) == [
        ("a.log", "2024-05-01", None, "hostX", "differential", "2024_05_01_07-30", "successful", 20.0)]
    assert growing.latest_state(spark, out).select("last_part").collect()[0][0] == 3


def test_dropped_logs_also_lose_the_sessions_of_earlier_parts(spark, tmp_dir):
    source, out = f"{tmp_dir}/logs", f"{tmp_dir}/out"
    good = [DATE + "SAVE DATA finished successfully"]
    for name in ("undated.log", "bytes.log", "gap.log", "fine.log"):
        _deliver(source, name, 0, good)
    growing.load_growing_logs(spark, source, out, f"{tmp_dir}/ckpt")
    assert growing.sessions(spark, out).count() == 4 and growing.dropped_logs(spark, out).count() == 0
    _deliver(source, "undated.log", 1, [" " + P + "a_databackup_differential_0_0"])
    with open(f"{source}/bytes.log.1", "wb") as f:
        f.write(b"\xff\xfe\n")
    _deliver(source, "gap.log", 2, good)
    _deliver(source, "fine.log", 1, good)
    growing.load_growing_logs(spark, source, out, f"{tmp_dir}/ckpt")
    assert {(r.file_path.rsplit("/", 1)[1], r.reason) for r in growing.dropped_logs(spark, out).collect()} == {
        ("undated.log", growing.UNDATED), ("bytes.log", growing.NOT_UTF8), ("gap.log", growing.OUT_OF_ORDER)}
    assert {r.file_path.rsplit("/", 1)[1] for r in growing.sessions(spark, out).collect()} == {"fine.log"}
    _deliver(source, "undated.log", 2, good)        # dropped stays dropped
    growing.load_growing_logs(spark, source, out, f"{tmp_dir}/ckpt")
    assert growing.sessions(spark, out).count() == 2


def test_a_batch_that_runs_again_replaces_its_output(spark, tmp_dir):
    """The checkpoint loses its last commit, as after a failure between the writes and the commit."""
    source, out, checkpoint = f"{tmp_dir}/logs", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    _deliver(source, "a.log", 0, [DATE + "SAVE DATA finished successfully", DATE + "state of service: n, h:1, v"])
    growing.load_growing_logs(spark, source, out, checkpoint)
    _deliver(source, "a.log", 1, [" SAVE DATA finished successfully"])
    growing.load_growing_logs(spark, source, out, checkpoint)
    before = _fields(_named(growing.sessions(spark, out).collect()))
    last = max((x for x in os.listdir(f"{checkpoint}/commits") if x.isdigit()), key=int)
    os.remove(f"{checkpoint}/commits/{last}")
    if os.path.exists(f"{checkpoint}/commits/.{last}.crc"):
        os.remove(f"{checkpoint}/commits/.{last}.crc")
    growing.load_growing_logs(spark, source, out, checkpoint)
    assert len(before) == 2 and _fields(_named(growing.sessions(spark, out).collect())) == before
