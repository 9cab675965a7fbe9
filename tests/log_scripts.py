"""Backup logs composed from known sessions.

A script starts from the sessions that a file shall hold, and renders each into lines whose
last word decides a field, among noise that must not: earlier values, dropped and ignored
lines, other text. Nothing here reads a log line.
"""

from __future__ import annotations

import random

FILES = "/usr/sap/HDB/SYS/global/hdb/backint/DB_HDB/"
FINISH = {"ok": ("SAVE DATA finished successfully", "successful", True),
          "error": ("SAVE DATA finished with error: [447] backup could not be completed", "failed", True),
          "other": ("SAVE DATA finished with error: [999] other", "failed", False)}


def day(rng: random.Random) -> str:
    return f"2024-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}"


def on(date: str | None, text: str) -> str:
    return f"{date}T10:00:00+00:00 {text}" if date else f" {text}"


def noise(rng: random.Random) -> list[str]:
    """Lines without any effect."""
    return [rng.choice([on(None, "some other text"), "", on(day(rng), "LOGBCKUP SAVE DATA finished successfully"),
                        on(None, "progress of service: nameserver, volume: 1, 50% 40/80"),
                        on(None, FILES + "x_0_1 SAVE DATA finished successfully"),
                        on(None, "command: BACKUP DATA FOR HDB USING DIFFERENTIAL")])
            for _ in range(rng.randrange(0, 3))]


def host_line(host: str) -> str:
    return f"state of service: nameserver, {host}:30001, volume: 1"


def size_line(size: int) -> str:
    return f"progress of service: indexserver, volume: 3, 100% {size}/{size}"


def session(rng: random.Random) -> tuple[list[str], tuple]:
    """Lines of one whole session and what it shall yield, but for file and close line."""
    lines = []
    if rng.random() < 0.5:                          # values that later lines replace
        lines += [on(day(rng), "opened"), on(None, host_line("early-host")), on(None, size_line(7)),
                  on(day(rng), FILES + "early_0_0")]
    kind = rng.choice(["full", "marked", "commanded", None])
    named = None
    if kind == "full" or (kind is None and lines):
        lines.append(on(rng.choice([None, day(rng)]), FILES + "COMPLETE_DATA_BACKUP_0_0"))
        named = ("full", "COMPLETE_DATA_BACKUP")
    elif kind:
        date = day(rng)
        if rng.random() < 0.5:
            lines.append(on(date, "a date for the next line"))
            date_here = None
        else:
            date_here = date
        text = FILES + ("a_databackup_differential_0_2" if kind == "marked"
                        else "full_0_3 command: BACKUP DATA FOR HDB USING DIFFERENTIAL")
        lines.append(on(date_here, text))
        named = ("differential", date.replace("-", "_") + "_07-30")
    host = rng.choice(["hostA", "db-host-2", "hôst-é"])
    size = rng.choice([10, 4096, 123456789])
    deciding = [on(None, host_line(host)), on(None, size_line(size))]
    rng.shuffle(deciding)
    for line in deciding:
        lines += [*noise(rng), line]
    text, status, tells = FINISH[rng.choice(list(FINISH))]
    start = day(rng)
    dated = rng.random() < 0.5
    if not dated:                                   # the date in force comes from a line before
        lines.append(on(start, rng.choice(["a date", FILES + "y_0_1 SAVE DATA finished successfully"])))
        lines += noise(rng)
    lines.append(on(start if dated else None, text))
    return lines, (start, start if dated and tells else None, host, *(named or ("full", None)), status, float(size))


def script(rng: random.Random) -> tuple[list[str], list[tuple]]:
    """Lines of one file, and (index of the closing line, session) of each of its sessions."""
    lines, found = noise(rng), []
    for _ in range(rng.randrange(0, 5)):
        some, expected = session(rng)
        lines += some
        found.append((len(lines) - 1, expected))
        lines += noise(rng)
    if rng.random() < 0.5:                          # unfinished
        lines += [on(day(rng), host_line("tail-host")), on(None, size_line(99))]
    if rng.random() < 0.1:                          # one line that voids the file, before any date
        lines.insert(0, on(None, FILES + "b_databackup_differential_0_0"))
        return lines, []
    return lines, found


def scripts(seed: int, n: int) -> tuple[list[tuple], list[tuple]]:
    """Rows (file, line number, text) of ``n`` files with gaps in their numbers, and the expected sessions."""
    rng = random.Random(seed)
    rows, expected = [], []
    for f in range(n):
        lines, found = script(rng)
        number, at = [], rng.randrange(0, 1000)
        for _ in lines:
            number.append(at)
            at += rng.randrange(1, 4)
        rows += [(f"f{f}.log", k, text) for k, text in zip(number, lines)]
        expected += [(f"f{f}.log", number[i], *x) for i, x in found]
    return rows, sorted(expected, key=repr)
