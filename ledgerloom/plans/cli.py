"""Command line for the scheduled loads: ``python -m ledgerloom.plans.cli <job> ...``.

Jobs:

* ``load-report``   day's report CSVs -> backup fact table (append)
* ``load-detail``   day's ``backup_jobs_report_*`` CSVs -> detail table (append/overwrite)
* ``load-logs``     backup ``.log`` files -> backup fact table (append)
* ``flatten-json``  page-view JSON -> flat Parquet (append), corrupt lines counted
* ``checks``        total, rows by component and a sample of a loaded table
* ``views``         create or replace the four reporting views over catalog tables

Run under ``spark-submit``; the session comes from the submit configuration
(``spark.checkpoint.dir`` must name shared storage on a cluster). A failure
exits non-zero instead of being logged and swallowed.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys

from ..session import get_spark
from . import jobs


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerloom")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("load-report", "load-detail"):
        s = sub.add_parser(name)
        s.add_argument("--base", required=True, help="root holding YYYY/MM/DD/ folders")
        s.add_argument("--table", required=True)
        s.add_argument("--location", required=True)
        s.add_argument("--date", help="processing day, YYYY-MM-DD (default: today, UTC)")
        if name == "load-detail":
            s.add_argument("--overwrite", action="store_true")
    s = sub.add_parser("load-logs")
    s.add_argument("--logs", required=True, help="folder searched recursively for .log files")
    s.add_argument("--table", required=True)
    s.add_argument("--location", required=True)
    s.add_argument("--date")
    s = sub.add_parser("flatten-json")
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--corrupt-output")
    s.add_argument("--recursive", action="store_true")
    s = sub.add_parser("checks")
    s.add_argument("--table", required=True)
    s = sub.add_parser("views")
    s.add_argument("--consent-table", required=True)
    s.add_argument("--pageview-table", required=True)
    s.add_argument("--prefix", default="v_")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = get_spark(app_name=f"ledgerloom-{args.job}")
    if args.job == "load-report":
        res = jobs.load_report_fact(spark, args.base, args.table, args.location, args.date)
    elif args.job == "load-detail":
        res = jobs.load_report_detail(spark, args.base, args.table, args.location, args.date,
                                      overwrite=args.overwrite)
    elif args.job == "load-logs":
        res = jobs.load_log_fact(spark, args.logs, args.table, args.location, args.date)
    elif args.job == "flatten-json":
        res = jobs.flatten_pageviews(spark, args.input, args.output, args.recursive,
                                     args.corrupt_output)
    elif args.job == "views":
        from ..sinks import tables
        out = {"views": tables.create_persistent_views(spark, args.consent_table,
                                                        args.pageview_table, args.prefix)}
        print(json.dumps(out))
        return out
    else:
        checks = jobs.load_checks(spark, args.table)
        out = {name: [r.asDict() for r in df.collect()] for name, df in checks.items()}
        print(json.dumps(out, default=str))
        return out
    out = {"table": res.table, "rows_written": res.rows_written, "corrupt_rows": res.corrupt_rows}
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    try:
        main()
    except jobs.NoInputError as e:
        logging.error("%s", e)
        sys.exit(2)
