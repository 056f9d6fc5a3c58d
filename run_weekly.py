"""Command for one weekly run, for spark-submit or plain Python.

    spark-submit run_weekly.py --root <landing> --target <table> --out <reports> --audit <log>
"""

from __future__ import annotations

import argparse
from datetime import date

from slotmill import fixed
from slotmill.plans.report import main_spec
from slotmill.plans.weekly import weekly_run
from slotmill.session import build_session


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Load the newest schedule file and write its reports.")
    parser.add_argument("--root", required=True, help="landing folder with one sub-folder per day")
    parser.add_argument("--target", required=True, help="folder of the loaded table")
    parser.add_argument("--out", required=True, help="folder of the report datasets")
    parser.add_argument("--audit", required=True, help="folder of the run records")
    parser.add_argument("--import-date", type=date.fromisoformat, default=None, help="default: today")
    parser.add_argument("--year-prefix", help="default: any folder whose name is a date")
    parser.add_argument("--file-prefix", help="default: F and six digits")
    parser.add_argument("--date-pattern", default=fixed.FILE_DATE_PATTERN)
    parser.add_argument("--main-sql", help="file with the main report's query over the view prelog")
    parser.add_argument("--strict", action="store_true", help="stop on a count mismatch before replacing rows")
    parser.add_argument("--list-faults", action="store_true", help="write all bad report cells as datasets before the run fails")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> str:
    args = arguments(argv)
    main_sql = open(args.main_sql, encoding="utf-8").read() if args.main_sql else None
    outcome = weekly_run(
        build_session("slotmill-weekly"),
        root=args.root,
        target=args.target,
        out=args.out,
        audit=args.audit,
        import_date=args.import_date or date.today(),
        specs=[main_spec(main_sql)] if main_sql else None,
        year_prefix=args.year_prefix,
        file_prefix=args.file_prefix,
        date_pattern=args.date_pattern,
        strict=args.strict,
        list_faults=args.list_faults,
    )
    print(outcome)
    return outcome


if __name__ == "__main__":
    main()
