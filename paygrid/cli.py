"""Command line for scheduled runs (``spark-submit paygrid/cli.py ...`` or
``python -m paygrid ...``).

    python -m paygrid --base hr.pay --dim hr.positions --ext market.pct \\
        --vac market.vacancies --target s3://bucket/features --log s3://bucket/run_log

Sources are catalog tables or parquet paths; ``--testdata DIR`` derives them
from the TPC-H-like test tables instead.  Prints one JSON line with the run's
outcome.
"""

from __future__ import annotations

import argparse
import json
import sys

from .plans.job import run
from .plans.mart import MartOptions
from .session import build_session
from .sources.tables import TableSources
from .sources.testdata import TestDataSources


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="paygrid", description="Build and merge the feature mart.")
    src = p.add_argument_group("sources")
    for name in ("base", "dim", "ext", "vac"):
        src.add_argument(f"--{name}", help=f"{name} source: catalog table or parquet path")
    src.add_argument("--testdata", help="derive the sources from this test-data folder")
    out = p.add_mutually_exclusive_group(required=True)
    out.add_argument("--target", help="month-partitioned parquet folder of the feature table")
    out.add_argument("--target-table", help="catalog feature table (created if missing)")
    p.add_argument("--log", help="run log parquet folder")
    p.add_argument("--as-of", help="as-of date (YYYY-MM-DD); default today")
    p.add_argument("--variant", choices=("wide", "compact"), default="wide")
    p.add_argument("--count-ratio", choices=("auto", "integer", "exact"), default="auto")
    p.add_argument("--warmup-months", type=int, default=0)
    p.add_argument("--dedupe", choices=("after", "before"), default="after")
    p.add_argument("--master", help="Spark master (default: from spark-submit)")
    args = p.parse_args(argv)
    if not args.testdata and not all(getattr(args, n) for n in ("base", "dim", "ext", "vac")):
        p.error("give --base, --dim, --ext and --vac, or --testdata")
    return args


def main(argv=None) -> int:
    args = parse(argv)
    spark = build_session(args.master, app_name="paygrid-job")
    if args.testdata:
        sources = TestDataSources(spark, args.testdata)
    else:
        sources = TableSources(spark, args.base, args.dim, args.ext, args.vac)
    options = MartOptions(as_of=args.as_of, count_ratio=args.count_ratio,
                          warmup_months=args.warmup_months, dedupe=args.dedupe)
    result = run(spark, sources, target_path=args.target, log_path=args.log, options=options,
                 variant=args.variant, target_table=args.target_table)
    print(json.dumps({"status": "ok", "rows": result.rows,
                      "inserted_at": result.inserted_at.isoformat()}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
