"""Print the formatted physical plan of a registered query.

Usage: python tools/show_plan.py <query> [sf_dir] [--final]
``--final`` runs the query first and prints the AQE final plan instead.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from paygrid.plans.queries import QUERIES  # noqa: E402
from paygrid.session import build_session  # noqa: E402


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    name = args[0] if args else "feature_mart"
    sf_dir = args[1] if len(args) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    df = QUERIES[name](spark, sf_dir)
    if "--final" in sys.argv:
        df.collect()
        print(df._jdf.queryExecution().executedPlan().treeString())
    else:
        df.explain("formatted")


if __name__ == "__main__":
    main()
