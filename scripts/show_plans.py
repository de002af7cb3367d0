"""Print the physical-plan lines that matter at scale (exchanges, joins,
scans with pushed filters, windows, aggregates, generators) for catalogue
queries.

usage: python scripts/show_plans.py [sf_dir] key [key ...]
       python scripts/show_plans.py /root/testdata/sf0.01 fct_daily_kpis --full
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from staylens.plans.catalog import QUERIES  # noqa: E402
from staylens.session import get_session  # noqa: E402

MARKERS = ("Exchange", "Join", "Scan", "Window", "Aggregate", "Generate", "Sort ", "PushedFilters",
           "PartitionFilters", "ReadSchema")


def main() -> None:
    args = [a for a in sys.argv[1:] if a != "--full"]
    full = "--full" in sys.argv
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    keys = [a for a in args if a != sf_dir] or ["fct_daily_kpis"]
    spark = get_session("local[8]", 16)
    spark.sparkContext.setLogLevel("ERROR")
    for key in keys:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[key](spark, sf_dir).explain("formatted" if full else "simple")
        print(f"===== {key}")
        for line in buf.getvalue().splitlines():
            if full or any(m in line for m in MARKERS):
                print("  " + line.rstrip()[:220])


if __name__ == "__main__":
    main()
