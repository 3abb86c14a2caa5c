"""Print the formatted physical plan of registered queries (after running them,
so AQE shows its final plan).

Usage: python tools/explain_plans.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shapekit.plans.catalog import QUERIES  # noqa: E402
from shapekit.session import get_session  # noqa: E402


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    for name in args:
        df = QUERIES[name](spark, sf)
        df.collect()
        print(f"===== {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
