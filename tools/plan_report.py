"""Print the formatted physical plan of registered queries (default: the bench set).

Usage: python tools/plan_report.py [--sf DIR] [name ...]
Queries with eager steps (checkpoints, size checks) run those steps first.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from bench import HEADLINE
    from carelens.plans.registry import REGISTRY
    from carelens.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=16)
    for name in a.names or HEADLINE:
        print(f"===== {name}")
        REGISTRY[name](spark, a.sf).explain("formatted")


if __name__ == "__main__":
    main()
