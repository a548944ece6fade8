"""Print the formatted physical plan of registered queries.

usage: python tools/explain.py [--sf DIR] query [query ...]

Boards that number their rows materialise their input first (see
``operators.groupwise.leaderboard``); their printed plan starts from that copy,
and the upstream plan ran as the job that wrote it.
"""

from __future__ import annotations

import argparse
import sys

sys.path.insert(0, ".")
from podium.plans import registry  # noqa: E402
from podium.session import get_session  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("queries", nargs="+")
    args = ap.parse_args()
    spark = get_session("podium-explain", "local[8]", 8)
    for name in args.queries:
        print(f"===== {name}")
        registry.QUERIES[name](spark, args.sf).explain("formatted")


if __name__ == "__main__":
    main()
