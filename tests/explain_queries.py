"""Print ``explain("formatted")`` for registered queries.

Usage: ``python tests/explain_queries.py [name ...] [--sf DIR]`` (default: every query at sf0.01).
"""

from __future__ import annotations

import sys
from pathlib import Path


def main(argv):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from rosterflow.plans.registry import all_queries
    from rosterflow.session import get_session

    sf, names, it = "/root/testdata/sf0.01", [], iter(argv)
    for a in it:
        if a == "--sf":
            sf = next(it)
        else:
            names.append(a)
    spark = get_session(master="local[8]", shuffle_partitions=8)
    qs = all_queries()
    for n in names or list(qs):
        print(f"===== {n}", flush=True)
        qs[n](spark, sf).explain("formatted")
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
