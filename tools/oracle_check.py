"""Run every registered query against its DuckDB twin and print a table.

Usage: python tools/oracle_check.py [--exact] [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starmart.catalog.check import compare, duck  # noqa: E402
from starmart.catalog.spark_queries import QUERIES  # noqa: E402
from starmart.session import local_session  # noqa: E402


def main(argv: list[str]) -> int:
    if "--exact" in argv:
        import starmart.catalog.check as check
        check.EXACT = True
        argv = [a for a in argv if a != "--exact"]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or sorted(QUERIES)
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            r = compare(spark, con, name, sf_dir)
            status = "OK " if r.ok else "BAD"
            bad += not r.ok
            print(f"{status} {name:32s} {r.spark_rows:>7} {str(r.oracle_rows):>7} {time.time() - t0:6.1f}s {r.detail}",
                  flush=True)
        except Exception as exc:  # report and go on with the next query
            bad += 1
            print(f"ERR {name:32s} {type(exc).__name__}: {str(exc)[:300]}", flush=True)
            traceback.print_exc(limit=2, file=sys.stdout)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
