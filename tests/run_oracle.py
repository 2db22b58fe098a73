"""Run every registered query against its DuckDB SQL (like the driver's check).

Usage: python tests/run_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from oracle import compare, duck  # noqa: E402

import __spark_entry__ as se  # noqa: E402
from strandline.session import get_spark  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(se.queries())
    spark = get_spark("local[8]", 8, extra={"spark.sql.session.timeZone": os.environ.get("TZ_SESSION", "UTC")})
    con = duck(sf_dir)
    sqls = se.oracle_sql()
    bad = 0
    for name in names:
        t0 = time.time()
        df = se.queries()[name](spark, sf_dir)
        if name in sqls:
            ok, msg = compare(df, con, sqls[name])
        else:
            ok, msg = True, f"{df.count()} rows (no oracle)"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.time() - t0:6.1f}s {msg}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
