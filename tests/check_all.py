"""Runs registered queries against DuckDB: python tests/check_all.py [sf_dir] [name ...]

With CHECK_SQL_ONLY=1 the rows-only queries are left out.
"""

from __future__ import annotations

import os
import sys
import time
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from compare import differences, duck  # noqa: E402

from ticketloom.catalog import load  # noqa: E402
from ticketloom.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    bad = 0
    for name, q in load().items():
        if wanted and not any(name == w or q.operator.split()[0] == w or w.endswith("*") and name.startswith(w[:-1]) for w in wanted):
            continue
        if q.sql is None and os.environ.get("CHECK_SQL_ONLY"):
            continue
        start = time.time()
        try:
            df = q.run(spark, sf)
            if q.sql is None:
                found, note = [], f"rows only: {df.count()}"
            else:
                found, note = differences(df, con, q.sql), "ok"
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
            if wanted:
                traceback.print_exc()
        bad += bool(found)
        print(f"{time.time() - start:6.2f}s {name}: {'; '.join(found) if found else note}", flush=True)
    print("failed:", bad)
