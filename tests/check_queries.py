"""python -m tests.check_queries [sf_dir] [name prefix ...]: compare queries with their SQL and time them."""

from __future__ import annotations

import sys
import time
import traceback

import __spark_entry__ as entry
from holdfast.session import local_session
from tests.oracle import compare, connect

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = local_session(cores="8"), connect(folder)
    bad = []
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        sql, start = entry.oracle_sql().get(name), time.time()
        try:
            result = compare(spark, con, fn, sql, folder) if sql else f"{fn(spark, folder).count()} rows (no SQL)"
        except Exception as error:  # noqa: BLE001
            traceback.print_exc(limit=-3)
            result = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        if result and "no SQL" not in result:
            bad.append(name)
        print(f"{time.time() - start:6.2f}s {name}: {result or 'ok'}", flush=True)
    print("failed:", bad)
    spark.stop()
