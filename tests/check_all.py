"""Compare every registered query with its SQL at one scale: check_all.py [sf_dir] [name...]."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from oracle import connect, differences  # noqa: E402
from repotrends.session import local_session  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = local_session("check", "8")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name in names:
        start = time.time()
        try:
            df = queries()[name](spark, sf)
            sql = oracle_sql().get(name)
            diff = differences(df, con, sql) if sql else [f"no SQL, {df.count()} rows"]
        except Exception as e:  # report and go on with the next query
            diff = [f"{type(e).__name__}: {e}"[:600]]
        bad += bool(diff)
        print(f"{name:28s} {time.time() - start:6.2f}s  {'ok' if not diff else diff}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
