"""Run registered queries against their SQL: python tests/check.py [name-prefix ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.compare import compare, connect
from venuelake.session import build_session
import __spark_entry__ as entry_points

if __name__ == "__main__":
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("check", 8)
    con = connect(sf)
    names = sys.argv[1:]
    bad = empty = 0
    oracles = entry_points.oracle_sql()
    for name, fn in entry_points.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            msg = compare(df, con, oracles[name]) if name in oracles else f"(no sql) {df.count()} rows"
            n = None
            if msg is None:
                n = con.execute(f"SELECT count(*) FROM ({oracles[name]})").fetchone()[0]
                if n == 0:
                    empty += 1
                    msg = "EMPTY RESULT"
        except Exception as e:  # report and go on with the next query
            msg = f"{type(e).__name__}: {str(e)[:600]}"
        ok = msg is None or msg.startswith("(no sql)")
        bad += not ok
        if not ok or os.environ.get("VERBOSE"):
            print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - t:.1f}s rows={n} {msg or ''}", flush=True)
    print(f"bad={bad} empty={empty}")
