"""Run every registered query against its DuckDB oracle (like the driver's
correctness gate). Usage: python tests/run_oracles.py [sf_dir] [name ...]"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from tallyspark.checks.compare import compare, duck  # noqa: E402
from tallyspark.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = build_session("local[8]")
con = duck(sf)
q, o = E.queries(), E.oracle_sql()
bad = 0
for name in names or list(q):
    t = time.time()
    try:
        df = q[name](spark, sf)
        if name in o:
            r = compare(df, con, o[name])
        else:
            r = {"spark_rows": df.count(), "oracle": None}
    except Exception as ex:  # noqa: BLE001
        r = {"error": repr(ex)[:800]}
    ok = r.get("hash_match") or (r.get("oracle") is None and "error" not in r)
    bad += not ok
    print(("OK  " if ok else "BAD ") + name, round(time.time() - t, 1), json.dumps(r, default=str)[:1500], flush=True)
print("failures:", bad)
