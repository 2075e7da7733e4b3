"""Run registered queries against their DuckDB oracle: python scripts/check_oracle.py [sf_dir] [key-substring ...]"""

import sys
import time

sys.path.insert(0, __file__.rsplit("/", 2)[0])

from uptake.plans.catalog import REGISTRY  # noqa: E402
from uptake.session import local_session  # noqa: E402
from tests.oracle import compare, duck  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
pats = sys.argv[2:]
spark = local_session(8)
con = duck(sf)
bad = 0
for key, (fn, sql) in REGISTRY.items():
    if pats and not any(p in key for p in pats):
        continue
    t0 = time.time()
    try:
        df = fn(spark, sf)
        if sql is None:
            n = df.count()
            ok, msg = True, f"(no oracle) {n} rows"
        else:
            ok, msg = compare(df, con, sql)
    except Exception as e:  # report and continue
        ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:600]}"
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {key:34s} {time.time() - t0:5.1f}s {msg}", flush=True)
print("failures:", bad)
