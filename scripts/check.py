"""python scripts/check.py [folder] [name part ...]: compare queries with their SQL."""
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from geocadence.catalog import load_all
from geocadence.catalog.compare import compare, connect
from geocadence.catalog.registry import ORACLES, QUERIES
from geocadence.session import build_session

load_all()
folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
parts = sys.argv[2:]
names = [n for n in QUERIES if not parts or any(p in n for p in parts)]
spark = build_session("local[8]")
spark.sparkContext.setLogLevel("OFF")
con = connect(folder)
bad = []
for n in names:
    t0 = time.time()
    try:
        ok, msg = compare(spark, con, n, QUERIES[n], ORACLES.get(n), folder)
    except Exception as e:
        ok, msg = False, f"{type(e).__name__}: {str(e)[:600]}"
        if os.environ.get("TRACE"):
            traceback.print_exc()
    if not ok:
        bad.append(n)
    print(f"{'ok  ' if ok else 'FAIL'} {n:32s} {time.time() - t0:6.2f}s {msg}", flush=True)
print(f"{len(names) - len(bad)}/{len(names)} ok; failed: {bad}")
