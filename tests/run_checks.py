"""Compare registered queries with their SQL: ``python tests/run_checks.py [folder] [name ...]``."""

import sys
import time

sys.path.insert(0, __file__.rsplit("/", 2)[0])
from __spark_entry__ import oracle_sql, queries  # noqa: E402
from pricetide.session import build_session  # noqa: E402
from tests.harness import compare, duck  # noqa: E402

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
wanted = sys.argv[2:]
spark = build_session("checks", "local[8]", 8, **{"spark.driver.memory": "12g"})
spark.sparkContext.setLogLevel("ERROR")
con, oracles, bad = duck(folder), oracle_sql(), 0
for name, fn in queries().items():
    if wanted and not any(w in name for w in wanted):
        continue
    start = time.time()
    try:
        if name in oracles:
            problem = compare(fn(spark, folder), con, oracles[name])
            note = "ok" if problem is None else f"DIFF {problem}"
        else:
            df = fn(spark, folder)
            note = f"rows only: {len(df.collect())} x {len(df.columns)}"
    except Exception as e:  # noqa: BLE001 - report and go on
        note = f"ERROR {type(e).__name__} {str(e)[:1500]}"
    bad += note.startswith(("DIFF", "ERROR"))
    print(f"{time.time() - start:6.1f}s {name}: {note}", flush=True)
print("failed:", bad)
