"""Compare every registered query with its oracle: python tests/check_all.py [folder] [name part]."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from matchbook.session import local_session  # noqa: E402
from tests.compare import connect, differences  # noqa: E402

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
wanted = sys.argv[2] if len(sys.argv) > 2 else ""
skipped = sys.argv[3] if len(sys.argv) > 3 else None
spark, con, bad = local_session(8), connect(folder), 0
oracles = entry.oracle_sql()
for name, run in entry.queries().items():
    if not any(w in name for w in wanted.split(",")) or (skipped and skipped in name):
        continue
    start = time.time()
    try:
        df = run(spark, folder)
        note = differences(df, con, oracles[name]) if name in oracles else f"no oracle, {df.count()} rows"
    except Exception as error:  # noqa: BLE001
        note = f"{type(error).__name__}: {str(error)[:600]}"
    bad += note is not None and not note.startswith("no oracle")
    print(f"{'ok  ' if note is None else 'DIFF'} {time.time() - start:6.1f}s {name} {note or ''}", flush=True)
print("differences:", bad)
