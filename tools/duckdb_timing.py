"""Time each oracle statement in DuckDB (the reference's engine) at one scale.

Usage: python tools/duckdb_timing.py [sf_dir] [threads]
Prints one JSON line {query: seconds}, median of three runs after a warm-up;
each result is materialised in a DuckDB temp table (no transfer to Python).
"""
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from indistar_oracle.duckdb_oracle import oracle_sql  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
threads = int(sys.argv[2]) if len(sys.argv) > 2 else 8
con = duckdb.connect()
con.execute(f"set threads = {threads}")
for t in ("nation", "customer", "orders", "lineitem", "part"):
    con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
out = {}
for name, sql in oracle_sql().items():
    # materialise inside DuckDB (no transfer to Python), like a no-op sink
    stmt = f"create or replace temp table bench_out as {sql}"
    con.execute(stmt)
    runs = []
    for _ in range(3):
        t0 = time.perf_counter()
        con.execute(stmt)
        runs.append(time.perf_counter() - t0)
    out[name] = round(statistics.median(runs), 3)
print(json.dumps(out))
