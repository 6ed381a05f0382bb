"""Check registered queries against their SQL: python tests/check.py [sf] [name part ...]."""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from kerbside.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    parts = sys.argv[2:]
    sf_dir = f"/root/testdata/{sf}"
    spark = build_session("check", "local[8]", "UTC", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": "/tmp/kerbside-warehouse",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf_dir)
    bad = 0
    for name, query in queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            got = oracle.spark_rows(df)
            seconds = time.time() - start
            sql = oracle_sql().get(name)
            if sql is None:
                print(f"rows  {name}: {len(got[1])} rows {seconds:.1f}s", flush=True)
                continue
            want = oracle.duck_rows(con, sql)
            if got != want:
                bad += 1
                print(f"DIFF  {name}: {len(got[1])} vs {len(want[1])} rows, columns {got[0]} vs {want[0]}")
                only = [r for r in got[1] if r not in set(want[1])][:3], [r for r in want[1] if r not in set(got[1])][:3]
                print("   spark", *only[0], sep="\n     ")
                print("   duck ", *only[1], sep="\n     ", flush=True)
            else:
                gaps = oracle.type_gaps(df, con, sql)
                print(f"ok    {name}: {len(got[1])} rows {seconds:.1f}s {gaps or ''}", flush=True)
        except Exception:
            bad += 1
            print(f"FAIL  {name}", flush=True)
            print("   " + "\n   ".join(traceback.format_exc().splitlines()[-6:])[:1500], flush=True)
    print("bad:", bad)


main()
