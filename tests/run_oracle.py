"""Run every registered query against its DuckDB twin (like the driver does).

usage: python tests/run_oracle.py [sf_dir] [name-prefix ...]
"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from churnlab.session import checkpoint_dir, get_spark  # noqa: E402
from churnlab.plans.registry import oracle_sql, queries  # noqa: E402
from oracle_check import compare  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    if os.environ.get("PLAIN_SESSION"):
        # the driver's own session: defaults except shuffle partitions
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = get_spark("local[8]", shuffle_partitions=8)
    checkpoint_dir(spark)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in sqls:
                ok, msg = compare(df, sqls[name], sf)
            else:
                n = df.count()
                ok, msg = True, f"{n} rows (no oracle)"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name:32s} {time.time() - t:6.2f}s {msg}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
