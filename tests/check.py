"""Compare registered queries with their SQL twins: python tests/check.py [sf_dir] [name ...]"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if args and not any(name == a or (a.endswith("*") and name.startswith(a[:-1])) for a in args):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            found = differences(df, con, oracle[name]) if name in oracle else [f"no SQL, {df.count()} rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if not found else str(found)[:700]}", flush=True)
    print("not ok:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
