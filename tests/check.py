"""python tests/check.py <sf_dir> [names…]: compare queries with their SQL, print a table."""

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from compare import connect, difference  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        if name in oracles:
            problem, n = difference(spark, con, sf_dir, queries[name], oracles[name])
        else:
            problem, n = None, queries[name](spark, sf_dir).count()
        bad += problem is not None
        kind = "ok" if name in oracles else "rows"
        state = "BAD" if problem else kind
        print(f"{name:32s} {state:5s} {n:8d} rows {time.time() - start:6.1f}s", flush=True)
        if problem:
            print("  ", problem, flush=True)
    print("orphans", set(oracles) - set(queries), "bad", bad)
