"""Run registered queries against their SQL: python tests/compare_all.py [sf dir] [names...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import differences, open_duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as contract


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = open_duckdb(sf_dir), contract.oracle_sql()
    failed = 0
    for name, build in contract.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = build(spark, sf_dir)
            if name in oracle:
                found = differences(df, con, oracle[name])
                note = "sql"
            else:
                found, note = ([] if df.count() else ["no rows"]), "rows"
        except Exception as error:  # report and go on with the next query
            found, note = [f"{type(error).__name__}: {str(error)[:600]}"], "error"
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name:32s} {note:5s} {time.time() - started:6.1f}s {found or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
