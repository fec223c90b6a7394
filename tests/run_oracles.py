"""Compare queries with their oracles: ``python tests/run_oracles.py FOLDER [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from compare import compare, oracle_connection  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(folder)
    oracles, bad = entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            result = compare(df, con, oracles[name]) if name in oracles else f"rows {df.count()} (no oracle)"
        except Exception as exc:  # noqa: BLE001
            result = "ERROR " + str(exc)[:600]
        if result:
            bad.append(name)
        print(f"{name:32s} {time.time() - start:6.1f}s {result or 'ok'}", flush=True)
    print(f"{len(bad)} differ: {bad}")
    return len(bad)


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 100))
