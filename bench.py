"""Times the headline queries and prints one JSON line.

Every query runs to the last row into Spark's no-op sink, so no time goes into
collecting results. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from tilth.plans.queries import run_query  # noqa: E402

HEADLINE = (
    "gold_field_soil_daily", "gold_field_weather_daily", "gold_field_crop_health_daily", "gold_field_irrigation_daily",
    "gold_machine_daily", "gold_planting_economics", "window_range_join", "active_interval_join", "decay_window_join",
    "gdd_cumulative", "dedupe_keep_last", "split_valid_invalid", "cost_pivot", "v_field_soil_weekly", "v_farm_scorecard",
    "chart_irrigation_dependence",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus) if cpus.isdigit() else 16))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.cache.maxEntries", "1000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        run_query(name, spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timed("gold_machine_daily")  # start-up and class loading
    times = {name: round(min(timed(name), timed(name)), 3) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(folder).name.removeprefix("sf"), "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
