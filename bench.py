"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. Each
query writes its full result to a no-op sink, so all rows and columns are
computed. Light queries run once to warm up and then give the median of three.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from stationkit.catalog import QUERIES

LIGHT = [
    "clean_readings", "duplicate_count", "feature_table", "global_index", "rolling_3h",
    "rolling_3h_by_type", "station_exposure", "hourly_peaks", "pollutant_corr",
    "anomaly_3sigma", "daily_trend", "stations", "degrees", "graph_edges", "station_pairs",
    "mean_encode", "forecast_naive", "forecast_table", "station_corr",
]
HEAVY = ["pagerank", "edge_pagerank", "stream_sliding", "stream_ingest", "model_leaderboard"]


def seconds(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stationkit-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in LIGHT:
        seconds(spark, name, folder)
        times[name] = round(statistics.median(seconds(spark, name, folder) for _ in range(3)), 3)
    for name in HEAVY:
        times[name] = round(seconds(spark, name, folder), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
