"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder and ``BENCH_CPUS`` the number of local cores. Staged input files (raw
trips, weather) are made before the clock starts; everything a query itself does is timed, its rows going
to a sink that drops them. Before that each query runs once, untimed, on the smallest tables, so that class
loading and compilation are not measured.
"""

import json
import os
import time

from pyspark.sql import SparkSession

from fareloom.plans import fixtures
from fareloom.plans.registry import QUERIES
from fareloom.session import get_session

HEADLINE = (
    "enrich_zones",
    "silver_select",
    "gold_join",
    "gold_join_fanout",
    "dq_report",
    "enrich_roundtrip",
    "stream_bronze",
    "stream_silver",
    "stream_report",
    "stream_gold",
    "stream_gold_fanout",
    "stream_gold_bounded",
    "stream_gold_static",
    "stream_gold_table",
    "stream_gold_late_weather",
    "stream_gold_table_late_weather",
    "catalog_bronze",
)


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "fareloom-bench",
        {
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    smallest = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(smallest) and smallest != sf_dir:
        for name in HEADLINE:
            run(spark, name, smallest)

    fixtures.staged_trips(spark, sf_dir)
    for stations in (False, True):
        fixtures.staged_weather(spark, sf_dir, stations)
    trips = fixtures.trips(spark, sf_dir).count()

    seconds = {name: run(spark, name, sf_dir) for name in HEADLINE}

    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "trips": trips,
                "trips_per_sec": {name: round(trips / s) for name, s in seconds.items()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
