"""Time the queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query runs once to warm up, then BENCH_RUNS times (default 2); the median counts. Results go to Spark's noop sink,
so all rows and columns are computed and none is collected. `build_marts` is the whole job: raw snapshots to marts on
disk, checks included. `islands_one_window` is the textbook form of `downtime_islands`, one window per ride, for
comparison.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from fleetstate.plans.build import build_marts  # noqa: E402
from fleetstate.session import RECOMMENDED  # noqa: E402
from workload.registry import REGISTRY, Frames  # noqa: E402


def session(cpus: str) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="bench-")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoint")
        .config("spark.local.dir", f"{scratch}/local")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_all(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def one_window_islands(staged: DataFrame) -> DataFrame:
    """Runs by the difference of two row numbers."""
    place = [F.row_number().over(Window.partitionBy(*keys).orderBy("captured_at", "data_source")) for keys in (["ride_id"], ["ride_id", "is_open"])]
    closed = staged.withColumn("run_no", place[0] - place[1]).filter(~F.col("is_open"))
    return closed.groupBy("ride_id", "ride_name", "park_name", "land_name", "run_no").agg(
        F.min("captured_at").alias("downtime_started_at"),
        F.max("captured_at").alias("last_observed_closed_at"),
        F.min("captured_date").alias("downtime_date"),
        F.count(F.lit(1)).alias("closed_snapshot_count"),
    )


def median_seconds(job, runs: int) -> float:
    job()
    times = []
    for _ in range(runs):
        begun = time.perf_counter()
        job()
        times.append(time.perf_counter() - begun)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    only = os.environ.get("BENCH_ONLY")
    jobs = {name: (lambda q=query: run_all(q(spark, sf_dir))) for name, query in REGISTRY.items()}
    jobs["build_marts"] = lambda: build_marts(Frames(spark, sf_dir).raw)
    jobs["islands_one_window"] = lambda: run_all(one_window_islands(Frames(spark, sf_dir).staged))
    if only:
        jobs = {name: jobs[name] for name in only.split(",")}
    seconds = {name: median_seconds(job, runs) for name, job in jobs.items()}
    headline = round(sum(s for name, s in seconds.items() if name in REGISTRY), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": headline,
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "times_control": {
                    name: round(s / seconds["islands_one_window"], 2) for name, s in seconds.items() if "islands_one_window" in seconds
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
