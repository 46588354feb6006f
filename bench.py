"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is run to completion with the no-op sink (the whole plan runs,
nothing is collected), after one warm-up, ``$BENCH_REPEAT`` times; the
median is reported.  The tables are single files of one row group, which one
core must read alone; they are written once, before timing, as a file a core,
as any table of some size lies on a cluster.  Prints one JSON line.
"""

from __future__ import annotations

import atexit
import json
import os
import shutil
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "shot_features",
    "player_summary",
    "goals_vs_expected_player",
    "preferred_foot",
    "players_inside_area",
    "assist_features",
    "frame_explode",
    "confusion_counts",
    "regression_metrics",
    "error_histogram",
    "goal_heatmap",
    "correlation_pairs",
    "running_total",
    "tick_grid_timeline",
    "stoppage_time",
    "attach_match",
    "train_logistic",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


TABLES = ("events", "lineitem", "orders")


def spread_tables(spark, sf_dir: str, files: int) -> str:
    """A folder with the tables that the queries read, as ``files`` files each."""
    folder = tempfile.mkdtemp(prefix="bench-tables-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").repartition(files).write.parquet(f"{folder}/{t}.parquet")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    # local mode: the driver JVM is the whole cluster; give it half the 32 GiB box
    os.environ.setdefault("PITCHLAKE_DRIVER_MEMORY", "16g")
    from pitchlake.plans.queries import QUERIES
    from pitchlake.session import get_spark

    spark = get_spark(f"local[{cpus}]", int(cpus))
    spark.conf.set("spark.sql.files.minPartitionNum", cpus)
    tables = spread_tables(spark, sf_dir, int(cpus))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    times: dict[str, float] = {}
    for name in names:
        fn = QUERIES[name]
        run(fn(spark, tables))  # warm-up: JIT, file listing, python imports
        samples = []
        for _ in range(repeat):
            t = time.perf_counter()
            run(fn(spark, tables))
            samples.append(time.perf_counter() - t)
        times[name] = round(statistics.median(samples), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "sum_median_query_seconds", "value": round(sum(times.values()), 4), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "cpus": int(cpus), "repeat": repeat}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
