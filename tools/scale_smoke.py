"""Replicate a test scale's ``events`` table N times and run the bench on it.

    python tools/scale_smoke.py /root/testdata/sf0.1 50 <out_dir>

Event ids are shifted per copy, so every copy becomes new matches (the
binding derives matches from ids); the other columns are copied.  The copy
is written once with Spark (``<out_dir>/events.parquet``), then ``bench.py``
runs the frame and timeline queries on it with ``BENCH_REPEAT=1``.
"""

from __future__ import annotations

import os
import subprocess
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES = ("shot_features,player_summary,players_inside_area,frame_explode,running_total,"
           "tick_grid_timeline,correlation_pairs,stoppage_time")


def main() -> None:
    src, factor, out = sys.argv[1], int(sys.argv[2]), sys.argv[3]
    from pyspark.sql import functions as F

    from pitchlake.session import get_spark

    spark = get_spark("local[8]", 8)
    ev = spark.read.parquet(f"{src}/events.parquet")
    n = ev.agg(F.max("event_id") + 1).first()[0]
    copies = ev.select(F.explode(F.sequence(F.lit(0), F.lit(factor - 1))).alias("k"), "*")
    copies.select((F.col("event_id") + F.col("k") * n).alias("event_id"), "ts", "user_id", "event_type",
                  "value", "props") \
        .repartition(2 * factor // 6 + 1).write.mode("overwrite").parquet(f"{out}/events.parquet")
    spark.stop()
    env = dict(os.environ, BENCH_SF_DIR=out, BENCH_REPEAT="1", BENCH_QUERIES=QUERIES)
    bench = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "bench.py")
    subprocess.run([sys.executable, bench], env=env, check=True)


if __name__ == "__main__":
    main()
