"""Times the headline jobs on the test tables and prints one JSON line.

The raw tables are written first (reported as ``raw_tables``). Each job then runs
``BENCH_REPEATS`` times from the raw Parquet to a full result; the first run is kept as
``cold``, the best of the rest counts. Reads of a stored mart are timed on their own.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cadenza import catalog  # noqa: E402
from cadenza.plans import build  # noqa: E402
from cadenza.session import build_session, new_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

HEADLINE = [
    "stg_activities",
    "stg_health",
    "int_unified",
    "mart_training",
    "mart_health",
    "mart_race",
    "join_range_30d",
    "agg_activity_overview",
    "agg_weekday_profile",
    "qry_recent_activities",
    "qry_temp_pace_trend",
    "wx_summary",
    "coaching_context",
    "alerts",
    "dq_report",
]


def full_result(df) -> None:
    """Compute every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return time.perf_counter() - start


def main() -> None:
    shared = tempfile.mkdtemp(prefix="cadenza-bench-")
    spark = build_session(CPUS, spark__checkpoint__dir=shared)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        full_result(catalog.run(name, spark, SF_DIR))

    tables = catalog.Tables(spark, SF_DIR)
    raw_names = ("activities", "daily_health", "calendar_events", "race_goals", "analysis_log")
    raw_seconds = timed(lambda: [getattr(tables, n) for n in raw_names])

    cold, best = {}, {}
    for name in HEADLINE:
        runs = [timed(lambda: run(name)) for _ in range(max(REPEATS, 2))]
        cold[name], best[name] = round(runs[0], 3), round(min(runs[1:]), 3)

    out = new_path(spark, "marts")
    raw = {n: getattr(tables, n) for n in raw_names}
    builds = [timed(lambda: build.build(raw, out)) for _ in range(2)]
    best["build_all_marts"] = round(min(builds), 3)
    mart = build.read_mart(spark, f"{out}/mart_training")
    mart.createOrReplaceTempView("stored_training")
    reads = {
        "read_mart_full": "SELECT * FROM stored_training",
        "read_mart_aggregate": "SELECT athlete_id, avg(total_distance_km), max(total_training_load)"
        " FROM stored_training GROUP BY athlete_id",
        "read_mart_filtered": "SELECT * FROM stored_training WHERE total_distance_km > 40",
    }
    for name, sql in reads.items():
        runs = [timed(lambda: full_result(spark.sql(sql))) for _ in range(REPEATS + 1)]
        best[name] = round(min(runs), 3)

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "cold": cold,
                "raw_tables": round(raw_seconds, 3),
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": CPUS,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
