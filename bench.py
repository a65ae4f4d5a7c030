"""Benchmark of the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).

``queries`` holds seconds per query, best of two after each query has been run once. The ``job_*``
entries clean a Parquet file of trips and write the result: ``job_exact``, ``job_exact_fingerprint``
with the other way of dropping duplicates, and
``job_step_by_step`` counting before and after each step with an action of its own, six in all.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

import pyspark
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rowguard.catalogs import YELLOW_TAXI  # noqa: E402
from rowguard.operators.cleaning import surviving_rows  # noqa: E402
from rowguard.operators.binding import bind  # noqa: E402
from rowguard.operators.counts import rule_counts  # noqa: E402
from rowguard.plans.clean_job import write_cleaned  # noqa: E402
from rowguard.session import get_session  # noqa: E402
from rowguard.sources.tables import read_table, write_table  # noqa: E402
from trip_queries.registry import REGISTRY  # noqa: E402
from trip_queries.trips import PERIOD, trips  # noqa: E402

HEADLINE = (
    "clean_trips",
    "clean_trips_fingerprint",
    "act_remove",
    "act_flag",
    "dedup_exact",
    "dedup_stats",
    "rule_stats",
    "clean_summary",
    "flag_distribution",
    "post_clean_checks",
    "profile_columns",
    "profile_duplicates",
    "negative_money_by_payment",
    "cleaning_policy",
    "dq_report",
)
RUNS = 2


def consume(df: DataFrame) -> None:
    """Compute every row and column without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def best_time(action: Callable[[], object]) -> float:
    times = []
    for _ in range(RUNS):
        started = time.perf_counter()
        action()
        times.append(time.perf_counter() - started)
    return round(min(times), 4)


def times_of(actions: dict[str, Callable[[], object]]) -> dict[str, float]:
    """Run every action once, so that all code is compiled, and then time each."""
    for action in actions.values():
        action()
    return {name: best_time(action) for name, action in actions.items()}


def step_by_step(raw: DataFrame, path: str) -> dict[str, int]:
    """The plain way to the same counts: six actions, four of which drop duplicates again."""
    found = {row["rule"]: row["rows"] for row in rule_counts(raw, YELLOW_TAXI, PERIOD).collect()}
    survivors = surviving_rows(raw, YELLOW_TAXI, PERIOD)
    before = survivors.count()
    cleaned = bind(raw, YELLOW_TAXI, PERIOD).with_flags(survivors.dropDuplicates())
    found["exact_duplicate_rows"] = before - cleaned.count()
    found["output_rows"] = cleaned.count()
    found["rows_flagged"] = cleaned.filter("dq_flags IS NOT NULL").count()
    write_table(cleaned, path, format="parquet")
    return found


def job_times(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, float]:
    path = f"{folder}/yellow_tripdata_{PERIOD}.parquet"
    write_table(trips(spark, sf_dir), path)
    raw = read_table(spark, path)

    def job(name: str, **options: str) -> Callable[[], object]:
        target = f"{folder}/{name}"
        return lambda: write_cleaned(
            raw, target, YELLOW_TAXI, PERIOD, output_format="parquet", **options
        )

    return times_of(
        {
            "job_exact": job("exact", dedup="aggregate"),
            "job_exact_fingerprint": job("fingerprint", dedup="fingerprint"),
            "job_step_by_step": lambda: step_by_step(raw, f"{folder}/steps"),
        }
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "rowguard_bench",
        master=f"local[{cpus}]",
        extra_config={
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = times_of(
        {name: lambda query=REGISTRY[name]: consume(query(spark, sf_dir)) for name in HEADLINE}
    )
    jobs = job_times(spark, sf_dir, tempfile.mkdtemp(prefix="rowguard-bench-"))
    rows = trips(spark, sf_dir).count()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": {**times, **jobs},
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "trips": rows,
                "clean_rows_per_sec": round(rows / times["clean_trips"]),
                "cpus": cpus,
                "spark": pyspark.__version__,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
