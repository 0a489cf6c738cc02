"""Times the headline queries and jobs and prints one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyward.plans import fixture as fx  # noqa: E402
from tallyward.plans import jobs  # noqa: E402
from tallyward.plans.durable import durable, scratch  # noqa: E402
from tallyward.plans.queries import QUERIES  # noqa: E402
from tallyward.schemas import CURATED, MONITORING  # noqa: E402

HEADLINE = [
    "alert_rules", "velocity_5min", "dedup_scored", "reconcile_labels", "hourly_monitoring",
    "dim_account", "fct_scored_transactions", "mart_fraud_hourly_kpis", "dq_fk_origin", "dq_unique",
    "parity_kpi", "kpi_tiles", "top_risky_accounts", "training_dataset", "envelope_decode",
    "alert_envelopes",
]
ONCE = ["stream_silver", "stream_velocity", "model_refresh"]


def hourly_and_warehouse(spark: SparkSession, silver, labels) -> None:
    out = scratch(spark, "bench")
    jobs.hourly(spark, silver, labels, out, as_of=fx.AS_OF)
    built = jobs.build_warehouse(
        spark, spark.read.schema(CURATED).parquet(f"{out}/curated_scored"),
        spark.read.schema(MONITORING).parquet(f"{out}/monitoring_hourly"), f"{out}/warehouse")
    failed = built.failed()
    assert not failed, failed


def timed(run) -> float:
    began = time.perf_counter()
    run()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def consume(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        consume(name)
        seconds[name] = round(statistics.median(timed(lambda: consume(name)) for _ in range(3)), 3)
    for name in ONCE:
        consume(name)
        seconds[name] = round(statistics.median(timed(lambda: consume(name)) for _ in range(3)), 3)
    silver = durable(fx.with_duplicates(fx.silver(spark, sf_dir)), "silver")
    labels = durable(fx.labels(spark, sf_dir), "labels")
    hourly_and_warehouse(spark, silver, labels)
    seconds["hourly_and_warehouse"] = round(statistics.median(
        timed(lambda: hourly_and_warehouse(spark, silver, labels)) for _ in range(3)), 3)
    rows = fx.table(spark, sf_dir, "events").count()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
        "stream_rows_per_second": round(rows / seconds["stream_silver"], 1),
    }))


if __name__ == "__main__":
    main()
