"""Time the headline queries and the reference workload of a million generated events.

Prints one JSON line. ``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the cores, ``BENCH_EVENTS`` the size of the
generated workload.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from schemaflow import session  # noqa: E402
from schemaflow.operators import metrics  # noqa: E402
from schemaflow.operators import validate as val  # noqa: E402
from schemaflow.operators.aggregate import aggregate  # noqa: E402
from schemaflow.operators.sinks import audit_totals, file_audit, write_aggregates  # noqa: E402
from schemaflow.plans.table_queries import QUERIES  # noqa: E402
from schemaflow.schemas import ORDER_V2  # noqa: E402
from schemaflow.sources.generator import generate  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
EVENTS = int(os.environ.get("BENCH_EVENTS", "1000000"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

HEADLINES = [
    "window_agg_hour",
    "window_agg_day",
    "window_agg_orders_day",
    "distinct_with_duplicates",
    "split_valid",
    "split_counts",
    "decode_v1_as_v2",
    "decode_oldest_first",
    "synthetic_orders",
    "compat_backward",
    "compat_full",
    "register_gate",
    "register_sequence",
    "parquet_roundtrip",
    "dedup_latest",
    "batch_run_metrics",
    "stream_window_agg",
]
# Queries that write and start streams are timed once, after the others have warmed the session.
HEAVY = {"parquet_roundtrip", "dedup_latest", "batch_run_metrics", "stream_window_agg"}


def start() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("schemaflow-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in session.recommended_options().items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(action) -> float:
    begun = time.perf_counter()
    action()
    return round(time.perf_counter() - begun, 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def calibration(spark: SparkSession) -> float:
    """A fixed computation that no change of the package touches, to tell a faster machine from faster code."""
    hashed = spark.range(0, 400_000_000, 1, int(CPUS)).selectExpr("sum(xxhash64(id) % 1000) AS total")
    return min(timed(hashed.collect) for _ in range(REPEATS))


def workload(spark: SparkSession, events: int) -> dict[str, float]:
    """Generate, validate, aggregate and write, timed by stage as the published numbers are."""
    stages = {}
    out = tempfile.mkdtemp(prefix="bench-")
    rows = generate(spark, events).persist()
    stages["generate"] = timed(rows.count)
    split = val.hold(val.validate(rows, ORDER_V2))
    counted = {}
    stages["validate"] = timed(lambda: counted.update(metrics.snapshot(split)))
    assert counted["records_valid"] == events, counted
    hourly = aggregate(split.valid, "1 hour").persist()
    stages["aggregate"] = timed(hourly.count)
    stages["write"] = timed(lambda: write_aggregates(hourly, f"{out}/agg"))
    stages["total"] = round(sum(stages.values()), 3)
    for frame in (hourly, split.tagged):
        frame.unpersist(blocking=True)
    # Beside the total: decode, aggregate and write in one, with only the generated rows cached.
    again = aggregate(val.validate(rows, ORDER_V2).valid, "1 hour")
    stages["uncached_write"] = timed(lambda: write_aggregates(again, f"{out}/again"))
    print(audit_totals(file_audit(spark, f"{out}/agg")).first(), file=sys.stderr)
    rows.unpersist(blocking=True)
    return stages


def main() -> None:
    spark = start()
    results = {}
    for name in HEADLINES:
        once = [timed(lambda: drain(QUERIES[name](spark, SF_DIR))) for _ in range(1 if name in HEAVY else REPEATS)]
        results[name] = min(once)
        print(name, once, file=sys.stderr, flush=True)
    runs = [workload(spark, EVENTS) for _ in range(REPEATS)]
    print(runs, file=sys.stderr)
    best = min(runs, key=lambda r: r["total"])
    results.update({f"events_{EVENTS}_{stage}": seconds for stage, seconds in best.items()})
    results.update({f"events_{EVENTS}_first_{stage}": seconds for stage, seconds in runs[0].items()})
    results["calibration"] = calibration(spark)
    total = round(sum(results[name] for name in HEADLINES) + best["total"], 3)
    line = {
        "metric": "headline queries and generated workload, wall clock",
        "value": total,
        "unit": "sec",
        "queries": results,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "events_per_sec": round(EVENTS / best["total"]),
        "cpus": int(CPUS),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
