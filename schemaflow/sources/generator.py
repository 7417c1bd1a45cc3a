"""Synthetic order events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from schemaflow.functions.payloads import encode_orders
from schemaflow.functions.columns import millis_to_time, null_binary, padded_id, segment_of
from schemaflow.schemas import ORDER_V2
from schemaflow.sources.topics import to_envelopes

# The shape of the generated workload.
BASE_MILLIS = 1_767_225_600_000  # 2026-01-01T00:00:00Z
STEP_MILLIS = 13
CUSTOMERS = 1_000
TOTALS = 50_000
LEAST_TOTAL = 100
DISCOUNTS = 500


def _draw(number: Column, seed: int, size: int) -> Column:
    """Number in [0, size) that depends on the row number and seed alone, hence not on the partitioning."""
    mixed = (number % 2147483648 * 48271 + seed * 7919 + 12345) % 2147483647
    mixed = (mixed * 69621 + seed) % 2147483647
    return F.shiftright(mixed, 7) % size


def order_rows(numbers: DataFrame, number: str = "id", seed: int = 42) -> DataFrame:
    """One order row for each row number."""
    i = F.col(number)
    return numbers.select(
        i.alias("id"),
        padded_id("order", 10, i).alias("order_id"),
        padded_id("customer", 5, _draw(i, seed, CUSTOMERS)).alias("customer_id"),
        segment_of(i).alias("customer_segment"),
        (_draw(i, seed + 1, TOTALS) + LEAST_TOTAL).alias("total_cents"),
        millis_to_time(F.lit(BASE_MILLIS) + i * STEP_MILLIS).alias("event_time"),
        _draw(i, seed + 2, DISCOUNTS).alias("discount_cents"),
    )


def order_events(numbers: DataFrame, number: str = "id", schema: str = ORDER_V2, seed: int = 42) -> DataFrame:
    """Kafka-shaped rows with encoded payloads, one for each row number."""
    rows = order_rows(numbers, number, seed).withColumn("value", encode_orders(schema))
    shaped = to_envelopes(rows, "orders", F.lit(0), F.col("id"), F.col("event_time"), F.col("value"))
    return shaped.withColumn("key", null_binary())


def generate(spark: SparkSession, count: int, schema: str = ORDER_V2, seed: int = 42) -> DataFrame:
    """``count`` events; small counts use few partitions, large ones the session's parallelism."""
    tasks = min(max(8, spark.sparkContext.defaultParallelism), max(1, count // 1000))
    return order_events(spark.range(0, count, 1, tasks), "id", schema, seed)
