"""Tumbling-window metrics per customer and segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemaflow.functions.columns import date_hour, net_cents
from schemaflow.schemas import AGGREGATE_COLUMNS

GRAIN = ["customer_id", "customer_segment"]


def window_metrics(net: str = "net_cents") -> list[Column]:
    return [
        F.count(F.lit(1)).alias("order_count"),
        F.sum(net).alias("net_cents_sum"),
        F.avg(net).alias("net_cents_avg"),
        F.max(net).alias("net_cents_max"),
    ]


def finish(grouped: DataFrame) -> DataFrame:
    """The ten output columns of a grouped frame that still holds its ``window`` struct."""
    opened = grouped.withColumns(
        {
            "window_start": F.col("window.start"),
            "window_end": F.col("window.end"),
            "date_hour": date_hour(F.col("window.start")),
        }
    )
    return opened.select(*AGGREGATE_COLUMNS)


def aggregate(orders: DataFrame, duration: str) -> DataFrame:
    """Exact metrics, distinct order ids included.

    Catalyst plans the distinct count in two exchanges: first on the grain plus the order id, which spreads a hot
    customer over all tasks, then on the grain, which carries one partial row per task and group. Rows without an event
    time belong to no window and drop out.
    """
    grouped = (
        orders.withColumn("net_cents", net_cents())
        .groupBy(*GRAIN, F.window("event_time", duration))
        .agg(*window_metrics(), F.count_distinct("order_id").alias("order_id_distinct"))
    )
    return finish(grouped)


def business_rows(orders: DataFrame, predicate: Column | None = None) -> DataFrame:
    """Orders that pass the business rule: by default a positive amount and a known customer."""
    rule = predicate if predicate is not None else (F.col("total_cents") > 0) & F.col("customer_id").isNotNull()
    return orders.filter(rule)


def in_segments(aggregated: DataFrame, excluded: str) -> DataFrame:
    """Rows of every segment but one."""
    return aggregated.where(F.col("customer_segment") != excluded)


def total_orders(aggregated: DataFrame) -> DataFrame:
    return aggregated.agg(F.sum("order_count").alias("order_count"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def first_by(df: DataFrame, *keys: str) -> DataFrame:
    """The one row that sorts first; planned as a top-1, not as a global sort."""
    return df.orderBy(*keys).limit(1)
