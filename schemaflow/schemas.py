"""Row shapes and the order payload schemas."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# The column names and types of all rows below. A topic snapshot with its position columns:
ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("value", T.BinaryType()),
    ]
)
ENVELOPE_COLUMNS = ENVELOPE.fieldNames()

ORDER_ROW = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("customer_segment", T.StringType()),
        T.StructField("total_cents", T.LongType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("discount_cents", T.LongType()),
    ]
)

BAD_ROW = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("reason", T.StringType()),
    ]
)

AGGREGATE_ROW = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("customer_segment", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("date_hour", T.StringType()),
        T.StructField("order_count", T.LongType()),
        T.StructField("net_cents_sum", T.LongType()),
        T.StructField("net_cents_avg", T.DoubleType()),
        T.StructField("net_cents_max", T.LongType()),
        T.StructField("order_id_distinct", T.LongType()),
    ]
)
AGGREGATE_COLUMNS = AGGREGATE_ROW.fieldNames()
PARTITION_COLUMNS = ["date_hour", "customer_segment"]


def order_schema(fields: list[dict], name: str = "Order", namespace: str = "fixtures.events") -> str:
    """Avro record schema as JSON text."""
    return json.dumps({"type": "record", "name": name, "namespace": namespace, "fields": fields})


# The three published versions of the order payload.
_KEYS = [
    {"name": "order_id", "type": "string"},
    {"name": "customer_id", "type": "string"},
    {"name": "customer_segment", "type": "string"},
]
_TIME = {"name": "event_time", "type": {"type": "long", "logicalType": "timestamp-millis"}}
_DISCOUNT = {"name": "discount_cents", "type": "long", "default": 0}

ORDER_V1 = order_schema([*_KEYS, {"name": "total_cents", "type": "long"}, _TIME])
ORDER_V2 = order_schema([*_KEYS, {"name": "total_cents", "type": "long"}, _TIME, _DISCOUNT])
ORDER_V3 = order_schema([*_KEYS, {"name": "total_amount_cents", "type": "long"}, _TIME, _DISCOUNT])
