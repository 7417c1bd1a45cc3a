"""Column expressions that encode and decode payloads."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from schemaflow.functions import avro_decode, avro_encode

# Both modules travel inside their UDFs, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(avro_decode)
cloudpickle.register_pickle_by_value(avro_encode)


def _arrow_udf(over_batches: Callable, returns: str, *settings) -> Callable:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return over_batches(batches, *settings)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # Non-deterministic in name only: it keeps Catalyst from evaluating the call a second time for a filter on the
    # result that it pushes below the projection.
    return F.arrow_udf(run, returns).asNondeterministic()


def decode_payload(payload: Column, reader: str, writers: list[str]) -> Column:
    """Struct of the decoded order fields, a ``valid`` flag and the failure, one per payload.

    Only the payload crosses to Python; the position columns stay in the JVM and are pruned from the scan where nobody
    reads them.
    """
    return _arrow_udf(avro_decode.decode_batches, avro_decode.decoded_type(reader), reader, writers)(payload)


def java_text(value: Column, kind: str) -> Column:
    """A decoded value of a reader's type as the text that Java prints for it."""
    if kind == "fixed":
        byte = F.transform(
            F.sequence(F.lit(1), F.greatest(F.octet_length(value), F.lit(1))),
            lambda i: F.conv(F.hex(F.substring(value, i, F.lit(1))), 16, 10).cast("int"),
        )
        signed = F.transform(byte, lambda b: F.when(b > 127, b - 256).otherwise(b).cast("string"))
        listed = F.when(F.octet_length(value) == 0, "").otherwise(F.array_join(signed, ", "))
        return F.when(value.isNotNull(), F.concat(F.lit("["), listed, F.lit("]")))
    if kind == "bytes":
        size = F.octet_length(value)
        return F.when(value.isNotNull(), F.format_string("java.nio.HeapByteBuffer[pos=0 lim=%1$d cap=%1$d]", size))
    # Numbers and booleans are printed by Java itself, text stays.
    return value.cast("string")


def encode_record(schema_json: str, values: dict[str, Column]) -> Column:
    """Payload of one flat record; a null in a field that is not a union with null gives a null payload.

    ``values`` maps field name to column; times must be given as epoch milliseconds.
    """
    fields = avro_encode.flat_fields(schema_json)
    absent = [name for name, _, _ in fields if name not in values]
    if absent:
        raise ValueError(f"no column given for fields {absent}")
    record = F.struct(*[values[name].cast(avro_encode.SPARK_TYPES[kind]).alias(name) for name, kind, _ in fields])
    return _arrow_udf(avro_encode.encode_batches, "binary", schema_json)(record)


def encode_orders(schema_json: str) -> Column:
    """Payload of an order row under one of the order schemas."""
    values = {name: F.col(name) for name in ("order_id", "customer_id", "customer_segment", "discount_cents")}
    values["total_cents"] = values["total_amount_cents"] = F.col("total_cents")
    values["event_time"] = F.unix_millis(F.col("event_time"))
    return encode_record(schema_json, values)
