"""The operators run over the given tables; one function per registered query.

``events`` rows serve as orders: the event id is the order, the user the customer, the type the segment, the value the
total and the ``k`` property the discount.
"""

from __future__ import annotations

import datetime
import functools
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from schemaflow import schemas
from schemaflow.functions.payloads import encode_orders
from schemaflow.functions.columns import is_date_hour, null_binary
from schemaflow.operators import aggregate as agg
from schemaflow.operators import compat, dedup, metrics, registration, sinks
from schemaflow.operators import validate as val
from schemaflow.plans.batch import run_batch, write_both
from schemaflow.session import scratch_dir, setting, state_on_disk, stored_bytes
from schemaflow.sources import generator, registry, tables, topic_log, topics
from schemaflow.streaming import aggregate as stream_agg
from schemaflow.streaming import ledger
from schemaflow.streaming import sinks as stream_sinks
from schemaflow.streaming.decoded import store_decoded, stream_decoded
from schemaflow.streaming.job import StreamPaths, run_stream

TOPIC = "orders"
SENTINEL = "sentinel"
STATE_BYTES = 8 << 20
# Payloads that no order schema reads. A negative length, nothing, an over-long number, a text longer than what
# follows, null, and an end after two fields.
CORRUPT = ("00010203", "", "FFFFFFFFFFFFFFFFFFFFFF", "0861", None, "02610262")

_v4 = json.loads(schemas.ORDER_V2)
ORDER_WITH_REGION = schemas.order_schema([*_v4["fields"], {"name": "region", "type": "string"}])
ORDER_WITH_REGION_DEFAULT = schemas.order_schema(
    [*_v4["fields"], {"name": "region", "type": "string", "default": "none"}]
)


# ---- inputs ------------------------------------------------------------------------------------------------------


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    # Timestamps in the tables carry no zone and are taken as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def property_k() -> Column:
    return F.coalesce(F.get_json_object("props", "$.k").cast("bigint"), F.lit(0).cast("bigint"))


def event_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type").alias("customer_segment"),
        F.round(F.col("value") * 100).cast("bigint").alias("total_cents"),
        F.col("ts").cast("timestamp").alias("event_time"),
        property_k().alias("discount_cents"),
    )


def customer_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    return joined.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("total_cents"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        F.lit(0).cast("bigint").alias("discount_cents"),
    )


def as_envelopes(orders: DataFrame, schema: str = schemas.ORDER_V2, corrupt: bool = False) -> DataFrame:
    """Orders as topic records; with ``corrupt`` the payload of every tenth order is garbage, of six kinds in turn."""
    number = F.col("order_id").cast("bigint")
    value = encode_orders(schema)
    if corrupt:
        kind = F.pmod(F.floor(number / 10), F.lit(len(CORRUPT))).cast("int") + 1
        value = F.when(number % 10 == 0, F.unhex(F.element_at(F.array(*map(F.lit, CORRUPT)), kind))).otherwise(value)
    partition = F.col("customer_id").cast("bigint") % 4
    return topics.to_envelopes(orders, TOPIC, partition, number, F.col("event_time"), value)


def event_envelopes(spark: SparkSession, sf: str, schema: str = schemas.ORDER_V2, corrupt: bool = False) -> DataFrame:
    return as_envelopes(event_orders(spark, sf), schema, corrupt)


def corrupted_split(spark: SparkSession, sf: str) -> val.Split:
    return val.validate(event_envelopes(spark, sf, corrupt=True), schemas.ORDER_V2, [schemas.ORDER_V1])


# ---- outputs -----------------------------------------------------------------------------------------------------


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as plain date-times."""
    times = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if f.dataType.typeName() == "timestamp"}
    return df.withColumns(times) if times else df


def hexed(df: DataFrame, column: str = "payload") -> DataFrame:
    return zoneless(df.withColumn(column, F.hex(column)))


# ---- window metrics ----------------------------------------------------------------------------------------------


def window_agg_hour(spark, sf):
    return zoneless(agg.aggregate(event_orders(spark, sf), "1 hour"))


def window_agg_day(spark, sf):
    return zoneless(agg.aggregate(event_orders(spark, sf), "1 day"))


def window_agg_orders_day(spark, sf):
    return zoneless(agg.aggregate(customer_orders(spark, sf), "1 day"))


def distinct_with_duplicates(spark, sf):
    """Every order twice, and once more without a time."""
    orders = event_orders(spark, sf)
    untimed = orders.withColumn("event_time", F.lit(None).cast("timestamp"))
    return zoneless(agg.aggregate(orders.unionByName(orders).unionByName(untimed), "1 day"))


def business_filter(spark, sf):
    rule = (F.col("total_cents") > F.col("discount_cents")) & F.col("customer_id").isNotNull()
    return zoneless(agg.aggregate(agg.business_rows(event_orders(spark, sf), rule), "1 day"))


def business_filter_default(spark, sf):
    return zoneless(agg.business_rows(event_orders(spark, sf)))


def segment_filter(spark, sf):
    return zoneless(agg.in_segments(agg.aggregate(event_orders(spark, sf), "1 day"), "error"))


def top1(spark, sf):
    hourly = agg.aggregate(event_orders(spark, sf), "1 hour")
    return zoneless(agg.first_by(hourly, "window_start", "customer_id", "customer_segment"))


def distinct_hours(spark, sf):
    return agg.distinct_values(agg.aggregate(event_orders(spark, sf), "1 hour"), "date_hour")


def hour_pattern(spark, sf):
    hours = distinct_hours(spark, sf)
    return hours.withColumn("matches", is_date_hour(F.col("date_hour")))


def global_sum(spark, sf):
    return agg.total_orders(agg.aggregate(event_orders(spark, sf), "1 hour"))


# ---- split -------------------------------------------------------------------------------------------------------


def envelope_offset_range(spark, sf):
    """A snapshot between two offset specs: whole partitions, an open start and a closed end."""
    starting = json.dumps({TOPIC: {"0": -2, "1": 0, "2": 100, "3": -2}})
    ending = json.dumps({TOPIC: {"0": -1, "1": -1, "2": -1, "3": 5000}})
    picked = topics.read_envelopes(event_envelopes(spark, sf), TOPIC, starting, ending)
    keyed = picked.withColumn("key", null_binary())
    return zoneless(keyed.select("topic", "partition", "offset", "timestamp", F.col("key").isNull().alias("no_key")))


def _halves(spark, sf) -> list[DataFrame]:
    """All events as envelopes, in two appends: offsets up to the middle one, and beyond."""
    envelopes = event_envelopes(spark, sf)
    last = envelopes.agg(F.max("offset")).first()[0] or 0
    return [envelopes.filter(F.col("offset") <= last // 2), envelopes.filter(F.col("offset") > last // 2)]


def topic_snapshot(spark, sf):
    """A stored topic of two appends, read between two offset specs and decoded: one partition left out, one cut at each end."""
    root = scratch_dir(spark, "topic")
    for half in _halves(spark, sf):
        topic_log.append_topic(half, root)
    starting = json.dumps({TOPIC: {"0": -2, "2": 100, "3": -2}})
    ending = json.dumps({TOPIC: {"0": -1, "1": -1, "2": -1, "3": 5000}})
    picked = topic_log.read_stored_topic(spark, root, TOPIC, starting, ending)
    return zoneless(val.validate(picked, schemas.ORDER_V2, [schemas.ORDER_V1]).valid)


def split_valid(spark, sf):
    return zoneless(corrupted_split(spark, sf).valid)


def split_bad(spark, sf):
    return hexed(corrupted_split(spark, sf).bad)


def split_counts(spark, sf):
    return val.split_counts(corrupted_split(spark, sf))


def split_metrics(spark, sf):
    return metrics.split_metrics(corrupted_split(spark, sf))


def decode_v1_as_v2(spark, sf):
    """Payloads of the first version under the second: the discount takes its default."""
    envelopes = event_envelopes(spark, sf, schemas.ORDER_V1)
    return zoneless(val.validate(envelopes, schemas.ORDER_V2, [schemas.ORDER_V1]).valid)


def decode_oldest_first(spark, sf):
    """With a longer reader, the oldest writer accepts the payloads of a newer one and the discount is lost."""
    writers = [schemas.ORDER_V1, schemas.ORDER_V2]
    return zoneless(val.validate(event_envelopes(spark, sf), ORDER_WITH_REGION_DEFAULT, writers).valid)


def decode_newest_first(spark, sf):
    writers = [schemas.ORDER_V1, schemas.ORDER_V2]
    split = val.validate(event_envelopes(spark, sf), ORDER_WITH_REGION_DEFAULT, writers, order="newest_first")
    return zoneless(split.valid)


SEGMENTS = ("view", "click", "purchase", "signup")


def decode_enum_segment(spark, sf):
    """Orders whose segment is an enum, read as text; a fifth segment is beyond the symbols, so its orders are bad.

    An enum is written as the number of its symbol, so the payloads are encoded with an int in its place.
    """
    fields = json.loads(schemas.ORDER_V2)["fields"]
    kind = {"type": "enum", "name": "Segment", "symbols": list(SEGMENTS)}
    numbered, named = (
        schemas.order_schema([{**f, "type": t} if f["name"] == "customer_segment" else f for f in fields])
        for t in ("int", kind)
    )
    place = F.array_position(F.array(*map(F.lit, SEGMENTS)), F.col("customer_segment")) - 1
    number = F.when(place >= 0, place).otherwise(len(SEGMENTS))
    orders = event_orders(spark, sf).withColumn("customer_segment", number)
    return zoneless(val.validate(as_envelopes(orders, numbered), named).valid)


def decode_text_types(spark, sf):
    """Orders whose texts are a long, a boolean and a double with an exponent, read as text."""
    fields = json.loads(schemas.ORDER_V2)["fields"]
    kinds = {"order_id": "long", "customer_id": "boolean", "customer_segment": "double"}
    typed = schemas.order_schema([{**f, "type": kinds.get(f["name"], f["type"])} for f in fields])
    orders = event_orders(spark, sf).withColumns(
        {
            "order_id": F.col("order_id").cast("bigint"),
            "customer_segment": (F.col("order_id").cast("bigint") + 1) * F.lit(1e9),
        }
    )
    envelopes = topics.to_envelopes(
        orders.withColumn("customer_id", F.col("customer_id").cast("bigint") % 2 == 0),
        TOPIC, F.lit(0), F.col("order_id"), F.col("event_time"), encode_orders(typed),
    )
    return zoneless(val.validate(envelopes, typed).valid)


def bad_only(spark, sf):
    return hexed(val.bad_only(event_envelopes(spark, sf)))


def replay_bad(spark, sf):
    """All payloads fail under a reader with a new required field; stored, they decode once the field has a default."""
    failed = val.validate(event_envelopes(spark, sf), ORDER_WITH_REGION).bad
    path = scratch_dir(spark, "replay")
    sinks.write_bad_rows(failed, path)
    replayed = val.replay(spark.read.parquet(path), ORDER_WITH_REGION_DEFAULT, [schemas.ORDER_V2])
    return zoneless(replayed.valid)


def synthetic_orders(spark, sf):
    """Generated orders, one per event, encoded and decoded again."""
    events = generator.order_events(table(spark, sf, "events"), "event_id")
    return zoneless(val.validate(events, schemas.ORDER_V2).valid)


# ---- sinks -------------------------------------------------------------------------------------------------------


def daily(spark, sf) -> DataFrame:
    return agg.aggregate(event_orders(spark, sf), "1 day")


def stale_daily(spark, sf) -> DataFrame:
    """What a first run wrote before discounts were known."""
    return agg.aggregate(event_orders(spark, sf).withColumn("discount_cents", F.lit(0).cast("bigint")), "1 day")


def corrected_daily(spark, sf) -> DataFrame:
    return agg.in_segments(daily(spark, sf), "error")


def parquet_roundtrip(spark, sf):
    path = scratch_dir(spark, "roundtrip")
    sinks.write_aggregates(daily(spark, sf), path)
    return zoneless(tables.read_aggregates(spark, path))


def parquet_append_twice(spark, sf):
    path = scratch_dir(spark, "append")
    sinks.write_aggregates(daily(spark, sf), path, coalesce_to=4)
    sinks.write_aggregates(daily(spark, sf), path, coalesce_to=4)
    return zoneless(tables.read_aggregates(spark, path))


def pruned_read(spark, sf):
    path = scratch_dir(spark, "pruned")
    sinks.write_aggregates(daily(spark, sf), path)
    return zoneless(tables.read_aggregates(spark, path, "2024-01-05-00", "2024-01-20-00", ["click", "purchase"]))


def _database(spark) -> str:
    path = scratch_dir(spark, "db")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def table_append(spark, sf):
    database = _database(spark)
    sinks.write_table(daily(spark, sf), database, "agg_orders")
    name = sinks.write_table(daily(spark, sf), database, "agg_orders")
    return zoneless(tables.read_table(spark, name))


def table_exists(spark, sf):
    """The test before and after the first write, beside the rows of the table."""
    database = _database(spark)
    before = sinks.table_exists(spark, f"{database}.agg_orders")
    name = sinks.write_table(daily(spark, sf), database, "agg_orders")
    tested = {"before": F.lit(before), "after": F.lit(sinks.table_exists(spark, name))}
    return zoneless(tables.read_table(spark, name).withColumns(tested))


def dual_write(spark, sf):
    """The same rows from both places, each marked with its own."""
    database, path = _database(spark), scratch_dir(spark, "dual")
    write_both(daily(spark, sf), path, {"database": database, "table": "agg_orders"})
    stored = tables.read_aggregates(spark, path).withColumn("place", F.lit("files"))
    listed = tables.read_table(spark, f"{database}.agg_orders").withColumn("place", F.lit("table"))
    return zoneless(stored.unionByName(listed))


def dead_letter_daily(spark, sf):
    path = scratch_dir(spark, "letters")
    sinks.write_bad_rows_daily(corrupted_split(spark, sf).bad, path)
    return spark.read.parquet(path).groupBy("dt").agg(F.count(F.lit(1)).alias("bad_count"))


def dead_letter_conditional(spark, sf):
    """A clean split writes nothing, a corrupted one writes its dead letters."""
    clean, path = val.validate(event_envelopes(spark, sf), schemas.ORDER_V2), scratch_dir(spark, "letters")
    split = corrupted_split(spark, sf)
    for side in (clean, split):
        held = val.hold(side)
        sinks.write_bad_rows_if_any(held.bad, path, metrics.snapshot(held)["records_bad"])
        val.release(held)
    return hexed(spark.read.parquet(path))


def bad_summary(spark, sf):
    return stream_sinks.summarize(val.bad_rows(corrupted_split(spark, sf).tagged, with_failure=True))


def dedup_latest(spark, sf):
    path = scratch_dir(spark, "dedup")
    sinks.write_aggregates(sinks.stamped(stale_daily(spark, sf)), path)
    sinks.write_aggregates(sinks.stamped(corrected_daily(spark, sf)), path)
    return zoneless(dedup.latest_writes(tables.read_aggregates(spark, path, stamped=True)).drop("written_at"))


def dynamic_overwrite(spark, sf):
    path = scratch_dir(spark, "overwrite")
    sinks.overwrite_partitions(stale_daily(spark, sf), path)
    sinks.overwrite_partitions(corrected_daily(spark, sf), path)
    return zoneless(tables.read_aggregates(spark, path))


def file_audit(spark, sf):
    """Directories with files in them, from the listing of an output, and how far it is from what the rows say of their files."""
    path = scratch_dir(spark, "audit")
    sinks.write_aggregates(daily(spark, sf), path)
    place = r"date_hour=([^/]+)/customer_segment=([^/]+)/"
    files = sinks.file_audit(spark, path)
    by_place = files.groupBy(
        F.regexp_extract("file_path", place, 1).alias("date_hour"),
        F.regexp_extract("file_path", place, 2).alias("customer_segment"),
    )
    held = tables.read_aggregates(spark, path).select(
        "date_hour", "customer_segment", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")
    )
    held = held.distinct().groupBy("date_hour", "customer_segment")
    held = held.agg(F.count(F.lit(1)).alias("held_files"), F.sum("size").alias("held_bytes"))
    found = by_place.agg(F.count(F.lit(1)).alias("files"), F.sum("file_bytes").alias("bytes"))
    totals = sinks.audit_totals(files)
    rest = totals["parquet_bytes"] - totals["parquet_files"] * totals["mean_parquet_bytes"]
    mean = totals.select(rest.between(F.lit(0), totals["parquet_files"] - 1).alias("mean_is_whole"))
    # The totals are one row.
    return found.join(held, ["date_hour", "customer_segment"], "full").join(F.broadcast(mean), F.lit(True)).select(
        "date_hour",
        "customer_segment",
        (F.col("files") - F.col("held_files")).alias("file_difference"),
        (F.col("bytes") - F.col("held_bytes")).alias("byte_difference"),
        "mean_is_whole",
    )


def batch_run_metrics(spark, sf):
    """The whole batch job: its counters and the size of what it stored."""
    root = scratch_dir(spark, "batch")
    known = order_registry(spark)
    counters = run_batch(
        event_envelopes(spark, sf, corrupt=True), known, TOPIC, f"{root}/out", f"{root}/bad", "1 day"
    )
    stored = tables.read_aggregates(spark, f"{root}/out").agg(
        F.count(F.lit(1)).alias("aggregate_rows"), F.sum("order_count").alias("aggregated_orders")
    )
    letters = spark.read.parquet(f"{root}/bad").agg(F.count(F.lit(1)).alias("stored_bad"))
    counted = {name: F.lit(value).cast("bigint") for name, value in counters.items()}
    return stored.join(letters, F.lit(True)).withColumns(counted)


def order_registry(spark) -> DataFrame:
    """The first two order versions as a registry."""
    rows = [(TOPIC, 1, schemas.ORDER_V1), (TOPIC, 2, schemas.ORDER_V2)]
    return spark.createDataFrame(rows, "subject string, version int, schema string")


# ---- streams -----------------------------------------------------------------------------------------------------


def sentinel(spark) -> DataFrame:
    """One order far in the future, whose time moves the watermark past every real window."""
    row = spark.range(1).select(
        F.lit("-1").alias("order_id"),
        F.lit("-1").alias("customer_id"),
        F.lit(SENTINEL).alias("customer_segment"),
        F.lit(0).cast("bigint").alias("total_cents"),
        F.timestamp_seconds(F.lit(4102444800)).alias("event_time"),
        F.lit(0).cast("bigint").alias("discount_cents"),
    )
    return as_envelopes(row)


def state_count(cores: int, stored: int) -> int:
    """Partitions of keyed state: full rounds of the cores in which none holds more than STATE_BYTES of the stored input."""
    return cores * max(1, -(-stored // (STATE_BYTES * cores)))


def _state_partitions(spark, stored: int = 0):
    """While a stream runs, keyed state is sized by the cores and the input where nobody set a number of shuffle partitions."""
    key = "spark.sql.shuffle.partitions"
    chosen = spark.sparkContext.getConf().get(key) is not None
    sized = state_count(spark.sparkContext.defaultParallelism, stored)
    return setting(spark, key, spark.conf.get(key) if chosen else str(sized))


def _stored_stream(spark, envelopes: DataFrame, label: str) -> tuple[str, DataFrame]:
    root = scratch_dir(spark, label)
    envelopes.write.mode("append").parquet(f"{root}/in")
    return root, topics.stream_envelopes(spark, f"{root}/in")


def _drained(spark, aggregated: DataFrame, root: str) -> DataFrame:
    with _state_partitions(spark):
        query = stream_sinks.write_aggregates(
            aggregated, f"{root}/out", f"{root}/checkpoint", name=root.rsplit("/", 1)[1], available_now=True
        )
        query.awaitTermination()
    return agg.in_segments(tables.read_aggregates(spark, f"{root}/out"), SENTINEL)


def stream_window_agg(spark, sf):
    """Stored envelopes as a stream: split, windows, partitioned output, drained by an available-now trigger."""
    envelopes = event_envelopes(spark, sf, corrupt=True).unionByName(sentinel(spark))
    root, stream = _stored_stream(spark, envelopes, "stream")
    valid = val.validate(stream, schemas.ORDER_V2, [schemas.ORDER_V1]).valid
    return zoneless(_drained(spark, stream_agg.aggregate_stream(valid, "1 day"), root))


def stream_topic_resume(spark, sf):
    """A tail of a stored topic, stopped between two appends and started again: every offset once, none lost."""
    root = scratch_dir(spark, "topic-tail")
    for half in _halves(spark, sf):
        topic_log.append_topic(half, f"{root}/topic")
        stream = topic_log.stream_stored_topic(spark, f"{root}/topic", TOPIC, "earliest", fail_on_loss=True)
        valid = val.validate(stream, schemas.ORDER_V2, [schemas.ORDER_V1]).valid
        writer = valid.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
        stream_sinks.triggered(writer.option("path", f"{root}/out"), None, True).start().awaitTermination()
    return zoneless(spark.read.schema(schemas.ORDER_ROW).parquet(f"{root}/out"))


def stream_ticking(spark, sf):
    """The same under a processing-time trigger, stopped once everything was processed."""
    envelopes = event_envelopes(spark, sf, corrupt=True).unionByName(sentinel(spark))
    root, stream = _stored_stream(spark, envelopes, "ticking")
    valid = val.validate(stream, schemas.ORDER_V2, [schemas.ORDER_V1]).valid
    by_day = stream_agg.aggregate_stream(valid, "1 day")
    with _state_partitions(spark):
        query = stream_sinks.write_aggregates(by_day, f"{root}/out", f"{root}/checkpoint", "1 second")
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    return zoneless(agg.in_segments(tables.read_aggregates(spark, f"{root}/out"), SENTINEL))


def stream_window_agg_exact(spark, sf):
    """Every envelope twice: the order count doubles, the distinct count does not."""
    envelopes = event_envelopes(spark, sf)
    twice = envelopes.unionByName(envelopes).unionByName(sentinel(spark))
    root, stream = _stored_stream(spark, twice, "exact")
    valid = val.validate(stream, schemas.ORDER_V2).valid
    return zoneless(_drained(spark, stream_agg.aggregate_stream_exact(valid, "1 day"), root))


def stream_window_agg_sketch(spark, sf):
    """The estimate stays within its error of the exact count, or within one."""
    root, stream = _stored_stream(spark, event_envelopes(spark, sf).unionByName(sentinel(spark)), "sketch")
    valid = val.validate(stream, schemas.ORDER_V2).valid
    rows = _drained(spark, stream_agg.aggregate_stream_sketch(valid, "1 day"), root)
    off = F.abs(F.col("order_id_distinct") - F.col("order_count"))
    close = off <= F.greatest(F.lit(1.0), F.col("order_count") * 0.2)
    return zoneless(rows.withColumn("close", close).drop("order_id_distinct"))


def stream_sketch_rollup(spark, sf):
    """Hours streamed with mergeable sketches, rolled up to days and segments without the orders."""
    root, stream = _stored_stream(spark, event_envelopes(spark, sf).unionByName(sentinel(spark)), "rollup")
    valid = val.validate(stream, schemas.ORDER_V2).valid
    # More state partitions must not mean more files in each of the many directories.
    writers = max(1, spark.sparkContext.defaultParallelism // 16)
    with _state_partitions(spark, stored_bytes(spark, f"{root}/in")), state_on_disk(spark):
        query = stream_sinks.write_aggregates(
            stream_agg.sketch(valid, "1 hour"), f"{root}/out", f"{root}/checkpoint", available_now=True, writers=writers
        )
        query.awaitTermination()
    hours = agg.in_segments(stream_agg.read_sketches(spark, f"{root}/out"), SENTINEL)
    rows = stream_agg.estimated(stream_agg.roll_up(hours, "1 day", ["customer_segment"]))
    off = F.abs(F.col("order_id_distinct") - F.col("order_count")) / F.col("order_count")
    return zoneless(rows.withColumn("relative_error", F.round(off, 1)))


def late_drop(spark, sf):
    """Every seventh order arrives after all others were processed; those whose day has closed are dropped.

    Three runs on one checkpoint: the punctual orders, the late ones, the sentinel.
    """
    envelopes = event_envelopes(spark, sf)
    late = F.col("offset") % 7 == 0
    root, stream = _stored_stream(spark, envelopes.filter(~late), "late")
    by_day = stream_agg.aggregate_stream(val.validate(stream, schemas.ORDER_V2).valid, "1 day", "1 hour")
    _drained(spark, by_day, root)
    envelopes.filter(late).write.mode("append").parquet(f"{root}/in")
    _drained(spark, by_day, root)
    sentinel(spark).write.mode("append").parquet(f"{root}/in")
    landed = _drained(spark, by_day, root)
    return landed.groupBy("date_hour", "customer_segment").agg(
        F.sum("order_count").alias("order_count"), F.sum("net_cents_sum").alias("net_cents_sum")
    )


def _streamed_job(spark, sf, label: str) -> StreamPaths:
    envelopes = event_envelopes(spark, sf, corrupt=True).unionByName(sentinel(spark))
    root, stream = _stored_stream(spark, envelopes, label)
    paths = StreamPaths(f"{root}/out", f"{root}/checkpoint", f"{root}/bad", f"{root}/summary")
    name = root.rsplit("/", 1)[1]
    with _state_partitions(spark):
        queries = run_stream(stream, order_registry(spark), TOPIC, paths, "1 day", name=name, available_now=True)
        for query in queries:
            query.awaitTermination()
    return paths


def stream_job(spark, sf):
    """The whole streaming job; its metrics."""
    paths = _streamed_job(spark, sf, "job")
    return zoneless(agg.in_segments(tables.read_aggregates(spark, paths.output), SENTINEL))


def stream_dead_letters(spark, sf):
    """The whole streaming job; its dead letters next to the counts of the per-batch summaries."""
    paths = _streamed_job(spark, sf, "letters")
    letters = tables.read_dead_letters(spark, paths.bad).drop("dt")
    summary = spark.read.parquet(paths.bad_summary)
    totals = summary.agg(
        F.sum("bad_count").alias("summed_count"), F.min("sample_reason").alias("sample_reason")
    )
    # The totals are one row.
    return hexed(letters.join(F.broadcast(totals), F.lit(True)))


def stream_dead_letters_daily(spark, sf):
    """The whole streaming job; its dead letters of ten days, read from the directories of those days only."""
    paths = _streamed_job(spark, sf, "daily")
    days = datetime.date(2024, 1, 5), datetime.date(2024, 1, 14)
    return tables.read_dead_letters(spark, paths.bad, *days).groupBy("dt").agg(F.count(F.lit(1)).alias("bad_count"))


def _stored_letters(spark, sf, label: str) -> str:
    """A stream of several micro-batches decoded once, its dead letters, and its counters; the folder they are in."""
    envelopes = event_envelopes(spark, sf, corrupt=True).repartition(3)
    root, _ = _stored_stream(spark, envelopes, label)
    stream = topics.stream_envelopes(spark, f"{root}/in", files_per_trigger=1)
    tagged = val.validate(stream, schemas.ORDER_V2, [schemas.ORDER_V1]).tagged
    store_decoded(tagged, f"{root}/rows", f"{root}/decode", available_now=True).awaitTermination()
    rows = stream_decoded(spark, f"{root}/rows", tagged.schema, files_per_trigger=2)
    stream_sinks.write_dead_letters(
        rows, f"{root}/bad", f"{root}/summary", f"{root}/letters", available_now=True, counters_path=f"{root}/counters"
    ).awaitTermination()
    return root


def stream_metrics(spark, sf):
    """Counters that a stream stored for each of its micro-batches, added up."""
    root = _stored_letters(spark, sf, "counted")
    totals = metrics.stream_totals(metrics.batch_counters(spark, f"{root}/counters"))
    return totals.select(*metrics.COUNTERS)


def stream_dead_letters_compacted(spark, sf):
    """Dead letters of several micro-batches, closed by day: what each day holds, and in how many files."""
    root = _stored_letters(spark, sf, "closed")
    ledger.close_days(spark, f"{root}/bad", schemas.BAD_ROW)
    letters = tables.read_dead_letters(spark, f"{root}/bad").withColumn("file", F.input_file_name())
    return letters.groupBy("dt").agg(
        F.count(F.lit(1)).alias("bad_count"), F.sum("offset").alias("offsets"), F.count_distinct("file").alias("files")
    )


# ---- schema registries -------------------------------------------------------------------------------------------

# The types that derived schemas draw from, and a default for each.
DERIVED_TYPES = ("int", "long", "float", "double", "string", "bytes", "boolean")
DERIVED_DEFAULTS = ("0", "0", "0.0", "0.0", '""', '""', "false")
DERIVED_WIDTH = 6
DERIVED_SPACE = "fixtures.events"


def derived_schema(number: Column, k: Column) -> Column:
    """Avro schema text whose fields, types, defaults, aliases and record name depend on two numbers of a row."""

    def kind(h: Column, place: int) -> Column:
        plain = f'"{DERIVED_TYPES[place]}"'
        if DERIVED_TYPES[place] != "long":
            return F.lit(plain)
        return F.when(h % 2 == 1, '{"type":"long","logicalType":"timestamp-millis"}').otherwise(plain)

    def field(j: int) -> Column:
        h = (number * 31 + k * 17 + j * 101) % 97
        shifted = h % 11 == 3
        places = (j + 1) % 7, j % 7
        base = F.when(shifted, kind(h, places[0])).otherwise(kind(h, places[1]))
        default = F.when(shifted, DERIVED_DEFAULTS[places[0]]).otherwise(DERIVED_DEFAULTS[places[1]])
        nullable = h % 7 == 1
        text = F.concat(
            F.when(h % 13 == 2, f'{{"name":"g{j}","type":').otherwise(f'{{"name":"f{j}","type":'),
            F.when(nullable, F.concat(F.lit('["null",'), base, F.lit("]"))).otherwise(base),
            F.when((h % 13 == 2) & (h % 2 == 0), f',"aliases":["f{j}"]').otherwise(""),
            F.when(h % 3 != 0, "}")
            .when(nullable, ',"default":null}')
            .otherwise(F.concat(F.lit(',"default":'), default, F.lit("}"))),
        )
        return F.when(h % 5 != 0, text)

    return F.concat(
        F.lit('{"type":"record","name":"'),
        F.when(k % 10 == 0, "Purchase").otherwise("Order"),
        F.lit(f'","namespace":"{DERIVED_SPACE}"'),
        F.when(k % 20 == 0, ',"aliases":["Order"]').otherwise(""),
        F.lit(',"fields":['),
        F.concat_ws(",", *[field(j) for j in range(DERIVED_WIDTH)]),
        F.lit("]}"),
    )


def event_registry(spark, sf) -> DataFrame:
    """A registry with one subject per user and one version per event."""
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("subject"),
        (F.col("event_id") + 1).cast("int").alias("version"),
        derived_schema(F.col("event_id"), property_k()).alias("schema"),
    )


def registry_fields(spark, sf):
    rows = compat.schema_fields(event_registry(spark, sf))
    return rows.withColumn("aliases", F.array_join("aliases", ","))


def registry_scan(spark, sf):
    """A registry stored as one file per supplier, scanned back and flattened."""
    supplier = table(spark, sf, "supplier")
    stored = supplier.select(
        F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("subject"),
        (F.col("s_suppkey") + 1).cast("int").alias("version"),
        derived_schema(F.col("s_suppkey").cast("bigint"), F.col("s_nationkey").cast("bigint")).alias("schema"),
    )
    root = scratch_dir(spark, "registry")
    registry.store_registry(stored, root)
    rows = compat.schema_fields(registry.read_registry(spark, root))
    return rows.withColumn("aliases", F.array_join("aliases", ","))


def registry_latest(spark, sf):
    return registration.latest(event_registry(spark, sf))


def registry_subjects(spark, sf):
    return registration.subjects(event_registry(spark, sf))


def _checked(spark, sf, level: str) -> DataFrame:
    return compat.check_consecutive(event_registry(spark, sf), level)


def compat_backward(spark, sf):
    return compat.violation_rows(_checked(spark, sf, "backward"), "backward")


def compat_forward(spark, sf):
    return compat.violation_rows(_checked(spark, sf, "forward"), "forward")


def compat_full(spark, sf):
    return compat.violation_rows(_checked(spark, sf, "full"), "full")


def compat_none(spark, sf):
    return compat.reports(_checked(spark, sf, "none"))


def compat_report(spark, sf):
    return compat.reports(_checked(spark, sf, "backward"))


LEVEL_NAMES = ("BACKWARD", "Forward", "fuLL", "None")


def compat_levels(spark, sf):
    """Violations at every level, which are named in any case."""
    rows = []
    for name in LEVEL_NAMES:
        level = compat.parse_level(name)
        found = compat.violation_rows(_checked(spark, sf, name), level)
        rows.append(found.agg(F.lit(level).alias("level"), F.count(F.lit(1)).alias("violations")))
    return functools.reduce(DataFrame.unionByName, rows)


def pair_check(spark, sf):
    """The first version of every subject against its last."""
    known = event_registry(spark, sf)
    ends = known.groupBy("subject").agg(F.min("version").alias("old_version"), F.max("version").alias("new_version"))
    return compat.reports(compat.check(compat.chosen_pairs(compat.with_docs(known), ends, "doc"), "full"))


def register_gate(spark, sf):
    """One candidate per customer; those without a version so far are accepted unchecked."""
    customer = table(spark, sf, "customer")
    candidates = customer.select(
        F.col("c_custkey").cast("string").alias("subject"),
        derived_schema(F.col("c_custkey").cast("bigint"), (F.col("c_nationkey") * 4).cast("bigint")).alias("schema"),
    )
    decided = registration.register(event_registry(spark, sf), candidates, "backward")
    kinds = F.array_join(F.transform("violations", lambda v: v["kind"]), ",").alias("kinds")
    return decided.select("subject", "schema", "accepted", "version", "report", kinds)


def register_sequence(spark, sf):
    """Four candidates per customer in turn, each against the last one accepted; the third differs from the others."""
    number = F.col("c_custkey").cast("bigint") + F.when(F.col("ord") == 2, 1).otherwise(0)
    candidates = table(spark, sf, "customer").withColumn("ord", F.explode(F.sequence(F.lit(0), F.lit(3)))).select(
        F.col("c_custkey").cast("string").alias("subject"),
        "ord",
        derived_schema(number, (F.col("c_nationkey") * 4).cast("bigint")).alias("schema"),
    )
    decided = registration.register_sequence(event_registry(spark, sf), candidates, "backward")
    return decided.select("subject", "ord", "schema", "accepted", "version", "report")


def register_fingerprints(spark, sf):
    """The layouts of every subject by the fingerprint of their canonical form."""
    found = registration.layouts(event_registry(spark, sf))
    return found.select("subject", "fingerprint", "version", "versions")


REFERRED = ("string", "Color", "q.Size", "p.Part")


def compat_references(spark, sf):
    """Versions whose last field names types that earlier fields define, in odd key orders and other namespaces."""
    kind = F.element_at(F.array(*map(F.lit, REFERRED)), (F.col("event_id") % 4 + 1).cast("int"))
    text = F.concat(
        F.lit('{"fields":[{"type":{"symbols":["A"],"doc":"one of {x}","name":"Color","type":"enum"},"name":"a"},'),
        F.lit('{"name":"b","type":{"size":2,"namespace":"q","type":"fixed","name":"Size"}},'),
        F.lit('{"name":"d","type":{"type":{"type":{"fields":[],"name":"p.Part","type":"record"}}}},'),
        F.lit('{"name":"c","type":'),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('["null","'), kind, F.lit('"]'))).otherwise(
            F.concat(F.lit('"'), kind, F.lit('"'))
        ),
        F.lit('}],"name":"Order","type":"record"}'),
    )
    known = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("subject"),
        (F.col("event_id") + 1).cast("int").alias("version"),
        text.alias("schema"),
    )
    return compat.violation_rows(compat.check_consecutive(known, "backward"), "backward")


# Candidates for registration and what is wrong with them.
CANDIDATES = {
    '{"type":"record","name":"R","fields":[]}': None,
    "hello, not a schema": "the text is not JSON",
    '{"type":"record","name":"R","fields":[{"name":"a","type":"strnig"}]}': "unknown type name strnig",
    '{"type":"record","name":"R","fields":[{"name":"a","type":"int"},{"name":"a","type":"int"}]}': (
        "record R has field a twice"
    ),
    '{"type":"record","name":"R","fields":[{"name":"a","type":"long","default":"x"}]}': (
        "field a has a default that does not fit its type"
    ),
}


def register_invalid(spark, sf):
    """One candidate per customer for a new subject; those that are no valid schema are refused with a report."""
    texts = F.array(*map(F.lit, CANDIDATES))
    candidates = table(spark, sf, "customer").select(
        F.concat(F.lit("new "), F.col("c_custkey").cast("string")).alias("subject"),
        F.element_at(texts, (F.col("c_custkey") % len(CANDIDATES) + 1).cast("int")).alias("schema"),
    )
    decided = registration.register(event_registry(spark, sf), candidates, "backward")
    return decided.select("subject", "schema", "accepted", "version", "report")


QUERIES = {
    f.__name__: f
    for f in (
        window_agg_hour,
        window_agg_day,
        window_agg_orders_day,
        distinct_with_duplicates,
        business_filter,
        business_filter_default,
        segment_filter,
        top1,
        distinct_hours,
        hour_pattern,
        global_sum,
        envelope_offset_range,
        topic_snapshot,
        split_valid,
        split_bad,
        split_counts,
        split_metrics,
        decode_v1_as_v2,
        decode_oldest_first,
        decode_newest_first,
        decode_enum_segment,
        decode_text_types,
        bad_only,
        replay_bad,
        synthetic_orders,
        parquet_roundtrip,
        parquet_append_twice,
        pruned_read,
        table_append,
        table_exists,
        dual_write,
        dead_letter_daily,
        dead_letter_conditional,
        bad_summary,
        dedup_latest,
        dynamic_overwrite,
        file_audit,
        batch_run_metrics,
        stream_window_agg,
        stream_topic_resume,
        stream_ticking,
        stream_window_agg_exact,
        stream_window_agg_sketch,
        stream_sketch_rollup,
        late_drop,
        stream_job,
        stream_dead_letters,
        stream_dead_letters_daily,
        stream_metrics,
        stream_dead_letters_compacted,
        registry_fields,
        registry_scan,
        registry_latest,
        registry_subjects,
        compat_backward,
        compat_forward,
        compat_full,
        compat_none,
        compat_report,
        compat_levels,
        pair_check,
        register_gate,
        register_sequence,
        register_fingerprints,
        compat_references,
        register_invalid,
    )
}
