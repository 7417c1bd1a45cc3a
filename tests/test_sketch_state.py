from __future__ import annotations

import datetime as dt
import glob

from pyspark.sql import functions as F

from schemaflow.plans import table_queries
from schemaflow.session import STATE_PROVIDER, scratch_dir, state_on_disk


def test_rollup_keeps_its_state_on_disk(spark, tmp_path):
    """Many small groups: what they hold lies in logs of a disk store, and all orders are in the result."""
    n = 3000
    i = F.col("id")
    events = spark.range(n).select(
        i.alias("event_id"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp") + F.make_dt_interval(hours=i % 48)).cast("timestamp_ntz").alias("ts"),
        (i % 997).alias("user_id"),
        F.when(i % 2 == 0, "view").otherwise("click").alias("event_type"),
        (i % 100).cast("double").alias("value"),
        F.lit('{"k": 1}').alias("props"),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    base = scratch_dir(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
    before = set(glob.glob(f"{base}/rollup-*"))
    rows = table_queries.stream_sketch_rollup(spark, str(tmp_path)).collect()
    assert sum(r.order_count for r in rows) == n and len(rows) == 4
    assert all(abs(r.order_id_distinct / r.order_count - 1) < 0.1 for r in rows)
    (root,) = set(glob.glob(f"{base}/rollup-*")) - before
    assert glob.glob(f"{root}/checkpoint/state/0/*/*.changelog")
    assert not glob.glob(f"{root}/checkpoint/state/0/*/*.delta")
    assert spark.conf.get(STATE_PROVIDER, None) is None


def test_a_chosen_state_store_stays(spark):
    chosen = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(STATE_PROVIDER, chosen)
    try:
        with state_on_disk(spark):
            assert spark.conf.get(STATE_PROVIDER) == chosen
        assert spark.conf.get(STATE_PROVIDER) == chosen
    finally:
        spark.conf.unset(STATE_PROVIDER)
    with state_on_disk(spark):
        assert "RocksDB" in spark.conf.get(STATE_PROVIDER)
    assert spark.conf.get(STATE_PROVIDER, None) is None


def test_state_partitions_grow_with_the_input():
    full = table_queries.STATE_BYTES
    count = table_queries.state_count
    assert [count(8, n) for n in (0, 1, 8 * full, 8 * full + 1, 50 * full)] == [8, 8, 8, 16, 56]
