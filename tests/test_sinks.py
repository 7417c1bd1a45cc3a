from __future__ import annotations

import datetime as dt

from conftest import plan_of
from fixtures import DAY, batch_fixture, orders
from pyspark.sql import functions as F

from schemaflow import session
from schemaflow.operators import dedup, sinks
from schemaflow.operators import validate as val
from schemaflow.operators.aggregate import aggregate
from schemaflow.plans.batch import run_batch, write_both
from schemaflow.schemas import ORDER_V1, ORDER_V2, ORDER_V3
from schemaflow.sources import tables


def sample(spark, n=50):
    """Aggregate rows as a table fixture: customers over five hours and two segments."""
    i = F.col("id")
    start = F.timestamp_seconds(F.lit(int(DAY.timestamp())) + (i % 5) * 3600)
    return spark.range(n).select(
        F.format_string("customer-%05d", i).alias("customer_id"),
        F.when(i % 2 == 0, "retail").otherwise("wholesale").alias("customer_segment"),
        start.alias("window_start"),
        (start + F.expr("INTERVAL 1 HOUR")).alias("window_end"),
        F.date_format(start, "yyyy-MM-dd-HH").alias("date_hour"),
        (i + 1).alias("order_count"),
        ((i + 1) * 1000).alias("net_cents_sum"),
        F.lit(1000.0).alias("net_cents_avg"),
        F.lit(1000).cast("bigint").alias("net_cents_max"),
        (i + 1).alias("order_id_distinct"),
    )


def test_append_doubles_and_dedup_restores(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_aggregates(sinks.stamped(sample(spark)), path)
    newer = sample(spark).withColumn("order_count", F.col("order_count") + 100)
    sinks.write_aggregates(sinks.stamped(newer), path, coalesce_to=0)
    stored = tables.read_aggregates(spark, path, stamped=True)
    assert stored.count() == 100
    latest = dedup.latest_writes(stored)
    assert latest.columns == stored.columns
    assert latest.count() == 50
    assert latest.agg(F.min("order_count")).first()[0] == 101


def test_dedup_is_decided_by_the_other_columns_at_equal_times(spark):
    stamp = F.lit(DAY)
    twice = sample(spark, 3).withColumn("written_at", stamp)
    more = twice.withColumn("order_count", F.lit(99).cast("bigint"))
    rows = dedup.latest_writes(twice.unionByName(more)).collect()
    assert [r["order_count"] for r in rows] == [99] * 3


def test_layout_and_types(spark, tmp_path):
    path = str(tmp_path / "out")
    numbered = sample(spark).withColumn("customer_segment", F.when(F.col("customer_segment") == "retail", "01").otherwise("02"))
    sinks.write_aggregates(numbered, path)
    stored = tables.read_aggregates(spark, path)
    assert {r[0] for r in stored.select("customer_segment").distinct().collect()} == {"01", "02"}
    assert stored.schema["date_hour"].dataType.typeName() == "string"
    assert stored.select("date_hour").distinct().count() == 5


def test_reads_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_aggregates(sample(spark), path)
    picked = tables.read_aggregates(spark, path, "2026-01-01-01", "2026-01-01-02", ["retail"])
    assert picked.count() == 10
    plan = plan_of(picked)
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "date_hour" in filters and "customer_segment" in filters


def test_overwrite_replaces_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.overwrite_partitions(sample(spark), path)
    changed = sample(spark).filter("date_hour = '2026-01-01-00'").withColumn("order_count", F.lit(0).cast("bigint"))
    for _ in range(2):
        sinks.overwrite_partitions(changed, path)
    stored = tables.read_aggregates(spark, path)
    assert stored.count() == 50
    assert {r["date_hour"] for r in stored.filter("order_count = 0").collect()} == {"2026-01-01-00"}


def test_rebalance_keeps_files_few(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_aggregates(sample(spark, 1000).repartition(8), path)
    totals = sinks.audit_totals(sinks.file_audit(spark, path)).first()
    assert totals["parquet_files"] == 10
    assert totals["mean_parquet_bytes"] == totals["parquet_bytes"] // 10


def test_audit_of_an_empty_place(spark, tmp_path):
    assert sinks.audit_totals(sinks.file_audit(spark, str(tmp_path))).first().asDict() == {
        "parquet_files": 0,
        "parquet_bytes": 0,
        "mean_parquet_bytes": 0,
    }


def test_table_is_created_then_appended(spark):
    assert not sinks.table_exists(spark, "sink_db.agg")
    name = sinks.write_table(sample(spark, 10), "sink_db", "agg")
    assert sinks.table_exists(spark, name)
    sinks.write_table(sample(spark, 5), "sink_db", "agg")
    stored = tables.read_table(spark, name)
    assert stored.count() == 15
    first = stored.orderBy("customer_id", "order_count").first()
    assert (first["order_count"], first["net_cents_sum"]) == (1, 1000)
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()][0].startswith("date_hour=")


def test_write_both(spark, tmp_path):
    path = str(tmp_path / "out")
    write_both(sample(spark), path, {"database": "both_db", "table": "agg"})
    assert tables.read_aggregates(spark, path).count() == tables.read_table(spark, "both_db.agg").count() == 50


def test_dead_letters(spark, tmp_path):
    bad = val.validate(batch_fixture(spark), ORDER_V2, [ORDER_V1]).bad
    plain, daily, none = (str(tmp_path / n) for n in ("plain", "daily", "none"))
    sinks.write_bad_rows(bad, plain)
    sinks.write_bad_rows(bad, plain)
    assert spark.read.parquet(plain).count() == 10
    sinks.write_bad_rows_daily(bad, daily)
    assert [r["dt"] for r in spark.read.parquet(daily).select("dt").distinct().collect()] == [dt.date(2026, 1, 1)]
    assert not sinks.write_bad_rows_if_any(bad, none, 0)
    assert not (tmp_path / "none").exists()


def test_dead_letters_make_few_files(spark, tmp_path):
    day = F.timestamp_seconds(F.lit(int(DAY.timestamp())) + (F.col("id") % 30) * 86400)
    bad = spark.range(0, 1000, 1, 40).select(
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        day.alias("timestamp"),
        F.unhex(F.lit("00")).alias("payload"),
        F.lit("r").alias("reason"),
    )
    plain, daily = str(tmp_path / "plain"), str(tmp_path / "daily")
    sinks.write_bad_rows(bad, plain)
    sinks.write_bad_rows_daily(bad, daily)
    count = lambda path: sinks.audit_totals(sinks.file_audit(spark, path)).first()["parquet_files"]
    assert count(plain) <= 2 and count(daily) == 30
    assert tables.read_dead_letters(spark, daily, DAY.date(), DAY.date()).count() == 34


def test_settings_and_scratch_are_as_before(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with session.setting(spark, key, "77"), session.scratch(spark, "gone") as path:
        assert spark.conf.get(key) == "77"
        spark.range(3).write.parquet(path)
    assert spark.conf.get(key) == before
    try:
        spark.read.parquet(path)
    except Exception as error:
        assert "PATH_NOT_FOUND" in str(error)
    else:
        raise AssertionError("the scratch folder is still there")


def test_batch_job(spark, tmp_path):
    rows = [("orders", 2, ORDER_V2), ("orders", 1, ORDER_V1)]
    registry = spark.createDataFrame(rows, "subject string, version int, schema string")
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    table = {"database": "job_db", "table": "agg"}
    counters = run_batch(batch_fixture(spark), registry, "orders", out, bad, "1 hour", table)
    assert (counters["records_in"], counters["records_valid"], counters["records_bad"]) == (50, 45, 5)
    stored = tables.read_aggregates(spark, out)
    assert stored.agg(F.sum("order_count")).first()[0] == 45
    assert tables.read_table(spark, "job_db.agg").count() == stored.count() == 9
    assert spark.read.parquet(bad).count() == 5
    clean = aggregate(orders(spark, [("o", "c", "S", 1, 1, 0)]), "1 hour")
    assert clean.count() == 1


def test_batch_job_needs_a_usable_reader(spark, tmp_path):
    registry = spark.createDataFrame([("orders", 3, ORDER_V3)], "subject string, version int, schema string")
    try:
        run_batch(batch_fixture(spark), registry, "orders", str(tmp_path / "o"), str(tmp_path / "b"))
    except ValueError as error:
        assert "total_cents" in str(error)
    else:
        raise AssertionError("a reader without total_cents was accepted")


def test_catalog_options_keep_present_extensions():
    options = session.catalog_options("/lake", "lake", "a.B, c.D")
    assert options["spark.sql.extensions"] == f"a.B,c.D,{session.ICEBERG_EXTENSION}"
    assert options["spark.sql.catalog.lake.warehouse"] == "/lake"
    again = session.catalog_options("/lake", "lake", options["spark.sql.extensions"])
    assert again == options


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = session.scratch_dir(spark, "x"), session.scratch_dir(spark, "x")
    assert one.startswith(shared) and one != two
