from __future__ import annotations

import datetime as dt

from conftest import plan_of
from fixtures import DAY, orders

from schemaflow.operators import aggregate as agg
from schemaflow.schemas import AGGREGATE_COLUMNS


def test_grain(spark):
    rows = [("o1", "c1", "S", 1000, 600, 0), ("o2", "c1", "S", 2000, 630, 100), ("o3", "c1", "S", 500, 660, 0)]
    out = agg.aggregate(orders(spark, [*rows, ("o4", "c2", "P", 700, 600, 0)]), "1 hour")
    assert out.columns == AGGREGATE_COLUMNS
    assert out.count() == 3
    row = out.filter("customer_id = 'c1' and date_hour = '2026-01-01-10'").first()
    assert (row["order_count"], row["net_cents_sum"]) == (2, 2900)
    assert row["window_end"] - row["window_start"] == dt.timedelta(hours=1)


def test_duplicates_count_once_as_distinct(spark):
    rows = [("o1", "c1", "S", 1000, m, 0) for m in (600, 630)] + [("o2", "c1", "S", 1000, 645, 0)]
    row = agg.aggregate(orders(spark, rows), "1 hour").first()
    assert (row["order_count"], row["order_id_distinct"]) == (3, 2)


def test_metrics_are_net_of_discount(spark):
    rows = [("o1", "c1", "S", 1000, 600, 100), ("o2", "c1", "S", 2000, 630, 500)]
    row = agg.aggregate(orders(spark, rows), "1 hour").first()
    assert (row["net_cents_max"], row["net_cents_avg"]) == (1500, 1200.0)


def test_rows_without_a_time_or_an_id(spark):
    rows = [("o1", "c1", "S", 10, None, 0), (None, "c1", "S", 10, 5, 0), ("o2", "c1", "S", 10, 5, 0)]
    out = agg.aggregate(orders(spark, rows), "1 hour").collect()
    assert [(r["order_count"], r["order_id_distinct"]) for r in out] == [(2, 1)]


def test_hot_customer_is_spread_by_order_id(spark):
    plan = plan_of(agg.aggregate(orders(spark, [("o", "c", "S", 1, 1, 0)]), "1 hour"))
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2
    assert plan.count("HashAggregate") == 4
    assert any("order_id" in line for line in exchanges)


def test_small_operators(spark):
    rows = [("o1", "c1", "S", 0, 0, 0), ("o2", None, "S", 5, 0, 0), ("o3", "c2", "P", 5, 70, 0)]
    df = orders(spark, rows)
    assert [r["order_id"] for r in agg.business_rows(df).collect()] == ["o3"]
    out = agg.aggregate(df, "1 hour")
    assert [r["customer_segment"] for r in agg.in_segments(out, "S").collect()] == ["P"]
    assert agg.total_orders(out).first()["order_count"] == 3
    assert agg.distinct_values(out, "date_hour").count() == 2
    top = agg.first_by(out, "window_start", "customer_id")
    assert top.first()["window_start"].replace(tzinfo=dt.timezone.utc) == DAY
    assert "TakeOrderedAndProject" in plan_of(top)
