"""Tables that micro-batches write, and days of them closed into few files.

A batch owns the directories ``dt=…/query=…/batch=…`` and overwrites them when it is run again. Closing a day writes all its
batches into a new directory below ``_closed`` and then one numbered file below ``_ledger``, which names that directory and
the batches it holds. Whoever creates the next number first has closed the day; a reader takes the last number of each day,
that directory, and the batches it does not name. A batch that was written again after its day was closed is named, so it
does not count twice. Nothing that readers may still use is removed until :func:`clean` is called with a grace period.
"""

from __future__ import annotations

import datetime
import json
import time
import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaflow.storage import listed, put_if_absent, remove

PLACE = [
    T.StructField("dt", T.DateType()),
    T.StructField("query", T.StringType()),
    T.StructField("batch", T.LongType()),
]


class Closed(NamedTuple):
    """The last ledger entry of a day: its number, the directory, and the ranges of batches of each query in it."""

    number: int
    place: str
    folded: dict[str, list[list[int]]]


def replace_batch(rows: DataFrame, path: str) -> None:
    """Replace what this batch stored before and nothing else; ``rows`` have the columns of PLACE."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*(f.name for f in PLACE)).parquet(path)


def _days(names: list[str], first: datetime.date | None, last: datetime.date | None) -> list[datetime.date]:
    """Days among directory names, within bounds. Rows without a day have none and are never closed."""
    days = []
    for name in names:
        try:
            days.append(datetime.date.fromisoformat(name.removeprefix("dt=")))
        except ValueError:
            continue
    return [d for d in days if (first is None or d >= first) and (last is None or d <= last)]


def closed_days(
    spark: SparkSession, path: str, first: datetime.date | None = None, last: datetime.date | None = None
) -> dict[datetime.date, Closed]:
    """The ledger's last entry of every day. The driver holds one entry a day."""
    newest = {}
    for day in _days([name for name, _ in listed(spark, f"{path}/_ledger")], first, last):
        files = [name for name, _ in listed(spark, f"{path}/_ledger/dt={day}") if name.endswith(".json")]
        if files:
            newest[f"{path}/_ledger/dt={day}/{files[-1]}"] = day, int(files[-1].removesuffix(".json"))
    if not newest:
        return {}
    texts = spark.read.text(list(newest), wholetext=True).select("value").collect()
    entries = {e["day"]: e for e in (json.loads(t["value"]) for t in texts)}
    return {
        day: Closed(number, entries[str(day)]["place"], entries[str(day)]["folded"]) for day, number in newest.values()
    }


def _named(day: datetime.date, entry: Closed) -> Column:
    """Whether the batch of a row is among those that an entry names."""
    ranges = [
        (F.col("query") == query) & F.col("batch").between(low, high)
        for query, parts in entry.folded.items()
        for low, high in parts
    ]
    return (F.col("dt") == F.lit(day)) & reduce(lambda a, b: a | b, ranges, F.lit(False))


def read_batches(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    first: datetime.date | None = None,
    last: datetime.date | None = None,
) -> DataFrame:
    """The rows of all batches, with ``schema`` and the columns of PLACE; only the days from ``first`` to ``last`` are read.

    Each row is read once whether its day is open, closed, or being closed meanwhile.
    """
    closed = closed_days(spark, path, first, last)
    names = [*schema.fieldNames(), *(f.name for f in PLACE)]
    full = T.StructType([*schema.fields, *PLACE])
    rows = spark.read.schema(full).parquet(path).select(*names)
    if first is not None:
        rows = rows.filter(F.col("dt") >= F.lit(first))
    if last is not None:
        rows = rows.filter(F.col("dt") <= F.lit(last))
    for day, entry in closed.items():
        rows = rows.filter(F.coalesce(~_named(day, entry), F.lit(True)))
    if closed:
        places = [f"{path}/_closed/{entry.place}" for entry in closed.values()]
        rows = rows.unionByName(spark.read.schema(full).parquet(*places).select(*names))
    return rows


def _with(folded: dict[str, list[list[int]]], batches: list[tuple[str, int]]) -> dict[str, list[list[int]]]:
    """Ranges of batches by query, with more batches."""
    numbers: dict[str, set[int]] = {}
    for query, batch in batches:
        numbers.setdefault(query, set()).add(batch)
    out = {}
    for query in {*folded, *numbers}:
        parts = sorted([*map(list, folded.get(query, [])), *([b, b] for b in numbers.get(query, ()))])
        joined = [parts[0]]
        for low, high in parts[1:]:
            if low <= joined[-1][1] + 1:
                joined[-1][1] = max(joined[-1][1], high)
            else:
                joined.append([low, high])
        out[query] = joined
    return out


def open_batches(spark: SparkSession, path: str, day: datetime.date, entry: Closed | None) -> list[tuple[str, int]]:
    """Batches of a day that have a directory and are not in the ledger."""
    folded = entry.folded if entry else {}
    found = []
    for query, _ in listed(spark, f"{path}/dt={day}"):
        name = query.removeprefix("query=")
        for batch, _ in listed(spark, f"{path}/dt={day}/{query}"):
            number = int(batch.removeprefix("batch="))
            if not any(low <= number <= high for low, high in folded.get(name, [])):
                found.append((name, number))
    return found


def close_days(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    first: datetime.date | None = None,
    last: datetime.date | None = None,
) -> list[datetime.date]:
    """Write the open batches of the days from ``first`` to ``last``, with what was closed before, into few files; returns the days
    that this call closed.

    One write serves all days. Batches that arrive meanwhile stay open. Where another call closes a day first, this one gives
    way and removes what it wrote for that day. The driver lists directories, one a batch, and never reads rows.
    """
    closed = closed_days(spark, path, first, last)
    days = _days([name for name, _ in listed(spark, path)], first, last)
    todo = {day: found for day in days if (found := open_batches(spark, path, day, closed.get(day)))}
    if not todo:
        return []
    full = T.StructType([*schema.fields, *PLACE])
    own = uuid.uuid4().hex
    places = [f"{path}/dt={day}/query={q}/batch={b}" for day, found in todo.items() for q, b in found]
    rows = spark.read.schema(full).option("basePath", path).parquet(*places)
    for day in todo.keys() & closed.keys():
        rows = rows.unionByName(spark.read.schema(full).parquet(f"{path}/_closed/{closed[day].place}").select(*full.fieldNames()))
    # The day is in the path and in the rows, as rows of several days are told apart after the union only.
    written = rows.withColumn("day", F.col("dt").cast("string")).hint("rebalance", F.col("day"))
    written.write.partitionBy("day").parquet(f"{path}/_closed/{own}")
    done = []
    for day, found in todo.items():
        before = closed.get(day)
        place = f"{own}/day={day}"
        entry = {"day": str(day), "place": place, "folded": _with(before.folded if before else {}, found)}
        number = before.number + 1 if before else 1
        if put_if_absent(spark, f"{path}/_ledger/dt={day}/{number:09d}.json", json.dumps(entry)):
            done.append(day)
        else:
            remove(spark, f"{path}/_closed/{place}")
    return done


def clean(spark: SparkSession, path: str, grace_seconds: float = 3600) -> int:
    """Remove the directories of closed batches, and those that later closings replaced; returns how many.

    Only where the entry that replaced them is older than ``grace_seconds``, so readers that started before have their files.
    """
    removed = 0
    now = time.time() * 1000
    closed = closed_days(spark, path)
    kept = {entry.place for entry in closed.values()}
    for day, entry in closed.items():
        ledger = f"{path}/_ledger/dt={day}"
        entries = dict(listed(spark, ledger))
        if now - entries[f"{entry.number:09d}.json"] < grace_seconds * 1000:
            continue
        for query, parts in entry.folded.items():
            folder = f"{path}/dt={day}/query={query}"
            for name, _ in listed(spark, folder):
                batch = int(name.removeprefix("batch="))
                if any(low <= batch <= high for low, high in parts):
                    remove(spark, f"{folder}/{name}")
                    removed += 1
        for number in range(1, entry.number):
            name = f"{number:09d}.json"
            if name in entries:
                (old,) = spark.read.text(f"{ledger}/{name}", wholetext=True).collect()
                place = json.loads(old["value"])["place"]
                if place not in kept:
                    remove(spark, f"{path}/_closed/{place}")
                    removed += 1
                remove(spark, f"{ledger}/{name}")
    return removed
