"""Parquet and catalog sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schemaflow.schemas import PARTITION_COLUMNS


def stamped(df: DataFrame, column: str = "written_at") -> DataFrame:
    """Add the write time that :func:`schemaflow.operators.dedup.latest_writes` orders by."""
    return df.withColumn(column, F.current_timestamp())


def laid_out(df: DataFrame, coalesce_to: int | None = None) -> DataFrame:
    """Prepare a frame for a partitioned write.

    By default rows are rebalanced on the partition columns: small partitions end up in few files, and adaptive
    execution splits a partition that holds a large share of the rows over several tasks. ``coalesce_to`` asks for a
    fixed number of tasks instead; being narrow it also limits the stage before it, so it suits small outputs only.
    """
    if coalesce_to is not None:
        return df.coalesce(max(1, coalesce_to))
    return df.hint("rebalance", *[F.col(c) for c in PARTITION_COLUMNS])


def write_aggregates(df: DataFrame, path: str, coalesce_to: int | None = None) -> None:
    """Append below ``path/date_hour=…/customer_segment=…``."""
    laid_out(df, coalesce_to).write.mode("append").partitionBy(*PARTITION_COLUMNS).parquet(path)


def overwrite_partitions(df: DataFrame, path: str) -> None:
    """Replace the partitions that ``df`` touches and leave the others, so that a re-run does not double its rows."""
    writer = laid_out(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*PARTITION_COLUMNS).parquet(path)


def write_bad_rows(bad: DataFrame, path: str) -> None:
    """Append dead letters; the payload stays binary. Rows are rebalanced, so that few make few files."""
    bad.hint("rebalance").write.mode("append").parquet(path)


def write_bad_rows_daily(bad: DataFrame, path: str) -> None:
    """Append dead letters below ``path/dt=<day of the record>``, rebalanced on the day."""
    by_day(bad).write.mode("append").partitionBy("dt").parquet(path)


def by_day(bad: DataFrame) -> DataFrame:
    return bad.withColumn("dt", F.to_date("timestamp")).hint("rebalance", F.col("dt"))


def write_bad_rows_if_any(bad: DataFrame, path: str, bad_count: int) -> bool:
    """Write only if the count already taken says there is something to write."""
    if bad_count > 0:
        write_bad_rows(bad, path)
    return bad_count > 0


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def write_table(df: DataFrame, database: str, table: str, catalog: str | None = None, fmt: str = "parquet") -> str:
    """Create the partitioned table on the first call and append on later ones; returns its full name.

    The session catalog takes ``saveAsTable``; any other catalog takes the v2 writer.
    """
    spark = df.sparkSession
    scope = f"{catalog}.{database}" if catalog else database
    name = f"{scope}.{table}"
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {scope}")
    if catalog in (None, "spark_catalog"):
        laid_out(df).write.format(fmt).mode("append").partitionBy(*PARTITION_COLUMNS).saveAsTable(name)
    elif table_exists(spark, name):
        laid_out(df).writeTo(name).append()
    else:
        columns = [F.col(c) for c in PARTITION_COLUMNS]
        laid_out(df).writeTo(name).using(fmt).partitionedBy(*columns).create()
    return name


def file_audit(spark: SparkSession, path: str) -> DataFrame:
    """One row per Parquet file below ``path``; reads the listing only, never the contents."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("path").alias("file_path"), F.col("length").alias("file_bytes"))
    )


def audit_totals(files: DataFrame) -> DataFrame:
    """Number of files, their total size and the whole mean size."""
    total = F.coalesce(F.sum("file_bytes"), F.lit(0))
    count = F.count(F.lit(1))
    return files.agg(
        count.alias("parquet_files"),
        total.alias("parquet_bytes"),
        F.when(count > 0, F.floor(total / count)).otherwise(0).alias("mean_parquet_bytes"),
    )
