"""What the operators of this subpackage share: table reads, stored intermediate results, and Arrow helpers."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from schemaflow.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder and read back: later passes and lost executors start from there."""
    path = scratch_dir(df.sparkSession, label)
    # These tables stay until the application ends, so they are kept small.
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(column: str) -> Column:
    """The UTF-8 bytes of a text column, empty for null."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """Whether a document is kept out of training: crc32 of its id as text, null ids as the empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus)) == remainder


def structs(columns: dict[str, Iterable], types: dict[str, pa.DataType]) -> pa.StructArray:
    """Python lists as one struct array with the given field types."""
    arrays = [pa.array(list(columns[name]), kind) for name, kind in types.items()]
    return pa.StructArray.from_arrays(arrays, fields=[pa.field(n, k) for n, k in types.items()])


def nested(df: DataFrame, name: str = "doc") -> Column:
    """All columns of a frame as one struct, so that columns beside it can have any name; ``<name>.*`` brings them back."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(name)
