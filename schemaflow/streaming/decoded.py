"""One decode for a whole streaming job: the tagged rows of a stream, stored once, and streams over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from schemaflow.storage import make_directory
from schemaflow.streaming.sinks import TRIGGER, triggered

KEEP = "30d"


def store_decoded(
    tagged: DataFrame,
    path: str,
    checkpoint: str,
    interval: str = TRIGGER,
    name: str | None = None,
    available_now: bool = False,
    keep: str = KEEP,
) -> StreamingQuery:
    """Decode a stream and append its tagged rows by side below ``path``; returns the running query.

    The sink's own log names the files of every finished micro-batch, so files of a batch that failed and was run again are
    never seen. Files older than ``keep`` leave that log; readers must not be behind by more.
    """
    make_directory(tagged.sparkSession, path)
    writer = tagged.writeStream.format("parquet").outputMode("append").partitionBy("valid")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint).option("retention", keep)
    if name:
        writer = writer.queryName(name)
    return triggered(writer, interval, available_now).start()


def stream_decoded(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None, keep: str = KEEP
) -> DataFrame:
    """Stream over what :func:`store_decoded` stores; ``schema``: that of its tagged frame.

    A filter on ``valid`` reaches the directories, so each side's readers open files of that side only.
    """
    # The directory's column comes last, as it does in every micro-batch, also where the stream starts before there are files.
    columns = [f for f in schema if f.name != "valid"]
    reader = spark.readStream.schema(T.StructType([*columns, schema["valid"]])).option("maxFileAge", keep)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
