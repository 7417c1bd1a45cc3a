"""Schema registries as frames: one row per registered version.

A registry frame has the columns ``subject``, ``version`` and ``schema`` (the JSON text), and may have ``doc``, the struct of
:func:`schemaflow.functions.schema_docs.schema_doc`, so that checks need not read the texts again.
"""

from __future__ import annotations

import os.path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from schemaflow.functions.schema_docs import schema_doc, valid_doc
from schemaflow.session import setting

# Two layouts: files kept by hand, <root>/<subject>/v<n>.avsc, and those stored by Spark,
# <root>/subject=<s>/version=<n>/part-….
HAND_KEPT = r"/([^/]+)/v(\d+)\.avsc$"
STORED = r"/subject=([^/]+)/version=(\d+)/[^/]+$"
# Directories are listed by this many tasks for each core; one for each directory, which Spark would take, mostly waits to start.
LISTING_TASKS = 4
LISTING_SETTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def read_registry(spark: SparkSession, root: str) -> DataFrame:
    """Every version of every subject below ``root``; other files are ignored.

    Fails if ``root`` is not a directory, and when a text that is no valid schema is read. A version number beyond an int is
    not a version. Each text is parsed once, into ``doc``.
    """
    depth = _directory_depth(spark, root)
    with setting(spark, LISTING_SETTING, str(LISTING_TASKS * spark.sparkContext.defaultParallelism)):
        files = spark.read.option("recursiveFileLookup", "true").text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    located = files.select(path.alias("path"), F.col("value").alias("schema"))
    below_root = F.size(F.split(F.regexp_replace("path", r"^\w+:(//[^/]*)?", ""), "/")) - 1 - depth
    stored = F.col("path").rlike(STORED) & (below_root == 3)
    hand_kept = F.col("path").rlike(HAND_KEPT) & (below_root == 2)

    def part(i: int) -> Column:
        return F.when(stored, F.regexp_extract("path", STORED, i)).otherwise(F.regexp_extract("path", HAND_KEPT, i))

    registered = (
        located.filter(stored | hand_kept)
        .select(
            F.when(stored, _decoded(_decoded(part(1)))).otherwise(_decoded(part(1))).alias("subject"),
            part(2).try_cast("int").alias("version"),
            "schema",
        )
        .filter(F.col("version").isNotNull())
    )
    place = F.concat_ws(" version ", F.col("subject"), F.col("version").cast("string"))
    read = registered.withColumn("doc", schema_doc(F.col("schema")))
    read = read.withColumn("doc", valid_doc(F.col("doc"), place))
    return read.select("subject", "version", F.when(F.col("doc").isNotNull(), F.col("schema")).alias("schema"), "doc")


def _decoded(name: Column) -> Column:
    """Undo percent escapes; stored directory names carry one level of them more than file paths do."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _directory_depth(spark: SparkSession, root: str) -> int:
    """Number of path parts of a directory; anything else is an error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
        raise ValueError(f"not a directory: {root}")
    return fs.makeQualified(path).depth()


def store_registry(registry: DataFrame, root: str) -> None:
    """Append versions below ``root`` in the layout that Spark writes, one file for each.

    Making a file takes far longer than its few bytes, so versions are dealt over all cores, however few tasks hold them.
    :func:`schemaflow.operators.registration.publish` keeps the hand-kept layout, and guards it.
    """
    cores = registry.sparkSession.sparkContext.defaultParallelism
    dealt = registry.select("subject", "version", "schema").repartition(cores, "subject", "version")
    dealt.write.mode("append").partitionBy("subject", "version").text(root)


def read_schema_file(spark: SparkSession, path: str) -> DataFrame:
    """The schema text of one file, as a one-row registry frame named after the file."""
    text = spark.read.text(path, wholetext=True)
    return text.select(
        F.lit(os.path.basename(path)).alias("subject"), F.lit(1).alias("version"), F.col("value").alias("schema")
    )
