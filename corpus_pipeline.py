"""Documents to packed training sequences: rules, classifier, near-duplicates, secrets, packing.

Each stage takes what its predecessor kept, as a table, and all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schemaflow.llm import minhash, packing, quality_bayes, quality_rules, secrets
from schemaflow.llm.common import stored, table

NEAR_PERCENT = 80


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts go, as do all of fewer than 50 words. No rows give no rows.

    Rows of repeated ids or texts are judged one by one, here and in the next stage; columns of any name stay, in all but the last.
    """
    return quality_rules.keep_sound(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; it learns from all labels of documents that came this far.

    Texts without words (null, empty) go. Without labels all others stay. No rows give no rows.
    """
    return quality_bayes.keep_good(docs, table(spark, sf_dir, "labels"), F.lit(False))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of similarity 0.8 or more; op2's 0.85 is its own contract.

    Texts without words (null, empty) are groups of their own and stay; of repeated ids in a group the row read first does. No rows
    give no rows.
    """
    return minhash.keep_first(docs, percent=NEAR_PERCENT)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind of a secret in its place; null and empty texts and repeated rows as they are. No rows give no rows."""
    return secrets.redact(docs, length="n_chars")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents: their token ids, with a checksum, and each one's sequence and place there.

    Null and empty texts are one piece of the end alone; repeated rows each have pieces of their own; only doc_id and text are read. No
    rows give no rows.
    """
    return packing.pack(packing.pieces(docs)).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", rules),
    ("quality_classifier", classifier),
    ("near_duplicates", near_duplicates),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

# Compression ratios, MinHash and token ids have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
