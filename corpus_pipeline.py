"""Four stages over documents: quality rules, exact dedup, near-duplicate removal, packing.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and returns a DataFrame that is
written and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import exact_dedup, near_dup, packing, quality
from corpusmill.llm.common import materialize
from corpusmill.session import ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; clean ones stay as they are.

    Null, empty and short texts are rejected, repeated rows share their fate, an empty table stays empty.
    """
    ship_package(spark)
    return quality.drop_rejected(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space one stays: the longest, then the least doc_id.

    Null counts as empty text, of repeated rows one stays, an empty table stays empty.
    """
    ship_package(spark)
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of Jaccard similarity 0.8 or more connect the least doc_id stays.

    Texts without words, null included, stay; rows of one id are told apart by their texts; an empty table stays empty.
    """
    ship_package(spark)
    return near_dup.drop_near_copies(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 tokens.

    A null text counts as empty and has its end token alone, repeated rows are packed each, an empty table gives no piece.
    """
    ship_package(spark)
    return packing.pack(docs)


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_copies), ("n-gram Jaccard join", near_copies), ("packing", packed)]

#: SQL can't express the packing stage; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
