"""Corpus sources and sinks; everything goes through Spark's readers and writers, so any store it reaches will do."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_corpus(
    spark: SparkSession, path: str | list[str], fmt: str = "parquet", subset: str | None = None, split: str | None = None, config: str | None = None, revision: str | None = None, ignore_corrupt: bool = False, **options: str
) -> DataFrame:
    """One or several directories of files. ``revision``, ``config`` and ``subset`` are folders below each, in this order; ``split`` is
    a value of the split column if there is one; ``ignore_corrupt`` leaves broken and missing files out."""
    paths = ["/".join(x for x in (p.rstrip("/"), revision, config, subset) if x) for p in ([path] if isinstance(path, str) else path)]
    reader = spark.read.format(fmt).options(**options)
    if ignore_corrupt:
        reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    if fmt == "parquet":
        reader = reader.option("mergeSchema", options.get("mergeSchema", "true"))
    df = reader.load(paths)
    return df.where(F.col("split") == split) if split and "split" in df.columns else df


def read_extension_parameters(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a parameter file in their order: language, extension, include, long_line_threshold, alphanum_threshold, alpha_filter, nr; all text."""
    rows = spark.read.option("header", "true").option("multiLine", "true").csv(path)
    known = {c.lower().replace(" ", "_"): c for c in rows.columns}
    names = ("language", "extension", "include", "long_line_threshold", "alphanum_threshold", "alpha_filter")
    return rows.select(*[F.col(f"`{known[n]}`").alias(n) for n in names], F.monotonically_increasing_id().alias("nr"))


def read_table(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """Any connector on the class path, such as a warehouse's."""
    return spark.read.format(fmt).options(**options).load()


def read_jsonl(spark: SparkSession, glob: str, schema: str | None = None, ignore_corrupt: bool = True) -> DataFrame:
    reader = spark.read.option("ignoreCorruptFiles", str(ignore_corrupt).lower()).option("mode", "PERMISSIVE")
    return (reader.schema(schema) if schema else reader).json(glob)


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", "true")
    return (reader.schema(schema) if schema else reader).csv(path)


def read_language_map(spark: SparkSession, path: str) -> DataFrame:
    """(name, extensions) from one JSON object."""
    whole = spark.read.text(path, wholetext=True)
    parsed = whole.select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("name", "extensions"))
    return parsed


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def partition_count(rows: int, chunk: int = 200_000, most: int = 2048, least: int = 256) -> int:
    return max(least, min(ceil(rows / chunk), most))


def partitioned_save(df: DataFrame, path: str, chunk: int = 200_000, most: int = 2048, least: int = 256) -> int:
    """Writes evenly dealt files of about ``chunk`` rows; returns their number."""
    n = partition_count(df.count(), chunk, most, least)
    df.repartition(n).write.mode("overwrite").option("compression", "snappy").parquet(path)
    return n


def save_limited(df: DataFrame, path: str, rows_a_file: int = 300_000) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_a_file).parquet(path)


def save_shards(df: DataFrame, path: str, key: str, bytes_total: int, shard_bytes: int = 1000 << 20) -> int:
    """Contiguous ranges of ``key``, one file each, of about ``shard_bytes``."""
    n = bytes_total // shard_bytes + 1
    df.repartitionByRange(n, key).sortWithinPartitions(key).write.mode("overwrite").parquet(path)
    return n


def save_by(df: DataFrame, path: str, column: str = "lang") -> None:
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def save_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
