"""Benchmark texts, kept and removed rows of a decontamination, and its evidence as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import quoted_docstring

#: Ids of a benchmark's test tasks, first and last, and how many there are: fixed values.
TASK_IDS, TASKS = (11, 510), 500


def read_tasks(spark: SparkSession, path: str, column: str, id_col: str = "task_id", ids: tuple[int, int] = TASK_IDS, expected: int | None = TASKS) -> DataFrame:
    """(item_id, text) of JSON lines whose id lies in ``ids``; another number of them than ``expected`` is an error."""
    rows = spark.read.json(path).where(F.col(id_col).between(*ids))
    if expected is not None and (found := rows.count()) != expected:
        raise ValueError(f"{found} tasks in {path}, not {expected}")
    return rows.select(F.col(id_col).cast("long").alias("item_id"), F.trim(column).alias("text"))


def read_columns(spark: SparkSession, path: str, columns: list[str], fmt: str = "parquet") -> DataFrame:
    """(text) of the filled values of ``columns``, lists of texts item by item."""
    rows = spark.read.format(fmt).load(path)
    found = None
    for name in columns:
        listed = rows.schema[name].dataType.typeName() == "array"
        part = rows.select((F.explode(name) if listed else F.col(name)).alias("text")).select(F.regexp_replace("text", r"^\s+|\s+$", "").alias("text"))
        found = part if found is None else found.unionByName(part)
    return found.where("text <> ''")


def read_prompts(spark: SparkSession, glob: str, until: str = "BEGIN SOLUTION") -> DataFrame:
    """(path, text) of whole prompt files, cut at the mark; a file without it is an error."""
    whole = spark.read.text(glob, wholetext=True).select(F.input_file_name().alias("path"), "value")
    lacking = whole.where(~F.col("value").contains(until)).first()
    if lacking:
        raise ValueError(f"no {until} in {lacking.path}")
    return whole.select("path", F.substring_index("value", until, 1).alias("text"))


def docstrings(prompts: DataFrame, column: str = "prompt") -> DataFrame:
    """(text) of the docstring in each prompt that has one."""
    return prompts.select(F.trim(quoted_docstring(F.col(column))).alias("text")).where("text is not null")


def read_languages(spark: SparkSession, path: str) -> DataFrame:
    """The names of one JSON list."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", "array<string>")).alias("name"))


def save_both(kept: DataFrame, removed: DataFrame, path: str) -> None:
    """Kept and removed rows side by side."""
    kept.write.mode("overwrite").parquet(f"{path}/kept")
    removed.write.mode("overwrite").parquet(f"{path}/removed")


def save_evidence(path: str, needles: DataFrame, matches: DataFrame, docs: DataFrame, id_col: str = "doc_id", group: str = "lang") -> None:
    """JSON beside a decontamination: the needles searched, each removed row with its reason and needle, counts by group and reason."""
    reason = F.concat("benchmark", F.lit("_match")).alias("filter_reason")
    hit = matches.select(id_col, reason, F.col("needle").alias("matched_substring"))
    excluded = docs.join(hit, id_col)
    needles.select("benchmark", "ord", "needle").write.mode("overwrite").json(f"{path}/benchmarks")
    excluded.select(F.struct(*docs.columns).alias("data"), "filter_reason", "matched_substring").write.mode("overwrite").json(f"{path}/excluded-data")
    excluded.groupBy(group, "filter_reason").agg(F.count("*").alias("n")).write.mode("overwrite").json(f"{path}/meta")


def read_evidence(spark: SparkSession, path: str, id_type: str = "bigint", id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(needles searched, known matches (id, needle)) of an earlier run, for ``incremental_matches``; empty tables if there is none."""
    needles, known = "benchmark string, ord long, needle string", f"{id_col} {id_type}, needle string"
    files = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/benchmarks")
    if not files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files):
        return spark.createDataFrame([], needles), spark.createDataFrame([], known)
    excluded = spark.read.schema(f"data struct<{id_col}:{id_type}>, filter_reason string, matched_substring string").json(f"{path}/excluded-data")
    return spark.read.schema(needles).json(f"{path}/benchmarks"), excluded.select(f"data.{id_col}", F.col("matched_substring").alias("needle"))


def save_statistics(df: DataFrame, path: str) -> None:
    """A bounded table of counts as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)
