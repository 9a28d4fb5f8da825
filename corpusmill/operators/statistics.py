"""Counts, top lists, percentiles, samples and log statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.hashing import keyed_uniform
from corpusmill.sources.shared import materialize


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    counted = df.groupBy(column).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), column).limit(top) if top else counted


def top_per_group(df: DataFrame, group: str, score: str, tie: str, n: int = 30) -> DataFrame:
    """The n highest and lowest rows of each group as (.., side, rank)."""
    found = []
    for side, order in (("most", F.desc(score)), ("least", F.asc(score))):
        ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(order, tie))).where(F.col("rank") <= n)
        found.append(ranked.withColumn("side", F.lit(side)))
    return found[0].unionByName(found[1])


def running_totals(df: DataFrame, order: list[str], amount: Column) -> DataFrame:
    """``df`` with ``before`` and ``total``: the sums of ``amount`` over all rows ahead in ``order``, and over all rows.

    Rows are dealt by ranges and written; sums of whole ranges, one row each, give where a range starts. No task sees more
    than a range. Columns named __p and __a are added on the way.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("__a", amount).repartitionByRange(parts, *order).withColumn("__p", F.spark_partition_id())
    dealt = materialize(dealt, "ranges")
    sums = dealt.groupBy("__p").agg(F.sum("__a").alias("own"))
    bases = sums.select("__p", (F.sum("own").over(Window.orderBy("__p")) - F.col("own")).alias("base"), F.sum("own").over(Window.partitionBy(F.lit(1))).alias("total"))
    ahead = F.sum("__a").over(Window.partitionBy("__p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("__a")
    return dealt.withColumn("__b", ahead).join(F.broadcast(bases), "__p").withColumn("before", F.col("base") + F.col("__b")).drop("__p", "__a", "__b", "base")


def row_index(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with idx: dense positions from 0 in ``order``."""
    return running_totals(df, order, F.lit(1).cast("long")).withColumnRenamed("before", "idx").drop("total")


def percentiles(df: DataFrame, column: str, points: list[float]) -> DataFrame:
    """(p, value) with linear interpolation between the two values next to the wanted rank; nulls don't count.

    Counts by value are summed before they are shuffled; running totals over ranges find the ranks.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    placed = running_totals(counted, ["v"], F.col("n"))
    wanted = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("p"), (F.lit(p / 100) * (F.col("total") - 1)).alias("rank")) for p in points])).alias("w")
    hit = placed.select("v", "n", "before", wanted).select("v", "n", "before", "w.p", "w.rank")
    inside = lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n"))
    low, high = F.floor("rank"), F.ceil("rank")
    found = hit.where(inside(low) | inside(high)).groupBy("p", "rank").agg(F.min("v").alias("a"), F.max("v").alias("b"))
    return found.select("p", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("rank") - F.floor("rank"))).cast("double").alias("value"))


def cumulative(df: DataFrame, column: str) -> DataFrame:
    """(value, share of rows at most that); counts are summed before running totals over ranges."""
    counted = df.groupBy(column).agg(F.count("*").alias("n"))
    return running_totals(counted, [column], F.col("n")).select(column, ((F.col("before") + F.col("n")) / F.col("total")).alias("share"))


def stratified_sample(df: DataFrame, group: str, key: str, n: int, salt: str = "sample") -> DataFrame:
    order = Window.partitionBy(group).orderBy(keyed_uniform(salt, F.col(key)), key)
    return df.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= n).drop("__r")


def sample(df: DataFrame, key: str, n: int, salt: str = "sample") -> DataFrame:
    return df.orderBy(keyed_uniform(salt, F.col(key)), key).limit(n)


def log_statistics(logs: DataFrame, patterns: dict[str, str], line: str = "value") -> DataFrame:
    """(name, value) of the first group of each pattern over distinct log lines."""
    distinct = logs.select(line).distinct()
    found = [distinct.where(F.col(line).rlike(p)).select(F.lit(n).alias("name"), F.regexp_extract(line, p, 1).alias("value")) for n, p in patterns.items()]
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def average_precision(scored: DataFrame, group: str, score: str, positive: str) -> DataFrame:
    """Average precision of a ranking by group; ties share the precision at their last row.

    Rows are counted by (group, score) first; totals run over ranges of that order, so a large group is no single task.
    """
    tied = scored.groupBy(F.col(group).alias("g"), (-F.col(score)).alias("o")).agg(F.count("*").alias("n"), F.sum(F.col(positive).cast("long")).alias("hits"))
    rows = running_totals(tied, ["g", "o"], F.col("n")).select("g", "o", "n", "hits", (F.col("before") + F.col("n")).alias("rows"))
    both = running_totals(rows, ["g", "o"], F.col("hits")).select("*", (F.col("before") + F.col("hits")).alias("found"))
    start = both.groupBy(F.col("g").alias("g0")).agg(F.min(F.col("rows") - F.col("n")).alias("rows_0"), F.min(F.col("found") - F.col("hits")).alias("found_0"), F.sum("hits").alias("all"))
    placed = both.join(start, F.col("g").eqNullSafe(F.col("g0")))
    precision = (F.col("found") - F.col("found_0")) / (F.col("rows") - F.col("rows_0"))
    return placed.groupBy(F.col("g").alias(group)).agg((F.sum(precision * F.col("hits")) / F.max("all")).alias("average_precision"))


def log_cardinality(statistics: DataFrame, expected: dict[str, int]) -> DataFrame:
    """(name, found, expected) of the statistics whose number of values differs from the expected one."""
    counted = statistics.groupBy("name").agg(F.count("*").alias("found"))
    wanted = F.create_map(*[F.lit(x) for pair in expected.items() for x in pair])[F.col("name")]
    missing = statistics.sparkSession.createDataFrame([(n,) for n in expected], "name string")
    return missing.join(counted, "name", "left").select("name", F.coalesce("found", F.lit(0)).alias("found"), wanted.alias("expected")).where("found <> expected")


def unrecognized(logs: DataFrame, pattern: str, line: str = "value") -> DataFrame:
    """(value, n) of the first group of a pattern over all lines that have it."""
    return value_counts(logs.where(F.col(line).rlike(pattern)).select(F.regexp_extract(line, pattern, 1).alias("value")), "value")


def confusion(df: DataFrame, actual: str, predicted: str, labels: list) -> DataFrame:
    return df.groupBy(actual).pivot(predicted, labels).count().na.fill(0)
