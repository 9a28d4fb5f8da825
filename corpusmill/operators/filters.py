"""Quality filters as predicates, and a chain that applies them with a report in one pass."""

from __future__ import annotations

from dataclasses import dataclass
from fnmatch import fnmatch

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.functions.hashing import keyed_uniform

#: Canonical order of the filters.
ALL_FILTERS = ("basic", "basic_per_extension", "stars", "comments", "fertility", "xml", "html", "large_and_small_files")


@dataclass(frozen=True)
class Filter:
    name: str
    keep: Column


def resolve(patterns: str, names: tuple[str, ...] = ALL_FILTERS) -> list[str]:
    """The names that a comma list of shell patterns selects, in canonical order; a pattern without a match is an error."""
    wanted = [p.strip() for p in patterns.split(",") if p.strip()]
    for p in wanted:
        if not any(fnmatch(n, p) for n in names):
            raise ValueError(f"no filter matches {p}")
    return [n for n in names if any(fnmatch(n, p) for p in wanted)]


def _known(predicate: Column, undecided: bool) -> Column:
    """What becomes of a row that a predicate can't judge: a null or, where a share is asked for, empty value. By default it is kept."""
    return F.coalesce(predicate, F.lit(undecided))


def basic(line_max: int = 1000, line_mean: int = 100, alphanum: float = 0.25, text: str = "text", undecided: bool = True) -> Filter:
    t = F.col(text)
    return Filter("basic", _known((tx.max_line_length(t) <= line_max) & (tx.mean_line_length(t) <= line_mean) & (tx.alnum_fraction(t) >= alphanum), undecided))


def xml(text: str = "text") -> Filter:
    return Filter("xml", ~F.coalesce(F.substring(text, 1, 100).contains("<?xml version="), F.lit(False)))


def size_between(column: str, low: int = 100, high: int = 5000, undecided: bool = True) -> Filter:
    return Filter("large_and_small_files", _known(F.col(column).between(low, high), undecided))


def stars(column: str, more_than: int = 5) -> Filter:
    return Filter("stars", F.coalesce(F.col(column), F.lit(0)) > more_than)


def comments(ratio: str, low: float = 0.01, high: float = 0.8) -> Filter:
    return Filter("comments", F.coalesce((F.col(ratio) > low) & (F.col(ratio) < high), F.lit(False)))


def run_chain(df: DataFrame, filters: list[Filter], size: str) -> tuple[DataFrame, DataFrame]:
    """(kept rows, report). The report has for each filter the rows and ``size`` before and after it, and the percentages kept.

    Flags are computed once; the report is one aggregation over their prefixes. A percentage of nothing is NaN; the first size is
    null where no row has one.
    """
    flagged = df
    for i, f in enumerate(filters):
        flagged = flagged.withColumn(f"__f{i}", f.keep)
    passed = [F.lit(True)]
    for i in range(len(filters)):
        passed.append(passed[-1] & F.col(f"__f{i}"))
    none = lambda i, n: F.lit(0 if i or n == "c" else None).cast("long")
    sums = [F.coalesce(F.sum(F.when(p, v)), none(i, n)).alias(f"{n}{i}") for i, p in enumerate(passed) for n, v in (("c", F.lit(1)), ("b", F.col(size)))]
    steps = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("step"), F.lit(f.name).alias("name"), F.col(f"c{i}").alias("rows_before"), F.col(f"c{i + 1}").alias("rows_after"), F.col(f"b{i}").alias("size_before"), F.col(f"b{i + 1}").alias("size_after"))
                for i, f in enumerate(filters)
            ]
        )
    )
    report = flagged.agg(*sums).select(steps.alias("s")).select("s.*")
    share = lambda a, b: F.when(F.col(b) == 0, float("nan")).otherwise(F.try_divide(100.0 * F.col(a), F.col(b)))
    percent = lambda a, b: F.round(share(a, b) * 100) / 100
    report = report.withColumn("rows_percent", percent("rows_after", "rows_before")).withColumn("size_percent", percent("size_after", "size_before"))
    return flagged.where(passed[-1]).drop(*[f"__f{i}" for i in range(len(filters))]), report


def parse_extension_parameters(raw: DataFrame) -> DataFrame:
    """Typed parameters by (language, extension) from text rows with their position ``nr``; the last row of a key wins.

    Non-numeric cells mean no check; the line mean is checked, at 100, where the line maximum is.
    """
    number = lambda c: F.expr(f"try_cast({c} as double)")
    last = Window.partitionBy("language", "extension").orderBy(F.desc("nr"))
    typed = raw.select(
        F.coalesce("language", F.lit("")).alias("language"), F.coalesce("extension", F.lit("")).alias("extension"), (F.col("include") == "1").alias("include"),
        number("long_line_threshold").alias("line_max"), number("alphanum_threshold").alias("alphanum"), number("alpha_filter").alias("alpha"), "nr",
    )
    typed = typed.withColumn("line_mean", F.when(F.coalesce(F.col("line_max"), F.lit(0.0)) != 0, 100.0))
    return typed.withColumn("n", F.row_number().over(last)).where("n = 1").drop("n", "nr")


def per_extension(df: DataFrame, parameters: DataFrame, language: str, extension: str, text: str = "text") -> DataFrame:
    """Rows that pass their (language, extension) parameters; a key without parameters, or not included, drops the row.

    A null or zero parameter disables its check. The parameter table is small by nature: a row an extension.
    """
    t = F.col(text)
    off = lambda c: F.coalesce(F.col(c), F.lit(0.0)) == 0
    keyed = df.withColumn("__l", F.coalesce(language, F.lit(""))).withColumn("__e", F.coalesce(extension, F.lit("")))
    found = keyed.join(parameters.withColumnsRenamed({"language": "__l", "extension": "__e"}), ["__l", "__e"]).where("include")
    passed = (
        (off("line_max") | (tx.max_line_length(t) <= F.col("line_max")))
        & (off("line_mean") | (tx.mean_line_length(t) <= F.col("line_mean")))
        & (off("alphanum") | (tx.alnum_fraction(t) >= F.col("alphanum")))
        & (off("alpha") | (tx.alpha_count(t) >= F.col("alpha") * F.char_length(t)))
    )
    return found.where(passed).select(*df.columns)


def extension_allowed(path: Column, extensions: list[str]) -> Column:
    return tx.extension(path).isin(extensions) | path.endswith("Dockerfile") | path.endswith("Makefile")


def without_owners(repos: Column, owners: list[str]) -> Column:
    """The comma list of repositories without those of ``owners`` (lower case); null when none is left."""
    left = F.filter(F.split(repos, ","), lambda r: ~F.lower(F.substring_index(r, "/", 1)).isin(owners))
    return F.when(F.size(left) > 0, F.array_join(left, ","))


def without_listed(df: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are on no list; null keys stay."""
    return df.join(listed.select(*keys).distinct(), keys, "left_anti")


#: Extensions of data files, of which a share is kept: fixed values.
DATA_EXTENSIONS = ("json", "yml", "xml", "html", "yaml")


def data_sampled(key: Column, path: Column, share: float = 0.5) -> Column:
    """Whether a file is kept: a keyed share of data files, all others."""
    return ~tx.extension(path).isin(*DATA_EXTENSIONS) | sampled("data files", key, share)


def sampled(salt: str, key: Column, share: float) -> Column:
    return keyed_uniform(salt, key) < share
