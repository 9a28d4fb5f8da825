"""Near-duplicate removal by banded MinHash and exact-key dedup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.graph import connected_components
from corpusmill.operators.minhash import band_choice, band_keys, minhash_signatures, star_edges
from corpusmill.sources.shared import materialize


def near_duplicate_components(
    docs: DataFrame, threshold: float = 0.7, num_perm: int = 256, ngram: int = 5, least: int = 5, bands: int | None = None, rows: int | None = None,
    variant: str = "v1", short_docs: str = "collapse", id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, component) of documents with a near-duplicate; ``short_docs`` "keep" leaves texts without shingles alone."""
    if bands is None or rows is None:
        bands, rows = band_choice(threshold, num_perm)
    # written once, as the buckets' minima and their members both come from it
    signed = materialize(minhash_signatures(docs, num_perm, ngram, least, variant, id_col=id_col, text_col=text_col), "signatures")
    if short_docs == "keep":
        signed = signed.where("n_shingles > 0")
    return connected_components(star_edges(band_keys(signed, bands, rows)))


def keep_least(docs: DataFrame, components: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Keeps the least id of each component and everything outside of components."""
    others = components.where("id <> component").select(F.col("id").alias(id_col))
    return docs.join(others, id_col, "left_anti")


def keep_best(docs: DataFrame, components: DataFrame, order: list[Column], id_col: str = "doc_id") -> DataFrame:
    """Keeps the first row of each component by ``order``, then by id. Only ids and rank keys are shuffled for it."""
    ranked = docs.select(F.col(id_col), F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], F.col(id_col).alias("id")).alias("rank"))
    member = ranked.join(components.withColumnRenamed("id", id_col), id_col)
    best = member.groupBy("component").agg(F.min("rank").alias("best"))
    losers = member.join(best, "component").where("rank <> best").select(id_col)
    return docs.join(losers, id_col, "left_anti")


def license_rank(license_type: Column) -> Column:
    """permissive, no_license, non_permissive, then anything else and null."""
    return F.when(license_type == "permissive", 0).when(license_type == "no_license", 1).when(license_type == "non_permissive", 2).when(license_type.isNotNull(), 3).otherwise(4)


def rank_keys(license_type: Column, stars: Column, forks: Column, revision: Column, visit: Column) -> list[Column]:
    """Ascending keys of the best-of-component rule: licence, more stars, more forks, later revision, later visit."""
    late = lambda t: -F.coalesce(F.unix_micros(t), F.lit(-(1 << 62)))
    return [license_rank(license_type), -F.coalesce(stars, F.lit(0)), -F.coalesce(forks, F.lit(0)), late(revision), late(visit)]


def first_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``."""
    rank = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(rank)).where("__n = 1").drop("__n")


def dedup_report(before: DataFrame, after: DataFrame, size: Column | None = None) -> DataFrame:
    """Rows before and after, the percentage kept and, with a ``size`` of a row, the sums of it."""
    sums = lambda side: [F.count("*").alias(f"rows_{side}")] + ([F.coalesce(F.sum(size), F.lit(0)).alias(f"size_{side}")] if size is not None else [])
    b, a = before.agg(*sums("before")), after.agg(*sums("after"))
    return b.crossJoin(a).withColumn("kept_percent", F.round(F.try_divide(100 * F.col("rows_after"), F.col("rows_before")), 2))
