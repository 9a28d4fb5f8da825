"""Benchmark decontamination: exact passages and near matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import minhash
from corpusmill.sources.shared import materialize

#: A trivial solution that matches too much: a fixed value.
WHITELIST = ("return ''.join(strings)",)
#: Needles are sent to every task up to this size; beyond it, words that are rare among them route the join.
BROADCAST_CHARS, BROADCAST_ROWS = 64_000_000, 500_000


def needles_of(benchmark: DataFrame, name: str = "benchmark", id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(benchmark, ord, needle): stripped, without empty and whitelisted strings."""
    needle = F.trim(F.regexp_replace(text_col, r"^\s+|\s+$", ""))
    return benchmark.select(F.lit(name).alias("benchmark"), F.col(id_col).alias("ord"), needle.alias("needle")).where((F.col("needle") != "") & ~F.col("needle").isin(*WHITELIST))


def substring_matches(docs: DataFrame, needles: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed_words: int = 3) -> DataFrame:
    """(id, benchmark, ord, needle): the first needle, by (benchmark, ord), that a text holds, case-insensitively.

    Needles with at least ``seed_words`` + 2 words meet only texts that share the first inner run of
    ``seed_words`` words: an equi-join, verified afterwards. Shorter needles are compared to every text; they are
    sent to all tasks only after their total size was checked against BROADCAST_CHARS.
    """
    marked = needles.select("benchmark", "ord", "needle", F.lower("needle").alias("lowered"), F.split(F.lower("needle"), r"\s", -1).alias("w"))
    long = F.size("w") >= seed_words + 2
    # words inside the needle are whole words of a text that holds it; split on single spaces keeps runs exact
    seeded = marked.where(long).withColumn("seed", F.array_join(F.slice("w", 2, seed_words), "\x1f")).drop("w")
    rows = docs.select(F.col(id_col).alias("id"), F.lower(F.coalesce(text_col, F.lit(""))).alias("t")).withColumn("row", F.xxhash64("id", "t"))
    places = lambda w: F.sequence(F.lit(1), F.greatest(F.size(w) - seed_words + 1, F.lit(1)))
    runs = tx.let(F.split("t", r"\s", -1), lambda w: F.transform(places(w), lambda i: F.array_join(F.slice(w, i, seed_words), "\x1f")))
    seeds = seeded.select("seed").distinct()
    if seeds.count() <= BROADCAST_ROWS:  # then the runs of a text are tested where they are made
        seeds = F.broadcast(seeds)
    candidates = rows.select("id", "row", F.explode(F.array_distinct(runs)).alias("seed")).join(seeds, "seed", "left_semi").join(seeded, "seed").select("id", "row", "benchmark", "ord", "needle", "lowered").distinct()
    found = candidates.drop("id").join(rows, "row").where(F.col("t").contains(F.col("lowered"))).select("id", "benchmark", "ord", "needle")
    short = marked.where(~long).drop("w")
    chars = short.agg(F.coalesce(F.sum(F.char_length("needle")), F.lit(0))).first()[0]
    if chars > BROADCAST_CHARS:
        raise ValueError(f"{chars} characters of short needles; split them and call this once a part")
    if chars:
        found = found.unionByName(rows.join(F.broadcast(short), F.col("t").contains(F.col("lowered"))).select("id", "benchmark", "ord", "needle"))
    best = F.min_by(F.struct("benchmark", "ord", "needle"), F.struct("benchmark", "ord")).alias("m")
    return found.groupBy("id").agg(best).select(F.col("id").alias(id_col), "m.*")


def split_by_matches(docs: DataFrame, matches: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(clean rows, contaminated rows)."""
    ids = matches.select(id_col).distinct()
    return docs.join(ids, id_col, "left_anti"), docs.join(ids, id_col, "left_semi")


def incremental_matches(docs: DataFrame, needles: DataFrame, searched: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, needle): known hits of earlier needles, and hits of needles not ``searched`` before among the other rows."""
    new = needles.join(searched.select("needle").distinct(), "needle", "left_anti")
    rest = docs.join(known.select(id_col).distinct(), id_col, "left_anti")
    fresh = substring_matches(rest, new, id_col, text_col).select(id_col, "needle")
    return docs.select(id_col).join(known.select(id_col, "needle"), id_col).unionByName(fresh)


def _token_sets(df: DataFrame, key: str, text_col: str) -> DataFrame:
    return df.select(F.col(key).alias("k"), F.array_distinct(tx.filled_tokens(F.coalesce(text_col, F.lit("")))).alias("s"))


def _small(df: DataFrame) -> DataFrame:
    """Marked for a broadcast if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def jaccard_pairs(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.58, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(id, item, similarity) of token-set Jaccard similarity at or over ``threshold``, exactly.

    Prefix filtering on the benchmark's side: a set this similar holds at least ceil(threshold * n) of an item's n tokens,
    so it has one of the item's first n - that + 1, taken from rare to common. Tokens of documents meet only these,
    and only where the sizes allow the similarity; candidates are verified on whole sets. Rows of one id are told apart.
    """
    rows = materialize(_token_sets(docs, id_col, text_col).withColumn("row", F.xxhash64("k", "s")).withColumn("n", F.size("s")), "sets")
    items = _token_sets(benchmark, item_col, text_col).withColumn("m", F.size("s")).where("m > 0")
    tokens = rows.select("row", "n", F.explode("s").alias("t"))
    listed = items.select("k", "m", F.explode("s").alias("t"))
    vocabulary = _small(listed.select("t").distinct())
    frequency = tokens.join(vocabulary, "t", "left_semi").groupBy("t").agg(F.count("*").alias("df"))
    order = Window.partitionBy("k").orderBy(F.coalesce("df", F.lit(0)), "t")
    ranked = listed.join(frequency, "t", "left").withColumn("r", F.row_number().over(order))
    prefix = _small(materialize(ranked.where(F.col("r") <= F.col("m") - F.ceil(threshold * F.col("m") - 1e-9) + 1).select("t", F.col("k").alias("item"), "m"), "prefix"))
    fits = (F.col("n") >= threshold * F.col("m") - 1e-9) & (F.col("m") >= threshold * F.col("n") - 1e-9)
    pairs = tokens.join(prefix, "t").where(fits).select("row", "item").distinct()
    verified = pairs.join(_small(items.select(F.col("k").alias("item"), F.col("s").alias("si"))), "item").join(rows, "row")
    verified = verified.withColumn("similarity", tx.jaccard(F.col("s"), F.col("si")))
    return verified.where(F.col("similarity") >= threshold).select(F.col("k").alias(id_col), F.col("item").alias(item_col), "similarity").distinct()


def lsh_pairs(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.58, num_perm: int = 128, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(id, item) of documents that share a band of their token sets' MinHash with a benchmark item: the candidates of
    an index over the benchmark that is asked for every document."""
    bands, rows = minhash.band_choice(threshold, num_perm)
    keys = lambda df, key: minhash.band_keys(minhash.minhash_signatures(df, num_perm, variant="tokens", id_col=key, text_col=text_col), bands, rows)
    index = _small(materialize(keys(benchmark, item_col), "index").withColumnRenamed("id", item_col))
    return keys(docs, id_col).join(index, ["band", "h"]).select(F.col("id").alias(id_col), item_col).distinct()
