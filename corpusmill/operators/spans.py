"""Character spans: overlap, matching, evaluation, BIO labels, windows of tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import let


def overlap_length(s: Column, e: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(F.least(e, e2) - F.greatest(s, s2), F.lit(0))


def overlaps(s: Column, e: Column, s2: Column, e2: Column) -> Column:
    return (s < e2) & (s2 < e)


def similar(s: Column, e: Column, s2: Column, e2: Column, alpha: float, beta: float) -> Column:
    """Whether the overlap exceeds ``alpha`` of the first and ``beta`` of the second span."""
    shared = overlap_length(s, e, s2, e2)
    return F.coalesce((F.try_divide(shared, e - s) > alpha) & (F.try_divide(shared, e2 - s2) > beta), F.lit(False))


def match_counts(references: DataFrame, predictions: DataFrame, alpha: float = 0.8, beta: float = 0.8, key: str = "doc_id") -> DataFrame:
    """(tag, tp, fp, fn) over all documents: predictions with a similar reference of their tag, those without, and
    references less matched predictions. Both inputs have key, tag, start, end."""
    p = predictions.withColumn("__p", F.monotonically_increasing_id())
    r = references.select(F.col(key).alias("k"), F.col("tag").alias("t"), F.col("start").alias("s"), F.col("end").alias("e"))
    near = similar(F.col("start"), F.col("end"), F.col("s"), F.col("e"), alpha, beta)
    hit = p.join(r, (F.col(key) == F.col("k")) & (F.col("tag") == F.col("t")) & near, "left_semi").groupBy("tag").agg(F.count("*").alias("tp"))
    predicted = p.groupBy("tag").agg(F.count("*").alias("n_pred"))
    wanted = references.groupBy("tag").agg(F.count("*").alias("n_ref"))
    every = predicted.join(wanted, "tag", "full").join(hit, "tag", "left").na.fill(0, ["n_pred", "n_ref", "tp"])
    return every.select("tag", "tp", (F.col("n_pred") - F.col("tp")).alias("fp"), (F.col("n_ref") - F.col("tp")).alias("fn"))


def rates(counts: DataFrame) -> DataFrame:
    """Adds recall and precision; both are 1 where a tag has neither references nor predictions, 0 over a zero denominator."""
    empty = (F.col("tp") == 0) & (F.col("fp") == 0) & (F.col("fn") == 0)
    rate = lambda rest: F.when(empty, 1.0).otherwise(F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col(rest)), F.lit(0.0)))
    return counts.withColumn("recall", rate("fn")).withColumn("precision", rate("fp"))


def overall(counts: DataFrame) -> DataFrame:
    total = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")])
    return rates(total)


def bio_labels(tokens: DataFrame, entities: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, pos, label): B- for an entity's first overlapping token, I- for the others, O elsewhere. Later entities win.

    ``tokens`` has key, pos, start, end; ``entities`` key, nr, tag, start, end.
    """
    e = entities.select(F.col(key).alias("k"), "nr", "tag", F.col("start").alias("s"), F.col("end").alias("e"))
    hit = tokens.join(e, (F.col(key) == F.col("k")) & overlaps(F.col("start"), F.col("end"), F.col("s"), F.col("e")))
    first = Window.partitionBy(key, "nr").orderBy("pos")
    marked = hit.withColumn("label", F.concat(F.when(F.row_number().over(first) == 1, "B-").otherwise("I-"), "tag"))
    last = marked.groupBy(key, "pos").agg(F.max_by("label", "nr").alias("label"))
    return tokens.select(key, "pos").join(last, [key, "pos"], "left").withColumn("label", F.coalesce("label", F.lit("O")))


def bio_entities(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, tag, first, last, n) of the entities that runs of labels form; ``labels`` has key, pos, label."""
    by = Window.partitionBy(key).orderBy("pos")
    tagged = labels.select(key, "pos", F.substring("label", 1, 1).alias("mark"), F.substring("label", 3, 100).alias("tag"))
    opens = (F.col("mark") != "O") & ((F.col("mark") == "B") | (F.lag("mark", 1, "O").over(by) == "O") | (F.lag("tag", 1, "").over(by) != F.col("tag")))
    runs = tagged.withColumn("run", F.sum(opens.cast("int")).over(by)).where("mark <> 'O'")
    return runs.groupBy(key, "run", "tag").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.count("*").alias("n")).drop("run")


def windows(tokens: Column, length: int, frequency: int = 0) -> Column:
    """Overlapping windows of a token array as structs (chunk_id, offset, tokens); the step is length, its half, or length / frequency."""
    step = length if frequency == 0 else length // 2 if frequency == 1 else length // frequency
    starts = lambda t: F.when(F.size(t) > 0, F.sequence(F.lit(0), F.size(t) - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return let(tokens, lambda t: F.transform(starts(t), lambda s, i: F.struct(i.alias("chunk_id"), s.alias("offset"), F.slice(t, s + 1, length).alias("tokens"))))


def combine_scores(scores: DataFrame, how: str = "average", key: str = "doc_id") -> DataFrame:
    """One score a (key, pos, label) from overlapping windows: summed and normalised over labels, or the last window's."""
    if how == "none":
        return scores.groupBy(key, "pos", "label").agg(F.max_by("score", "chunk_id").alias("score"))
    summed = scores.groupBy(key, "pos", "label").agg(F.sum("score").alias("total"))
    return summed.select(key, "pos", "label", (F.col("total") / F.sum("total").over(Window.partitionBy(key, "pos"))).alias("score"))


def softmax(values: Column) -> Column:
    most = F.array_max(values)
    shifted = F.transform(values, lambda v: F.exp(v - most))
    return F.transform(shifted, lambda v: v / F.aggregate(shifted, F.lit(0.0), lambda a, x: a + x))


def argmax(values: Column) -> Column:
    return F.array_position(values, F.array_max(values)).cast("int") - 1


def exclude_overlapping(entities: Column, others: Column) -> Column:
    """Entities that overlap none of ``others``."""
    return F.filter(entities, lambda x: ~F.exists(others, lambda y: overlaps(x["start"], x["end"], y["start"], y["end"])))
