"""Entities that a model predicts: boundaries, tokens, labels by trigger words, confidence, merging with patterns' hits."""

from __future__ import annotations

import re
import sys
import unicodedata
from array import array
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import let
from corpusmill.operators.spans import overlaps

#: Characters that are no part of an entity's start: a fixed value.
EDGE = "!\"'()*+,-./:;<=>?[\\]^_`{|}~"
#: Words near which a value is a password or a key: fixed values.
TRIGGERS = {
    "PASSWORD": ("auth", "password", "passphrase", "passwd", "pass", "pwd", "token"),
    "KEY": (
        "access", "accesskey", "accesstoken", "account", "api", "apikey", "apisecret", "apitoken", "auth", "authcode", "authorization", "bitcoin",
        "eth", "hidden", "iamauthenticator", "keid", "key", "ledger", "private", "pub", "public", "secret", "sec", "token", "verification",
    ),
    "NAME": (
        "author", "copyright", "created", "createdby", "edited", "editedby", "editor", "maintainer", "modified", "modifiedby", "name", "requested",
        "requestedby", "todo", "user", "written", "writtenby",
    ),
    "USERNAME": ("author", "editor", "facebook", "github", "linkedin", "login", "maintainer", "todo", "twitter", "user", "username"),
}
#: Confidence from which an entity is good, and below which it is bad; other tags have none.
GOOD = {"PASSWORD": 1.0, "KEY": 1.0, "NAME": 0.7, "USERNAME": 0.7, "EMAIL": 0.9, "IP_ADDRESS": 1.0, "AMBIGUOUS": 1.0}
BAD = {"PASSWORD": 0.0, "KEY": 0.0, "NAME": 0.6, "USERNAME": 0.61, "EMAIL": 0.0, "IP_ADDRESS": 0.0, "AMBIGUOUS": 0.0}
TOKENS = "array<struct<start:int,end:int>>"
#: Numbers from which a block of spans leaves its worker, and characters of a long text.
SPAN_BLOCK = 1 << 20


def trimmed(entity: Column) -> Column:
    """An entity (tag, value, start, end) without punctuation at its start, and at its end unless it is a key.

    Offsets follow; a value of nothing else becomes empty at its own start.
    """
    value = entity["value"]
    left = F.ltrim(value, F.lit(EDGE))
    right = F.when(entity["tag"] == "KEY", left).otherwise(F.regexp_replace(left, r"(?U)[\s\W]+$", ""))
    new = F.regexp_replace(right, r"(?U)^\s+|\s+$", "")
    offset = F.greatest(F.instr(value, new) - 1, F.lit(0))
    start = entity["start"] + offset
    return F.struct(entity["tag"].alias("tag"), new.alias("value"), start.cast("int").alias("start"), (start + F.char_length(new)).cast("int").alias("end"))


@lru_cache(maxsize=1)
def combining_marks() -> str:
    """All combining marks, of which Python's word characters have none, as ranges of a pattern: single ones are slow there."""
    marks = {c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == "M"}
    return "".join(f"{chr(c)}-{chr(d)}" for c, d in zip(sorted(c for c in marks if c - 1 not in marks), sorted(c for c in marks if c + 1 not in marks), strict=True))


def token_spans(text: Column, pattern: str = r"[\w+.\-]+|\S") -> Column:
    """Spans (start, end) of runs of word characters, plus, dot and dash, and of single other characters that are no space.

    Another ``pattern``, without groups, finds other tokens. Spans are held as two numbers each and leave by blocks of bounded size, or one
    longer text. A filter on the result does not find the spans again.
    """

    def spans(batches):
        import numpy as np
        import pyarrow as pa

        tokens = re.compile(f"({pattern})")

        def found(text):
            """Starts and ends in turn; a text is split, which is faster but holds its tokens, unless it is long."""
            if len(text) > SPAN_BLOCK:
                return (x for m in tokens.finditer(text) for x in m.span())
            parts = tokens.split(text)
            return array("i", np.cumsum(np.fromiter(map(len, parts), np.int32, len(parts)), dtype=np.int32)[:-1].tobytes())

        def block(ends, bounds):
            offsets, flat = np.frombuffer(ends, np.int32), np.frombuffer(bounds, np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(flat[::2]), pa.array(flat[1::2])], ["start", "end"])
            return pa.ListArray.from_arrays(pa.array(offsets), pairs)

        for texts in batches:
            ends, bounds = array("i", [0]), array("i")
            for t in texts:
                bounds.extend(found(t.as_py() or ""))
                ends.append(len(bounds) // 2)
                if len(bounds) > SPAN_BLOCK:
                    yield block(ends, bounds)
                    ends, bounds = array("i", [0]), array("i")
            if len(ends) > 1:
                yield block(ends, bounds)

    return F.arrow_udf(spans, TOKENS, F.ArrowUDFType.SCALAR_ITER).asNondeterministic()(text)


def with_ends(values: Column, first: Column, last: Column) -> Column:
    """A window's ids or labels between the marks of its begin and end."""
    return F.concat(F.array(first), values, F.array(last))


def remap(new_ends: list[int], old_ends: list[int], scores: list[list[float]]) -> list[list[float] | None]:
    """For each new token the mean scores of the old tokens that it shares characters with, told by their ends; none where the
    old tokens end before it."""
    import numpy as np

    if not len(old_ends):
        return [None] * len(new_ends)
    new, old = np.asarray(new_ends), np.asarray(old_ends)
    sums = np.concatenate([np.zeros((1, len(scores[0]))), np.cumsum(np.array([list(x) for x in scores], float), axis=0)])
    first = np.searchsorted(old, np.concatenate([[0], new[:-1]]), "right")
    last = np.minimum(np.searchsorted(old, new, "left"), len(old) - 1)
    return [list((sums[j + 1] - sums[i]) / (j + 1 - i)) if i <= j else None for i, j in zip(first.tolist(), last.tolist(), strict=True)]


def remapped(new_ends: Column, old_ends: Column, scores: Column) -> Column:
    """``remap`` of array columns, one document a row: array<array<double>>."""

    @F.pandas_udf("array<array<double>>")
    def mapped(new, old, values):
        import pandas as pd

        return pd.Series([remap(a, b, c) for a, b, c in zip(new, old, values, strict=True)])

    return mapped(new_ends, old_ends, scores)


def entities_with_confidence(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, tag, start, end, confidence) of the entities that runs of labels form.

    ``labels`` has key, pos, start, end, label, prob. An entity begins at a B- label, after an O, or where the tag
    changes; its confidence is the mean probability of its tokens.
    """
    by = Window.partitionBy(key).orderBy("pos")
    tagged = labels.select(key, "pos", "start", "end", "prob", F.substring("label", 1, 1).alias("mark"), F.substring("label", 3, 100).alias("tag"))
    opens = (F.col("mark") != "O") & ((F.col("mark") == "B") | (F.lag("mark", 1, "O").over(by) == "O") | (F.lag("tag", 1, "").over(by) != F.col("tag")))
    runs = tagged.withColumn("run", F.sum(opens.cast("int")).over(by)).where("mark <> 'O'")
    return runs.groupBy(key, "run", "tag").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.avg("prob").alias("confidence")).drop("run")


def trigger_distance(text: Column, start: Column, words: tuple[str, ...]) -> Column:
    """Characters between a trigger word and the entity, on its line, within 100 characters and without separators; 100 without one."""
    before = F.substring(text, F.greatest(start - 100, F.lit(0)) + 1, F.least(start, F.lit(100)))
    prefix = F.lower(F.regexp_replace(F.substring_index(before, "\n", -1), r"(?U)[\s'\":=(){}\[\]_/]", ""))
    listed = F.array(*map(F.lit, words))
    after = lambda p, w: F.when(F.instr(p, w) > 0, F.char_length(p) - (F.instr(p, w) - 1 + F.char_length(w))).otherwise(100)
    return let(prefix, lambda p: F.array_min(F.transform(listed, lambda w: after(p, w))))


def _by_tag(tag: Column, values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[tag]


def pseudo_labels(entities: DataFrame, near: int = 5, good: dict[str, float] | None = None, bad: dict[str, float] | None = None) -> DataFrame:
    """Entities (text, tag, start, end, confidence, ..) with their corrected tag and label GOOD, BAD or null.

    A password or key gets the tag of the nearer trigger word, the password at a tie. An entity is good near a trigger word
    of its tag or from its tag's confidence on, bad below the other one.
    """
    text, start = F.col("text"), F.col("start")
    nearer = F.when(trigger_distance(text, start, TRIGGERS["PASSWORD"]) <= trigger_distance(text, start, TRIGGERS["KEY"]), "PASSWORD").otherwise("KEY")
    tagged = entities.withColumn("tag", F.when(F.col("tag").isin("PASSWORD", "KEY"), nearer).otherwise(F.col("tag")))
    close = F.lit(False)
    for tag, words in TRIGGERS.items():
        close = close | ((F.col("tag") == tag) & (trigger_distance(text, start, words) <= near))
    sure = F.coalesce(F.col("confidence") >= _by_tag(F.col("tag"), good or GOOD), F.lit(False))
    poor = F.coalesce(F.col("confidence") < _by_tag(F.col("tag"), bad or BAD), F.lit(False))
    return tagged.withColumn("label", F.when(close | sure, "GOOD").when(poor, "BAD"))


def training_entities(labelled: DataFrame, hits: DataFrame, key: str = "doc_id") -> DataFrame:
    """Entities for training: the model's without unsure keys, passwords and addresses, of documents without a bad one among the
    rest, and the patterns' ``hits`` (key, tag, start, end) with confidence 1 that overlap none of them."""
    unsure = F.col("tag").isin("KEY", "PASSWORD", "IP_ADDRESS", "EMAIL") & ~F.coalesce(F.col("label") == "GOOD", F.lit(False))
    rest = labelled.where(~unsure)
    wrong = rest.where("label = 'BAD'").select(key).distinct()
    kept = rest.join(wrong, key, "left_anti").select(key, "tag", "start", "end", "confidence")
    mine = kept.select(F.col(key).alias("k"), F.col("start").alias("s"), F.col("end").alias("e"))
    free = hits.join(wrong, key, "left_anti").join(mine, (F.col(key) == F.col("k")) & overlaps(F.col("start"), F.col("end"), F.col("s"), F.col("e")), "left_anti")
    return kept.unionByName(free.select(key, "tag", "start", "end", F.lit(1.0).alias("confidence")))


def split_by_fold(rows: DataFrame, fold: str, held_out: int) -> tuple[DataFrame, DataFrame]:
    """(training rows, test rows) by a column that holds each row's fold."""
    return rows.where(F.col(fold) != held_out), rows.where(F.col(fold) == held_out)


def shuffled(rows: DataFrame, key: str, salt: str = "shuffle") -> DataFrame:
    """The rows in an order that depends on a keyed hash alone."""
    from corpusmill.functions.hashing import keyed_uniform

    return rows.orderBy(keyed_uniform(salt, F.col(key)), key)


def converted(annotations: Column) -> Column:
    """Annotations with API and SSH keys as KEY."""
    return F.transform(annotations, lambda a: F.struct(F.when(a["tag"].isin("API_KEY", "SSH_KEY"), "KEY").otherwise(a["tag"]).alias("tag"), a["value"].alias("value"), a["start"].alias("start"), a["end"].alias("end")))


def patched(rows: DataFrame, patches: DataFrame, key: str, column: str) -> DataFrame:
    """``rows`` with the values of ``patches`` (key, column) where there are any."""
    fixed = patches.select(key, F.col(column).alias("__new"), F.lit(True).alias("__fixed"))
    return rows.join(fixed, key, "left").withColumn(column, F.when(F.col("__fixed"), F.col("__new")).otherwise(F.col(column))).drop("__new", "__fixed")


def curated(rows: DataFrame, annotators: str = "n_annotators", annotations: str = "annotations") -> DataFrame:
    """Rows that an annotator saw, with the annotations marked correct."""
    return rows.where(F.col(annotators) >= 1).withColumn(annotations, F.filter(annotations, lambda a: F.coalesce(a["correct"], F.lit(False))))


def marked_errors(text: Column, missed: Column, wrong: Column) -> Column:
    """The text with missed spans as [FN: ...] and wrong ones as [FP: ...]; of overlapping spans the first counts."""
    from corpusmill.operators.pii import fold_redaction, merge_spans

    tagged = lambda spans, kind: F.transform(spans, lambda s: F.struct(F.lit(kind).alias("tag"), s["start"].alias("start"), s["end"].alias("end")))
    both = merge_spans(F.concat(tagged(missed, "FN"), tagged(wrong, "FP")))
    return fold_redaction(text, both, lambda s: F.concat(F.lit("["), s["tag"], F.lit(": "), F.substring(text, s["start"] + 1, s["end"] - s["start"]), F.lit("]")))


def entity_scores(references: DataFrame, predictions: DataFrame, key: str = "doc_id") -> DataFrame:
    """(tag, precision, recall, f1, support) over exact matches of (key, tag, start, end)."""
    columns = [key, "tag", "start", "end"]
    r, p = references.select(*columns).distinct(), predictions.select(*columns).distinct()
    every = r.withColumn("r", F.lit(1)).join(p.withColumn("p", F.lit(1)), columns, "full")
    counts = every.groupBy("tag").agg(F.count("r").alias("support"), F.count("p").alias("found"), F.count_if(F.col("r").isNotNull() & F.col("p").isNotNull()).alias("hit"))
    rate = lambda n: F.coalesce(F.try_divide(F.col("hit"), F.col(n)), F.lit(0.0))
    scored = counts.withColumn("precision", rate("found")).withColumn("recall", rate("support"))
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return scored.select("tag", "precision", "recall", f1.alias("f1"), "support")
