"""Queries of entity post-processing."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import entities as en
from corpusmill.operators import spans
from corpusmill.plans.registry import query, table
from corpusmill.plans.span_queries import TOKENS_SQL, _tokens

#: An entity of 12 characters at a place of each text that its id chooses, with a tag and a confidence.
ENTITY_SQL = """e AS (SELECT doc_id, text, (['KEY', 'EMAIL', 'PASSWORD', 'NAME'])[doc_id % 4 + 1] AS tag, ((doc_id * 37) % greatest(length(text) - 12, 1))::INT AS start, (doc_id % 10) / 10.0::DOUBLE AS confidence FROM documents),
v AS (SELECT *, substr(text, start + 1, 12) AS value FROM e)"""


def _entities(spark, sf):
    docs = table(spark, sf, "documents")
    tag = F.get(F.array(*map(F.lit, ("KEY", "EMAIL", "PASSWORD", "NAME"))), (F.col("doc_id") % 4).cast("int"))
    start = ((F.col("doc_id") * 37) % F.greatest(F.char_length("text") - 12, F.lit(1))).cast("int")
    rows = docs.select("doc_id", "text", tag.alias("tag"), start.alias("start"), ((F.col("doc_id") % 10) / 10.0).alias("confidence"))
    return rows.withColumn("value", F.substring("text", F.col("start") + 1, F.lit(12))).withColumn("end", F.col("start") + F.char_length("value"))


EDGE_SQL = en.EDGE.replace("'", "''")


@query(
    "entity_trim",
    f"""WITH {ENTITY_SQL}, l AS (SELECT *, ltrim(value, '{EDGE_SQL}') AS l FROM v), r AS (SELECT *, CASE WHEN tag = 'KEY' THEN l ELSE regexp_replace(l, '[^\\p{{L}}\\p{{M}}\\p{{N}}_]+$', '') END AS r FROM l),
        n AS (SELECT *, regexp_replace(r, '^\\s+|\\s+$', '', 'g') AS new FROM r)
        SELECT doc_id, tag, new AS value, (start + greatest(instr(value, new) - 1, 0))::INT AS start, (start + greatest(instr(value, new) - 1, 0) + length(new))::INT AS "end" FROM n""",
)
def entity_trim(spark, sf):
    entity = F.struct("tag", "value", "start", "end")
    return _entities(spark, sf).select("doc_id", tx.let(entity, en.trimmed).alias("e")).select("doc_id", "e.*")


def _distance_sql(words) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"list_min(list_transform([{listed}], lambda w: CASE WHEN instr(prefix, w) > 0 THEN length(prefix) - (instr(prefix, w) - 1 + length(w)) ELSE 100 END))"


PREFIX_SQL = """x AS (SELECT *, lower(regexp_replace(string_split(substr(text, greatest(start - 100, 0) + 1, least(start, 100)), chr(10))[-1], '[\\s''":=(){}\\[\\]_/]', '', 'g')) AS prefix FROM v)"""


@query("trigger_distance", f"WITH {ENTITY_SQL}, {PREFIX_SQL} SELECT doc_id, {_distance_sql(en.TRIGGERS['KEY'])}::INT AS distance FROM x")
def trigger_distance(spark, sf):
    return _entities(spark, sf).select("doc_id", en.trigger_distance(F.col("text"), F.col("start"), en.TRIGGERS["KEY"]).alias("distance"))


NEAR_SQL = " OR ".join(f"(tag = '{tag}' AND {_distance_sql(words)} <= 5)" for tag, words in en.TRIGGERS.items())
BOUND_SQL = {name: "CASE tag " + " ".join(f"WHEN '{t}' THEN {x}" for t, x in bounds.items()) + " END" for name, bounds in (("good", en.GOOD), ("bad", en.BAD))}
LABELS_SQL = f"""{ENTITY_SQL}, {PREFIX_SQL},
t AS (SELECT * REPLACE (CASE WHEN tag IN ('PASSWORD', 'KEY') THEN CASE WHEN {_distance_sql(en.TRIGGERS['PASSWORD'])} <= {_distance_sql(en.TRIGGERS['KEY'])} THEN 'PASSWORD' ELSE 'KEY' END ELSE tag END AS tag) FROM x),
b AS (SELECT doc_id, tag, start, confidence, CASE WHEN {NEAR_SQL} OR confidence >= {BOUND_SQL['good']} THEN 'GOOD' WHEN confidence < {BOUND_SQL['bad']} THEN 'BAD' END AS label FROM t)"""


@query("pseudo_labels", f"WITH {LABELS_SQL} SELECT doc_id, tag, label FROM b")
def pseudo_labels(spark, sf):
    return en.pseudo_labels(_entities(spark, sf)).select("doc_id", "tag", "label")


@query(
    "training_entities",
    f"""WITH {LABELS_SQL}, r AS (SELECT * FROM b WHERE tag NOT IN ('KEY', 'PASSWORD', 'IP_ADDRESS', 'EMAIL') OR coalesce(label, '') = 'GOOD'), wrong AS (SELECT doc_id FROM r WHERE label = 'BAD'),
        k AS (SELECT doc_id, tag, start, confidence FROM r WHERE doc_id NOT IN (SELECT doc_id FROM wrong)),
        h AS (SELECT doc_id, 'NAME' AS tag, (instr(text, 'the ') - 1)::INT AS start FROM documents WHERE contains(text, 'the ') AND doc_id NOT IN (SELECT doc_id FROM wrong))
        SELECT doc_id, tag, start, confidence FROM k UNION ALL SELECT doc_id, tag, start, 1.0 FROM h WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.doc_id = h.doc_id AND h.start < k.start + 12 AND k.start < h.start + 4)""",
)
def training_entities(spark, sf):
    docs = table(spark, sf, "documents").where(F.col("text").contains("the "))
    hits = docs.select("doc_id", F.lit("NAME").alias("tag"), (F.instr("text", "the ") - 1).alias("start")).withColumn("end", F.col("start") + 4)
    whole = en.pseudo_labels(_entities(spark, sf)).withColumn("end", F.col("start") + 12)
    return en.training_entities(whole, hits).select("doc_id", "tag", "start", "confidence")


@query(
    "entity_confidence",
    f"""WITH {TOKENS_SQL}, m AS (SELECT doc_id, pos, s, length(word) AS n, length(word) > 4 AS inside FROM t),
        o AS (SELECT *, inside AND NOT coalesce(lag(inside) OVER (PARTITION BY doc_id ORDER BY pos), false) AS opens FROM m),
        r AS (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM o)
        SELECT doc_id, 'LONG' AS tag, min(s) AS start, max(s + n)::INT AS "end", avg(n / 32.0) AS confidence FROM r WHERE inside GROUP BY doc_id, run""",
)
def entity_confidence(spark, sf):
    words = _tokens(spark, sf)
    labels = words.select("doc_id", "pos", "start", "end", F.when(F.char_length("word") > 4, "I-LONG").otherwise("O").alias("label"), (F.char_length("word") / 32.0).alias("prob"))
    return en.entities_with_confidence(labels)


THE_SQL = """x AS (SELECT doc_id, string_split(text, 'the ') AS w FROM documents WHERE contains(text, 'the ')), u AS (SELECT doc_id, unnest(w[:-2]) AS part, generate_subscripts(w[:-2], 1) AS i FROM x),
r AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'NAME' ELSE 'KEY' END AS tag, (sum(length(part) + 4) OVER (PARTITION BY doc_id ORDER BY i) - 4)::INT AS s FROM u),
p AS (SELECT doc_id, tag, s + (CASE WHEN s % 3 = 0 THEN 1 ELSE 0 END) AS s FROM r WHERE s % 5 <> 0)"""


@query(
    "entity_scores",
    f"""WITH {THE_SQL}, j AS (SELECT coalesce(r.tag, p.tag) AS tag, r.s IS NOT NULL AS a, p.s IS NOT NULL AS b FROM r FULL JOIN p ON r.doc_id = p.doc_id AND r.tag = p.tag AND r.s = p.s),
        c AS (SELECT tag, count(*) FILTER (a) AS support, count(*) FILTER (b) AS found, count(*) FILTER (a AND b) AS hit FROM j GROUP BY tag)
        SELECT tag, hit / found AS precision, hit / support AS recall, 2 * (hit / found) * (hit / support) / (hit / found + hit / support) AS f1, support FROM c""",
)
def entity_scores(spark, sf):
    """Predictions leave out and shift some references."""
    docs = table(spark, sf, "documents").select("doc_id", F.explode(tx.literal_offsets(F.col("text"), F.lit("the "))).alias("start"))
    refs = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, "NAME").otherwise("KEY").alias("tag"), "start").withColumn("end", F.col("start") + 4)
    preds = refs.where("start % 5 <> 0").withColumn("start", F.col("start") + F.when(F.col("start") % 3 == 0, 1).otherwise(0)).withColumn("end", F.col("start") + 4)
    return en.entity_scores(refs, preds)


@query("token_spans", "WITH t AS (SELECT doc_id, regexp_extract_all(text, '[\\p{L}\\p{M}\\p{N}_+.\\-]+|[^\\s]') AS w FROM documents) SELECT doc_id, len(w)::INT AS n, list_sum(list_transform(w, lambda x: length(x)))::INT AS chars FROM t WHERE len(w) > 0")
def token_spans(spark, sf):
    """Combining marks belong to words and only ASCII spaces separate, as in the statement."""
    tokens = en.token_spans(F.col("text"), rf"[\w{en.combining_marks()}+.\-]+|[^ \t\n\f\r]")
    found = table(spark, sf, "documents").select("doc_id", tokens.alias("s")).where(F.size("s") > 0)
    return found.select("doc_id", F.size("s").alias("n"), F.aggregate("s", F.lit(0), lambda a, x: a + x["end"] - x["start"]).alias("chars"))


@query("window_ends", "SELECT conv_id, turn, '<s> ' || text || ' </s>' AS tokens FROM conversations")
def window_ends(spark, sf):
    tokens = en.with_ends(F.split("text", " ", -1), F.lit("<s>"), F.lit("</s>"))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.array_join(tokens, " ").alias("tokens"))


@query("fold_split", "SELECT doc_id, CASE WHEN quality = 1 THEN 'test' ELSE 'train' END AS side FROM labels")
def fold_split(spark, sf):
    train, test = en.split_by_fold(table(spark, sf, "labels"), "quality", 1)
    return train.select("doc_id", F.lit("train").alias("side")).unionByName(test.select("doc_id", F.lit("test").alias("side")))


@query("annotation_fixes", "SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN 'fixed' ELSE lang END AS lang FROM documents d LEFT JOIN labels l USING (doc_id)")
def annotation_fixes(spark, sf):
    fixes = table(spark, sf, "labels").where("toxic = 1").select("doc_id", F.lit("fixed").alias("lang"))
    return en.patched(table(spark, sf, "documents").select("doc_id", "lang"), fixes, "doc_id", "lang")


@query("annotation_tags", "SELECT doc_id, CASE WHEN quality = 1 THEN 'KEY,EMAIL' ELSE 'KEY,NAME' END AS tags FROM labels")
def annotation_tags(spark, sf):
    entity = lambda tag: F.struct(tag.alias("tag"), F.lit("v").alias("value"), F.lit(0).alias("start"), F.lit(1).alias("end"))
    listed = F.array(entity(F.when(F.col("quality") == 1, "API_KEY").otherwise("SSH_KEY")), entity(F.when(F.col("quality") == 1, "EMAIL").otherwise("NAME")))
    return table(spark, sf, "labels").select("doc_id", F.array_join(F.transform(en.converted(listed), lambda a: a["tag"]), ",").alias("tags"))


@query("curated_rows", "SELECT doc_id, CASE WHEN toxic = 1 THEN 'a' ELSE 'a,b' END AS tags FROM labels WHERE quality >= 1")
def curated_rows(spark, sf):
    note = lambda name, ok: F.struct(F.lit(name).alias("tag"), ok.alias("correct"))
    rows = table(spark, sf, "labels").withColumn("annotations", F.array(note("a", F.lit(True)), note("b", F.col("toxic") == 0)))
    return en.curated(rows, "quality").select("doc_id", F.array_join(F.transform("annotations", lambda a: a["tag"]), ",").alias("tags"))


@query(
    "marked_errors",
    "WITH p AS (SELECT doc_id, text, instr(text, 'the ') - 1 AS s FROM documents WHERE instr(text, 'the ') > 1) SELECT doc_id, substr(text, 1, s) || '[FN: the]' || substr(text, s + 4, 1) || '[FP: ' || substr(text, s + 5, 3) || ']' || substr(text, s + 8) AS marked FROM p",
)
def marked_errors(spark, sf):
    docs = table(spark, sf, "documents").withColumn("s", F.instr("text", "the ") - 1).where("s > 0")
    span = lambda a, b: F.array(F.struct((F.col("s") + a).alias("start"), (F.col("s") + b).alias("end")))
    return docs.select("doc_id", en.marked_errors(F.col("text"), span(0, 3), span(4, 7)).alias("marked"))


@query("overlap_lengths", f"WITH {ENTITY_SQL} SELECT doc_id, greatest(least(start + 12, 60) - greatest(start, 20), 0)::INT AS shared FROM v")
def overlap_lengths(spark, sf):
    return _entities(spark, sf).select("doc_id", spans.overlap_length(F.col("start"), F.col("start") + 12, F.lit(20), F.lit(60)).alias("shared"))
