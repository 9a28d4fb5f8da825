"""Queries of personal data, spans and their evaluation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import pii, spans
from corpusmill.plans.registry import query, table

#: Shapes that DuckDB can search for; on these texts they find what the detector's wider patterns find.
EMAIL = r"""[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}(?:[\s,!?;:"()<>]|\.\s|\.$|$)"""
IP_ANY = r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"
VALID_SQL = "list_bool_and(list_transform(string_split(ip, '.'), lambda p: p::INT <= 255 AND (p = '0' OR NOT starts_with(p, '0'))))"
NUMBER_SQL = "(string_split(ip, '.')[1]::BIGINT * 16777216 + string_split(ip, '.')[2]::BIGINT * 65536 + string_split(ip, '.')[3]::BIGINT * 256 + string_split(ip, '.')[4]::BIGINT)"
PRIVATE_SQL = " OR ".join(
    f"({NUMBER_SQL} BETWEEN {sum(int(x) << 8 * (3 - i) for i, x in enumerate(a.split('.')))} AND {sum(int(x) << 8 * (3 - i) for i, x in enumerate(a.split('.'))) + 2 ** (32 - n) - 1})" for a, n in tx.PRIVATE_IPV4
)


@query("email_hits", f"SELECT doc_id, len(regexp_extract_all(text, '{EMAIL}')) AS n FROM documents WHERE regexp_matches(text, '{EMAIL}')")
def email_hits(spark, sf):
    found = F.size(F.filter("secrets", lambda s: s["tag"] == "EMAIL"))
    return _scanned(spark, sf).select("doc_id", found.cast("long").alias("n")).where("n > 0")


#: Quads with their surroundings of 100 characters; one-digit quads are versions unless dns or server is near.
QUADS_SQL = f"""
x AS (SELECT doc_id, text, unnest(regexp_extract_all(text, '{IP_ANY}')) AS ip FROM documents),
y AS (SELECT DISTINCT doc_id, ip, instr(text, ip) AS spot, lower(substr(text, greatest(instr(text, ip) - 100, 1), least(instr(text, ip) - 1, 100) + length(ip) + 100)) AS near FROM x),
q AS (SELECT *, length(ip) = 7 AND NOT (contains(near, 'dns') OR contains(near, 'server')) AS version FROM y)
"""


#: Quads between the separators that the detector asks for.
EDGES = r"""[\s@,?!;:''"()\[\]{}<>=|\\*#&/¿¡]"""
PARTED_SQL = QUADS_SQL.replace(f"regexp_extract_all(text, '{IP_ANY}')", f"regexp_extract_all(text, '(?m)(?:^|{EDGES})({IP_ANY})(?:$|{EDGES}|\\.(?:\\s|$))', 1)")


@query("ipv4_hits", f"WITH {PARTED_SQL} SELECT doc_id, ip, {VALID_SQL} AND ({PRIVATE_SQL}) AS private FROM q WHERE {VALID_SQL} AND NOT version")
def ipv4_hits(spark, sf):
    ips = _scanned(spark, sf).select("doc_id", F.explode(F.filter("secrets", lambda s: (s["tag"] == "IP_ADDRESS") & ~s["value"].contains(":"))).alias("s")).select("doc_id", F.col("s.value").alias("ip")).distinct()
    return ips.select("doc_id", "ip", tx.is_private_ip(F.col("ip")).alias("private"))


@query("ip_version_filter", f"WITH {QUADS_SQL} SELECT doc_id, ip, version FROM q")
def ip_version_filter(spark, sf):
    ips = table(spark, sf, "documents").select("doc_id", "text", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(IP_ANY), F.lit(0)))).alias("ip"))
    start = F.instr("text", F.col("ip")) - 1
    near = tx.context(F.col("text"), start, start + F.char_length("ip"), 100)
    return ips.select("doc_id", "ip", pii.is_version_column(F.col("ip"), near).alias("version"))


@query("many_hashes", "WITH c AS (SELECT doc_id, lower(text) AS l, floor(0.02 * (length(text) - length(replace(text, chr(10), '')))) AS least FROM documents) SELECT doc_id FROM c WHERE (length(l) - length(replace(l, 'sha', ''))) // 3 > least OR (length(l) - length(replace(l, 'hash', ''))) // 4 > least")
def many_hashes(spark, sf):
    return table(spark, sf, "documents").where(pii.has_many_hashes(F.col("text"))).select("doc_id")


@query(
    "secret_context_hash",
    r"""WITH f AS (SELECT doc_id, text, unnest(list_distinct(list_filter(string_split(text, '"'), lambda x: regexp_full_match(x, '[0-9a-f]{40}')))) AS value FROM documents WHERE contains(text, '"')),
        l AS (SELECT doc_id, value, lower(string_split(substr(text, 1, instr(text, value) - 1), chr(10))[-1]) AS line FROM f)
        SELECT doc_id, value, contains(line, 'sha') OR contains(line, 'md5') OR contains(line, 'hash') OR contains(line, 'byte') AS hash FROM l""",
)
def secret_context_hash(spark, sf):
    values = F.array_distinct(F.filter(F.split("text", '"', -1), lambda x: x.rlike("^[0-9a-f]{40}$")))
    found = table(spark, sf, "documents").select("doc_id", "text", F.explode(values).alias("value"))
    return found.select("doc_id", "value", pii.follows_hash_word(F.col("text"), F.col("value")).alias("hash"))


def _scanned(spark, sf):
    return pii.scan(table(spark, sf, "documents"))


@query("pii_scan")
def pii_scan(spark, sf):
    return _scanned(spark, sf).select("doc_id", F.to_json("secrets").alias("secrets"), "has_secrets", "number_secrets")


@query("pii_counters")
def pii_counters(spark, sf):
    return pii.counters(_scanned(spark, sf))


@query("redact")
def redact(spark, sf):
    return pii.redact(_scanned(spark, sf), pii.POOLS).where("modified").select("doc_id", "new_content", "modified")


@query("pii_tag_counts")
def pii_tag_counts(spark, sf):
    return _scanned(spark, sf).select(F.explode("secrets").alias("s")).groupBy("s.tag").agg(F.count("*").alias("n"))


#: References: all places of 'the ' in a text; predictions: the same shifted by doc_id mod 3 characters, and none where that is 2.
REF_SQL = """x AS (SELECT doc_id, string_split(text, 'the ') AS w FROM documents WHERE contains(text, 'the ')),
u AS (SELECT doc_id, unnest(w[:-2]) AS part, generate_subscripts(w[:-2], 1) AS i FROM x),
r AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'NAME' ELSE 'KEY' END AS tag, (sum(length(part) + 4) OVER (PARTITION BY doc_id ORDER BY i) - 4)::INT AS s FROM u),
p AS (SELECT doc_id, tag, s + (doc_id % 3)::INT AS s FROM r WHERE doc_id % 3 <> 2)"""


@query(
    "eval_intervals",
    f"""WITH {REF_SQL}, m AS (SELECT p.tag, p.doc_id, p.s, bool_or(greatest(least(p.s + 4, r.s + 4) - greatest(p.s, r.s), 0) / 4.0 > 0.8) AS hit FROM p JOIN r USING (doc_id, tag) WHERE r.s BETWEEN p.s - 4 AND p.s + 4 GROUP BY ALL),
        c AS (SELECT tag, count(*) FILTER (hit) AS tp, count(*) AS n_pred FROM m GROUP BY tag), n AS (SELECT tag, count(*) AS n_ref FROM r GROUP BY tag)
        SELECT tag, tp, n_pred - tp AS fp, n_ref - tp AS fn, tp / (tp + n_ref - tp) AS recall, tp / n_pred AS precision FROM c JOIN n USING (tag)""",
)
def eval_intervals(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.explode(tx.literal_offsets(F.col("text"), F.lit("the "))).alias("start"))
    refs = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, "NAME").otherwise("KEY").alias("tag"), "start").withColumn("end", F.col("start") + 4)
    shifted = (F.col("start") + F.col("doc_id") % 3).cast("int")
    preds = refs.where("doc_id % 3 <> 2").withColumn("start", shifted).withColumn("end", F.col("start") + 4)
    return spans.rates(spans.match_counts(refs, preds))


TOKENS_SQL = "w AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents), v AS (SELECT doc_id, unnest(w) AS word, (generate_subscripts(w, 1) - 1)::INT AS pos FROM w), t AS (SELECT doc_id, pos, word, (sum(length(word) + 1) OVER (PARTITION BY doc_id ORDER BY pos) - length(word) - 1)::INT AS s FROM v)"


def _tokens(spark, sf):
    placed = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", " ", -1)).alias("pos", "word"))
    ends = F.sum(F.char_length("word") + 1).over(Window.partitionBy("doc_id").orderBy("pos")).cast("int")
    return placed.withColumn("end", ends - 1).withColumn("start", F.col("end") - F.char_length("word"))


@query(
    "bio_label",
    f"""WITH {TOKENS_SQL}, x AS (SELECT doc_id, pos, s, s + length(word) AS e FROM t),
        h AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM x WHERE s < 30 AND 10 < e)
        SELECT x.doc_id, x.pos, CASE WHEN n IS NULL THEN 'O' WHEN n = 1 THEN 'B-NAME' ELSE 'I-NAME' END AS label FROM x LEFT JOIN h USING (doc_id, pos)""",
)
def bio_label(spark, sf):
    tokens = _tokens(spark, sf)
    entities = table(spark, sf, "documents").select("doc_id", F.lit(0).alias("nr"), F.lit("NAME").alias("tag"), F.lit(10).alias("start"), F.lit(30).alias("end"))
    return spans.bio_labels(tokens, entities)


@query(
    "bio_entities",
    f"""WITH {TOKENS_SQL}, m AS (SELECT doc_id, pos, length(word) > 4 AS inside FROM t),
        o AS (SELECT *, inside AND NOT coalesce(lag(inside) OVER (PARTITION BY doc_id ORDER BY pos), false) AS opens FROM m),
        r AS (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM o)
        SELECT doc_id, 'LONG' AS tag, min(pos) AS first, max(pos) AS last, count(*) AS n FROM r WHERE inside GROUP BY doc_id, run""",
)
def bio_entities(spark, sf):
    labels = _tokens(spark, sf).select("doc_id", "pos", F.when(F.char_length("word") > 4, "I-LONG").otherwise("O").alias("label"))
    return spans.bio_entities(labels)


@query("chunk_windows", "WITH w AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents) SELECT doc_id, i::INT AS chunk_id, (i * 64)::INT AS \"offset\", len(w[i * 64 + 1:i * 64 + 128])::INT AS n, w[i * 64 + 1] AS first FROM w, unnest(range(0, (len(w) + 63) // 64)) u(i)")
def chunk_windows(spark, sf):
    chunks = table(spark, sf, "documents").select("doc_id", F.explode(spans.windows(F.split("text", " ", -1), 128, 1)).alias("c"))
    return chunks.select("doc_id", "c.chunk_id", "c.offset", F.size("c.tokens").alias("n"), F.get("c.tokens", F.lit(0)).alias("first"))


SCORES_SQL = "s AS (SELECT doc_id, p AS pos, c AS chunk_id, l AS label, ((doc_id * 7 + p * 3 + c * 5 + l * 11) % 13 + 1)::DOUBLE AS score FROM documents, unnest(range(0, 6)) a(p), unnest(range(0, 2)) b(c), unnest(range(0, 3)) d(l))"


def _scores(spark, sf):
    grid = table(spark, sf, "documents").select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("pos")).select("*", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("chunk_id")).select("*", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("label"))
    return grid.withColumn("score", ((F.col("doc_id") * 7 + F.col("pos") * 3 + F.col("chunk_id") * 5 + F.col("label") * 11) % 13 + 1).cast("double"))


@query("chunk_combine", f"WITH {SCORES_SQL}, g AS (SELECT doc_id, pos::INT AS pos, label::INT AS label, sum(score) AS total FROM s GROUP BY ALL) SELECT doc_id, pos, label, total / sum(total) OVER (PARTITION BY doc_id, pos) AS score FROM g")
def chunk_combine(spark, sf):
    return spans.combine_scores(_scores(spark, sf))


@query("argmax_label", f"WITH {SCORES_SQL} SELECT doc_id, pos::INT AS pos, (list_position(list(score ORDER BY label), max(score)) - 1)::INT AS best, exp(max(score)) / sum(exp(score)) AS p FROM s WHERE chunk_id = 0 GROUP BY doc_id, pos")
def argmax_label(spark, sf):
    rows = _scores(spark, sf).where("chunk_id = 0").groupBy("doc_id", "pos").agg(F.transform(F.sort_array(F.collect_list(F.struct("label", "score"))), lambda x: x["score"]).alias("v"))
    return rows.select("doc_id", "pos", spans.argmax(F.col("v")).alias("best"), F.array_max(spans.softmax(F.col("v"))).alias("p"))


@query("exclude_overlaps", f"WITH {TOKENS_SQL} SELECT doc_id, count(*) FILTER (NOT (s < 60 AND 20 < s + length(word))) AS kept FROM t WHERE length(word) > 0 GROUP BY doc_id")
def exclude_overlaps(spark, sf):
    words = _tokens(spark, sf).where(F.char_length("word") > 0).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("e"))
    other = F.array(F.struct(F.lit(20).alias("start"), F.lit(60).alias("end")))
    return words.select("doc_id", F.size(spans.exclude_overlapping(F.col("e"), other)).cast("long").alias("kept"))
