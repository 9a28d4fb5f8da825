"""Queries of near-duplicate removal and decontamination."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import decontamination as dc
from corpusmill.operators import dedup, minhash
from corpusmill.operators.graph import connected_components
from corpusmill.plans.registry import query, table
from corpusmill.sources.shared import materialize

#: The default hash family and its bands at a threshold of 0.7; DuckDB evaluates it in its wide integers.
PERMUTATIONS, THRESHOLD = 256, 0.7
BANDS, ROWS = minhash.band_choice(THRESHOLD, PERMUTATIONS)


def _permutations_sql(n: int) -> str:
    """(i, low and high halves of a and b): products of 32-bit halves stay within 64 bits."""
    a, b = minhash.permutations(n)
    halves = lambda x: f"{x & 0xFFFFFFFF}::UBIGINT, {x >> 32}::UBIGINT"
    return ", ".join(f"({i}, {halves(x)}, {halves(y)})" for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)))


def _bands_sql(p: str, source: str, key: str, grams: str, permutations: int, bands: int, rows: int) -> str:
    """Statements that end with ``p``bands (id, band, h); ``grams`` makes a list of the tokens w."""
    return f"""
{p}t AS (SELECT {key} AS doc_id, regexp_split_to_array(text, '[^A-Za-z_0-9]') AS w FROM {source}),
{p}g AS (SELECT doc_id, unnest(list_distinct({grams})) AS gram FROM {p}t),
{p}s AS (SELECT doc_id, sha1(gram) AS h FROM {p}g),
{p}v AS (SELECT DISTINCT doc_id, ('0x' || substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2))::UBIGINT AS x FROM {p}s),
{p}perms(i, al, ah, bl, bh) AS (VALUES {_permutations_sql(permutations)}),
{p}p1 AS (SELECT doc_id, i, x * al AS low, ((x * ah) & 4294967295) + bh AS high, bl FROM {p}v, {p}perms),
{p}p2 AS (SELECT doc_id, i, (low & 4294967295) + bl AS low, high + (low >> 32) AS high FROM {p}p1),
{p}p3 AS (SELECT doc_id, i, low & 4294967295 AS low, (high + (low >> 32)) & 4294967295 AS high FROM {p}p2),
{p}p4 AS (SELECT doc_id, i, (((high & 536870911) << 32) + low) + (high >> 29) AS y FROM {p}p3),
{p}m AS (SELECT doc_id, i, min((CASE WHEN y >= 2305843009213693951 THEN y - 2305843009213693951 ELSE y END) & 4294967295)::BIGINT AS sig FROM {p}p4 GROUP BY doc_id, i),
{p}f AS (SELECT d.doc_id, p.i, coalesce(m.sig, 4294967295) AS sig FROM {p}t d CROSS JOIN {p}perms p LEFT JOIN {p}m m ON m.doc_id = d.doc_id AND m.i = p.i),
{p}bands AS (SELECT doc_id AS id, i // {rows} AS band, string_agg(lower(printf('%08x', sig)), '' ORDER BY i) AS h FROM {p}f WHERE i < {bands * rows} GROUP BY doc_id, i // {rows})"""


GRAMS_SQL = "CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) ELSE [] END"
BANDS_SQL = f"""{_bands_sql("", "documents", "doc_id", GRAMS_SQL, PERMUTATIONS, BANDS, ROWS)},
edges AS (SELECT DISTINCT id AS src, least AS dst FROM (SELECT id, min(id) OVER (PARTITION BY band, h) AS least FROM bands) WHERE id <> least)
"""
COMPONENTS_SQL = """
both_ways AS (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges),
reached AS (SELECT DISTINCT a, a AS b FROM both_ways UNION SELECT r.a, e.b FROM reached r JOIN both_ways e ON r.b = e.a),
components AS (SELECT a AS id, min(b) AS component FROM reached GROUP BY a)
"""


def _signed(spark, sf, **options):
    return materialize(minhash.minhash_signatures(table(spark, sf, "documents"), PERMUTATIONS, **options), "signatures")


@query("minhash_bands", f"WITH {BANDS_SQL} SELECT band, h, id FROM bands")
def minhash_bands(spark, sf):
    return minhash.band_keys(_signed(spark, sf), BANDS, ROWS).select("band", F.lower(F.hex("h")).alias("h"), "id")


@query("lsh_edges", f"WITH {BANDS_SQL} SELECT src, dst FROM edges")
def lsh_edges(spark, sf):
    return minhash.star_edges(minhash.band_keys(_signed(spark, sf), BANDS, ROWS))


def _components(spark, sf):
    return dedup.near_duplicate_components(table(spark, sf, "documents"), THRESHOLD, PERMUTATIONS)


@query("components", f"WITH RECURSIVE {BANDS_SQL}, {COMPONENTS_SQL} SELECT id, component FROM components")
def components(spark, sf):
    return _components(spark, sf)


@query("dedup_keep_least", f"WITH RECURSIVE {BANDS_SQL}, {COMPONENTS_SQL} SELECT doc_id FROM documents LEFT JOIN components ON doc_id = id WHERE component IS NULL OR component = id")
def dedup_keep_least(spark, sf):
    return dedup.keep_least(table(spark, sf, "documents"), _components(spark, sf)).select("doc_id")


@query(
    "dedup_keep_best",
    f"""WITH RECURSIVE {BANDS_SQL}, {COMPONENTS_SQL},
        ranked AS (SELECT d.doc_id, component, row_number() OVER (PARTITION BY component ORDER BY coalesce(quality, 0) DESC, n_chars DESC, d.doc_id) AS n
          FROM documents d LEFT JOIN labels l USING (doc_id) JOIN components ON d.doc_id = id)
        SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM ranked WHERE n > 1)""",
)
def dedup_keep_best(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    order = [-F.coalesce("quality", F.lit(0)), -F.col("n_chars")]
    return dedup.keep_best(docs, _components(spark, sf), order).select("doc_id")


@query("dedup_keep_min", f"WITH RECURSIVE {BANDS_SQL}, {COMPONENTS_SQL} SELECT doc_id, lang, source, n_chars FROM documents LEFT JOIN components ON doc_id = id WHERE component IS NULL OR component = id")
def dedup_keep_min(spark, sf):
    """Near-dedup with the default parameters: 256 permutations, threshold 0.7, 5-grams."""
    docs = table(spark, sf, "documents")
    return dedup.keep_least(docs, _components(spark, sf)).select("doc_id", "lang", "source", "n_chars")


@query("dedup_v2")
def dedup_v2(spark, sf):
    """The second variant; DuckDB has no xxHash of 32 bits, so a brute-force version checks it."""
    docs = table(spark, sf, "documents")
    return dedup.keep_least(docs, dedup.near_duplicate_components(docs, num_perm=250, variant="v2")).select("doc_id", "lang", "source", "n_chars")


@query("dedup_report", f"WITH RECURSIVE {BANDS_SQL}, {COMPONENTS_SQL}, k AS (SELECT count(*) AS n, coalesce(sum(n_chars), 0) AS size FROM components JOIN documents ON doc_id = id WHERE id <> component) SELECT count(*) AS rows_before, sum(n_chars)::BIGINT AS size_before, count(*) - (SELECT n FROM k) AS rows_after, (sum(n_chars) - (SELECT size FROM k))::BIGINT AS size_after, round(100 * (count(*) - (SELECT n FROM k)) / count(*), 2) AS kept_percent FROM documents")
def dedup_report(spark, sf):
    docs = table(spark, sf, "documents")
    return dedup.dedup_report(docs, dedup.keep_least(docs, _components(spark, sf)), F.col("n_chars"))


@query("graph_components", """WITH RECURSIVE e AS (SELECT o_custkey AS src, o_custkey // 3 AS dst FROM orders), b AS (SELECT src AS a, dst AS b FROM e WHERE src <> dst UNION SELECT dst, src FROM e WHERE src <> dst),
    r AS (SELECT a, min(b) AS b FROM b GROUP BY a), x AS (SELECT DISTINCT a FROM b) SELECT a AS id, 0::BIGINT AS component FROM x WHERE a >= 0 UNION SELECT src, src FROM e WHERE src = dst AND src NOT IN (SELECT a FROM b)""")
def graph_components(spark, sf):
    """Keys joined to a third of themselves form one tree with the root 0, which the statement presumes, unless a key on the way is missing."""
    return connected_components(table(spark, sf, "orders").select(F.col("o_custkey").alias("src"), F.expr("o_custkey div 3").alias("dst")))


@query("exact_dedup_first", "SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def exact_dedup_first(spark, sf):
    """Texts are compared by two digests; only digests are shuffled to find the first of each."""
    docs = table(spark, sf, "documents")
    firsts = docs.groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    return docs.select("doc_id", "lang").join(firsts, "doc_id", "left_semi")


@query("repo_file_dedup", "SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1")
def repo_file_dedup(spark, sf):
    return dedup.first_by_key(table(spark, sf, "events"), ["user_id", "event_type"], ["event_id"]).select("event_id", "user_id", "event_type")


NEEDLES_SQL = "needles AS (SELECT 'benchmark' AS benchmark, item_id AS ord, trim(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS needle FROM benchmark WHERE trim(text) <> '')"
MATCHES_SQL = NEEDLES_SQL + ", matches AS (SELECT doc_id, benchmark, ord, needle FROM documents JOIN needles ON contains(lower(text), lower(needle)) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY benchmark, ord) = 1)"


def _matches(spark, sf):
    return dc.substring_matches(table(spark, sf, "documents"), dc.needles_of(table(spark, sf, "benchmark")))


@query("decontam_substring", f"WITH {MATCHES_SQL} SELECT doc_id, benchmark, ord, needle FROM matches")
def decontam_substring(spark, sf):
    return _matches(spark, sf)


@query("decontam_kept", f"WITH {MATCHES_SQL} SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM matches)")
def decontam_kept(spark, sf):
    return dc.split_by_matches(table(spark, sf, "documents"), _matches(spark, sf))[0].select("doc_id")


@query("decontam_meta", f"WITH {MATCHES_SQL} SELECT lang, benchmark || '_match' AS reason, count(*) AS n FROM matches JOIN documents USING (doc_id) GROUP BY 1, 2")
def decontam_meta(spark, sf):
    reasons = _matches(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    return reasons.groupBy("lang", F.concat("benchmark", F.lit("_match")).alias("reason")).agg(F.count("*").alias("n"))


@query(
    "decontam_incremental",
    f"""WITH {NEEDLES_SQL}, old AS (SELECT doc_id, ord, needle FROM documents JOIN needles ON contains(lower(text), lower(needle)) WHERE ord < 10 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ord) = 1),
        new AS (SELECT doc_id, ord, needle FROM documents JOIN needles ON contains(lower(text), lower(needle)) WHERE ord >= 10 AND needle NOT IN (SELECT needle FROM needles WHERE ord < 10)
          AND doc_id NOT IN (SELECT doc_id FROM old) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ord) = 1)
        SELECT doc_id, needle FROM old UNION ALL SELECT doc_id, needle FROM new""",
)
def decontam_incremental(spark, sf):
    docs, needles = table(spark, sf, "documents"), dc.needles_of(table(spark, sf, "benchmark"))
    searched = needles.where("ord < 10")
    return dc.incremental_matches(docs, needles, searched, dc.substring_matches(docs, searched))


TOKEN_SETS_SQL = """
a AS (SELECT doc_id, list_distinct(list_filter(regexp_split_to_array(text, '[^A-Za-z_0-9]'), lambda x: x <> '')) AS s FROM documents),
b AS (SELECT item_id, list_distinct(list_filter(regexp_split_to_array(text, '[^A-Za-z_0-9]'), lambda x: x <> '')) AS s FROM benchmark),
j AS (SELECT doc_id, item_id, len(list_intersect(a.s, b.s)) AS k, len(a.s) AS n, len(b.s) AS m FROM a, b),
sims AS (SELECT doc_id, item_id, k / greatest(1, n + m - k) AS similarity FROM j)
"""


@query("decontam_jaccard", f"WITH {TOKEN_SETS_SQL} SELECT doc_id, item_id, similarity FROM sims WHERE similarity >= 0.2")
def decontam_jaccard(spark, sf):
    return dc.jaccard_pairs(table(spark, sf, "documents"), table(spark, sf, "benchmark"), 0.2)


@query("decontam_near", f"WITH {TOKEN_SETS_SQL} SELECT doc_id, item_id, similarity FROM sims WHERE similarity >= 0.58")
def decontam_near(spark, sf):
    """The default threshold."""
    return dc.jaccard_pairs(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


FILLED_SQL = "list_filter(w, lambda x: x <> '')"


@query(
    "decontam_lsh",
    f"WITH {_bands_sql('d_', 'documents', 'doc_id', FILLED_SQL, 128, *minhash.band_choice(0.25, 128))}, {_bands_sql('i_', 'benchmark', 'item_id', FILLED_SQL, 128, *minhash.band_choice(0.25, 128))} SELECT DISTINCT a.id AS doc_id, b.id AS item_id FROM d_bands a JOIN i_bands b USING (band, h)",
)
def decontam_lsh(spark, sf):
    return dc.lsh_pairs(table(spark, sf, "documents"), table(spark, sf, "benchmark"), 0.25)


@query("decontam_max_similarity", f"WITH {TOKEN_SETS_SQL}, best AS (SELECT doc_id, max(similarity) AS s FROM sims WHERE similarity >= 0.1 GROUP BY doc_id) SELECT count(*) AS n, min(s) AS least, max(s) AS most, avg(s) AS mean FROM best")
def decontam_max_similarity(spark, sf):
    pairs = dc.jaccard_pairs(table(spark, sf, "documents"), table(spark, sf, "benchmark"), 0.1)
    best = pairs.groupBy("doc_id").agg(F.max("similarity").alias("s"))
    return best.agg(F.count("*").alias("n"), F.min("s").alias("least"), F.max("s").alias("most"), F.avg("s").alias("mean"))


@query("benchmark_text", "SELECT item_id, trim(text) || ' ' || length(text) AS assembled FROM benchmark")
def benchmark_text(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", F.concat_ws(" ", F.trim("text"), F.char_length("text").cast("string")).alias("assembled"))


@query("self_jaccard", "WITH a AS (SELECT item_id, list_distinct(list_filter(regexp_split_to_array(text, '[^A-Za-z_0-9]'), lambda x: x <> '')) AS s FROM benchmark) SELECT x.item_id, len(list_intersect(x.s, y.s)) / greatest(1, len(list_distinct(list_concat(x.s, y.s)))) AS similarity FROM a x JOIN a y ON y.item_id = x.item_id + 1")
def self_jaccard(spark, sf):
    a = table(spark, sf, "benchmark").select("item_id", F.array_distinct(tx.filled_tokens(F.col("text"))).alias("s"))
    b = a.select((F.col("item_id") - 1).alias("item_id"), F.col("s").alias("t"))
    return a.join(b, "item_id").select("item_id", tx.jaccard(F.col("s"), F.col("t")).alias("similarity"))
