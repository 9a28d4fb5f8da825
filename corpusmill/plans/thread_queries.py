"""Queries of issue threads, commits, notebooks and the language map."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import commits, issues, languages, notebooks
from corpusmill.plans.registry import query, table


def _events(spark, sf):
    """Conversations as issues: role is the author, turns are in order."""
    turns = table(spark, sf, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.col("role").alias("author"), "text"))).alias("e"))
    return turns.select("conv_id", F.transform("e", lambda x: F.struct(x["author"].alias("author"), x["text"].alias("text"))).alias("events"))


@query("issue_counts", "SELECT conv_id, sum(length(text))::BIGINT AS text_size, count(DISTINCT role) AS user_count, count(*) AS event_count FROM conversations GROUP BY conv_id")
def issue_counts(spark, sf):
    e = F.col("events")
    return _events(spark, sf).select("conv_id", issues.size_of(e).cast("long").alias("text_size"), issues.user_count(e).cast("long").alias("user_count"), F.size(e).cast("long").alias("event_count"))


@query("issue_filter", "SELECT conv_id FROM conversations GROUP BY conv_id HAVING sum(length(text)) >= 200 AND (count(DISTINCT role) >= 2 OR (sum(length(text)) <= 7000 AND count(*) <= 10))")
def issue_filter(spark, sf):
    e = F.col("events")
    return _events(spark, sf).where(issues.keeps(issues.user_count(e), issues.size_of(e), F.size(e))).select("conv_id")


@query("issue_truncate", """WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents)
    SELECT doc_id, CASE WHEN len(l) > 12 THEN array_to_string(list_concat(l[1:6], ['[Truncated]'], l[len(l) - 3:len(l)]), chr(10)) ELSE text END AS text FROM l""")
def issue_truncate(spark, sf):
    return table(spark, sf, "documents").select("doc_id", issues.truncate(F.col("text"), 12, 6, 4).alias("text"))


@query("issue_bots", "SELECT conv_id, count(*) FILTER (role <> 'assistant') AS n FROM conversations GROUP BY conv_id")
def issue_bots(spark, sf):
    """The assistant named as a bot; its callers stay, as no text names it or starts with a slash."""
    named = _events(spark, sf).select("conv_id", F.transform("events", lambda e: F.struct(F.when(e["author"] == "assistant", "assistant-ci").otherwise(e["author"]).alias("author"), F.regexp_replace(e["text"], "assistant-ci|^/", "").alias("text"))).alias("events"))
    return named.select("conv_id", F.size(issues.without_bots(F.col("events"))).cast("long").alias("n"))


@query("issue_mask_users", """WITH f AS (SELECT conv_id, role, min(turn) AS first FROM conversations GROUP BY ALL), n AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY first) - 1 AS i FROM f)
    SELECT conv_id, turn, 'username_' || i AS author FROM conversations JOIN n USING (conv_id, role)""")
def issue_mask_users(spark, sf):
    turns = table(spark, sf, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.col("role").alias("author"), "text"))).alias("e"))
    masked = turns.select("conv_id", F.posexplode(F.arrays_zip(F.col("e.turn").alias("turn"), issues.masked(F.col("e")).alias("m"))).alias("i", "x"))
    return masked.select("conv_id", "x.turn", "x.m.author")


@query(
    "issue_pipeline",
    """WITH t AS (SELECT conv_id, turn, role, regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '_{20,}', '', 'g') AS text FROM conversations),
       s AS (SELECT conv_id, sum(length(text))::INT AS text_size, count(DISTINCT role)::INT AS user_count, count(*)::INT AS event_count FROM t GROUP BY conv_id),
       f AS (SELECT conv_id, role, min(turn) AS first FROM t GROUP BY ALL), n AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY first) - 1 AS i FROM f),
       r AS (SELECT conv_id, coalesce(max(role) FILTER (i = 0), chr(1)) AS r0, coalesce(max(role) FILTER (i = 1), chr(1)) AS r1, coalesce(max(role) FILTER (i = 2), chr(1)) AS r2 FROM n GROUP BY conv_id)
       SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS pos, 'username_' || i AS author, replace(replace(replace(text, r0, 'username_0'), r1, 'username_1'), r2, 'username_2') AS text, text_size, user_count, event_count
       FROM t JOIN s USING (conv_id) JOIN n USING (conv_id, role) JOIN r USING (conv_id) WHERE text_size >= 200 AND (user_count >= 2 OR (text_size <= 7000 AND event_count <= 10))""",
)
def issue_pipeline(spark, sf):
    """The whole chain; these conversations hold no mail, long text or bot."""
    kept, _ = issues.run_pipeline(_events(spark, sf))
    return kept.select("conv_id", F.posexplode("events").alias("pos", "e"), "text_size", "user_count", "event_count").select("conv_id", "pos", "e.author", "e.text", "text_size", "user_count", "event_count")


@query("issue_report", """SELECT * FROM (WITH s AS (SELECT conv_id, sum(length(text)) AS size, count(DISTINCT role) AS users, count(*) AS n FROM conversations GROUP BY conv_id), k AS (SELECT * FROM s WHERE size >= 200 AND (users >= 2 OR (size <= 7000 AND n <= 10)))
    SELECT 0 AS step, 'loaded' AS name, (SELECT count(*) FROM s)::BIGINT AS rows, (SELECT sum(size) FROM s)::BIGINT AS size UNION ALL SELECT 1, 'truncate', (SELECT count(*) FROM s), (SELECT sum(size) FROM s)
    UNION ALL SELECT 2, 'bots', (SELECT count(*) FROM s), (SELECT sum(size) FROM s) UNION ALL SELECT 3, 'users and size', (SELECT count(*) FROM k), (SELECT sum(size) FROM k))""")
def issue_report(spark, sf):
    """Rows and characters after each step; these conversations hold no mail, long text or bot."""
    return issues.run_pipeline(_events(spark, sf))[1]


def _commits(spark, sf):
    """Consecutive documents as the two sides of a commit; the subject is the new side's first line."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    old = docs.select((F.col("doc_id") + 1).alias("doc_id"), F.col("text").alias("old"))
    return docs.join(old, "doc_id").select("doc_id", "old", F.col("text").alias("new"), F.substring_index("text", "\n", 1).alias("subject"), F.concat(F.lit("a/f."), "lang").alias("path"))


@query("line_diff")
def line_diff(spark, sf):
    return _commits(spark, sf).select("doc_id", commits.diff_stats("old", "new").alias("d")).select("doc_id", "d.*")


from corpusmill.plans.text_queries import uniform_sql  # noqa: E402


@query(
    "commit_filter",
    f"""WITH s AS (SELECT doc_id, string_split(text, chr(10))[1] AS subject, text FROM documents),
        w AS (SELECT *, lower(subject) AS l, len(list_filter(regexp_split_to_array(subject, '\\s+'), lambda x: x <> '')) AS n FROM s)
        SELECT doc_id FROM w WHERE text <> '' AND n > 0 AND NOT contains(l, 'auto commit') AND NOT contains(l, 'update contributing') AND NOT contains(l, '<?xml')
          AND l NOT IN ('readme', 'update', 'dummy', 'updated', 'debug', 'test', 'update readme', 'update readme.md', 'updated readme.md', 'updated readme')
          AND (n >= 5 OR {uniform_sql('brief', 'doc_id')} <= 0.5) AND NOT regexp_matches(l, '^(?:v)?[0-9]+\\.[0-9]+\\.[0-9]+($|\\S)') AND length(subject) <= 20 * n AND NOT (starts_with(l, ' ') AND n = 1)
          AND (doc_id % 5 <> 0 OR {uniform_sql('short', 'doc_id')} <= 0.1)""",
)
def commit_filter(spark, sf):
    docs = table(spark, sf, "documents").withColumn("subject", F.substring_index("text", "\n", 1))
    changed = F.when(F.col("doc_id") % 5 == 0, 1).otherwise(50)
    return docs.where(commits.keeps(F.col("doc_id"), F.col("text"), F.lit("a/f.py"), F.col("subject"), changed)).select("doc_id")


@query("commit_windows")
def commit_windows(spark, sf):
    rows = _commits(spark, sf).withColumn("d", commits.diff_stats("old", "new"))
    text = commits.training_text(F.col("doc_id"), F.col("old"), F.col("new"), F.col("subject"), F.col("d"))
    return rows.select("doc_id", text.alias("content")).withColumn("size", F.char_length("content"))


RUNS_SQL = "c AS (SELECT *, (coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn) <> role, true))::INT AS changes FROM conversations), r AS (SELECT *, sum(changes) OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS run FROM c)"


@query("run_length_roles", f"WITH {RUNS_SQL} SELECT conv_id, run::BIGINT AS run, role, min(turn) AS first, count(*) AS n FROM r GROUP BY conv_id, run, role")
def run_length_roles(spark, sf):
    return notebooks.run_lengths(table(spark, sf, "conversations"), "conv_id", "turn", "role")


@query(
    "pair_turns",
    f"""WITH c0 AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'code' ELSE 'markdown' END AS role, text FROM conversations),
        c AS (SELECT *, (coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn) <> role, true))::INT AS changes FROM c0),
        r AS (SELECT *, sum(changes) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM c),
        g AS (SELECT conv_id, run, role, string_agg(replace(replace(regexp_replace(text, '<.*?>', '', 'g'), chr(10), ''), '#', ''), ' ' ORDER BY turn) AS md, string_agg(text, chr(10) ORDER BY turn) AS code, arg_max(text, turn) AS last_text, max(run) OVER (PARTITION BY conv_id) AS top FROM r GROUP BY conv_id, run, role),
        k AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY run) - 1 AS i FROM g WHERE NOT (run = 1 AND role = 'code') AND NOT (run = top AND role = 'markdown'))
        SELECT a.conv_id, (a.i // 2)::INT AS pair, a.md AS markdown, b.code, b.last_text AS output FROM k a JOIN k b ON a.conv_id = b.conv_id AND b.i = a.i + 1 WHERE a.n % 2 = 0 AND a.i % 2 = 0""",
)
def pair_turns(spark, sf):
    rows = table(spark, sf, "conversations").withColumn("role", F.when(F.col("role") == "assistant", "code").otherwise("markdown"))
    return notebooks.triplets(rows.withColumn("out", F.col("text")), "conv_id", "turn", "role", "text", "out")


@query("concat_islands", """WITH o AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS spot FROM conversations), c AS (SELECT *, (coalesce(lag(role) OVER (ORDER BY spot) <> role, true))::INT AS breaks FROM o),
    r AS (SELECT *, sum(breaks) OVER (ORDER BY spot) AS run FROM c) SELECT role, min(conv_id * 1000 + turn)::BIGINT AS first, '<jupyter_start>' || string_agg(text, '' ORDER BY spot) AS content, count(*)::INT AS chain_length FROM r GROUP BY run, role""")
def concat_islands(spark, sf):
    """Turns in order of conversation and turn; a role that comes again after another starts a new chain."""
    turns = table(spark, sf, "conversations").withColumn("at", F.col("conv_id") * 1000 + F.col("turn"))
    return notebooks.chain(turns, "role", "at", "text")


@query("structured_text", """SELECT conv_id, turn, '<jupyter_text>' || regexp_replace(text, '^\\s+|\\s+$', '', 'g') || '<jupyter_code>' || role || '<jupyter_output>' || regexp_replace(CASE WHEN length(text) > 1000 THEN substr(text, 1, 1000) || '[...]' ELSE text END, '^\\s+|\\s+$', '', 'g') AS content FROM conversations""")
def structured_text(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", notebooks.structured(F.col("text"), F.col("role"), F.col("text")).alias("content"))


PAIRS = [("C", [".c", ".h", ".cats"]), ("C++", [".cpp", ".h", ".hh"]), ("Objective-C", [".h", ".mm"]), ("PLSQL", [".sql", ".pls"]), ("SQL", [".sql"]), ("HyPhy", [".bf"]), ("Perl", [".pl", ".t", ".v"]), ("Raku", [".t", ".pl"])]
#: A few known languages, and the languages of documents with their sources as extensions.
PAIRS_SQL = "known(name, extension) AS (VALUES " + ", ".join(f"('{n}', '{e}')" for n, es in PAIRS for e in es) + "), pairs AS (SELECT * FROM known UNION ALL SELECT DISTINCT lang, '.' || source FROM documents)"


def _pairs(spark, sf):
    listed = table(spark, sf, "documents").groupBy(F.col("lang").alias("name")).agg(F.collect_set(F.concat(F.lit("."), "source")).alias("extensions"))
    return languages.exploded(languages.appended(spark.createDataFrame(PAIRS, "name string, extensions array<string>"), listed))


@query("lang_ext_clashes", f"WITH {PAIRS_SQL} SELECT extension, array_to_string(list_sort(list(DISTINCT name)), ',') AS names, count(DISTINCT name) AS n FROM pairs GROUP BY extension HAVING count(DISTINCT name) > 1")
def lang_ext_clashes(spark, sf):
    return languages.clashes(_pairs(spark, sf)).withColumn("names", F.array_join("names", ","))


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


OWNERS_SQL = "owners(extension, owner) AS (VALUES " + ", ".join(f"({_sql_list(x)})" for x in languages.OWNERS.items()) + ")"


@query(
    "lang_ext_resolve",
    f"""WITH {PAIRS_SQL}, {OWNERS_SQL}, k AS (SELECT CASE WHEN name IN ('PLSQL', 'PLpgSQL', 'SQLPL') THEN 'SQL' WHEN name = 'M4Sugar' THEN 'M4' ELSE name END AS name, extension FROM pairs
          WHERE name <> 'HyPhy' AND extension NOT IN ({_sql_list(languages.DROPPED_EXTENSIONS)}))
        SELECT DISTINCT name, extension FROM k LEFT JOIN owners USING (extension) WHERE owner IS NULL OR owner = name""",
)
def lang_ext_resolve(spark, sf):
    return languages.resolve(_pairs(spark, sf))


@query("lang_regroup", f"WITH {PAIRS_SQL} SELECT name, array_to_string(list_sort(list(DISTINCT extension)), ',') AS extensions FROM pairs GROUP BY name")
def lang_regroup(spark, sf):
    return languages.regrouped(_pairs(spark, sf)).withColumn("extensions", F.array_join("extensions", ","))


@query("lang_difference", f"WITH {PAIRS_SQL} SELECT DISTINCT name, 'first' AS side FROM pairs WHERE name NOT IN ('C', 'SQL', 'fr') UNION ALL SELECT 'Zig', 'second'")
def lang_difference(spark, sf):
    baseline = spark.createDataFrame([("C",), ("SQL",), ("Zig",), ("fr",)], "name string")
    return languages.difference(_pairs(spark, sf), baseline)


@query("owner_opt_out", "WITH r AS (SELECT l_orderkey, l_linenumber, list_filter(['u' || (l_partkey % 7) || '/a', 'v' || (l_suppkey % 5) || '/b'], lambda x: string_split(x, '/')[1] NOT IN ('u1', 'u3', 'v2')) AS left_over FROM lineitem) SELECT l_orderkey, l_linenumber, array_to_string(left_over, ',') AS repos FROM r WHERE len(left_over) > 0")
def owner_opt_out(spark, sf):
    from corpusmill.operators.filters import without_owners

    rows = table(spark, sf, "lineitem")
    repos = F.concat(F.lit("u"), F.col("l_partkey") % 7, F.lit("/a,v"), F.col("l_suppkey") % 5, F.lit("/b"))
    return rows.select("l_orderkey", "l_linenumber", without_owners(repos, ["u1", "u3", "v2"]).alias("repos")).where("repos is not null")


@query(
    "notebook_cells",
    """SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'code' ELSE 'markdown' END AS type, text AS src, CASE WHEN role = 'assistant' AND turn % 2 = 1 THEN text ELSE '_____no_output_____' END AS out
       FROM conversations WHERE text <> ''""",
)
def notebook_cells(spark, sf):
    """Conversations written as notebooks and parsed again; sources are lists of lines or strings."""
    code = F.col("role") == "assistant"
    lines = F.transform(F.split("text", "(?<=\n)", -1), lambda x: x)
    quoted = F.regexp_replace(F.to_json(F.struct(F.col("text").alias("t"))), r'^\{"t":|\}$', "")
    source = F.when(F.col("turn") % 3 == 0, F.to_json(lines)).otherwise(quoted)
    outputs = F.when(code & (F.col("turn") % 2 == 1), F.concat(F.lit('[{"text":'), F.to_json(lines), F.lit("}]"))).otherwise("[]")
    cell = F.concat(F.lit('{"cell_type":"'), F.when(code, "code").otherwise("markdown"), F.lit('","source":'), source, F.lit(',"outputs":'), outputs, F.lit("}"))
    turns = table(spark, sf, "conversations").where("text <> ''").select("conv_id", "turn", cell.alias("cell"))
    books = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "cell"))).alias("c"))
    content = F.concat(F.lit('{"metadata":{"kernelspec":{"name":"python3"}},"cells":['), F.array_join(F.transform("c", lambda x: x["cell"]), ","), F.lit("]}"))
    parsed = books.select("conv_id", F.col("c.turn").alias("turns"), content.alias("content")).where(notebooks.is_python(F.col("content")))
    cells = parsed.select("conv_id", F.explode(F.arrays_zip("turns", notebooks.parse_cells(F.col("content")).alias("cells"))).alias("x"))
    return cells.select("conv_id", F.col("x.turns").alias("turn"), "x.cells.type", "x.cells.src", "x.cells.out")


@query("script_extensions", "SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN '.jl' WHEN conv_id % 3 = 1 THEN '.py' END AS extension FROM (SELECT DISTINCT conv_id FROM conversations)")
def script_extensions(spark, sf):
    """Languages by the metadata's extension, by a Python kernel, or unknown."""
    ids = table(spark, sf, "conversations").select("conv_id").distinct()
    meta = F.when(F.col("conv_id") % 3 == 0, '{"metadata":{"language_info":{"file_extension":".jl"}}}').when(F.col("conv_id") % 3 == 1, '{"metadata":{"kernelspec":{"name":"python3"}}}').otherwise('{"metadata":{}}')
    return ids.select("conv_id", notebooks.script_extension(meta).alias("extension"))


@query("event_texts", "SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN text WHEN turn % 3 = 1 THEN role ELSE '' END AS text FROM conversations")
def event_texts(spark, sf):
    """A comment, else a description, else nothing."""
    comment = F.when(F.col("turn") % 3 == 0, F.col("text")).when(F.col("turn") % 3 == 1, "")
    description = F.when(F.col("turn") % 3 != 2, F.col("role"))
    return table(spark, sf, "conversations").select("conv_id", "turn", issues.event_text(comment, description).alias("text"))
