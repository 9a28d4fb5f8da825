"""Line dedup by a log-template tree, in DataFrame functions alone.

A line's leaf is its number of tokens and its leading tokens; a token with a digit is variable wherever it
stands. Within a leaf a field is constant where its token recurs over documents and variable elsewhere,
which gives the line's template. Lines whose template recurs across documents are dropped, and long lines
already when a few documents hold them as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import SPACES, in_bitmap, key_bitmap, materialize, text_of

#: Leading tokens of a leaf, documents from which something recurs, and share of constant fields.
LEADING, DOCUMENTS, CONSTANT_SHARE = 2, 10, 0.5
#: Tokens of a long line, and documents from which it recurs.
LONG_TOKENS, LONG_DOCUMENTS = 20, 3
VARIABLE = "<*>"
#: Bytes of leading tokens that stand in a leaf's key as they are; a digest and its mark take 33.
LEAF_BYTES = 32


def _masked_lines(text: Column) -> Column:
    """The lines of a text with tokens parted by one space and tokens with a digit masked; lines without a token are empty.

    Most texts have no odd spaces and most lines no digit; plain searches spare them the replacements.
    """
    odd = text.startswith(" ") | text.endswith(" ")
    for found in ("  ", "\t", "\x0b", "\x0c", "\r", "\n ", " \n"):
        odd = odd | text.contains(found)
    tidy = F.regexp_replace(F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " "), r"(?:^|(?<=\n))\x20|\x20(?=\n|$)", "")
    lines = F.split(F.when(odd, tidy).otherwise(text), "\n", -1)
    masked = lambda x: F.when(x.rlike("[0-9]"), F.regexp_replace(x, r"(?<![^\x20])[^\x20\n0-9]*+[0-9][^\x20\n]*+", VARIABLE)).otherwise(x)
    return F.transform(lines, masked)


def _size(masked: Column) -> Column:
    """Number of tokens of a masked line that has one."""
    return F.octet_length(masked) - F.octet_length(F.replace(masked, F.lit(" "), F.lit(""))) + 1


def _key(*parts: Column) -> Column:
    """A key of 128 bits."""
    return F.unhex(F.md5(F.concat_ws("\n", *parts).cast("binary")))


def _leaf(masked: Column, size: Column, leading: int) -> Column:
    """The number of tokens and the leading tokens; the latter as a digest if they are long, which is longer than any that stand as they are."""
    first = F.substring_index(masked, " ", leading)
    return F.concat(size.cast("string"), F.lit("\n"), F.when(F.octet_length(first) <= LEAF_BYTES, first).otherwise(F.concat(F.lit("#"), F.md5(first.cast("binary")))))


def _in_leaves(text: Column, leading: int) -> Column:
    """(text, n, leaf) of the masked lines of a text that have a token, each once; n is the number of tokens."""
    worded = F.filter(F.array_distinct(_masked_lines(text)), lambda t: F.trim(t) != "")
    sized = F.transform(worded, lambda t: F.struct(t.alias("text"), _size(t).alias("n")))
    return F.transform(sized, lambda t: F.struct(t["text"].alias("text"), t["n"].alias("n"), _leaf(t["text"], t["n"], leading).alias("leaf")))


def _digest(masked: Column) -> Column:
    return F.unhex(F.md5(masked.cast("binary")))


def _constant_tokens(masked: Column, size: Column) -> Column:
    """Tokens of a masked line of ``size`` tokens that are not variable; most lines have no variable one."""
    marked = F.concat(F.lit(" "), F.replace(masked, F.lit(" "), F.lit("  ")), F.lit(" "))
    rest = F.replace(marked, F.lit(f" {VARIABLE} "), F.lit(""))
    return F.when(masked.contains(VARIABLE), size - ((F.octet_length(marked) - F.octet_length(rest)) / (len(VARIABLE) + 2)).cast("int")).otherwise(size)


def _open(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows whose ``key`` may be among ``keys``; an exact join must follow."""
    return in_bitmap(df, F.xxhash64(key), key_bitmap(keys.select(F.xxhash64(key).alias("key")), "key"), "open").where("open").drop("open")


def drop_templates(
    docs: DataFrame,
    leading: int = LEADING,
    documents: int = DOCUMENTS,
    constant_share: float = CONSTANT_SHARE,
    long_tokens: int = LONG_TOKENS,
    long_documents: int = LONG_DOCUMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row a document: id, n_lines (with a token), n_dropped, text without the dropped lines.

    Lines are parted by newlines. A field is constant if ``documents`` distinct documents of the leaf have its
    token there; a template recurs if ``documents`` have it and at least ``constant_share`` of its fields are
    constant. A line of ``long_tokens`` tokens or more also goes if ``long_documents`` have it with the same
    tokens, digits aside, and that share of its tokens has no digit. Documents of one text count once, so a
    document is not emptied for having exact copies.

    Null texts count as empty, null ids pass through, repeated rows get the same result each, a very long text is
    as many lines as it has, an empty table gives no row. Counts are summed before the shuffle. Fields meet documents only for
    lines that fewer than ``documents`` hold; the fields of all others are constant by that alone. Texts reach a
    shuffle as digests, but for lines of recurring leaves and texts that lose a line (bitmaps of fixed size tell).
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    row_key = F.xxhash64("id", "text")
    digests = F.transform("lines", lambda x: F.struct(x["leaf"].alias("leaf"), _digest(x["text"]).alias("line"), x["n"].alias("n"), _constant_tokens(x["text"], x["n"]).alias("c")))
    lined = rows.select(row_key.alias("row"), _digest(F.col("text")).alias("identity"), _in_leaves(F.col("text"), leading).alias("lines"))
    table = materialize(lined.select(F.monotonically_increasing_id().alias("rid"), "row", "identity", digests.alias("lines")), "lines")

    # of equal texts one stands for all: only the others are joined away, so nothing below counts a text twice
    firsts = table.groupBy("identity").agg(F.min("rid").alias("rid"), F.max("rid").alias("most")).where("rid < most")
    copied = _open(table.select("identity", "rid"), "identity", firsts)
    copies = materialize(copied.join(firsts.select("identity", F.col("rid").alias("kept")), "identity").where("rid <> kept").select("rid"), "copies")
    doubt = in_bitmap(table, F.col("rid"), key_bitmap(copies.select(F.col("rid").alias("key")), "key"), "open")
    single = doubt.where(~F.col("open")).select("rid", "lines").unionByName(doubt.where("open").join(copies, "rid", "left_anti").select("rid", "lines"))
    leaves = single.select(F.explode(F.array_distinct("lines.leaf")).alias("leaf")).groupBy("leaf").count().where(F.col("count") >= documents).select("leaf")
    leaves = materialize(leaves, "leaves")
    lines = single.select("rid", F.explode("lines").alias("x")).select("rid", "x.*")
    held = lines.groupBy("line").agg(F.count("*").alias("held"), F.first("n").alias("n"), F.first("c").alias("c"))
    held = materialize(held.where(F.col("held") >= min(documents, long_documents)), "held")
    full = held.where(F.col("held") >= documents).select("line")
    long = held.where((F.col("held") >= long_documents) & (F.col("n") >= long_tokens) & (F.col("c") >= constant_share * F.col("n"))).select("line")

    # the tokens of each distinct line of a recurring leaf, and whether enough documents hold it
    texts = rows.select(F.explode(_in_leaves(F.col("text"), leading)).alias("x")).select("x.leaf", "x.text")
    texts = _open(texts, "leaf", leaves).groupBy("leaf", "text").agg(F.lit(1).alias("one")).select("leaf", _digest(F.col("text")).alias("line"), F.split("text", " ", -1).alias("tokens"))
    texts = texts.join(leaves, "leaf", "left_semi").join(full.withColumn("full", F.lit(True)), "line", "left").withColumn("full", F.col("full").isNotNull())
    texts = materialize(texts, "texts")
    fields_of = lambda df, *more: df.select("leaf", "line", *more, F.posexplode("tokens").alias("pos", "token")).where(F.col("token") != VARIABLE).withColumn("field", _key(F.hex("leaf"), F.col("pos").cast("string"), F.col("token")))
    rare = texts.where(~F.col("full")).select("leaf", "line", "tokens")
    holders = _open(lines.select("rid", "leaf", "line"), "leaf", leaves).select("rid", "line")
    shared = fields_of(rare.join(holders, "line"), "rid").groupBy("field", "rid").agg(F.lit(1).alias("one")).groupBy("field").count().where(F.col("count") >= documents).select("field")
    constants = materialize(fields_of(texts.where("full")).select("field").union(shared).distinct(), "constants")
    templates = (
        fields_of(texts, F.size("tokens").alias("n"), "full")
        .join(constants, "field", "left_semi")
        .groupBy("leaf", "line", "n", "full")
        .agg(F.count("*").alias("constant"), F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("kept"))
        .where(F.col("constant") >= constant_share * F.col("n"))
        .select("leaf", "line", "full", _key(F.hex("leaf"), F.to_json("kept")).alias("template"))
    )
    templates = materialize(templates, "templates")
    several = templates.where(~F.col("full")).join(holders, "line").groupBy("template", "rid").agg(F.lit(1).alias("one")).groupBy("template").count().where(F.col("count") >= documents).select("template")
    recurring = templates.where("full").select("template").union(several).distinct()
    dropped = templates.join(recurring, "template", "left_semi").select("line").union(long).distinct()
    dropped = materialize(dropped.select("line", F.length("line").alias("k")), "dropped")

    # the rows that hold a dropped line, with its digests; the added key lets AQE split a frequent line
    hits = _open(table.select("row", F.explode("lines.line").alias("line")), "line", dropped)
    hits = hits.withColumn("k", F.length("line")).join(dropped, ["line", "k"]).groupBy("row").agg(F.collect_set("line").alias("gone"))
    hits = materialize(hits, "hits")
    keyed = rows.withColumn("row", row_key)
    flagged = in_bitmap(keyed, F.col("row"), key_bitmap(hits.select(F.col("row").alias("key")), "key"), "open")
    # sorted and merged at every size: a plan that broadcasts small inputs would grow faster than the input
    touched = flagged.where("open").join(hits.hint("merge"), "row", "left").select("id", "text", "gone")
    pairs = F.arrays_zip(F.split("text", "\n", -1).alias("line"), _masked_lines(F.col("text")).alias("masked"))
    stay = F.transform(F.filter(pairs, lambda x: ~F.array_contains("gone", _digest(x["masked"]))), lambda x: x["line"])
    cut = touched.withColumn("stay", F.when(F.col("gone").isNotNull(), stay))
    rest = flagged.where(~F.col("open")).select("id", "text", F.lit(None).cast("array<string>").alias("stay"))
    parted = F.split("text", "\n", -1)
    return cut.select("id", "text", "stay").unionByName(rest).select(
        F.col("id").alias(id_col),
        F.size(F.filter(parted, lambda x: F.ltrim(x, F.lit(SPACES)) != "")).cast("long").alias("n_lines"),
        F.when(F.col("stay").isNull(), 0).otherwise(F.size(parted) - F.size("stay")).cast("long").alias("n_dropped"),
        F.when(F.col("stay").isNull(), F.col("text")).otherwise(F.array_join("stay", "\n")).alias("text"),
    )


ORACLE = r"""
WITH l AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nr FROM documents
), t AS (
    SELECT doc_id, nr, line, list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS tokens FROM l
), m AS (
    SELECT *, len(tokens) AS n, array_to_string(tokens, ' ') AS masked, coalesce(tokens[1], '') AS first, coalesce(tokens[2], '') AS second FROM t WHERE len(tokens) > 0
), i AS (SELECT doc_id, md5(coalesce(text, '')) AS identity FROM documents
), h AS (SELECT DISTINCT n, first, second, masked, tokens, identity FROM m JOIN i USING (doc_id)
), leaves AS (SELECT n, first, second FROM h GROUP BY ALL HAVING count(DISTINCT identity) >= 10
), f AS (SELECT n, first, second, masked, identity, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM h JOIN leaves USING (n, first, second)
), constants AS (SELECT n, first, second, pos, token FROM f WHERE token <> '<*>' GROUP BY ALL HAVING count(DISTINCT identity) >= 10
), templates AS (
    SELECT n, first, second, masked, string_agg(pos || ':' || token, ' ' ORDER BY pos) AS template
    FROM (SELECT DISTINCT n, first, second, masked, pos, token FROM f) JOIN constants USING (n, first, second, pos, token)
    GROUP BY n, first, second, masked HAVING count(*) >= 0.5 * n
), recurring AS (
    SELECT n, first, second, template FROM templates JOIN h USING (n, first, second, masked) GROUP BY ALL HAVING count(DISTINCT identity) >= 10
), long AS (
    SELECT masked FROM h WHERE n >= 20 AND len(list_filter(tokens, lambda x: x <> '<*>')) >= 0.5 * n GROUP BY masked HAVING count(DISTINCT identity) >= 3
), gone AS (SELECT masked FROM templates JOIN recurring USING (n, first, second, template) UNION SELECT masked FROM long
), marked AS (
    SELECT t.doc_id, t.nr, t.line, len(t.tokens) > 0 AS worded, gone.masked IS NOT NULL AS gone
    FROM t LEFT JOIN gone ON array_to_string(t.tokens, ' ') = gone.masked AND len(t.tokens) > 0
)
SELECT doc_id, count(*) FILTER (worded) AS n_lines, count(*) FILTER (gone) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (NOT gone), '') AS text
FROM marked GROUP BY doc_id
"""
