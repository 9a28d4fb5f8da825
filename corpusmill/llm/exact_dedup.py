"""Exact dedup by progressive refinement: length, then prefix hash, then full hash of what still collides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import JAVA_SPACE, in_bitmap, key_bitmap, materialize, new_names, text_of

PREFIX_CHARS = 128


def exact_groups(docs: DataFrame, digest_all: bool = False, prefix_chars: int = PREFIX_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after deleting space and U+0009 to U+000D; of equal texts the row
    with the most code points, then the smallest id stays (of rows that tie in both, one). Null texts
    count as empty, null ids sort last, an empty table gives no row.

    The first pass reads lengths and counts them; texts whose length occurs once are done. Of the others
    a hash of the first ``prefix_chars`` characters is counted with the length, and only texts that still
    collide are hashed in full. What survives a pass is a bitmap of fixed size, so texts are never
    shuffled; a false positive of the bitmap costs a hash and changes no result. ``digest_all`` hashes the
    rest too, for a caller who wants the digest of each text; it is null for them otherwise.
    """
    counted, groups = _grouped(docs, digest_all, prefix_chars, id_col, text_col)
    # size as a second key makes both sides reshuffle, which lets AQE split the partition of a large group
    joined = counted.join(groups, ["text_sha256", "size"], "left").withColumn("nr", F.explode(F.sequence(F.lit(1), "rows")))
    single = F.col("group_size").isNull()
    return joined.select(
        F.col("id").alias(id_col),
        F.when(single, F.col("id")).otherwise(F.col("stays.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | ((F.col("nr") == 1) & _stays())).alias("kept"),
        "text_sha256",
    )


def _stays() -> Column:
    return F.col("id").eqNullSafe(F.col("stays.id")) & (F.col("key") == F.col("stays.key"))


def _grouped(docs: DataFrame, digest_all: bool, prefix_chars: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows by id and text with their number, groups of equal texts with the id and text that stay)."""
    normal = F.regexp_replace(text_of(text_col), JAVA_SPACE, "")
    sized = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("key"), normal.alias("normal"), F.char_length(text_of(text_col)).cast("long").alias("points"))
    sized = sized.withColumn("size", F.octet_length("normal"))
    # another pass over the text is cheaper than keeping it: lengths alone are shuffled here
    by_size = sized.groupBy("size").count().where("count > 1").select(F.xxhash64("size").alias("key"))
    prefix = F.xxhash64("size", F.substring("normal", 1, prefix_chars))
    colliding = in_bitmap(sized, F.xxhash64("size"), key_bitmap(by_size, "key"), "open")
    by_prefix = colliding.where("open").select(prefix.alias("key")).groupBy("key").count().where("count > 1").select("key")
    flagged = in_bitmap(sized, prefix, key_bitmap(by_prefix, "key"), "open")
    rows = flagged.select("id", "key", "points", "size", F.when(F.col("open") | F.lit(digest_all), F.sha2("normal", 256)).alias("text_sha256"), "open")
    # rows that share id and text differ in nothing that matters here: they are counted
    counted = rows.groupBy("id", "key", "points", "size", "text_sha256", "open").agg(F.count("*").cast("int").alias("rows"))
    best = F.struct("points", F.col("id").isNotNull().alias("known"), (-F.col("id")).alias("least"), "key")
    groups = (
        counted.where("open")
        .groupBy("text_sha256")
        .agg(F.max("size").alias("size"), F.sum("rows").alias("group_size"), F.max_by(F.struct("id", "key"), best).alias("stays"))
        .where("group_size > 1")
    )
    return counted, groups


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of ``exact_groups``; all columns stay, whatever their names.

    Null texts count as empty, so of rows without text one stays; of rows equal in id and text one stays; an empty
    table stays empty.
    """
    gone_id, gone_key, key, flag = new_names(docs.columns, 4)
    counted, groups = _grouped(docs, False, PREFIX_CHARS, id_col, text_col)
    copies = materialize(counted.join(groups, ["text_sha256", "size"]).select("id", "key", _stays().alias("stays"), "rows"), "copies")
    gone = copies.where(~F.col("stays")).select(F.col("id").alias(gone_id), F.col("key").alias(gone_key))
    touched = key_bitmap(copies.where("not stays or rows > 1").select("key"), "key")
    # rows outside the bitmap of what goes or repeats stay without a join
    flagged = in_bitmap(docs.withColumn(key, F.xxhash64(text_of(text_col))), F.col(key), touched, flag)
    doubtful = flagged.where(flag).join(gone, (F.col(key) == F.col(gone_key)) & F.col(id_col).eqNullSafe(F.col(gone_id)), "left_anti")
    return flagged.where(~F.col(flag)).unionByName(doubtful.dropDuplicates([id_col, key])).drop(flag, key)


ORACLE = r"""
WITH n AS (
    SELECT doc_id, length(coalesce(text, '')) AS points, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""
