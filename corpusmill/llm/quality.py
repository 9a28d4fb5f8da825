"""Quality rules: text statistics, and lines that recur across the documents of a host."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import WORD, in_bitmap, key_bitmap, materialize, new_names, released, text_blocks

#: Distinct documents of a host from which a line counts as boilerplate, and what a document must keep without them.
LINE_DOCUMENTS = 10
MIN_WORDS, MIN_SHARE = 20, 0.2

FEATURES = "rid long, id {kind}, row long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, body binary, lines array<struct<line:binary,words:long>>"


def repeat_words(codes: np.ndarray, owner: np.ndarray, n: int, width: int = 8) -> np.ndarray:
    """For each of ``n`` texts the words within windows of ``width`` (a power of two) found twice or more in it.

    Equal windows get equal numbers by doubling: a window of 2k words is the pair of its halves.
    """
    total = len(codes)
    found = np.zeros(n, np.int64)
    if total < width + 1:
        return found
    span = 1
    while span < width:
        pairs = codes[:-span].astype(np.int64) * (int(codes.max()) + 1) + codes[span:]
        codes = np.unique(pairs, return_inverse=True)[1]
        span *= 2
    whole = np.flatnonzero(owner[: total - width + 1] == owner[width - 1 :])
    _, inverse, counts = np.unique(codes[whole] * n + owner[whole], return_inverse=True, return_counts=True)
    begin = whole[counts[inverse] > 1]
    cover = np.zeros(total + 1, np.int64)
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + width, -1)
    np.add.at(found, owner[np.cumsum(cover[:-1]) > 0], 1)
    return found


def _row(*columns: str) -> Column:
    """Names a row by its content: equal rows share their fate."""
    return F.xxhash64(*columns)


def document_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The statistics of each document, a 128-bit hash of its normalised text (``body``), and its distinct
    normalised lines as 128-bit hashes with their words.

    A line is normalised by lower case, digits as 0 and words joined by one space; a text is the sequence
    of its normalised lines that have words.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        words_of = re.compile(WORD).findall
        digits = str.maketrans("123456789", "0" * 9)
        number = TaskContext.get().partitionId() << 33
        for batch in released(text_blocks(batches)):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = len(texts)
            codes: dict[str, int] = {}
            flat, stats, lines_of, bodies = [], np.zeros((4, n), np.int64), [], []
            for i, text in enumerate(texts):
                lines, seen, sizes = text.split("\n"), set(), {}
                body = xxhash.xxh3_128()
                count = chars = repeated = 0
                for line in lines:
                    words = words_of(line)
                    if not words:
                        continue
                    count += len(words)
                    chars += sum(map(len, words))
                    repeated += line in seen
                    seen.add(line)
                    flat += [codes.setdefault(w, len(codes)) for w in words]
                    key = xxhash.xxh3_128_digest(" ".join(words).lower().translate(digits).encode("utf-8", "surrogatepass"))
                    sizes[key] = sizes.get(key, 0) + len(words)
                    body.update(key)
                stats[:, i] = count, chars, sum(map(text.count, "#*$%&|<>")), repeated
                bodies.append(body.digest())
                lines_of.append([{"line": k, "words": v} for k, v in sizes.items()])
            owner = np.repeat(np.arange(n), stats[0])
            windows = repeat_words(np.array(flat, np.int64), owner, n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(number, number + n)),
                    batch.column(0),
                    batch.column(3),
                    batch.column(2),
                    *map(pa.array, stats[:3]),
                    pa.array(stats[3]),
                    pa.array(windows),
                    pa.array(bodies, pa.binary()),
                    pa.array(lines_of, pa.list_(pa.struct([("line", pa.binary()), ("words", pa.int64())]))),
                ],
                ["rid", "id", "row", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "body", "lines"],
            )
            number += n

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(host_col).cast("string").alias("host"), _row(id_col, text_col, host_col).alias("row"))
    return slim.mapInArrow(run, FEATURES.format(kind=kind))


def judge(
    docs: DataFrame,
    line_documents: int = LINE_DOCUMENTS,
    min_words: int = MIN_WORDS,
    min_share: float = MIN_SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """One row a document: id, the five statistics, base_failed, n_line_words (words of boilerplate lines), kept.

    A line found in ``line_documents`` or more distinct documents of its host is boilerplate; documents of
    equal normalised text are one, all others count each, near copies too. A document
    is depleted if without such lines fewer than ``min_words`` words or less than ``min_share`` of its words
    are left; it is kept if it is neither depleted nor base_failed (fewer than 20 words, or more than 30 of
    100 in repeated windows). Null texts count as empty, null hosts as one host, repeated rows are judged
    each, an empty table gives no row. Counts are summed before they are shuffled; the rows of a frequent
    line are joined, not gathered.
    """
    return _judged(docs, line_documents, min_words, min_share, id_col, text_col, host_col).drop("__row")


def _judged(docs: DataFrame, line_documents: int, min_words: int, min_share: float, id_col: str, text_col: str, host_col: str) -> DataFrame:
    features = materialize(document_features(docs, id_col, text_col, host_col), "features")
    lines = features.select("rid", "body", F.coalesce("host", F.lit("")).alias("host"), F.explode("lines").alias("l")).select("rid", "body", "host", "l.line", "l.words")
    counted = lines.groupBy("host", "line", "body").agg(F.lit(1).alias("one")).groupBy("host", "line").agg(F.count("*").alias("documents"))
    common = counted.where(F.col("documents") >= line_documents).select("host", "line")
    # a constant third key makes both sides reshuffle, which lets AQE split a frequent line's partition
    lost = (
        lines.drop("body")
        .withColumn("k", F.length("line"))
        .join(common.withColumn("k", F.length("line")), ["host", "line", "k"])
        .groupBy("rid")
        .agg(F.sum("words").alias("n_line_words"))
    )
    left = F.col("n_words") - F.col("n_line_words")
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    depleted = (F.col("n_line_words") > 0) & ((left < min_words) | (left < min_share * F.col("n_words")))
    return (
        features.drop("body", "lines")
        .join(lost, "rid", "left")
        .withColumn("n_line_words", F.coalesce("n_line_words", F.lit(0)))
        .select(F.col("row").alias("__row"), F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "n_line_words", (~base & ~depleted).alias("kept"))
    )


def drop_rejected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``docs`` without the documents that ``judge`` rejects; all columns stay, whatever their names.

    Null and empty texts have too few words and go; repeated rows share their fate; an empty table stays empty.
    """
    gone_id, gone_row, row, flag = new_names(docs.columns, 4)
    verdicts = _judged(docs, LINE_DOCUMENTS, MIN_WORDS, MIN_SHARE, id_col, text_col, host_col)
    gone = materialize(verdicts.where(~F.col("kept")).select(F.col("__row").alias(gone_row), F.col(id_col).alias(gone_id)), "rejected")
    numbered = docs.withColumn(row, _row(id_col, text_col, host_col))
    # rows outside the bitmap of rejected rows stay without a join
    flagged = in_bitmap(numbered, F.col(row), key_bitmap(gone.select(F.col(gone_row).alias("key")), "key"), flag)
    doubtful = flagged.where(flag).join(gone, (F.col(row) == F.col(gone_row)) & F.col(id_col).eqNullSafe(F.col(gone_id)), "left_anti")
    return flagged.where(~F.col(flag)).unionByName(doubtful).drop(flag, row)


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents
), w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d
), win AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 6), lambda i: {'spot': i, 'words': array_to_string(w[i:i + 7], ' ')})) AS x FROM w WHERE len(w) >= 8
), again AS (SELECT doc_id, x.spot AS spot, count(*) OVER (PARTITION BY doc_id, x.words) AS n FROM win
), covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(spot, spot + 8)) AS p FROM again WHERE n > 1) GROUP BY doc_id
), lines AS (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS nr FROM d
), norm AS (
    SELECT doc_id, host, line, nr, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
           regexp_replace(lower(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' ')), '[0-9]', '0', 'g') AS norm
    FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM norm GROUP BY doc_id
), body AS (SELECT doc_id, md5(string_agg(norm, chr(10) ORDER BY nr)) AS body FROM norm GROUP BY doc_id
), common AS (SELECT host, norm FROM norm JOIN body USING (doc_id) GROUP BY host, norm HAVING count(DISTINCT body) >= 10
), lost AS (SELECT doc_id, sum(words) AS n FROM norm JOIN common USING (host, norm) GROUP BY doc_id
), stats AS (
    SELECT w.doc_id, len(w.w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS n_line_words
    FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id)
), judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM stats)
SELECT *, NOT base_failed AND NOT (n_line_words > 0 AND (n_words - n_line_words < 20 OR n_words - n_line_words < 0.2 * n_words)) AS kept FROM judged
"""
