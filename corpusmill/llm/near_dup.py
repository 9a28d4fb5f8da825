"""N-gram Jaccard join: MinHash LSH forest for candidates, exact verification of all pairs in a candidate cluster.

Each distinct word sequence has one signature path in every tree of the forest. Texts whose paths share a
prefix in a tree meet in a node; prefixes are shortened to the depth at which the forest reaches the target
recall at the threshold. Pairs of a small node are looked at one by one. A crowded node, whose texts may share no more
than a passage, is resolved exactly: sets this similar share one of their rarest shingles, so its texts are
brought together by those. What is joined forms clusters; within a cluster every pair of texts is
compared exactly, in blocks of bounded size, so links and classes hold no estimate.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import WORD, connected_components, in_bitmap, key_bitmap, materialize, new_names, released, text_blocks

SHINGLE, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 24, 8, 0.999
#: Texts of a forest node up to which its pairs are looked at one by one; the texts of a larger node are joined exactly.
SMALL = 4
#: Cells of the sketch that orders shingles by frequency, and how many of the heaviest are told apart. Any order gives the same result.
CELLS, HEAVY = 1 << 20, 1 << 16
#: Distinct texts of a cluster's block, least and most; two blocks are compared by one task.
BLOCK, MOST_BLOCK = 512, 2048


def prefix_depth(threshold: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix whose agreement in one of ``trees`` trees has at least ``recall`` at the threshold."""
    return max([k for k in range(1, depth + 1) if 1 - (1 - threshold**k) ** trees >= recall], default=1)


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    """64-bit hashes of word shingles; a text of fewer words has one shingle of all its words."""

    def __init__(self, size: int):
        self.size, self.factors = size, _odd(size, 11)
        self.words_of = re.compile(WORD).findall
        self.memo: dict[str, int] = {}

    def block(self, texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """(digest of each word sequence, hashes of all shingles, where each text's begin, how many it has)."""
        import xxhash

        if len(self.memo) > 100_000:
            self.memo.clear()
        memo, digests, hashes = self.memo, [], []
        for text in texts:
            words = self.words_of(text)
            digests.append(xxhash.xxh3_128_digest("\x20".join(words).encode("utf-8", "surrogatepass")) if words else b"")
            for word in set(words).difference(memo):
                memo[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
            hashes.append(np.fromiter(map(memo.__getitem__, words), np.uint64, len(words)))
        counts = np.fromiter(map(len, hashes), np.int64, len(hashes))
        short = np.flatnonzero((counts > 0) & (counts < self.size))
        for i in short:
            value = np.uint64(counts[i]) + (hashes[i] * self.factors[: counts[i]]).sum(dtype=np.uint64)
            hashes[i] = np.concatenate([[value], np.zeros(self.size - 1, np.uint64)])
        flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        padded = np.concatenate([flat, np.zeros(self.size, np.uint64)])
        mixed = np.zeros(len(flat), np.uint64)
        for j, factor in enumerate(self.factors):
            mixed += padded[j : j + len(flat)] * factor
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        counts[short] = self.size
        begin = np.cumsum(counts) - counts
        shingles = np.maximum(counts - self.size + 1, 0)
        starts = np.repeat(begin - (np.cumsum(shingles) - shingles), shingles) + np.arange(shingles.sum())
        return digests, mixed[starts], np.cumsum(shingles) - shingles, shingles


def signatures(hashes: np.ndarray, begin: np.ndarray, counts: np.ndarray, width: int) -> np.ndarray:
    """16 bits of ``width`` minima for each text; texts without shingles get zeros."""
    found = np.zeros((len(begin), width), ">u2")
    full = np.flatnonzero(counts)
    if not len(full):
        return found
    for i, (a, b) in enumerate(zip(_odd(width, 21), _odd(width, 22), strict=True)):
        least = np.minimum.reduceat(hashes * a + b, begin[full])
        found[full, i] = ((least ^ (least >> np.uint64(32))) & np.uint64(0xFFFF)).astype(np.uint16)
    return found


def _row(id_col: str, text_col: str) -> Column:
    """Names a row by its id and text."""
    return F.xxhash64(id_col, text_col)


def _features(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        shingler, number = Shingler(size), TaskContext.get().partitionId() << 33
        for batch in released(text_blocks(batches)):
            n = batch.num_rows
            digests, hashes, begin, counts = shingler.block([t or "" for t in batch.column(1).to_pylist()])
            paths = signatures(hashes, begin, counts, TREES * DEPTH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(number, number + n)), batch.column(0), batch.column(2), pa.array(digests, pa.binary()), pa.array(counts), pa.array([p.tobytes() for p in paths], pa.binary())],
                ["rid", "id", "row", "key", "n_shingles", "paths"],
            )
            number += n

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _row(id_col, text_col).alias("row"))
    return slim.mapInArrow(run, f"rid long, id {kind}, row long, key binary, n_shingles long, paths binary")


def _candidates(texts: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """(pairs (a, b) of keys that share a prefix of ``depth`` in a tree, for nodes of up to SMALL texts; keys of larger nodes)."""
    width = 2 * DEPTH
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    prefix = F.substring("paths", F.col("tree") * width + 1, F.lit(2 * depth))
    nodes = texts.select("key", "paths", tree).select("key", F.xxhash64("tree", prefix).alias("node"))
    shared = materialize(nodes.groupBy("node").agg(F.count("*").alias("size"), F.min("key").alias("least")).where("size > 1"), "nodes")
    nodes = in_bitmap(nodes, F.col("node"), key_bitmap(shared.select(F.col("node").alias("key")), "key"), "open").where("open").select("node", "key")
    # the key's length as a second key makes both sides reshuffle, which lets AQE split a large node's partition
    met = materialize(nodes.withColumn("k", F.length("key")).join(shared.withColumn("k", F.length("least")), ["node", "k"]).select("node", "key", "size"), "met")
    small = met.where(F.col("size") <= SMALL).groupBy("node").agg(F.collect_list("key").alias("keys"))
    pairs = small.select("keys", F.explode("keys").alias("a")).select("a", F.explode("keys").alias("b")).where("a < b").distinct()
    return pairs, met.where(F.col("size") > SMALL).select("key").distinct()


def _agreeing(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs whose signatures agree in at least ``least`` of their places."""

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for i in (2, 3))
                import pyarrow as pa

                yield batch.select(["a", "b"]).filter(pa.array((left == right).mean(axis=1) >= least))

    a = texts.select(F.col("key").alias("a"), F.col("paths").alias("pa"))
    b = texts.select(F.col("key").alias("b"), F.col("paths").alias("pb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "pa", "pb").mapInArrow(run, "a binary, b binary")


def _sets(docs: DataFrame, texts: DataFrame, keys: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(key, copies, shingles) of the texts named by ``keys``: sorted 64-bit hashes; a repeated row may give its text twice."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        shingler = Shingler(size)
        for batch in released(text_blocks(batches)):
            digests, hashes, begin, counts = shingler.block([t or "" for t in batch.column(2).to_pylist()])
            same = [i for i, (a, b) in enumerate(zip(digests, batch.column(0).to_pylist(), strict=True)) if a == b]
            sets = [np.unique(hashes[begin[i] : begin[i] + counts[i]]).tobytes() for i in same]
            kept = batch.take(pa.array(same, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns[:2], pa.array(sets, pa.binary())], ["key", "copies", "shingles"])

    wanted = materialize(texts.select("key", "id", "copies").join(keys, "key", "left_semi").withColumn("near", F.xxhash64("id")), "wanted")
    read = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    near = in_bitmap(read, F.xxhash64("doc"), key_bitmap(wanted.select(F.col("near").alias("key")), "key"), "open").where("open").drop("open")
    held = near.join(wanted, F.col("doc").eqNullSafe(F.col("id"))).select("key", "copies", "text")
    return materialize(held.mapInArrow(run, "key binary, copies long, shingles binary"), "sets")


def prefix_length(n: int, threshold: float) -> int:
    """How many of a set's ``n`` members, taken in one order for all sets, must hold one of each set this similar."""
    return n - math.ceil(threshold * n - 1e-9) + 1


def _cells(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(44)).astype(np.int64)


def _stars(sets: DataFrame, threshold: float) -> DataFrame:
    """Edges (a, b) that connect every two of the sets whose similarity reaches the threshold.

    Exact prefix filtering: of all members in one order, the first ``prefix_length`` of two similar sets have one in
    common. The order is by frequency, rare first, so shingles of a passage that many texts share bring nobody
    together. Frequencies are a sketch of fixed size; the texts of one shingle point to their least key.
    """

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        cells = np.zeros(CELLS, np.int64)
        for batch in released(batches):
            if batch.num_rows:
                cells += np.bincount(_cells(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)), minlength=CELLS)
        heavy = np.argpartition(cells, CELLS - HEAVY)[-HEAVY:]
        heavy = heavy[cells[heavy] > 1]
        yield pa.RecordBatch.from_pydict({"cell": heavy, "n": cells[heavy]})

    totals = sets.select("shingles").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    heavy = totals.orderBy(F.desc("n"), "cell").limit(HEAVY).collect()
    order = np.zeros(CELLS, np.int32)
    for place, row in enumerate(reversed(heavy)):
        order[row.cell] = place + 1
    shared = sets.sparkSession.sparkContext.broadcast(order)

    def prefixes(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in released(text_blocks(batches, column="shingles")):
            keys, found = [], []
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                values = np.frombuffer(raw, np.uint64)
                first = values[np.argsort(shared.value[_cells(values)], kind="stable")][: prefix_length(len(values), threshold)]
                keys += [key] * len(first)
                found.append(first)
            flat = np.concatenate(found).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(flat)], ["key", "shingle"])

    rows = sets.select("key", "shingles").mapInArrow(prefixes, "key binary, shingle long")
    least = materialize(rows.groupBy("shingle").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least < most").drop("most"), "rare")
    near = in_bitmap(rows, F.col("shingle"), key_bitmap(least.select(F.col("shingle").alias("key")), "key"), "open").where("open")
    # the length as a second key makes both sides reshuffle, which lets AQE split a shingle's partition
    joined = near.withColumn("k", F.length("key")).join(least.withColumn("k", F.length("least")), ["shingle", "k"])
    return joined.where("key <> least").select(F.col("least").alias("a"), F.col("key").alias("b")).distinct()


def shared_counts(sets: list[np.ndarray], split: int | None = None) -> np.ndarray:
    """How many members each two sets have in common; with ``split``, of the sets before it (rows) and from it on (columns)."""
    n = len(sets)
    rows, columns, base = (n, n, 0) if split is None else (split, n - split, split)
    found = np.zeros((rows, columns), np.float32)
    _, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), np.fromiter(map(len, sets), np.int64, n))
    # members that many sets have: products of bounded 0/1 matrices
    dense = np.flatnonzero(counts > max(n // 8, 8))
    spot = np.full(len(counts), -1)
    spot[dense] = np.arange(len(dense))
    column = spot[place]
    width = max(1, (1 << 21) // n)
    for start in range(0, len(dense), width):
        held = (column >= start) & (column < start + width)
        ones = np.zeros((n, min(width, len(dense) - start)), np.float32)
        ones[owner[held], column[held] - start] = 1
        found += ones[:rows] @ ones[base:].T
    # members of few sets: each with those that follow it among the holders
    few = np.flatnonzero((counts[place] > 1) & (column < 0))
    few = few[np.lexsort((owner[few], place[few]))]
    value, holder = place[few], owner[few]
    at, step, total = np.arange(len(few)), 1, np.zeros(rows * columns, np.int64)
    while len(at):
        at = at[at + step < len(few)]
        at = at[value[at] == value[at + step]]
        i, j = holder[at], holder[at + step]
        if split is not None:
            cross = (i < split) & (j >= split)
            i, j = i[cross], j[cross]
        if len(i):
            total += np.bincount(i * columns + (j - base), minlength=rows * columns)
        step += 1
    total = total.reshape(rows, columns)
    return found.astype(np.int64) + (total + total.T if split is None else total)


def link_block(copies: np.ndarray, sets: list[np.ndarray], threshold: float, split: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(links of each text counting copies of its partners, local root of each text) among the pairs of one
    block, or with ``split`` between the block before it and the one from it on."""
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    if split is None:
        shared = shared_counts(sets)
        linked = shared >= threshold * (sizes[:, None] + sizes - shared) - 1e-9
        np.fill_diagonal(linked, False)
        links = linked @ copies
    else:
        shared = shared_counts(sets, split)
        one = shared >= threshold * (sizes[:split, None] + sizes[split:] - shared) - 1e-9
        links = np.concatenate([one @ copies[split:], copies[:split] @ one])
        linked = np.zeros((n, n), bool)
        linked[:split, split:] = one
        linked[split:, :split] = one.T
    roots = np.full(n, -1)
    for i in range(n):
        if roots[i] < 0:
            roots[i], front = i, linked[i] & (roots < 0)
            while front.any():
                roots[front] = i
                front = linked[front].any(axis=0) & (roots < 0)
    return links.astype(np.int64), roots


def _verified(members: DataFrame, threshold: float) -> DataFrame:
    """(key, root, links) of each member and block pair; members hold cluster, cluster_size, key, copies, shingles."""
    block = F.least(F.greatest(F.col("cluster_size") / 64, F.lit(BLOCK)), F.lit(MOST_BLOCK))
    blocks = F.ceil(F.col("cluster_size") / block).cast("int")
    own = F.pmod(F.xxhash64("key"), blocks)
    spread = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    spread = spread.select("cluster", F.least("own", "other").cast("int").alias("lo"), F.greatest("own", "other").cast("int").alias("hi"), "own", "key", "copies", "shingles")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def flush(group, rows):
            unique = {row[1]: row for row in rows}  # rows that share id and text come once
            rows = sorted(unique.values(), key=lambda r: (r[0] != group[1], r[1]))
            keys, copies = [r[1] for r in rows], np.array([r[2] for r in rows], np.int64)
            split = None if group[1] == group[2] else sum(r[0] == group[1] for r in rows)
            links, roots = link_block(copies, [np.frombuffer(r[3], np.uint64) for r in rows], threshold, split)
            return pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "root": pa.array([keys[i] for i in roots.tolist()], pa.binary()), "links": links})

        group, rows = None, []
        for batch in released(batches):
            columns = [batch.column(i).to_pylist() for i in range(7)]
            for cluster, lo, hi, own, key, n, shingles in zip(*columns, strict=True):
                if (cluster, lo, hi) != group:
                    if rows:
                        yield flush(group, rows)
                    group, rows = (cluster, lo, hi), []
                rows.append((own, key, n, shingles))
        if rows:
            yield flush(group, rows)

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = spread.repartition(parts, "cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi")
    return dealt.mapInArrow(run, "key binary, root binary, links long")


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, class_id, n_links.

    Documents link when the Jaccard similarity of their sets of ``shingle``-word shingles is ``threshold``
    or more (words are runs without space and U+0009 to U+000D; a text of fewer words has one shingle of all).
    ``n_links`` counts all other documents it links to, copies included; ``class_id`` is the least id of
    the documents that links connect. A text without words, null included, links to nothing. Repeated
    rows are copies, null ids are least, a very long text is one set of its distinct shingles, an empty table
    gives no row.
    """
    return _classes(docs, threshold, shingle, id_col, text_col).select(F.col("id").alias(id_col), "class_id", "n_links")


def _classes(docs: DataFrame, threshold: float, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(row, id, class_id, n_links, stays): ``stays`` for the rows that have the class's least (id, word sequence)."""
    features = materialize(_features(docs, id_col, text_col, shingle), "forest")
    worded = features.where("n_shingles > 0")
    texts = materialize(worded.groupBy("key").agg(F.min_by("id", F.struct("id", "rid")).alias("id"), F.count("*").alias("copies"), F.first("paths").alias("paths"), F.first("n_shingles").alias("n_shingles")), "texts")
    pairs, crowded = _candidates(texts, prefix_depth(threshold))
    # five standard deviations below the threshold: less is lost here than by the forest's recall
    pairs = materialize(_agreeing(pairs, texts, threshold - 0.15), "pairs")
    crowded = materialize(crowded, "crowded")
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).union(crowded).distinct()
    sets = _sets(docs, texts, keys, shingle, id_col, text_col)
    # a false positive of the bitmap is compared in vain and changes nothing
    in_crowd = in_bitmap(sets, F.xxhash64("key"), key_bitmap(crowded.select(F.xxhash64("key").alias("key")), "key"), "open").where("open")
    stars = _stars(in_crowd, threshold)
    clusters = connected_components(pairs.unionByName(stars)).select(F.col("node").alias("key"), F.col("root").alias("cluster"))
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("cluster_size"))
    # length as a second key makes both sides reshuffle, which lets AQE split a large cluster's partition
    sized = clusters.withColumn("k", F.length("cluster")).join(sizes.withColumn("k", F.length("cluster")), ["cluster", "k"]).drop("k")
    found = materialize(_verified(sets.join(sized, "key"), threshold), "links")
    joined = connected_components(found.where("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    rooted = links.join(joined.withColumnRenamed("node", "key"), "key", "left").select("key", "links", F.coalesce("root", "key").alias("root"))
    linked = rooted.join(texts.select("key", "id", "copies", "n_shingles"), "key", "right").withColumn("root", F.coalesce("root", "key")).withColumn("links", F.coalesce("links", F.lit(0)))
    # singles need no join: only texts with links or copies are looked up below
    linked = materialize(linked.where("links > 0 or copies > 1"), "linked")
    least = linked.groupBy("root").agg(F.min(F.struct("id", "key")).alias("least")).withColumn("k", F.length("root"))
    classes = linked.withColumn("k", F.length("root")).join(least, ["root", "k"]).select("key", "n_shingles", "least", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    # the number of shingles as a second key makes both sides reshuffle: a large group of copies is split
    rows = features.select("row", "id", "key", "n_shingles").join(classes.withColumn("found", F.lit(True)), ["key", "n_shingles"], "left")
    single = F.col("found").isNull()
    return rows.select(
        "row",
        "id",
        F.when(single, F.col("id")).otherwise(F.col("least.id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (single | (F.col("id").eqNullSafe(F.col("least.id")) & (F.col("key") == F.col("least.key")))).alias("stays"),
        (~single).alias("linked"),
    )


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class of ``near_classes``: that of the least id, then the least word sequence.

    All columns stay, whatever their names. Rows that share an id are told apart by their texts; of rows equal in both, one
    stays. Texts without words, null included, stay; an empty table stays empty.
    """
    gone_id, gone_row, row, flag = new_names(docs.columns, 4)
    touched = materialize(_classes(docs, threshold, shingle, id_col, text_col).where("linked").select(F.col("id").alias(gone_id), F.col("row").alias(gone_row), "stays").distinct(), "touched")
    flagged = in_bitmap(docs.withColumn(row, _row(id_col, text_col)), F.col(row), key_bitmap(touched.select(F.col(gone_row).alias("key")), "key"), flag)
    gone = touched.where(~F.col("stays")).drop("stays")
    doubtful = flagged.where(flag).join(gone, (F.col(row) == F.col(gone_row)) & F.col(id_col).eqNullSafe(F.col(gone_id)), "left_anti")
    known = touched.where("stays").drop("stays")
    # rows of a false positive of the bitmap are no copies; they stay as they are
    other = doubtful.join(known, (F.col(row) == F.col(gone_row)) & F.col(id_col).eqNullSafe(F.col(gone_id)), "left_anti")
    one = doubtful.join(known, (F.col(row) == F.col(gone_row)) & F.col(id_col).eqNullSafe(F.col(gone_id)), "left_semi").dropDuplicates([id_col, row])
    return flagged.where(~F.col(flag)).unionByName(other).unionByName(one).drop(row, flag)


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE shared >= 0.8 * (x.n + y.n - shared)
), reached AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
SELECT a AS doc_id, min(b) AS class_id, (SELECT count(*) FROM links WHERE links.a = reached.a) AS n_links FROM reached GROUP BY reached.a
"""
