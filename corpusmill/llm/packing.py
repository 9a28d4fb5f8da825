"""Lexical retrieval packing: BM25 neighbours of a seed document fill its window.

Texts become ids once, and document frequencies and lengths are summed over all documents. Every
document is routed by its strongest BM25 terms: rows are dealt by ranges of these terms, so documents that
share them stand together wherever they came from, and a term that many documents share is split
by the next terms. A range is a sequence of shards of bounded size, each with an inverted index that weighs
terms by the counts of the whole corpus. The window left open at a shard's end is carried into the
range's next shard, so only a range's last window holds padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import materialize, released, text_blocks
from corpusmill.llm.tokens import WIDE, encoded_documents, stored_ids

K1, B = 1.2, 0.75
#: Strongest terms of a document by which it is routed.
ROUTES = 3
#: Ids of a shard; its index takes about 100 bytes an id.
SHARD_IDS = 1 << 20


def term_counts(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, place of the document, occurrences) of each distinct pair, in order of terms."""
    n = max(len(documents), 1)
    owner = np.repeat(np.arange(len(documents), dtype=np.int64), [len(d) for d in documents])
    terms = np.concatenate(documents).astype(np.int64) if documents else np.empty(0, np.int64)
    keys, tf = np.unique(terms * n + owner, return_counts=True)
    return keys // n, keys % n, tf


class Corpus:
    """Counts over all documents: how many there are, their mean length, and in how many each term is."""

    def __init__(self, n: int, mean: float, frequency: np.ndarray):
        self.n, self.mean, self.frequency = n, max(mean, 1.0), frequency
        self.idf = np.log1p((n - frequency + 0.5) / (frequency + 0.5))

    def weights(self, terms: np.ndarray, tf: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """BM25 weight of each term in a document of the given length."""
        return self.idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths / self.mean))

    def routes(self, documents: list[np.ndarray]) -> np.ndarray:
        """The ROUTES strongest terms of each document that another document has too; -1 where it has fewer."""
        terms, owner, tf = term_counts(documents)
        lengths = np.fromiter(map(len, documents), np.int64, len(documents))
        shared = self.frequency[terms] > 1
        terms, owner, tf = terms[shared], owner[shared], tf[shared]
        order = np.lexsort((terms, -self.weights(terms, tf, lengths[owner]), owner))
        terms, owner = terms[order], owner[order]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        found = np.full((len(documents), ROUTES), -1, np.int32)
        first = rank < ROUTES
        found[owner[first], rank[first]] = terms[first]
        return found


class Bm25Shard:
    """Inverted index of one shard: for each term the documents that hold it and their BM25 weight."""

    def __init__(self, documents: list[np.ndarray], corpus: Corpus):
        lengths = np.fromiter(map(len, documents), np.int64, len(documents))
        terms, self.documents, tf = term_counts(documents)
        self.weights = corpus.weights(terms, tf, lengths[self.documents])
        first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.empty(0, np.int64)
        self.first, self.last = first, np.append(first[1:], len(terms))
        df = self.last - first
        # the query of a document: all its terms that another document of the shard has
        place = np.repeat(np.arange(len(first)), df)
        shared = np.flatnonzero(np.repeat(df, df) > 1)
        order = shared[np.argsort(self.documents[shared], kind="stable")]
        self.queries = np.split(place[order], np.searchsorted(self.documents[order], np.arange(1, max(len(documents), 1))))
        self.n = len(documents)

    def scores(self, document: int) -> np.ndarray:
        """BM25 score of every document of the shard for the terms of one."""
        terms = self.queries[document]
        first, df = self.first[terms], self.last[terms] - self.first[terms]
        spans = np.repeat(first - np.cumsum(df) + df, df) + np.arange(df.sum())
        return np.bincount(self.documents[spans], self.weights[spans], self.n)


class Packer:
    """Packs the shards of one range; the window that is open at a shard's end is carried on."""

    def __init__(self, size: int, first_sequence: int, corpus: Corpus):
        self.size, self.corpus = size, corpus
        self.unnumbered = first_sequence
        self.window, self.filled = self._number(), 0

    def _number(self) -> int:
        self.unnumbered += 1
        return self.unnumbered - 1

    def pack(self, documents: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, int]]:
        """(document, start, length, sequence, offset) of each piece of the shard's documents."""
        begin = [0] * len(documents)
        for doc, ids in enumerate(documents):  # whole windows of long documents stand alone; their tails are packed
            while len(ids) - begin[doc] >= self.size:
                yield doc, begin[doc], self.size, self._number(), 0
                begin[doc] += self.size
        index = Bm25Shard([d[i:] for i, d in zip(begin, documents, strict=True)], self.corpus)
        unused = np.array([i < len(d) for i, d in zip(begin, documents, strict=True)], bool)
        scores, scan = None, 0
        while True:
            doc = -1
            if scores is not None:
                doc = int(np.argmax(np.where(unused, scores, 0)))
                if not unused[doc] or scores[doc] <= 0:
                    doc = -1
            if doc < 0:  # no unused neighbour: the next unused document
                while scan < len(unused) and not unused[scan]:
                    scan += 1
                if scan == len(unused):
                    return
                doc = scan
            if scores is None:  # a window's first document is its seed
                scores = index.scores(doc)
            unused[doc] = False
            while begin[doc] < len(documents[doc]):
                stop = min(len(documents[doc]), begin[doc] + self.size - self.filled)
                yield doc, begin[doc], stop - begin[doc], self.window, self.filled
                self.filled += stop - begin[doc]
                begin[doc] = stop
                if self.filled == self.size:
                    self.window, self.filled = self._number(), 0
                    # what was cut off seeds the next window
                    scores = index.scores(doc) if stop < len(documents[doc]) else None


def corpus_counts(encoded: DataFrame) -> Corpus:
    """Counts over all documents; only sums by term, as many as the vocabulary has, come to the driver."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(2, np.int64)  # documents, ids
        frequency = np.zeros(1, np.int64)
        for batch in released(text_blocks(batches, column="ids")):
            documents = stored_ids(batch, 1)
            total += len(documents), sum(map(len, documents))
            terms = term_counts(documents)[0]
            found = np.bincount(terms, minlength=len(frequency))
            found[: len(frequency)] += frequency
            frequency = found
        used = np.flatnonzero(frequency)
        yield pa.RecordBatch.from_pydict({"term": np.concatenate([[-2, -1], used]), "n": np.concatenate([total, frequency[used]])})

    rows = encoded.select("wide", "ids").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {r.term: r.n for r in rows}
    n, ids = counts.pop(-2, 0), counts.pop(-1, 0)
    frequency = np.zeros(max(counts, default=0) + 1, np.int64)
    frequency[list(counts)] = list(counts.values())
    return Corpus(n, ids / max(n, 1), frequency)


def pack(
    docs: DataFrame,
    vocab: str = "byte_bpe_50k.json",
    size: int = 2048,
    end_id: int = 1,
    shard_ids: int = SHARD_IDS,
    keep_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row a piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, little-endian).

    A document's ids are those of the tokenizers library and ``end_id``; each lies in one piece.
    Whole windows of a document over ``size`` ids stand alone, its tail is packed. A window starts with a
    seed, whose terms retrieve the shard's unused documents in order of BM25 score; then documents without a
    shared term follow in the order of routing. A document that doesn't fit is cut and its rest seeds the
    next window. Neighbours are looked for within a shard of ``shard_ids`` ids, which routing by the strongest terms fills
    with related documents. Null texts count as empty (``end_id`` alone), null ids pass through, repeated
    rows are packed each, a text longer than a shard is a shard of its own, ties in score go to the document
    routed first, an empty table gives no row.
    """
    encoded = materialize(encoded_documents(docs, vocab, end_id, id_col, text_col), "encoded", "zstd")
    corpus = docs.sparkSession.sparkContext.broadcast(corpus_counts(encoded))
    kind = docs.schema[id_col].dataType.simpleString()

    def route(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in released(text_blocks(batches, column="ids")):
            routes = corpus.value.routes(stored_ids(batch, 3))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(routes[:, i]) for i in range(ROUTES))], [*batch.schema.names, *(f"k{i}" for i in range(ROUTES))])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        packer = Packer(size, TaskContext.get().partitionId() << 40, corpus.value)
        for batch in released(shards(batches)):
            documents = [x.astype(WIDE) for x in stored_ids(batch, 2)]
            rows = list(packer.pack(documents))
            doc, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*rows, strict=True))
            pieces = [documents[d][s : s + n].tobytes() for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
            columns = {
                "id": batch.column(0).take(pa.array(doc)),
                "start": start,
                "length": length,
                "ids_crc32": np.fromiter(map(zlib.crc32, pieces), np.int64, len(pieces)),
                "doc_tokens": np.fromiter(map(len, documents), np.int64, len(documents))[doc],
                "sequence_id": sequence,
                "offset": offset,
            }
            if keep_ids:
                columns["ids"] = pa.array(pieces, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    def shards(batches: Iterator) -> Iterator:
        """Batches cut and joined to shards of about ``shard_ids`` ids."""
        import pyarrow as pa

        held, total = [], 0
        for batch in text_blocks(batches, column="ids", limit=2 * shard_ids):
            n = sum(len(x) // 2 for x in batch.column(2).to_pylist())
            if held and total + n > shard_ids:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, total = [], 0
            held.append(batch)
            total += n
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    keys = [f"k{i}" for i in range(ROUTES)]
    routed = encoded.mapInArrow(route, f"id {kind}, salt long, wide boolean, ids binary, " + ", ".join(f"{k} int" for k in keys))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = routed.repartitionByRange(parts, *keys, "salt", "id").sortWithinPartitions(*keys, "salt", "id").select("id", "wide", "ids")
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * keep_ids
    return dealt.mapInArrow(run, schema).withColumnRenamed("id", id_col)
