"""LM scoring by subword lattices: the marginal probability of a text over all segmentations into pieces.

The pieces are an existing vocabulary's. Its stored scores give their first weights; expectation steps
over the word counts of the training documents turn these into probabilities. A text is a sequence of
words and an end; a word's probability sums over all its segmentations by forward recursion in log space.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import materialize, released, text_blocks
from corpusmill.llm.tokens import vocabulary

#: The end of a text among the word counts; no word is empty.
END = ""
#: Words of a share of 1/2**20 or more: 2**20 at most, whatever the corpus; these may be sent to all tasks.
FREQUENT = 1 << 20
ROWS = 16384
#: Least logarithm that plain probabilities of prefixes may reach; longer words are summed in logarithms.
LEAST = -600.0
#: Expectation steps over the training counts: until the log likelihood gains less than this share, or so many.
TOLERANCE, STEPS = 0.002, 6
#: Characters whose words are coded together, and words that a task counts before it sends them.
BLOCK, TASK_WORDS = 8_000_000, 1_000_000


class Lattice:
    """Byte trie of the pieces, walked for many words at once. A word's bytes follow one space, which stands
    for the word mark of the pieces; each single byte is a piece, so every word has a segmentation."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        scores: dict[bytes, float] = {}
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                continue
            piece = model.id_to_piece(i)
            raw = bytes((int(piece[3:5], 16),)) if model.is_byte(i) else piece.replace("▁", " ").encode()
            if raw.rfind(b" ") <= 0:
                scores[raw] = max(scores.get(raw, -math.inf), 0.0 if model.is_byte(i) else model.get_score(i))
        for b in range(256):
            scores.setdefault(bytes((b,)), min(scores.values()))
        self.pieces = sorted(scores)
        stored = np.array([scores[p] for p in self.pieces])
        # scores that are ranks of merges (whole negative numbers) follow Zipf's law; others are log probabilities
        ranks = bool((stored == np.round(stored)).all())
        first = -np.log(10.0 - stored) if ranks else stored
        children: list[dict[int, int]] = [{}, {}]
        self.node = np.zeros(len(self.pieces), np.int64)
        for i, piece in enumerate(self.pieces):
            at = 1
            for byte in piece:
                following = children[at].get(byte)
                if following is None:
                    following = children[at][byte] = len(children)
                    children.append({})
                at = following
            self.node[i] = at
        self.child = np.zeros((len(children), 256), np.int32)
        for at, row in enumerate(children):
            for byte, following in row.items():
                self.child[at, byte] = following
        self.first = first - np.logaddexp.reduce(first)

    def weights(self, logs: np.ndarray) -> np.ndarray:
        found = np.full(len(self.child), -np.inf)
        found[self.node] = logs
        return found

    def _arcs(self, words: list[bytes]) -> tuple[np.ndarray, int, Callable]:
        """(lengths, greatest length, arcs) of words in order of length; an arc's rows are distinct."""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        width = int(lengths.max())
        text = np.frombuffer(b"".join(b" " + w.ljust(width - 1, b"\0") for w in words), np.uint8).reshape(len(words), width)
        columns, child = np.ascontiguousarray(text.T), self.child.reshape(-1)
        begin = np.searchsorted(lengths, np.arange(width), "right")

        def arcs(weights: np.ndarray, none: float) -> Iterator:
            for i in range(width):
                rows = np.arange(begin[i], len(lengths))
                state = np.ones(len(rows), np.int64)
                for j in range(i, width):
                    state = child[(state << 8) + columns[j][rows]]
                    alive = np.flatnonzero((state > 0) & (rows >= begin[j]))
                    rows, state = rows[alive], state[alive].astype(np.int64)
                    if not len(rows):
                        break
                    w = weights[state]
                    ends = np.flatnonzero(w > none)
                    if len(ends):
                        yield i, j + 1, rows[ends], state[ends], w[ends]

        return lengths, width, arcs

    def _batches(self, words: list[bytes]) -> Iterator[np.ndarray]:
        """Places of words of like length, in batches of bounded size."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        start = 0
        while start < len(order):
            stop = min(start + ROWS, len(order))
            while stop > start + 1 and (stop - start) * (lengths[order[stop - 1]] + 1) > 1 << 19:
                stop = start + (stop - start + 1) // 2
            yield order[start:stop]
            start = stop

    def score(self, words: list[bytes], weights: np.ndarray) -> np.ndarray:
        """Natural log of the marginal probability of each word."""
        found, plain, lowest = np.zeros(len(words)), np.exp(weights), weights[self.node].min()
        for places in self._batches(words):
            lengths, width, arcs = self._arcs([words[i] for i in places])
            if width * lowest > LEAST:
                alpha = _forward(arcs(plain, 0.0), len(places), width)
                found[places] = np.log(alpha[lengths, np.arange(len(places))])
            else:
                alpha = _log_forward(arcs(weights, -np.inf), len(places), width)
                found[places] = alpha[lengths, np.arange(len(places))]
        return found

    def expect(self, words: list[bytes], counts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float]:
        """(expected uses of each trie node over all segmentations of the words, by their counts; their log likelihood)."""
        found, likelihood = np.zeros(len(self.child)), 0.0
        plain, lowest = np.exp(weights), weights[self.node].min()
        for places in self._batches(words):
            lengths, width, arcs = self._arcs([words[i] for i in places])
            own, each = counts[places], np.arange(len(places))
            linear = width * lowest > LEAST
            kept = list(arcs(plain, 0.0) if linear else arcs(weights, -np.inf))
            uses = []
            if linear:
                alpha = _forward(kept, len(places), width)
                total = alpha[lengths, each]
                likelihood += float(np.log(total) @ own)
                beta = np.zeros_like(alpha)
                beta[lengths, each] = own / total
                for i, j, rows, _, w in reversed(kept):
                    through = w * beta[j][rows]
                    beta[i][rows] += through
                    uses.append(alpha[i][rows] * through)
            else:
                alpha = _log_forward(kept, len(places), width)
                total = alpha[lengths, each]
                likelihood += float(total @ own)
                beta = np.full_like(alpha, -np.inf)
                beta[lengths, each] = 0
                for i, j, rows, _, w in reversed(kept):
                    through = w + beta[j][rows]
                    beta[i][rows] = np.logaddexp(beta[i][rows], through)
                    uses.append(np.exp(alpha[i][rows] + through - total[rows]) * own[rows])
            found += np.bincount(np.concatenate([x[3] for x in reversed(kept)]), np.concatenate(uses), len(found))
        return found, likelihood


def _forward(arcs: Iterable, n: int, width: int) -> np.ndarray:
    """Probabilities of the prefixes of ``n`` words, by length and word."""
    alpha = np.zeros((width + 1, n))
    alpha[0] = 1
    for i, j, rows, _, w in arcs:
        alpha[j][rows] += alpha[i][rows] * w
    return alpha


def _log_forward(arcs: Iterable, n: int, width: int) -> np.ndarray:
    """The same in logarithms, for words so long that their probabilities would underflow."""
    alpha = np.full((width + 1, n), -np.inf)
    alpha[0] = 0
    for i, j, rows, _, w in arcs:
        alpha[j][rows] = np.logaddexp(alpha[j][rows], alpha[i][rows] + w)
    return alpha


@lru_cache(maxsize=1)
def lattice(path: str) -> Lattice:
    return Lattice(path)


def lowered_words(texts) -> tuple[np.ndarray, np.ndarray, object]:
    """(place of its text, code) of each word of an Arrow array of texts, and the distinct words by code; A-Z are lowered."""
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    flat = lists.flatten()
    worded = pc.greater(pc.binary_length(flat), 0)  # white space at either end of a text leaves an empty part
    coded = flat.filter(worded).dictionary_encode()
    return owner[worded.to_numpy(zero_copy_only=False)], coded.indices.to_numpy(), coded.dictionary.cast(pa.string())


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c, t) over all texts: occurrences in training texts and in all, and the numbers of texts as the counts of END.

    ``docs`` has text and held_out. Counts are added up before the shuffle.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def added(parts: list) -> pa.Table:
            table = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("c", "sum"), ("t", "sum")])
            return table.select(["word", "c_sum", "t_sum"]).rename_columns(["word", "c", "t"]).combine_chunks()

        parts, held = [], 0
        for batch in released(text_blocks(batches, limit=BLOCK)):
            owner, codes, words = lowered_words(batch.column(0))
            trains = ~batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            c, t = np.bincount(codes[trains[owner]], minlength=len(words)), np.bincount(codes, minlength=len(words))
            table = {"word": pa.concat_arrays([words, pa.array([END])]), "c": np.append(c, trains.sum()), "t": np.append(t, len(trains))}
            parts.append(pa.table(table))
            held += len(words) + 1
            if held > TASK_WORDS:
                parts = [added(parts)]
                held = parts[0].num_rows
                if held > TASK_WORDS // 2:
                    yield from parts[0].to_batches(max_chunksize=100_000)
                    parts, held = [], 0
        if parts:
            yield from added(parts).to_batches(max_chunksize=100_000)

    parts = docs.select("text", "held_out").mapInArrow(run, "word string, c long, t long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))


def piece_probabilities(counts: DataFrame, vocab: str, steps: int, tolerance: float = TOLERANCE, smoothing: float = 0.1) -> tuple[np.ndarray, float]:
    """(natural log probability of each piece, of the end) after expectation steps over the word counts.

    Steps end when the words' log likelihood gains less than ``tolerance`` of itself, or after ``steps``. Only sums by
    piece come to the driver: at most as many as the vocabulary has.
    """
    model = lattice(vocabulary(vocab))
    words = counts.where(F.col("word") != END)
    ends = counts.where(F.col("word") == END).agg(F.sum("c")).first()[0] or 0
    logs, end_log, last = model.first, 0.0, -math.inf
    for _ in range(steps):
        sent = counts.sparkSession.sparkContext.broadcast(logs)

        def run(batches: Iterator, sent=sent) -> Iterator:
            import pyarrow as pa

            own = lattice(vocabulary(vocab))
            weights, total, likelihood = own.weights(sent.value), np.zeros(len(own.child)), 0.0
            for batch in batches:
                batch_words = batch.column(0).cast(pa.binary()).to_pylist()
                if batch_words:
                    uses, gained = own.expect(batch_words, batch.column(1).to_numpy(), weights)
                    total += uses
                    likelihood += gained
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"node": np.append(used, -1), "uses": np.append(total[used], likelihood)})

        uses, reached = np.zeros(len(model.child)), 0.0
        for row in words.mapInArrow(run, "node long, uses double").groupBy("node").agg(F.sum("uses").alias("uses")).collect():
            if row.node < 0:
                reached = row.uses
            else:
                uses[row.node] = row.uses
        pieces = uses[model.node] + smoothing
        total = pieces.sum() + ends + smoothing
        logs, end_log = np.log(pieces / total), math.log((ends + smoothing) / total)
        if reached - last < tolerance * abs(reached):
            break
        last = reached
    return logs, end_log


def score(docs: DataFrame, vocab: str = "piece_bpe_32k.model", steps: int = STEPS, tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Training documents are those whose crc32 of the id as text is not 1 modulo 5 (a null id as empty
    text). ``score`` is the lattice's log10 probability of the words and the end; ``base_score`` the
    smoothed unigram's over words. Null texts count as empty and have the end alone, repeated rows are
    scored each, an empty table gives no row. Each distinct word is scored once. Counts and scores of frequent words, of which
    there are few by definition, go to every task; those of all other words meet the documents in a join.
    """
    held = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held.alias("held_out"))
    counts = materialize(word_counts(rows), "words")
    sums = counts.agg(*(F.coalesce(x, F.lit(0)) for x in (F.sum("c"), F.count_if(F.col("c") > 0), F.sum("t"), F.sum(F.when(F.col("word") == END, F.col("c"))))))
    n, v, every, ends = sums.first()
    logs, end_log = piece_probabilities(counts.where("c > 0").select("word", "c"), vocab, steps, tolerance)
    sent = docs.sparkSession.sparkContext.broadcast(logs)

    def score_words(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = lattice(vocabulary(vocab))
        weights = own.weights(sent.value)
        for batch in batches:
            found = own.score(batch.column(0).cast(pa.binary()).to_pylist(), weights) / math.log(10) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "lp"])

    words = materialize(counts.where(F.col("word") != END).mapInArrow(score_words, "word string, c long, t long, lp double"), "scores")
    frequent = words.where(F.col("t") * FREQUENT >= every).select("word", "c", "lp").toArrow().combine_chunks()
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    scale = n + 0.5 * (v + 1)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        names, c, lp = (shared.value.column(i).combine_chunks() for i in range(3))
        c, lp = c.to_numpy(zero_copy_only=False), lp.to_numpy(zero_copy_only=False)
        lc = np.log10((c + 0.5) / scale)
        end_base, end_score = math.log10((ends + 0.5) / scale), end_log / math.log(10)
        number = TaskContext.get().partitionId() << 33
        for batch in released(text_blocks(batches, column="text", limit=BLOCK)):
            n_docs = batch.num_rows
            owner, codes, words = lowered_words(batch.column(1))
            place = pc.fill_null(pc.index_in(words, value_set=names), -1).to_numpy(zero_copy_only=False)[codes]
            common = np.flatnonzero(place >= 0)
            at, of = place[common], owner[common]
            base = np.bincount(of, lc[at], n_docs) + end_base
            known = np.bincount(of, c[at] > 0, n_docs).astype(np.int64) + (ends > 0)
            total = np.bincount(of, lp[at], n_docs) + end_score
            sizes = np.bincount(owner, minlength=n_docs) + 1
            rids = np.arange(number, number + n_docs)
            number += n_docs
            others = np.flatnonzero(place < 0)
            pairs, tf = np.unique(owner[others] * max(len(words), 1) + codes[others], return_counts=True)
            of, rare = np.divmod(pairs, max(len(words), 1))
            more = len(pairs)
            # a document's own row has a key that is no word and no other document's
            keys = pa.concat_arrays([pa.array([f" {r}" for r in rids.tolist()], pa.string()), words.take(pa.array(rare))])
            join = lambda own, kind: pa.concat_arrays([pa.array(own, kind) if not isinstance(own, pa.Array) else own, pa.nulls(more, kind)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([rids, rids[of]])),
                    keys,
                    pa.array(np.concatenate([np.zeros(n_docs, np.int64), tf])),
                    join(batch.column(0), batch.column(0).type),
                    join(batch.column(2), pa.bool_()),
                    join(sizes, pa.int64()),
                    join(known, pa.int64()),
                    join(base, pa.float64()),
                    join(total, pa.float64()),
                ],
                ["rid", "word", "tf", "id", "held_out", "n_tokens", "known", "base", "score"],
            )

    parts = rows.mapInArrow(run, f"rid long, word string, tf long, id {kind}, held_out boolean, n_tokens long, known long, base double, score double")
    joined = parts.join(words.select("word", "c", "lp"), "word", "left")
    c = F.coalesce("c", F.lit(0))
    return (
        joined.groupBy("rid")
        .agg(
            F.max("id").alias(id_col),
            F.max("held_out").alias("held_out"),
            F.max("n_tokens").alias("n_tokens"),
            (F.sum("known") + F.sum(F.when(c > 0, F.col("tf")).otherwise(0))).alias("n_known"),
            F.lit(n).cast("long").alias("train_tokens"),
            (F.sum("base") + F.sum(F.col("tf") * F.log10((c + 0.5) / F.lit(float(scale))))).alias("base_score"),
            (F.sum("score") + F.sum(F.col("tf") * F.coalesce("lp", F.lit(0.0)))).alias("score"),
        )
        .drop("rid")
    )
