"""Byte-level BPE by recursive SQL: an in-process DuckDB in each partition contracts and decodes.

Words are cut where no token of the vocabulary stands across, so that merges never meet there. The bytes
of a piece are rows (word, position, token). A recursive query joins neighbouring tokens with the merge
table and contracts every piece's leftmost pair of least rank, once a round, until no piece has a pair
left. An ordered aggregation over (document, position) turns ids back into bytes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import released, text_blocks
from corpusmill.llm.tokens import BLOCK, binary_slices, distinct_chunks, expanded, vocabulary

#: Pieces of words whose ids a worker remembers; a full memo is emptied.
MEMO_PIECES = 350_000
#: Bytes of words that are cut at once.
WORD_BYTES = 4_000_000
#: Rounds of one recursion, and symbol rows that its rounds may make (fewer for long words, whose query is wider); they bound DuckDB's memory.
ROUNDS, ROUND_ROWS, LONG_ROWS = 48, 3_000_000, 600_000

#: Bytes from which a piece is contracted by all places of its least pair a round.
LONG = 256
#: Ids that one decoding query reads.
DECODE_IDS = 1_000_000

CONTRACT = """
WITH RECURSIVE steps(word, pos, tok, round) AS (
    SELECT word, pos, tok, 0 FROM symbols
    UNION ALL
    SELECT word, pos, tok, round FROM (
        WITH pairs AS (
            SELECT word, pos, tok, round, lead(tok) OVER w AS follower, lead(pos) OVER w AS follower_pos
            FROM steps WHERE round < {rounds} WINDOW w AS (PARTITION BY word ORDER BY pos)
        ), best AS (
            SELECT word, min((merged, pos, follower_pos)) AS pick
            FROM pairs JOIN merges ON tok = first AND follower = second GROUP BY word
        )
        SELECT word, pos, CASE WHEN pos = pick[2] THEN pick[1] ELSE tok END AS tok, round + 1 AS round
        FROM pairs JOIN best USING (word) WHERE pos <> pick[3]
    )
)
SELECT word, pos, tok, last FROM steps JOIN (SELECT word, max(round) AS last FROM steps GROUP BY word) USING (word)
WHERE round = last ORDER BY word, pos
"""

#: For long words: the places of the one least pair, from the left, don't wait for each other up to the first where a
#: neighbour makes a pair of still lower rank with the merged token; of a run of overlapping pairs every other one is taken.
CONTRACT_LONG = """
WITH RECURSIVE steps(word, pos, tok, round) AS (
    SELECT word, pos, tok, 0 FROM symbols
    UNION ALL
    SELECT word, pos, tok, round FROM (
        WITH pairs AS (
            SELECT word, pos, tok, round, row_number() OVER w AS nr, lag(tok) OVER w AS before, lead(tok) OVER w AS follower, lead(tok, 2) OVER w AS after
            FROM steps WHERE round < {rounds} WINDOW w AS (PARTITION BY word ORDER BY pos)
        ), possible AS (
            SELECT word, nr, before, after, merged, min(merged) OVER (PARTITION BY word) AS least FROM pairs JOIN merges ON tok = first AND follower = second
        ), places AS (
            SELECT *, row_number() OVER (PARTITION BY word ORDER BY nr) AS place FROM possible WHERE merged = least
        ), turns AS (
            SELECT *, row_number() OVER (PARTITION BY word, nr - place ORDER BY nr) AS turn FROM places
        ), risks AS (
            SELECT t.word, t.nr, t.merged, (l.first IS NOT NULL OR r.first IS NOT NULL OR b.first IS NOT NULL)::INT AS risk FROM turns t
            LEFT JOIN early l ON l.first = t.before AND l.second = t.merged
            LEFT JOIN early r ON r.first = t.merged AND r.second = t.after
            LEFT JOIN early b ON b.first = t.merged AND b.second = t.merged
            WHERE turn % 2 = 1
        ), picked AS (
            SELECT word, nr, merged FROM (SELECT *, sum(risk) OVER (PARTITION BY word ORDER BY nr) - risk AS earlier FROM risks) WHERE earlier = 0
        ), going AS (
            SELECT word, nr, merged FROM picked UNION ALL SELECT word, nr + 1, NULL FROM picked
        )
        SELECT p.word, pos, coalesce(merged, tok) AS tok, round + 1 AS round
        FROM pairs p SEMI JOIN picked ON p.word = picked.word LEFT JOIN going g ON p.word = g.word AND p.nr = g.nr
        WHERE g.word IS NULL OR merged IS NOT NULL
    )
)
SELECT word, pos, tok, last FROM steps JOIN (SELECT word, max(round) AS last FROM steps GROUP BY word) USING (word)
WHERE round = last ORDER BY word, pos
"""

#: A byte is the character of its number; rows come sorted to the aggregate, which one thread does in their order.
DECODE = "SELECT doc, string_agg(letters, '') AS letters FROM (SELECT doc, letters FROM ids JOIN tokens USING (tok) ORDER BY pos) GROUP BY doc"


class SqlBpe:
    """Encoder and decoder over a rank file: lines of base64 bytes and rank."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.bytes = np.array([ranks[bytes((b,))] for b in range(256)], np.int32)
        splits = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "700MB", "temp_directory": ""})
        self._register("merge_rows", dict(zip(("first", "second", "merged"), map(list, zip(*splits, strict=True)), strict=True)))
        self.db.execute("CREATE TABLE merges AS SELECT first::INT AS first, second::INT AS second, merged::INT AS merged FROM merge_rows")
        self.db.execute("CREATE TABLE early AS SELECT first, second FROM merges WHERE merged < greatest(first, second)")
        self._register("token_rows", {"tok": list(ranks.values()), "letters": [t.decode("latin-1") for t in ranks]})
        self.db.execute("CREATE TABLE tokens AS SELECT tok::INT AS tok, letters FROM token_rows")
        self.db.unregister("merge_rows")
        self.db.unregister("token_rows")
        self.memo: dict[bytes, bytes] = {}
        self._plant()

    def _plant(self) -> None:
        """The vocabulary as a tree of bytes: what follows a node by a byte, and which token ends at a node, or -1."""
        inner = {t[:i] for t in self.ranks for i in range(1, len(t))} | {bytes((b,)) for b in range(256)}
        nodes = {t: i for i, t in enumerate(sorted(inner, key=lambda t: (len(t), t)))}
        self.inner = len(nodes)
        nodes |= {t: i for i, t in enumerate((t for t in self.ranks if t not in inner), len(nodes))}
        self.child, self.token = np.zeros((self.inner, 256), np.int32), np.full(len(nodes), -1, np.int32)
        for t, i in nodes.items():
            self.token[i] = self.ranks.get(t, -1)
            if len(t) > 1:
                self.child[nodes[t[:-1]], t[-1]] = i

    def _register(self, name: str, columns: dict) -> None:
        import pyarrow as pa

        self.db.register(name, pa.table(columns))

    def _contract(self, words: np.ndarray, positions: np.ndarray, tokens: np.ndarray, query: str, rounds: int) -> tuple[np.ndarray, ...]:
        self._register("symbols", {"word": words, "pos": positions, "tok": tokens})
        found = self.db.execute(query.format(rounds=rounds)).fetchnumpy()
        self.db.unregister("symbols")
        return tuple(np.asarray(found[c]) for c in ("word", "pos", "tok", "last"))

    def _reach(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end, token) of the longest token that begins at each byte of words, from one bound to the next, and lies in its word."""
        end, token = np.arange(1, len(data) + 1), self.token[data]
        stop = np.repeat(bounds[1:], np.diff(bounds))
        at, node, size = np.arange(len(data)), data.astype(np.int32), 1
        while len(at):
            open_ = (node < self.inner) & (at + size < stop[at])
            at, node = at[open_], node[open_]
            node = self.child[node, data[at + size]]
            at, node, size = at[node > 0], node[node > 0], size + 1
            found = self.token[node]
            ends = found >= 0
            end[at[ends]], token[at[ends]] = at[ends] + size, found[ends]
        return end, token

    def _encode_pieces(self, pieces: list[bytes]) -> None:
        """Remembers the ids of pieces of words."""
        for of, query in (([p for p in pieces if len(p) < LONG], CONTRACT), (sorted((p for p in pieces if len(p) >= LONG), key=len), CONTRACT_LONG)):
            self.memo.update((p, ids.astype("<i4").tobytes()) for p, ids in zip(of, self._merged(of, query), strict=True))

    def _merged(self, words: list[bytes], query: str) -> list[np.ndarray]:
        """Ids of words by contraction from their bytes, in recursions whose rounds make a bounded number of rows."""
        found: list[np.ndarray] = [np.empty(0, np.int32)] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        cost = np.cumsum(lengths * np.minimum(lengths, ROUNDS))
        begin, most = 0, LONG_ROWS if query is CONTRACT_LONG else ROUND_ROWS
        while begin < len(words):
            end = max(begin + 1, int(np.searchsorted(cost, (cost[begin - 1] if begin else 0) + most, "right")))
            word = np.repeat(np.arange(begin, end), lengths[begin:end])
            pos = np.arange(len(word)) - np.repeat(np.cumsum(lengths[begin:end]) - lengths[begin:end], lengths[begin:end])
            tok = self.bytes[np.frombuffer(b"".join(words[begin:end]), np.uint8)]
            while len(word):
                # short words make no more rows than their cost, as they end after as many rounds as they have bytes
                rounds = max(1, min(ROUNDS, most // len(word))) if query is CONTRACT_LONG else ROUNDS
                word, pos, tok, last = self._contract(word, pos, tok, query, rounds)
                done = last < rounds  # the others go on from where this recursion ended
                ids, first = np.unique(word[done], return_index=True)
                for w, part in zip(ids.tolist(), np.split(tok[done], first[1:]), strict=False):
                    found[w] = part
                word, pos, tok = word[~done], pos[~done], tok[~done]
            begin = end
        return found

    def _encode_words(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, where those of each word begin and the end of all) of words of bytes, from one bound to the next.

        A word that is a token is its id, as in the library; others are cut wherever no token stands across.
        """
        import pyarrow as pa

        end, token = self._reach(data, bounds)
        known = end[bounds[:-1]] == bounds[1:]
        known &= token[bounds[:-1]] >= 0
        begin = np.flatnonzero(np.append(True, np.maximum.accumulate(end)[:-1] <= np.arange(1, len(data))))
        first_piece = np.searchsorted(begin, bounds)
        whole = np.zeros(len(begin), bool)
        whole[first_piece[:-1][known]] = True
        begin = begin[whole | ~np.repeat(known, np.diff(first_piece))]
        first_piece = np.searchsorted(begin, bounds)
        whole = np.repeat(known, np.diff(first_piece))
        ends = np.append(begin[1:], len(data))
        whole |= ends - begin == 1
        first, count = token[begin].astype(np.int64), np.ones(len(begin), np.int64)
        rest = np.flatnonzero(~whole)
        pieces = binary_slices(data, begin).take(pa.array(rest)).dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        missing = [p for p in distinct if p not in self.memo]
        if len(self.memo) + len(missing) > MEMO_PIECES:
            self.memo.clear()
            missing = distinct
        self._encode_pieces(missing)
        found = list(map(self.memo.__getitem__, distinct))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        base = int(self.token.max()) + 1
        codes = pieces.indices.to_numpy()
        first[rest], count[rest] = base + (np.cumsum(sizes) - sizes)[codes], sizes[codes]
        pool = np.concatenate([np.arange(base, dtype=np.int32), np.frombuffer(b"".join(found), "<i4")])
        ids, at = expanded(pool, first, count)
        return ids, at[first_piece]

    def encode_block(self, texts) -> list[np.ndarray]:
        """The ids of each text of a list or an Arrow array; each distinct chunk of them is split and encoded once."""
        import pyarrow as pa

        data, bounds, codes, stops = distinct_chunks(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        if not len(data):
            return [np.empty(0, np.int32)] * len(texts)
        words = pa.array([w for text in data for w in self.split(text)], pa.large_string())
        at = np.frombuffer(words.buffers()[1], np.int64)[: len(words) + 1]
        letters, parts, begin = np.frombuffer(words.buffers()[2], np.uint8), [], 0
        while begin < len(words):
            stop = max(begin + 1, int(np.searchsorted(at, at[begin] + WORD_BYTES, "right")) - 1)
            parts.append(self._encode_words(letters[at[begin] : at[stop]], at[begin : stop + 1] - at[begin]))
            begin = stop
        ids = np.concatenate([x for x, _ in parts])
        first = np.append(0, np.cumsum(np.concatenate([np.diff(x) for _, x in parts])))[np.searchsorted(at, bounds)]
        flat, at = expanded(ids, first[:-1][codes], np.diff(first)[codes])
        return [flat[a:b] for a, b in pairwise(at[stops].tolist())]

    def decode_block(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each document's ids, by ordered aggregation over at most DECODE_IDS ids a query."""
        found = [b""] * len(ids)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        if not lengths.sum():
            return found
        flat, doc, ends = np.concatenate(ids), np.repeat(np.arange(len(ids)), lengths), np.cumsum(lengths)
        pos = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
        for start in range(0, len(flat), DECODE_IDS):
            span = slice(start, start + DECODE_IDS)
            self._register("ids", {"doc": doc[span], "pos": pos[span], "tok": flat[span]})
            for i, letters in self.db.execute(DECODE).fetchall():
                found[i] += letters.encode("latin-1")
            self.db.unregister("ids")
        return found


@lru_cache(maxsize=2)
def sql_bpe(path: str, pattern: str) -> SqlBpe:
    return SqlBpe(path, pattern)


def encode_and_decode(docs: DataFrame, vocab: str = "byte_bpe_multi_50k.tiktoken", keep: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, n_tokens, ids_sha256, decoded_sha256 and with ``keep`` the ids and the decoded text.

    Digests are of the ids as little-endian unsigned 32-bit integers and of the decoded bytes. Nothing is
    shuffled. Null texts count as empty and have no id, null document ids pass through, repeated rows
    are encoded each, long words are contracted in steps of bounded memory, an empty
    table gives no row.
    """

    def run(batches: Iterator) -> Iterator:
        import public_tokenizers
        import pyarrow as pa

        bpe = sql_bpe(vocabulary(vocab), public_tokenizers.PATTERN)
        for batch in released(text_blocks(batches, limit=BLOCK)):
            ids = bpe.encode_block(batch.column(1))
            texts = bpe.decode_block(ids)
            raw = [x.astype("<u4").tobytes() for x in ids]
            digest = lambda x: hashlib.sha256(x).hexdigest()
            columns = {"id": batch.column(0), "n_tokens": np.fromiter(map(len, ids), np.int64, len(ids)), "ids_sha256": list(map(digest, raw)), "decoded_sha256": list(map(digest, texts))}
            if keep:
                columns |= {"ids": pa.array(raw, pa.binary()), "decoded": pa.array(texts, pa.binary())}
            yield pa.RecordBatch.from_pydict(columns)

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded binary" * keep
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)
