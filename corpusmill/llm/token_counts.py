"""Token counts by finite-state transducers compiled from a byte-level BPE vocabulary.

Two deterministic transducers give the number of tokens of a text without building its ids.

* The splitter reads character classes and marks where pieces begin. A block of texts is cut into
  chunks; each chunk's state map (exit state for every entry state) is computed for all chunks in
  lockstep, the maps compose in a parallel prefix scan, and a last lockstep pass emits the marks.
* The counter reads a piece's bytes; between pieces it is in its first state. Its state is the tail of the piece whose segmentation later
  bytes may still change; a transition is annotated with the number of tokens that became final by
  it, a state with the number its tail gives at the end. States and transitions are compiled on first
  use from the merge ranks and kept within a bound.

Null and empty texts have no token. Strings of special tokens count one, as the library's default.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import released, text_blocks, text_of
from corpusmill.llm.tokens import WHITE_SPACE, byte_letters, vocabulary

#: Bounds of the counter's tables; a full table is emptied and compiled again as needed.
MAX_TRANSITIONS, MAX_PAIRS, MAX_PIECES = 400_000, 250_000, 250_000
CHUNK = 256
#: Characters of a long text that are split and counted at once.
PART_CHARS = 1_000_000

# character classes of the splitter; the letters of contractions have their own
LETTER, SHORT, R, E, V, EL, NUMBER, BLANK, SPACE, QUOTE, OTHER, END = range(12)
STATES = ("start", "letters", "number", "other", "blank", "space", "blanks", "spaces", "quote", "quote_r", "quote_v", "quote_l", "short")
HERE, BEFORE = 1, 2


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks by (state, class): HERE, a piece begins at this character; BEFORE, at the one before."""
    at = {name: i for i, name in enumerate(STATES)}
    letters = {LETTER, SHORT, R, E, V, EL}
    fresh = {c: "letters" for c in letters} | {NUMBER: "number", BLANK: "blank", SPACE: "space", QUOTE: "quote", OTHER: "other", END: "start"}
    step = {(s, c): (fresh[c], HERE) for s in STATES for c in range(12)}
    for c in letters:
        step["letters", c] = "letters", 0
        step["blank", c] = "letters", 0
        step["blanks", c] = "letters", BEFORE
    step["number", NUMBER] = "number", 0
    step["blank", NUMBER], step["blanks", NUMBER] = ("number", 0), ("number", BEFORE)
    for c in (OTHER, QUOTE):
        step["other", c] = "other", 0
        step["quote", c] = "other", 0
        step["blank", c], step["blanks", c] = ("other", 0), ("other", BEFORE)
    for s in ("blank", "space", "blanks", "spaces"):
        step[s, BLANK], step[s, SPACE] = ("blanks", 0), ("spaces", 0)
    for c in range(12):
        if c not in (BLANK, SPACE, END):
            step["spaces", c] = fresh[c], HERE | BEFORE
    step["quote", SHORT] = "short", 0
    for c, s, last in ((R, "quote_r", E), (V, "quote_v", E), (EL, "quote_l", EL)):
        step["quote", c] = s, 0
        for d in range(12):  # the quote stands alone unless the contraction is completed
            to, mark = step["letters", d]
            step[s, d] = to, mark | BEFORE
        step[s, last] = "short", 0
    to = np.array([[at[step[s, c][0]] for c in range(12)] for s in STATES], np.intp)
    return to, np.array([[step[s, c][1] for c in range(12)] for s in STATES], np.uint8)


class Splitter:
    def __init__(self):
        self.to, self.marks = _splitter()
        self.classes = np.full(0x110000, 255, np.uint8)

    def _class(self, point: int) -> int:
        c = chr(point)
        if c == " ":
            return BLANK
        if c in WHITE_SPACE.replace("-", "") or 9 <= point <= 13 or 0x2000 <= point <= 0x200A:
            return SPACE
        if c == "'":
            return QUOTE
        kind = unicodedata.category(c)[0]
        if kind == "L":
            return {"s": SHORT, "t": SHORT, "m": SHORT, "d": SHORT, "r": R, "e": E, "v": V, "l": EL}.get(c, LETTER)
        return NUMBER if kind == "N" else OTHER

    def starts(self, points: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where pieces begin; ``ends`` are the positions of the characters that stand between texts."""
        kinds = self.classes[points]
        if (kinds == 255).any():
            for p in np.unique(points[kinds == 255]):
                self.classes[p] = self._class(int(p))
            kinds = self.classes[points]
        kinds[ends] = END
        chunks = -(-len(kinds) // CHUNK)
        kinds = np.concatenate([kinds, np.full(chunks * CHUNK - len(kinds), END, np.uint8)])
        columns = np.ascontiguousarray(kinds.reshape(chunks, CHUNK).T).astype(np.intp)
        width, to, marks = self.to.shape[1], (self.to * self.to.shape[1]).ravel(), self.marks.ravel()
        # states are kept multiplied by the number of classes, so that adding a class gives a table index
        maps = np.tile(np.arange(len(STATES)) * width, (chunks, 1))
        for column in columns:
            maps = to.take(maps + column[:, None])
        maps //= width
        shift = 1
        while shift < chunks:
            maps[shift:] = np.take_along_axis(maps[shift:], maps[:-shift], axis=1)
            shift *= 2
        state = np.concatenate([[0], maps[:-1, 0]]) * width
        found = np.empty((CHUNK, chunks), np.uint8)
        for i, column in enumerate(columns):
            at = state + column
            found[i] = marks.take(at)
            state = to.take(at)
        found = found.T.ravel()
        begins = (found & HERE).astype(bool)
        begins[:-1] |= (found[1:] & BEFORE).astype(bool)
        return np.flatnonzero(begins[: len(points)])


class Counter:
    """The piece transducer of one BPE vocabulary."""

    def __init__(self, vocab: dict[bytes, int], ranks: dict[tuple[bytes, bytes], int]):
        self.vocab, self.ranks = vocab, ranks
        self.longest = max(map(len, vocab))
        self.prefixes = {t[:i] for t in vocab for i in range(1, len(t))}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.pieces: dict[bytes | str, int] = {}
        self._reset()

    def _reset(self) -> None:
        self.states, self.tails, self.finals, self.moves = {b"": 0}, [(b"", (0,))], [0], {}

    def merged(self, text: bytes) -> list[bytes]:
        """The merges applied by rank, leftmost first."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _fits(self, left: bytes, token: bytes) -> bool:
        """Whether the merges leave ``left`` followed by ``token`` as they are."""
        found = self.pairs.get((left, token))
        if found is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            found = self.pairs[left, token] = self.merged(left + token) == ([left, token] if left else [token])
        return found

    def _compile(self, state: int, byte: int) -> int:
        """Target and emitted count of one transition, as target << 16 | count."""
        tail, lengths = self.tails[state]
        text = tail + bytes((byte,))
        n = len(text)
        for size in range(min(n, self.longest), 0, -1):
            token = text[n - size :]
            if token in self.vocab:
                before = n - size
                if lengths[before] >= 0 and self._fits(text[before - lengths[before] : before], token):
                    break
        else:
            raise ValueError("the vocabulary lacks a single byte")
        lengths = (*lengths, size)
        # a later token can only reach back to a place from which the text so far begins a token
        open_at = [j for j in range(n) if lengths[j] >= 0 and text[j:] in self.prefixes] + [n]
        shared: set[int] | None = None
        needed: set[int] = set()
        for j in open_at:
            chain = {j}
            while j:
                j -= lengths[j]
                chain.add(j)
            needed |= chain
            shared = chain if shared is None else shared & chain
        cut = max(shared)
        emitted, j = 0, cut
        while j:
            j -= lengths[j]
            emitted += 1
        rest = text[cut:]
        target = self.states.get(rest)
        if target is None:
            target = self.states[rest] = len(self.tails)
            kept = (0, *(lengths[j] if j in needed else -1 for j in range(cut + 1, n + 1)))
            total, j = 0, len(rest)
            while j:
                j -= kept[j]
                total += 1
            self.tails.append((rest, kept))
            self.finals.append(total)
        move = self.moves[state << 8 | byte] = target << 16 | emitted
        return move

    def count(self, piece: str) -> int:
        if len(self.moves) > MAX_TRANSITIONS:
            self._reset()
        state = total = 0
        moves = self.moves
        for byte in piece.encode():
            move = moves.get(state << 8 | byte)
            if move is None:
                move = self._compile(state, byte)
            state, total = move >> 16, total + (move & 0xFFFF)
        return total + self.finals[state]

    def counts(self, pieces: list[str]) -> np.ndarray:
        known = self.pieces
        if len(known) > MAX_PIECES:
            known.clear()
        for piece in set(pieces).difference(known):
            known[piece] = self.count(piece)
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))


class TokenCounter:
    """Counts tokens of blocks of texts for a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            description = json.load(file)
        splitter, model = description["pre_tokenizer"], description["model"]
        if splitter["type"] != "ByteLevel" or splitter["add_prefix_space"] or description["normalizer"] or model["type"] != "BPE":
            raise ValueError("only byte-level BPE without normalizer and added space is compiled")
        back = {c: b for b, c in byte_letters().items()}
        raw = lambda token: bytes(back[c] for c in token)
        self.special = [x["content"] for x in description["added_tokens"]]
        vocab = {raw(t): i for t, i in model["vocab"].items() if t not in self.special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.counter = Counter(vocab, {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)})
        self.splitter = Splitter()
        self.edge = re.compile(f"(?<=[^{WHITE_SPACE}])(?=[{WHITE_SPACE}])").search

    def _cut(self, text: str) -> list[str]:
        """A long text in parts of bounded size, cut where white space follows something else: there a piece always begins."""
        parts, start = [], 0
        while len(text) - start > PART_CHARS:
            found = self.edge(text, start + PART_CHARS)
            if not found:
                break
            parts.append(text[start : found.start()])
            start = found.start()
        return [*parts, text[start:]]

    def count_block(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text; blocks of bounded size are counted together, whatever the length of a text."""
        totals = np.zeros(len(texts), np.int64)
        parts, owners, held = [], [], 0

        def flush() -> None:
            nonlocal held
            np.add.at(totals, owners, self._count_parts(parts))
            parts.clear()
            owners.clear()
            held = 0

        for i, text in enumerate(texts):
            found = [text] if text else []
            for special in self.special:
                cut = [p.split(special) for p in found]
                totals[i] += sum(map(len, cut)) - len(cut)
                found = [p for c in cut for p in c if p]
            for part in (q for p in found for q in (self._cut(p) if len(p) > PART_CHARS else [p])):
                if parts and held + len(part) > 2 * PART_CHARS:
                    flush()
                parts.append(part)
                owners.append(i)
                held += len(part)
        if parts:
            flush()
        return totals

    def _count_parts(self, parts: list[str]) -> np.ndarray:
        joined = "\n".join(parts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = (np.cumsum(lengths + 1) - 1)[:-1]
        starts = self.splitter.starts(points, ends)
        bounds = starts.tolist()
        pieces = [joined[i:j] for i, j in zip(bounds, [*bounds[1:], len(joined)], strict=True)]
        counts = self.counter.counts(pieces)
        counts[np.searchsorted(starts, ends)] = 0  # the characters between parts
        # a piece takes the counter from its first state back to it, so its map is that state and a count: the scan is a sum
        scan = np.concatenate([[0], np.cumsum(counts)])
        first = np.searchsorted(starts, np.concatenate([[0], ends + 1]))
        return scan[np.append(first[1:], len(counts))] - scan[first]


@lru_cache(maxsize=2)
def counter_of(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(docs: DataFrame, vocab: str = "byte_bpe_50k.json", limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: its id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    Rows are read once and never shuffled; repeated rows give repeated results, null ids pass
    through, null texts count as empty, other columns are not read. An empty table gives none. A long
    text is counted in parts, so it takes no more memory than its own characters.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counter = counter_of(vocabulary(vocab))
        for batch in released(text_blocks(batches)):
            n = counter.count_block(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    slim = docs.select(F.col(id_col).alias("id"), F.octet_length(text_of(text_col)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    counted = slim.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
