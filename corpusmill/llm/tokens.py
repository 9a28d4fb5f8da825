"""Token ids of whole texts, equal to those of the tokenizers library.

The merges of a vocabulary file are compiled to a rank table of the tiktoken library, which applies
them several times as fast. Both pick the merge of least rank, leftmost first; they could differ only in
a token that its own merges don't build, so every token is checked when the file is read, and a
vocabulary that fails goes to the tokenizers library alone.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import released, text_blocks

#: Characters with the Unicode property White_Space: a fixed value of the standard.
WHITE_SPACE = "\t-\r \x85\xa0  -     　"
#: Latin letters that normalisation leaves alone; symbols that are no letters, numbers or spaces in any version of Unicode.
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"
SYMBOLS = "\x00\x03-\x08\x0e-\x1f!-/:-@\\[-`{-\x7f¡-©«-±´¶-¸»¿×÷‐-‧‰-⁞€"
#: What ends a word, and what stands for a word that the library encodes, in the rank table of a vocabulary with word ends.
WORD_END, ELSEWHERE = "\x01", "\x02"
#: Bytes with which no character with that property begins.
WORD_BYTES = ~np.isin(np.arange(256), [*b"\t\n\x0b\x0c\r ", *(c.encode()[0] for c in "\x85\xa0\u1680\u2000\u2028\u205f\u3000")])
#: Space and U+0009 to U+000D.
DROPPED_BYTES = np.isin(np.arange(256), list(b"\t\n\x0b\x0c\r "))
#: Characters whose chunks are encoded together.
BLOCK = 8_000_000
#: Stored ids: those of larger vocabularies take four bytes.
NARROW, WIDE = np.dtype("<u2"), np.dtype("<u4")


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Ids of a vocabulary file of the tokenizers library, without begin, end or added special tokens.

    Strings of special tokens inside a text are handled as the library's default does; null counts as empty.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            description = json.load(file)
        special = {x["content"]: x["id"] for x in description["added_tokens"]}
        self.special = list(special)
        self.dtype = NARROW if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else WIDE
        self.encode_text, self.chunks = self._library, None
        model, splitter, normal = description["model"], description["pre_tokenizer"] or {}, description["normalizer"]
        if model["type"] != "BPE" or model.get("dropout") or not special:
            return
        suffix = model["end_of_word_suffix"] or ""
        ranks = self._ranks(model, special, suffix)
        if ranks is None:
            return
        import public_tokenizers
        import tiktoken

        if splitter.get("type") == "ByteLevel" and splitter["use_regex"] and not splitter["add_prefix_space"] and not normal and not suffix:
            self.fast = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
            self.encode_text = lambda text: self.fast.encode_to_numpy(text, allowed_special="all")
            self.chunks = None if any(" " in s for s in special) else self._byte_chunks
            self.sizes = np.zeros(self.fast.n_vocab, np.int64)
            for token, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
                self.sizes[i] = len(token)
        elif suffix and splitter.get("type") == "Sequence" and splitter["pretokenizers"][0].get("behavior") == "Removed" and normal and len(special) > 1:
            # lower case; white space is dropped, and no rule looks across it
            self.mark = special[self.special[0]]
            ranks[(ELSEWHERE + WORD_END).encode()] = self.mark
            self.fast = tiktoken.Encoding(path, pat_str=f"[^{WORD_END}]+{WORD_END}", mergeable_ranks=ranks, special_tokens={})
            self.safe = re.compile(f"[{LETTERS}{SYMBOLS}0-9 \t-\r]*").fullmatch
            self.pieces = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[{SYMBOLS}]+").findall
            self.words = re.compile("[^ \t-\r]+").findall
            self.encode_text = self._words
            self.chunks = None if any(re.search("[ \t-\r]", s) for s in special) else self._word_chunks
            self.sizes = np.zeros(self.fast.n_vocab, np.int64)
            for token, i in ranks.items():
                self.sizes[i] = len(token.removesuffix(WORD_END.encode()))

    def _ranks(self, model: dict, special: dict[str, int], suffix: str) -> dict[bytes, int] | None:
        """Ids by the bytes of their tokens (a word's end as WORD_END), or none if ids don't give the order of the merges
        or a token isn't what its own merges build."""
        from tokenizers.models import BPE

        vocab = {t: i for t, i in model["vocab"].items() if t not in special}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        first = 512 if suffix else 256
        cut = len(suffix)
        if len(vocab) != first + len(merges) or any(vocab.get(a[: len(a) - cut if a.endswith(suffix) and cut else None] + b) != first + i for i, (a, b) in enumerate(merges)):
            return None
        inner = BPE(vocab=vocab, merges=merges)
        for token, i in vocab.items():
            ends = bool(cut) and token.endswith(suffix)
            built = self.tokenizer.model.tokenize(token[:-cut]) if ends else inner.tokenize(token)
            if [x.id for x in built] != [i]:
                return None
        back = {c: b for b, c in byte_letters().items()}
        end = WORD_END.encode()
        ranks = {bytes(back[c] for c in (t[:-cut] if cut and t.endswith(suffix) else t)) + (end if cut and t.endswith(suffix) else b""): i for t, i in vocab.items()}
        return ranks if len(ranks) == len(vocab) else None

    def _library(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def _words(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return self._library(text)
        if self.safe(text):
            found = self.pieces(text.lower())
            return self.fast.encode_to_numpy(WORD_END.join(found) + WORD_END) if found else np.empty(0, self.dtype)
        pieces, elsewhere = [], []
        for word in self.words(text):
            if self.safe(word):
                pieces += self.pieces(word.lower())
            else:
                pieces.append(ELSEWHERE)
                elsewhere.append(word)
        ids = self.fast.encode_to_numpy(WORD_END.join(pieces) + WORD_END)
        found = [np.asarray(x.ids, ids.dtype) for x in self.tokenizer.encode_batch_fast(elsewhere, add_special_tokens=False)]
        spots = np.flatnonzero(ids == self.mark)
        parts = np.split(ids, spots)
        return np.concatenate([parts[0], *(x for own, rest in zip(found, parts[1:], strict=True) for x in (own, rest[1:]))])

    def encode_block(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; call it with blocks of bounded size."""
        none = np.empty(0, self.dtype)
        return [self.encode_text(t).astype(self.dtype) if t else none for t in texts]

    def encode_array(self, texts, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of an Arrow array, each followed by ``end``; where each text begins, and the end of all).

        Each distinct chunk of the array is encoded once, where the vocabulary has chunks.
        """
        dtype = np.promote_types(self.dtype, np.min_scalar_type(end)).newbyteorder("<")
        if not self.chunks:
            parts = [np.append(x, x.dtype.type(end)) for x in (y.astype(dtype) for y in self.encode_block(texts.to_pylist()))]
            return np.concatenate([np.empty(0, dtype), *parts]), np.concatenate([[0], np.cumsum([len(x) for x in parts], dtype=np.int64)])
        pool, count, codes, stops = self.chunks(texts)
        n = len(count)
        pool, count = np.append(pool, end).astype(dtype), np.append(count, 1)
        order = np.insert(codes.astype(np.int64), stops[1:], n)
        flat, at = expanded(pool, (np.cumsum(count) - count)[order], count[order])
        return flat, at[stops + np.arange(len(stops))]

    def _byte_chunks(self, texts) -> tuple[np.ndarray, ...]:
        """(ids of the distinct chunks one after another, how many of each, the chunks of all texts by number, how many before each text and of all).

        The byte-level splitter parts every text before a space that a character other than white space follows, whatever
        stands around it, and no special string has a space. So the chunks that begin with such a space are encoded as one
        text, in which they are parted again.
        """
        joined, bounds, codes, stops = distinct_chunks(texts)
        ids = np.concatenate([np.empty(0, self.dtype), *map(self.encode_text, joined)])
        last = np.searchsorted(np.cumsum(self.sizes[ids]), bounds[1:], "right")
        return ids, np.diff(last, prepend=0), codes, stops

    def _word_chunks(self, texts) -> tuple[np.ndarray, ...]:
        """The same of a vocabulary with word ends: chunks are what stands between white space, which is dropped; neither a rule
        nor a special string reaches across. Lower case keeps the number of bytes of what ``safe`` lets through."""
        import pyarrow as pa

        data, bounds = flat_bytes(texts)
        inside = ~DROPPED_BYTES[data]
        first = inside & (starts(bounds, len(data)) | np.append(True, ~inside[:-1])[: len(data)])
        chunks = binary_slices(data[inside], np.flatnonzero(first[inside])).dictionary_encode()
        codes, distinct = chunks.indices.to_numpy(), chunks.dictionary.cast(pa.large_string()).to_pylist()
        safe = np.fromiter((self.safe(x) is not None for x in distinct), bool, len(distinct))
        joined = " ".join([x for x, own in zip(distinct, safe, strict=True) if own])
        if any(s in joined for s in self.special):
            safe &= np.fromiter((not any(s in x for s in self.special) for x in distinct), bool, len(distinct))
            joined = " ".join([x for x, own in zip(distinct, safe, strict=True) if own])
        found = self.pieces(joined.lower())
        ids = self.fast.encode_to_numpy(WORD_END.join(found) + WORD_END) if found else np.empty(0, self.dtype)
        sizes = flat_bytes(chunks.dictionary)[1]
        last = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(np.diff(sizes)[safe]), "right")
        count = np.empty(len(distinct), np.int64)
        count[safe] = np.diff(last, prepend=0)
        elsewhere = [x.ids for x in self.tokenizer.encode_batch_fast([x for x, own in zip(distinct, safe, strict=True) if not own], add_special_tokens=False)]
        count[~safe] = [len(x) for x in elsewhere]
        # the safe ones' ids stand first
        place = np.empty(len(distinct), np.int64)
        place[np.argsort(~safe, kind="stable")] = np.arange(len(distinct))
        pool = np.concatenate([ids, *(np.asarray(x, self.dtype) for x in elsewhere)]).astype(self.dtype)
        stops = np.searchsorted(np.flatnonzero(first), bounds)
        return pool, np.concatenate([count[safe], count[~safe]]), place[codes], stops


def distinct_chunks(texts) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The distinct chunks of the texts of an Arrow array, cut before every space that a character other than white space follows.

    Returns texts to split, in which chunks are parted again (those that begin with such a space as one text, then each other);
    where the bytes of each chunk begin in them, and the end of all; the chunks of all texts, by number; how many come before
    each text, and of all.
    """
    import pyarrow as pa

    data, bounds = flat_bytes(texts)
    cut = words_begin(data, bounds)
    begin = np.flatnonzero(cut | starts(bounds, len(data)))
    chunks = binary_slices(data, begin).dictionary_encode()
    codes, distinct = chunks.indices.to_numpy(), chunks.dictionary
    joined = np.zeros(len(distinct), bool)
    joined[codes[cut[begin]]] = True
    together, alone = np.flatnonzero(joined), np.flatnonzero(~joined)
    first = distinct.take(pa.array(together))
    rest = distinct.take(pa.array(alone)).to_pylist()
    text, ends = flat_bytes(first)
    place = np.empty(len(distinct), np.int64)
    place[together], place[alone] = np.arange(len(together)), len(together) + np.arange(len(alone))
    at = np.append(ends, ends[-1] + np.cumsum([len(x) for x in rest], dtype=np.int64))
    return [x.decode() for x in [text.tobytes(), *rest] if x], at, place[codes], np.searchsorted(begin, bounds)


def flat_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts of an Arrow array, where each begins and the end of all); null counts as empty."""
    import pyarrow as pa

    filled = texts.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1] if len(filled) else np.zeros(1, np.int64)
    return np.frombuffer(filled.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def binary_slices(data: np.ndarray, begin: np.ndarray):
    """The bytes from each place to the next, the last to the end, as an Arrow array without copies."""
    import pyarrow as pa

    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(np.append(begin, len(data)).astype(np.int64)), pa.py_buffer(data)])


def expanded(pool: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the ranges of ``pool`` one after another, where each begins and the end of all)."""
    total = np.cumsum(count)
    flat = pool[np.repeat(first - total + count, count) + np.arange(total[-1] if len(total) else 0)]
    return flat, np.append(0, total)


def starts(bounds: np.ndarray, size: int) -> np.ndarray:
    """Whether a text begins at a byte."""
    found = np.zeros(size + 1, bool)
    found[bounds] = True
    return found[:-1]


def words_begin(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether a byte of UTF-8 texts, from one bound to the next, is a space that a character other than white space follows in its text."""
    found = np.zeros(len(data), bool)
    found[:-1] = (data[:-1] == 32) & WORD_BYTES[data[1:]] & ~starts(bounds, len(data))[1:]
    return found


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder a Python worker; it holds the vocabulary and nothing of the texts."""
    return Encoder(path)


def vocabulary(name: str) -> str:
    """Place of a vocabulary file on this machine; called on executors, whose folders may differ from the driver's."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoded_documents(docs: DataFrame, vocab: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(id, salt, wide, ids) of each document: ids in two bytes each where all fit, ``salt`` a hash of both."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encode = encoder(vocabulary(vocab))
        narrow = encode.dtype.itemsize == 2 and end_id < 1 << 16
        stored = NARROW if narrow else WIDE
        for batch in released(text_blocks(batches, limit=BLOCK)):
            flat, bounds = encode.encode_array(batch.column(1), end_id)
            flat, bounds = memoryview(flat.astype(stored, copy=False)).cast("B"), bounds * stored.itemsize
            salt = [zlib.crc32(flat[a:b]) for a, b in pairwise(bounds.tolist())]
            ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(salt), [None, pa.py_buffer(bounds), pa.py_buffer(flat)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(salt, pa.int64()), pa.array([not narrow] * len(salt)), ids], ["id", "salt", "wide", "ids"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, salt long, wide boolean, ids binary")


def stored_ids(batch, column: int) -> list[np.ndarray]:
    """The ids of a batch; the flag before them tells their width."""
    return [np.frombuffer(x, WIDE if wide else NARROW) for x, wide in zip(batch.column(column).to_pylist(), batch.column(column - 1).to_pylist(), strict=True)]
