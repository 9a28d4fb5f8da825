"""MinHash signatures and banding; hash arithmetic in NumPy over Arrow batches."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MERSENNE_61 = (1 << 61) - 1
PRIME_32 = 4294967291
MASK_32 = 0xFFFFFFFF
#: Hashes that one pass over the permutations takes, and characters of texts that are worked on together.
SLICE, BLOCK_CHARS = 1 << 14, 4_000_000


def permutations(num_perm: int, variant: str = "v1", seed: int = 42) -> np.ndarray:
    """Rows a and b of the hash family: v1 draws a and b in turn modulo 2^61 - 1, v2 all a, then all b below 2^32 - 5."""
    draw = np.random.RandomState(seed)
    if variant != "v2":
        pairs = [(draw.randint(1, MERSENNE_61, dtype=np.uint64), draw.randint(0, MERSENNE_61, dtype=np.uint64)) for _ in range(num_perm)]
        return np.array(pairs, np.uint64).T
    return np.array([draw.randint(1, PRIME_32, num_perm, dtype=np.uint32), draw.randint(0, PRIME_32, num_perm, dtype=np.uint32)], np.uint32)


def band_choice(threshold: float, num_perm: int) -> tuple[int, int]:
    """(bands, rows) that minimise half the false positive and half the false negative area."""
    points, weights = np.polynomial.legendre.leggauss(64)

    def area(low: float, high: float, curve) -> float:
        x = (high - low) / 2 * points + (high + low) / 2
        return float((high - low) / 2 * (weights * curve(x)).sum())

    best = min(
        (0.5 * area(0.0, threshold, lambda s, b=b, r=r: 1 - (1 - s**r) ** b) + 0.5 * area(threshold, 1.0, lambda s, b=b, r=r: (1 - s**r) ** b), b, r)
        for b in range(1, num_perm + 1)
        for r in range(1, num_perm // b + 1)
    )
    return best[1], best[2]


def shingle_hashes(text: str, size: int, least: int, variant: str) -> np.ndarray:
    """Hashes of a text's word n-grams: SHA-1 words of whole n-grams (v1), of its distinct tokens (tokens), or xxh32 with
    short texts as one gram (v2)."""
    if variant == "tokens":
        found = set(re.split("[^A-Za-z_0-9]", text)) - {""}
        return np.frombuffer(b"".join([hashlib.sha1(t.encode()).digest()[:4] for t in found]), "<u4").astype(np.uint64)
    if variant == "v1":
        tokens = re.split("[^A-Za-z_0-9]", text)
        if len(tokens) < max(size, least):
            return np.empty(0, np.uint64)
        grams = {" ".join(gram) for gram in zip(*(tokens[i:] for i in range(size)), strict=False)}
        sha1 = hashlib.sha1
        return np.frombuffer(b"".join([sha1(g.encode()).digest()[:4] for g in grams]), "<u4").astype(np.uint64)
    import xxhash

    tokens = re.split(r"\W", text.lower())
    grams = set() if len(tokens) < least else {" ".join(tokens[i : i + size]) for i in range(max(1, len(tokens) - size + 1))}
    return np.fromiter(map(xxhash.xxh32_intdigest, grams), np.uint32, len(grams))


def signatures(hashes: list[np.ndarray], perms: np.ndarray, variant: str) -> np.ndarray:
    """Minima over the shingles of each text, a row of 32-bit numbers a text; 2^32 - 1 everywhere for a text without shingles.

    Products wrap at 64 bits (v1) or 32 bits (v2). All texts are worked on together in slices that fit the
    processor's cache, so a long text takes no more memory than its hashes.
    """
    a, b = perms
    found = np.full((len(a), len(hashes)), MASK_32, np.uint32)
    sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
    if not sizes.sum():
        return found.T
    flat, owner = np.concatenate(hashes), np.repeat(np.arange(len(hashes)), sizes)
    for start in range(0, len(flat), SLICE):
        part, texts = flat[start : start + SLICE], owner[start : start + SLICE]
        first = np.flatnonzero(np.concatenate([[True], texts[1:] != texts[:-1]]))
        rows = texts[first]
        x, high = np.empty_like(part), np.empty_like(part)
        for i in range(len(a)):
            np.multiply(part, a[i], out=x)
            x += b[i]
            if variant != "v2":
                # x mod 2^61 - 1 without a division: the high bits are added to the low ones, which leaves less than twice the modulus
                np.right_shift(x, np.uint64(61), out=high)
                x &= np.uint64(MERSENNE_61)
                x += high
                x[x >= np.uint64(MERSENNE_61)] -= np.uint64(MERSENNE_61)
                x &= np.uint64(MASK_32)
            else:
                x[x >= np.uint32(PRIME_32)] -= np.uint32(PRIME_32)
            minima = np.minimum.reduceat(x, first).astype(np.uint32)
            found[i, rows] = np.minimum(found[i, rows], minima)
    return found.T


def signature(hashes: np.ndarray, perms: np.ndarray, variant: str) -> np.ndarray:
    """The minima of one text."""
    return signatures([hashes], perms, variant)[0].astype(np.uint64)


def minhash_signatures(
    docs: DataFrame, num_perm: int = 256, ngram: int = 5, least: int = 5, variant: str = "v1", seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, sig binary, n_shingles) of each document, ``sig`` being ``num_perm`` big-endian 32-bit numbers; null texts count as empty."""
    perms = permutations(num_perm, variant, seed)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sizes = pc_lengths(batch.column(1))
            start = 0
            while start < batch.num_rows:
                stop, total = start, 0
                while stop < batch.num_rows and (stop == start or total + sizes[stop] <= BLOCK_CHARS):
                    total += sizes[stop]
                    stop += 1
                part = batch.slice(start, stop - start)
                hashes = [shingle_hashes(t or "", ngram, least, variant) for t in part.column(1).to_pylist()]
                rows = signatures(hashes, perms, variant).astype(">u4")
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r.tobytes() for r in rows], pa.binary()), pa.array(list(map(len, hashes)), pa.int64())], ["id", "sig", "n_shingles"])
                start = stop

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"id {kind}, sig binary, n_shingles long")


def pc_lengths(column) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


def band_keys(signed: DataFrame, bands: int, rows: int) -> DataFrame:
    """(band, h, id): the rows of each band as bytes."""
    parts = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.substring("sig", i * (4 * rows) + 1, F.lit(4 * rows)))
    return signed.select("id", F.posexplode(parts).alias("band", "h")).select("band", "h", "id")


def star_edges(keys: DataFrame) -> DataFrame:
    """(src, dst): each id of a bucket to the bucket's least id; minima are pre-aggregated, buckets never gathered.

    ``keys`` is read twice: give it a written table. The length of a band's key, joined on too, makes both sides
    reshuffle, which lets AQE split the partition of a bucket that many ids share.
    """
    least = keys.groupBy("band", "h").agg(F.min("id").alias("dst"), F.max("id").alias("most")).where("dst < most").select("band", "h", F.length("h").alias("k"), "dst")
    return keys.withColumn("k", F.length("h")).join(least, ["band", "h", "k"]).where("id <> dst").select(F.col("id").alias("src"), "dst").distinct()
