"""Token ids as bit planes: blocks of ids transposed to planes, each compressed, with a chunk index.

A shard is one self-contained binary image:

    magic "BPLN" | u1 version | u1 bits a plane row (1 or 8) | u2 planes | u4 ids a block | u8 ids | u8 documents
    | planes of all blocks, each a zstandard frame
    | chunk index: u4 size of every frame, block by block and plane by plane
    | document index: i8 id, u1 null flag, u8 ids of each document, zstandard
    | u4 size of the document index

All numbers are little-endian. Images are kept in a table of the shared folder, one row a shard,
because only Spark's writers reach the shared store from executors.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import discard, materialize, released, shared_dir, text_blocks
from corpusmill.llm.tokens import encoded_documents, stored_ids

MAGIC, VERSION = b"BPLN", 1
HEAD = struct.Struct("<4sBBHIQQ")
BLOCK_IDS = 1 << 15
SHARD_IDS = 1 << 18


def to_planes(block: np.ndarray, bits: int, plane_bits: int) -> np.ndarray:
    """Rows of bytes: with ``plane_bits`` 1 a row for each bit of the ids, with 8 a row for each byte."""
    raw = block.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : -(-bits // 8)]
    if plane_bits == 8:
        return np.ascontiguousarray(raw.T)
    return np.packbits(np.unpackbits(raw, axis=1, bitorder="little")[:, :bits].T, axis=1, bitorder="little")


def from_planes(planes: np.ndarray, n: int, plane_bits: int) -> np.ndarray:
    raw = np.zeros((n, 4), np.uint8)
    if plane_bits == 8:
        raw[:, : len(planes)] = planes.T
    else:
        bits = np.zeros((n, 32), np.uint8)
        bits[:, : len(planes)] = np.unpackbits(planes, axis=1, count=n, bitorder="little").T
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").ravel()


def write_shard(ids: np.ndarray, doc_ids: list[int | None], counts: list[int], plane_bits: int = 1, level: int = 1) -> bytes:
    """The image of one shard; ``counts`` are the ids of each document in order."""
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    planes = bits if plane_bits == 1 else -(-bits // 8)
    pack = zstandard.ZstdCompressor(level=level).compress
    frames = [pack(row.tobytes()) for i in range(0, len(ids), BLOCK_IDS) for row in to_planes(ids[i : i + BLOCK_IDS], bits, plane_bits)]
    table = np.zeros(len(doc_ids), [("id", "<i8"), ("null", "u1"), ("n", "<u8")])
    table["id"], table["null"], table["n"] = [x or 0 for x in doc_ids], [x is None for x in doc_ids], counts
    documents = pack(table.tobytes())
    head = HEAD.pack(MAGIC, VERSION, plane_bits, planes, BLOCK_IDS, len(ids), len(doc_ids))
    return b"".join([head, *frames, np.array(list(map(len, frames)), "<u4").tobytes(), documents, struct.pack("<I", len(documents))])


def _index(image: bytes) -> tuple[int, int, int, np.ndarray, np.ndarray, int]:
    """(bits a plane row, planes, ids a block, where each frame starts, document table, ids) of an image."""
    magic, version, plane_bits, planes, block, n, _ = HEAD.unpack_from(image)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a shard of bit planes")
    (documents,) = struct.unpack_from("<I", image, len(image) - 4)
    table_at = len(image) - 4 - documents
    table = np.frombuffer(zstandard.ZstdDecompressor().decompress(image[table_at:-4]), [("id", "<i8"), ("null", "u1"), ("n", "<u8")])
    frames = -(-n // block) * planes
    sizes = np.frombuffer(image, "<u4", frames, table_at - 4 * frames)
    return plane_bits, planes, block, HEAD.size + np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), table, n


def read_range(image: bytes, start: int, stop: int) -> np.ndarray:
    """The ids from ``start`` to ``stop`` of an image; the chunk index tells the only blocks that are decompressed."""
    plane_bits, planes, block, starts, _, n = _index(image)
    start, stop = max(start, 0), min(stop, n)
    unpack, parts = zstandard.ZstdDecompressor().decompress, []
    for b in range(start // block, -(-stop // block) if stop > start else 0):
        rows = [np.frombuffer(unpack(image[starts[k] : starts[k + 1]]), np.uint8) for k in range(b * planes, (b + 1) * planes)]
        parts.append(from_planes(np.stack(rows), min(block, n - b * block), plane_bits))
    if not parts:
        return np.empty(0, "<u4")
    skipped = start // block * block
    return np.concatenate(parts)[start - skipped : stop - skipped]


def read_shard(image: bytes) -> tuple[np.ndarray, list[int | None], np.ndarray]:
    """(ids, document ids, ids of each document) of an image."""
    table, n = _index(image)[4:]
    return read_range(image, 0, n), [None if null else i for i, null in zip(table["id"].tolist(), table["null"].tolist(), strict=True)], table["n"].astype(np.int64)


def write_ids(docs: DataFrame, path: str, vocab: str = "word_bpe_49k.json", end_id: int = 1, plane_bits: int = 1, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of all documents in ascending order of their integer id (nulls first) as a table of shards.

    Texts become ids before they are shuffled. The rows are dealt by ranges of (id, hash of the ids), which
    also splits an id that many rows share, and each range is cut into shards of bounded size; a document is
    never cut, and its ids take fewer bytes than its text. Null texts count as empty and get the end id
    alone; repeated rows are written each; an empty table gives an empty table of shards.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError(f"ids are integers, not {kind}")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        part, number = TaskContext.get().partitionId(), 0
        ids, doc_ids, total = [], [], 0

        def shard():
            image = write_shard(np.concatenate(ids), doc_ids, list(map(len, ids)), plane_bits)
            return pa.RecordBatch.from_pydict({"part": [part], "number": [number], "n_ids": [total], "n_docs": [len(ids)], "image": [image]})

        for batch in released(text_blocks(batches, column="ids")):
            for doc_id, found in zip(batch.column(0).to_pylist(), stored_ids(batch, 2), strict=True):
                ids.append(found)
                doc_ids.append(doc_id)
                total += len(found)
                if total >= SHARD_IDS:
                    yield shard()
                    ids, doc_ids, total, number = [], [], 0, number + 1
        if ids:
            yield shard()

    encoded = materialize(encoded_documents(docs, vocab, end_id, id_col, text_col), "encoded", "zstd")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["id", "salt"]
    dealt = encoded.withColumn("id", F.col("id").cast("long")).repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "wide", "ids")
    dealt.mapInArrow(run, "part long, number long, n_ids long, n_docs long, image binary").write.option("compression", "none").parquet(path)
    discard(encoded)


def read_ids(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of each document, decoded from the shards below ``path``."""
    shards = spark.read.schema("part long, number long, n_ids long, n_docs long, image binary").parquet(path)
    # one row a range, of which there are spark.sql.shuffle.partitions at most
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    bases = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    sizes = shards.select("part", "number", "n_ids")
    local = sizes.select("part", "number", (F.sum("n_ids").over(Window.partitionBy("part").orderBy("number")) - F.col("n_ids")).alias("before"))
    placed = shards.join(F.broadcast(bases), "part").join(local, ["part", "number"]).select((F.col("base") + F.col("before")).alias("first"), "image")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in released(batches):
            for first, image in zip(batch.column(0), batch.column(1), strict=True):
                ids, doc_ids, counts = read_shard(image.as_py())
                ends = np.cumsum(counts)
                pieces = [ids[j - n : j].astype("<u4").tobytes() for j, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                columns = {
                    "doc_id": pa.array(doc_ids, pa.int64()),
                    "start": first.as_py() + ends - counts,
                    "n_tokens": counts,
                    "ids_crc32": np.fromiter(map(zlib.crc32, pieces), np.int64, len(pieces)),
                }
                if keep_ids:
                    columns["ids"] = pa.array(pieces, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids)


def id_files_path(spark: SparkSession, label: str) -> str:
    import uuid

    return f"{shared_dir(spark)}/corpusmill/{label}-{uuid.uuid4().hex}"
