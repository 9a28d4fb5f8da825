"""Shared pieces: word patterns, the shared folder, fixed-size bitmaps, connected components, batch helpers."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.sources.shared import materialize, shared_dir

#: Characters that separate words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
JAVA_SPACE = r"[\x20\x09-\x0D]"

#: Bits of the bitmap that stands for a set of keys; 2**25 bits are 4 MB whatever the input's size.
BITMAP_BITS = 1 << 25
BITMAP_BUCKET = 32768


def discard(df: DataFrame) -> None:
    """Deletes the files of a ``materialize`` result that no later plan reads."""
    spark = df.sparkSession
    jvm = spark._jvm
    root = shared_dir(spark)
    for name in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if "/corpusmill/" in name and name.split("/corpusmill/")[0].split(":")[-1].strip("/") == root.split(":")[-1].strip("/"):
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_of(column: Column | str) -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def key_bitmap(keys: DataFrame, key: str) -> DataFrame:
    """The set of the long column ``key`` as at most BITMAP_BITS / BITMAP_BUCKET rows (bitmap_bucket, bitmap).

    The size is fixed, so the result may be broadcast at any scale. A key of the set always tests
    true; a foreign key may too, so an exact step must follow.
    """
    bit = F.pmod(F.col(key), F.lit(BITMAP_BITS))
    return (
        keys.select(F.bitmap_bucket_number(bit).alias("bitmap_bucket"), F.bitmap_bit_position(bit).alias("bitmap_position"))
        .groupBy("bitmap_bucket")
        .agg(F.bitmap_construct_agg("bitmap_position").alias("bitmap"))
    )


def in_bitmap(df: DataFrame, key: Column, bitmap: DataFrame, flag: str) -> DataFrame:
    """``df`` with the boolean ``flag``: whether ``key`` may be in the set that ``bitmap`` stands for."""
    bit = F.pmod(key, F.lit(BITMAP_BITS))
    bucket, at, side, bits = new_names(df.columns, 4)
    known = bitmap.select(F.col("bitmap_bucket").alias(side), F.col("bitmap").alias(bits))
    joined = df.withColumn(bucket, F.bitmap_bucket_number(bit)).withColumn(at, F.bitmap_bit_position(bit)).join(F.broadcast(known), F.col(bucket) == F.col(side), "left")
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.col(at) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, F.pmod(F.col(at), F.lit(8)).cast("int")) == 1
    return joined.withColumn(flag, F.coalesce(hit, F.lit(False))).drop(bucket, at, side, bits)


def new_names(taken: list[str], n: int) -> list[str]:
    """``n`` column names that differ from all of ``taken``, case aside."""
    used = {c.lower() for c in taken}
    return [name for name in (f"__c{i}" for i in range(len(used) + n)) if name not in used][:n]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the undirected ``edges`` (a, b); nodes of a component share one root.

    Rounds of contraction: each node points to its least neighbour, edges are renamed to what their
    ends point to, loops and repeats go. Every round is a pre-aggregated minimum and two equi-joins whose
    skew AQE can split; a hub's edges are never gathered. Node values should be in random order
    (digests), which makes the edges shrink by a constant factor a round. Each round's edges and
    pointers are written to the shared folder, so lineage stays short and lost executors cost one round.
    No edge gives an empty result; repeated edges and loops change nothing.
    """
    current = materialize(edges.select("a", "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    pointers = []
    while not current.isEmpty():
        both = current.union(current.select("b", "a"))
        # the added constant makes the joins below reshuffle, which lets AQE split a hub's partition
        least = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("parent"))
        step = materialize(least, "pointers")
        pointers.append(step)
        renamed = (
            current.join(step.select(F.col("node").alias("a"), F.col("parent").alias("pa")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("parent").alias("pb")), "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct()
        )
        following = materialize(renamed, "edges")
        discard(current)
        current = following
    if not pointers:
        return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    labels = pointers[-1].select("node", F.col("parent").alias("root"))
    for step in reversed(pointers[:-1]):
        above = labels.select(F.col("node").alias("parent"), "root")
        labels = step.join(above, "parent", "left").select("node", F.coalesce("root", "parent").alias("root"))
    return labels


def released(blocks: Iterator) -> Iterator:
    """The same blocks; when they end, memory that a task no longer uses goes back to the system, as Python workers outlive tasks."""
    yield from blocks
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def text_blocks(batches: Iterator, column: str = "text", limit: int = 2_000_000) -> Iterator:
    """Arrow batches cut into slices of about ``limit`` characters of ``column``, or one longer text."""
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        yield batch.slice(start)
