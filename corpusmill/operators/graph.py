"""Connected components of an edge table by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.sources.shared import materialize


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(id, component) of every node, component being the least id that edges connect it to.

    A node points to its least neighbour, edges are renamed to what their ends point to, loops and
    repeats go, until no edge is left; then pointers are followed back. Nodes are compared by a hash of
    their id first: in such a random order a path shrinks by a constant factor a round, whereas natural order
    takes a round a step. Minima are pre-aggregated and joins are plain equi-joins, so a hub's edges are
    never gathered by one task. Every round is written to the shared folder. Nulls are ignored; no edge
    gives an empty result.
    """
    node = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
    pairs = edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(node(src).alias("a"), node(dst).alias("b"))
    current = materialize(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    loops = current.where("a = b").select(F.col("a.id").alias("id"))
    current = current.where("a <> b")
    steps = []
    while not current.isEmpty():
        both = current.union(current.select("b", "a"))
        step = materialize(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("parent")), "pointers")
        steps.append(step)
        renamed = current.join(step.toDF("a", "pa"), "a").join(step.toDF("b", "pb"), "b").where("pa <> pb")
        current = materialize(renamed.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    if not steps:
        return loops.select("id", F.col("id").alias("component"))
    labels = steps[-1].toDF("node", "root")
    for step in reversed(steps[:-1]):
        labels = step.join(labels.toDF("parent", "root"), "parent", "left").select("node", F.coalesce("root", "parent").alias("root"))
    labels = materialize(labels.select(F.col("node.id").alias("id"), F.col("root.id").alias("root")), "labels")
    alone = loops.join(labels, "id", "left_anti")
    least = labels.groupBy("root").agg(F.min("id").alias("component"))
    return labels.join(least, "root").select("id", "component").union(alone.select("id", F.col("id").alias("component")))
