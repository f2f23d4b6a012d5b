"""Connected components of a graph that is a table of links."""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.session import written


def _forest(batches):
    """Links of one task as a forest: each vertex with the smallest one that the task's links reach."""
    up: dict = {}

    def root(v):
        while up.setdefault(v, v) != v:
            up[v] = v = up[up[v]]
        return v

    kind = pa.binary()
    for batch in batches:
        kind = batch.schema.field(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    links = [(v, r) for v in list(up) if (r := root(v)) != v]
    if links:
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], kind), pa.array([x[1] for x in links], kind),
                                          pa.array([TaskContext.get().partitionId()] * len(links), pa.int32())], names=["a", "b", "task"])


def _contracted(links: DataFrame) -> DataFrame:
    """``links (a, b)`` as a forest for each part of the size that adaptive execution advises."""
    schema = links.select("a", "b", F.lit(0).cast("int").alias("task")).schema
    return written(links.select("a", "b").where("a <> b").hint("rebalance").mapInArrow(_forest, schema), "forest")


def components(links: DataFrame) -> DataFrame:
    """``(v, label)`` for each vertex of ``links (a, b)``; the label is the smallest vertex of the component.

    Each task turns its links into a forest; then large-star and small-star steps hand the neighbours of every vertex to the
    smallest of them, until all are stars or one task had all the links that were left. The least neighbour is an
    aggregate, so a vertex with very many links shrinks before the shuffle, and the join back is one whose hot side
    adaptive execution splits. The rounds grow with the logarithm of the size; each is written to the shared folder.
    """
    work = _contracted(links)
    while True:
        count, vertices, tasks = work.agg(F.count("*"), F.count_distinct("a"), F.count_distinct("task")).first()
        if tasks <= 1 or count == vertices and work.select("b").join(work.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break  # one task had all links, or each vertex has one root and no root another
        # Large star: the larger neighbours of a vertex go to the smallest of its neighbours and itself.
        both = work.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(work.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: the smaller neighbours of a vertex, and itself, go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("m").alias("b")),
                                                                F.struct(F.col("v").alias("a"), F.col("m").alias("b")))).alias("l"))
        work = _contracted(small.select("l.*").distinct())
    roots = work.select(F.col("b").alias("v"), F.col("b").alias("label")).distinct()
    return work.select(F.col("a").alias("v"), F.col("b").alias("label")).unionAll(roots)
