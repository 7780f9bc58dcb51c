"""Connected components of a graph given as edge rows, without gathering the graph anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import Scratch, lean


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each of n nodes' component under edges a-b, all within one task's bounded block."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (up := label[label]).tobytes() != label.tobytes():
            label = up
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


@lean
def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of each batch replaced by a star to the smallest node of its local component."""
    for x in batches:
        u, v = (np.asarray(x.column(k)) for k in (0, 1))
        ids, at = np.unique(np.r_[u, v], return_inverse=True)
        root = ids[roots(len(ids), at[: len(u)], at[len(u) :])]
        off = root != ids
        yield pa.record_batch({"u": ids[off], "v": root[off]})


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(id, component) for every node of edges (u long, v long); component is the smallest id reachable.

    Alternating large-star and small-star rounds until the edges are stars.  Each minimum over neighbours is a
    partial aggregation, and the joins that hand it back read written tables, so a hot node splits.  Self edges
    and repeated rows are allowed.  Nulls are dropped.  No edges: no rows.
    """
    spark = scratch.spark
    edges = edges.select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")).where("u != v")
    edges = scratch.table(edges.mapInArrow(_contract, "u long, v long").distinct(), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.table(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{name}-low-{turn}")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.table(large, f"{name}-large-{turn}")
        low = scratch.table(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-down-{turn}")
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        small = scratch.table(small, f"{name}-{turn}")
        # Stars: every node has one parent and no parent has a parent.
        heads = small.select(F.col("v").alias("u")).distinct()
        stray = small.groupBy("u").agg(F.count(F.lit(1)).alias("n")).join(heads.withColumn("head", F.lit(1)), "u", "left").where("n > 1 or head = 1").limit(1).count()
        for old in (f"{name}-{turn - 1}", f"{name}-low-{turn}", f"{name}-large-{turn}", f"{name}-down-{turn}"):
            scratch.drop(old)
        edges = small
        if not stray:
            break
    out = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return out.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
