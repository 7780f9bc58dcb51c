"""Embedding near-dedup by iterative quantisation, multi-index Hamming tables and exact reranking.

* Classes: equal vectors of a label are one from here on, with a number of copies, so thousands of them weigh as one.
* Codes: on a bounded sample (``max_fit_rows``, a parameter) a rotation is learned that turns principal components into
  balanced binary codes (alternating signs and an orthogonal Procrustes step).  Several rotations from different
  starts give independent codes.  Every valid vector is coded.
* Tables: codes are cut into substrings of s bits, at most log2 of the largest label's rows, one table each; vectors of
  a label that agree on a table's substring meet.  A bit flips with chance angle/pi, the angle being that of the centred
  vectors, which grows with what all vectors have in common.  It is taken from the sample, and the number of tables, and
  with it of rotations, is what brings the chance to meet at the threshold to ``TARGET``.
* Buckets are found with ids and codes only; those with one vector drop out before any vector is sent.
* Rerank: cosine in double precision of the original vectors.  A pair is counted in the first table where it meets, so
  links are counted without a list of pairs: each task returns a number of links and one edge per vector.
* A bucket of m vectors is dealt into ceil(m / ``CELL``) blocks, and every two blocks meet in a task of their own: each
  vector is sent once a table for every ``CELL`` vectors of its bucket.

Cases: vectors that are null, zero, or hold null or non-finite components, and null labels and vec_ids, link with
nothing; vectors of different length never link; rows equal in vec_id, label and vector are one vector, rows that share
a vec_id only are different ones, and each row of a vec_id returns the links of all; equal vectors link; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowstream import whole_groups
from .components import components, roots
from .runtime import Scratch, lean

THRESHOLD, TARGET, CELL = 0.98, 0.9999, 1024
#: Buckets of so many vectors and more are compared by one product.
DENSE = 48
#: What sending a row to a table costs in comparisons, and a number of tables that no plan reaches.
SEND, MOST = 64, 1 << 14


def learn_codes(x: np.ndarray, rotations: int, rounds: int = 50, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and a matrix whose columns' signs are the codes: rotations of the principal components, side by side."""
    mean = x.mean(0)
    d = x.shape[1]
    _, vectors = np.linalg.eigh(np.cov(x, rowvar=False).reshape(d, d) if len(x) > 1 else np.eye(d))
    v = (x - mean) @ vectors
    out = []
    for k in range(rotations):
        r = np.linalg.qr(np.random.default_rng(seed + k).normal(size=(d, d)))[0]
        for _ in range(rounds):
            a, _, b = np.linalg.svd(v.T @ np.where(v @ r >= 0, 1.0, -1.0))
            r = a @ b
        out.append(vectors @ r)
    return mean, np.concatenate(out, 1)


def flip_rates(x: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """The chance that a bit of each centred unit vector differs from that of a vector just at the threshold.

    Centring keeps the distance of the two but shortens both, so the angle grows with what the vectors have in common.
    It is largest, asin(distance / length), where the pair is seen along the tangent; 90 degrees at most are taken.
    """
    distance = math.sqrt(2 - 2 * threshold)
    return np.arcsin(np.minimum(1, distance / np.maximum(np.linalg.norm(x, axis=1), 1e-12))) / math.pi


def plan_tables(x: np.ndarray, label: np.ndarray, rows: int, threshold: float = THRESHOLD, target: float = TARGET) -> tuple[int, int, int]:
    """Bits of a substring, number of tables and of rotations, for centred unit vectors x of a sample and their labels.

    The tables bring the mean chance to meet at the threshold to the target in every label of 64 vectors or more, and
    in the others together.  Of the widths of a substring the cheapest is taken: a row sent costs about SEND
    comparisons, and both grow with dimensions and tables.  No bits, one table, compares a label's vectors all.
    """
    d = x.shape[1]
    flip = flip_rates(x, threshold)
    _, group, size = np.unique(label, return_inverse=True, return_counts=True)
    group = np.unique(np.where(size[group] >= 64, group, -1), return_inverse=True)[1]
    size = np.bincount(group)
    order = np.lexsort((np.random.default_rng(5).random(len(x)), label))
    i, j = order[:-1][label[order[1:]] == label[order[:-1]]], order[1:][label[order[1:]] == label[order[:-1]]]
    length = np.maximum(np.linalg.norm(x, axis=1), 1e-12)
    agree = 1 - np.arccos(np.clip(np.einsum("ij,ij->i", x[i], x[j]) / (length[i] * length[j]), -1, 1)) / math.pi if len(i) else np.full(1, 0.5)
    best = (float((SEND + rows) * (d + 1)), 0, 1)
    for bits in range(1, max(1, min(d, 62, math.ceil(math.log2(max(rows, 2))) - 1)) + 1):
        miss = 1 - (1 - flip) ** bits
        enough = lambda tables: (np.bincount(group, miss**tables) / size).max() <= 1 - target  # noqa: B023, E731
        low, high = 0, 1
        while high < MOST and not enough(high):
            low, high = high, 2 * high
        if high >= MOST:
            break
        while high - low > 1:
            low, high = (low, (low + high) // 2) if enough((low + high) // 2) else ((low + high) // 2, high)
        best = min(best, (high * (SEND + rows * float((agree**bits).mean())) * (d + high), bits, high))
    _, bits, tables = best
    return bits, tables, math.ceil(tables / (d // max(1, bits)))


def unit(column: pa.Array, d: int) -> np.ndarray:
    """Rows of a list column as doubles of length 1."""
    v = np.asarray(column.flatten().cast(pa.float64())).reshape(-1, d)
    v = v / np.abs(v).max(1, keepdims=True) if len(v) else v
    return v / np.linalg.norm(v, axis=1, keepdims=True) if len(v) else v


KEPT = ["node", "label", "embedding", "copies"]


def _codes(mean: np.ndarray, matrix: np.ndarray, bits: int, tables: int, d: int):
    weight = (1 << np.arange(bits)).astype(np.int64)
    per = d // max(1, bits)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            sign = (unit(x.column("embedding"), d) - mean) @ matrix >= 0
            codes = np.stack([sign[:, t // per * d + t % per * bits :][:, :bits] @ weight for t in range(tables)], 1).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1, dtype=np.int32) * tables), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*(x.column(c) for c in KEPT), lists], [*KEPT, "codes"])

    return run


def _pairs_of(cut: np.ndarray, v: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs within each group whose cosine reaches the threshold."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    size = np.diff(cut)
    for a, b in zip(cut[:-1][size >= DENSE].tolist(), cut[1:][size >= DENSE].tolist(), strict=True):
        i, j = np.nonzero(np.triu(v[a:b] @ v[a:b].T >= threshold - 1e-9, 1))
        left.append(i + a)
        right.append(j + a)
    few = np.where(size < DENSE, size, 0)
    at = np.repeat(cut[:-1], few) + np.arange(few.sum()) - np.repeat(np.cumsum(few) - few, few)
    end = np.repeat(cut[1:], few)
    for k in range(1, int(few.max(initial=1))):
        i = at[at + k < end]
        left.append(i)
        right.append(i + k)
    a, b = np.concatenate(left), np.concatenate(right)
    # One way of summing decides, whatever way a pair was found.
    near = np.concatenate([np.zeros(0, bool), *(np.einsum("ij,ij->i", v[a[s : s + 32768]], v[b[s : s + 32768]]) >= threshold for s in range(0, len(a), 32768))])
    return a[near], b[near]


def _rerank(d: int, tables: int, threshold: float):
    """node, n, root: links in copies, and edges, of the pairs that meet in this table first."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cut in whole_groups(batches, ["label", "table", "code", "x", "y"]):
            for lo, hi in _runs(cut):
                part = t.slice(cut[lo], cut[hi] - cut[lo])
                v = unit(part.column("embedding").combine_chunks(), d)
                node, copies, table = (part.column(c).to_numpy() for c in ("node", "copies", "table"))
                codes = np.asarray(part.column("codes").combine_chunks().flatten()).reshape(-1, tables)
                block, cross = part.column("block").to_numpy(), part.column("x").to_numpy() != part.column("y").to_numpy()
                i, j = _pairs_of(cut[lo : hi + 1] - cut[lo], v, threshold)
                before = (codes[i] == codes[j]) & (np.arange(tables) < table[i][:, None])
                # In a cell of two blocks only pairs across them count; the others meet in their own block's cell.
                first = ~before.any(1) & (~cross[i] | (block[i] != block[j]))
                i, j = i[first], j[first]
                if len(i):
                    nodes, back = np.unique(np.r_[node[i], node[j]], return_inverse=True)
                    root = nodes[roots(len(nodes), back[: len(i)], back[len(i) :])]
                    n = np.bincount(back, np.r_[copies[j], copies[i]], len(nodes))
                    yield pa.record_batch({"node": nodes, "n": n.astype(np.int64), "root": root})

    return run


def _runs(cut: np.ndarray, rows: int = 4096) -> Iterator[tuple[int, int]]:
    """Ranges of groups of about so many rows together."""
    lo = 0
    while lo < len(cut) - 1:
        hi = max(lo + 1, int(np.searchsorted(cut, cut[lo] + rows, "right")) - 1)
        yield lo, hi
        lo = hi


def near_links(vectors: DataFrame, d: int, scratch: Scratch, threshold: float = THRESHOLD, max_fit_rows: int = 20_000) -> DataFrame:
    """node, n, root: partial numbers of links, and edges, of different vectors node, label, embedding, copies of length d."""
    name = f"d{d}"
    sizes = vectors.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    share = min(1.0, max_fit_rows / max(1, sizes["all"]))
    sample = vectors.where(F.expr(f"pmod(xxhash64(node), 1048576) < {math.ceil(share * 1048576)}")).select("embedding", F.xxhash64("label").alias("label")).toArrow()
    x = unit(sample.column("embedding").combine_chunks(), d)
    bits, tables, rotations = plan_tables(x - x.mean(0), sample.column("label").to_numpy(), sizes["most"], threshold)
    mean, matrix = learn_codes(x, rotations)
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in KEPT) + ", codes array<bigint>"
    coded = scratch.table(vectors.select(*KEPT).mapInArrow(_codes(mean, matrix, bits, tables, d), schema), f"{name}-codes")
    keyed = coded.select("node", "label", F.posexplode("codes").alias("table", "code"))
    # Ids and codes first: buckets with one vector go, and larger ones than a cell holds are dealt into blocks.
    shared = scratch.table(keyed.groupBy("label", "table", "code").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), f"{name}-shared")
    met = keyed.join(shared.hint("merge"), ["label", "table", "code"]).withColumn("blocks", F.ceil(F.col("size") / CELL).cast("int"))
    met = met.withColumn("block", F.expr("cast(pmod(xxhash64(node), blocks) as int)"))
    met = scratch.table(met.groupBy("node").agg(F.collect_list(F.struct("table", "code", "block", "blocks")).alias("met")), f"{name}-met")  # at most one entry a table
    sent = coded.join(met.hint("merge"), "node").select(*KEPT, "codes", F.inline("met"))
    sent = sent.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = sent.select(*KEPT, "codes", "table", "code", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    keys = ["label", "table", "code", "x", "y"]
    return sent.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_rerank(d, tables, threshold), "node long, n long, root long")


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    ok = "label is not null and embedding is not null and size(embedding) > 0 and vec_id is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x != 0)"
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").where(F.coalesce(F.expr(ok), F.lit(False)))


def distinct_vectors(valid: DataFrame) -> DataFrame:
    """label, embedding, copies, first (smallest vec_id) and node of each different vector of a label.

    node is that vec_id, but where different vectors share it, a hash of the vector.
    """
    one = valid.groupBy("label", "embedding", "vec_id").agg(F.lit(1).alias("one")).groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    several = one.groupBy("first").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("first", F.lit(True).alias("several"))
    out = one.join(several.hint("merge"), "first", "left")
    return out.select("label", "embedding", "copies", "first", F.expr("if(several, xxhash64(label, embedding), first)").alias("node"))


def op10_embedding_near_dedup(embeddings: DataFrame) -> DataFrame:
    """The rows of the contract."""
    scratch = Scratch(embeddings.sparkSession, "embeddings")
    valid = valid_vectors(embeddings)
    vectors = scratch.table(distinct_vectors(valid), "vectors")
    found = None
    for r in vectors.groupBy(F.size("embedding").alias("d")).count().orderBy("d").collect():  # one row for each length there is
        part = near_links(vectors.where(F.size("embedding") == r["d"]), r["d"], scratch)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return embeddings.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = scratch.table(found, "found")
    groups = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")), scratch)
    links = found.groupBy("node").agg(F.sum("n").alias("n"))
    per = links.join(groups.withColumnRenamed("id", "node"), "node", "left")
    # Copies of a vector: each finds its class by the vector itself, but the classes of one are spared the way.
    classes = vectors.join(per.hint("merge"), "node", "left").select("label", "embedding", "first", "copies", F.coalesce("component", "node").alias("component"), F.expr("coalesce(n, 0L) + copies - 1").alias("n"))
    classes = scratch.table(classes, "classes")
    smallest = scratch.table(classes.groupBy("component").agg(F.min("first").alias("component_id")), "smallest")
    classes = classes.join(smallest.hint("merge"), "component")
    linked = classes.where("n > 0")
    alone = linked.where("copies = 1").select(F.col("first").alias("vec_id"), "n", "component_id")
    many = linked.where("copies > 1").select("label", "embedding", "n", "component_id")
    copied = valid.join(many.hint("merge"), ["label", "embedding"]).select("vec_id", "n", "component_id").distinct()
    placed = alone.unionByName(copied).groupBy("vec_id").agg(F.sum("n").alias("n"), F.min("component_id").alias("component_id"))
    out = embeddings.select("vec_id").join(placed.hint("merge"), "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))
