"""Sharding in Hilbert-curve order: cut the curve into runs that prune on several metadata dimensions at once.

Each dimension is quantised to 2^BITS levels, the levels become one index on the Hilbert curve, and rows are sorted
by that index and then by the remaining sort columns.  Rows of one run are near each other in every dimension, so
minimum and maximum of a shard's files are narrow in all of them.

Levels are the bounds of equal shares of all rows, found from the counts of each dimension's values; strings and numbers are
compared with them whole.  The sort is a range partitioning of narrow key rows (no text); Spark samples where one task's range
ends, which no rank depends on: rank is the row's place in its partition plus the rows of the partitions before it.  Law ``rows``:
of n rows and s shards, the row of rank r goes to shard r*s div n, so counts differ by one at most.

Cases: null text counts as no bytes; null dimensions take level 0; ties on the curve are broken by doc_id and then by
size and checksum, and rows equal in all of these are interchangeable; an empty table gives no rows; only doc_id,
text, lang and source are read, whatever else a table holds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import Scratch

BITS = 4


def hilbert_index(point: list[int], bits: int) -> int:
    """Place on the Hilbert curve of a point with coordinates below 2**bits (Skilling's transpose form)."""
    x, n, top = list(point), len(point), 1 << (bits - 1)
    q = top
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, top
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    return sum(((v >> b) & 1) << (b * n + n - 1 - i) for b in range(bits) for i, v in enumerate(x))


def on_curve(levels: list[Column], bits: int = BITS) -> Column:
    """The index of a point, read off a table of all cells that is built from the rule above."""
    n = len(levels)
    cells = [hilbert_index([(c >> (bits * (n - 1 - i))) & ((1 << bits) - 1) for i in range(n)], bits) for c in range(1 << bits * n)]
    cell = sum((v * (1 << (bits * (n - 1 - i))) for i, v in enumerate(levels)), F.lit(0))
    return F.get(F.split(F.lit(",".join(map(str, cells))), ",").cast("array<int>"), cell.cast("int"))


def quantised(value: Column, bounds: list, levels: int) -> Column:
    """How many bounds a value exceeds, spread over all levels, so that a dimension of few values halves the curve too."""
    number = sum(((value > F.lit(b)).cast("int") for b in bounds), F.lit(0))
    return F.floor(number * levels / F.lit(len(bounds) + 1)).cast("int")


def level_bounds(rows: DataFrame, dimensions: list[str], levels: int, range_values: int = 100_000) -> list[list]:
    """For each dimension, the values that cut all rows into equal shares; fewer where values recur.

    Rows of a value are counted, values are dealt into ranges of about range_values, and the values at the cuts are found
    by running sums within the ranges that hold one.
    """
    scratch, out = Scratch(rows.sparkSession, "bounds"), []
    for k, d in enumerate(dimensions):
        counted = scratch.table(rows.select(F.col(d).alias("v")).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n")), f"counts{k}")
        ranges = max(1, math.ceil(counted.count() / range_values))
        dealt = scratch.table(counted.repartitionByRange(ranges, "v").withColumn("part", F.spark_partition_id()), f"ranges{k}")
        sizes = sorted((r["part"], r["n"]) for r in dealt.groupBy("part").agg(F.sum("n").alias("n")).collect())  # one row a range
        total, before, cuts = sum(n for _, n in sizes), 0, {}
        places = sorted({total * j // levels for j in range(1, levels)})
        for part, n in sizes:
            if own := [p - before for p in places if before <= p < before + n]:
                cuts[part] = own
            before += n
        upto = F.sum("n").over(Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        held = [f"part = {part} and upto - n <= {p} and {p} < upto" for part, own in cuts.items() for p in own]
        found = dealt.where(F.col("part").isin(list(cuts))).withColumn("upto", upto).where(" or ".join(f"({h})" for h in held) or "false").select("v").toArrow()
        out.append(sorted(set(found.column("v").to_pylist())))
    scratch.clear()
    return out


def hilbert_shards(rows: DataFrame, dimensions: list[str], order: list[str], shards: int, scratch: Scratch, bits: int = BITS) -> DataFrame:
    """rows with curve, shard and slot (gapless from 0 in each shard); dimensions are columns of rows, strings or numbers."""
    bounds = level_bounds(rows, dimensions, 1 << bits)
    levels = [F.coalesce(quantised(F.col(d), b, 1 << bits), F.lit(0)) for d, b in zip(dimensions, bounds, strict=True)]
    keyed = rows.withColumn("curve", on_curve(levels, bits))
    placed = keyed.repartitionByRange("curve", *order).sortWithinPartitions("curve", *order).withColumn("__id", F.monotonically_increasing_id())
    placed = scratch.table(placed.withColumn("__part", F.shiftright("__id", 33)).withColumn("__at", F.col("__id") - F.shiftleft(F.col("__part"), 33)).drop("__id"), "placed")
    sizes = sorted((r["__part"], r["n"]) for r in placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect())  # one row a partition
    total, before, starts = sum(n for _, n in sizes), 0, []
    for part, n in sizes:
        starts.append((part, before))
        before += n
    if not starts:
        return placed.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long")).drop("__part", "__at")
    offset = F.element_at(F.map_from_arrays(F.split(F.lit(",".join(str(p) for p, _ in starts)), ",").cast("array<bigint>"), F.split(F.lit(",".join(str(b) for _, b in starts)), ",").cast("array<bigint>")), F.col("__part"))
    ranked = placed.withColumn("__rank", offset + F.col("__at"))
    first = F.expr(f"cast((cast(shard as bigint) * {total} + {shards} - 1) div {shards} as bigint)")
    return ranked.withColumn("shard", F.expr(f"cast((__rank * {shards}) div {total} as int)")).withColumn("slot", F.col("__rank") - first).drop("__part", "__at", "__rank")


def op9_hilbert_sharding(documents: DataFrame, shards: int = 8) -> DataFrame:
    """The rows of the contract, under the law ``rows``, and the curve's index."""
    scratch = Scratch(documents.sparkSession, "sharding")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"),
        F.col("lang").cast("string").alias("d_lang"), F.col("source").cast("string").alias("d_source"), F.octet_length(text).alias("d_size"),
    )
    out = hilbert_shards(rows, ["d_lang", "d_source", "d_size"], ["doc_id", "size", "text_crc32"], shards, scratch)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")
