"""Relational operators over any DataFrame.

Operators: K4 J1 A7 A8 A15 W1 W2 W3 W4 W5 W11 W13 T1 T13 T14 T16 U1 U2 U3.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def novel(current: DataFrame, baseline: DataFrame, keys: list[tuple[Column, Column]]) -> DataFrame:
    """Rows whose keys, each compared by itself, are all absent from the baseline; null keys never match."""
    out = current
    for mine, theirs in keys:
        seen = baseline.select(theirs.alias("__key")).where("__key is not null").distinct()
        out = out.withColumn("__mine", mine).join(seen, F.col("__mine") == F.col("__key"), "left_anti").drop("__mine")
    return out


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by an order.

    A maximum of a struct is a partial aggregation, so a key with a third of all rows is reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")).select(*key, "__row.*")


def common_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """U1."""
    both = [c for c in a.columns if c in b.columns]
    return a.select(*both).unionByName(b.select(*both))


def filled_union(frames: list[DataFrame]) -> DataFrame:
    """Schema-merging union of string tables, gaps as ''."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).fillna("")


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of old without the keys of new, and new."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def hash_sample(df: DataFrame, key: str, rate: float, seed: str = "qc") -> DataFrame:
    """The max(1, ceil(n*rate)) rows of smallest hash, without a total sort.

    Rows are counted by the hash's first three digits; whole buckets below the boundary are taken, and only the one on
    it, a 4096th of all rows, is ranked.
    """
    hashed = df.withColumn("__h", F.sha2(F.concat(F.lit(seed), F.col(key).cast("string")), 256)).withColumn("__b", F.substring("__h", 1, 3))
    counts = sorted((r["__b"], r["n"]) for r in hashed.groupBy("__b").agg(F.count(F.lit(1)).alias("n")).collect())
    want, at, taken = max(1, -(-int(sum(n for _, n in counts) * round(rate * 1_000_000)) // 1_000_000)), None, 0
    for b, n in counts:
        if taken + n >= want:
            at = b
            break
        taken += n
    below = hashed.where(F.col("__b") < F.lit(at or ""))
    edge = hashed.where(F.col("__b") == F.lit(at or "")).orderBy("__h", key).limit(want - taken)
    return below.unionByName(edge).drop("__h", "__b")


def windows(sentences: Column, size: int = 20, overlap: int = 2) -> Column:
    """Structs start, sentences; tail windows are kept even where they are covered already."""
    if overlap >= size:
        raise ValueError("overlap must be smaller than size")
    n = F.size(sentences)
    starts = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(size - overlap))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(i.alias("start"), F.slice(sentences, i + 1, size).alias("sentences")))


def top_k(df: DataFrame, key: list[str], score: str, ties: list[str], k: int, threshold: float | None = None) -> DataFrame:
    """At most k rows of each key by score, over a threshold; rank from 1.

    Spark prunes each task's rows to k a key before the shuffle (a window group limit), whatever a key's size.
    """
    w = Window.partitionBy(*key).orderBy(F.desc(score), *ties)
    out = df.where(F.col(score) >= threshold) if threshold is not None else df
    return out.withColumn("retrieval_rank", F.row_number().over(w)).where(F.col("retrieval_rank") <= k)


def with_share(df: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of each key and their percentage of all rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("share", F.round(100.0 * F.col("n") / total, 6))


def margin_lines(pages: DataFrame, paper: str, page: str, text: str, least: int = 3) -> DataFrame:
    """Normal forms of first and last two lines that recur on max(3, half) of a paper's pages or more."""
    from ..functions.text import margin_key

    lines = F.filter(F.transform(F.split(text, "\n"), lambda v: F.trim(v)), lambda x: x != "")
    ends = F.array_distinct(F.transform(F.concat(F.slice(lines, 1, 2), F.slice(lines, F.greatest(F.size(lines) - 1, F.lit(1)), 2)), margin_key))
    sizes = pages.groupBy(paper).agg(F.count_distinct(page).alias("pages"))
    found = pages.where(F.col(text).isNotNull()).select(paper, page, F.explode(ends).alias("line")).where("length(line) >= 6")
    counted = found.groupBy(paper, "line").agg(F.count_distinct(page).alias("n"))
    return counted.join(sizes, paper).where((F.col("pages") >= least) & (F.col("n") >= F.greatest(F.lit(3), F.round(F.col("pages") * 0.5)))).select(paper, "line", "n", "pages")


def carry_forward(df: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """Value of the last row that has one."""
    return df.withColumn(value, F.last(value, ignorenulls=True).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def budget_fold(costs: Column, budget: float, at_least: int = 0) -> Column:
    """Whether each of an array's costs is taken, in order; a cost that does not fit is passed by."""
    zero = F.struct(F.lit(0.0).alias("used"), F.lit(0).alias("n"), F.array().cast("array<boolean>").alias("taken"))

    def step(z: Column, c: Column) -> Column:
        take = (z["used"] + c <= budget) | (z["n"] < at_least)
        return F.struct((z["used"] + F.when(take, c).otherwise(0.0)).alias("used"), (z["n"] + take.cast("int")).alias("n"), F.concat(z["taken"], F.array(take)).alias("taken"))

    return F.aggregate(costs.cast("array<double>"), zero, step, lambda z: z["taken"])
