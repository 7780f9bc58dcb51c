"""Fuzzy record linkage in blocks.  Operators: W7 M17."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import jaccard

# Fixed values.
LEAST_SCORE, LEAST_GAP = 55.0, 8.0


def candidates(targets: DataFrame, others: DataFrame, token: str = "tokens", least: float = 0.0) -> DataFrame:
    """Pairs that share a token: an equi-join instead of every pair.

    With ``least``, only pairs whose token sets may have that Jaccard similarity or more, and all of them: each set is
    looked up by its rarest tokens, as many as any set that similar must share one of, so common tokens pair nothing.
    """
    t, o = (df.select(key, F.array_distinct(token).alias("all")) for df, key in ((targets, "target_id"), (others, "other_id")))
    t, o = (df.select("*", F.explode("all").alias("token")) for df in (t, o))
    if least > 0:
        seen = t.select("token").unionByName(o.select("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))

        def rare(df: DataFrame, key: str) -> DataFrame:
            sets = df.join(seen, "token").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("s"))
            many = F.size("s") - F.ceil(F.size("s") * least - 1e-9) + 1
            return sets.select(key, F.explode(F.slice("s", F.lit(1), many.cast("int"))).alias("x")).select(key, F.col("x.token").alias("token"))

        t, o = rare(t, "target_id"), rare(o, "other_id")
    return t.select("target_id", "token").join(o.select("other_id", "token"), "token").select("target_id", "other_id").distinct()


def decide(scored: DataFrame, key: list[str] = ("target_id",)) -> DataFrame:
    """Best and second score of each target and what follows from them; copies, if there, is how many others a row stands for."""
    w = Window.partitionBy(*key).orderBy(F.desc("score"), "other_id")
    ranked = scored.withColumn("rank", F.row_number().over(w)).withColumn("second", F.lead("score").over(w)).where("rank = 1")
    second = F.when(F.col("copies") > 1, F.col("score")).otherwise(F.col("second")) if "copies" in scored.columns else F.col("second")
    gap = F.col("score") - F.coalesce(second, F.lit(0.0))
    word = F.when((F.col("score") >= LEAST_SCORE) & (gap >= LEAST_GAP), "match").when(F.col("score") >= LEAST_SCORE, "ambiguous").otherwise("unmatched")
    return ranked.select(*key, "other_id", "score", F.round(gap, 6).alias("gap"), word.alias("decision"))


def score_tokens(pairs: DataFrame, targets: DataFrame, others: DataFrame) -> DataFrame:
    """The token part of a score, up to 100."""
    joined = pairs.join(targets.select("target_id", F.col("tokens").alias("a")), "target_id").join(others.select("other_id", F.col("tokens").alias("b")), "other_id")
    return joined.select("target_id", "other_id", F.round(100 * jaccard(F.col("a"), F.col("b")), 6).alias("score"))
