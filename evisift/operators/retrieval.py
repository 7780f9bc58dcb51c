"""Passage retrieval: centroids, scores and a diverse, budgeted choice.

Operators: A12 W6 W13 T3 T8 R10.  Scores are native columns; only the greedy choice, in which each step
depends on the ones before, runs per paper in pandas, over ``POOL`` passages of it at a time.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import dot, norm
from ..sources.scratch import Scratch

# Fixed values.
SECTION_CAP, PAGE_WINDOW, PAGE_CAP, NEAR_DUPLICATE, POOL = 2, 2, 2, 0.82, 200


def centroids(vectors: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean of each label's normalised vectors, per dimension a partial aggregation."""
    length = norm(F.col(vector))
    unit = F.transform(F.col(vector).cast("array<double>"), lambda x: F.when(length > 0, x / length).otherwise(0.0))
    mean = vectors.select(label, F.posexplode(unit).alias("at", "x")).groupBy(label, "at").agg(F.avg("x").alias("x"))
    return mean.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("centroid"))


def certainty(df: DataFrame, key: list[str], score: str) -> DataFrame:
    """Rank, min-max percentile (1 alone, 0.5 if flat) and label within each key."""
    w = Window.partitionBy(*key)
    lo, hi, n = F.min(score).over(w), F.max(score).over(w), F.count(F.lit(1)).over(w)
    share = F.when(n == 1, 1.0).when(hi == lo, 0.5).otherwise((F.col(score) - lo) / (hi - lo))
    return df.withColumn("certainty_percentile", share).withColumn("certainty_label", F.when(share >= 0.8, "high").when(share >= 0.5, "medium").otherwise("low"))


def score_vectors(vectors: DataFrame, vector: str, centroid: DataFrame) -> DataFrame:
    """Positive minus negative cosine; centroid has one row with columns pos and neg."""
    c = vectors.join(F.broadcast(centroid.limit(1)))  # one row
    length = norm(F.col(vector))
    cosine = lambda other: F.when(length > 0, dot(F.col(vector), F.col(other)) / (length * norm(F.col(other)))).otherwise(0.0)
    return c.withColumn("pos_score", cosine("pos")).withColumn("neg_score", cosine("neg")).withColumn("score", F.col("pos_score") - F.col("neg_score")).drop("pos", "neg")


def hybrid_score(base: Column, section: Column, sentences: Column, readability: Column, digits: Column, low_quality: Column) -> Column:
    """T3 without topic cues: what a passage's form adds to or takes from its similarity."""
    add = lambda cond, v: F.when(cond, v).otherwise(0.0)
    return (
        base + add(section == "method", 0.05) + 0.04 * readability + add(sentences > 0, 0.06 * F.least(sentences / 20.0, F.lit(1.0)))
        - add((sentences > 0) & (sentences < 12), 0.08) - add(digits > 0.20, 0.05) - add(section == "reference", 0.10) - add(low_quality, 0.15)
    )


def choose(rows: pd.DataFrame, k: int, budget: float, limit: int) -> pd.DataFrame:
    """T8, W13 for one paper: caps are relaxed in three passes by score; costs that do not fit are passed by.

    rows: what was picked before, with pick and pool -1, and the best rows left of each first pass that may take them,
    its number as pool.  Of POOL rows or more, which may not be all, a pass sees the best; after it the choice stops,
    and open tells so.
    """
    rows = rows.reset_index(drop=True)
    tokens = [set(t) if t is not None else set() for t in rows["tokens"]]
    before = rows[rows["pool"] < 0].sort_values("pick")
    picked = [int(i) for i in before.index]
    used = float(before["cost"].sum())
    have = Counter(before["row_key"])
    rows["tie"] = rows["chunk_id"].fillna("")
    left = rows[rows["pool"] >= 0].sort_values(["order", "tie", "row_key"], ascending=[False, True, True])
    more = False
    for level in range(3):
        pool = left[left["pool"] <= level].head(limit)
        skip = Counter(have)
        for i, r in pool.iterrows():
            if skip[r["row_key"]] > 0:
                skip[r["row_key"]] -= 1
                continue
            if len(picked) >= k or used + r["cost"] > budget:
                continue
            same = sum(rows["section"][j] == r["section"] for j in picked)
            near = sum(rows["page"][j] // PAGE_WINDOW == r["page"] // PAGE_WINDOW for j in picked)
            twin = any(len(tokens[i] & tokens[j]) >= NEAR_DUPLICATE * max(1, len(tokens[i] | tokens[j])) for j in picked)
            if twin and level < 2 or level < 1 and near >= PAGE_CAP or level < 2 and same >= SECTION_CAP:
                continue
            picked.append(int(i))
            have[r["row_key"]] += 1
            used += r["cost"]
        if len(picked) < k and len(pool) >= limit:
            more = True
            break
    out = rows.loc[picked].copy()
    out["pick"] = range(1, len(picked) + 1)
    if more and not picked:  # nothing fits yet: a row without a pick keeps the paper open
        out = rows.iloc[:1].copy()
        out["pick"] = 0
    out["open"] = more
    return out


def _best(df: DataFrame, key: list[str], n: int) -> DataFrame:
    """The first n rows of each key by score, place from 1; Spark prunes each task's rows before the shuffle."""
    w = Window.partitionBy(*key).orderBy(F.desc("order"), "chunk_id", "row_key")
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def _lowest_pass(picks: Column, budget: float) -> Column:
    """The first pass that a row may be picked in after these picks; null if its cost no longer fits.

    More picks only refuse more, so a row refused once need not be seen again.
    """
    count = lambda test: F.size(F.filter(picks, test))
    used = F.aggregate(picks, F.lit(0.0), lambda z, p: z + F.coalesce(p["cost"], F.lit(0.0))) + F.col("cost")
    same = count(lambda p: p["section"].eqNullSafe(F.col("section"))) >= SECTION_CAP
    window = lambda page: F.floor(page / PAGE_WINDOW)
    near = count(lambda p: F.coalesce(window(p["page"]) == window(F.col("page")), F.lit(False))) >= PAGE_CAP
    over = F.coalesce((used > budget) & ~F.isnan(used), F.lit(False))
    return F.when(over, F.lit(None).cast("int")).when(same, 2).when(near, 1).otherwise(0)


def _twin(picks: Column) -> Column:
    """Whether the row's words are nearly those of a pick; sets of too different size are not compared."""
    n = F.size("tokens")
    both = lambda p: F.size(F.array_intersect(p["tokens"], F.col("tokens")))
    alike = lambda p: both(p) * (1 + NEAR_DUPLICATE) >= NEAR_DUPLICATE * (F.size(p["tokens"]) + n)
    close = lambda p: F.least(n, F.size(p["tokens"])) >= NEAR_DUPLICATE * F.greatest(F.lit(1), n, F.size(p["tokens"]))
    return F.exists(picks, lambda p: F.when(close(p), alike(p)).otherwise(False))


def diverse_selection(chunks: DataFrame, k: int, budget: float) -> DataFrame:
    """paper_id, chunk_id, section, page, score, cost, text of the chosen rows and their order.

    No paper is gathered whole: a round takes the best POOL rows of each paper that what was picked before does not
    refuse, and those papers whose pool ran out go on to the next round, until k are picked or no row is left.
    """
    names = ["paper_id", "chunk_id", "section", "page", "score", "cost", "text"]
    kinds = ["string", "string", "string", "int", "double", "double", "string"]
    scratch = Scratch(chunks.sparkSession, "selection")
    rows = chunks.select(*[F.col(n).cast(t).alias(n) for n, t in zip(names, kinds, strict=True)])
    rows = rows.withColumn("row_key", F.xxhash64(*names)).withColumn("order", F.nanvl("score", F.lit(None).cast("double")))
    rows = scratch.table(rows, "rows")  # scores are worked out once
    # Words as str.split() parts them, by one function for filter and choice.
    words = F.array_distinct(F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"(?U)[\s\x1c-\x1f]+"), lambda w: w != ""))
    columns = [*names, "row_key", "order"]
    schema = ", ".join([*(f"{n} {t}" for n, t in zip(names, kinds, strict=True)), "row_key long, order double, pool int, place int, pick int, open boolean"])

    def ask(left: DataFrame, limit: int) -> DataFrame:
        run = lambda g: choose(g, k, budget, limit).reindex(columns=[*columns, "pool", "place", "pick", "open"])
        return left.withColumn("tokens", words).groupBy("paper_id").applyInPandas(run, schema)

    parts = ["pool", "place", "pick"]
    found = scratch.table(ask(_best(rows, ["paper_id"], POOL).select(*columns, F.lit(0).alias("pool"), "place", F.lit(0).alias("pick")), POOL), "round-0")
    done = found.where("not open")
    step = 0
    while found.where("open").limit(1).count():  # ends: each round picks a row of an open paper or closes it
        step += 1
        held = found.where("open")
        picks = F.array_sort(F.collect_list(F.when(F.col("pick") > 0, F.struct("pick", "section", "page", "cost", words.alias("tokens")))))
        state = held.groupBy(F.col("paper_id").alias("of")).agg(picks.alias("picks"))
        left = rows.join(state, F.col("paper_id").eqNullSafe(F.col("of"))).withColumn("pool", _lowest_pass(F.col("picks"), budget)).where("pool is not null")
        left = left.withColumn("tokens", F.when(F.col("pool") < 2, words)).withColumn("pool", F.when(F.col("pool") == 2, 2).when(_twin(F.col("picks")), 2).otherwise(F.col("pool")))
        left = _best(left.select(*columns, "pool"), ["paper_id", "pool"], POOL + k).select(*columns, "pool", "place", F.lit(0).alias("pick"))
        before = held.where("pick > 0").select(*columns, F.lit(-1).alias("pool"), "place", "pick")
        found = scratch.table(ask(left.unionByName(before), POOL + k), f"round-{step}")
        done = done.unionByName(found.where("not open"))
    done = done.where("pick > 0").select(*columns, *parts)
    if not step:  # places in the one pool are ranks
        return done.select(*names, F.col("place").alias("retrieval_rank"), "pick")
    done = scratch.table(done, "picked")
    other = rows.select(F.col("paper_id").alias("of"), F.col("order").alias("o"), F.col("chunk_id").alias("c"), F.col("row_key").alias("key"))
    place = lambda order, chunk, key: F.struct(F.coalesce(order, F.lit(float("-inf"))).alias("o"), F.coalesce(chunk, F.lit("")).alias("c"), key.alias("k"))
    mine, its = place(F.col("order"), F.col("chunk_id"), F.col("row_key")), place(F.col("o"), F.col("c"), F.col("key"))
    ahead = (its["o"] > mine["o"]) | (its["o"] == mine["o"]) & ((its["c"] < mine["c"]) | (its["c"] == mine["c"]) & (its["k"] < mine["k"]))
    counted = done.select("paper_id", "order", "chunk_id", "row_key", "pick").join(other, F.col("paper_id").eqNullSafe(F.col("of")) & ahead)
    ranks = counted.groupBy("paper_id", "pick").agg((F.count(F.lit(1)) + 1).cast("int").alias("at"))
    ranked = done.alias("l").join(ranks.alias("p"), F.expr("l.paper_id <=> p.paper_id and l.pick = p.pick"), "left")
    return ranked.select(*[F.col(f"l.{n}") for n in names], F.coalesce("p.at", F.lit(1)).alias("retrieval_rank"), F.col("l.pick"))
