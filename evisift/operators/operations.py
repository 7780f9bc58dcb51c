"""Run catalogue, retries, resources, mismatches and review summaries.

Operators: K4 K11 K13 P18 P19 P48 F8 F27 J2 J23 A17 A18 A20 A21 A22 A23 A25 A27 A29 M10 M16 H9 H13 H15 H19 H20.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .relational import latest, upsert

# Fixed values.
STAMP = r"([0-9]{8})[_-]?([0-9]{6})"
EMISSIONS = ["duration", "emissions", "energy_consumed", "cpu_energy", "gpu_energy", "ram_energy"]


def attempt(df: DataFrame, key: list[str], number: str) -> DataFrame:
    """The next attempt of each label."""
    return df.groupBy(*key).agg((F.coalesce(F.max(number), F.lit(0)) + 1).alias("next_attempt"))


def manifest(parts: list[tuple[str, DataFrame]], key: list[str], item: str) -> DataFrame:
    """Distinct ids over several artefacts, with the artefacts that name each."""
    rows = None
    for name, df in parts:
        one = df.select(*key, item).distinct().withColumn("artefact", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy(*key, item).agg(F.array_sort(F.collect_set("artefact")).alias("artefacts"))


def time_saved(minutes: Column, qc_papers: Column, papers: Column, runtime_minutes: Column) -> tuple[Column, Column]:
    """Minutes saved, and their share of the manual time (a fraction, whatever its name says elsewhere)."""
    manual = minutes / qc_papers * papers
    saved = manual - runtime_minutes
    return saved, F.when(manual > 0, saved / manual)


def energy(devices: Column, watts: Column, usage: Column, hours: Column, memory_watts: Column, pue: float, grid: float) -> tuple[Column, Column]:
    """kWh and grams of an assumed device."""
    kwh = (devices * watts * usage + memory_watts) * hours / 1000 * F.lit(pue)
    return kwh, kwh * F.lit(grid)


def merge_usage(a: Column, b: Column) -> Column:
    """Key-wise sum of two maps."""
    return F.map_zip_with(a, b, lambda _, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))


def total_inference(total: Column, count: Column, percent: Column) -> Column:
    """An explicit total, else count per percent; below 100 percent the larger of both."""
    guess = F.when(percent > 0, F.round(count * 100 / percent))
    return F.when(total.isNull(), guess).when((percent < 100) & (guess > total), guess).otherwise(total)


def mismatches(pairs: DataFrame) -> DataFrame:
    """Rows of human and AI decisions that differ, FP or FN; an AI without decision is UNDECIDED."""
    kind = F.when(~F.coalesce(F.col("ai").isin(0, 1), F.lit(False)), "UNDECIDED").when((F.col("human") == 0) & (F.col("ai") == 1), "FP").otherwise("FN")
    return pairs.where(~F.col("human").eqNullSafe(F.col("ai"))).withColumn("mismatch", kind)


def unique_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join on a key that must be unique on both sides; a repeated key raises when it is met."""
    checked = lambda df: df.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(key))).withColumn(key, F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit(f"repeated {key}: "), F.col(key).cast("string")))).otherwise(F.col(key))).drop("__n")
    return checked(left).join(checked(right), key)


def review_summary(reviews: DataFrame, keys: list[str]) -> DataFrame:
    """Rates of accepted, corrected and unclear decisions, and whether they call for another look."""
    out = reviews.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("expert_decision") == d).alias(d) for d in ("accept", "correct", "mark_unavailable", "unclear")])
    rate = lambda c: F.round(F.col(c) / F.col("n"), 6).alias(f"{c}_rate")
    return out.select(*keys, "n", rate("accept"), rate("correct"), rate("unclear"), ((F.col("correct") + F.col("unclear")) / F.col("n") >= 0.2).alias("trigger"))


def drift(old: list[Column], new: list[Column]) -> Column:
    """The first of context, template and text hashes that differs, else none."""
    names = ("context", "template", "assembly")
    return F.coalesce(*[F.when(~a.eqNullSafe(b), F.lit(n)) for a, b, n in zip(old, new, names, strict=True)], F.lit("none"))


def stale_runs(runs: DataFrame) -> DataFrame:
    """runs without tokens and papers, unless a live run shares their minute."""
    dead = (F.coalesce("tokens_total", F.lit(0)) <= 0) & (F.coalesce("papers", F.lit(0)) <= 0)
    live = runs.where(~dead).select("minute").distinct()
    return runs.where(dead).join(live, "minute", "left_anti")


def catalogue(index: DataFrame, rows: DataFrame) -> DataFrame:
    """K4, H9: the index with rows replaced by their key, the newest of each run kept."""
    return upsert(index, latest(rows, ["run_id"], [F.col("modified"), F.col("path")]), ["run_id"])


def stamp(path: Column) -> Column:
    """The time in an artefact's name."""
    return F.try_to_timestamp(F.concat(F.regexp_extract(path, STAMP, 1), F.regexp_extract(path, STAMP, 2)), F.lit("yyyyMMddHHmmss"))


def content_store(known: DataFrame, texts: DataFrame) -> DataFrame:
    """Texts whose hash is not known yet, with the hash and its short form."""
    hashed = texts.withColumn("sha256", F.sha2("content", 256)).withColumn("campaign_id", F.substring("sha256", 1, 12)).dropDuplicates(["sha256"])
    return hashed.join(known.select("sha256"), "sha256", "left_anti")


def emission_totals(rows: DataFrame) -> DataFrame:
    """Row count and sums of six measures kept as texts; a cell that is no number, and a missing column, count 0."""
    cell = lambda c: F.coalesce(F.trim(F.col(c)).try_cast("double"), F.lit(0.0)) if c in rows.columns else F.lit(0.0)
    return rows.agg(F.count(F.lit(1)).alias("row_count"), *[F.coalesce(F.sum(cell(c)), F.lit(0.0)).alias(c) for c in EMISSIONS])


def fill_run(rows: DataFrame, run: str, run_id: str | None = None, override: bool = False) -> DataFrame:
    """Columns run and run_id after project_name (else last), filled where blank, or everywhere."""
    old = rows.columns
    at = old.index("project_name") + 1 if "project_name" in old else len(old)
    names = old if "run" in old else [*old[:at], "run", *old[at:]]
    if "run_id" not in names:
        names = [*names[: names.index("run") + 1], "run_id", *names[names.index("run") + 1 :]]
    for name, value in (("run", run), ("run_id", run_id)):
        now = F.coalesce(F.col(name), F.lit("")) if name in old else F.lit("")
        rows = rows.withColumn(name, F.when(F.lit(override) | (now == ""), F.lit(value or "")).otherwise(now) if value else now)
    return rows.select(*names)


def find_record(records: DataFrame, paper_id: str | None = None, input_hash: str | None = None) -> DataFrame:
    """Rows (paper_id, input_sha256) of an id, with or without #, or of an input's hash; a filter that the scan gets."""
    same_id = F.lit(False) if not paper_id else F.col("paper_id").isin(sorted({paper_id.strip(), paper_id.strip().lstrip("#"), "#" + paper_id.strip().lstrip("#")}))
    same_hash = F.lit(False) if not input_hash else F.lower(F.trim("input_sha256")) == input_hash.strip().lower()
    return records.where(F.coalesce(same_id, F.lit(False)) | F.coalesce(same_hash, F.lit(False)))


def quality_split(chunks: DataFrame, low: Column, always: list[str] = ("title",)) -> tuple[DataFrame, DataFrame]:
    """F8: kept chunks and the pool of dropped ones; kinds that are always included stay whatever their quality."""
    drop = F.coalesce(low, F.lit(False)) & ~F.coalesce(F.col("kind").isin(*always), F.lit(False))
    return chunks.where(~drop), chunks.where(drop)
