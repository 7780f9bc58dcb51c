"""Ids, scores, options and records that runs keep: subset checks, appended samples, totals, sidecars, serialised results.

Operators: K5 K9 K14 P25 P40 J3 J5 J8 M8 H1 H8 H10 H11 H14 H18 H21 H29 H32 H35 H46 H49 H77 H86 H94.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, udfs
from .bootstrap import first_surname
from .extraction import to_wide
from .relational import latest, upsert

# Fixed values.
SCORE_YES = ["1", "true", "yes", "y", "correct", "match", "stimmt"]
SCORE_NO = ["0", "false", "no", "n", "incorrect", "mismatch", "stimmt nicht"]
TYPE_SYNONYMS = {
    "enum": "enum", "categorical": "enum", "category": "enum", "boolean": "boolean", "bool": "boolean", "list": "list", "array": "list", "list_str": "list", "list[string]": "list",
    "string": "string", "str": "string", "text": "string", "integer": "integer", "int": "integer", "float": "float", "number": "float",
}
DASHES, SINGLE_QUOTES, DOUBLE_QUOTES = "‐‑‒–—―−⁃", "‘’‚‛", "“”„‟"
TOKEN_FIELDS = ["prompt_tokens", "response_tokens", "embedding_tokens", "pdf_text_tokens", "pdf_visual_tokens"]


def validation_text(x: Column) -> Column:
    """P25: lower case with plain dashes and quotes, punctuation as blanks; accents are folded as far as two-letter forms go."""
    t = F.translate(F.coalesce(x, F.lit("")), " " + DASHES + "∕⁄" + SINGLE_QUOTES + DOUBLE_QUOTES, " " + "-" * len(DASHES) + "//" + "'" * len(SINGLE_QUOTES) + '"' * len(DOUBLE_QUOTES))
    t = F.translate(F.lower(t), "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ_", "aaaaaaceeeeiiiinooooouuuuyy ")
    t = F.regexp_replace(F.regexp_replace(t, r"[^\x00-\x7F]", ""), r"[\[\]{}'\"`|;:,()/<>]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, "[^a-z0-9.+%_-]+", " "), " +", " "))


def _once(parts: Column) -> Column:
    """Parts without blanks around them, the first of those that differ in case only."""
    kept = F.filter(F.transform(parts, text.strip), lambda p: p != "")
    low = F.transform(kept, F.lower)
    return F.filter(kept, lambda p, i: F.array_position(low, F.lower(p)) == i + 1)


def options(x: Column) -> Column:
    """Allowed options, split at | ; and ,."""
    return _once(F.split(F.coalesce(x, F.lit("")), "[|;,]"))


def anchors(x: Column) -> Column:
    """Semantic anchors, split at line ends and ||."""
    return _once(F.split(F.regexp_replace(F.coalesce(x, F.lit("")), "\r\n?", "\n"), r"\n|\|\|"))


def cell_score(x: Column) -> Column:
    """M8: whether a reviewer scored a cell as right; null for anything else."""
    t = F.lower(F.trim(x))
    return F.when(t.isin(SCORE_YES), True).when(t.isin(SCORE_NO), False)


def type_name(x: Column) -> Column:
    """One of six types; null for a name that is none."""
    t = F.translate(F.lower(F.trim(F.coalesce(x, F.lit("")))), " -", "__")
    return F.coalesce(*[F.when(t == k, v) for k, v in TYPE_SYNONYMS.items()])


def id_column(columns: list[str], aliases: list[str]) -> str:
    """H1: the first alias that is a column; raises if none is."""
    found = next((c for a in aliases for c in columns if c == a), None)
    if found is None:
        raise KeyError(f"none of {aliases} is a column")
    return found


def sheet_ids(sheet: DataFrame, aliases: list[str]) -> DataFrame:
    """Distinct ids of a sheet, without # and .0, blank ones left out."""
    return sheet.select(text.paper_id(F.col(f"`{id_column(sheet.columns, aliases)}`").cast("string")).alias("paper_id")).where("paper_id != ''").distinct()


def relaxed_bool(x: Column) -> Column:
    """H46."""
    return F.coalesce(F.lower(F.trim(x)).isin("1", "true", "yes", "y"), F.lit(False))


def bare_id(x: Column) -> Column:
    """An id without # before it."""
    return F.regexp_replace(F.trim(F.coalesce(x, F.lit(""))), "^#+", "")


def scoped(rows: DataFrame, ids: DataFrame, key: str = "paper_id") -> DataFrame:
    """The rows of a sample's ids; all rows where none of them is in it.

    Whether one is, is a scalar of the plan, so the rows are filtered without asking first.
    """
    marked = rows.join(ids.select(key).distinct().withColumn("__in", F.lit(True)), key, "left")
    some = marked.where("__in").limit(1).agg(F.count(F.lit(1)).alias("n"))
    return marked.where(F.col("__in") | (some.scalar() == 0)).drop("__in")


def appended(base: DataFrame, more: DataFrame, key: str = "paper_id") -> DataFrame:
    """One row of each id of base, and of more those whose id base lacks; blank ids are all kept."""
    first = lambda df: df.where(F.coalesce(F.col(key), F.lit("")) == "").unionByName(df.where(F.col(key) != "").dropDuplicates([key]))
    fresh = more.join(base.where(F.col(key) != "").select(key).distinct(), key, "left_anti")
    return first(base).unionByName(first(fresh))


def append_summary(records: DataFrame, total: int) -> DataFrame:
    """The summary of appended records: how many, and their share of the stage."""
    return records.agg(F.count(F.lit(1)).alias("paper_count")).withColumn("percent_of_stage", F.when(F.lit(total) > 0, F.round(F.col("paper_count") * 100.0 / F.lit(total), 6)))


def missing_ids(sample: DataFrame, results: DataFrame, key: str = "paper_id") -> DataFrame:
    """Ids of a sample without a result; a subset if there is none."""
    return sample.select(key).distinct().join(results.select(key).distinct(), key, "left_anti")


def result_ids(results: DataFrame, payload: str, key: str = "paper_id") -> DataFrame:
    """Ids with a result that is not empty."""
    return results.where(F.coalesce(F.trim(payload), F.lit("")) != "").select(key).distinct()


def last_total(log: DataFrame, order: str) -> DataFrame:
    """The last row whose id is TOTAL."""
    return latest(log.where("paper_id = 'TOTAL'"), ["paper_id"], [F.col(order)])


def free_name(taken: list[str], stem: str, suffix: str) -> str:
    """Stem and suffix, with the first number that makes them a name not taken."""
    known, n, name = set(taken), 0, stem + suffix
    while name in known:
        n += 1
        name = f"{stem}_{n}{suffix}"
    return name


def sample_size(sample: DataFrame, key: str = "paper_id") -> DataFrame:
    """H21."""
    return sample.where(F.coalesce(F.trim(key), F.lit("")) != "").agg(F.count(F.lit(1)).alias("n"))


def keyed(audit: DataFrame, key: list[str], order: str) -> DataFrame:
    """The last row of each key, for joins instead of an index in memory."""
    return latest(audit, key, [F.col(order)])


def link_features(records: DataFrame) -> DataFrame:
    """target_id, author, year, title of records paper_id, authors, year, title, as J16 reads them."""
    return records.select(F.col("paper_id").alias("target_id"), first_surname(F.col("authors")).alias("author"), text.year(F.col("year")).alias("year"), F.trim(F.regexp_replace(F.lower("title"), "[^a-z0-9]+", " ")).alias("title"))


def gold_frame(cells: DataFrame, names: list[str]) -> DataFrame:
    """H8: one row a paper with a column a variable, of gold cells paper_id, variable, value, evaluable."""
    return to_wide(cells.where("evaluable"), "paper_id", "variable", "value", names)


def sanitised(decision: Column, authors: Column) -> Column:
    """A model's answer without the authors' names."""
    return udfs.redact_authors(F.coalesce(decision, F.lit("")), F.coalesce(authors, F.lit("")))


def resource_row(fields: dict[str, Column]) -> list[Column]:
    """The five token counts of a paper, blank as 0, and their sum."""
    counts = [F.coalesce(fields[f].cast("long") if f in fields else F.lit(None), F.lit(0)).cast("long") for f in TOKEN_FIELDS]
    return [*[c.alias(f) for c, f in zip(counts, TOKEN_FIELDS, strict=True)], sum(counts[1:], counts[0]).alias("tokens_total")]


def result_record(cells: Column) -> Column:
    """A map of a paper's flat values as JSON, names in order, null values as blanks."""
    entries = F.array_sort(F.map_entries(cells))
    return F.to_json(F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], F.coalesce(e["value"], F.lit(""))))))


def merged_sidecars(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """What a run adds to or replaces of its chunk and artefact records."""
    return upsert(old, new, key)


def alignment_report(cells: DataFrame) -> DataFrame:
    """K9: the lines of a validation report over tp, tn, fp, fn, one row each: line_no, line."""
    n = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    share = lambda a, b: F.when(b > 0, F.format_string("%.4f", a / b)).otherwise("n/a")
    lines = {"n": n.cast("string"), "observed_agreement": share(F.col("tp") + F.col("tn"), n), "sensitivity": share(F.col("tp"), F.col("tp") + F.col("fn")), "specificity": share(F.col("tn"), F.col("tn") + F.col("fp"))}
    return cells.select(F.posexplode(F.array(*[F.concat(F.lit(f"{k}: "), v) for k, v in lines.items()])).alias("line_no", "line"))
