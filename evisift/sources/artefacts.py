"""Artefacts of runs found by name and age, page texts, caches by content, review sheets and prompt templates.

Operators: S12 S13 S14 S16 S17 S18 S20 A24 M18 H3 H4 H43 H45 H56 H57 H58 H69 H74 H85 H87 H89 H99.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values.
DELIMITERS = [",", ";", "\t"]
LEAST_PAGE, LEAST_RATIO, SUPPLEMENTS, SUPPLEMENT_WORDS = 80, 0.80, 8, 4000
CRITERIA = "{eligibility_criteria}"


def first_candidate(files: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Per key the file (columns name, modified) that comes first in ``names``, where {id} stands
    for the key; of equal places the newest, then the smallest name.  Keys without any of them give no row."""
    place = F.coalesce(*[F.when(F.col("name") == F.replace(F.lit(n), F.lit("{id}"), F.col(key).cast("string")), k) for k, n in enumerate(names)])
    best = F.min_by(F.struct("name", "modified"), F.struct("place", (-F.unix_micros(F.col("modified"))).alias("age"), "name"))
    return files.withColumn("place", place).where("place is not null").groupBy(key).agg(best.alias("b")).select(key, "b.name", "b.modified")


def page_text(primary: Column, fallback: Column) -> Column:
    """The primary extractor's page unless it is blank, or short and the other's longer."""
    a, b = F.trim(F.coalesce(primary, F.lit(""))), F.trim(F.coalesce(fallback, F.lit("")))
    return F.when((F.length(a) < LEAST_PAGE) & (F.length(b) > F.length(a)), b).otherwise(a)


def reuse(current: DataFrame, cache: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """What the cache has under equal keys (path, size, time), and what must be parsed again."""
    known = cache.dropDuplicates(keys)
    return current.join(known, keys), current.join(known.select(*keys), keys, "left_anti")


def absent_only(wanted: DataFrame, there: DataFrame, keys: list[str]) -> DataFrame:
    """Artefacts to copy, those that are not there yet."""
    return wanted.join(there.select(*keys).distinct(), keys, "left_anti")


def length_guard(normalised: Column, direct: Column) -> Column:
    """Whether a stored text is long enough beside one parsed afresh; true where there is nothing to compare."""
    share = F.length(F.trim(normalised)) / F.nullif(F.length(F.trim(direct)), F.lit(0))
    return F.coalesce(share >= LEAST_RATIO, F.lit(True))


def supplements(files: DataFrame, key: str) -> DataFrame:
    """Per key one block of its first files by name (columns name, text), each shortened.

    Only struct(name, text) of a key's first files are kept while aggregating: a window prunes the rest per task."""
    from pyspark.sql import Window

    words = F.filter(F.split(F.trim("text"), r"\s+"), lambda w: w != "")
    rank = F.row_number().over(Window.partitionBy(key).orderBy("name"))
    first = files.where("trim(text) != ''").withColumn("__n", rank).where(F.col("__n") <= SUPPLEMENTS)
    part = F.concat(F.lit("[Supplemental Source: "), F.col("name"), F.lit("]\n"), F.array_join(F.slice(words, 1, SUPPLEMENT_WORDS), " "))
    gathered = first.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("__n", part.alias("part")))).alias("parts"))
    return gathered.select(key, F.concat(F.lit("[Supplemental Cited Evidence]\n\n"), F.array_join("parts.part", "\n\n")).alias("block"))


def delimiter(sample: str) -> str:
    """Of comma, semicolon and tab the one that splits a sheet's first lines most evenly; a semicolon if none does."""
    lines = [x for x in sample.splitlines() if x.strip()][:20]
    counts = {d: [x.count(d) for x in lines] for d in DELIMITERS}
    even = {d: (min(c) == max(c), min(c)) for d, c in counts.items() if c and min(c) > 0}
    return max(even, key=lambda d: even[d]) if even else ";"


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A review sheet with every cell a string; its first line tells the delimiter."""
    head = "\n".join(r.value for r in spark.read.text(path).limit(20).collect())
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("sep", delimiter(head)).csv(path).fillna("")


def with_alias_columns(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """A schema column that is missing is a copy of its first alias that is there."""
    found = {c: next(a for a in names if a in df.columns) for c, names in aliases.items() if c not in df.columns and set(names) & set(df.columns)}
    return reduce(lambda d, c: d.withColumn(c, F.col(found[c])), found, df)


def prompt_template(spark: SparkSession, path: str, criteria: str = "") -> str:
    """A prompt's text, its placeholder replaced by the criteria (by nothing without them)."""
    rows = spark.read.text(path, wholetext=True).limit(1).collect()
    return rows[0].value.replace(CRITERIA, criteria).strip() if rows else ""


def newest_by_stamp(files: DataFrame, stamp: str | None = None) -> DataFrame:
    """The file (name, modified, stamp) of a stamp if there is one, else the newest, else none."""
    exact = (F.col("stamp") == F.lit(stamp)) if stamp else F.lit(False)
    order = F.struct(F.coalesce(exact, F.lit(False)).alias("exact"), F.col("modified"), F.col("name"))
    return files.agg(F.max_by(F.struct("name", "modified", "stamp"), order).alias("b")).where("b is not null").select("b.*")


def with_metadata(rows: DataFrame, metadata: DataFrame, key: str) -> DataFrame:
    """Left join on the normal form of an id: no leading #, no trailing .0 (metadata with one row an id)."""
    plain = lambda c: F.regexp_replace(F.regexp_replace(F.trim(c.cast("string")), "^#+", ""), r"\.0$", "")
    right = metadata.withColumn("__id", plain(F.col(key))).drop(key)
    return rows.withColumn("__id", plain(F.col(key))).join(right, "__id", "left").drop("__id")


def count_records(spark: SparkSession, paths: list[str]) -> int:
    """Data lines of JSON-lines files, each file once; blank lines and ``meta`` lines do not count."""
    once = list(dict.fromkeys(paths))
    return spark.read.text(once).where("trim(value) != '' and not contains(value, '\"meta\":')").count() if once else 0
