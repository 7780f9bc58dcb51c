"""Extraction schemas, typed values, nested, long and wide form.

Operators: S9 P36 P38 J14 A5 M11 M14 R11 R12 R20.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import TYPE_NAMES, change_type, is_missing

_SPARK = {"integer": T.LongType(), "float": T.DoubleType(), "boolean": T.BooleanType(), "list": T.ArrayType(T.StringType()), "enum": T.StringType(), "string": T.StringType()}


def compile_schema(variables: list[dict[str, str]]) -> T.StructType:
    """Nested type of a variable list: per domain, <variable>_value of its type and <variable>_quote."""
    domains: dict[str, list[T.StructField]] = {}
    seen = set()
    for v in variables:
        key = (v["domain"].strip(), v["variable_name"].strip())
        kind = TYPE_NAMES.get(v["variable_type"].strip().lower())
        if key in seen or not all(key) or kind is None or kind == "enum" and not v.get("allowed_options", "").strip() or not v.get("instruction", "").strip():
            raise ValueError(f"bad variable {key}")
        seen.add(key)
        domains.setdefault(key[0], []).extend([T.StructField(f"{key[1]}_value", _SPARK[kind]), T.StructField(f"{key[1]}_quote", T.StringType())])
    return T.StructType([T.StructField(d, T.StructType(f)) for d, f in domains.items()])


def coerce(value: Column, kind: str, options: list[str] | None = None) -> Column:
    """Typed value of a text, null where it is missing or does not fit."""
    v = F.when(~is_missing(value), F.trim(value))
    if kind == "integer":
        return v.try_cast("double").try_cast("bigint")
    if kind == "float":
        return v.try_cast("double")
    if kind == "boolean":
        return F.coalesce(F.lower(v).isin("true", "yes", "1"), F.lit(False))
    if kind == "list":
        return F.filter(F.transform(F.split(v, r"[;,|\n]"), lambda v: F.trim(v)), lambda x: x != "")
    if kind == "enum":
        return F.coalesce(*[F.when(F.lower(v) == o.lower(), F.lit(o)) for o in options or [""]])
    return v


def flatten(struct: T.StructType, column: str) -> list[Column]:
    """Every leaf of a nested result as <domain>.<name>, lists joined by '; '."""
    out = []
    for d in struct.fields:
        for f in d.dataType.fields:
            leaf = F.col(f"{column}.`{d.name}`.`{f.name}`")
            out.append((F.array_join(leaf, "; ") if isinstance(f.dataType, T.ArrayType) else leaf.cast("string")).alias(f"{d.name}.{f.name}"))
    return out


def to_wide(long: DataFrame, key: str, name: str, value: str, names: list[str]) -> DataFrame:
    """One column per listed name; listing them spares a pass over the data."""
    return long.groupBy(key).pivot(name, names).agg(F.first(value, ignorenulls=True))


def to_long(wide: DataFrame, key: list[str], names: list[str]) -> DataFrame:
    """R12."""
    return wide.unpivot(key, names, "variable", "value")


def version_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Cells that both versions have and that differ."""
    both = old.withColumnRenamed("value", "old").join(new.withColumnRenamed("value", "new"), keys)
    return both.withColumn("change", change_type(F.col("old"), F.col("new"))).where("change not in ('same', 'both_missing')")


def concordance(cells: DataFrame, keys: list[str]) -> DataFrame:
    """A5: cells has human_present and matched; concordance over present cells, accuracy over all."""
    out = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_cells"), F.count_if("human_present").alias("n_present"), F.count_if(F.col("human_present") & F.col("matched")).alias("n_concordant"), F.count_if("matched").alias("n_matched"))
    share = lambda a, b: F.round(F.when(F.col(b) > 0, F.col(a) / F.col(b)), 6)
    return out.withColumn("concordance", share("n_concordant", "n_present")).withColumn("accuracy", share("n_matched", "n_cells"))


def rescue(primary: Column, quote: Column, second: Column, second_quote: Column) -> Column:
    """Which of two answers stands, and why."""
    no, no_q, no2, no2_q = is_missing(primary), is_missing(quote), is_missing(second), is_missing(second_quote)
    return (
        F.when(no & no2, "both_missing").when(no, "rescue_filled_missing").when(no2, "primary_only")
        .when(F.lower(primary) == F.lower(second), "same_value").when(no_q & ~no2_q, "rescue_has_quote").otherwise("primary_kept")
    )
