"""Sources and sinks of citation exports, labelled examples, JSON lines and run artefacts.

Operators: S1 S2 S4 S5 S6 S7 S8 S10 S11 K1 K7 K8 K10 K15 P1 P2 P3 P4 P6 H2.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import year
from ..functions.values import MISSING

# Canonical fields and the headers that each may come under.
ALIASES = {
    "paper_id": ["Covidence #", "ID", "Ref", "paper_id"],
    "title": ["Title"], "abstract": ["Abstract"], "authors": ["Authors", "Author"], "year": ["Published Year", "Year"],
    "month": ["Published Month"], "journal": ["Journal"], "volume": ["Volume"], "issue": ["Issue"], "pages": ["Pages"],
    "accession": ["Accession Number"], "doi": ["DOI"], "ref": ["Ref"], "study": ["Study"], "notes": ["Notes"], "tags": ["Tags"],
}


def header_key(name: str) -> str:
    return re.sub("[^a-z0-9]", "", name.lower())


def alias(columns: list[str], key: str, aliases: dict[str, list[str]] = ALIASES) -> Column:
    """Per row, the first non-blank cell among a field's headers: exact names first, then normal forms."""
    wanted = [*aliases.get(key, []), key]
    names = [c for a in wanted for c in columns if c == a]
    names += [c for a in wanted for c in columns if header_key(c) == header_key(a) and c not in names]
    cells = [F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) for c in dict.fromkeys(names)]
    return F.coalesce(*cells, F.lit("")) if cells else F.lit("")


def read_text_csv(spark: SparkSession, paths: str | list[str], sep: str = ",") -> DataFrame:
    """Every cell a string, blank cells '', a byte order mark and blanks around headers dropped (H2)."""
    df = spark.read.option("header", True).option("inferSchema", False).option("multiLine", True).option("escape", '"').option("sep", sep).option("emptyValue", "").csv(paths)
    df = df.withColumn("__file", F.col("_metadata.file_path")).withColumn("__modified", F.col("_metadata.file_modification_time"))
    return df.toDF(*[c.lstrip("﻿").strip() for c in df.columns]).fillna("")


def canonical(raw: DataFrame) -> DataFrame:
    """The canonical columns with flags; rows without title and abstract go."""
    kept = [c for c in raw.columns if not c.startswith("__")]
    out = raw.select(*[alias(kept, k).alias(k) for k in ALIASES], F.concat_ws(" ", *[F.col(f"`{c}`") for c in kept]).alias("__any"))
    blank = lambda c: F.when(F.lower(F.trim(c)).isin(MISSING), "").otherwise(c)
    out = out.withColumn("abstract", blank(F.col("abstract"))).withColumn("doi", blank(F.col("doi")))
    out = out.withColumn("year", F.when(year(F.col("year")) != "", year(F.col("year"))).otherwise(year(F.col("__any"))))
    flags = {f"citation_ingestion_missing_{c}": F.col(c) == "" for c in ("title", "abstract", "doi")}
    return out.withColumns(flags).where("title != '' or abstract != ''").drop("__any")


def newest(df: DataFrame) -> DataFrame:
    """The rows of the file that was modified last, of equal times the last name."""
    last = df.agg(F.max(F.struct("__modified", "__file")).alias("last")).select("last.__file")
    return df.join(F.broadcast(last), "__file", "left_semi")  # one row


def read_json_lines(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Data rows; blank and corrupt lines and ``meta`` rows are left out."""
    full = f"{schema}, meta string, _corrupt_record string"
    df = spark.read.schema(full).option("mode", "PERMISSIVE").json(paths)
    return df.where("meta is null and _corrupt_record is null").drop("meta", "_corrupt_record")


def labelled_examples(raw: DataFrame) -> DataFrame:
    """Label POS or NEG and text, under any of their names."""
    kept = [c for c in raw.columns if not c.startswith("__")]
    text = alias(kept, "text", {"text": ["text", "sentence", "content"]})
    label = F.upper(alias(kept, "label", {"label": ["label", "class"]}))
    return raw.select(label.alias("label"), text.alias("text")).where("label in ('POS', 'NEG') and text != ''")


def with_harvested(examples: DataFrame, excluded: DataFrame) -> DataFrame:
    """Negative examples from excluded records, abstract or else title, unless the text is there already."""
    key = F.lower(F.trim(F.regexp_replace("text", r"\s+", " ")))
    more = excluded.select(F.lit("NEG").alias("label"), F.coalesce(F.nullif("abstract", F.lit("")), "title").alias("text")).where("text != ''").withColumn("k", key).dropDuplicates(["k"])
    return examples.unionByName(more.join(examples.select(key.alias("k")), "k", "left_anti").drop("k"))


def write_by_decision(records: DataFrame, path: str) -> None:
    """K1: one folder a decision; records without one are kept apart, not lost."""
    decided = F.when(F.col("is_eligible").isNull(), "undecided").when(F.col("is_eligible"), "include").otherwise("exclude")
    records.withColumn("decision", decided).write.mode("overwrite").partitionBy("decision").json(path)


def append_log(rows: DataFrame, path: str) -> None:
    """K7."""
    rows.write.mode("append").json(path)


def write_text_csv(rows: DataFrame, path: str) -> None:
    """Strings, booleans in lower case, one header."""
    flat = rows.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in rows.columns])
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
