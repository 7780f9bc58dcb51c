"""A training-data pipeline over ``documents``: five stages, each one operator, each written and read again.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evisift.llm import decontamination, ngram_join, secret_scans, sentencepieces, toxicity
from evisift.llm.runtime import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that the classifier, fitted on the labelled rows that may be learned from, rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(toxicity.training_rows(docs, labels), Scratch(spark, "pipeline-toxicity"))
    return toxicity.score(docs.select(*COLUMNS), model).where("toxicity_score < 0.5").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one of smallest doc_id, of each group that links of similarity 0.8 or more connect."""
    return ngram_join.keep_first(docs.select(*COLUMNS), Scratch(spark, "pipeline-ngrams"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that hold an item of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.find_leaks(docs.select(*COLUMNS), benchmark, Scratch(spark, "pipeline-leaks")).where("size(items) = 0").select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret; n_chars follows where a text changes."""
    out = secret_scans.redact_secrets(docs.select(*COLUMNS).withColumn("__old", F.col("text")))
    return out.withColumn("n_chars", F.when(F.col("text") == F.col("__old"), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every text, with the byte span of each piece."""
    return sentencepieces.encode(docs.select(*COLUMNS), sentencepieces.default_model())


STAGES = [("toxicity", toxic), ("ngram_jaccard_join", near_duplicates), ("benchmark_decontamination", benchmark_leaks), ("secret_scans", secrets), ("sentencepiece", pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each keeps is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.table(docs, f"{k}-{name}")
    return docs


#: A fitted classifier and a tokenizer have no SQL: tested against a brute-force version.
ORACLE_SQL = None
