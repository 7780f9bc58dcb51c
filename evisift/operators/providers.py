"""Calls of a model service: batches, retries, a cache by text.  The service itself is a parameter; none is built in.

Operators: S22 S23 R9 R21 H61 H82 H95 H97.  Each task opens its own service and sends fixed batches, so
memory is bounded by a batch; a task that is lost is sent again, so a service should not mind a repeated request.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH, TRIES = 32, 2

Service = Callable[[list[str]], list]


def attempt(service: Service, texts: list[str], tries: int = TRIES, wait: float = 0.5) -> tuple[list, str | None]:
    """Answers and no error, or no answers and the last error after so many tries, with waits that double."""
    for k in range(tries):
        try:
            found = list(service(texts))
            if len(found) != len(texts):
                raise ValueError(f"{len(found)} answers to {len(texts)} texts")
            return found, None
        except Exception as e:  # a service may raise anything: its error becomes a row, not a lost job
            error = f"{type(e).__name__}: {e}"
            if k + 1 < tries:
                time.sleep(wait * 2**k)
    return [None] * len(texts), error


def call(df: DataFrame, key: str, text: str, open_service: Callable[[], Service], answer: str = "string", batch: int = BATCH, tries: int = TRIES) -> DataFrame:
    """Key, answer (of the given type) and error of each row; a batch that fails goes again text by text, so
    one bad text costs only its own answer.  A null text is sent as an empty one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        service = open_service()
        for f in frames:
            for at in range(0, len(f), batch):
                part = f.iloc[at : at + batch]
                sent = ["" if t is None else t for t in part["__text"]]
                found, error = attempt(service, sent, tries)
                each = [(a, None) for a in found] if error is None else [(a[0], e) for a, e in (attempt(service, [t], tries) for t in sent)] if len(sent) > 1 else [(None, error)]
                yield pd.DataFrame({"key": part["__key"].to_numpy(), "answer": [a for a, _ in each], "error": [e for _, e in each]})

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("__key"), F.col(text).alias("__text")).mapInPandas(run, f"key {kind}, answer {answer}, error string").withColumnRenamed("key", key)


def embed(df: DataFrame, text: str, cache: DataFrame, open_service: Callable[[], Service]) -> tuple[DataFrame, DataFrame]:
    """Rows with their text's vector, and the new cache (text_sha256, vector); each distinct text that the cache
    lacks is sent once.  Texts whose request failed have no vector and stay out of the cache."""
    rows = df.withColumn("text_sha256", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    missing = rows.select("text_sha256", F.col(text).alias("__t")).dropDuplicates(["text_sha256"]).join(cache.select("text_sha256"), "text_sha256", "left_anti")
    found = call(missing, "text_sha256", "__t", open_service, "array<double>").where("error is null").select("text_sha256", F.col("answer").alias("vector"))
    known = cache.select("text_sha256", "vector").unionByName(found)
    return rows.join(known, "text_sha256", "left"), known


def merged_domains(answers: DataFrame, key: str, defaults: dict[str, str]) -> DataFrame:
    """Per key the answers (columns domain, payload, error) of all domains over their defaults, as JSON texts,
    and a map of errors.  A domain is one of few configured names, so a key's row is bounded."""
    payload = lambda d, default: F.coalesce(F.max(F.when((F.col("domain") == d) & F.col("error").isNull(), F.col("payload"))), F.lit(default)).alias(d)
    errors = F.map_from_entries(F.array_sort(F.collect_set(F.when(F.col("error").isNotNull(), F.struct("domain", "error")))))
    return answers.groupBy(key).agg(*[payload(d, v) for d, v in defaults.items()], errors.alias("errors"))


def parsed(answer: Column, schema: str) -> Column:
    """Struct of the answer's first JSON object read by a schema, the raw text and an error; unread answers keep their text."""
    body = F.regexp_extract(answer, r"(?s)(\{.*\})", 1)
    value = F.from_json(body, schema, {"mode": "PERMISSIVE"})
    bad = (body == "") | F.try_parse_json(body).isNull()
    return F.struct(F.when(~bad, value).alias("value"), answer.alias("raw"), F.when(answer.isNull(), "no_answer").when(bad, "not_json").alias("error"))
