"""The subpackage's registered queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .decontamination import op7_decontamination
from .embedding_dedup import op10_embedding_near_dedup
from .hilbert_sharding import op9_hilbert_sharding
from .ngram_join import op2_ngram_jaccard_join
from .pii import op3_pii_feistel
from .secret_scans import op1_secret_scans
from .sentencepieces import op5_sentencepiece
from .substring_dedup import op8_substring_dedup
from .toxicity import op4_toxicity
from .url_filters import ORACLE_SQL as URL_FILTERS_SQL
from .url_filters import op6_url_filters


def _on(operator, *tables: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables))

    query.__doc__ = operator.__doc__
    return query


def pii_key(spark: SparkSession) -> str:
    """The session's ``evisift.pii.key``; a throw-away key for the query's own test tables only where that is unset."""
    return spark.conf.get("evisift.pii.key", None) or "key of the registered query"


def _pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_pii_feistel(spark.read.parquet(f"{sf_dir}/documents.parquet"), pii_key(spark))


_pii.__doc__ = op3_pii_feistel.__doc__

QUERIES = {
    "op1_secret_scans": _on(op1_secret_scans, "documents"),
    "op2_ngram_jaccard_join": _on(op2_ngram_jaccard_join, "documents"),
    "op3_pii_feistel": _pii,
    "op4_toxicity": _on(op4_toxicity, "documents", "labels"),
    "op5_sentencepiece": _on(op5_sentencepiece, "documents"),
    "op6_url_filters": _on(op6_url_filters, "pages"),
    "op7_decontamination": _on(op7_decontamination, "documents", "benchmark"),
    "op8_substring_dedup": _on(op8_substring_dedup, "documents"),
    "op9_hilbert_sharding": _on(op9_hilbert_sharding, "documents"),
    "op10_embedding_near_dedup": _on(op10_embedding_near_dedup, "embeddings"),
}
ORACLE_SQL = {"op6_url_filters": URL_FILTERS_SQL}
