"""Terms, gates and caps that turn scored passages into examples.

Operators: F10 F23 F24 W11 W12 U5 R18 R25 H40.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import CITATION, hits, is_boilerplate, readability, words


def gates(text: Column, least_words: int = 40, most_words: int = 220) -> Column:
    """the first reason to reject a passage, in a fixed order; null for one that stays."""
    m = readability(text)
    return (
        F.when(F.trim(F.coalesce(text, F.lit(""))) == "", "empty")
        .when(m["word_count"] < least_words, "too_short").when(m["word_count"] > most_words, "too_long")
        .when(is_boilerplate(text), "boilerplate").when(hits(text, CITATION) >= 4, "reference_like")
        .when(hits(F.lower(text), "et al") >= 3, "reference_like").when(m["alnum_ratio"] < 0.6, "noisy").when(m["unique_alpha_word_count"] < 10, "repetitive")
    )


def capped(df: DataFrame, source: str, order: list[Column], cap: int, total: int) -> DataFrame:
    """At most cap rows of each source; if these are fewer than total, the best of the rest fill up.

    Each source's first ``total`` rows are all that can be chosen, so Spark prunes to them before any row moves.
    """
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(source).orderBy(*order))).where(F.col("__rank") <= total)
    return ranked.withColumn("__late", F.col("__rank") > cap).orderBy("__late", *order).limit(total).drop("__rank", "__late")


def best_per_section(df: DataFrame, paper: str, section: str, order: list[Column]) -> DataFrame:
    """The first row of each section of each paper."""
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(paper, section).orderBy(*order))).where("__rank = 1").drop("__rank")


def cue_terms(monitoring: list[str], action: list[str], positive: list[str]) -> list[str]:
    """Monitoring terms that are neither actions nor positive terms, in order."""
    other = {t.lower() for t in [*action, *positive]}
    return list(dict.fromkeys(t for t in monitoring if t.lower() not in other))


def monitoring_only(text: Column, topic: str, monitoring: str, action: str) -> Column:
    """a passage on the topic that only observes."""
    return text.rlike(topic) & text.rlike(monitoring) & ~text.rlike(action)


def term_score(text: Column, positive: dict[str, float], negative: dict[str, float], section_bonus: Column, page: Column) -> Column:
    """Weighted term hits, a bonus of the section, less late pages, with length."""
    tokens = words(F.lower(text))
    count = lambda t: F.size(F.filter(tokens, lambda w: w == t))
    worth = lambda terms: sum((count(t) * F.lit(v) for t, v in terms.items()), F.lit(0.0))
    return worth(positive) - worth(negative) + section_bonus - F.when(page > 10, 0.5).otherwise(0.0) + F.least(F.size(tokens) / 200.0, F.lit(1.0))


def page_tag(first: Column, last: Column) -> Column:
    """H40."""
    return F.when(first.isNull(), "pNA").when(last.isNull() | (last == first), F.concat(F.lit("p"), first.cast("string"))).otherwise(F.concat(F.lit("p"), first.cast("string"), F.lit("-"), last.cast("string")))
