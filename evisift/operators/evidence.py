"""Evidence lines, hints and windows, all within each document's row.

Operators: P46 J20 W10 W15 T11 R13 R15 R23 H34 H60.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import words

# Fixed values.
WINDOW_WORDS, WINDOW_STEP, MOST_TERMS = 140, 35, 24


def term_list(raw: str, least: int = 3, most: int = 120) -> list[str]:
    """Terms of a rule, split at semicolons or else commas."""
    parts = raw.split(";") if ";" in raw else raw.split(",")
    return [p.strip() for p in parts if least <= len(p.strip()) <= most]


def term_pattern(terms: list[str], whole_words: bool = False) -> str:
    """One alternation, longest term first; within words too unless asked otherwise."""
    body = "|".join(re.escape(t) for t in sorted(dict.fromkeys(terms), key=lambda t: (-len(t), t))[:MOST_TERMS])
    return f"(?i)\\b(?:{body})\\b" if whole_words else f"(?i)(?:{body})"


def snippet(text: Column, pattern: str, most: int = 160) -> Column:
    """A window around the first match, with dots where it is cut."""
    at = F.regexp_instr(text, F.lit(pattern))
    start = F.greatest(F.lit(1), at - most // 2)
    cut = F.substring(text, start, F.lit(most))
    return F.when(at > 0, F.concat(F.when(start > 1, "...").otherwise(""), cut, F.when(start + most <= F.length(text), "...").otherwise("")))


def context_lines(text: Column, pattern: str, before: int = 1, after: int = 2) -> Column:
    """Lines around each matching line."""
    lines = F.split(text, "\n")
    hit = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(pattern), i)), lambda i: i.isNotNull())
    return F.transform(hit, lambda i: F.array_join(F.slice(lines, F.greatest(i - before, F.lit(0)) + 1, F.least(i, F.lit(before)) + 1 + after), "\n"))


def hints(text: Column, terms: list[str], n: int) -> Column:
    """The n best lines by distinct terms and digits; structs score, line_no, line."""
    lines = F.split(text, "\n")
    count = lambda x: sum((F.contains(F.lower(x), F.lit(t.lower())).cast("int") for t in terms), F.lit(0))
    scored = F.transform(lines, lambda x, i: F.struct((-(count(x) + x.rlike("[0-9]").cast("int"))).alias("score"), (i + 1).alias("line_no"), x.alias("line"), count(x).alias("terms")))
    best = F.slice(F.array_sort(F.filter(scored, lambda s: s["terms"] > 0)), 1, n)
    return F.transform(best, lambda s: F.struct((-s["score"]).alias("score"), s["line_no"].cast("long").alias("line_no"), s["line"].alias("line")))


def best_window(text: Column, terms: list[str], size: int = WINDOW_WORDS, step: int = WINDOW_STEP) -> Column:
    """Start and score of the word window with most term hits, the first of equals."""
    tokens = words(F.lower(text))
    starts = F.sequence(F.lit(0), F.greatest(F.size(tokens) - 1, F.lit(0)), F.lit(max(12, step)))
    score = lambda i: F.size(F.filter(F.slice(tokens, i + 1, size), lambda w: w.isin([t.lower() for t in terms])))
    return F.array_max(F.transform(starts, lambda i: F.struct(score(i).alias("score"), (-i).alias("start"))))


def labelled_counts(text: Column) -> Column:
    """Numbers given as a sample size."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(?i)\bn\s*=\s*([0-9]+)"), F.lit(1)), lambda x: x.cast("int"))


def quoted_context(chunks: Column, quote: Column) -> Column:
    """The first chunk that holds the quote's first 120 characters, else the first two."""
    found = F.filter(chunks, lambda c: F.contains(c, F.substring(quote, 1, 120)))
    return F.when(F.size(found) > 0, F.slice(found, 1, 1)).otherwise(F.slice(chunks, 1, 2))


def chunk_label(chunk_id: Column, section: Column, page: Column, line: Column) -> Column:
    """H34."""
    part = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"{name}="), c.cast("string")))
    return F.concat_ws(" | ", chunk_id, part("section", section), part("page", page), part("line", line))
