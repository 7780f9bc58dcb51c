"""Value matching and decision parsing.

Operators: P30 P31 P32 P34 F17 F19 U7 U8 M3 M4 M5 M14 R8.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
YES = ["true", "yes", "1", "include", "included", "eligible"]
NO = ["false", "no", "0", "exclude", "excluded", "ineligible"]
MISSING = ["", "na", "n/a", "not available", "none", "null", "nan"]
BORDERLINE = (0.45, 0.75)
SEED_CONFIDENCE = 0.98
STOP_WORDS = ["a", "an", "and", "as", "at", "by", "for", "from", "in", "is", "of", "on", "or", "that", "the", "this", "to", "was", "were", "with"]
TYPE_NAMES = {"int": "integer", "integer": "integer", "number": "float", "float": "float", "decimal": "float", "bool": "boolean", "boolean": "boolean", "list": "list", "array": "list", "enum": "enum", "category": "enum", "string": "string", "str": "string", "text": "string"}


def is_missing(x: Column) -> Column:
    return x.isNull() | F.lower(F.trim(x)).isin(MISSING)


def parse_bool(x: Column) -> Column:
    """P34."""
    t = F.lower(F.trim(x))
    return F.when(t.isin(YES), True).when(t.isin(NO), False)


def parse_decision(x: Column) -> Column:
    """1, 0 or null."""
    return parse_bool(x).cast("int")


def field(json: Column, *names: str) -> Column:
    """First non-blank of several keys of a JSON text; null for text that is not JSON."""
    return F.coalesce(*[F.nullif(F.trim(F.get_json_object(json, f"$.{n}")), F.lit("")) for n in names])


def eligible(json: Column, stage: Column) -> Column:
    """NEUTRAL is a yes in title_abstract only; a text that is not JSON is read by its words."""
    raw = F.upper(field(json, "is_eligible"))
    low = F.lower(json)
    text = F.when(F.contains(low, F.lit("ineligible")), False).when(F.contains(low, F.lit("eligible")), True)
    return F.when(F.get_json_object(json, "$").isNull(), text).when(raw == "NEUTRAL", F.when(stage == "title_abstract", True)).otherwise(parse_bool(raw))


def contradictions(ok: Column, flags: Column, reason: Column, allowed: list[str]) -> Column:
    """F17 over an array of flags; the names of the rules that are broken."""
    some = F.exists(flags, lambda f: f)
    return F.array_compact(F.array(
        F.when(~ok & (F.size(flags) > 0) & ~some, "is_eligible_false_without_true_exclusion_flag"),
        F.when(ok & some, "is_eligible_true_with_true_exclusion_flag"),
        F.when(reason.isNotNull() & ~reason.isin(allowed), "reason_not_in_configured_exclusion_categories"),
    ))


def violations(ok: Column, confidence: Column, justification: Column, reason: Column, seed: Column) -> Column:
    """F19."""
    return F.array_compact(F.array(
        F.when(confidence.isNull() | (confidence < 0) | (confidence > 1), "confidence_range"),
        F.when(F.coalesce(F.trim(justification), F.lit("")) == "", "justification_empty"),
        F.when(~ok & reason.isNull(), "reason_missing"),
        F.when((confidence > SEED_CONFIDENCE) & seed.isNull(), "seed_references_missing"),
    ))


def content_tokens(x: Column) -> Column:
    """M3 on ASCII text: distinct tokens of two characters and more without stop words."""
    raw = F.regexp_extract_all(F.lower(x), F.lit("([a-z0-9][a-z0-9.+%_-]*)"), F.lit(1))
    cut = F.transform(raw, lambda t: F.regexp_replace(t, "^[-_]+|[-_]+$", ""))
    return F.array_distinct(F.filter(cut, lambda t: (F.length(t) >= 2) & ~t.isin([*STOP_WORDS, "not"])))


def shares(a: Column, b: Column, both: Column) -> tuple[Column, Column]:
    """U7, U8 of the sizes of two sets and of what they share, which is then worked out once."""
    least, union = F.least(a, b), a + b - both
    return F.when(least > 0, both / least).otherwise(0.0), F.when(union > 0, both / union).otherwise(0.0)


def overlap(a: Column, b: Column) -> Column:
    """U7."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(0.0)


def jaccard(a: Column, b: Column) -> Column:
    """U8."""
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).otherwise(0.0)


def numbers(x: Column) -> Column:
    return F.transform(F.regexp_extract_all(x, F.lit(r"([0-9]+(?:\.[0-9]+)?)"), F.lit(1)), lambda v: v.cast("double"))


def numbers_overlap(human: Column, ai: Column, tolerance: float = 0.05) -> Column:
    """M4."""
    return F.exists(numbers(human), lambda h: F.exists(numbers(ai), lambda a: F.abs(h - a) <= F.greatest(F.lit(0.5), F.abs(h) * tolerance)))


def factual_match(human: Column, ai: Column, free: float = 0.42, short: float = 0.50) -> Column:
    """M5 for free text: token overlap, or numbers and a little less of it."""
    a, b = content_tokens(human), content_tokens(ai)
    least, share = F.least(F.size(a), F.size(b)), overlap(a, b)
    limit = F.when(least <= 4, short).otherwise(free)
    return (least >= 2) & ((share >= limit) | (numbers_overlap(human, ai) & (share >= F.greatest(F.lit(0.25), limit - 0.15))))


def change_type(old: Column, new: Column) -> Column:
    """M14."""
    return F.when(is_missing(old) & is_missing(new), "both_missing").when(is_missing(new), "present_to_missing").when(is_missing(old), "missing_to_present").when(old.eqNullSafe(new), "same").otherwise("changed")


def dot(a: Column, b: Column) -> Column:
    """R8 in double precision."""
    return F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda z, x: z + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))
