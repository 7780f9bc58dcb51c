"""Human review: columns matched to variables, gold values, quote-aware agreement, packets for reviewers.

Operators: S21 F21 F22 J12 J13 J17 J18 J21 J22 W9 T15 T17 M6 M7 M12 H5 H6 H23 H24 H25 H27 H28 H30 H31 H33 H36 H65 H92 H96.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values
from .extraction import to_long
from .relational import latest

# Fixed values.
ABSENT = ["", "n/a", "na", "not available", "not applicable", "none", "null", "missing"]
WEAK_PHRASES = ['"title":', "all rights reserved", "creative commons", "public domain dedication", "provided you give appropriate credit", "open access"]
GENERIC_COMMENT = [
    r"\bmissing\b", r"\bnot\s+(?:complete|completely|fully)\b", r"\bincomplete\b", r"\bminor\b", r"\bnegligible\b", r"\btoo\s+generic\b", r"\brepeats?\b.*\b(?:aim|objective|goal)s?\b",
    r"\bdoes\s+not\s+match\b", r"\bno\s+direct\s+quote\b", r"\bnot\s+separately\s+(?:analysed|analyzed|reported|evaluated)\b", r"\bnot\s+reported\s+separately\b", r"\bfragment\b", r"\bunclear\b",
    r"\bfehlt\b", r"\bfehlen\b", r"\bnicht\s+(?:komplett|vollständig|gesondert)\b", r"\bvernachlässig", r"\bungenauigkeit\b", r"\bwiederholt\b.*\b(?:ziel|ziele)\b", r"\bstimmt\s+nicht\b",
]
FROM_MANUSCRIPT = [r"\b(?:page|p\.|pp\.|seite|s\.)\s*\d+", r"\b(?:table|tab\.|figure|fig\.|section|methods?|results?|discussion|abstract)\b", r'["“”„]', r"\bdoi\b", r"\bn\s*=\s*\d+", r"\b\d+(?:\.\d+)?\s*%", r"\b\d+\s*/\s*\d+\b"]
HEADER_SCORES = {"consensus": 100, "variable": 98, "stem": 94, "ends_variable": 90, "ends_stem": 86, "has_consensus": 82, "has_variable": 78, "has_stem": 72}
NOTE_WORDS, NOTE_PENALTY = ["note", "notes", "quote", "quotes"], 35
SEVERITY = ["high", "review", "info"]


def label_key(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]+", " "))


def best_header(headers: Column, variable: Column, consensus: Column) -> Column:
    """Place (from 0) and score of the header that names a variable best, the first of equals; null without any."""
    name, whole = label_key(variable), label_key(consensus)
    stem = label_key(F.regexp_replace(F.regexp_replace(variable, "_overall", ""), "_", " "))
    within = lambda part, all_: (part != "") & (F.size(F.array_except(F.split(part, " "), F.split(all_, " "))) == 0)

    def score(h: Column) -> Column:
        rules = {
            "consensus": h == whole, "variable": h == name, "stem": (stem != "") & (h == stem), "ends_variable": F.endswith(h, name), "ends_stem": (stem != "") & F.endswith(h, stem),
            "has_consensus": within(whole, h), "has_variable": within(name, h), "has_stem": within(stem, h),
        }
        worth = F.coalesce(*[F.when(rule, HEADER_SCORES[k]) for k, rule in rules.items()], F.lit(0))
        less = F.when(F.arrays_overlap(F.split(h, " "), F.array(*map(F.lit, NOTE_WORDS))), NOTE_PENALTY).otherwise(0)
        return F.when((h != "") & (worth > 0), worth - less).otherwise(0)

    scored = F.transform(headers, lambda h, i: F.struct(score(label_key(h)).alias("score"), (-i).alias("back")))
    best = F.array_max(F.filter(scored, lambda s: s["score"] > 0))
    return F.when(best.isNotNull(), F.struct((-best["back"]).alias("place"), best["score"].alias("score")))


def candidate_headers(domain: str, variable: str, consensus: str, aliases: list[str] = ()) -> list[str]:
    """Names under which a sheet may hold a variable, the surest first."""
    shorter = [x[: -len(end)] for x, end in ((variable, "_overall"), (consensus, " overall")) if x.lower().endswith(end)]
    return [c for c in [consensus, variable, f"{domain}_{variable}", *aliases, *shorter] if c.strip()]


def resolve_header(headers: list[str], candidates: list[str]) -> str | None:
    """For each candidate in turn the header that is equal, equal in letters and digits, or equal without 'overall'."""
    plain = lambda x: "".join(c for c in x.lower() if c.isalnum())
    forms = [lambda x: x, plain, lambda x: plain(x).removesuffix("overall")]
    for c in candidates:
        for form in forms:
            for h in reversed(headers):
                if form(h) == form(c):
                    return h
    return None


def prose(x: Column) -> Column:
    """Compared form of a value: lower case, what is neither letter nor digit as one space (ASCII)."""
    return label_key(x)


def alias_match(human: Column, ai: Column, groups: list[list[str]]) -> Column:
    """Both values hold, or lie in, a term of the same group."""
    h, a = prose(human), prose(ai)
    near = lambda x, group: F.greatest(F.lit(False), *[F.contains(x, t) | F.contains(t, x) for t in map(prose, map(F.lit, group))])
    return (h != "") & (a != "") & F.greatest(F.lit(False), F.lit(False), *[near(h, g) & near(a, g) for g in groups])


def block_match(block: Column, aliases: list[str]) -> Column:
    """A text block names a domain as a whole phrase."""
    spaced = F.concat(F.lit(" "), prose(block), F.lit(" "))
    return F.greatest(F.lit(False), F.lit(False), *[F.contains(spaced, F.concat(F.lit(" "), prose(F.lit(a)), F.lit(" "))) for a in aliases if a.strip()])


def is_absent(x: Column) -> Column:
    return x.isNull() | F.lower(F.trim(x)).isin(ABSENT)


def quote_match(human: Column, ai: Column, free: float = 0.42, short: float = 0.50) -> Column:
    """M6: struct of matched and reason, the first rule that applies."""
    h, a = prose(human), prose(ai)
    small, large = F.when(F.length(h) <= F.length(a), h).otherwise(a), F.when(F.length(h) <= F.length(a), a).otherwise(h)
    inside = (F.length(small) >= 3) & F.contains(F.concat(F.lit(" "), large, F.lit(" ")), F.concat(F.lit(" "), small, F.lit(" ")))
    x, y = values.content_tokens(human), values.content_tokens(ai)
    least, share = F.least(F.size(x), F.size(y)), values.overlap(x, y)
    limit = F.when(least <= 4, short).otherwise(free)
    told = lambda matched, reason: F.struct(F.lit(matched).alias("matched"), reason.alias("reason"))
    by = lambda head: F.concat(F.lit(head), F.format_number(share, 2))
    return (
        F.when(is_absent(human) & is_absent(ai), told(True, F.lit("both_missing"))).when(is_absent(human) | is_absent(ai), told(False, F.lit("missing_mismatch")))
        .when(F.lower(F.trim(human)) == F.lower(F.trim(ai)), told(True, F.lit("strict_or_alias"))).when((h != "") & (h == a), told(True, F.lit("punctuation_spacing_normalized")))
        .when(inside, told(True, F.lit("short_exact_containment"))).when(least < 2, told(False, F.lit("too_few_tokens"))).when(share >= limit, told(True, by("token_overlap_")))
        .when(values.numbers_overlap(human, ai) & (share >= F.greatest(F.lit(0.25), limit - 0.15)), told(True, by("numeric_plus_overlap_"))).otherwise(told(False, by("overlap_")))
    )


def quote_cell_match(truth: Column, value: Column, quote: Column, note: Column) -> Column:
    """M7: value and quote against truth and, where there is one, the reviewer's note; reasons of those that match."""
    noted = F.coalesce(F.trim(note), F.lit("")) != ""
    pairs = {"value_vs_truth": (truth, value, F.lit(True)), "ai_quote_vs_truth": (truth, quote, F.lit(True)), "value_vs_reviewer_note": (note, value, noted), "ai_quote_vs_reviewer_note": (note, quote, noted)}
    said = F.array_compact(F.array(*[F.when(on & quote_match(a, b)["matched"], F.concat(F.lit(f"{k}:"), quote_match(a, b)["reason"])) for k, (a, b, on) in pairs.items()]))
    return F.struct((F.size(said) > 0).alias("matched"), F.array_join(said, "; ").alias("reason"))


def note_usable(note: Column) -> Column:
    """a note that can stand as the true value: it cites the manuscript, or is neither a comment nor a fragment."""
    low = F.lower(F.trim(F.regexp_replace(F.coalesce(note, F.lit("")), r"\s+", " ")))
    cites, comment = low.rlike("|".join(FROM_MANUSCRIPT)), low.rlike("|".join(GENERIC_COMMENT))
    fragment = low.rlike(r"^(?:and|or|und|oder)\b") | (F.size(F.regexp_extract_all(low, F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))) <= 1)
    return (low != "") & (cites | ~(comment | fragment))


def neighbour_note(notes: Column, scores: Column, place: Column) -> Column:
    """The note at a place (from 0); for a rejected cell without one, that of the next two places unless rejected too."""
    cell = lambda a, k: F.trim(F.coalesce(F.get(a, place + k), F.lit("")))
    near = [F.when((cell(notes, k) != "") & (cell(scores, k) != "0"), cell(notes, k)) for k in (1, 2)]
    return F.when((cell(notes, 0) != "") | (cell(scores, 0) != "0"), cell(notes, 0)).otherwise(F.coalesce(*near, F.lit("")))


def gold_value(value: Column, score: Column, note: Column) -> Column:
    """Struct value, evaluable, origin of the true value: accepted, corrected by a note, or not to be had."""
    told = lambda v, ok, why: F.struct(v.alias("value"), F.lit(ok).alias("evaluable"), F.lit(why).alias("origin"))
    none, noted, rejected = F.lit(""), F.coalesce(F.trim(note), F.lit("")) != "", F.coalesce(score == "0", F.lit(False))
    return (
        F.when(score == "1", told(value, True, "reviewer_accepted_source_value")).when(noted & note_usable(note) & rejected, told(note, True, "reviewer_quote_correction"))
        .when(noted & note_usable(note), told(note, True, "reviewer_quote_without_binary_score")).when(noted, told(none, False, "reviewer_comment_without_extractable_ground_truth"))
        .when(rejected, told(none, False, "reviewer_rejected_without_correction")).otherwise(told(none, False, "not_human_reviewed"))
    )


def informative(hit: Column) -> Column:
    """not blank, no dotted leader, no licence or header phrase."""
    t = F.trim(F.coalesce(hit, F.lit("")))
    return (t != "") & ~t.rlike(r"(?:\.\s*){5}") & ~F.greatest(F.lit(False), *[F.contains(F.lower(t), F.lit(p)) for p in WEAK_PHRASES])


def trace_evidence(reports: DataFrame) -> DataFrame:
    """paper_id, field_path, n_hits, first_hit from column ``text`` of trace reports; only informative hits count."""
    section = F.regexp_extract("text", r"(?s)=== Evidence Hint Search For Missing Fields ===\s*(.*?)(?:\n=== |\z)", 1)
    blocks = reports.select(F.regexp_replace(F.regexp_extract("text", r"(?m)^paper_id:\s*#?(.+?)\s*$", 1), "^#+", "").alias("paper_id"), F.explode(F.split(section, r"\n(?=\[[^\]\n]+\]\s+search_terms=)")).alias("block"))
    hits = F.filter(F.regexp_extract_all("block", F.lit(r"(?m)^\s+L\d+:\s*(.+)$"), F.lit(1)), informative)
    fields = blocks.select("paper_id", F.regexp_extract(F.trim("block"), r"^\[([^\]\n]+)\]\s+search_terms=", 1).alias("field_path"), hits.alias("hits"))
    return fields.where("paper_id != '' and field_path != ''").select("paper_id", "field_path", F.size("hits").alias("n_hits"), F.coalesce(F.substring(F.try_element_at("hits", F.lit(1)), 1, 500), F.lit("")).alias("first_hit"))


def audit_rows(records: DataFrame, keys: list[str], variables: list[tuple[str, str]]) -> DataFrame:
    """A row per record and (domain, variable), with columns <domain>_<variable> and <domain>_<variable>_quote as value and quote."""
    cell = lambda name: (F.col(name).cast("string") if name in records.columns else F.lit(None).cast("string"))
    each = [F.struct(F.lit(d).alias("domain"), F.lit(v).alias("variable"), cell(f"{d}_{v}").alias("value"), cell(f"{d}_{v}_quote").alias("quote")) for d, v in variables]
    return records.select(*keys, F.inline(F.array(*each)))


def packets(reviewers: dict[str, list[str]], shared: list[str], audit: DataFrame) -> DataFrame:
    """Each reviewer's rows of an audit (column ``path``): own variables, then shared ones not among them; a path none reviews gives no row."""
    scopes: dict[str, list[tuple[str, str]]] = {}
    for who, own in reviewers.items():
        for path in dict.fromkeys([*own, *shared]):
            scopes.setdefault(path, []).append((who, "assigned_expertise" if path in own else "shared_methodological_audit"))
    chosen = F.coalesce(*[F.when(F.col("path") == p, F.array(*[F.struct(F.lit(w).alias("reviewer"), F.lit(s).alias("scope")) for w, s in who])) for p, who in scopes.items()])
    return audit.select("*", F.inline(chosen))


def unknown_variables(reviewers: dict[str, list[str]], known: list[str]) -> list[str]:
    """Variables of a reviewer that the schema lacks."""
    return sorted({v for own in reviewers.values() for v in own} - set(known))


def rescue_targets(cells: DataFrame, variables: list[str], domains: list[str]) -> DataFrame:
    """Cells (path, domain, value, quote) to try again: configured ones and those without value or quote."""
    return cells.where(F.col("path").isin(variables) | F.col("domain").isin(domains) | is_absent(F.col("value")) | is_absent(F.col("quote")))


def changed(rescued: DataFrame) -> DataFrame:
    """Cells for which the second answer stands and differs in value or quote."""
    return rescued.where(F.col("mode") == "semantic_rescue").where(~(F.col("value").eqNullSafe(F.col("second")) & F.col("quote").eqNullSafe(F.col("second_quote"))))


def apply_rescue(rescued: DataFrame) -> DataFrame:
    """Value and quote as they stand after the rescue."""
    took = F.col("mode") == "semantic_rescue"
    return rescued.withColumn("value", F.when(took, F.col("second")).otherwise(F.col("value"))).withColumn("quote", F.when(took, F.col("second_quote")).otherwise(F.col("quote")))


def by_severity(*others: str) -> list[Column]:
    """Order of findings, unknown severities last."""
    return [F.coalesce(*[F.when(F.col("severity") == s, k) for k, s in enumerate(SEVERITY)], F.lit(len(SEVERITY))), *map(F.col, others)]


def by_id(name: str) -> list[Column]:
    """Shorter ids first, so whole numbers sort by value."""
    return [F.length(name), F.col(name)]


def number_text(x: Column) -> Column:
    """H6: a number as text, whole ones without a fraction; null for what is no number."""
    v = F.trim(x).try_cast("double")
    return F.when(v.isNotNull() & ~F.isnan(v), F.when(v == F.floor(v), F.floor(v).cast("string")).otherwise(v.cast("string")))


def headers_or_schema(headers: list[str], schema: list[str]) -> list[str]:
    """A sheet's headers if four or more of them are the schema's, else the schema's: a manifest is no layout."""
    plain = lambda x: "".join(c for c in x.lower() if c.isalnum())
    return headers if len({*map(plain, headers)} & {*map(plain, schema)}) >= 4 else list(dict.fromkeys(h for h in schema if h))


def consensus_cells(sheet: DataFrame, key: str, order: str, names: list[str]) -> DataFrame:
    """Key, variable, value of the last row of each id by an order."""
    return to_long(latest(sheet, [key], [F.col(order)]).select(key, *names), [key], names)


def with_decisions(report: DataFrame, decisions: list[str], paper_id: str | None = None) -> DataFrame:
    """Rows of some decisions, of one paper if asked."""
    rows = report.where(F.lower(F.trim("decision")).isin([d.lower() for d in decisions]))
    return rows.where(F.col("paper_id") == paper_id) if paper_id else rows


def rescue_counts(rescued: DataFrame) -> DataFrame:
    """Cells by domain and by what became of them."""
    return rescued.groupBy("domain", "mode").agg(F.count(F.lit(1)).alias("n"))
