"""Validation of decisions and of extracted cells: typed agreement, human labels, borderline answers, plausibility.

Operators: S19 K2 K3 K16 P37 P39 P47 P50 F11 F14 F15 F16 F17 F18 F25 F26 J7 J9 J11 J15 A5 A19 A26 A28 W14 M1 M2 M9 M15 H17 H22 H30 H64.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, values
from .bookkeeping import cell_score
from .evidence import labelled_counts
from .review import ABSENT, alias_match, changed, quote_cell_match

# Fixed values.
YES_WORDS = ["true", "1", "yes", "y", "present", "reported", "explicit"]
BOOLEAN_SPELLINGS = ["true", "false", "yes", "no"]
SECTION_MARKERS = ["abstract", "methods", "methods section", "design setting and participants", "recruitment", "eligibility", "setting", "participants", "results section", "discussion"]
STRICT_TYPES = ["integer", "float", "boolean", "enum"]
EVIDENCE_WORDS = 40
DISPLAY_MISSING = "Not Available"
VAGUE = ["yes", "true", "reported", "present", "mentioned", "unclear", "mixed", "various"]


def plain(x: Column) -> Column:
    """Lower case with single blanks."""
    return F.trim(F.regexp_replace(F.lower(F.trim(F.coalesce(x, F.lit("")))), r"\s+", " "))


def list_items(x: Column) -> Column:
    """Distinct items of a list text in lower case, words for absence left out, in order of their names."""
    whole = F.when(F.lower(F.trim(x)).isin(ABSENT), F.lit("")).otherwise(F.coalesce(x, F.lit("")))
    items = F.transform(F.split(whole, r"[;,|\n]"), plain)
    return F.array_sort(F.array_distinct(F.filter(items, lambda i: ~i.isin([a for a in ABSENT if a != "missing"]))))


def typed_key(x: Column, kind: str) -> Column:
    """M1: what two values of a type are compared by, as text: all words for absence alike, lists as sets, numbers by value."""
    absent = x.isNull() | F.lower(F.trim(x)).isin(ABSENT)
    if kind == "list":
        return F.array_join(list_items(x), "\n")
    if kind == "boolean":
        return F.when(~absent & F.lower(F.trim(x)).isin(YES_WORDS), "true").otherwise("false")
    if kind in ("integer", "float"):
        number = F.trim(x).try_cast("double")
        return F.when(absent, "not available").otherwise(F.coalesce(F.when(~F.isnan(number), number.cast("string")), plain(x)))
    return F.when(absent, "not available").otherwise(plain(x))


def strict_match(human: Column, ai: Column, kind: str, groups: list[list[str]] = (), fuzzy: bool = False) -> Column:
    """M2: equal by type or in one alias group; free text and lists also by their facts where that is asked for."""
    same = (typed_key(human, kind) == typed_key(ai, kind)) | alias_match(human, ai, list(groups))
    return same | F.coalesce(values.factual_match(human, ai), F.lit(False)) if fuzzy and kind not in STRICT_TYPES else same


def human_labels(included: DataFrame, excluded: DataFrame, known: list[str], ignored: list[str] = (), default: str = "Unspecified Reason") -> DataFrame:
    """paper_id, human_decision, human_note, human_tag of sheets paper_id, notes, tags; of an id in both the included row stands."""
    tagged = F.array_join(text.tags(F.coalesce("tags", F.lit("")), known, list(ignored)), " | ")
    yes = included.select(text.paper_id(F.col("paper_id")).alias("paper_id"), F.lit(1).alias("human_decision"), F.lit("Included").alias("human_note"), F.lit("").alias("human_tag"))
    no = excluded.select(text.paper_id(F.col("paper_id")).alias("paper_id"), F.lit(0).alias("human_decision"), text.reason_text(F.col("notes"), default).alias("human_note"), tagged.alias("human_tag"))
    both = yes.unionByName(no).groupBy("paper_id")
    # One row an id by a partial aggregation; of equal decisions the first note in order.
    return both.agg(F.min(F.struct(-F.col("human_decision"), "human_note", "human_tag")).alias("r")).select("paper_id", (-F.col("r.col1")).alias("human_decision"), "r.human_note", "r.human_tag")


def qc_labels(sheet: DataFrame) -> DataFrame:
    """S19 of a sheet paper_id, decision, reason: rows whose decision cannot be read go."""
    out = sheet.select(text.paper_id(F.col("paper_id")).alias("paper_id"), values.parse_decision(F.col("decision")).alias("human_decision"), F.coalesce("reason", F.lit("QC human review")).alias("human_note"))
    return out.where("human_decision is not null")


def aligned(human: Column, ai: Column, human_tags: Column, ai_tags: Column) -> Column:
    """M9: struct decision_match, reason_match; an included record has no reason, and the AI's first tag must be a human one."""
    own = F.when(F.coalesce(ai == 1, F.lit(False)), F.array().cast("array<string>")).otherwise(ai_tags)
    none = (F.size(own) == 0) & (F.size(human_tags) == 0)
    return F.struct(F.coalesce(human == ai, F.lit(False)).alias("decision_match"), (none | F.coalesce(F.array_contains(human_tags, F.try_element_at(own, F.lit(1))), F.lit(False))).alias("reason_match"))


def needs_retry(answer: Column) -> Column:
    """an answer that was cut off: not blank, no error message, and without its closing brace or not JSON."""
    t = F.trim(F.coalesce(answer, F.lit("")))
    return (t != "") & ~F.startswith(t, F.lit("LLM error")) & (~F.endswith(t, F.lit("}")) | (F.startswith(t, F.lit("{")) & F.try_parse_json(t).isNull()))


def exclusion_reason(answer: Column) -> Column:
    """The first of three keys that is not blank."""
    return values.field(answer, "exclusion_reason_category", "exclusion_reason", "reason")


def complete(answer: Column, stage: Column) -> Column:
    """F16: a JSON answer with a decision that can be read, a confidence, a justification, and a reason if it excludes."""
    ok = values.eligible(answer, stage)
    told = values.field(answer, "confidence_score").isNotNull() & values.field(answer, "justification").isNotNull()
    return F.coalesce(F.try_parse_json(answer).isNotNull() & ok.isNotNull() & told & (ok | exclusion_reason(answer).isNotNull()), F.lit(False))


def borderline(answer: Column, contradictions: Column, neutral: list[str], prefiltered: Column, evidence_words: Column, rescued: Column, topic_signal: Column, insufficient: str = "insufficient_context", topic_reasons: list[str] = ()) -> Column:
    """the reasons to look at an answer again, distinct and sorted.

    contradictions: F17's names; neutral: reasons that may be neutral; prefiltered: F14 found a publication without data;
    evidence_words, rescued: words of, and rescued sections among, chunks other than titles; topic_signal: F11 over them.
    """
    ok, reason = values.parse_bool(values.field(answer, "is_eligible")), exclusion_reason(answer)
    confidence = values.field(answer, "confidence_score").try_cast("double")
    out = ok == F.lit(False)
    found = F.array(
        F.when(confidence.between(*values.BORDERLINE), "mid_confidence_band"),
        F.when(out & reason.isin(list(neutral)), "context_only_exclusion"),
        F.when(ok & prefiltered, "publication_type_prefilter_conflict"),
        F.when(out & (reason == insufficient) & (evidence_words > 0) & ((evidence_words >= EVIDENCE_WORDS) | (rescued > 0)), "insufficient_context_with_non_title_evidence"),
        F.when(out & reason.isin(list(topic_reasons)) & topic_signal, "topic_exclusion_with_topic_signal"),
    )
    return F.array_sort(F.array_distinct(F.concat(contradictions, F.array_compact(found))))


def prompt_overflow(words: Column, most_output: Column, window: Column) -> Column:
    """F25."""
    return words + most_output > window


def blocked(errors: DataFrame, kinds: list[str]) -> DataFrame:
    """ids with an error that another try does not mend."""
    return errors.where(F.col("error_type").isin(kinds)).select("paper_id").distinct()


def pending(retry: DataFrame, latest: DataFrame, stage: Column) -> DataFrame:
    """Ids to try again whose latest answer, if there is one, is not complete."""
    answered = latest.select("paper_id", complete(F.col("answer"), stage).alias("done"))
    return retry.select("paper_id").distinct().join(answered, "paper_id", "left").where("done is null or not done").select("paper_id")


def carried_folders(included: DataFrame, folders: DataFrame) -> DataFrame:
    """Each included paper with its folder of the stage before, null where there is none."""
    return included.join(folders.groupBy("paper_id").agg(F.min("folder").alias("folder")), "paper_id", "left")


def main_and_retry(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Role main for the first row of each key, retry for the others, by a minimum instead of a sort of each group."""
    first = rows.groupBy(*key).agg(F.min(F.struct(*order)).alias("__first"))
    return rows.join(first, key).withColumn("role", F.when(F.struct(*order) == F.col("__first"), "main").otherwise("retry")).drop("__first")


def validated_cells(human: DataFrame, ai: DataFrame, variables: list[tuple[str, str]], quotes: bool = True) -> DataFrame:
    """J11, A5's input: every variable (name, type) of every human row beside the AI's value of the same paper.

    human has a column per variable, <variable>_note, and <variable>_score where a reviewer scored the cell; ai has a
    column per variable and <variable>_quote.  Variables are unpivoted within each row, so no cross join is made.
    """
    cell = lambda df, name: (F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string"))
    mine = [F.struct(F.lit(v).alias("variable"), F.lit(k).alias("kind"), cell(human, v).alias("human"), cell(human, f"{v}_note").alias("note"), cell(human, f"{v}_score").alias("score")) for v, k in variables]
    theirs = F.map_from_arrays(F.array(*[F.lit(v) for v, _ in variables]), F.array(*[F.struct(cell(ai, v).alias("value"), cell(ai, f"{v}_quote").alias("quote")) for v, _ in variables]))
    rows = human.select("paper_id", F.array(*mine).alias("cells")).join(ai.select("paper_id", theirs.alias("answers")), "paper_id", "left").select("paper_id", F.inline("cells"), "answers")
    rows = rows.withColumn("ai", F.col("answers")[F.col("variable")]["value"]).withColumn("quote", F.col("answers")[F.col("variable")]["quote"]).drop("answers")
    strict = F.coalesce(*[F.when(F.col("kind") == k, strict_match(F.col("human"), F.col("ai"), k)) for k in sorted({k for _, k in variables})], F.lit(False))
    aware = quote_cell_match(F.col("human"), F.col("ai"), F.col("quote"), F.col("note"))["matched"]
    scored = cell_score(F.col("score"))
    none = lambda c, k: F.when(k == "list", F.size(list_items(c)) == 0).otherwise(c.isNull() | F.lower(F.trim(c)).isin(ABSENT))
    return rows.select(
        "paper_id", "variable", (~none(F.col("human"), F.col("kind"))).alias("human_present"), none(F.col("ai"), F.col("kind")).alias("ai_missing"), strict.alias("strict_match"), aware.alias("quote_aware_match"),
        F.coalesce(scored, aware if quotes else strict).alias("matched"), F.when(scored.isNotNull(), "human_binary_score").otherwise("quote_aware_value_or_quote" if quotes else "normalized_exact_value").alias("match_source"),
    )


def plausibility(cells: DataFrame, traces: DataFrame | None = None, rescued: DataFrame | None = None) -> DataFrame:
    """paper_id, domain, variable, severity, check_name of every finding, each rule of a row an element of one array.

    cells: paper_id, domain, variable, kind, options (array), value, quote, baseline, in_baseline (whether the earlier
    version has the paper).  traces: paper_id, domain, variable, n_hits.  rescued: paper_id, domain, variable and the
    columns that H30 reads.  The sample size is the value of the variable ``sample_size`` of the same paper and domain.
    """
    size = cells.where("variable = 'sample_size'").groupBy("paper_id", "domain").agg(F.max(F.regexp_extract("value", "([0-9]+)", 1).try_cast("long")).alias("sample"))
    rows = cells.join(size, ["paper_id", "domain"], "left")
    hits = traces.groupBy("paper_id", "domain", "variable").agg(F.max("n_hits").alias("n_hits")) if traces is not None else None
    rows = rows.join(hits, ["paper_id", "domain", "variable"], "left") if hits is not None else rows.withColumn("n_hits", F.lit(0))
    absent = lambda c: F.col(c).isNull() | F.lower(F.trim(F.col(c))).isin(ABSENT)
    key = lambda c: F.regexp_replace(F.lower(F.coalesce(F.col(c), F.lit(""))), "[^a-z0-9]+", "")
    has, quoted, was = ~absent("value"), F.coalesce(F.trim("quote"), F.lit("")) != "", ~absent("baseline") & F.col("in_baseline")
    differs = F.col("in_baseline") & ~F.coalesce(F.col("value"), F.lit("")).eqNullSafe(F.coalesce(F.col("baseline"), F.lit("")))
    choice = F.coalesce(F.size("options"), F.lit(0)) > 0
    compact = F.col("sample").isNotNull() | F.col("kind").isin("integer", "boolean") | choice
    both = F.concat_ws(" ", F.coalesce("value", F.lit("")), F.coalesce("quote", F.lit("")))
    under = F.array_distinct(F.transform(F.regexp_extract_all(both, F.lit(r"[0-9]+\s*/\s*([0-9]+)"), F.lit(1)), lambda x: x.try_cast("long")))
    counts = labelled_counts(both)
    other = (F.col("variable") != "sample_size") & (F.col("sample") > 0)
    markers = [m.replace(" ", "") for m in SECTION_MARKERS]
    rule = lambda on, name, level: F.when(F.coalesce(on, F.lit(False)), F.struct(level if isinstance(level, Column) else F.lit(level), F.lit(name)))
    found = F.array_compact(F.array(
        rule(differs & was & ~has, "version_present_to_missing", "high"), rule(differs & ~was & has, "version_missing_to_present", "info"), rule(differs & was & has & compact, "version_changed_present_value", "review"),
        rule(has & (F.col("kind") == "integer") & ~F.col("value").rlike("[0-9]"), "schema_integer_not_numeric", "high"),
        rule(has & (F.col("kind") == "boolean") & ~key("value").isin(BOOLEAN_SPELLINGS), "schema_boolean_unexpected_value", "review"),
        rule(has & choice & ~F.exists("options", lambda o: F.regexp_replace(F.lower(o), "[^a-z0-9]+", "") == key("value")), "schema_allowed_option_unmatched", "review"),
        rule(has & F.contains(key("variable"), F.lit("evidencesource")) & F.greatest(*[F.startswith(key("value"), F.lit(m)) for m in markers]), "evidence_source_looks_like_article_section", "review"),
        rule(has & ~quoted, "present_value_without_quote", "review"), rule(~has & quoted, "missing_value_with_quote", "review"),
        rule(~has & (F.col("n_hits") > 0), "missing_value_with_trace_evidence", F.when(was, "high").otherwise("review")),
        rule(other & (F.size(under) > 0) & ~F.array_contains(under, F.col("sample")), "population_denominator_differs_from_sample_size", "high"),
        rule(other & (F.size(counts) >= 2) & (F.aggregate(counts, F.lit(0), lambda z, c: z + c) > F.col("sample")), "population_counts_exceed_sample_size", "review"),
    ))
    out = rows.select("paper_id", "domain", "variable", F.explode(found).alias("f")).select("paper_id", "domain", "variable", F.col("f.col1").alias("severity"), F.col("f.col2").alias("check_name"))
    if rescued is None:
        return out
    return out.unionByName(changed(rescued).select("paper_id", "domain", "variable", F.lit("review").alias("severity"), F.lit("hybrid_rescue_changed_primary_value").alias("check_name")))


def with_baseline(candidate: DataFrame, baseline: DataFrame) -> DataFrame:
    """Cells with the earlier version's value beside them; in_baseline says whether it has the paper at all."""
    known = baseline.select("paper_id").distinct().withColumn("in_baseline", F.lit(True))
    old = baseline.select("paper_id", "domain", "variable", F.col("value").alias("baseline"))
    return candidate.join(old, ["paper_id", "domain", "variable"], "left").join(known, "paper_id", "left").withColumn("in_baseline", F.coalesce("in_baseline", F.lit(False)))


def total_of(parts: list[DataFrame], measures: list[str]) -> DataFrame:
    """The sums of measures over the total rows of several runs; a run without a measure counts 0."""
    one = lambda df: df.select(*[F.coalesce(F.col(m).try_cast("double"), F.lit(0.0)).alias(m) if m in df.columns else F.lit(0.0).alias(m) for m in measures])
    rows = one(parts[0])
    for df in parts[1:]:
        rows = rows.unionByName(one(df))
    return rows.agg(*[F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in measures])


def presence(cells: list[Column]) -> Column:
    """How many of a record's values are there."""
    return sum((F.when(values.is_missing(c), 0).otherwise(1) for c in cells), F.lit(0))


def level_counts(reports: DataFrame) -> DataFrame:
    """Documents by the parser's level, the part before the first colon, and by status."""
    return reports.groupBy(F.coalesce(F.substring_index("parser_level", ":", 1), F.lit("none")).alias("level"), "status").agg(F.count(F.lit(1)).alias("n"))


def chunk_records(chunks: DataFrame, order: str) -> DataFrame:
    """K2: paper_id and its chunks as JSON, in order; a paper's chunks are its own text, so they are bounded by it."""
    rest = [c for c in chunks.columns if c not in ("paper_id", order)]
    return chunks.groupBy("paper_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(order, *rest))), lambda c: F.struct(*[c[n].alias(n) for n in rest]))).alias("chunks"))


def split_summary(records: DataFrame, split: str, seconds: str) -> DataFrame:
    """K3: count, share of all and the longest response of each split."""
    counts = records.groupBy(split).agg(F.count(F.lit(1)).alias("n"), F.max(seconds).alias("most_seconds"))
    return counts.withColumn("percent", F.round(100.0 * F.col("n") / counts.agg(F.sum("n").alias("total")).scalar(), 6))


def payload_cell(leaf: Column, default: str | None = None) -> Column:
    """Struct value, quote of a JSON leaf, plain or of the old shape {value, quote}; no quote stands without a value."""
    nested = F.get_json_object(leaf, "$.value")
    old = F.coalesce(F.startswith(F.trim(leaf), F.lit("{")), F.lit(False))
    value = F.when(old, nested).otherwise(leaf)
    kept = F.when(values.is_missing(value), F.lit(default).cast("string")).otherwise(value)
    return F.struct(kept.alias("value"), F.when(old & ~values.is_missing(value), F.get_json_object(leaf, "$.quote")).alias("quote"))


def display(value: Column) -> Column:
    """A value, or an array of them joined, as shown; what is absent as DISPLAY_MISSING."""
    return F.when(values.is_missing(value), DISPLAY_MISSING).otherwise(F.trim(value))


def display_list(items: Column) -> Column:
    """P39 of an array."""
    return F.coalesce(F.nullif(F.array_join(F.filter(items, lambda x: ~values.is_missing(x)), "; "), F.lit("")), F.lit(DISPLAY_MISSING))


def filename_metadata(name: Column) -> Column:
    """Struct author, year, title of 'Author - Year - Title.pdf'; the whole name as title where it has another shape."""
    bare = F.regexp_replace(name, r"(?i)\.pdf$", "")
    part = lambda k: F.trim(F.regexp_extract(bare, r"^(.*?)\s+-\s+([0-9]{4})\s+-\s+(.*)$", k))
    fits = part(2) != ""
    return F.struct(F.when(fits, part(1)).otherwise("").alias("author"), part(2).alias("year"), F.when(fits, part(3)).otherwise(F.trim(bare)).alias("title"))


def base_source(source: Column) -> Column:
    """P50: what is before the first bar."""
    return F.trim(F.substring_index(F.coalesce(source, F.lit("")), "|", 1))


def vague(value: Column) -> Column:
    """H64."""
    return F.coalesce(plain(value).isin(VAGUE), F.lit(False))


def assumption_gaps(row: dict[str, Column]) -> Column:
    """Names of the fields, in order of their names, that a row leaves blank."""
    return F.array_compact(F.array(*[F.when(F.coalesce(F.trim(c.cast("string")), F.lit("")) == "", F.lit(k)) for k, c in sorted(row.items())]))


