"""What goes to a model as context, and how the flags of its answer become columns.

Operators: P13 P15 P16 P41 P42 P43 P44 F9 F11 F12 F13 F20 W16 U6 R4 R6 R7 H42 H48 H50 H52 H53 H59 H67 H68.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as texts
from ..functions import udfs, values

# Fixed values.
CORE_FIELDS = ["step_by_step_deliberation", "is_eligible", "confidence_score", "justification", "exclusion_reason_category", "seed_references"]
EXCLUSION_PREFIXES = ["no_", "not_", "wrong_", "insufficient_", "language_", "full_", "outside_", "without_", "exclude_", "non_"]
SECTION_NAMES = {
    "introduction": ["introduction", "background"],
    "method": ["method", "methods", "methodology", "materials and methods", "study design"],
    "results": ["results", "findings"],
    "discussion": ["discussion"],
    "conclusion": ["conclusion", "conclusions", "summary"],
    "reference": ["references", "reference", "bibliography", "acknowledgements", "acknowledgments"],
}
SECTION_CUES = {
    "introduction": r"\b(introduction|background)\b",
    "method": r"\b(methods?|methodology|materials?\s+and\s+methods?|study\s+design|participants?|intervention|procedure|protocol|randomi[sz]ed)\b",
    "results": r"\b(results?|findings)\b",
    "discussion": r"\bdiscussion\b",
    "conclusion": r"\b(conclusion|conclusions|summary)\b",
    "reference": r"\b(references?|bibliography|acknowledg(?:e)?ments?)\b",
}
METHOD_EVIDENCE = r"(?i)\b(methods?|methodology|materials?\s+and\s+methods?|study\s+design|participants?|recruit(?:ed|ment)?|intervention|procedure|protocol|randomi[sz]ed|outcome\s+measure|baseline|follow[- ]?up)\b"
MISSING_ABSTRACT = ["", "na", "n/a", "not available", "none", "null", "nan"]
CUE_WORDS, TITLE_LENGTH, SIGNAL_BUDGET, LEAST_CHARS_A_PAGE = 20, 50, 4500, 100


def _text(x: Column) -> Column:
    return F.trim(F.coalesce(x, F.lit("")))


def section_of(label: Column, text: Column) -> Column:
    """The section a label names, else the first whose cue is among the first words; null without either."""
    named = F.lower(F.trim(label))
    head = texts.truncate_words(text, CUE_WORDS)
    return F.coalesce(*[F.when(named.isin(n), k) for k, n in SECTION_NAMES.items()], *[F.when(head.rlike("(?i)" + p), k) for k, p in SECTION_CUES.items()])


def method_evidence(label: Column, text: Column, monitoring: Column) -> Column:
    """a method section, or a method's words outside reference lists; never text that only observes."""
    told = text.rlike(METHOD_EVIDENCE) & ~texts.reference_dominant(text)
    return F.coalesce(~monitoring & ((section_of(label, text) == "method") | told), F.lit(False))


def topic_flags(text: Column, action: str, primary: str, secondary: str) -> Column:
    """which of three patterns a text has, and whether all."""
    has = [F.coalesce(text.rlike(p), F.lit(False)) for p in (action, primary, secondary)]
    return F.struct(has[0].alias("action"), has[1].alias("primary"), has[2].alias("secondary"), (has[0] & has[1] & has[2]).alias("all"))


def dense(text: Column, pages: Column) -> Column:
    """enough characters a page to be a text layer; a document without pages counts as one page."""
    return F.length(_text(text)) / F.greatest(pages, F.lit(1)) >= LEAST_CHARS_A_PAGE


def missing_abstract(flag: Column, abstract: Column) -> Column:
    """why a record has no abstract to screen; null where it has one."""
    return F.when(F.lower(_text(flag)).isin("true", "1", "yes"), "abstract_missing_in_citation_ingestion").when(F.lower(_text(abstract)).isin(MISSING_ABSTRACT), "abstract_missing_or_placeholder")


def insufficient_context(why: Column, flags: list[str], reason: str = "insufficient_context") -> Column:
    """The decision on a record without abstract, as JSON; null where ``why`` is."""
    cells = [F.lit(1.0).alias("confidence_score"), F.lit("No abstract to screen by.").alias("justification"), F.lit(reason).alias("exclusion_reason_category"), F.lit(False).alias("is_eligible")]
    return F.when(why.isNotNull(), F.to_json(F.struct(*cells, *[F.lit(f == reason).alias(f) for f in flags], why.alias("deterministic_screening_reason"))))


def without_keys(metadata: Column, names: list[str]) -> Column:
    """A map without some keys, as those of authors."""
    return F.map_filter(metadata, lambda k, _: ~k.isin(names))


def exclusion_key(key: Column) -> Column:
    """Whether a key, in snake case, names an exclusion flag."""
    k = texts.snake(key)
    return (k != "") & ~k.isin(CORE_FIELDS) & k.rlike("^(?:" + "|".join(EXCLUSION_PREFIXES) + ")|_context$")


def folder_name(paper_id: Column, authors: Column, year: Column, title: Column) -> Column:
    """Id, first author's first word, year and a short title, joined by single underscores; 'paper' if all are blank."""
    safe = lambda x: F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), r"[^\p{L}\p{N}_-]", "_"), "^_+|_+$", "")
    author = F.element_at(F.split(F.trim(F.element_at(F.split(F.coalesce(authors, F.lit("")), ","), 1)), " "), 1)
    parts = F.array(safe(paper_id), safe(author), safe(year), F.substring(safe(title), 1, TITLE_LENGTH))
    joined = F.regexp_replace(F.array_join(F.filter(parts, lambda p: p != ""), "_"), "_{2,}", "_")
    return F.when(joined == "", "paper").otherwise(joined)


def numbered_chunks(chunks: Column) -> Column:
    """An array of structs text, section, page_start, page_end, sentences as blocks, each under its numbered head."""

    def block(c: Column, i: Column) -> Column:
        pages = F.when(c["page_start"] == c["page_end"], F.concat(F.lit("page "), c["page_start"].cast("string"))).otherwise(F.concat(F.lit("pages "), c["page_start"].cast("string"), F.lit("-"), c["page_end"].cast("string")))
        count = F.when(c["sentences"] > 0, F.concat(F.lit("sentences "), c["sentences"].cast("string")))
        head = F.concat_ws(", ", F.concat(F.lit("Chunk "), (i + 1).cast("string")), F.concat(F.lit("section "), c["section"]), pages, count)
        return F.concat(F.lit("["), head, F.lit("]\n"), _text(c["text"]))

    return F.array_join(F.transform(chunks, block), "\n\n")


def title_abstract_context(paper_id: Column, title: Column, abstract: Column) -> Column:
    """The whole record as one block; without an abstract, no such part."""
    body = F.when(_text(abstract) != "", F.concat(F.lit("Abstract:\n"), _text(abstract)))
    return F.concat_ws("\n\n", F.concat(F.lit("Paper ID: "), paper_id.cast("string")), F.concat(F.lit("Title: "), _text(title)), body)


def full_text_context(*parts: Column) -> Column:
    """Header, hints, body and supplement, as far as they are not blank."""
    return F.concat_ws("\n\n", *[F.when(_text(p) != "", F.trim(p)) for p in parts])


def first_text(*sources: Column) -> Column:
    """The first source that is not blank: cached text, chunks, fallback."""
    return F.coalesce(*[F.when(_text(s) != "", s) for s in sources])


def sentence_chunks(paper_id: Column, title: Column, abstract: Column) -> Column:
    """One chunk a sentence, title first; inputs are arrays of sentences, blank ones leave no gap in the numbering."""

    def side(kind: str, sentences: Column) -> Column:
        kept = F.filter(F.transform(F.coalesce(sentences, F.array().cast("array<string>")), lambda s: F.trim(s)), lambda s: s != "")
        return F.transform(kept, lambda s, i: F.struct(F.concat_ws("::", paper_id.cast("string"), F.lit(kind), F.lpad(i.cast("string"), 4, "0")).alias("chunk_id"), F.lit(kind).alias("kind"), s.alias("text")))

    return F.concat(side("title", title), side("abstract", abstract))


def prepared_chunks(paper_id: Column, title: Column, abstract: Column, authors: Column) -> Column:
    """R7 for records: sentences of title and abstract without their authors, each with its estimated tokens."""
    clean = lambda x: udfs.sentences(udfs.redact_authors(F.coalesce(x, F.lit("")), F.coalesce(authors, F.lit(""))))
    chunks = sentence_chunks(paper_id, clean(title), clean(abstract))
    return F.transform(chunks, lambda c: c.withField("tokens", F.ceil(F.size(texts.words(c["text"])) * texts.TOKENS_PER_WORD).cast("int")))


def deliberation(payload: Column) -> Column:
    """An answer's reasoning as one text: of an object its logic, else its texts joined, else its JSON."""
    raw = F.try_variant_get(F.try_parse_json(payload), "$.step_by_step_deliberation", "variant")
    is_text = F.schema_of_variant(raw) == "STRING"
    plain = F.try_variant_get(F.try_parse_json(payload), "$.step_by_step_deliberation", "string")
    cells = F.map_values(F.try_variant_get(F.try_parse_json(payload), "$.step_by_step_deliberation", "map<string,variant>"))
    spoken = F.transform(F.filter(cells, lambda v: F.schema_of_variant(v) == "STRING"), lambda v: F.trim(v.cast("string")))
    joined = F.array_join(F.filter(spoken, lambda s: s != ""), " ")
    logic = [F.nullif(F.trim(F.get_json_object(payload, f"$.step_by_step_deliberation.{k}")), F.lit("")) for k in ("Logic", "logic")]
    return F.when(is_text, plain).when(F.schema_of_variant(raw).startswith("OBJECT"), F.coalesce(*logic, F.nullif(joined, F.lit("")), F.to_json(raw))).otherwise(plain)


def _cells(payload: Column) -> Column:
    return F.coalesce(F.from_json(payload, "map<string,string>"), F.create_map().cast("map<string,string>"))


def flag_values(payload: Column, configured: list[str], neutral: list[str]) -> Column:
    """Configured flags and those an answer adds, in order of their names: true, false, or null for neutral or unread."""
    cells = _cells(payload)
    keys = F.array_sort(F.array_union(F.array(*map(F.lit, configured)).cast("array<string>"), F.filter(F.map_keys(cells), exclusion_key)))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.when(~(k.isin(neutral) & (F.upper(F.trim(cells[k])) == "NEUTRAL")) | cells[k].isNull(), values.parse_bool(cells[k])))))


def flag_violations(payload: Column, configured: list[str], neutral: list[str], reasons: list[str]) -> Column:
    """flags that are neither boolean nor an allowed neutral, a missing reason, a reason that is not configured."""
    cells = _cells(payload)
    unread = [F.when(cells[k].isNotNull() & values.parse_bool(cells[k]).isNull() & ~((F.upper(F.trim(cells[k])) == "NEUTRAL") & F.lit(k in neutral)), f"flag:{k}") for k in configured]
    reason, ok = values.field(payload, "exclusion_reason_category"), values.parse_bool(cells["is_eligible"])
    added = F.transform(F.filter(F.map_keys(cells), exclusion_key), texts.snake)
    return F.array_compact(F.array(*unread, F.when(~ok & reason.isNull(), "reason_missing"), F.when(reason.isNotNull() & ~reason.isin(reasons) & ~F.array_contains(added, reason), "reason_not_configured")))


def absence_key(keys: Column, terms: list[str], preferred: str | None = None) -> Column:
    """The preferred key if it is there, else the first ``no_`` key in order of names that shares a word with the topic."""
    known = F.array_sort(F.filter(F.transform(keys, texts.snake), lambda k: k != ""))
    topic = sorted({w for t in terms for w in "".join(c if c.isascii() and c.isalnum() else " " for c in t.lower()).split() if len(w) >= 3})
    shared = F.filter(known, lambda k: k.startswith("no_") & F.arrays_overlap(F.split(k, "_"), F.array(*map(F.lit, topic)).cast("array<string>")))
    return F.coalesce(F.when(F.array_contains(known, preferred or ""), preferred), F.try_element_at(shared, F.lit(1)))


def signal_text(reasoning: Column, chunks: Column) -> Column:
    """An answer's own words, then passages as far as the budget of characters goes."""
    own = F.filter(F.transform(reasoning, _text), lambda s: s != "")
    total = lambda parts: F.aggregate(parts, F.lit(0), lambda n, s: n + F.length(s))
    step = lambda taken, c: F.when((total(taken) < SIGNAL_BUDGET) & (_text(c) != ""), F.concat(taken, F.array(F.substring(_text(c), F.lit(1), SIGNAL_BUDGET - total(taken))))).otherwise(taken)
    return F.array_join(F.aggregate(chunks, own, step), "\n")


def summary(paper_id: Column, title: Column, abstract: Column, decision: Column) -> Column:
    """A record's readable block."""
    line = lambda name, x: F.when(F.coalesce(x, F.lit("")) != "", F.concat(F.lit(f"{name}: "), x, F.lit("\n"))).otherwise("")
    return F.concat(F.lit("Paper ID: "), F.coalesce(paper_id.cast("string"), F.lit("")), F.lit("\n"), line("Title", title), line("Abstract", F.substring(abstract, 1, 1000)), F.lit("LLM Decision: "), F.coalesce(decision, F.lit("")), F.lit("\n"))


def distinct_casefold(items: Column) -> Column:
    """The first of items that differ in case only, in order."""
    low = F.transform(items, F.lower)
    return F.filter(items, lambda x, i: F.array_position(low, F.lower(x)) == i + 1)


def single_blank_lines(text: Column) -> Column:
    """One blank line of each run."""
    return F.regexp_replace(text, r"\n[ \t]*\n[ \t\n]*\n", "\n\n")
