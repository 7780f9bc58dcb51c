"""Queries of text forms, decisions, validation, review and run bookkeeping, each with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text, udfs, values
from ..operators import bookkeeping, bootstrap, contexts, evidence, extraction, linkage, operations, relational, review, selection, signals, validation
from ..sources import artefacts, records
from ..sources.scratch import Scratch
from ..streaming import incremental
from . import registry
from .registry import _CONTENT, _SCORED, _TOKENS, _chain, _lines, _sum_sql

NAMES: list[str] = []


def query(sql: str | None = None):
    def register(f):
        NAMES.append(f.__name__)
        return registry.query(sql)(f)

    return register


def _in(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _nth(column: str, words: list[str | None]) -> F.Column:
    """One of some words, by a number."""
    return F.element_at(F.array(*[F.lit(w) for w in words]), (F.pmod(F.col(column), F.lit(len(words))) + 1).cast("int"))


def _pick(column: str, words: list[str | None]) -> str:
    return "([" + ", ".join("NULL" if w is None else "'" + w.replace("'", "''") + "'" for w in words) + f"])[({column} % {len(words)}) + 1]"


# --- text forms

_SQUEEZED = "trim(regexp_replace({x}, '[ \\t\\n\\f\\r]+', ' ', 'g'), ' ')"


@query(f"""
SELECT page_id, regexp_extract(url, '((?:19|20)[0-9]{{2}})', 1) AS year, nullif(regexp_replace(lower(url), '[^a-z0-9]+', '', 'g'), '') AS fingerprint, trim(regexp_replace(regexp_replace(lower(url), '[0-9]+', ' ', 'g'), '\\s+', ' ', 'g'), ' ') AS margin,
  coalesce(nullif(regexp_replace(url, '[^A-Za-z0-9_-]', '', 'g'), ''), 'paper') AS safe, {_SQUEEZED.format(x="translate(lower(url), '_-', '  ')")} AS tag,
  CASE WHEN length(t) > 60 THEN rtrim(substr(t, 1, 57), ' ') || '...' ELSE t END AS short FROM (SELECT *, {_SQUEEZED.format(x="html")} AS t FROM pages)""")
def text_normal_forms(pages):
    """P5, P7, P11, P17, P23, P27 over addresses and pages."""
    u = F.col("url")
    return pages.select("page_id", text.year(u).alias("year"), text.fingerprint(u).alias("fingerprint"), text.margin_key(u).alias("margin"), text.safe_name(u).alias("safe"), text.tag_text(u).alias("tag"), text.shorten(F.col("html"), 60).alias("short"))


_SPACED = [("([.!?;,:])([0-9A-Za-z_])", "\\1 \\2"), ("([A-Za-z])([0-9])", "\\1 \\2"), ("([0-9])([A-Za-z])", "\\1 \\2"), ("([a-z])([A-Z])", "\\1 \\2")]
_JOINED = _chain("coalesce(html, '')", [("\\xAD", ""), ("([0-9A-Za-z_])-\\s*\\n\\s*([0-9A-Za-z_])", "\\1\\2"), ("\\r\\n?", "\\n")]).replace("'\\n'", "chr(10)")


@query(f"""
WITH l AS (SELECT page_id, list_filter(list_transform(string_split({_JOINED}, chr(10)), lambda x: trim(regexp_replace(x, '^\\s+|\\s+$', '', 'g'), ' ')), lambda x: x = '' OR NOT ({' OR '.join(f"regexp_matches(x, '{p}')" for p in text.DROPPED_LINES)})) AS a FROM pages),
j AS (SELECT page_id, array_to_string(list_transform(a, lambda x: {_chain("regexp_replace(x, '[\\t ]+', ' ', 'g')", _SPACED)}), chr(10)) AS t FROM l)
SELECT page_id, md5(regexp_replace(regexp_replace(t, '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g')) AS repaired_md5 FROM j""")
def line_repair(pages):
    """P9."""
    return pages.select("page_id", F.md5(text.repair_lines(F.col("html"))).alias("repaired_md5"))


@query(f"SELECT conv_id, turn, {_SQUEEZED.format(x=_chain("coalesce(text, '')", [("\\xAD", ""), ("([0-9A-Za-z_])-\\s+([0-9A-Za-z_])", "\\1\\2")]))} AS line FROM conversations")
def chunk_lines(conversations):
    """P10."""
    return conversations.select("conv_id", "turn", text.chunk_line(F.col("text")).alias("line"))


@query(f"SELECT page_id, md5(regexp_replace(html, '(?is)\\n[ \\t]*(?:</?[a-z]+>)*[ \\t]*$', '')) IS NOT NULL AS whole, coalesce(nullif(trim(regexp_replace(split_part(url, '/', 3), '(?i)^\\s*exclusion reason:\\s*', '')), ''), 'unspecified') AS reason FROM pages")
def reason_texts(pages):
    """P29 over hosts, half of them under its heading."""
    host = F.split_part("url", F.lit("/"), F.lit(3))
    headed = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit(" Exclusion Reason:  "), host)).otherwise(host)
    return pages.select("page_id", F.col("html").isNotNull().alias("whole"), text.reason_text(headed).alias("reason"))


_KNOWN_TAGS, _IGNORED_TAGS = ["promo", "brushed", "steel", "small"], ["tin"]


@query(f"""
WITH p AS (SELECT p_partkey, list_filter(list_transform(string_split(replace(p_type, ' ', ';') || ',' || lower(p_brand) || ';Tin; STEEL', ';'), lambda x: x), lambda x: true) AS l FROM part),
q AS (SELECT p_partkey, list_filter(list_transform(flatten(list_transform(l, lambda x: string_split(x, ','))), lambda x: {_SQUEEZED.format(x="translate(lower(x), '_-', '  ')")}), lambda x: x <> '' AND x NOT IN ({_in(_IGNORED_TAGS)})) AS parts FROM p),
f AS (SELECT p_partkey, list_filter(list_transform(parts, lambda x: CASE {' '.join(f"WHEN contains(x, '{k}') THEN '{k}'" for k in _KNOWN_TAGS)} END), lambda t: t IS NOT NULL) AS found FROM q)
SELECT p_partkey, array_to_string(list_filter(found, lambda t, i: list_position(found, t) = i), ',') AS tags FROM f""")
def tag_lists(part):
    """P28."""
    raw = F.concat(F.regexp_replace("p_type", " ", ";"), F.lit(","), F.lower("p_brand"), F.lit(";Tin; STEEL"))
    return part.select("p_partkey", F.array_join(text.tags(raw, _KNOWN_TAGS, _IGNORED_TAGS), ",").alias("tags"))


_REFERENCE_HEADS = ["References", "## 7. Bibliography:", "  works  cited ", "literature cited", "references are within a line", "7 See references"]


@query("SELECT p_partkey, p_name || CASE WHEN p_partkey % 6 >= 4 THEN ' ' || chr(10) || chr(10) || (['references are within a line', '7 See references'])[p_partkey % 6 - 3] || chr(10) || p_type || chr(10) || 'Bibliographies' ELSE '' END AS kept FROM part")
def texts_before_references(part):
    """Nothing from the first heading of references on is kept."""
    return part.select("p_partkey", text.before_references(F.concat(F.lit("\n "), "p_name", F.lit(" \n\n"), _nth("p_partkey", _REFERENCE_HEADS), F.lit("\n"), "p_type", F.lit("\nBibliographies\t"))).alias("kept"))


_CITED = "len(regexp_extract_all({x}, '\\[[0-9,\\s\\-]+\\]|\\([12][0-9]{{3}}\\)'))"
_SUBSTANCE = f"""(word_count >= 25 AND unique_alpha_word_count >= 10 AND score >= 0.40 AND {_CITED.format(x="t")} / greatest(word_count, 1) <= 0.45
  AND (regexp_matches(t, '{text.METHOD_EVIDENCE}') OR regexp_matches(t, '{text.SUBSTANTIVE_TEXT}') OR len(list_filter(regexp_extract_all(t, '[\\p{{L}}\\p{{N}}_]+'), lambda w: regexp_full_match(w, '[A-Za-z]{{5,}}'))) >= 12))"""
_LISTED = f"""({_CITED.format(x="u")} >= 8 OR ({_CITED.format(x="u")} >= 4 AND len(regexp_extract_all(lower(u), 'doi')) + len(regexp_extract_all(lower(u), 'et al')) + len(regexp_extract_all(lower(u), 'pmid')) >= 3)
  OR (len(regexp_extract_all(u, '\\b(?:19|20)[0-9]{{2}}\\b')) >= 10 AND {_CITED.format(x="u")} >= 3) OR len(regexp_extract_all(u, '{text.REFERENCE_ENTRY}')) >= 6 OR regexp_matches(array_to_string(tok[1:35], ' '), '{text.REFERENCE_HEAD}'))"""
_JUDGED = f"SELECT s.*, trim(coalesce(d.text, ''), ' ') AS t, {_TOKENS.replace('text', 'd.text')} AS tok, array_to_string({_TOKENS.replace('text', 'd.text')}, ' ') AS u, d.text FROM ({_SCORED}) s JOIN documents d USING (doc_id)"
_RATIOS = "alnum_count / greatest(n_chars, 1) < 0.45 OR word_count < 5 OR unique_alpha_word_count < 4 OR single_count / greatest(word_count, 1) > 0.35 OR avg_len < 3.0 OR spaced"


@query(f"""
SELECT doc_id, {_SUBSTANCE} AS substantive, u <> '' AND {_LISTED} AND NOT {_SUBSTANCE} AS reference_dominant,
  ({_sum_sql(text.BOILERPLATE_STRONG)}) >= 1 OR ({_sum_sql(text.BOILERPLATE_WEAK)}) >= 3 OR alnum_count < 12 OR {_RATIOS} OR (u <> '' AND {_LISTED} AND NOT {_SUBSTANCE}) AS low_quality FROM ({_JUDGED})""")
def chunk_quality(documents):
    """F4, F6, F7."""
    t = F.col("text")
    flags = {"substantive": text.substantive_text(t), "reference_dominant": text.reference_dominant(t), "low_quality": text.low_quality(t)}
    return documents.select("doc_id", *[F.coalesce(c, F.lit(False)).alias(k) for k, c in flags.items()])


_HEADS = [None, "Methods: ", "3.1 Results - ", "DISCUSSION", "2 Materials and Methods", "References", "Conclusions: ", "methodology of it ", "1. Introduction:"]


@query(f"""
WITH l AS (SELECT p_partkey, coalesce({_pick("p_partkey", _HEADS)}, '') || CASE WHEN p_partkey % 9 IN (3, 4, 5, 8) THEN '' ELSE p_name END AS s FROM part),
h AS (SELECT *, CASE {' '.join(f"WHEN regexp_matches(s, '(?i)^\\s*(?:[0-9]+(?:\\.[0-9]+)*)?\\s*(?:{p})\\s*:?\\s*$') THEN '{k}'" for k, p in text.SECTIONS.items())} END AS alone,
  CASE {' '.join(f"WHEN regexp_matches(s, '(?i)^\\s*(?:[0-9]+(?:\\.[0-9]+)*)?\\s*(?:{p})\\s*[:\\-]\\s*.*$') THEN '{k}'" for k, p in text.SECTIONS.items() if k != "reference")} END AS inline FROM l)
SELECT p_partkey, coalesce(alone, inline) AS section, CASE WHEN alone IS NOT NULL THEN '' WHEN inline IS NOT NULL THEN trim(regexp_extract(s, '^[^:\\-]*[:\\-]\\s*(.*)$', 1)) ELSE trim(s) END AS rest FROM h""")
def section_lines(part):
    """Headings alone, with a colon or dash, and none."""
    body = F.when((F.pmod("p_partkey", F.lit(9))).isin(3, 4, 5, 8), "").otherwise(F.col("p_name"))
    label, rest = text.section(F.concat(F.coalesce(_nth("p_partkey", _HEADS), F.lit("")), body))
    return part.select("p_partkey", label.alias("section"), rest.alias("rest"))


# --- decisions

_WORDS = [" Yes", "NO", "included", "excluded ", "maybe", "1", "0", "", None]
_BOOL = f"CASE WHEN lower(trim(w)) IN ({_in(values.YES)}) THEN true WHEN lower(trim(w)) IN ({_in(values.NO)}) THEN false END"


@query(f"SELECT s_suppkey, {_BOOL} AS yes, ({_BOOL})::INTEGER AS decision FROM (SELECT s_suppkey, {_pick('s_suppkey', _WORDS)} AS w FROM supplier)")
def decision_words(supplier):
    """P30, P34."""
    w = _nth("s_suppkey", _WORDS)
    return supplier.select("s_suppkey", values.parse_bool(w).alias("yes"), values.parse_decision(w).alias("decision"))


_FULL = '{"is_eligible": false, "confidence_score": 0.6, "justification": "seen", "exclusion_reason_category": "no_intervention"}'
_ANSWERS = [_FULL, '{"is_eligible": true, "confidence_score": 0.9, "justification": "fits"}', '{"is_eligible": false, "confidence_score": 0.5, "justification": "x"}', '{"is_eligible": true, "justification": "x"}', "LLM error: 500", "", '{"is_eligible": true, "conf', "eligible", '{"is_eligible": "NEUTRAL", "confidence_score": 1, "justification": " ", "reason": "r"}', '{"a": }', None]


@query(f"""
WITH a AS (SELECT c_custkey, c_custkey % {len(_ANSWERS)} AS k, trim(coalesce({_pick('c_custkey', _ANSWERS)}, '')) AS t FROM customer)
SELECT c_custkey, t <> '' AND NOT starts_with(t, 'LLM error') AND (NOT ends_with(t, '}}') OR (starts_with(t, '{{') AND NOT json_valid(t))) AS retry, k IN (0, 1) AS complete, CASE k WHEN 0 THEN 'no_intervention' WHEN 8 THEN 'r' END AS reason FROM a""")
def answer_states(customer):
    """F15, F16, H17 over whole, cut, plain and missing answers."""
    a = _nth("c_custkey", _ANSWERS)
    return customer.select("c_custkey", validation.needs_retry(a).alias("retry"), validation.complete(a, F.lit("full_text")).alias("complete"), validation.exclusion_reason(a).alias("reason"))


@query(f"""
WITH n AS (SELECT DISTINCT o_custkey AS paper_id FROM orders WHERE o_orderstatus = 'P'), l AS (SELECT c_custkey AS paper_id, c_custkey % {len(_ANSWERS)} IN (0, 1) AS done FROM customer WHERE c_custkey % 5 <> 0)
SELECT paper_id FROM n LEFT JOIN l USING (paper_id) WHERE done IS NULL OR NOT done""")
def retry_pending(orders, customer):
    """J7, F16."""
    retry = orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("paper_id"))
    latest = customer.where("c_custkey % 5 != 0").select(F.col("c_custkey").alias("paper_id"), _nth("c_custkey", _ANSWERS).alias("answer"))
    return validation.pending(retry, latest, F.lit("full_text"))


_BORDER = "'{\"is_eligible\": ' || CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'false' END || ', \"confidence_score\": ' || ((doc_id % 100) / 100.0)::VARCHAR || '}'"


@query("""
WITH b AS (SELECT doc_id, quality, toxic, doc_id % 2 = 0 AS ok, (doc_id % 100) / 100.0 AS conf, CASE doc_id % 5 WHEN 0 THEN 'insufficient_context' WHEN 1 THEN 'not_urban_context' WHEN 2 THEN 'no_topic' END AS reason FROM labels),
r AS (SELECT doc_id, [CASE WHEN toxic = 1 THEN 'is_eligible_true_with_true_exclusion_flag' END, CASE WHEN conf BETWEEN 0.45 AND 0.75 THEN 'mid_confidence_band' END, CASE WHEN NOT ok AND reason = 'not_urban_context' THEN 'context_only_exclusion' END, CASE WHEN ok AND quality = 1 THEN 'publication_type_prefilter_conflict' END,
  CASE WHEN NOT ok AND reason = 'insufficient_context' AND doc_id % 90 > 0 AND (doc_id % 90 >= 40 OR doc_id % 3 > 0) THEN 'insufficient_context_with_non_title_evidence' END, CASE WHEN NOT ok AND reason = 'no_topic' AND quality = 0 THEN 'topic_exclusion_with_topic_signal' END] AS l FROM b)
SELECT doc_id, array_to_string(list_sort(list_filter(l, lambda x: x IS NOT NULL)), ',') AS reasons FROM r""")
def borderline_answers(labels):
    """F18."""
    reason = F.when(F.col("doc_id") % 5 == 0, "insufficient_context").when(F.col("doc_id") % 5 == 1, "not_urban_context").when(F.col("doc_id") % 5 == 2, "no_topic")
    answer = F.to_json(F.struct((F.col("doc_id") % 2 == 0).alias("is_eligible"), (F.pmod("doc_id", F.lit(100)) / 100).alias("confidence_score"), reason.alias("exclusion_reason_category")))
    known = F.array_compact(F.array(F.when(F.col("toxic") == 1, "is_eligible_true_with_true_exclusion_flag")))
    out = validation.borderline(answer, known, ["not_urban_context"], F.col("quality") == 1, F.col("doc_id") % 90, F.col("doc_id") % 3, F.col("quality") == 0, topic_reasons=["no_topic"])
    return labels.select("doc_id", F.array_join(out, ",").alias("reasons"))


# --- human labels and agreement

_SHEET_TAGS = ["no topic; wrong type", "Other, NO_TOPIC", "ignored", "", "wrong-type"]


@query(f"""
WITH i AS (SELECT DISTINCT o_custkey::VARCHAR AS paper_id FROM orders WHERE o_orderstatus = 'F'), e AS (SELECT o_custkey::VARCHAR AS paper_id, min(coalesce(nullif(trim(regexp_replace({_pick('o_custkey', ['Exclusion reason: too far', '', 'plain'])}, '(?i)^\\s*exclusion reason:\\s*', '')), ''), 'Unspecified Reason')) AS note,
  min({_pick('o_custkey', ['no topic | wrong type', 'no topic', '', '', 'wrong type'])}) AS tag FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey)
SELECT paper_id, 1 AS human_decision, 'Included' AS human_note, '' AS human_tag FROM i UNION ALL SELECT paper_id, 0, note, tag FROM e WHERE paper_id NOT IN (SELECT paper_id FROM i)""")
def human_labels(orders):
    """An included and an excluded sheet of orders' customers."""
    own = orders.select("o_orderstatus", F.concat(F.lit("#"), F.col("o_custkey").cast("string"), F.lit(".0")).alias("paper_id"), _nth("o_custkey", ["Exclusion reason: too far", "", "plain"]).alias("notes"), _nth("o_custkey", _SHEET_TAGS).alias("tags"))
    return validation.human_labels(own.where("o_orderstatus = 'F'"), own.where("o_orderstatus = 'P'"), ["no topic", "wrong type"], ["ignored"])


@query(f"SELECT s_suppkey::VARCHAR AS paper_id, ({_BOOL})::INTEGER AS human_decision, CASE WHEN s_suppkey % 2 = 0 THEN 'said' ELSE 'QC human review' END AS human_note FROM (SELECT s_suppkey, {_pick('s_suppkey', _WORDS)} AS w FROM supplier) WHERE {_BOOL} IS NOT NULL")
def qc_labels(supplier):
    """A reviewer's sheet of the sample."""
    return validation.qc_labels(supplier.select(F.col("s_suppkey").cast("string").alias("paper_id"), _nth("s_suppkey", _WORDS).alias("decision"), F.when(F.col("s_suppkey") % 2 == 0, "said").alias("reason")))


@query("SELECT doc_id, quality = toxic AS decision_match, (doc_id % 3 = 0 AND (toxic = 1 OR doc_id % 4 = 0)) OR (toxic <> 1 AND doc_id % 4 <> 0 AND doc_id % 3 = 1) AS reason_match FROM labels")
def decision_alignment(labels):
    """M9."""
    human = F.when(F.col("doc_id") % 3 == 0, F.array().cast("array<string>")).when(F.col("doc_id") % 3 == 1, F.array(F.lit("x"), F.lit("a"))).otherwise(F.array(F.lit("b")))
    ai = F.when(F.col("doc_id") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("a"), F.lit("b")))
    return labels.select("doc_id", validation.aligned(F.col("quality"), F.col("toxic"), human, ai).alias("m")).select("doc_id", "m.*")


_TYPED = {"integer": (["12", "12.0", "n/a", "many", "7"], ["12.0", "13", None, " Many ", "7.5"]), "boolean": (["Yes", "no", "reported", "", "y"], ["true", None, "1", "none", "false"]), "list": (["a, B;c", "n/a", "x|y", "b", ""], ["C, b; a;a", "", "y", "B ", None]), "string": (["One  two", "N/A", "City park", "x", "not available"], ["one two", "missing", "urban park near", "y", "None"])}
_ABSENT = _in(review.ABSENT)
_SCALAR = f"trim(regexp_replace(lower(trim(coalesce({{x}}, ''))), '[ \\t\\n\\f\\r]+', ' ', 'g'))"
_GONE = f"({{x}} IS NULL OR lower(trim({{x}})) IN ({_ABSENT}))"
_ITEMS = f"list_sort(list_distinct(list_filter(list_transform(string_split(translate(CASE WHEN lower(trim(coalesce({{x}}, ''))) IN ({_ABSENT}) THEN '' ELSE coalesce({{x}}, '') END, ',|' || chr(10), ';;;'), ';'), lambda i: trim(lower(i))), lambda i: i NOT IN ({_in([a for a in review.ABSENT if a != 'missing'])}))))"
_KEYS = {
    "integer": f"CASE WHEN {_GONE} THEN 'not available' ELSE coalesce(try_cast(trim({{x}}) AS DOUBLE)::VARCHAR, {_SCALAR}) END",
    "boolean": f"CASE WHEN NOT {_GONE} AND lower(trim({{x}})) IN ({_in(validation.YES_WORDS)}) THEN 'true' ELSE 'false' END",
    "list": f"array_to_string({_ITEMS}, chr(10))",
    "string": f"CASE WHEN {_GONE} THEN 'not available' ELSE {_SCALAR} END",
}
_GROUPS = [["park", "green space"]]


def _alias_sql(h: str, a: str) -> str:
    form = lambda x: f"trim(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', ' ', 'g'))"
    hit = lambda x, g: "(" + " OR ".join(f"contains({form(x)}, '{t}') OR contains('{t}', {form(x)})" for t in g) + ")"
    return f"({form(h)} <> '' AND {form(a)} <> '' AND (" + " OR ".join(f"({hit(h, g)} AND {hit(a, g)})" for g in _GROUPS) + "))"


@query(" UNION ALL ".join(f"""SELECT c_custkey, '{k}' AS kind, {_KEYS[k].format(x='h')} = {_KEYS[k].format(x='a')} AS same_key, {_KEYS[k].format(x='h')} = {_KEYS[k].format(x='a')} OR {_alias_sql('h', 'a')} AS strict
  FROM (SELECT c_custkey, {_pick('c_custkey', h)} AS h, {_pick('(c_custkey // 5)', a)} AS a FROM customer)""" for k, (h, a) in _TYPED.items()))
def typed_agreement(customer):
    """Every human value of five beside every AI value of five, by type."""
    rows = customer.withColumn("other", F.floor(F.col("c_custkey") / 5).cast("long"))
    out = None
    for k, (h, a) in _TYPED.items():
        human, ai = _nth("c_custkey", h), _nth("other", a)
        one = rows.select("c_custkey", F.lit(k).alias("kind"), (validation.typed_key(human, k) == validation.typed_key(ai, k)).alias("same_key"), validation.strict_match(human, ai, k, _GROUPS).alias("strict"))
        out = one if out is None else out.unionByName(one)
    return out


@query("""
WITH a AS (SELECT o_custkey AS paper_id, max(o_orderstatus) AS v FROM orders GROUP BY 1), h AS (SELECT c_custkey AS paper_id, CASE c_custkey % 4 WHEN 0 THEN 'n/a' WHEN 1 THEN 'F' ELSE 'P' END AS status, c_mktsegment AS segment, CASE WHEN c_custkey % 7 = 0 THEN (c_custkey % 2)::VARCHAR END AS score FROM customer),
c AS (SELECT h.paper_id, 'status' AS variable, status AS human, a.v AS ai, score FROM h LEFT JOIN a USING (paper_id) UNION ALL SELECT h.paper_id, 'segment', segment, CASE WHEN a.paper_id IS NOT NULL THEN upper(segment) END, NULL FROM h LEFT JOIN a USING (paper_id)),
m AS (SELECT *, human <> 'n/a' AS human_present, ai IS NULL AS ai_missing, CASE WHEN human = 'n/a' OR ai IS NULL THEN human = 'n/a' AND ai IS NULL ELSE lower(human) = lower(ai) END AS strict_match FROM c)
SELECT paper_id, variable, human_present, ai_missing, strict_match, coalesce(score = '1', strict_match) AS matched, CASE WHEN score IS NOT NULL THEN 'human_binary_score' ELSE 'normalized_exact_value' END AS match_source FROM m""")
def validated_cells(orders, customer):
    """Two variables of every customer, one with a reviewer's score."""
    k = F.col("c_custkey")
    human = customer.select(k.alias("paper_id"), F.when(k % 4 == 0, "n/a").when(k % 4 == 1, "F").otherwise("P").alias("status"), F.col("c_mktsegment").alias("segment"), F.when(k % 7 == 0, (k % 2).cast("string")).alias("status_score"))
    ai = orders.groupBy(F.col("o_custkey").alias("paper_id")).agg(F.max("o_orderstatus").alias("status")).join(customer.select(k.alias("paper_id"), F.upper("c_mktsegment").alias("segment")), "paper_id")
    return validation.validated_cells(human, ai, [("status", "enum"), ("segment", "string")], quotes=False).drop("quote_aware_match")


# --- plausibility

_SIZES, _VALUES, _QUOTES = ["40", "n/a", "120", "many"], ["12/40 women", "n=30, n=95", "Yes", "", "urban", "7/90", "n/a", "Methods"], ["", "seen n=3", "in 12/40"]
_DIGITS = "regexp_extract({x}, '([0-9]+)', 1)"


@query(f"""
WITH c AS (SELECT c_custkey AS paper_id, 'sample_size' AS variable, 'integer' AS kind, {_pick('c_custkey', _SIZES)} AS value, 'q' AS quote, {_pick('c_custkey', _SIZES)} AS baseline FROM customer
  UNION ALL SELECT c_custkey, 'women', 'string', {_pick('c_custkey', _VALUES)}, {_pick('c_custkey', _QUOTES)}, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE {_pick('c_custkey', _VALUES)} END FROM customer
  UNION ALL SELECT c_custkey, 'urban', 'boolean', {_pick('c_custkey', _VALUES)}, 'q', {_pick('c_custkey', _VALUES[1:] + _VALUES[:1])} FROM customer
  UNION ALL SELECT c_custkey, 'evidence_source', 'enum', {_pick('c_custkey', _VALUES)}, 'q', {_pick('c_custkey', _VALUES)} FROM customer),
s AS (SELECT paper_id, try_cast(nullif({_DIGITS.format(x='value')}, '') AS BIGINT) AS sample FROM c WHERE variable = 'sample_size'),
r AS (SELECT c.*, s.sample, c.paper_id % 3 <> 0 AS known, NOT {_GONE.format(x='value')} AS has, trim(quote) <> '' AS quoted, (NOT {_GONE.format(x='baseline')}) AND c.paper_id % 3 <> 0 AS was, CASE WHEN c.variable = 'women' AND c.paper_id % 2 = 0 THEN 2 ELSE 0 END AS n_hits,
  list_distinct(list_transform(regexp_extract_all(value || ' ' || quote, '[0-9]+\\s*/\\s*([0-9]+)', 1), lambda x: x::BIGINT)) AS under, list_transform(regexp_extract_all(value || ' ' || quote, '(?i)\\bn\\s*=\\s*([0-9]+)', 1), lambda x: x::BIGINT) AS counts, regexp_replace(lower(value), '[^a-z0-9]+', '', 'g') AS k FROM c JOIN s USING (paper_id)),
f AS (SELECT paper_id, variable, unnest([
  CASE WHEN known AND value <> baseline AND was AND NOT has THEN 'high:version_present_to_missing' END, CASE WHEN known AND value <> baseline AND NOT was AND has THEN 'info:version_missing_to_present' END,
  CASE WHEN known AND value <> baseline AND was AND has AND (sample IS NOT NULL OR kind IN ('integer', 'boolean') OR variable = 'evidence_source') THEN 'review:version_changed_present_value' END,
  CASE WHEN has AND kind = 'integer' AND NOT regexp_matches(value, '[0-9]') THEN 'high:schema_integer_not_numeric' END, CASE WHEN has AND kind = 'boolean' AND k NOT IN ('true', 'false', 'yes', 'no') THEN 'review:schema_boolean_unexpected_value' END,
  CASE WHEN has AND variable = 'evidence_source' AND k NOT IN ('urban', 'yes') THEN 'review:schema_allowed_option_unmatched' END, CASE WHEN has AND variable = 'evidence_source' AND ({' OR '.join(f"starts_with(k, '{m.replace(' ', '')}')" for m in validation.SECTION_MARKERS)}) THEN 'review:evidence_source_looks_like_article_section' END,
  CASE WHEN has AND NOT quoted THEN 'review:present_value_without_quote' END, CASE WHEN NOT has AND quoted THEN 'review:missing_value_with_quote' END, CASE WHEN NOT has AND n_hits > 0 THEN CASE WHEN was THEN 'high' ELSE 'review' END || ':missing_value_with_trace_evidence' END,
  CASE WHEN variable <> 'sample_size' AND sample > 0 AND len(under) > 0 AND NOT list_contains(under, sample) THEN 'high:population_denominator_differs_from_sample_size' END,
  CASE WHEN variable <> 'sample_size' AND sample > 0 AND len(counts) >= 2 AND list_sum(counts) > sample THEN 'review:population_counts_exceed_sample_size' END]) AS x FROM r)
SELECT paper_id, 'population' AS domain, variable, split_part(x, ':', 1) AS severity, split_part(x, ':', 2) AS check_name FROM f WHERE x IS NOT NULL
UNION ALL SELECT c_custkey, 'population', 'women', 'review', 'hybrid_rescue_changed_primary_value' FROM customer WHERE c_custkey % 6 = 0""")
def plausibility_rules(customer):
    """Every family of rules over four variables of each customer."""
    k = F.col("c_custkey")
    cell = lambda name, kind, value, quote, baseline, options=(): F.struct(F.lit(name).alias("variable"), F.lit(kind).alias("kind"), F.array(*map(F.lit, options)).cast("array<string>").alias("options"), value.alias("value"), quote.alias("quote"), baseline.alias("baseline"))
    size, value = _nth("c_custkey", _SIZES), _nth("c_custkey", _VALUES)
    cells = customer.select(k.alias("paper_id"), F.lit("population").alias("domain"), F.inline(F.array(
        cell("sample_size", "integer", size, F.lit("q"), size), cell("women", "string", value, _nth("c_custkey", _QUOTES), F.when(k % 5 == 0, "").otherwise(value)),
        cell("urban", "boolean", value, F.lit("q"), _nth("c_custkey", _VALUES[1:] + _VALUES[:1])), cell("evidence_source", "enum", value, F.lit("q"), value, ["Urban", "YES"]),
    )))
    old = cells.where("paper_id % 3 != 0").select("paper_id", "domain", "variable", F.col("baseline").alias("value"))
    traces = customer.where("c_custkey % 2 = 0").select(k.alias("paper_id"), F.lit("population").alias("domain"), F.lit("women").alias("variable"), F.lit(2).alias("n_hits"))
    rescued = customer.where("c_custkey % 3 = 0").select(k.alias("paper_id"), F.lit("population").alias("domain"), F.lit("women").alias("variable"), F.when(k % 2 == 0, "semantic_rescue").otherwise("primary").alias("mode"), F.lit("a").alias("value"), F.lit("b").alias("second"), F.lit("q").alias("quote"), F.lit("q").alias("second_quote"))
    return validation.plausibility(validation.with_baseline(cells.drop("baseline"), old), traces, rescued)


# --- runs and bookkeeping


@query("SELECT round(sum(CASE WHEN s % 4 = 0 THEN 0 ELSE b END), 2) AS tokens, sum(s)::DOUBLE AS seconds, 0.0::DOUBLE AS missing FROM (SELECT s_suppkey AS s, s_acctbal AS b FROM supplier UNION ALL SELECT c_custkey, 0 FROM customer)")
def qc_and_remaining_totals(supplier, customer):
    """Measures kept as texts, some of them no numbers, one run without tokens."""
    a = supplier.select(F.when(F.col("s_suppkey") % 4 == 0, "n/a").otherwise(F.col("s_acctbal").cast("string")).alias("tokens"), F.col("s_suppkey").cast("string").alias("seconds"))
    out = validation.total_of([a, customer.select(F.col("c_custkey").cast("string").alias("seconds"))], ["tokens", "seconds", "missing"])
    return out.withColumn("tokens", F.round("tokens", 2))


@query("SELECT DISTINCT user_id AS paper_id FROM events WHERE event_type IN ('error', 'view')")
def blocked_ids(events):
    """F26."""
    return validation.blocked(events.select(F.col("user_id").alias("paper_id"), F.col("event_type").alias("error_type")), ["error", "view"])


@query(f"SELECT doc_id, len({_TOKENS}) + 100 > 400 AS overflow FROM documents")
def prompt_overflow(documents):
    """F25, P20."""
    return documents.select("doc_id", validation.prompt_overflow(F.size(text.words(F.col("text"))), F.lit(100), F.lit(400)).alias("overflow"))


@query("SELECT c_custkey AS paper_id, f.folder FROM customer LEFT JOIN (SELECT o_custkey AS k, min('f' || o_orderkey) AS folder FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) f ON f.k = c_custkey")
def carried_folders(customer, orders):
    """J9."""
    return validation.carried_folders(customer.select(F.col("c_custkey").alias("paper_id")), orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("paper_id"), F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("folder")))


@query("SELECT event_id, user_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 THEN 'main' ELSE 'retry' END AS role FROM events")
def main_and_retry(events):
    """W14."""
    return validation.main_and_retry(events.select("event_id", "user_id", "ts"), ["user_id"], ["ts", "event_id"]).drop("ts")


@query(f"SELECT s_suppkey, (NOT ({_pick('s_suppkey', _WORDS)} IS NULL OR lower(trim({_pick('s_suppkey', _WORDS)})) IN ({_in(values.MISSING)})))::INTEGER + 1 + 0 AS present FROM supplier")
def present_values(supplier):
    """A26."""
    return supplier.select("s_suppkey", validation.presence([_nth("s_suppkey", _WORDS), F.col("s_name"), F.lit(" N/A ")]).alias("present"))


@query("SELECT coalesce(split_part(p_type, ' ', 1), 'none') AS level, p_brand AS status, count(*) AS n FROM part GROUP BY ALL")
def parser_levels(part):
    """A28, K16."""
    return validation.level_counts(part.select(F.regexp_replace("p_type", " ", ":").alias("parser_level"), F.col("p_brand").alias("status")))


@query("SELECT conv_id AS paper_id, '[' || string_agg('{\"role\":\"' || role || '\",\"size\":' || length(text)::VARCHAR || '}', ',' ORDER BY turn) || ']' AS chunks FROM conversations GROUP BY conv_id")
def chunk_records(conversations):
    """K2."""
    return validation.chunk_records(conversations.select(F.col("conv_id").alias("paper_id"), "turn", "role", F.length("text").alias("size")), "turn")


@query("SELECT event_type, count(*) AS n, max(value) AS most_seconds, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM events GROUP BY event_type")
def split_summary(events):
    """K3."""
    return validation.split_summary(events, "event_type", "value")


_LEAVES = ['{"value": "12", "quote": "q1"}', "plain", '{"value": "n/a", "quote": "q2"}', "", None, '{"value": null, "quote": "q3"}']


@query(f"SELECT s_suppkey, {_pick('s_suppkey', ['12', 'plain', 'none given', 'none given', 'none given', 'none given'])} AS value, {_pick('s_suppkey', ['q1', None, None, None, None, None])} AS quote, {_pick('s_suppkey', ['Not Available', 'plain', 'Not Available'])} AS shown, {_pick('s_suppkey', ['a; b', 'Not Available', 'c'])} AS listed FROM supplier")
def payload_cells(supplier):
    """P37, P39."""
    cell = validation.payload_cell(_nth("s_suppkey", _LEAVES), "none given")
    items = F.when(F.col("s_suppkey") % 3 == 0, F.array(F.lit("a"), F.lit("n/a"), F.lit("b"))).when(F.col("s_suppkey") % 3 == 1, F.array(F.lit(" "))).otherwise(F.array(F.lit("c")))
    return supplier.select("s_suppkey", cell["value"].alias("value"), cell["quote"].alias("quote"), validation.display(_nth("s_suppkey", [" null ", " plain", None])).alias("shown"), validation.display_list(items).alias("listed"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END AS author, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE (2000 + p_size)::VARCHAR END AS year, p_name AS title, p_brand AS base, p_partkey % 8 IN (1, 4) AS vague FROM part")
def filename_parts(part):
    """P47, P50, H64."""
    whole = F.concat("p_brand", F.lit(" - "), (F.col("p_size") + 2000).cast("string"), F.lit(" -  "), "p_name", F.lit(".PDF"))
    meta = validation.filename_metadata(F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(whole))
    return part.select("p_partkey", *[meta[k].alias(k) for k in ("author", "year", "title")], validation.base_source(F.concat("p_brand", F.lit(" | "), "p_type")).alias("base"), validation.vague(_nth("p_partkey", ["12", " Mixed", "3", "x", "YES", "no", "", None])).alias("vague"))


@query("SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_custkey % 3 = 0 THEN 'grid' END, 'watts'], lambda x: x IS NOT NULL), ',') AS gaps FROM customer")
def assumption_gaps(customer):
    """H22."""
    gaps = validation.assumption_gaps({"watts": F.when(F.col("c_custkey") % 2 == 0, " "), "grid": F.when(F.col("c_custkey") % 3 != 0, F.lit(1.5)), "name": F.col("c_name")})
    return customer.select("c_custkey", F.array_join(gaps, ",").alias("gaps"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'context' WHEN c_custkey % 3 = 0 THEN 'assembly' ELSE 'none' END AS drift, CASE WHEN c_custkey % 4 = 0 THEN CASE WHEN c_custkey % 10 > 0 THEN round((c_custkey % 50) * 100 / (c_custkey % 10 * 10)) END
  WHEN c_custkey % 10 < 10 AND c_custkey % 10 > 0 AND round((c_custkey % 50) * 100 / (c_custkey % 10 * 10)) > 30 THEN round((c_custkey % 50) * 100 / (c_custkey % 10 * 10)) ELSE 30 END AS total FROM customer""")
def run_signals(customer):
    """M16, H13."""
    k, same = F.col("c_custkey"), F.lit("h")
    drift = operations.drift([same, F.lit(None).cast("string"), same], [F.when(k % 5 == 0, "x").otherwise("h"), F.lit(None).cast("string"), F.when(k % 3 == 0, "x").otherwise("h")])
    total = operations.total_inference(F.when(k % 4 != 0, 30.0), k % 50, k % 10 * 10)
    return customer.select("c_custkey", drift.alias("drift"), total.cast("double").alias("total"))


@query("SELECT user_id, event_type, coalesce(sum(value), 0) AS used FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL")
def merged_usage(events):
    """Two maps of usage, by user, added by key."""
    one = lambda t: events.where(F.col("event_type") == t).groupBy("user_id").agg(F.create_map(F.lit(t), F.sum("value")).alias(t))
    none = F.create_map().cast("map<string,double>")
    both = one("click").join(one("view"), "user_id", "full").select("user_id", operations.merge_usage(F.coalesce("click", none), F.coalesce("view", none)).alias("m"))
    return both.select("user_id", F.explode("m").alias("event_type", "used"))


@query("SELECT doc_id, human, CASE WHEN ai THEN 1 END AS ai, CASE WHEN NOT ai THEN 'UNDECIDED' WHEN human = 0 THEN 'FP' END AS mismatch FROM (SELECT doc_id, quality AS human, toxic = 0 AS ai FROM labels) WHERE NOT (ai AND human = 1)")
def undecided_answers(labels):
    """M10, A22 with answers that cannot be read."""
    return operations.mismatches(labels.select("doc_id", F.col("quality").alias("human"), F.when(F.col("toxic") == 0, 1).alias("ai")))


@query("SELECT o_orderkey, o_orderdate + INTERVAL 3 HOUR + INTERVAL 4 MINUTE + INTERVAL 5 SECOND AS made FROM orders")
def run_stamps(orders):
    """The time in a file name."""
    name = F.concat(F.lit("run_x_"), F.date_format("o_orderdate", "yyyyMMdd"), F.when(F.col("o_orderkey") % 2 == 0, "_").otherwise("-"), F.lit("030405.jsonl"))
    return orders.select("o_orderkey", operations.stamp(name).alias("made"))


@query("SELECT o_custkey::VARCHAR AS run_id, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS size FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 UNION ALL SELECT DISTINCT o_custkey::VARCHAR, -1 FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def run_catalogue(orders):
    """K4, H9: an index whose runs are replaced by the newest file of each."""
    index = orders.select(F.col("o_custkey").cast("string").alias("run_id"), F.col("o_orderdate").alias("modified"), F.lit("old").alias("path"), F.lit(-1).cast("long").alias("size")).dropDuplicates(["run_id"])
    rows = orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").cast("string").alias("run_id"), F.col("o_orderdate").alias("modified"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("path"), F.col("o_orderkey").alias("size"))
    return operations.catalogue(index, rows).select("run_id", "size")


@query("SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def common_columns(customer, supplier):
    """U1."""
    return relational.common_union(customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), "c_mktsegment"), supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), "s_acctbal"))


@query("SELECT c_custkey FROM customer ORDER BY sha256('pilot' || c_custkey::VARCHAR), c_custkey LIMIT (SELECT greatest(1, ceil(count(*) * 0.01))::BIGINT FROM customer)")
def pilot_sample(customer):
    """T14."""
    return relational.hash_sample(customer.select("c_custkey"), "c_custkey", 0.01, "pilot")


# --- human review

_RESCUED = """SELECT p_partkey, p_brand AS domain, CASE WHEN p_size % 3 = 0 THEN 'semantic_rescue' ELSE 'primary' END AS mode, p_name AS value, CASE WHEN p_size % 2 = 0 THEN p_name ELSE p_type END AS second, 'q' AS quote, CASE WHEN p_size % 5 = 0 THEN 'r' ELSE 'q' END AS second_quote FROM part"""


def _rescued(part: DataFrame) -> DataFrame:
    size = F.col("p_size")
    return part.select("p_partkey", F.col("p_brand").alias("domain"), F.when(size % 3 == 0, "semantic_rescue").otherwise("primary").alias("mode"), F.col("p_name").alias("value"), F.when(size % 2 == 0, F.col("p_name")).otherwise(F.col("p_type")).alias("second"), F.lit("q").alias("quote"), F.when(size % 5 == 0, "r").otherwise("q").alias("second_quote"))


@query(f"SELECT p_partkey FROM ({_RESCUED}) WHERE mode = 'semantic_rescue' AND (value <> second OR quote <> second_quote)")
def rescue_changes(part):
    """H30."""
    return review.changed(_rescued(part)).select("p_partkey")


@query(f"SELECT p_partkey, CASE WHEN mode = 'semantic_rescue' THEN second ELSE value END AS value, CASE WHEN mode = 'semantic_rescue' THEN second_quote ELSE quote END AS quote FROM ({_RESCUED})")
def rescue_applied(part):
    """H96."""
    return review.apply_rescue(_rescued(part)).select("p_partkey", "value", "quote")


@query(f"SELECT domain, mode, count(*) AS n FROM ({_RESCUED}) GROUP BY ALL")
def rescue_tally(part):
    """H65."""
    return review.rescue_counts(_rescued(part))


@query("SELECT p_partkey FROM part WHERE p_brand = 'Brand#11' OR p_brand = 'Brand#13' OR p_size % 4 = 0 OR p_size % 7 = 0")
def rescue_targets(part):
    """M12."""
    cells = part.select("p_partkey", F.col("p_brand").alias("path"), F.col("p_brand").alias("domain"), F.when(F.col("p_size") % 4 == 0, " N/A").otherwise(F.col("p_name")).alias("value"), F.when(F.col("p_size") % 7 == 0, "").otherwise("q").alias("quote"))
    return review.rescue_targets(cells, ["Brand#11"], ["Brand#13"]).select("p_partkey")


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 1 WHEN 'O' THEN 3 END, length(o_orderkey::VARCHAR), o_orderkey::VARCHAR) AS place FROM orders")
def finding_order(orders):
    """T15, T17."""
    from pyspark.sql import Window

    rows = orders.select("o_orderkey", "o_custkey", F.col("o_orderkey").cast("string").alias("id"), F.when(F.col("o_orderstatus") == "F", "high").when(F.col("o_orderstatus") == "P", "review").otherwise("odd").alias("severity"))
    return rows.select("o_orderkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy(*review.by_severity(), *review.by_id("id"))).cast("long").alias("place"))


_NUMBERS = ["12.0", " 7", "3.25", "x", "", None, "-4"]


@query(f"SELECT s_suppkey, {_pick('s_suppkey', ['12', '7', '3.25', None, None, None, '-4'])} AS number FROM supplier")
def number_texts(supplier):
    """H6."""
    return supplier.select("s_suppkey", review.number_text(_nth("s_suppkey", _NUMBERS)).alias("number"))


@query("SELECT o_custkey AS paper_id, v AS variable, max_by(CASE WHEN v = 'status' THEN o_orderstatus ELSE o_orderpriority END, o_orderkey) AS value FROM orders, (SELECT unnest(['status', 'priority']) AS v) GROUP BY ALL")
def consensus_cells(orders):
    """The last row of each id, a row a variable."""
    sheet = orders.select(F.col("o_custkey").alias("paper_id"), "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    return review.consensus_cells(sheet, "paper_id", "o_orderkey", ["status", "priority"])


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_custkey = 7")
def reports_of_a_paper(orders):
    """H36."""
    rows = orders.select("o_orderkey", F.concat(F.lit(" "), "o_orderstatus").alias("decision"), F.col("o_custkey").cast("string").alias("paper_id"))
    return review.with_decisions(rows, ["f", "p"], "7").select("o_orderkey")


@query("SELECT p_partkey, contains(' ' || lower(p_name) || ' ', ' green ') OR contains(' ' || lower(p_name) || ' ', ' sky blue ') AS named FROM part")
def domain_blocks(part):
    """J22."""
    return part.select("p_partkey", review.block_match(F.regexp_replace(F.upper("p_name"), " ", " - "), ["Green", "sky-blue"]).alias("named"))


_TRACE = "paper_id: #{} \nx\n=== Evidence Hint Search For Missing Fields ===\n[a.b] search_terms=x\n  L3: found a thing\n  L9: ......\n[c.d] search_terms=y\n  L1: open access text\n=== End ===\n[e.f] search_terms=z\n  L1: no"


@query("SELECT s_suppkey::VARCHAR AS paper_id, f AS field_path, CASE WHEN f = 'a.b' THEN 1 ELSE 0 END AS n_hits, CASE WHEN f = 'a.b' THEN 'found a thing' ELSE '' END AS first_hit FROM supplier, (SELECT unnest(['a.b', 'c.d']) AS f)")
def trace_evidence(supplier):
    """S21, F21."""
    head, tail = _TRACE.split("{}")
    return review.trace_evidence(supplier.select(F.concat(F.lit(head), F.col("s_suppkey").cast("string"), F.lit(tail)).alias("text")))


# --- evidence and prompts

_MARKED = "regexp_matches(x, '(?i)token')"


@query(f"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL), h AS (SELECT doc_id, a, list_filter(range(1, len(a) + 1), lambda i: regexp_matches(a[i], '(?i)token')) AS hit_at FROM l)
SELECT doc_id, md5(array_to_string(list_transform(hit_at, lambda i: array_to_string(list_slice(a, greatest(i - 1, 1), i + 2), chr(10))), '|')) AS lines_md5, len(hit_at) AS n FROM h""")
def lines_around_hits(documents):
    """W10."""
    c = evidence.context_lines(F.col("text"), "(?i)token")
    return documents.where("text is not null").select("doc_id", F.md5(F.array_join(c, "|")).alias("lines_md5"), F.size(c).cast("long").alias("n"))


_LONG = ["green", "blue", "sky blue", "a+b"]


@query("SELECT p_partkey, regexp_matches(p_name, '(?i)\\b(?:sky blue|green|a\\+b|blue)\\b') AS whole, regexp_matches(p_name, '(?i)(?:sky blue|green|a\\+b|blue)') AS within FROM part")
def compiled_terms(part):
    """R15."""
    return part.select("p_partkey", F.col("p_name").rlike(evidence.term_pattern(_LONG, True)).alias("whole"), F.col("p_name").rlike(evidence.term_pattern(_LONG)).alias("within"))


@query("SELECT p_partkey, 'n = ' || p_size || ', N=' || p_partkey AS told, p_size + p_partkey AS total FROM part")
def sample_sizes(part):
    """R23."""
    told = F.concat(F.lit("n = "), F.col("p_size").cast("string"), F.lit(", N="), F.col("p_partkey").cast("string"))
    return part.select("p_partkey", told.alias("told"), F.aggregate(evidence.labelled_counts(told), F.lit(0), lambda z, x: z + x).cast("long").alias("total"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_brand WHEN p_size % 3 = 1 THEN p_type ELSE p_name || '|' || p_brand END AS context FROM part")
def quoted_contexts(part):
    """J20."""
    chunks = F.array("p_name", "p_brand", "p_type")
    quote = F.when(F.col("p_size") % 3 == 0, F.substring("p_brand", 3, 9)).when(F.col("p_size") % 3 == 1, F.col("p_type")).otherwise("not there")
    return part.select("p_partkey", F.array_join(evidence.quoted_context(chunks, quote), "|").alias("context"))


@query("SELECT p_partkey, p_brand || CASE WHEN p_size % 2 = 0 THEN ' | section=' || p_brand ELSE '' END || ' | page=' || p_size || CASE WHEN p_size % 3 = 0 THEN ' | line=' || p_partkey ELSE '' END AS label, CASE WHEN p_size % 4 = 0 THEN 'pNA' WHEN p_size % 4 = 1 THEN 'p' || p_size ELSE 'p' || p_size || '-' || (p_size + 2) END AS tag FROM part")
def chunk_labels(part):
    """H34, H40."""
    size = F.col("p_size")
    label = evidence.chunk_label(F.col("p_brand"), F.when(size % 2 == 0, F.col("p_brand")), size, F.when(size % 3 == 0, F.col("p_partkey")))
    return part.select("p_partkey", label.alias("label"), signals.page_tag(F.when(size % 4 != 0, size), F.when(size % 4 == 1, size).otherwise(size + 2)).alias("tag"))


@query(f"SELECT doc_id, regexp_matches(text, 'thing') AND regexp_matches(text, 'token') AND NOT regexp_matches(text, '[0-9]') AS monitoring_only FROM documents WHERE text IS NOT NULL")
def monitoring_texts(documents):
    """F10."""
    return documents.where("text is not null").select("doc_id", signals.monitoring_only(F.col("text"), "thing", "token", "[0-9]").alias("monitoring_only"))


_COUNTED = "len(list_filter({t}, lambda w: w = '{w}'))"
_LOWER = _TOKENS.replace("text", "lower(text)")


@query(f"SELECT doc_id, round(1.5 * {_COUNTED.format(t=_LOWER, w='the')} + 0.5 * {_COUNTED.format(t=_LOWER, w='and')} - 2.0 * {_COUNTED.format(t=_LOWER, w='der')} + 0.25 - CASE WHEN doc_id % 20 > 10 THEN 0.5 ELSE 0.0 END + least(len({_LOWER}) / 200.0, 1.0), 6) AS score FROM documents")
def term_scores(documents):
    """R25."""
    score = signals.term_score(F.col("text"), {"the": 1.5, "and": 0.5}, {"der": 2.0}, F.lit(0.25), F.pmod("doc_id", F.lit(20)))
    return documents.select("doc_id", F.round(score, 6).alias("score"))


@query(f"SELECT doc_id, length(trim(coalesce(text, ''), ' ')) / 7 >= 100 AS dense, len({_CONTENT.format(x='text')}) AS n_tokens FROM documents")
def dense_texts(documents):
    """F12, M3."""
    return documents.select("doc_id", contexts.dense(F.col("text"), F.lit(7)).alias("dense"), F.size(values.content_tokens(F.coalesce("text", F.lit("")))).cast("long").alias("n_tokens"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN '' ELSE 'Head' || chr(10) || chr(10) END || p_name || chr(10) || chr(10) || p_type AS context, CASE WHEN p_size % 3 = 0 THEN p_type ELSE p_name END AS first,
  'Paper ID: ' || p_partkey || chr(10) || 'Title: ' || p_name || chr(10) || CASE WHEN p_size % 2 = 0 THEN 'Abstract: ' || p_type || chr(10) ELSE '' END || 'LLM Decision: ' || p_brand || chr(10) AS summary FROM part""")
def assembled_texts(part):
    """P43, H42, H50, H67, H68."""
    size = F.col("p_size")
    context = contexts.full_text_context(F.when(size % 2 == 1, "Head "), F.col("p_name"), F.lit("  "), F.col("p_type"))
    first = contexts.first_text(F.lit(None).cast("string"), F.when(size % 3 != 0, F.col("p_name")).otherwise(" "), F.col("p_type"))
    return part.select("p_partkey", context.alias("context"), first.alias("first"), contexts.summary(F.col("p_partkey"), F.col("p_name"), F.when(size % 2 == 0, F.col("p_type")), F.col("p_brand")).alias("summary"))


@query("SELECT p_partkey, len(list_distinct(string_split(lower(p_name || ' ' || p_name || ' x'), ' '))) AS n FROM part")
def casefold_distinct(part):
    """U6."""
    return part.select("p_partkey", F.size(contexts.distinct_casefold(F.split(F.concat("p_name", F.lit(" "), F.upper("p_name"), F.lit(" x")), " "))).cast("long").alias("n"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name || chr(10) || chr(10) || c_mktsegment WHEN 1 THEN c_name || chr(10) || c_mktsegment ELSE c_name || chr(10) || ' ' || chr(9) || chr(10) || c_mktsegment END AS t FROM customer")
def blank_lines(customer):
    """W16."""
    gap = _nth("c_custkey", ["\n\n\n \n", "\n", "\n \t\n"])
    return customer.select("c_custkey", contexts.single_blank_lines(F.concat("c_name", gap, "c_mktsegment")).alias("t"))


_KEYS_OF = ["no_topic", "Wrong Type", "confidence_score", "urban_context", "outside area", "title", "is_eligible"]


@query(f"SELECT s_suppkey, s_suppkey % 7 IN (0, 1, 3, 4) AS is_flag FROM supplier")
def exclusion_keys(supplier):
    """P15."""
    return supplier.select("s_suppkey", contexts.exclusion_key(_nth("s_suppkey", _KEYS_OF)).alias("is_flag"))


@query("SELECT p_partkey, 'name=' || p_name || ',type=' || p_type AS kept FROM part")
def without_authors(part):
    """P13."""
    m = F.create_map(F.lit("name"), F.col("p_name"), F.lit("authors"), F.col("p_brand"), F.lit("type"), F.col("p_type"))
    kept = contexts.without_keys(m, ["authors"])
    return part.select("p_partkey", F.array_join(F.transform(F.array_sort(F.map_entries(kept)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("kept"))


_REASONINGS = ['{"step_by_step_deliberation": "plain words"}', '{"step_by_step_deliberation": {"Logic": " so it is ", "other": "x"}}', '{"step_by_step_deliberation": {"a": "one", "b": 2, "c": " two "}}', '{"other": 1}', "not json"]


@query(f"SELECT s_suppkey, {_pick('s_suppkey', ['plain words', 'so it is', 'one two', None, None])} AS reasoning FROM supplier")
def reasonings(supplier):
    """P44."""
    return supplier.select("s_suppkey", contexts.deliberation(_nth("s_suppkey", _REASONINGS)).alias("reasoning"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'abstract_missing_or_placeholder' END AS why, CASE WHEN c_custkey % 3 = 0 THEN 'insufficient_context' END AS reason FROM customer")
def decisions_without_context(customer):
    """H48, F13."""
    why = contexts.missing_abstract(F.lit("no"), F.when(F.col("c_custkey") % 3 == 0, " N/A").otherwise(F.col("c_name")))
    out = contexts.insufficient_context(why, ["no_topic", "insufficient_context"])
    return customer.select("c_custkey", why.alias("why"), F.get_json_object(out, "$.exclusion_reason_category").alias("reason"))


@query("SELECT p_partkey, 'say so' || chr(10) || substr(p_name, 1, greatest(0, 4500 - 6)) || CASE WHEN true THEN chr(10) || p_type ELSE '' END AS signal FROM part")
def signal_texts(part):
    """H53."""
    return part.select("p_partkey", contexts.signal_text(F.array(F.lit(" say so "), F.lit("")), F.array(F.col("p_name"), F.lit(" "), F.col("p_type"))).alias("signal"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'no_green_space' WHEN p_size % 3 = 1 THEN 'wanted' END AS absence FROM part")
def absence_keys(part):
    """H59."""
    keys = F.when(F.col("p_size") % 3 == 0, F.array(F.lit("No Green-Space"), F.lit("not_urban"), F.lit("no_zoo"))).when(F.col("p_size") % 3 == 1, F.array(F.lit("no_green_space"), F.lit("Wanted"))).otherwise(F.array(F.lit("no_zoo"), F.lit("not_green")))
    return part.select("p_partkey", contexts.absence_key(keys, ["Green space", "a b"], "wanted").alias("absence"))


@query("SELECT p_partkey, regexp_matches(p_name, '(?i)green') AND NOT p_size % 2 = 0 AS method FROM part")
def method_texts(part):
    """a method section, or its words, and not only observed."""
    label = F.when(F.col("p_name").rlike("(?i)green"), "Methods").otherwise("Results")
    return part.select("p_partkey", contexts.method_evidence(label, F.col("p_type"), F.col("p_size") % 2 == 0).alias("method"))


@query("SELECT c_custkey AS paper_id, k.kind || '::' || k.i AS part, k.s AS text FROM (SELECT c_custkey, unnest([{'kind': 'title', 'i': 0, 's': c_name}, {'kind': 'abstract', 'i': 0, 's': c_mktsegment}, {'kind': 'abstract', 'i': 1, 's': 'end'}]) AS k FROM customer)")
def record_chunks(customer):
    """R6."""
    chunks = contexts.sentence_chunks(F.col("c_custkey"), F.array("c_name"), F.array(F.lit(" "), F.col("c_mktsegment"), F.lit("end ")))
    out = customer.select(F.col("c_custkey").alias("paper_id"), F.inline(chunks))
    return out.select("paper_id", F.concat("kind", F.lit("::"), F.split_part("chunk_id", F.lit("::"), F.lit(3)).cast("int").cast("string")).alias("part"), "text")


# --- values

_FACTS = ["40 adults walked in the green park", "about 41 adult walkers in parks", "park green adults 12", "nothing alike here", "green park"]


@query(f"""
WITH c AS (SELECT c_custkey, {_pick('c_custkey', _FACTS)} AS h, {_pick('(c_custkey // 5)', _FACTS)} AS a FROM customer), t AS (SELECT *, {_CONTENT.format(x='h')} AS x, {_CONTENT.format(x='a')} AS y, list_transform(regexp_extract_all(h, '[0-9]+(?:\\.[0-9]+)?'), lambda v: v::DOUBLE) AS hn, list_transform(regexp_extract_all(a, '[0-9]+(?:\\.[0-9]+)?'), lambda v: v::DOUBLE) AS an FROM c),
s AS (SELECT *, least(len(x), len(y)) AS least_n, len(list_intersect(x, y)) / least(len(x), len(y)) AS share, coalesce(list_bool_or(flatten(list_transform(hn, lambda v: list_transform(an, lambda w: abs(v - w) <= greatest(0.5, abs(v) * 0.05))))), false) AS numbers FROM t)
SELECT c_custkey, numbers, least_n >= 2 AND (share >= CASE WHEN least_n <= 4 THEN 0.50 ELSE 0.42 END OR (numbers AND share >= greatest(0.25, CASE WHEN least_n <= 4 THEN 0.50 ELSE 0.42 END - 0.15))) AS factual FROM s""")
def factual_matches(customer):
    """M4, M5."""
    rows = customer.withColumn("other", F.floor(F.col("c_custkey") / 5).cast("long"))
    h, a = _nth("c_custkey", _FACTS), _nth("other", _FACTS)
    return rows.select("c_custkey", values.numbers_overlap(h, a).alias("numbers"), values.factual_match(h, a).alias("factual"))


_TRUTHS, _AI = ["green park", "n/a", "40 adults", "city"], ["a green park nearby", "", "41 adults", "village"]


@query(f"""
WITH c AS (SELECT c_custkey, c_custkey % 4 AS t, (c_custkey // 4) % 4 AS v, (c_custkey // 16) % 2 AS n FROM customer)
SELECT c_custkey, (t = 0 AND v = 0) OR (t = 1 AND v = 1) OR (t = 2 AND v = 2) OR t = 3 OR n = 1 AS matched FROM c""")
def quote_aware_cells(customer):
    """M7: value or quote against truth or note; the quote names the city."""
    rows = customer.withColumns({"v": F.floor(F.col("c_custkey") / 4).cast("long"), "n": F.floor(F.col("c_custkey") / 16) % 2})
    note = F.when(F.col("n") == 1, "seen in the city")
    return rows.select("c_custkey", review.quote_cell_match(_nth("c_custkey", _TRUTHS), _nth("v", _AI), F.lit("in the city"), note)["matched"].alias("matched"))


@query("SELECT s_suppkey, 'population.size_value' AS name, s_suppkey::VARCHAR AS value FROM supplier UNION ALL SELECT s_suppkey, 'population.groups_value', 'a; ' || s_name FROM supplier")
def flattened_results(supplier):
    """A nested result of a compiled schema as names and texts."""
    variables = [{"domain": "population", "variable_name": n, "variable_type": t, "instruction": "x"} for n, t in (("size", "int"), ("groups", "list"))]
    schema = extraction.compile_schema(variables)
    nested = F.struct(F.struct(F.col("s_suppkey").cast("long").alias("size_value"), F.lit(None).cast("string").alias("size_quote"), F.array(F.lit("a"), F.col("s_name")).alias("groups_value"), F.lit(None).cast("string").alias("groups_quote")).alias("population"))
    flat = supplier.select("s_suppkey", nested.cast(schema).alias("r")).select("s_suppkey", *extraction.flatten(schema, "r"))
    return flat.unpivot("s_suppkey", ["`population.size_value`", "`population.groups_value`"], "name", "value").withColumn("name", F.regexp_replace("name", "`", ""))


# --- selection of passages

CUES = {"action": "(?i)a[eo]", "primary": "(?i)[ou]r", "secondary": "(?i)en", "watched": "(?i)thing"}


def passages(documents: DataFrame) -> DataFrame:
    """Each line of a document as a passage of it, with similarities drawn by a hash; every fifth line is one set aside."""
    lines = documents.where("text is not null").select(F.col("doc_id").alias("paper_id"), F.posexplode(F.split("text", "\n")).alias("line", "text"))
    draw = lambda salt: F.pmod(F.xxhash64("paper_id", "line", F.lit(salt)), F.lit(1000)) / 10000
    own = F.array(*[F.lit(s) for s in ("", "methods", "results", "references", "introduction", "conclusion", "discussion")])
    label = F.when(F.col("line") % 3 == 0, F.element_at(own, (F.col("line") / 3 % 7 + 1).cast("int"))).otherwise("")
    return lines.select(
        "paper_id", F.concat_ws("::", F.col("paper_id").cast("string"), F.lpad(F.col("line").cast("string"), 6, "0")).alias("chunk_id"), F.when(F.col("line") == 0, "title").otherwise("full_text").alias("kind"), label.alias("section"), "text",
        (F.col("line") / 4 + 1).cast("int").alias("page"), "line", (F.size(F.split("text", "[.!?]")) - 1).alias("sentences"), draw("s").alias("score"), draw("p").alias("pos_score"), draw("n").alias("neg_score"), (F.col("line") % 5 == 4).alias("extra"),
    )


@query()
def passage_selection(documents):
    """T5 with T2, T3, T4, T6, T7, T8, T9, J19 and W13: the lines of each document as its passages."""
    out = selection.select(passages(documents), **CUES)
    return out.withColumn("sources", F.array_join("sources", ","))


@query()
def passage_priority(documents):
    """Each passage's place by priority and its hybrid score."""
    rows = selection.prepared(passages(documents), **CUES).select("paper_id", F.posexplode("rows").alias("p", "r"))
    return rows.select("paper_id", (F.col("p") + 1).alias("place"), F.col("r.chunk_id").alias("chunk_id"), F.round("r.hybrid", 6).alias("hybrid_score"))


# --- examples and hints


@query("""
WITH w AS (SELECT p_partkey, list_transform(regexp_extract_all(lower('Dom ' || replace(p_name, '_', ' ') || ' ' || p_type || ' the x-ray'), '[A-Za-z][A-Za-z0-9+\\-]{2,}'), lambda x: regexp_replace(x, '^-+|-+$', '', 'g')) AS l FROM part),
d AS (SELECT p_partkey, list_concat(['alias one'], list_filter(l, lambda x: x NOT IN ('the', ''))) AS l FROM w)
SELECT p_partkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i)[1:4], ',') AS terms FROM d""")
def variable_terms(part):
    """R14, T18."""
    terms = bootstrap.search_terms(F.array(F.lit("alias one")), [F.lit("Dom"), F.col("p_name"), F.lit(None).cast("string"), F.col("p_type"), F.lit("the x-ray")], ["the"], 4)
    return part.select("p_partkey", F.array_join(terms, ",").alias("terms"))


@query("""
WITH h AS (SELECT p_brand, p_partkey AS pos, p_type AS domain, r.r AS rank, repeat('x', p_size::INTEGER + r.r) AS line FROM part, (SELECT unnest([0, 1]) AS r) r),
o AS (SELECT *, lag(rank) OVER w IS NULL OR lag(rank) OVER w <> rank OR lag(domain) OVER w <> domain AS opens FROM h WINDOW w AS (PARTITION BY p_brand ORDER BY rank, pos)),
u AS (SELECT *, 10 + sum(length(line) + CASE WHEN opens THEN length('Domain: ' || domain) ELSE 0 END) OVER (PARTITION BY p_brand ORDER BY rank, pos) AS upto FROM o)
SELECT p_brand, rank, pos, opens AS opens_domain, row_number() OVER (PARTITION BY p_brand ORDER BY rank, pos) AS place FROM u WHERE upto <= 3500""")
def hint_budget(part):
    """Two hints of every part of a brand, its type as their domain."""
    own = part.select("p_brand", F.col("p_partkey").alias("variable_pos"), F.col("p_type").alias("domain"), F.explode(F.array(F.lit(0), F.lit(1))).alias("rank"), F.col("p_size").cast("int").alias("q"))
    hints = own.select("p_brand", "variable_pos", "domain", "rank", F.expr("repeat('x', q + rank)").alias("line"))
    return bootstrap.breadth_first(hints, ["p_brand"], 3500, 10).select("p_brand", "rank", F.col("variable_pos").alias("pos"), "opens_domain", F.col("place").cast("long").alias("place"))


@query("""
WITH c AS (SELECT c_nationkey, c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 11 > 0 THEN c_custkey % 7 END AS page, c_acctbal / 20 AS score FROM customer), n AS (SELECT *, count(*) OVER (PARTITION BY c_nationkey) > 40 AS plenty FROM c),
l AS (SELECT *, score < -30 OR (plenty AND page IS NOT NULL AND row_number() OVER (PARTITION BY c_nationkey, page, score >= -30 ORDER BY score DESC, id) > 1) AS late FROM n),
r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY late, score DESC, id) AS place FROM l) SELECT c_nationkey, id AS chunk_id, late, place FROM r WHERE place <= 10""")
def diverse_passages(customer):
    """Customers as the passages of their nation."""
    chunks = customer.select("c_nationkey", F.col("c_custkey").cast("string").alias("chunk_id"), F.when(F.col("c_custkey") % 11 > 0, F.col("c_custkey") % 7).alias("page"), (F.col("c_acctbal") / 20).alias("score"))
    return bootstrap.diverse_passages(chunks, ["c_nationkey"], 10).select("c_nationkey", "chunk_id", "late", F.col("place").cast("long").alias("place"))


_SIGNALS, _AGAINST = ["thing", "token", "the "], ["not", "sample"]
_WORDS_OF = "regexp_extract_all({x}, '[A-Za-z0-9][A-Za-z0-9''/_\\-]*')"


def _hits_sql(words: list[str]) -> str:
    return " + ".join(f"contains(lower(t), '{w}')::INTEGER" for w in words)


@query(f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS_OF.format(x="coalesce(text, '')")} AS w FROM documents),
m AS (SELECT *, len(w) AS n, greatest(length(t), 1) AS size, length(array_to_string(w, '')) / greatest(len(w), 1) AS avg_len, len(list_filter(w, lambda x: length(x) <= 2)) / greatest(len(w), 1) AS short,
  len(regexp_extract_all(t, '[0-9]')) / greatest(length(t), 1) AS digits, len(regexp_extract_all(t, '[^\\p{{L}}\\p{{N}} .,;:!?()\\[\\]{{}}\\-_/''"]')) / greatest(length(t), 1) AS bad, len(regexp_extract_all(t, '\\p{{L}}')) / greatest(length(t), 1) AS alpha,
  {_hits_sql(_SIGNALS)} + {_hits_sql(_AGAINST)} AS hits, regexp_matches(lower(t), 'et al') AS ref, regexp_matches(lower(t), 'license') AS low FROM d)
SELECT doc_id, n AS word_count, CASE WHEN n > 0 THEN hits ELSE 0 END AS signal_hits, round(CASE WHEN n > 0 THEN hits * 2.0 + least(n, 160) / 80.0 - short * 5.0 - digits * 2.0 - bad * 30.0 + alpha * 1.5 + least(avg_len, 7.0) / 4.0 - CASE WHEN ref THEN 6.0 ELSE 0.0 END - CASE WHEN low THEN 5.0 ELSE 0.0 END ELSE -999.0 END, 6) AS score FROM m""")
def window_quality(documents):
    """R24."""
    m = bootstrap.window_quality(F.col("text"), _SIGNALS, _AGAINST, {"method": ["method"]}, "et al", "license")
    return documents.select("doc_id", m["word_count"].cast("long").alias("word_count"), m["signal_hits"].cast("long").alias("signal_hits"), F.round(m["score"], 6).alias("score"))


@query("""
WITH p AS (SELECT p_partkey, lower(p_type) || ' ' || lower(p_name) AS b, p_name FROM part), f AS (SELECT *, list_filter(['green', 'ring', 'steel', 'blue', 'anvil'], lambda x: contains(b, x))[1:4] AS l, list_filter(['green', 'ring'], lambda x: contains(lower(p_name), x)) AS tags FROM p)
SELECT p_partkey, CASE WHEN len(l) > 0 THEN 'terms: ' || array_to_string(l, ', ') ELSE 'weak fit' END AS reason, CASE WHEN len(tags) > 0 THEN array_to_string(tags, ', ') ELSE 'general' END AS tags FROM f""")
def example_reasons(part):
    """H37, H38."""
    chunks = part.select(F.col("p_partkey").cast("string").alias("paper_id"), F.col("p_type").alias("title"), F.col("p_name").alias("text"), F.lit(3).alias("page"))
    out = bootstrap.example_rows(chunks, "NEG", [], ["green", "ring", "steel", "blue", "anvil"], ["green", "ring"])
    return out.select(F.split_part("source", F.lit(" | "), F.lit(1)).cast("long").alias("p_partkey"), "reason", "tags")


@query("SELECT doc_id, len(list_filter(regexp_extract_all(lower(text), '[a-z][a-z0-9\\-]{2,}'), lambda w: w NOT IN ('the', 'and', ''))) AS n FROM documents WHERE text IS NOT NULL")
def example_tokens(documents):
    """H39."""
    return documents.where("text is not null").select("doc_id", F.size(bootstrap.example_tokens(F.col("text"), ["the", "and"])).cast("long").alias("n"))


@query("SELECT p_partkey, least(p_size, least(p_partkey % 9, 4) + greatest(p_partkey % 5 - p_partkey % 3, 0)) AS positives, least(p_partkey % 9, 4) AS negatives FROM part")
def draft_balance(part):
    """H91."""
    k = F.col("p_partkey")
    pos, neg = bootstrap.needed(F.col("p_size").cast("long"), k % 9, k % 3, k % 5, 4)
    return part.select("p_partkey", pos.alias("positives"), neg.alias("negatives"))


_AUTHORS = ["Smith, John; Doe, J.", "Ann O'Neil", "", None, "van den Berg, A", "Li; Wu"]


@query(f"SELECT s_suppkey, {_pick('s_suppkey', ['smith', 'ann', '', '', 'vandenberg', 'li'])} AS surname, {_pick('s_suppkey', ['qc_sample', 'remaining_sample', 'remaining_sample', 'qc_sample', None])} AS run FROM supplier")
def surnames_and_runs(supplier):
    """P26, H16."""
    k = F.col("s_suppkey")
    run = bootstrap.run_label(_nth("s_suppkey", ["x_QC_sample.csv", "remaining_sample.csv", "a", "b", "c"]), k % 5 == 2, k % 5 == 3)
    return supplier.select("s_suppkey", bootstrap.first_surname(_nth("s_suppkey", _AUTHORS)).alias("surname"), run.alias("run"))


@query("SELECT c_custkey::VARCHAR AS \"Covidence #\", c_name AS \"TITLE\", '' AS other FROM customer")
def metadata_rows(customer):
    """H26."""
    return customer.select(*bootstrap.metadata_row(["Covidence #", "TITLE", "other"], {"covidence": F.col("c_custkey"), "Title": F.col("c_name")}))


@query()
def composite_linkage(part):
    """Parts beside files named for their brand, size and the first word of their name; the ratio has no SQL."""
    t = part.select(F.col("p_partkey").cast("string").alias("target_id"), F.regexp_replace(F.lower("p_brand"), "[^a-z0-9]", "").alias("author"), (F.col("p_size") + 1950).cast("string").alias("year"), F.col("p_name").alias("title"))
    o = part.where("p_partkey % 3 = 0").select(F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("other_id"), F.concat_ws(" ", F.regexp_replace(F.lower("p_brand"), "#", " "), (F.col("p_size") + 1950).cast("string"), "p_name").alias("name"), (F.col("p_size") + 1950).cast("string").alias("year"))
    return bootstrap.best_links(t, o, Scratch(part.sparkSession, "links"))


# --- ids, scores and records

_RAW = ["One–two; “THREE” (4)", "snake_case/x", None, "Café: 50% +1", "a|b,c"]


@query(f"SELECT s_suppkey, {_pick('s_suppkey', ['one-two three 4', 'snake case x', '', 'cafe 50% +1', 'a b c'])} AS plain, {_pick('s_suppkey', ['a|B', 'x', ''])} AS choices, {_pick('s_suppkey', ['a;b|C', 'one', '', 'q'])} AS marks FROM supplier")
def split_and_plain_texts(supplier):
    """P25, P40."""
    choices, marks = _nth("s_suppkey", ["a; B |b, A", " x ", None]), _nth("s_suppkey", ["a;b\r\n C || c\n\n", "one", None, "q||Q"])
    return supplier.select("s_suppkey", bookkeeping.validation_text(_nth("s_suppkey", _RAW)).alias("plain"), F.array_join(bookkeeping.options(choices), "|").alias("choices"), F.array_join(bookkeeping.anchors(marks), "|").alias("marks"))


@query(f"SELECT s_suppkey, ({_pick('s_suppkey', ['t', 'f', None, None, 't', 'f', None])})::BOOLEAN AS score, s_suppkey % 7 IN (0, 4) AS relaxed, {_pick('s_suppkey', ['enum', 'list', None, 'float', 'string'])} AS kind, s_suppkey::VARCHAR AS id FROM supplier")
def scores_and_types(supplier):
    """M8, H46, H77."""
    said = _nth("s_suppkey", ["Yes", "stimmt nicht", "", None, " 1 ", "no", "perhaps"])
    kind = bookkeeping.type_name(_nth("s_suppkey", ["Categorical", "list-str", "date", " Number", "TEXT"]))
    return supplier.select("s_suppkey", bookkeeping.cell_score(said).alias("score"), bookkeeping.relaxed_bool(said).alias("relaxed"), kind.alias("kind"), bookkeeping.bare_id(F.concat(F.lit(" ##"), F.col("s_suppkey").cast("string"))).alias("id"))


@query("SELECT o_orderkey, 'some' AS scope FROM orders WHERE o_custkey IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0) UNION ALL SELECT c_custkey, 'all' FROM customer")
def sample_scope(orders, supplier, customer):
    """Orders of a sheet's ids; all customers, as none is in theirs."""
    even = bookkeeping.sheet_ids(supplier.where("s_suppkey % 2 = 0").select(F.concat(F.lit("#"), F.col("s_suppkey").cast("string"), F.lit(".0")).alias("ID")), ["Covidence #", "ID"])
    some = bookkeeping.scoped(orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("paper_id")), even).select("o_orderkey", F.lit("some").alias("scope"))
    none = bookkeeping.scoped(customer.select(F.col("c_custkey").alias("o_orderkey"), F.col("c_name").alias("paper_id")), even)
    return some.unionByName(none.select("o_orderkey", F.lit("all").alias("scope")))


@query("""
WITH b AS (SELECT DISTINCT o_custkey::VARCHAR AS paper_id FROM orders WHERE o_orderstatus = 'F'), m AS (SELECT DISTINCT o_custkey::VARCHAR AS paper_id FROM orders WHERE o_orderstatus = 'O'), a AS (SELECT paper_id FROM b UNION SELECT paper_id FROM m)
SELECT paper_id, NULL::BIGINT AS paper_count, NULL::DOUBLE AS percent_of_stage FROM a UNION ALL SELECT 'summary', count(*), round(count(*) * 100.0 / 3000, 6) FROM a""")
def appended_records(orders):
    """Records appended where their id is new, and the refreshed summary."""
    ids = lambda s: orders.where(F.col("o_orderstatus") == s).select(F.col("o_custkey").cast("string").alias("paper_id"))
    rows = bookkeeping.appended(ids("F"), ids("O"))
    summary = bookkeeping.append_summary(rows, 3000).select(F.lit("summary").alias("paper_id"), "paper_count", "percent_of_stage")
    return rows.select("paper_id", F.lit(None).cast("long").alias("paper_count"), F.lit(None).cast("double").alias("percent_of_stage")).unionByName(summary)


@query("SELECT c_custkey AS paper_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def ids_without_result(customer, orders):
    """J8, H11."""
    done = bookkeeping.result_ids(orders.select(F.col("o_custkey").alias("paper_id"), F.when(F.col("o_orderstatus") == "F", "{}").otherwise(" ").alias("payload")), "payload")
    return bookkeeping.missing_ids(customer.select(F.col("c_custkey").alias("paper_id")), done)


@query("SELECT max_by(o_totalprice, o_orderkey) FILTER (o_orderstatus = 'P') AS total, count(*) FILTER (o_orderstatus <> 'O') AS n FROM orders")
def log_totals(orders):
    """H14, H21."""
    log = orders.select(F.when(F.col("o_orderstatus") == "P", "TOTAL").when(F.col("o_orderstatus") == "F", "x").otherwise(" ").alias("paper_id"), "o_orderkey", "o_totalprice")
    return bookkeeping.last_total(log, "o_orderkey").select(F.col("o_totalprice").alias("total"), bookkeeping.sample_size(log).scalar().alias("n"))


@query("SELECT o_custkey AS paper_id, o_orderstatus AS variable, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL")
def audit_index(orders):
    """H29, H32."""
    return bookkeeping.keyed(orders.select(F.col("o_custkey").alias("paper_id"), F.col("o_orderstatus").alias("variable"), "o_orderkey", F.col("o_orderkey").alias("at")), ["paper_id", "variable"], "at").drop("at")


@query("SELECT p_partkey::VARCHAR AS target_id, 'smith' AS author, (1950 + p_size)::VARCHAR AS year, lower(p_name) AS title FROM part")
def link_targets(part):
    """H35."""
    rows = part.select(F.col("p_partkey").cast("string").alias("paper_id"), F.lit("Smith, J.; Doe").alias("authors"), F.concat(F.lit("May "), (F.col("p_size") + 1950).cast("string")).alias("year"), F.concat(F.regexp_replace(F.upper("p_name"), " ", " - "), F.lit("!")).alias("title"))
    return bookkeeping.link_features(rows)


@query("SELECT o_custkey AS paper_id, max(o_totalprice) FILTER (o_orderstatus = 'F') AS F, max(o_totalprice) FILTER (o_orderstatus = 'O') AS O FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey")
def gold_frame(orders):
    """H8."""
    cells = orders.groupBy(F.col("o_custkey").alias("paper_id"), F.col("o_orderstatus").alias("variable")).agg(F.max("o_totalprice").alias("value"))
    return bookkeeping.gold_frame(cells.withColumn("evaluable", F.col("variable") != "P"), ["F", "O"])


@query("SELECT c_custkey, c_custkey AS prompt_tokens, CASE WHEN c_custkey % 2 = 0 THEN 7 ELSE 0 END AS response_tokens, 0 AS embedding_tokens, 3 AS pdf_text_tokens, 0 AS pdf_visual_tokens, c_custkey + 3 + CASE WHEN c_custkey % 2 = 0 THEN 7 ELSE 0 END AS tokens_total FROM customer")
def resource_rows(customer):
    """H94."""
    return customer.select("c_custkey", *bookkeeping.resource_row({"prompt_tokens": F.col("c_custkey"), "response_tokens": F.when(F.col("c_custkey") % 2 == 0, 7), "pdf_text_tokens": F.lit("3")}))


@query("SELECT p_partkey, '{\"name\":\"' || p_name || '\",\"size\":\"' || CASE WHEN p_size % 2 = 0 THEN p_size::VARCHAR ELSE '' END || '\"}' AS record FROM part")
def result_records(part):
    """K5, H86."""
    cells = F.create_map(F.lit("size"), F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")), F.lit("name"), F.col("p_name"))
    return part.select("p_partkey", bookkeeping.result_record(cells).alias("record"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'new' ELSE 'old' END AS state FROM customer")
def sidecars(customer):
    """K14."""
    one = lambda s: customer.select("c_custkey", F.lit(s).alias("state"))
    return bookkeeping.merged_sidecars(one("old"), one("new").where("c_custkey % 4 = 0"), ["c_custkey"])


@query("""
WITH c AS (SELECT count(*) FILTER (quality = 1 AND toxic = 1) AS tp, count(*) FILTER (quality = 0 AND toxic = 0) AS tn, count(*) FILTER (quality = 0 AND toxic = 1) AS fp, count(*) FILTER (quality = 1 AND toxic = 0) AS fn FROM labels)
SELECT 0 AS line_no, 'n: ' || (tp + tn + fp + fn) AS line FROM c UNION ALL SELECT 1, 'observed_agreement: ' || printf('%.4f', (tp + tn) / (tp + tn + fp + fn)) FROM c UNION ALL SELECT 2, 'sensitivity: ' || printf('%.4f', tp / (tp + fn)) FROM c UNION ALL SELECT 3, 'specificity: ' || printf('%.4f', tn / (tn + fp)) FROM c""")
def alignment_report(labels):
    """K9 but for its picture."""
    from ..functions import stats

    return bookkeeping.alignment_report(labels.agg(*stats.confusion(F.col("quality"), F.col("toxic"))))


@query("SELECT c_custkey, 'seen by and others' AS answer FROM customer")
def sanitised_answers(customer):
    """H49, P12."""
    return customer.select("c_custkey", bookkeeping.sanitised(F.concat(F.lit("seen by "), F.col("c_name"), F.lit(" and others")), F.concat(F.lower("c_name"), F.lit("; Doe"))).alias("answer"))


# --- files written and read again, in a folder of the query's own


def _folder(df: DataFrame, name: str) -> str:
    return Scratch(df.sparkSession, name).path


@query("""
SELECT c_custkey::VARCHAR AS paper_id, c_name AS title, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment || ', "so"' || chr(10) || 'on' END AS abstract, (1990 + c_custkey % 30)::VARCHAR AS year, c_custkey % 3 = 0 AS citation_ingestion_missing_abstract, true AS citation_ingestion_missing_doi FROM customer WHERE c_custkey % 10 <> 0""")
def citation_export(customer):
    """An export under its own headers, written and read as canonical records."""
    blank = F.col("c_custkey") % 10 == 0
    rows = customer.select(
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string")).alias("Covidence #"), F.col("c_custkey").cast("string").alias("Ref"), F.when(blank, "").otherwise(F.col("c_name")).alias("TITLE "),
        F.when(blank, "").when(F.col("c_custkey") % 3 == 0, " N/A").otherwise(F.concat("c_mktsegment", F.lit(', "so"\non'))).alias("Abstract"), F.concat(F.lit("May "), (F.col("c_custkey") % 30 + 1990).cast("string")).alias("Published Year"), F.lit("none").alias("DOI"),
    )
    path = _folder(customer, "citations")
    records.write_text_csv(rows, path)
    out = records.canonical(records.read_text_csv(customer.sparkSession, path))
    return out.select("paper_id", "title", "abstract", "year", "citation_ingestion_missing_abstract", "citation_ingestion_missing_doi")


@query("SELECT event_id, event_type FROM events WHERE event_id % 4 <> 1")
def json_records(events):
    """Logs appended to, with meta rows, corrupt and blank lines between them."""
    path = _folder(events, "log")
    rows = events.select("event_id", "event_type")
    records.append_log(rows.where("event_id % 4 = 0"), path)
    records.append_log(rows.where("event_id % 4 > 1").withColumn("meta", F.lit(None).cast("string")), path)
    records.append_log(rows.where("event_id % 4 = 1").withColumn("meta", F.lit("summary")), path)
    rows.where("event_id % 50 = 0").select(F.when(F.col("event_id") % 100 == 0, '{"event_id": ').otherwise(" ").alias("value")).write.mode("append").text(path)
    return records.read_json_lines(events.sparkSession, path, "event_id long, event_type string")


@query("SELECT doc_id, CASE WHEN toxic = 1 THEN 'undecided' WHEN quality = 1 THEN 'include' ELSE 'exclude' END AS decision FROM labels")
def records_by_decision(labels):
    """K1: records in a folder of each decision."""
    path = _folder(labels, "decisions")
    records.write_by_decision(labels.select("doc_id", F.when(F.col("toxic") == 0, F.col("quality") == 1).alias("is_eligible")), path)
    return labels.sparkSession.read.schema("doc_id long, decision string").json(path)


@query("""
WITH e AS (SELECT CASE WHEN p_size % 2 = 0 THEN 'POS' ELSE 'NEG' END AS label, p_name || ' ' || p_partkey AS text FROM part WHERE p_size % 5 < 3), x AS (SELECT DISTINCT CASE WHEN p_size % 4 = 0 THEN p_type ELSE p_name || ' ' || p_partkey END AS text FROM part WHERE p_size % 4 < 2)
SELECT label, text FROM e UNION ALL SELECT 'NEG', text FROM x WHERE lower(text) NOT IN (SELECT lower(text) FROM e)""")
def labelled_examples(part):
    """Examples under other headers, bad labels and blank texts left out, with negatives harvested from records."""
    said = F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"))
    k = F.col("p_size") % 5
    sheet = part.select(F.when(k == 3, "maybe").when(F.col("p_size") % 2 == 0, "pos").otherwise(" Neg").alias("Class"), F.when(k < 4, said).alias("Sentence"))
    path = _folder(part, "examples")
    records.write_text_csv(sheet, path)
    own = records.labelled_examples(records.read_text_csv(part.sparkSession, path))
    excluded = part.where("p_size % 4 < 2").select(F.when(F.col("p_size") % 4 == 0, F.col("p_type")).otherwise("").alias("abstract"), said.alias("title"))
    return records.with_harvested(own, excluded)


@query("SELECT n_nationkey::VARCHAR AS id FROM nation WHERE n_nationkey % 2 = 1")
def newest_export(nation):
    """Of two exports the rows of the one written last."""
    path = _folder(nation, "exports")
    for k in (0, 1):
        records.write_text_csv(nation.where(F.col("n_nationkey") % 2 == k).select(F.col("n_nationkey").alias("id")).coalesce(1), f"{path}/{k}")
    return records.newest(records.read_text_csv(nation.sparkSession, [f"{path}/0", f"{path}/1"])).select("id")


@query("SELECT user_id, max_by(event_type, (ts, event_id)) AS event_type, max(event_id) FILTER (true) IS NOT NULL AS there FROM events GROUP BY user_id")
def replaced_by_batch(events):
    """Three batches of events, each replacing its users' rows; batches are handed over as a stream would."""
    target = _folder(events, "upserts")
    write = incremental.upsert_sink(target, ["user_id"], ["ts", "event_id"], 8)
    day = F.pmod(F.xxhash64(F.lit(0), "user_id"), F.lit(3))
    rows = events.select("user_id", "event_type", "ts", "event_id")
    write(rows.where("event_id % 2 = 0"), 0)
    latest = relational.latest(rows, ["user_id"], [F.col("ts"), F.col("event_id")])
    write(latest.where(day == 1).select(*rows.columns), 1)
    write(latest.where(day != 1).select(*rows.columns), 2)
    write(latest.where(day != 1).select(*rows.columns), 2)  # tried again
    left = incremental.pending(rows.select("user_id").distinct(), incremental.current(events.sparkSession, target), "user_id")
    out = incremental.current(events.sparkSession, target).select("user_id", "event_type", F.lit(True).alias("there"))
    return out.unionByName(left.select("user_id", F.lit("missing").alias("event_type"), F.lit(False).alias("there")))


# --- the few Arrow functions, and small rules over artefacts


@query("SELECT event_id, props AS object FROM events WHERE props IS NOT NULL")
def json_objects(events):
    """The first balanced object among words, open braces and quotes."""
    said = F.concat(F.lit('so {"x": " it } says: '), F.lit('" \\n'), "props", F.lit(" and {more"))
    return events.where("props is not null").select("event_id", udfs.first_json_object(said).alias("object"))


@query("SELECT o_custkey, o_orderkey, place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders) WHERE place <= 3")
def top_suggestions(orders):
    """The three best of each target."""
    out = relational.top_k(orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_totalprice", ["o_orderkey"], 3)
    return out.select("o_custkey", "o_orderkey", F.col("retrieval_rank").cast("long").alias("place"))


@query("SELECT doc_id, CASE WHEN length(trim(text)) = 0 THEN true ELSE coalesce(length(trim(substr(text, 1, (n_chars * 0.79)::BIGINT))) / length(trim(text)) >= 0.8, true) END AS enough FROM documents")
def length_guards(documents):
    """A stored text of four fifths of its length, or not quite."""
    stored = F.substring("text", F.lit(1), F.round(F.col("n_chars") * 0.79).cast("int"))
    return documents.select("doc_id", artefacts.length_guard(stored, F.col("text")).alias("enough"))


@query("SELECT c_custkey, list_contains([0, 2], i) AS title, CASE i WHEN 0 THEN 'On it by' WHEN 1 THEN 'It works.' WHEN 2 THEN 'x' END AS text FROM customer, (SELECT unnest([0, 1]) AS i) WHERE i < 2")
def prepared_records(customer):
    """Sentences of a title and an abstract without their authors."""
    chunks = contexts.prepared_chunks(F.col("c_custkey"), F.concat(F.lit("On it by "), "c_name"), F.lit(" It works. "), F.col("c_name"))
    return customer.select("c_custkey", F.explode(chunks).alias("c")).select("c_custkey", (F.col("c.kind") == "title").alias("title"), F.col("c.text").alias("text"))


@query("SELECT c_custkey::VARCHAR AS id, c_name || ';x' AS name, c_mktsegment AS segment FROM customer")
def review_sheet(customer):
    """A sheet parted by semicolons, a column copied from the alias that it came under."""
    path = _folder(customer, "sheet")
    rows = customer.select(F.col("c_custkey").alias("id"), F.concat("c_name", F.lit(";x")).alias("Full name"), F.col("c_mktsegment").alias("segment"))
    rows.write.option("header", True).option("sep", ";").option("escape", '"').csv(path)
    out = artefacts.with_alias_columns(artefacts.read_sheet(customer.sparkSession, path), {"name": ["title", "Full name"], "segment": ["id"]})
    return out.select("id", "name", "segment")


@query("SELECT 'stamp' AS asked, max_by(o_orderkey::VARCHAR, (o_orderdate, o_orderkey::VARCHAR)) FILTER (o_orderstatus = 'P') AS name FROM orders UNION ALL SELECT 'none', max_by(o_orderkey::VARCHAR, (o_orderdate, o_orderkey::VARCHAR)) FROM orders UNION ALL SELECT 'unknown', max_by(o_orderkey::VARCHAR, (o_orderdate, o_orderkey::VARCHAR)) FROM orders")
def stamped_files(orders):
    """The newest file of a stamp, or of all without one or with one that no file has."""
    files = orders.select(F.col("o_orderkey").cast("string").alias("name"), F.col("o_orderdate").alias("modified"), F.col("o_orderstatus").alias("stamp"))
    one = lambda asked, stamp: artefacts.newest_by_stamp(files, stamp).select(F.lit(asked).alias("asked"), "name")
    return one("stamp", "P").unionByName(one("none", None)).unionByName(one("unknown", "zz"))


@query("SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 2 = 0")
def folder_metadata(orders, customer):
    """Metadata joined on ids in other spellings."""
    rows = orders.select("o_orderkey", F.concat(F.lit(" #"), F.col("o_custkey").cast("string")).alias("id"))
    known = customer.where("c_custkey % 2 = 0").select(F.concat(F.col("c_custkey").cast("string"), F.lit(".0")).alias("id"), "c_name")
    return artefacts.with_metadata(rows, known, "id").select("o_orderkey", "c_name")


@query("SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 100000)")
def artefacts_to_copy(orders):
    """What is not there yet."""
    return artefacts.absent_only(orders.where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey"), orders.where("o_totalprice > 100000"), ["o_orderkey"])
