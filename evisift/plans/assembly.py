"""Registered queries of contexts, artefacts and human review, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import contexts, operations, review
from ..sources import artefacts
from .registry import _CITES, _SUBSTANTIVE, query

_CUES = " ".join(f"WHEN regexp_matches(head, '(?i){p}') THEN '{k}'" for k, p in contexts.SECTION_CUES.items())
_HEAD = "array_to_string(list_filter(regexp_split_to_array(trim(coalesce(text, ''), ' '), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')[:20], ' ')"


@query(f"SELECT doc_id, CASE {_CUES} END AS section FROM (SELECT doc_id, {_HEAD} AS head FROM documents)")
def inferred_sections(documents):
    """By the first words, as no source is a section's name."""
    return documents.select("doc_id", contexts.section_of(F.col("source"), F.col("text")).alias("section"))


@query("SELECT source, count(*) FILTER (regexp_matches(text, '(?i)river')) AS action, count(*) FILTER (regexp_matches(text, '(?i)the')) AS first, count(*) FILTER (regexp_matches(text, '(?i)river') AND regexp_matches(text, '(?i)the') AND regexp_matches(text, '(?i)s ')) AS every FROM documents GROUP BY source")
def topic_cues(documents):
    """F11."""
    f = documents.select("source", contexts.topic_flags(F.col("text"), "(?i)river", "(?i)the", "(?i)s ").alias("f"))
    return f.groupBy("source").agg(F.count_if("f.action").alias("action"), F.count_if("f.primary").alias("first"), F.count_if("f.all").alias("every"))


@query("SELECT doc_id, md5('Paper ID: ' || doc_id || chr(10) || chr(10) || 'Title: ' || trim(coalesce(source, ''), ' ') || CASE WHEN trim(coalesce(text, ''), ' ') <> '' THEN chr(10) || chr(10) || 'Abstract:' || chr(10) || trim(text, ' ') ELSE '' END) AS context_md5 FROM documents")
def record_contexts(documents):
    """P42."""
    return documents.select("doc_id", F.md5(contexts.title_abstract_context(F.col("doc_id"), F.col("source"), F.col("text"))).alias("context_md5"))


@query("""
SELECT l_orderkey, string_agg('[Chunk ' || rn || ', section ' || l_returnflag || CASE WHEN l_linenumber % 2 = 0 THEN ', page ' || l_linenumber ELSE ', pages ' || l_linenumber || '-' || (l_linenumber + 1) END || CASE WHEN l_linenumber % 3 > 0 THEN ', sentences ' || (l_linenumber % 3) ELSE '' END || ']' || chr(10) || l_linestatus, chr(10) || chr(10) ORDER BY rn) AS blocks
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_linestatus, l_returnflag) AS rn FROM lineitem) GROUP BY l_orderkey""")
def chunk_blocks(lineitem):
    """An order's lines as chunks; an order has few."""
    n = F.col("l_linenumber")
    c = F.struct(n.alias("page_start"), F.col("l_linestatus").alias("text"), F.col("l_returnflag").alias("section"), F.when(n % 2 == 0, n).otherwise(n + 1).alias("page_end"), (n % 3).alias("sentences"))
    return lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(c)).alias("c")).select("l_orderkey", contexts.numbered_chunks(F.col("c")).alias("blocks"))


@query("SELECT c_custkey, regexp_replace(c_custkey || '_' || split_part(regexp_replace(c_mktsegment, '[^A-Za-z0-9_-]', '_', 'g'), ' ', 1) || '_2020_' || substr(trim(regexp_replace(c_name, '[^A-Za-z0-9_-]', '_', 'g'), '_'), 1, 50), '_{2,}', '_', 'g') AS folder FROM customer")
def paper_folders(customer):
    """P16."""
    return customer.select("c_custkey", contexts.folder_name(F.col("c_custkey").cast("string"), F.col("c_mktsegment"), F.lit("2020"), F.col("c_name")).alias("folder"))


@query("SELECT reason, count(*) AS n FROM (SELECT CASE WHEN doc_id % 9 = 0 THEN 'abstract_missing_in_citation_ingestion' WHEN lower(trim(coalesce(text, ''), ' ')) IN ('', 'na', 'n/a', 'not available', 'none', 'null', 'nan') OR doc_id % 9 = 1 THEN 'abstract_missing_or_placeholder' END AS reason FROM documents) GROUP BY reason")
def missing_abstracts(documents):
    """F13."""
    k = F.col("doc_id") % 9
    why = contexts.missing_abstract(F.when(k == 0, " Yes").otherwise("no"), F.when(k == 1, " Not Available ").otherwise(F.col("text")))
    return documents.select(why.alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN toxic = 1 ELSE NULL END AS no_context, quality = 1 AS wrong_topic, concat_ws(',', CASE WHEN doc_id % 3 = 2 THEN 'flag:no_context' END, CASE WHEN doc_id % 5 = 0 THEN 'reason_missing' END, CASE WHEN doc_id % 5 = 1 THEN 'reason_not_configured' END) AS broken FROM labels""")
def answer_flags(labels):
    """H52, F20 over answers made from labels: true, neutral or unread flags; reasons missing or unknown."""
    k = F.col("doc_id")
    flag = F.when(k % 3 == 0, F.when(F.col("toxic") == 1, "Yes").otherwise("no")).when(k % 3 == 1, "neutral").otherwise("perhaps")
    reason = F.when(k % 5 == 0, None).when(k % 5 == 1, "odd").when(k % 5 == 2, "wrong_topic").otherwise("set")
    payload = F.to_json(F.struct(F.lit(False).alias("is_eligible"), flag.alias("no_context"), (F.col("quality") == 1).alias("wrong_topic"), reason.alias("exclusion_reason_category")))
    v = contexts.flag_values(payload, ["no_context"], ["no_context"])
    broken = contexts.flag_violations(payload, ["no_context"], ["no_context"], ["set"])
    return labels.select("doc_id", v["no_context"].alias("no_context"), v["wrong_topic"].alias("wrong_topic"), F.array_join(broken, ",").alias("broken"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 0 ELSE 1 END AS place, CASE WHEN p_size % 2 = 0 THEN 100 ELSE 78 END::BIGINT AS score FROM part")
def header_choice(part):
    """A note column that would fit is passed over for one that fits less."""
    even = F.col("p_size") % 2 == 0
    headers = F.when(even, F.array(F.lit("Sample size"), F.lit("sample size note"))).otherwise(F.array(F.lit("size sample notes"), F.lit("the size of sample taken")))
    b = review.best_header(headers, F.when(even, "sample").otherwise("size_sample"), F.when(even, "Sample  Size").otherwise("Total N"))
    return part.select("p_partkey", b["place"].cast("int").alias("place"), b["score"].cast("long").alias("score"))


@query("""
SELECT reason, count(*) AS n FROM (SELECT CASE WHEN p_size % 6 = 0 THEN 'both_missing' WHEN p_size % 6 = 1 THEN 'missing_mismatch' WHEN p_size % 6 = 2 THEN 'strict_or_alias' WHEN p_size % 6 = 3 THEN 'punctuation_spacing_normalized'
  WHEN p_size % 6 = 4 THEN 'short_exact_containment' ELSE 'token_overlap_0.50' END AS reason FROM part) GROUP BY reason""")
def quote_aware_reasons(part):
    """M6: each rule in turn over spellings of a value."""
    k = F.col("p_size") % 6
    human = F.when(k == 0, "n/a").otherwise("Large polished steel")
    ai = F.when(k == 0, " None ").when(k == 1, "missing").when(k == 2, " large polished STEEL").when(k == 3, "large, polished - steel.").when(k == 4, "a large polished steel part")
    ai = F.coalesce(ai, F.lit("large copper"))
    return part.select(review.quote_match(human, ai)["reason"].alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT origin, evaluable, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'reviewer_accepted_source_value' WHEN o_orderkey % 4 = 1 THEN 'reviewer_rejected_without_correction' WHEN o_orderkey % 4 = 2 AND o_custkey % 2 = 0 THEN 'reviewer_quote_correction' WHEN o_orderkey % 4 = 2 THEN 'reviewer_comment_without_extractable_ground_truth' ELSE 'not_human_reviewed' END AS origin,
  o_orderkey % 4 = 0 OR (o_orderkey % 4 = 2 AND o_custkey % 2 = 0) AS evaluable FROM orders) GROUP BY ALL""")
def gold_origins(orders):
    """The note of a rejected cell stands two places on."""
    k = F.col("o_orderkey") % 4
    score = F.when(k == 0, "1").when(k == 3, "").otherwise("0")
    note = F.when(F.col("o_custkey") % 2 == 0, "unclear, but see page 4").otherwise("this is unclear to me")
    own = review.neighbour_note(F.array(F.lit(""), F.lit(""), F.when(k == 2, note).otherwise("")), F.array(score, F.lit("0"), F.lit("")), F.lit(0))
    g = review.gold_value(F.col("o_orderstatus"), score, own)
    return orders.select(g["origin"].alias("origin"), g["evaluable"].alias("evaluable")).groupBy("origin", "evaluable").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, count(*) AS n FROM (SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM documents WHERE text IS NOT NULL) WHERE line <> '' AND NOT regexp_matches(line, '(\\.\\s*){5,}') AND NOT regexp_matches(lower(line), '\"title\":|all rights reserved|creative commons|public domain dedication|provided you give appropriate credit|open access') GROUP BY doc_id")
def informative_lines(documents):
    """F21."""
    return documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where(review.informative(F.col("line"))).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, domain, variable, value, quote FROM (SELECT c_custkey, 'who' AS domain, 'name' AS variable, c_name AS value, NULL AS quote FROM customer UNION ALL SELECT c_custkey, 'who', 'segment', c_mktsegment, c_name FROM customer)")
def audit_cells(customer):
    """Without a join, each record's row widens to its variables."""
    named = customer.select("c_custkey", F.col("c_name").alias("who_name"), F.col("c_mktsegment").alias("who_segment"), F.col("c_name").alias("who_segment_quote"))
    return review.audit_rows(named, ["c_custkey"], [("who", "name"), ("who", "segment")])


@query("""
WITH a AS (SELECT s_suppkey, 'x.name' AS path, s_name AS value FROM supplier UNION ALL SELECT s_suppkey, 'x.nation', s_nationkey::VARCHAR FROM supplier)
SELECT s_suppkey, path, value, 'ann' AS reviewer, CASE path WHEN 'x.name' THEN 'assigned_expertise' ELSE 'shared_methodological_audit' END AS scope FROM a UNION ALL SELECT s_suppkey, path, value, 'bob', 'assigned_expertise' FROM a WHERE path = 'x.nation'""")
def reviewer_packets(supplier):
    """J13, H33."""
    cell = lambda p, v: F.struct(F.lit(p).alias("path"), v.cast("string").alias("value"))
    audit = supplier.select("s_suppkey", F.inline(F.array(cell("x.name", F.col("s_name")), cell("x.nation", F.col("s_nationkey")))))
    return review.packets({"ann": ["x.name"], "bob": ["x.nation"]}, ["x.nation"], audit)


@query("SELECT l_orderkey, min_by(l_returnflag, CASE l_returnflag WHEN 'R' THEN 0 ELSE 1 END) AS name FROM lineitem WHERE l_returnflag IN ('R', 'A') GROUP BY l_orderkey")
def artefact_choice(lineitem):
    """The first of several names that is there."""
    files = lineitem.select("l_orderkey", F.col("l_returnflag").alias("name"), F.lit("2020-01-01").cast("timestamp").alias("modified"))
    return artefacts.first_candidate(files, "l_orderkey", ["R", "A"]).drop("modified")


@query("SELECT doc_id, length(CASE WHEN length(a) < 80 AND length(b) > length(a) THEN b ELSE a END) AS n_chars_used FROM (SELECT doc_id, trim(CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 THEN substr(coalesce(text, ''), 1, 60) ELSE coalesce(text, '') END, ' ') AS a, trim(coalesce(text, ''), ' ') AS b FROM documents)")
def page_choice(documents):
    """Of two extractors' texts."""
    k, t = F.col("doc_id") % 4, F.coalesce(F.col("text"), F.lit(""))
    first = F.when(k == 0, "").when(k == 1, F.substring(t, 1, 60)).otherwise(t)
    return documents.select("doc_id", F.length(artefacts.page_text(first, t)).cast("long").alias("n_chars_used"))


@query("SELECT doc_id, quality, toxic FROM labels JOIN documents USING (doc_id) WHERE lang = 'en' AND quality = 1")
def cached_texts(labels, documents):
    """Rows whose text is cached under an equal key."""
    return artefacts.reuse(labels.where("quality = 1"), documents.where("lang = 'en'").select("doc_id"), ["doc_id"])[0]


@query("""
SELECT conv_id, '[Supplemental Cited Evidence]' || chr(10) || chr(10) || string_agg('[Supplemental Source: ' || lpad(turn::VARCHAR, 6, '0') || ']' || chr(10) || role, chr(10) || chr(10) ORDER BY turn) AS block
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations) WHERE rn <= 8 GROUP BY conv_id""")
def supplement_blocks(conversations):
    """The first eight files of each folder are the operator's limit."""
    return artefacts.supplements(conversations.select("conv_id", F.lpad(F.col("turn").cast("string"), 6, "0").alias("name"), F.col("role").alias("text")), "conv_id")


@query("SELECT count(*)::DOUBLE AS row_count, round(sum(CASE WHEN event_id % 3 = 0 THEN 0 ELSE value END), 4) AS duration, round(sum(value), 4) AS emissions FROM events")
def emission_totals(events):
    """Measures as texts, every third of one no number."""
    rows = events.select(F.when(F.col("event_id") % 3 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("duration"), F.col("value").cast("string").alias("emissions"))
    t = operations.emission_totals(rows)
    return t.select(F.col("row_count").cast("double").alias("row_count"), F.round("duration", 4).alias("duration"), F.round("emissions", 4).alias("emissions"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'r1' ELSE 'kept' END AS run, 'x7' AS run_id FROM supplier")
def run_labels(supplier):
    """H19, H20."""
    rows = supplier.select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 1, "kept").otherwise("").alias("run"))
    return operations.fill_run(rows, "r1", "x7")


@query("SELECT '#' || doc_id AS paper_id, sha256(coalesce(text, '')) AS input_sha256 FROM documents WHERE doc_id = 7")
def record_lookup(documents):
    """J23."""
    records = documents.select(F.concat(F.lit("#"), F.col("doc_id").cast("string")).alias("paper_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("input_sha256"))
    return operations.find_record(records, "7")


@query(f"""
SELECT kept, count(*) AS n FROM (SELECT source = 'web' OR NOT coalesce(NOT regexp_matches(line, '[\\p{{L}}\\p{{N}}]') OR len(regexp_extract_all(line, '[A-Za-z]+')) < 3 OR length(line) < 25
  OR len(regexp_extract_all(line, '[0-9]')) / greatest(length(line), 1) > 0.35 OR ({_CITES.format(x="line")} >= 2 AND NOT {_SUBSTANTIVE.format(x="line")}), false) AS kept
  FROM (SELECT source, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM documents WHERE text IS NOT NULL)) GROUP BY kept""")
def quality_pool(documents):
    """F8: lines that stay and those kept aside, by F1; one source's always stay."""
    lines = documents.select(F.col("source").alias("kind"), F.explode(F.split("text", "\n")).alias("line")).withColumn("line", F.trim("line"))
    parts = operations.quality_split(lines, text.low_information(F.col("line")), ["web"])
    return parts[0].select(F.lit(True).alias("kept")).unionByName(parts[1].select(F.lit(False).alias("kept"))).groupBy("kept").agg(F.count(F.lit(1)).alias("n"))
