"""Contexts, artefacts, review and model services on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from evisift.operators import contexts, operations, prompts, providers, review
from evisift.sources import artefacts


def one(spark, column, **cells):
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'int' if isinstance(v, int) else 'string'}" for k, v in cells.items()) or "x int"
    return spark.createDataFrame([tuple(cells.values()) or (1,)], schema).select(column.alias("c")).first().c


def test_sections_and_method_evidence(spark):
    at = lambda label, text: one(spark, contexts.section_of(F.col("a"), F.col("t")), a=label, t=text)
    assert at(" Materials and Methods ", "x") == "method"
    assert at("page 3", "3. Results of it") == "results" and at(None, "word " * 20 + "results") is None and at(None, None) is None
    told = lambda text, off: one(spark, contexts.method_evidence(F.lit(None).cast("string"), F.col("t"), F.lit(off)), t=text)
    assert told("they were recruited", False) and not told("they were recruited", True) and not told("none", False) and told(None, False) is False


def test_record_decision_without_abstract(spark):
    got = json.loads(one(spark, contexts.insufficient_context(F.lit("why"), ["no_data", "insufficient_context"])))
    assert got["insufficient_context"] is True and got["no_data"] is False and got["is_eligible"] is False and got["deterministic_screening_reason"] == "why"
    assert one(spark, contexts.insufficient_context(F.lit(None).cast("string"), ["a"])) is None


def test_deliberation(spark):
    read = lambda v: one(spark, contexts.deliberation(F.col("j")), j=json.dumps({"step_by_step_deliberation": v}))
    assert read("plain") == "plain"
    assert read({"a": " x ", "Logic": " so "}) == "so"
    assert read({"a": " x ", "b": 3, "c": "y"}) == "x y"
    assert json.loads(read({"b": 3})) == {"b": 3}
    assert read(5) == "5" and read(None) is None
    assert one(spark, contexts.deliberation(F.col("j")), j="no json") is None and one(spark, contexts.deliberation(F.col("j")), j=None) is None


def test_flags(spark):
    answer = json.dumps({"no_x": "NEUTRAL", "wrong_y": True, "justification": "j", "other": "no", "z_context": None})
    assert one(spark, contexts.flag_values(F.col("j"), ["no_x", "absent"], ["no_x"]), j=answer) == {"absent": None, "no_x": None, "wrong_y": True, "z_context": None}
    broken = lambda **cells: one(spark, contexts.flag_violations(F.col("j"), ["no_x"], [], ["set"]), j=json.dumps(cells))
    assert broken(no_x="NEUTRAL", is_eligible=True) == ["flag:no_x"]
    assert broken(is_eligible=False) == ["reason_missing"]
    assert broken(is_eligible=False, exclusion_reason_category="odd") == ["reason_not_configured"]
    assert broken(is_eligible=False, exclusion_reason_category="wrong_y", wrong_y=True) == []
    assert one(spark, contexts.flag_violations(F.col("j"), ["no_x"], [], []), j=None) == []


def test_absence_key(spark):
    pick = lambda keys, preferred=None: one(spark, contexts.absence_key(F.col("k"), ["River water"], preferred), k=keys)
    assert pick(["no_water", "No River"]) == "no_river" and pick(["x"], "x") == "x" and pick(["no_sand"]) is None and pick([]) is None


def test_texts(spark):
    assert one(spark, contexts.signal_text(F.array(F.lit(" a "), F.lit("")), F.array(F.repeat(F.lit("b"), 4490), F.lit("c" * 50), F.lit("d")))) == "a\n" + "b" * 4490 + "\n" + "c" * 9
    assert one(spark, contexts.distinct_casefold(F.col("k")), k=["A", "b", "a", "B"]) == ["A", "b"]
    assert one(spark, contexts.single_blank_lines(F.col("t")), t="a\n\n \n\nb\nc\n\nd") == "a\n\nb\nc\n\nd"
    assert one(spark, contexts.full_text_context(F.col("a"), F.col("b"), F.col("c")), a="h", b=None, c=" x ") == "h\n\nx"
    assert one(spark, contexts.first_text(F.col("a"), F.col("b")), a=" ", b="x") == "x"
    assert one(spark, contexts.summary(F.lit(1), F.col("t"), F.col("a"), F.col("d")), t="T", a=None, d=None) == "Paper ID: 1\nTitle: T\nLLM Decision: \n"
    assert [r.chunk_id for r in one(spark, contexts.sentence_chunks(F.lit("p"), F.col("t"), F.col("a")), t=["x", " "], a=["y", "z"])] == ["p::title::0000", "p::abstract::0000", "p::abstract::0001"]
    assert one(spark, contexts.folder_name(F.col("i"), F.col("a"), F.col("y"), F.col("t")), i="7", a="Del Rio, X", y="2001", t="A: b!") == "7_Del_2001_A_b"
    assert one(spark, contexts.folder_name(F.col("i"), F.col("i"), F.col("i"), F.col("i")), i=None) == "paper"


def test_headers():
    assert review.candidate_headers("d", "n_overall", "N overall", ["N all"]) == ["N overall", "n_overall", "d_n_overall", "N all", "n", "N"]
    assert review.resolve_header(["n", "N Overall"], ["N overall"]) == "N Overall" and review.resolve_header(["x"], ["y"]) is None
    assert review.unknown_variables({"a": ["x", "y"]}, ["x"]) == ["y"]


def test_quote_aware(spark):
    got = lambda **c: one(spark, review.quote_cell_match(F.col("t"), F.col("v"), F.col("q"), F.col("n")), **c)
    assert tuple(got(t="12 adults", v="30 adult rats", q="we saw 12 adults there", n=None)) == (True, "ai_quote_vs_truth:short_exact_containment")
    assert tuple(got(t=None, v="n/a", q="x", n="x")) == (True, "value_vs_truth:both_missing; ai_quote_vs_reviewer_note:strict_or_alias")
    assert not got(t="a b", v="c d", q=None, n="").matched
    assert one(spark, review.alias_match(F.col("a"), F.col("b"), [["city", "urban area"]]), a="Urban area", b="a city")
    assert not one(spark, review.alias_match(F.col("a"), F.col("b"), [["city", "urban area"]]), a="sea", b="a city")
    assert one(spark, review.block_match(F.col("a"), ["study design"]), a="The Study-Design:") and not one(spark, review.block_match(F.col("a"), ["design"]), a="designs")


def test_notes(spark):
    usable = lambda n: one(spark, review.note_usable(F.col("n")), n=n)
    assert usable("the mean age was 30") and usable("unclear, see page 3") and not usable("unclear to me") and not usable("and so on") and not usable("one") and not usable(None)


def test_trace_evidence(spark):
    report = "paper_id: #12\n=== Evidence Hint Search For Missing Fields ===\n[d.n] search_terms=a\n  L3: open access text\n  L9: twelve adults\n[d.m] search_terms=b\n=== End\n  L1: not here"
    assert {tuple(r) for r in review.trace_evidence(spark.createDataFrame([(report,), ("none",), (None,)], "text string")).collect()} == {("12", "d.n", 1, "twelve adults"), ("12", "d.m", 0, "")}


def test_rescue(spark):
    cells = spark.createDataFrame([("a.x", "a", "v", "q"), ("a.y", "a", "n/a", "q"), ("b.z", "b", "v", None)], "path string, domain string, value string, quote string")
    assert {r.path for r in review.rescue_targets(cells, [], []).collect()} == {"a.y", "b.z"} and review.rescue_targets(cells, ["a.x"], []).count() == 3
    done = spark.createDataFrame([("semantic_rescue", "v", "q", "w", "q"), ("semantic_rescue", "v", "q", "v", "q"), ("primary", "v", "q", "w", "q")], "mode string, value string, quote string, second string, second_quote string")
    assert review.changed(done).count() == 1 and [r.value for r in review.apply_rescue(done).collect()] == ["w", "v", "v"]


def test_orders_and_numbers(spark):
    df = spark.createDataFrame([("info", "10"), ("high", "9"), ("odd", "1")], "severity string, id string")
    assert [r.severity for r in df.orderBy(*review.by_severity("id")).collect()] == ["high", "info", "odd"] and [r.id for r in df.orderBy(*review.by_id("id")).collect()] == ["1", "9", "10"]
    assert [one(spark, review.number_text(F.col("x")), x=x) for x in ("3.0", " 2.5", "NaN", "a", None)] == ["3", "2.5", None, None, None]


def test_artefacts(spark, tmp_path):
    files = spark.sql("SELECT * FROM VALUES (1, 'paper.txt', timestamp'2020-01-01'), (1, '1_paper.txt', timestamp'2019-01-01'), (2, 'paper.txt', timestamp'2019-01-01'), (3, 'z', timestamp'2019-01-01') AS t(id, name, modified)")
    assert {(r.id, r.name) for r in artefacts.first_candidate(files, "id", ["{id}_paper.txt", "#{id}_paper.txt", "paper.txt"]).collect()} == {(1, "1_paper.txt"), (2, "paper.txt")}
    stamped = files.withColumn("stamp", F.col("id").cast("string"))
    assert artefacts.newest_by_stamp(stamped, "3").first().name == "z" and artefacts.newest_by_stamp(stamped).first().stamp == "1" and artefacts.newest_by_stamp(stamped.where("id > 9")).count() == 0
    assert artefacts.delimiter("a;b,c\n1;2\n") == ";" and artefacts.delimiter("a\tb\n") == "\t" and artefacts.delimiter("") == ";"
    (tmp_path / "s.csv").write_text('N;Note\n1;"a;b"\n')
    sheet = artefacts.with_alias_columns(artefacts.read_sheet(spark, str(tmp_path / "s.csv")), {"Size": ["n", "N"], "Note": ["N"]})
    assert [tuple(r) for r in sheet.select("Size", "Note").collect()] == [("1", "a;b")]
    (tmp_path / "p.txt").write_text("Ask {eligibility_criteria}\nnow\n")
    assert artefacts.prompt_template(spark, str(tmp_path / "p.txt"), "X") == "Ask X\nnow"
    assert one(spark, artefacts.length_guard(F.col("a"), F.col("b")), a="x" * 7, b="y" * 10) is False and one(spark, artefacts.length_guard(F.col("a"), F.col("b")), a="x", b="")
    meta = spark.createDataFrame([("7", "t")], "id string, title string")
    assert artefacts.with_metadata(spark.createDataFrame([("#7.0",), ("8",)], "id string"), meta, "id").where("title is not null").count() == 1
    hit, miss = artefacts.reuse(spark.range(3), spark.range(2).withColumn("text", F.lit("x")), ["id"])
    assert (hit.count(), miss.count(), artefacts.absent_only(spark.range(3), spark.range(2), ["id"]).count()) == (2, 1, 1)


def test_services(spark):
    def lengths():
        def service(texts):
            if any("bad" in t for t in texts):
                raise ValueError("refused")
            return [[float(len(t))] for t in texts]

        return service

    def shouts():
        return lambda texts: ['said {"v": "%s"}' % t.upper() for t in texts]

    rows = spark.createDataFrame([(1, "aa"), (2, "bad"), (3, "aa"), (4, "c"), (5, None)], "id int, t string")
    cache = spark.createDataFrame([(r.h, [9.0]) for r in spark.range(1).select(F.sha2(F.lit("c"), 256).alias("h")).collect()], "text_sha256 string, vector array<double>")
    with_vectors, known = providers.embed(rows, "t", cache, lengths)
    assert {r.id: r.vector for r in with_vectors.collect()} == {1: [2.0], 2: None, 3: [2.0], 4: [9.0], 5: [0.0]} and known.count() == 3
    answers = providers.call(rows.where("t is not null"), "id", "t", shouts)
    read = answers.select("id", providers.parsed(F.col("answer"), "v string").alias("p"))
    assert {r.id: r.p.value.v for r in read.collect()} == {1: "AA", 2: "BAD", 3: "AA", 4: "C"}
    assert providers.call(rows.where("id > 9"), "id", "t", shouts).count() == 0
    assert one(spark, providers.parsed(F.col("t"), "v string"), t="none").error == "not_json"
    domains = spark.createDataFrame([(1, "a", "{}", None), (1, "b", None, "E")], "id int, domain string, payload string, error string")
    got = providers.merged_domains(domains, "id", {"a": "{0}", "b": "{1}"}).first()
    assert (got.a, got.b, got.errors) == ("{}", "{1}", {"b": "E"})


PROMPT = """Intro
# STEPS
1) First
 more
2) Second
# END GOAL
- "no_river":
- "is_eligible":
- "Wrong Thing":
# NARROWING
- "no_later":
# Criteria
Action / Change:
- Include: e.g. training; River walks ; no
- Exclude: sand
Other
- Include: nothing
"""


def test_prompts():
    assert prompts.rule_terms(PROMPT, ["action/change"]) == ["training", "river walks"] and prompts.rule_terms(PROMPT, ["Action/ Change"], "Exclude") == ["sand"]
    assert prompts.guidance_blocks(PROMPT) == ["1) First\n more", "2) Second"] and [h for h, _ in prompts.sections(PROMPT)] == ["STEPS", "END GOAL", "NARROWING", "Criteria"]
    assert "First" not in prompts.without_sections(PROMPT) and prompts.without_sections(PROMPT).startswith("Intro\n\n# NARROWING\n")
    assert prompts.required_keys(PROMPT) == {"no_river", "is_eligible"}
    assert prompts.flag_schema(["Wrong context"], PROMPT) == (["no_river", "wrong_context"], ["wrong_context"], None)
    with pytest.raises(ValueError):
        prompts.flag_schema([], "")
    s = prompts.signals(PROMPT, ["Action/Change"], ["none"], ["method"])
    assert s.source == "prompt_criteria" and s.secondary is None and s.keywords == ["method", "river walks", "training"]
    assert prompts.domain_groups(["a", "b", "c"], [["b", "a"]]) == [("b", "a"), ("c",)] and prompts.domain_groups(["a"]) == [("a",)]
    with pytest.raises(ValueError):
        prompts.for_domains([("a", "x")], ["b"])
    assert prompts.setting({"n": "4"}, "n", int) == 4 and prompts.setting({"n": "No"}, "n", bool) is False and prompts.setting({}, "n", int, 3) == 3
    with pytest.raises(ValueError):
        prompts.setting({"n": "x"}, "n", float)
    assert prompts.stage_rules({"a": {"x": 1, "y": 2}, "b": 1}, {"a": {"y": 3}, "b": None}) == {"a": {"x": 1, "y": 3}, "b": 1}
    assert prompts.second_look("c\n", " a ", ["r"]) == "c\n\nEarlier answer:\na\n\nRules:\n- r"


def test_run_rows(spark):
    rows = spark.createDataFrame([("p", "old"), ("q", None)], "project_name string, run string")
    assert operations.fill_run(rows, "r").columns == ["project_name", "run", "run_id"] and [r.run for r in operations.fill_run(rows, "r").collect()] == ["old", "r"]
    assert [r.run for r in operations.fill_run(rows, "r", "i", override=True).collect()] == ["r", "r"]
    assert operations.emission_totals(spark.createDataFrame([(" 2 ",), ("x",), (None,)], "duration string")).first()[:3] == (3, 2.0, 0.0)
    records = spark.createDataFrame([("#1", "AA"), ("2", None), (None, "bb")], "paper_id string, input_sha256 string")
    assert operations.find_record(records, "1").count() == 1 and operations.find_record(records, None, "BB ").count() == 1 and operations.find_record(records).count() == 0
    kept, pool = operations.quality_split(spark.createDataFrame([("title", True), ("body", True), (None, None), (None, True)], "kind string, low boolean"), F.col("low"))
    assert (kept.count(), pool.count()) == (2, 2)


def test_sheets_and_records(spark, tmp_path):
    assert review.headers_or_schema(["id", "N", "Year", "Title"], ["ID", "n", "year", "title", "x"]) == ["id", "N", "Year", "Title"] and review.headers_or_schema(["id"], ["ID", "ID", "n"]) == ["ID", "n"]
    sheet = spark.createDataFrame([("1", 1, "a"), ("1", 2, "b"), ("2", 1, None)], "id string, row int, v string")
    assert {tuple(r) for r in review.consensus_cells(sheet, "id", "row", ["v"]).collect()} >= {("1", "v", "b")}
    report = spark.createDataFrame([("1", " Match "), ("2", "none"), ("3", None)], "paper_id string, decision string")
    assert review.with_decisions(report, ["match", "none"]).count() == 2 and review.with_decisions(report, ["match"], "2").count() == 0
    assert review.rescue_counts(spark.createDataFrame([("a", "x"), ("a", "x"), ("b", None)], "domain string, mode string")).count() == 2
    (tmp_path / "r.jsonl").write_text('{"a": 1}\n\n{"meta": 1}\n{"a": 2}\n')
    assert artefacts.count_records(spark, [str(tmp_path / "r.jsonl")] * 2) == 2 and artefacts.count_records(spark, []) == 0
    got = one(spark, contexts.prepared_chunks(F.lit("p"), F.col("t"), F.col("a"), F.col("w")), t="Rivers by Ann Poe", a="One two. Three four five.", w="Ann Poe")
    assert [c.kind for c in got] == ["title", "abstract", "abstract"] and "Poe" not in got[0].text and [c.tokens for c in got[1:]] == [3, 4]
    assert one(spark, contexts.prepared_chunks(F.lit("p"), F.col("t"), F.col("t"), F.col("t")), t=None) == []
