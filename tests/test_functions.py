"""Functions, sources, sinks and streams on small fixtures; properties with hypothesis."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evisift.functions import stats, text, udfs, values
from evisift.operators import contexts, evidence, extraction, linkage, operations, relational, retrieval, review, signals
from evisift.plans import registry
from evisift.sources import records
from evisift.streaming import incremental


def one(spark, column, **cells):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'int'}" for k, v in cells.items()) or "x int"
    return spark.createDataFrame([tuple(cells.values()) or (1,)], schema).select(column.alias("c")).first().c


def test_exact_interval_known_values():
    low, high = stats.exact_interval(8, 10)
    assert (round(low, 4), round(high, 4)) == (0.4439, 0.9748)
    assert stats.exact_interval(0, 10) == (0.0, pytest.approx(0.3085, abs=1e-4)) and stats.exact_interval(10, 10)[1] == 1.0
    assert math.isnan(stats.exact_interval(0, 0)[0])


@given(st.integers(1, 60).flatmap(lambda n: st.tuples(st.integers(0, n), st.just(n))))
@settings(max_examples=40, deadline=None)
def test_exact_interval_holds_the_estimate(kn):
    low, high = stats.exact_interval(*kn)
    assert low <= kn[0] / kn[1] <= high


def test_repair(spark):
    got = one(spark, text.repair(F.col("t")), t="mi­cro-\nrandomised trial.Then 10degrees andCelsius\r\n  end")
    assert got == "microrandomised trial. Then 10 degrees and Celsius end"
    assert one(spark, text.repair(F.col("t")), t=None) == ""
    kept = one(spark, text.repair_lines(F.col("t")), t="A\r\n\r\n\r\n\r\nhttps://x.org/a\nb  c\tD2\n")
    assert kept == "A\n\nb c D 2"


def test_sections(spark):
    label, rest = text.section(F.col("t"))
    assert one(spark, F.struct(label.alias("a"), rest.alias("b")), t="2.1 Methods") == ("method", "")
    assert one(spark, F.struct(label.alias("a"), rest.alias("b")), t="Results: all fine") == ("results", "all fine")
    assert one(spark, F.struct(label.alias("a"), rest.alias("b")), t="Nothing here") == (None, "Nothing here")


def test_low_information_and_quality(spark):
    low = text.low_information(F.col("t"))
    for t, want in [("", True), ("....", True), ("1 2 3 4", True), ("Words that make up one full sentence.", False), ("See studies [1] and [2, 3] for more of it.", True), ("Baseline results of participants showed significant effect [1] against [2] another group.", False)]:
        assert one(spark, low, t=t) is want
    assert one(spark, text.low_quality(F.col("t")), t="Copyright 2020, all rights reserved by the house") is True
    assert one(spark, text.reference_dominant(F.col("t")), t="References Smith et al. (2020)") is True


@given(st.text(max_size=12))
@settings(max_examples=15, deadline=None)
def test_paper_id_is_idempotent(spark, x):
    once = one(spark, text.paper_id(F.lit(x)))
    assert one(spark, text.paper_id(F.lit(once))) == text_strip(once)


def text_strip(x):
    import re

    return re.sub(r"^([0-9]+)\.0$", r"\1", re.sub("^#+", "", x.strip(" ")))


def test_sentences_and_json():
    assert udfs.split_sentences("Dr. Smith came. He saw 3 cats! Did e.g. Bob? Yes.") == ["Dr. Smith came.", "He saw 3 cats!", "Did e.g. Bob?", "Yes."]
    assert udfs.split_sentences(None) == []
    assert udfs.json_object('x {"a": "}\\"", "b": {"c": 1}} y') == '{"a": "}\\"", "b": {"c": 1}}'
    assert udfs.json_object("{ open {\"a\": 1}") == '{"a": 1}' and udfs.json_object("no") is None
    assert udfs.ascii_fold("Élan vital_2.PDF") == "elan vital 2"
    assert udfs.without_authors("By A. Smith and B. Jones now", "A. Smith; B. Jones") == "By and now"


def test_decisions(spark):
    e = values.eligible(F.col("t"), F.lit("title_abstract"))
    for t, want in [('{"is_eligible": true}', True), ('{"is_eligible": "NEUTRAL"}', True), ("ineligible paper", False), ("clearly eligible", True), ("LLM error", None), ('{"is_eligible": "no"}', False)]:
        assert one(spark, e, t=t) is want
    assert one(spark, values.eligible(F.col("t"), F.lit("full_text")), t='{"is_eligible": "NEUTRAL"}') is None
    assert one(spark, values.factual_match(F.col("a"), F.col("b")), a="mobile health application", b="A mobile application") is True
    assert one(spark, values.numbers_overlap(F.col("a"), F.col("b")), a="n 40", b="41 people") is True


@given(st.lists(st.sampled_from("abcdef"), max_size=6), st.lists(st.sampled_from("abcdef"), max_size=6))
@settings(max_examples=15, deadline=None)
def test_jaccard_is_symmetric(spark, a, b):
    arr = lambda v: F.array(*map(F.lit, v)).cast("array<string>")
    x, y = one(spark, values.jaccard(arr(a), arr(b))), one(spark, values.jaccard(arr(b), arr(a)))
    assert x == y and 0 <= x <= 1


@given(st.integers(0, 60), st.integers(2, 9))
@settings(max_examples=15, deadline=None)
def test_windows_cover_every_sentence(spark, n, size):
    arr = F.transform(F.sequence(F.lit(1), F.lit(max(n, 1))), lambda i: i.cast("string")) if n else F.array().cast("array<string>")
    got = one(spark, relational.windows(arr, size, 1))
    assert len(got) == -(-n // (size - 1)) and {s for w in got for s in w.sentences} == {str(k) for k in range(1, n + 1)}


def test_sample_and_sets(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    sample = relational.hash_sample(df, "k", 0.037)
    rest = df.join(sample, "k", "left_anti")
    assert sample.count() == 37 and rest.count() == 963 and relational.hash_sample(df.limit(0), "k", 0.1).count() == 0
    assert {r.k for r in relational.hash_sample(df, "k", 0.037).collect()} == {r.k for r in sample.collect()}
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, relational.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_budget_passes_by_what_does_not_fit(spark):
    assert one(spark, relational.budget_fold(F.array(*map(F.lit, [5, 9, 3, 2])), 10.0)) == [True, False, True, True]


def test_greedy_choice(spark):
    rows = [("p", f"c{k}", "method" if k < 6 else "results", k, 1.0 - k / 100, 10.0, " ".join(f"w{k}{j}" for j in range(5))) for k in range(12)]
    rows.append(("p", "twin", "other", 50, 0.5, 10.0, " ".join(f"w0{j}" for j in range(5))))
    df = spark.createDataFrame(rows, "paper_id string, chunk_id string, section string, page int, score double, cost double, text string")
    got = retrieval.diverse_selection(df, 5, 45.0).orderBy("pick").collect()
    assert len(got) == 4 and sum(r.cost for r in got) <= 45
    assert {r.section for r in got[:4]} == {"method", "results"} and "twin" not in {r.chunk_id for r in got}


def test_long_spaced_text(spark):
    got = one(spark, text.readability(F.lit("a " * 20_000))["readability_score"])
    assert got is not None and 0 < got < 1


def test_whole_texts_are_folded(spark, tmp_path):
    import re
    import unicodedata

    texts = ["Über " * 400 + "Ende.pdf", "é" * 500 + " ﬁn\u0301", "x" * 300 + ".PDF", "", None, "a-b_c " * 90]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.folded for r in registry.QUERIES["ascii_folded_names"](spark, str(tmp_path)).collect()}
    for k, t in enumerate(texts):
        plain = "".join(c for c in unicodedata.normalize("NFKD", t or "") if ord(c) < 128).lower()
        assert got[k] == " ".join(re.findall("[a-z0-9]+", plain[:-4] if plain.endswith(".pdf") else plain)), k


def brute_choice(rows, k, budget):
    rows = sorted(rows, key=lambda r: (-r[4], r[1]))
    picked = []
    for level in range(3):
        for r in rows:
            if len(picked) >= k or r in picked or sum(p[5] for p in picked) + r[5] > budget:
                continue
            words = set(r[6].lower().split())
            twin = any(len(words & set(p[6].lower().split())) >= 0.82 * max(1, len(words | set(p[6].lower().split()))) for p in picked)
            near, same = sum(p[3] // 2 == r[3] // 2 for p in picked) >= 2, sum(p[2] == r[2] for p in picked) >= 2
            if not (level < 2 and (twin or same) or level < 1 and near):
                picked.append(r)
    return [(r[1], n + 1, rows.index(r) + 1) for n, r in enumerate(picked)]


def test_greedy_choice_beyond_the_first_rows(spark):
    text = lambda k: " ".join(f"w{k}{j}" for j in range(5))
    make = lambda p, k, section, page, score, cost, t: (p, f"c{k:04d}", section, page, score, cost, t)
    papers = {
        "copies": [make("copies", k, f"s{k % 7}", k, 2.0, 1.0, text(0)) for k in range(450)] + [make("copies", k, f"s{k % 7}", k, 1.0 - k / 1e4, 1.0, text(k)) for k in range(450, 520)],
        "section": [make("section", k, "one" if k < 450 else f"s{k}", k, 1.0 - k / 1e4, 1.0, text(k)) for k in range(470)],
        "page": [make("page", k, f"s{k}", 0 if k < 450 else k, 1.0 - k / 1e4, 1.0, text(k)) for k in range(456)],
        "cost": [make("cost", k, f"s{k}", k, 1.0 - k / 1e4, 99.0 if k < 450 else 5.0, text(k)) for k in range(470)],
        "few": [make("few", k, "one", 0, 1.0 - k / 1e4, 1.0, text(0)) for k in range(15)],
        "flat": [make("flat", k, "one", k, 0.5, 1.0, text(k % 3)) for k in range(450)],
    }
    df = spark.createDataFrame([r for rows in papers.values() for r in rows], "paper_id string, chunk_id string, section string, page int, score double, cost double, text string")
    got = retrieval.diverse_selection(df, 10, 40.0).orderBy("pick").collect()
    for p, rows in papers.items():
        assert [(r.chunk_id, r.pick, r.retrieval_rank) for r in got if r.paper_id == p] == brute_choice(rows, 10, 40.0), p


def test_schema_and_flatten(spark):
    v = [{"domain": "population", "variable_name": "size", "variable_type": "int", "instruction": "x"}, {"domain": "population", "variable_name": "groups", "variable_type": "list", "instruction": "x"}]
    schema = extraction.compile_schema(v)
    df = spark.createDataFrame([('{"population": {"size_value": 5, "groups_value": ["a", "b"], "groups_quote": "q"}}',)], "t string").select(F.from_json("t", schema).alias("d"))
    assert df.select(*extraction.flatten(schema, "d")).first().asDict() == {"population.size_value": "5", "population.size_quote": None, "population.groups_value": "a; b", "population.groups_quote": "q"}
    for bad in ([v[0], v[0]], [{**v[0], "variable_type": "enum"}], [{**v[0], "instruction": " "}], [{**v[0], "variable_type": "odd"}]):
        with pytest.raises(ValueError):
            extraction.compile_schema(bad)


def test_linkage(spark):
    t = spark.createDataFrame([("t1", ["alpha", "beta", "gamma"]), ("t2", ["delta"])], "target_id string, tokens array<string>")
    o = spark.createDataFrame([("o1", ["alpha", "beta", "gamma"]), ("o2", ["alpha", "x", "y", "z"])], "other_id string, tokens array<string>")
    got = linkage.decide(linkage.score_tokens(linkage.candidates(t, o), t, o)).collect()
    assert [(r.target_id, r.other_id, r.decision) for r in got] == [("t1", "o1", "match")]


def test_unique_join_raises(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="repeated k"):
        operations.unique_join(a, spark.createDataFrame([(1, 2)], "k int, w int"), "k").collect()


def test_evidence(spark):
    assert one(spark, evidence.snippet(F.col("t"), "needle", 10), t="x" * 30 + "needle" + "y" * 30) == "...xxxxxneedl..."
    assert one(spark, evidence.context_lines(F.col("t"), "hit", 1, 1), t="a\nb hit\nc\nd") == ["a\nb hit\nc"]
    assert evidence.term_list("a b; cc; longer term") == ["a b", "longer term"] and evidence.term_pattern(["a", "a.b"]) == "(?i)(?:a\\.b|a)"


def test_csv_and_json_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿Covidence #,title ,Abstract,Published Year,DOI\n#22,T,N/A,May 2021,10.1/X\n,,,,\n007,\"multi\nline\",text,,\n")
    raw = records.read_text_csv(spark, str(tmp_path / "a.csv"))
    got = records.canonical(raw).orderBy("paper_id").collect()
    assert [(r.paper_id, r.title, r.abstract, r.year) for r in got] == [("#22", "T", "", "2021"), ("007", "multi\nline", "text", "")]
    assert got[0].citation_ingestion_missing_abstract and not got[0].citation_ingestion_missing_doi
    assert records.newest(raw).count() == raw.count()
    (tmp_path / "r.jsonl").write_text('{"paper_id": "1", "v": 2}\n\nbroken{\n{"meta": "summary"}\n')
    assert [tuple(r) for r in records.read_json_lines(spark, str(tmp_path / "r.jsonl"), "paper_id string, v int").where("paper_id is not null").collect()] == [("1", 2)]
    kb = spark.createDataFrame([("pos", "one"), ("odd", "x"), ("NEG", " ")], "class string, Sentence string")
    assert [tuple(r) for r in records.labelled_examples(kb).collect()] == [("POS", "one")]
    excluded = spark.createDataFrame([("", "ONE"), ("two", "t")], "abstract string, title string")
    assert sorted(r.text for r in records.with_harvested(records.labelled_examples(kb), excluded).collect()) == ["one", "two"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "paper_id string, is_eligible boolean")
    records.write_by_decision(df, str(tmp_path / "d"))
    back = spark.read.json(str(tmp_path / "d"))
    assert {r.paper_id: r.decision for r in back.collect()} == {"a": "include", "b": "exclude", "c": "undecided"}
    records.write_text_csv(df, str(tmp_path / "c"))
    assert {tuple(r) for r in records.read_text_csv(spark, str(tmp_path / "c")).select("paper_id", "is_eligible").collect()} == {("a", "true"), ("b", "false"), ("c", "")}
    records.append_log(df, str(tmp_path / "l"))
    records.append_log(df, str(tmp_path / "l"))
    assert spark.read.json(str(tmp_path / "l")).count() == 6


def test_stream_upsert(spark, tmp_path):
    for k, rows in enumerate([[("a", 1, 1), ("b", 1, 1)], [("b", 2, 5), ("b", 3, 4), ("c", 1, 1)]]):
        spark.createDataFrame(rows, "k string, v int, t int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = incremental.read_files(spark, str(tmp_path / "in"), "k string, v int, t int").writeStream.foreachBatch(incremental.upsert_sink(str(tmp_path / "out"), ["k"], ["t", "v"])).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
        assert k is not None
    assert sorted(tuple(r) for r in incremental.current(spark, str(tmp_path / "out")).select("k", "v").collect()) == [("a", 1), ("b", 2), ("c", 1)]


def test_upsert_versions(spark, tmp_path):
    target = str(tmp_path / "t")
    write = incremental.upsert_sink(target, ["k"], ["t"], 4)
    batch = lambda rows: spark.createDataFrame(rows, "k string, v int, t int")
    now = lambda: sorted(tuple(r) for r in incremental.current(spark, target).select("k", "v").collect())
    assert incremental.current(spark, target, "k string, v int, t int").count() == 0
    write(batch([(f"k{i}", 0, 0) for i in range(40)]), 0)
    for n in (1, 2, 3):
        write(batch([("k1", n, n), ("k2", n, n)]), n)
        write(batch([("k1", n, n), ("k2", n, n)]), n)
        assert now() == sorted((f"k{i}", n if i in (1, 2) else 0) for i in range(40))
    versions = sorted(str(p.relative_to(target)) for p in (tmp_path / "t").glob("upsert_version=*/upsert_bucket=*"))
    assert len([v for v in versions if v.startswith("upsert_version=0")]) <= 4 and not any(v.startswith("upsert_version=1") for v in versions)


def test_stream_windows_equal_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.coalesce(2).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    q = incremental.event_windows(stream).writeStream.format("memory").queryName("w").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(spark.table("w")) == rows(incremental.event_windows(events))


def test_list_values_and_margin_lines_are_trimmed(spark):
    assert one(spark, extraction.coerce(F.col("t"), "list"), t="0 rats; 10 mice;\n 22") == ["0 rats", "10 mice", "22"]
    pages = spark.createDataFrame([(1, p, f"  0 Journal of Rivers \nbody {p}\n1 foot {p}") for p in range(4)], "paper int, page int, text string")
    assert "journal of rivers" in {r.line for r in relational.margin_lines(pages, "paper", "page", "text").collect()}


def test_json_object_equals_a_plain_version():
    import random

    def plain(t):
        for begin in [i for i, c in enumerate(t) if c == "{"]:
            depth, quoted, escaped = 0, False, False
            for i in range(begin, len(t)):
                c = t[i]
                if quoted:
                    quoted, escaped = escaped or c != '"', not escaped and c == "\\"
                elif c == '"':
                    quoted = True
                elif c in "{}":
                    depth += 1 if c == "{" else -1
                    if not depth:
                        return t[begin : i + 1]
        return None

    rng = random.Random(3)
    for _ in range(20_000):
        t = "".join(rng.choice('{}"\\a ') for _ in range(rng.randrange(14)))
        assert udfs.json_object(t) == plain(t), t
    assert udfs.json_object("{" * 300_000) is None and udfs.json_object('{"a":' * 100_000) is None


def test_long_texts_of_one_kind(spark):
    """Runs that a repeated group would recurse over, or that a search would begin anew at each character of."""
    n = 30_000
    texts = ["-" + "\n" * n + "!", "x" + " " * n + "x", "x" + "\t \n" * n + "x", "1" * n, "a " * n, "1.1." * n, "\n" * n, " \n" * n, "[1,2] " * n, ". " * n, "a b c d e f " * n, "{" * n, "x" * n]
    t = F.col("t")
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    made = [text.repair(t), text.repair_lines(t), text.chunk_line(t), text.margin_key(t), text.low_information(t), text.low_quality(t), text.section(t)[0], text.before_references(t), text.is_boilerplate(t), contexts.single_blank_lines(t), review.informative(t), review.note_usable(t), signals.gates(t), contexts.section_of(t, t), *text.readability(t).values()]
    out = df.select(*[F.length(c.cast("string")).alias(f"c{k}") for k, c in enumerate(made)]).collect()
    assert len(out) == len(texts) and out[1].c0 == 3


def test_link_scores_and_rare_tokens(spark):
    import difflib
    import random

    from evisift.operators import bootstrap

    rng = random.Random(5)
    vocabulary = [f"word{k}" for k in range(25)] + ["the", "of"] * 6
    titles = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    targets = [(f"t{k}", rng.choice(["smith", "vandenberg", "", "li"]), rng.choice(["2001", "2002", ""]), t) for k, t in enumerate(titles)]
    others = [(f"o{k}", f"{rng.choice(['smith', 'van den berg', 'jones', 'li'])} {y} {rng.choice(titles)}", y) for k, y in enumerate(rng.choices(["2001", "2002", "2003"], k=70))]
    t, o = spark.createDataFrame(targets, "target_id string, author string, year string, title string"), spark.createDataFrame(others, "other_id string, name string, year string")
    got = {(r.target_id, r.other_id): r.score for r in bootstrap.link_scores(t, o).collect()}
    for ti, author, ty, title in targets:
        for oi, name, oy in others:
            w = name.split()
            runs = {"".join(w[i : i + n]) for i in range(len(w)) for n in (1, 2, 3)}
            a, b = ({x for x in v.split() if len(x) >= 3} for v in (title, name))
            full = 40 * (author != "" and author in runs) + 25 * (ty != "" and ty == oy) + 25 * difflib.SequenceMatcher(None, title, name).ratio() + 10 * (len(a & b) / len(a | b))
            if (ti, oi) in got:
                assert got[ti, oi] == pytest.approx(full, abs=1e-5)
            else:
                assert full < 55
    sets_t, sets_o = [(f"t{k}", x.split()) for k, x in enumerate(titles)], [(f"o{k}", x.split()) for k, x in enumerate(reversed(titles))]
    pairs = linkage.candidates(spark.createDataFrame(sets_t, "target_id string, tokens array<string>"), spark.createDataFrame(sets_o, "other_id string, tokens array<string>"), least=0.6)
    met = {(r.target_id, r.other_id) for r in pairs.collect()}
    near = {(x, y) for x, a in sets_t for y, b in sets_o if len(set(a) & set(b)) >= 0.6 * len(set(a) | set(b))}
    assert near <= met and len(met) < 3600


def test_best_links_are_those_of_all_pairs(spark):
    import random

    from evisift.operators import bootstrap
    from evisift.sources.scratch import Scratch

    rng = random.Random(6)
    vocabulary = [f"word{k}" for k in range(9)] + ["the"] * 2
    titles = ["", *(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 4))) for _ in range(25))]
    targets = [(f"t{k}", rng.choice(["smith", "vandenberg", "", "li", None]), rng.choice(["2001", "2002", "", "2004", None]), rng.choice([*titles, None])) for k in range(400)]
    others = [(f"o{k}", f"{rng.choice(['smith', 'smith', 'van den berg', 'jones'])} {y} {rng.choice(titles)}", y) for k, y in enumerate(rng.choices(["2001", "2002", "2003", "", None], k=300))]
    few = [(f"t{k}", "li", "2001", "word1 word2") for k in range(3)], [("o1", "li word1 word2", "2001"), ("o2", "word1 word2", "2001"), ("o3", "word2 word3", "2001"), ("o4", "li 2002 other", "2002")]
    for some, rest in ((targets, others), few, (targets, others[:15]), (targets, others[:2]), (targets, [])):
        t, o = spark.createDataFrame(some, "target_id string, author string, year string, title string"), spark.createDataFrame(rest, "other_id string, name string, year string")
        wanted = linkage.decide(bootstrap.link_scores(t, o))
        assert sorted(map(tuple, bootstrap.best_links(t, o, Scratch(spark, "links")).collect())) == sorted(map(tuple, wanted.collect()))


def test_linkage_of_many_copies(spark, tmp_path):
    """12,000 parts of one brand against 4,000 files of it: 48 million pairs, of ten texts."""
    from pyspark.sql import functions as F

    from evisift.plans import QUERIES

    parts = spark.range(12_000).select(F.col("id").alias("p_partkey"), F.lit("Brand#7").alias("p_brand"), (F.col("id") % 2).cast("int").alias("p_size"), F.concat(F.lit("part "), (F.col("id") % 5).cast("string")).alias("p_name"))
    parts.write.parquet(str(tmp_path / "part.parquet"))
    got = QUERIES["composite_linkage"](spark, str(tmp_path)).collect()
    assert len(got) == 12_000 and {r.decision for r in got} == {"ambiguous"} and {r.gap for r in got} == {0.0}
