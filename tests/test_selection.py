"""The choice of passages against a plain statement of its rules, on random papers; order and scores on real texts."""

import random

import pytest

import __spark_entry__ as entry
from evisift.operators import selection
from evisift.operators.selection import SECTIONS, Choice, Settings


def jaccard(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a and b else 0


def plain(rows, top_k, threshold, budget):
    """Rules in the order in which they act; rows are by priority, p their place."""
    rows = [dict(r, p=k) for k, r in enumerate(rows)]
    titles, rest = [r for r in rows if r["always"]], [r for r in rows if not r["always"]]
    by_score = sorted([r for r in rest if not r["extra"] and r["score"] >= threshold], key=lambda r: (-r["score"], r["page"], r["line"], r["chunk_id"]))
    primary = by_score[:top_k]
    source = {r["chunk_id"]: {"primary"} for r in primary + titles}
    pool = [r for r in rest if not r["references"]]
    top = max([r["score"] for r in primary] + [0])
    weak = len(primary) < 3 or sum(r["words"] for r in primary) < 280 or top < 0.02 or sum(r["low"] for r in primary) > 0.4 * len(primary)
    room = min(max(2, min(24, budget // 420)), len(pool), top_k)
    if weak:
        cap = min(room, 2)
    elif top >= max(threshold + 0.02, 0.04) and len(primary) >= 4:
        cap = room
    elif top >= max(threshold + 0.01, 0.02) and len(primary) >= 2:
        cap = min(room, 4)
    else:
        cap = min(room, 2)
    least = min(cap, 2)
    chosen = list(primary)
    if weak:
        for r in titles + primary:
            source.setdefault(r["chunk_id"], set()).add("fallback")
        for r in primary:
            if r["rescue_term"] or r["label"] in SECTIONS:
                source[r["chunk_id"]].add("section_rescue")
            if r["label"]:
                source[r["chunk_id"]].add("section:" + r["label"])
        order = [r for r in sorted(primary, key=lambda r: ("section_rescue" not in source[r["chunk_id"]], r["p"])) if not r["references"]]
        chosen = []
        for s in SECTIONS:
            for r in order:
                if r["label"] == s and not r["low"]:
                    chosen.append(r)
                    break
        for r in order:
            if r not in chosen and len(chosen) < top_k:
                chosen.append(r)
        chosen = chosen[:top_k]
    before = list(chosen)
    stay = []
    for r in chosen:
        ok = (not r["low"] and not r["references"]) or (r["substance"] and not r["boilerplate"])
        if ok and 0 < r["sentences"] < 12 and r["words"] < 60:
            ok = False
        if not ok and "section_rescue" in source.get(r["chunk_id"], ()):
            ok = not r["references"] and r["readable"] >= 0.45 and r["words"] >= 48 and r["single"] <= 0.25 and r["sentences"] >= 6
        if ok:
            stay.append(r)
    chosen = stay
    if least and not chosen:
        if weak:
            chosen = [r for r in before if not r["low"] and not r["references"]][:least]
        if not chosen:
            chosen = [r for r in rest if not r["extra"] and not r["references"] and not r["low"]][:least]
            for r in chosen:
                source.setdefault(r["chunk_id"], set()).add("raw_rescue")
    quota = pool or sorted(before if weak else primary, key=lambda r: r["p"])
    for need, test in ((min(1, cap), lambda r: r["method"]), (least, lambda r: True)):
        for low_too in (False, True):
            for r in quota:
                if sum(1 for c in chosen if test(c)) >= need:
                    break
                if test(r) and not r["references"] and r not in chosen and (low_too or not r["low"]):
                    chosen.append(r)
    if not weak and cap >= 6 and top >= max(threshold + 0.01, 0.02):
        anchors = sorted([r for r in chosen if r["score"] >= 0.04] or chosen, key=lambda r: r["p"])
        against = [r for r in quota if r not in chosen and not r["references"] and not r["low"] and r["neg_score"] >= 0.02 and (r["score"] <= 0.08 or r["neg_score"] > r["pos_score"])]
        added = 0
        for a in anchors:
            ranks = []
            for c in against:
                same, near, both = a["label"] is not None and a["label"] == c["label"], min(a["page"], c["page"]) > 0 and abs(a["page"] - c["page"]) <= 4, jaccard(a["signature"], c["signature"])
                if same or near or both >= 0.1:
                    ranks.append((not same, not near, c["pos_score"] - c["neg_score"], abs(c["score"]), -both, c["p"], c))
            if ranks and added < min(2, max(1, cap // 6)):
                best = min(ranks, key=lambda x: x[:6])[6]
                against = [c for c in against if c is not best]
                chosen.append(best)
                source.setdefault(best["chunk_id"], set()).add("counterevidence")
                source.setdefault(a["chunk_id"], set()).add("counterevidence_anchor")
                added += 1
    order, out = sorted(chosen, key=lambda r: r["p"]), []
    target = min(cap, len(order))
    out = [r for r in order if "counterevidence" in source.get(r["chunk_id"], ())][:target]
    twin = lambda r: any(jaccard(r["signature"], o["signature"]) >= 0.82 for o in out)
    for s in SECTIONS:
        for r in order:
            if len(out) < target and r["label"] == s and r not in out and not r["references"] and not twin(r):
                out.append(r)
                break
    for level in (0, 1, 2, 3):
        for r in order:
            if len(out) >= target or r in out or (level < 3 and r["references"]):
                continue
            pages = sum(1 for o in out if o["page"] > 0 and r["page"] > 0 and (o["page"] - 1) // 2 == (r["page"] - 1) // 2)
            if level == 0 and (r["label"] in SECTIONS and sum(1 for o in out if o["label"] == r["label"]) >= 2 or pages >= 2):
                continue
            if level == 1 and pages >= 3 or level < 2 and twin(r):
                continue
            out.append(r)
    kept, used = [], 0
    for r in out:
        if len(kept) < 2 or used + r["tokens"] <= budget:
            kept.append(r)
            used += r["tokens"]
    default = {"fallback"} if weak else {"primary"}
    return [(r["chunk_id"], sorted(source.get(r["chunk_id"], default))) for r in titles + sorted(kept, key=lambda r: r["p"])], weak


def test_choice_equals_the_plain_rules():
    rng = random.Random(7)
    weak = pairs = rescued = 0
    for trial in range(3000):
        n = rng.randrange(1, 40)
        strong = rng.random() < 0.7
        bits = {k: rng.choice([0.0, 0.1, 0.5, 1.0]) for k in ("references", "low", "substance", "boilerplate", "method", "rescue_term", "extra")}
        vocabulary = [f"w{k}" for k in range(rng.choice([3, 12, 60]))]
        rows = [
            {k: rng.random() < p for k, p in bits.items()}
            | {"chunk_id": f"c{k:03d}", "always": rng.random() < 0.08, "label": rng.choice([None, "reference", *SECTIONS]), "page": rng.randrange(0, 12), "line": k, "sentences": rng.choice([0, 3, 8, 20]), "words": rng.choice([10, 50, 70, 200])}
            | {"score": rng.choice([0, 0.004, 0.02, 0.05, 0.3]) * (1 if strong else 0.05), "pos_score": rng.random() / 10, "neg_score": rng.random() / 10, "readable": rng.random(), "single": rng.random() / 2, "hybrid": 0.0}
            | {"signature": rng.sample(vocabulary, min(len(vocabulary), rng.randrange(0, 9))), "tokens": rng.choice([40, 400, 9000])}
            for k in range(n)
        ]
        for r in rows:
            r["method"] = r["method"] and not r["always"]
        s = Settings(top_k=rng.choice([0, 2, 5, 10, 24]))
        want, was_weak = plain(rows, s.top_k, s.threshold, s.budget)
        got = [(r["chunk_id"], r["sources"]) for r in Choice([dict(r) for r in rows], s).run()]
        assert got == want, trial
        weak += was_weak
        pairs += any("counterevidence" in src for _, src in got)
        rescued += any("raw_rescue" in src for _, src in got)
    assert weak > 300 and pairs > 100 and rescued > 20


def test_settings():
    assert Settings().budget == 40_800 and Settings(window=9_000, output=1_000).budget == 8_000
    assert [r["chunk_id"] for r in Choice([], Settings()).run()] == []


def test_selection_over_documents(spark):
    sf = "/root/testdata/sf0.001"
    order = {(r.paper_id, r.chunk_id): (r.place, r.hybrid_score) for r in entry.queries()["passage_priority"](spark, sf).collect()}
    chosen = entry.queries()["passage_selection"](spark, sf).collect()
    papers = {p for p, _ in order}
    assert {r.paper_id for r in chosen} == papers and all((r.paper_id, r.chunk_id) in order for r in chosen)
    assert all(order[r.paper_id, r.chunk_id][1] == pytest.approx(r.hybrid_score, abs=1e-6) for r in chosen)
    for p in papers:
        own = sorted((r for r in chosen if r.paper_id == p), key=lambda r: r.place)
        assert [r.place for r in own] == list(range(1, len(own) + 1)) and own[0].chunk_id.endswith("::000000") and len(own) <= 11
        assert [order[p, r.chunk_id][0] for r in own[1:]] == sorted(order[p, r.chunk_id][0] for r in own[1:])


def test_missing_cells(spark):
    rows = [("p", None, None, None, None, None, None, None, None, None, None, None), ("p", "a", "title", None, "t", None, None, None, float("nan"), None, None, None), ("p", "a", "title", None, "again", 1, 1, 1, 0.5, 0.1, 0.1, False)]
    df = spark.createDataFrame(rows, "paper_id string, chunk_id string, kind string, section string, text string, page int, line int, sentences int, score double, pos_score double, neg_score double, extra boolean")
    assert [(r.paper_id, r.chunk_id) for r in selection.select(df, "a", "b", "c", "d").collect()] == [("p", "a")]
    assert selection.select(df.limit(0), "a", "b", "c", "d").count() == 0
