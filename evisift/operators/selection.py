"""Selection of a paper's passages: priority, adaptive cap, rescue, quotas, counter-evidence, diversity and budget.

Operators: J19 W13 T2 T3 T4 T5 T6 T7 T8 T9.

What a passage is worth is worked out natively, one column each, and its paper's passages are put in order by an array
sort.  Only the choice itself, in which each step depends on those before, runs in Python: once per paper, over the
passages of that paper's own text, as Arrow batches.

Cases: a paper without passages has no row; passages without an id are never chosen; of passages with one id the first
by priority counts; null scores count as 0, null pages as none, null texts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as texts
from . import contexts
from .signals import monitoring_only

# Fixed values.
SECTIONS = ["introduction", "method", "results", "discussion", "conclusion"]
RESCUE_TERMS = ["introduction", "background", "method", "methods", "methodology", "materials and methods", "participant", "participants", "intervention", "procedure", "outcome", "results", "discussion", "conclusion", "conclusions", "trial", "protocol"]
SIGNATURE_STOP = ["the", "and", "for", "with", "that", "this", "from", "were", "was", "are", "have", "has", "had", "into", "using", "used", "than", "their", "which", "when", "while", "also"]
SIGNATURE_WORDS = 90
SENTENCE_TARGET, SENTENCE_FLOOR = 20, 12
WEAK_PASSAGES, WEAK_WORDS, WEAK_SCORE, FRAGMENTED_SHARE = 3, 280, 0.02, 0.40
LEAST_PASSAGES, LEAST_METHOD, MEDIUM_CAP, MOST_PASSAGES, FALLBACK = 2, 1, 4, 24, 20
BUDGET_SHARE, LEAST_BUDGET, ASSUMED_TOKENS = 0.60, 12_000, 420
SECTION_CAP, PAGE_WINDOW, PAGE_CAP, NEAR_DUPLICATE = 2, 2, 2, 0.82
PAIRS, PAIR_SCORE, PAIR_NEGATIVE, PAIR_PAGES, PAIR_OVERLAP, PAIR_CAP, ANCHOR_SCORE = 2, 0.08, 0.02, 4, 0.10, 6, 0.04


@dataclass(frozen=True)
class Settings:
    """What a run configures: window and output in tokens, number and least score of primary passages."""

    window: int = 78_000
    output: int = 10_000
    top_k: int | None = 10
    threshold: float = 0.005

    @property
    def budget(self) -> int:
        prompt = max(1, self.window - self.output)
        return min(prompt, max(LEAST_BUDGET, int(prompt * BUDGET_SHARE)))


def signature(text: Column) -> Column:
    """Distinct words of three letters and more but for common ones, the first of them in order of the alphabet."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"\b([a-z]{3,})\b"), F.lit(1))
    return F.slice(F.array_sort(F.array_except(F.array_distinct(found), F.array(*map(F.lit, SIGNATURE_STOP)))), 1, SIGNATURE_WORDS)


def hybrid_score(base: Column, label: Column, text: Column, sentences: Column, cues: Column, monitoring: Column) -> Column:
    """Similarity, and what a passage's section, cues, form and purpose add to or take from it."""
    add = lambda on, v: F.when(F.coalesce(on, F.lit(False)), v).otherwise(0.0)
    m, substance = texts.readability(text), texts.substantive_text(text)
    opening = texts.truncate_words(text, 25).rlike(texts.REFERENCE_HEAD) & ~substance
    digits = texts.hits(text, "[0-9]") / F.greatest(F.length(text), F.lit(1))
    dual = cues["action"] & (cues["primary"] | cues["secondary"])
    return (
        base + add(label == "method", 0.05) + F.when(cues["all"], 0.08).when(dual, 0.04).otherwise(0.0) + 0.04 * m["readability_score"]
        + add(sentences > 0, 0.06 * F.least(sentences / SENTENCE_TARGET, F.lit(1.0))) - add((sentences > 0) & (sentences < SENTENCE_FLOOR), 0.08)
        - add(digits > 0.20, 0.05) - add((texts.hits(text, texts.CITATION) >= 6) & ~substance, 0.04) - add(monitoring, 0.10)
        - add((label == "reference") | opening, 0.10) - add(texts.low_quality(text), 0.15)
    )


def prepared(chunks: DataFrame, action: str, primary: str, secondary: str, watched: str) -> DataFrame:
    """paper_id and ``rows``, its passages in order of priority (T2), each a struct of what the choice reads.

    chunks: paper_id, chunk_id, kind, section, text, page, line, sentences, score, pos_score, neg_score, extra (whether it
    was set aside before).  action, primary, secondary, watched: patterns of the cues, watched those of mere observation.
    """
    t, zero = F.coalesce("text", F.lit("")), F.lit(0.0)
    label = contexts.section_of(F.col("section"), t)
    cues = contexts.topic_flags(t, action, primary, secondary)
    monitoring = F.coalesce(monitoring_only(t, f"(?:{primary})|(?:{secondary})", watched, action), F.lit(False))
    m = texts.readability(t)
    base = chunks.select(
        "paper_id", "chunk_id", F.coalesce(F.col("kind") == "title", F.lit(False)).alias("always"), label.alias("label"), t.alias("text"), cues.alias("cues"), monitoring.alias("monitoring"),
        F.coalesce("page", F.lit(0)).alias("page"), F.coalesce("line", F.lit(0)).alias("line"), F.coalesce("sentences", F.lit(0)).alias("sentences"),
        *[F.coalesce(F.nanvl(c, zero), zero).alias(c) for c in ("score", "pos_score", "neg_score")], F.coalesce("extra", F.lit(False)).alias("extra"),
    )
    t, label = F.col("text"), F.col("label")
    is_method = F.coalesce(label == "method", F.lit(False))
    told = t.rlike(texts.METHOD_EVIDENCE)
    wide = base.select(
        "*", texts.reference_dominant(t).alias("references"), texts.low_quality(t).alias("low"), texts.substantive_text(t).alias("substance"), texts.is_boilerplate(t).alias("boilerplate"),
        m["readability_score"].alias("readable"), m["word_count"].cast("int").alias("words"), m["single_char_token_ratio"].alias("single"), signature(t).alias("signature"),
        hybrid_score(F.col("score"), label, t, F.col("sentences"), F.col("cues"), F.col("monitoring")).alias("hybrid"), t.rlike("(?i)" + "|".join(RESCUE_TERMS)).alias("rescue_term"),
        texts.chunk_tokens(t, F.nullif("page", F.lit(0)), F.col("sentences")).cast("int").alias("tokens"),
    )
    dual = F.col("cues.action") & (F.col("cues.primary") | F.col("cues.secondary"))
    key = [
        F.coalesce(label == "reference", F.lit(False)) | F.col("references"), F.col("monitoring"), ~(is_method | told), ~is_method, ~F.col("cues.all"), ~dual,
        -F.col("hybrid"), -F.col("score"), F.col("page"), F.col("line"), F.coalesce("chunk_id", F.lit("")),
    ]
    method = ~F.col("always") & ~F.col("monitoring") & (is_method | (told & ~F.col("references")))
    read = ["chunk_id", "always", "label", "page", "line", "sentences", "score", "pos_score", "neg_score", "extra", "references", "low", "substance", "boilerplate", "readable", "words", "single", "signature", "hybrid", "rescue_term", "tokens"]
    row = F.struct(*[c.alias(f"k{i:02d}") for i, c in enumerate(key)], *read, method.alias("method"))
    kept = F.transform(F.array_sort(F.collect_list(row)), lambda r: F.struct(*[r[c].alias(c) for c in [*read, "method"]]))
    return wide.groupBy("paper_id").agg(kept.alias("rows"))  # bounded by the paper's own text


@dataclass
class Choice:
    """A paper's passages in order of priority, and where those that are taken came from."""

    rows: list[dict[str, Any]]
    settings: Settings
    sources: dict[str, set[str]] = field(default_factory=dict)

    def __post_init__(self):
        seen: set[str] = set()
        self.rows = [r for r in self.rows if r["chunk_id"] and not (r["chunk_id"] in seen or seen.add(r["chunk_id"]))]
        self.place = {r["chunk_id"]: k for k, r in enumerate(self.rows)}
        for r in self.rows:
            r["words_set"] = frozenset(r["signature"] or ())

    def ranked(self, rows: list[dict]) -> list[dict]:
        return sorted(rows, key=lambda r: self.place[r["chunk_id"]])

    def mark(self, rows: list[dict], source: str) -> None:
        for r in rows:
            self.sources.setdefault(r["chunk_id"], set()).add(source)

    def top(self, k: int | None) -> list[dict]:
        """The titles, and the k best of the others over the threshold."""
        rest = sorted((r for r in self.rows if not r["always"] and not r["extra"] and r["score"] >= self.settings.threshold), key=lambda r: (-r["score"], r["page"], r["line"], r["chunk_id"]))
        return [r for r in self.rows if r["always"]] + (rest if k is None else rest[: max(0, k)])

    def caps(self, primary: list[dict], available: int) -> tuple[bool, int, int, bool]:
        """T4: whether the evidence is weak, how many passages may stay, how many must, and whether pairs are looked for."""
        s, best = self.settings, max((r["score"] for r in primary), default=0.0)
        fragments = sum(r["low"] for r in primary) / max(len(primary), 1)
        weak = len(primary) < WEAK_PASSAGES or sum(r["words"] for r in primary) < WEAK_WORDS or best < WEAK_SCORE or fragments > FRAGMENTED_SHARE
        target = min(max(LEAST_PASSAGES, min(MOST_PASSAGES, s.budget // ASSUMED_TOKENS)), available)
        target = target if s.top_k is None else min(target, max(0, s.top_k))
        if weak:
            cap = LEAST_PASSAGES
        elif best >= max(s.threshold + 0.02, 0.04) and len(primary) >= 4:
            cap = target
        elif best >= max(s.threshold + 0.01, 0.02) and len(primary) >= LEAST_PASSAGES:
            cap = MEDIUM_CAP
        else:
            cap = LEAST_PASSAGES
        cap = min(cap, target)
        return weak, cap, min(cap, LEAST_PASSAGES), not weak and cap >= PAIR_CAP and best >= max(s.threshold + 0.01, 0.02)

    def denoised(self, rows: list[dict]) -> list[dict]:
        """Without fragments and reference lists, unless they carry substance or were rescued for their section."""

        def stays(r: dict) -> bool:
            good = not r["low"] and not r["references"] or r["substance"] and not r["boilerplate"]
            if good and (not 0 < r["sentences"] < SENTENCE_FLOOR or r["words"] >= max(40, SENTENCE_FLOOR * 5)):
                return True
            readable = r["readable"] >= 0.45 and r["words"] >= max(35, SENTENCE_FLOOR * 4) and r["single"] <= 0.25 and r["sentences"] >= max(4, SENTENCE_FLOOR // 2)
            return "section_rescue" in self.sources.get(r["chunk_id"], ()) and not r["references"] and readable

        return [r for r in rows if r["always"] or stays(r)]

    def filled(self, rows: list[dict], pool: list[dict], least: int, counts: str | None = None) -> list[dict]:
        """T6, and T7 with counts 'method': passages are added by priority until enough count, good ones before poor ones."""
        kind = lambda r: bool(r[counts]) if counts else not r["always"]
        out, have = list(rows), {r["chunk_id"] for r in rows}
        missing = least - sum(map(kind, out))
        for poor in (False, True):
            for r in self.ranked([r for r in pool if kind(r) and not r["references"]]):
                if missing > 0 and r["chunk_id"] not in have and (poor or not r["low"]):
                    out.append(r)
                    have.add(r["chunk_id"])
                    missing -= 1
        return out

    def paired(self, rows: list[dict], pool: list[dict], cap: int) -> list[dict]:
        """For the best passages, one each that speaks against them: of their section, near them, or in their words."""
        have = {r["chunk_id"] for r in rows}
        anchors = self.ranked([r for r in rows if not r["always"]])
        anchors = [r for r in anchors if r["score"] >= ANCHOR_SCORE] or anchors
        against = [
            r for r in self.ranked(pool)
            if not r["always"] and r["chunk_id"] not in have and not r["references"] and not r["low"] and r["neg_score"] >= PAIR_NEGATIVE and (r["score"] <= PAIR_SCORE or r["neg_score"] > r["pos_score"])
        ]
        out, left = list(rows), min(PAIRS, max(1, cap // 6))
        for a in anchors:
            if not left:
                break
            best = None
            for c in against:
                same, near = bool(a["label"]) and a["label"] == c["label"], a["page"] > 0 and c["page"] > 0 and abs(a["page"] - c["page"]) <= PAIR_PAGES
                overlap = _jaccard(a["words_set"], c["words_set"])
                rank = (not same, not near, c["pos_score"] - c["neg_score"], abs(c["score"]), -overlap, self.place[c["chunk_id"]])
                if (same or near or overlap >= PAIR_OVERLAP) and (best is None or rank < best[0]):
                    best = rank, c
            if best:
                out.append(best[1])
                against.remove(best[1])
                self.mark([best[1]], "counterevidence")
                self.mark([a], "counterevidence_anchor")
                left -= 1
        return out

    def diverse(self, rows: list[dict], target: int) -> list[dict]:
        """First what must stay, then one of each section, then by priority under caps that are relaxed twice."""
        ranked = self.ranked({r["chunk_id"]: r for r in rows}.values())
        target, picked, taken = min(max(target, 0), len(ranked)), [], set()
        section, window = lambda r: r["label"] if r["label"] in SECTIONS else None, lambda r: (r["page"] - 1) // PAGE_WINDOW if r["page"] > 0 else None
        twin = lambda r: any(_jaccard(r["words_set"], p["words_set"]) >= NEAR_DUPLICATE for p in picked)
        count = lambda of, value: sum(of(p) == value for p in picked) if value is not None else 0

        def take(r: dict) -> None:
            picked.append(r)
            taken.add(r["chunk_id"])

        for r in ranked:
            if len(picked) < target and "counterevidence" in self.sources.get(r["chunk_id"], ()):
                take(r)
        for name in SECTIONS:
            first = next((r for r in ranked if r["label"] == name and r["chunk_id"] not in taken and not r["references"] and not twin(r)), None)
            if first and len(picked) < target:
                take(first)
        for level in range(4):
            for r in ranked:
                if len(picked) >= target:
                    return picked
                if r["chunk_id"] in taken or level < 3 and r["references"]:
                    continue
                pages = count(window, window(r))
                if level == 0 and (count(section, section(r)) >= SECTION_CAP or pages >= PAGE_CAP) or level == 1 and pages > PAGE_CAP or level < 2 and twin(r):
                    continue
                take(r)
        return picked

    def affordable(self, rows: list[dict]) -> list[dict]:
        """In order, what fits the budget; the first few whatever they cost."""
        out, used = [], 0
        for r in rows:
            if len(out) < LEAST_PASSAGES or used + r["tokens"] <= self.settings.budget:
                out.append(r)
                used += r["tokens"]
        return out

    def balanced(self, rows: list[dict], most: int) -> list[dict]:
        """The weak path's passages: a good one of each section, then rescued ones and the others by priority."""
        rescued = lambda r: "section_rescue" in self.sources.get(r["chunk_id"], ())
        order = sorted((r for r in rows if not r["always"] and not r["references"]), key=lambda r: (not rescued(r), self.place[r["chunk_id"]]))
        out = [f for name in SECTIONS if (f := next((r for r in order if r["label"] == name and not r["low"]), None))]
        have = {r["chunk_id"] for r in out}
        return (out + [r for r in order if r["chunk_id"] not in have])[: max(most, 0)]

    def run(self) -> list[dict]:
        """T5: the chosen passages, titles first, each with its sources."""
        titles = lambda rows: [r for r in rows if r["always"]]
        others = lambda rows: [r for r in rows if not r["always"]]
        pool = [r for r in self.rows if not r["always"] and not r["references"]]
        chosen = self.top(self.settings.top_k)
        primary = others(chosen)
        self.mark(chosen, "primary")
        weak, cap, least, pairs = self.caps(primary, len(pool))
        ranked = self.ranked(primary)
        if weak:
            k = self.settings.top_k
            most = min(FALLBACK, max(min(self.settings.budget // ASSUMED_TOKENS, MOST_PASSAGES, len(pool)), LEAST_PASSAGES)) if k is None else max(0, k)
            fallback = self.top(most)
            self.mark(fallback, "fallback")
            for r in others(fallback):
                if r["rescue_term"] or r["label"] in SECTIONS:
                    self.mark([r], "section_rescue")
                if r["label"]:
                    self.mark([r], f"section:{r['label']}")
            ranked = self.balanced([*{r["chunk_id"]: r for r in [*chosen, *fallback]}.values()], most)
            chosen = titles(chosen) + ranked
        chosen = self.denoised(chosen)
        if least and not others(chosen):
            good = [r for r in ranked if not r["low"] and not r["references"]][:least] if weak else []
            raw = [r for r in self.rows if not r["always"] and not r["extra"] and not r["references"] and not r["low"]][:least]
            if not good:
                self.mark(raw, "raw_rescue")
            chosen = chosen + (good or raw)
        quota = pool or ranked
        chosen = self.filled(chosen, quota, min(LEAST_METHOD, cap), "method")
        chosen = self.filled(chosen, quota, least)
        if pairs:
            chosen = self.paired(chosen, quota, cap)
        kept = self.affordable(self.diverse(others(chosen), cap))
        default = {"fallback" if weak else "primary"}
        return [{"chunk_id": r["chunk_id"], "hybrid_score": round(r["hybrid"], 6), "sources": sorted(self.sources.get(r["chunk_id"], default))} for r in self.ranked(titles(chosen)) + self.ranked(kept)]


def _jaccard(a: frozenset, b: frozenset) -> float:
    return len(a & b) / len(a | b) if a and b else 0.0


def select(chunks: DataFrame, action: str, primary: str, secondary: str, watched: str, settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """T5: paper_id, place (from 1), chunk_id, hybrid_score and sources of the passages chosen for each paper."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            out = []
            for paper, rows in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True):
                out += [{"paper_id": paper, "place": k + 1, **r} for k, r in enumerate(Choice(rows, settings).run())]
            yield pa.RecordBatch.from_pylist(out, schema)

    papers = prepared(chunks, action, primary, secondary, watched)
    kind = papers.schema["paper_id"].dataType
    schema = pa.schema([("paper_id", {"bigint": pa.int64(), "int": pa.int32()}.get(kind.simpleString(), pa.string())), ("place", pa.int32()), ("chunk_id", pa.string()), ("hybrid_score", pa.float64()), ("sources", pa.list_(pa.string()))])
    return papers.mapInArrow(run, f"paper_id {kind.simpleString()}, place int, chunk_id string, hybrid_score double, sources array<string>")
