"""Toxicity: a linear classifier on character n-grams whose features are scaled by naive Bayes log-count ratios.

* Text is lower-cased, white-space runs become one space, and n-grams of ``ORDERS`` characters are hashed into
  ``2**BITS`` buckets; a bucket counts once per text and order.
* Counts: every labelled training row counts.  Each task sums its rows' buckets into dense arrays, cut into ranges,
  so what is shuffled per task has a fixed size; ranges are then added up.  From them come the log-count ratios
  r = log((pos + 1) / (n_pos + 2)) - log((neg + 1) / (n_neg + 2)) and, for choosing buckets, r over its standard error.
* All buckets of at least ``LEAST_RATIO`` that are significant among 2**BITS of them (``LEAST_Z``) are kept, however many
  there are; x = r for a bucket that a text has, else 0.
* Fit: L2-regularised logistic regression on the driver, over a sample of at most about ``max_fit_rows`` training rows,
  chosen by a hash of doc_id.  That bound is a parameter and the only sampling there is.

Cases: null text is empty; an empty text scores the intercept; repeated doc_ids are scored row by row, and of several
labels of one doc_id the largest counts; null labels are left out; very long texts are scored whole, in slices; with
no labelled row at all every score is 0.25; an empty table gives no rows; other columns of the input are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import Scratch, lean, unused
from .textwords import _powers

ORDERS, BITS, RANGES = (3, 4, 5, 6), 20, 1024
#: Buckets whose log-count ratio is nearer to 0 tell nothing.
LEAST_RATIO = 0.7
#: Standard errors from 0 that one in 2,000 of the buckets that tell nothing reaches by chance.
LEAST_Z = 3.5
FOLDS = 5
_BASE = 0x9E3779B97F4A7C15
_SPACE = re.compile(r"\s+")


class ToxicityModel(NamedTuple):
    """Chosen buckets, the log-count ratio and the fitted weight of each, and the intercept."""

    buckets: np.ndarray
    ratios: np.ndarray
    weights: np.ndarray
    intercept: float


def _slices(texts: list[str | None], limit: int = 1 << 19) -> Iterator[tuple[int, list[str]]]:
    lo, n, out = 0, 0, []
    for i, t in enumerate(texts):
        t = _SPACE.sub(" ", (t or "").lower())
        if out and n + len(t) > limit:
            yield lo, out
            lo, n, out = i, 0, []
        out.append(t)
        n += len(t)
    if out:
        yield lo, out


#: One odd factor an order, so that equal letters of different orders fall apart.
_FACTORS = {n: pow(0xD1342543DE82EF95, n, 1 << 64) for n in ORDERS}


def buckets(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: where each text's n-grams begin (and the end), and the bucket of every n-gram of the texts."""
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) for t in texts], np.int64)
    end = np.cumsum(size)
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), np.cumsum((code.astype(np.uint64) + np.uint64(1)) * _powers(max(1, len(code)), _BASE)[: len(code)])]
        back = _powers(max(1, len(code)), pow(_BASE, -1, 1 << 64))
        for n in ORDERS:
            m = max(0, len(code) - n + 1)
            bucket = (((sums[n:] - sums[: len(sums) - n]) * (back[:m] * np.uint64(_FACTORS[n]))) >> np.uint64(64 - BITS)).astype(np.int32) if m else np.zeros(0, np.int32)
            # The last n - 1 places of each text would reach into the next one.
            over = (end[:, None] - np.arange(1, n)).ravel()
            keep = np.ones(m, bool)
            keep[over[(over >= 0) & (over < m)]] = False
            yield np.r_[0, np.cumsum(np.maximum(0, size - n + 1))], bucket[keep]


@lean
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the task's rows by class and bucket, and in range -1 the number of rows of each class."""
    total, rows = np.zeros((2, 1 << BITS), np.int32), np.zeros(2, np.int64)
    last, number = np.zeros(1 << BITS, np.int32), np.zeros(0, np.int32)
    for x in batches:
        label = np.asarray(x.column("toxic")).astype(np.int64)
        rows += np.bincount(label, minlength=2)
        for lo, texts in _slices(x.column("text").to_pylist()):
            for cut, bucket in buckets(texts):
                if len(bucket) > len(number):
                    number = np.arange(2 * len(bucket), dtype=np.int32)
                for k in range(len(texts)):
                    own = bucket[cut[k] : cut[k + 1]]
                    # Of places with one bucket the last one written stays: each bucket counts once per text and order.
                    last[own] = number[: len(own)]
                    total[label[lo + k]][own[last[own] == number[: len(own)]]] += 1
    if rows.sum():
        width = (1 << BITS) // RANGES
        cut = total.reshape(2, RANGES, width)
        yield pa.record_batch({"range": pa.array(np.arange(RANGES, dtype=np.int32)), "counts": pa.array([cut[:, k].tobytes() for k in range(RANGES)], pa.binary())})
        yield pa.record_batch({"range": pa.array([-1], pa.int32()), "counts": pa.array([rows.tobytes()], pa.binary())})


@lean
def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the arrays of each range; the rows come sorted by range."""
    now, total = None, None
    for x in batches:
        for r, c in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True):
            part = np.frombuffer(c, np.int64 if r < 0 or len(c) == 2 * 8 * (1 << BITS) // RANGES else np.int32).astype(np.int64)
            if r != now:
                if now is not None:
                    yield pa.record_batch({"range": pa.array([now], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})
                now, total = r, np.zeros(len(part), np.int64)
            total = total + part
    if now is not None:
        yield pa.record_batch({"range": pa.array([now], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def _significant(n: tuple[int, int]):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = (1 << BITS) // RANGES
        for x in batches:
            for r, c in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True):
                if r >= 0:
                    neg, pos = np.frombuffer(c, np.int64).reshape(2, width).astype(float)
                    ratio = np.log((pos + 1) / (n[1] + 2)) - np.log((neg + 1) / (n[0] + 2))
                    z = np.abs(ratio) / np.sqrt(1 / (pos + 1) + 1 / (neg + 1))
                    best = np.flatnonzero((z >= LEAST_Z) & (np.abs(ratio) >= LEAST_RATIO))
                    yield pa.record_batch({"bucket": pa.array(r * width + best, pa.int64()), "ratio": ratio[best]})

    return run


def _chosen(table: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text and feature number of each chosen bucket that a text has."""
    docs, feats = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for cut, bucket in buckets(texts):
        f = table[bucket]
        hit = np.flatnonzero(f >= 0)
        docs.append(np.searchsorted(cut, hit, "right") - 1)
        feats.append(f[hit].astype(np.int64))
    both = np.unique((np.concatenate(docs) << 32) | np.concatenate(feats))
    return both >> 32, both & 0xFFFFFFFF


def _table(chosen: np.ndarray) -> np.ndarray:
    table = np.full(1 << BITS, -1, np.int32)
    table[chosen] = np.arange(len(chosen), dtype=np.int32)
    return table


def _features(chosen: np.ndarray):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(chosen)
        for x in batches:
            label = x.column("toxic").to_pylist()
            for lo, texts in _slices(x.column("text").to_pylist()):
                doc, feat = _chosen(table, texts)
                cut = np.searchsorted(doc, np.arange(len(texts) + 1))
                yield pa.record_batch({"toxic": pa.array(label[lo : lo + len(texts)], pa.int32()), "features": pa.array([feat[a:b].astype(np.int32).tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary())})

    return run


def logistic(feature: np.ndarray, cut: np.ndarray, ratio: np.ndarray, y: np.ndarray, l2: float = 1.0, rounds: int = 250, chunk: int = 1 << 20) -> tuple[np.ndarray, float]:
    """Weights and intercept of L2-regularised logistic regression by Adam on the full gradient.

    Row k has the features cut[k]:cut[k + 1], each worth its ratio; rows are passed over in chunks, so that little more
    than the features themselves is held.
    """
    width = len(ratio)
    w, m, v, rate = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1), 0.05
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    parts, lo = [], 0
    while lo < len(y):
        hi = max(lo + 1, int(np.searchsorted(cut, cut[lo] + chunk, "right")) - 1)
        parts.append((lo, hi))
        lo = hi
    for k in range(1, rounds + 1):
        worth, g = w[:-1] * ratio, np.zeros(width + 1)
        for lo, hi in parts:
            own, size = feature[cut[lo] : cut[hi]], np.diff(cut[lo : hi + 1])
            total = np.diff(np.r_[0.0, np.cumsum(worth[own])][cut[lo : hi + 1] - cut[lo]])
            off = 1 / (1 + np.exp(-np.clip(total + w[-1], -40, 40))) - y[lo:hi]
            g[:-1] += np.bincount(own, np.repeat(off, size), width) * ratio
            g[-1] += off.sum()
        g[:-1] += l2 * w[:-1]
        g /= len(y)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * min(1, 2 * (rounds - k) / rounds) * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-9)
    return w[:-1], float(w[-1])


def fit(training: DataFrame, scratch: Scratch, max_fit_rows: int = 16_000) -> ToxicityModel:
    """The model of training rows doc_id, text, toxic (0 or 1)."""
    training = training.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    parts = training.select("text", "toxic").mapInArrow(_count, "range int, counts binary")
    sums = scratch.table(parts.repartition("range").sortWithinPartitions("range").mapInArrow(_sum, "range int, counts binary"), "sums")
    head = sums.where("range = -1").first()
    if head is None:
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), np.zeros(0), float(np.log(0.25 / 0.75)))
    n = tuple(int(k) for k in np.frombuffer(head.counts, np.int64))
    best = sums.mapInArrow(_significant(n), "bucket long, ratio double").toArrow().sort_by("bucket")  # 2**BITS rows at most
    chosen, ratios = best.column("bucket").to_numpy(), best.column("ratio").to_numpy()
    share = min(1.0, max_fit_rows / max(1, sum(n)))
    sample = training.where(F.expr(f"pmod(xxhash64(doc_id), 1048576) < {int(share * 1048576)}"))
    rows = sample.mapInArrow(_features(chosen), "toxic int, features binary").toArrow()
    if not rows.num_rows:
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), np.zeros(0), float(np.log(0.25 / 0.75)))
    y = rows.column("toxic").to_numpy().astype(float)
    feature = np.concatenate([np.frombuffer(f.as_py(), np.int32) for f in rows.column("features")])
    cut = np.r_[0, np.cumsum(pc.binary_length(rows.column("features")).to_numpy() // 4, dtype=np.int64)]
    del rows
    weights, intercept = logistic(feature, cut, ratios, y)
    return ToxicityModel(chosen, ratios, weights, intercept)


def _scorer(model: ToxicityModel, keep: list[str]):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, worth = _table(model.buckets), model.weights * model.ratios
        for x in batches:
            out = np.zeros(x.num_rows)
            for lo, texts in _slices(x.column(0).to_pylist()):
                doc, feat = _chosen(table, texts)
                out[lo : lo + len(texts)] = np.bincount(doc, worth[feat], len(texts))
            score = 1 / (1 + np.exp(-np.clip(out + model.intercept, -40, 40)))
            yield pa.RecordBatch.from_arrays([*x.columns[1:], pa.array(score)], [*keep, "toxicity_score"])

    return run


def score(df: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """df with toxicity_score; a column of that name is replaced."""
    df = df.drop("toxicity_score")
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.select(F.col(text).cast("string").alias(unused(df, "__text")), *[F.col(f"`{c}`") for c in df.columns]).mapInArrow(_scorer(model, df.columns), f"{kind}, toxicity_score double")


def held_out(doc_id: str = "doc_id"):
    """Whether a row is never learned from: crc32 of the id's decimal text, modulo FOLDS, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def training_rows(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic of the labelled rows that may be learned from."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where("toxic in (0, 1)").hint("merge")
    # A merge join at every size: labels grow with the corpus.
    return documents.select("doc_id", "text").where(~held_out()).join(known.where(~held_out()).hint("merge"), "doc_id")


def op4_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scratch = Scratch(documents.sparkSession, "toxicity")
    model = fit(training_rows(documents, labels), scratch)
    out = score(documents.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), F.col("toxicity_score").alias("score"), (F.col("toxicity_score") >= 0.5).cast("int").alias("predicted"))
