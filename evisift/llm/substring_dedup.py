"""Substring dedup with difference-cover anchors.

A window is ``WINDOW`` consecutive words.  Residues ``COVER`` modulo ``PERIOD`` have every difference, so for any two
places of equal windows there is one shift below PERIOD at which both places have a cover residue; with an anchor of
``ANCHOR`` = WINDOW - PERIOD + 1 words, that shared anchor lies within both windows.  Hence:

1. Anchors are hashed only at cover positions (4 of 13), dealt out by their hash, and those that occur more than once
   are found.
2. They are extended: every window that holds a repeated anchor is compared with all others, by 128 bits made of two
   independent hashes of each of its words, and every occurrence but the earliest (doc_id, start) is a repeat.
3. The words of repeated windows are removed.

One record is one row, so the rows of each step are at most the anchors and windows of the input, however many
partitions there are.  Within a slice of text, occurrences of one hash are reduced before the shuffle: in step 1 to one
record, in step 2 to the earliest one, and the others are answered on the spot.  So a passage that a third of all
documents share sends one record per slice.  Answers (document, place) are gathered per document, which bounds them by
its words, and meet the texts in a join.

A document is known by its doc_id and a hash of its text, so that documents without an id, or with one and the same,
are not mistaken for each other.

Cases: null text has no words; a text of fewer than WINDOW words has no window; null doc_id counts as the smallest
id; rows that repeat a doc_id and text are one document, so neither copy precedes the other; of different texts with
one doc_id the window that starts earlier in its text precedes, at equal starts neither; very long texts are whole
slices; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowstream import whole_groups
from .runtime import Scratch, lean
from .textwords import Words, inside, ngrams, words

# A perfect difference set.
PERIOD, COVER = 13, (0, 1, 3, 9)
WINDOW = 20
ANCHOR = WINDOW - PERIOD + 1
#: Words worked on before records are handed on; bounds a task's memory and is what a hot hash is reduced over.
CHUNK_WORDS = 1 << 21
#: Rows handed on at once.
SENT = 1 << 16
#: Kinds of rows: a hash met once, a place known to be a repeat, a hash that is known to repeat and asks for no answer.
ONCE, ANSWER, KNOWN = 0, 1, 2
NULL_ID = -(1 << 63)


def _table(**columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The columns in batches; 64-bit hashes go as signed numbers."""
    own = {k: v.view(np.int64) if v.dtype == np.uint64 else v for k, v in columns.items()}
    for at in range(0, len(next(iter(own.values()))), SENT):
        yield pa.record_batch({k: pa.array(v[at : at + SENT]) for k, v in own.items()})


def _places(w: Words, refs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of n-grams within one row: index of their first word in w, its row's ref and place in the text."""
    at = np.flatnonzero(inside(w, n))
    row = w.row_of()[at]
    return at, refs[w.lo + row], (at - w.first[row]).astype(np.int32)


def _numbers(column: pa.Array) -> np.ndarray:
    return np.ascontiguousarray(column.to_numpy(zero_copy_only=False))


def _rows_of(h: np.ndarray, ref: np.ndarray, pos: np.ndarray, kind: int) -> Iterator[pa.RecordBatch]:
    yield from _table(h=h, ref=ref, pos=pos, kind=np.full(len(h), kind, np.int32))


@lean
def _anchor_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """h, ref, pos, kind: the anchors at cover positions, one record per hash and slice."""

    def flush() -> Iterator[pa.RecordBatch]:
        h, ref, pos = (np.concatenate(c) for c in zip(*held, strict=True))
        _, at, back, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        twice = n[back] > 1
        yield from _rows_of(h[twice], ref[twice], pos[twice], ANSWER)
        for kind, some in ((ONCE, at[n == 1]), (KNOWN, at[n > 1])):
            yield from _rows_of(h[some], ref[some], pos[some], kind)

    held, size = [], 0
    for x in batches:
        refs = _numbers(x.column("ref"))
        for w in words(x.column("text")):
            if len(w.hashes) < WINDOW:
                continue
            h = ngrams(w.hashes, ANCHOR)
            at, ref, pos = _places(w, refs, ANCHOR)
            long = np.diff(w.first)[w.row_of()[at]] >= WINDOW
            keep = np.isin(pos % PERIOD, COVER) & long
            held.append((h[at[keep]], ref[keep], pos[keep]))
            size += len(w.hashes)
            if size >= CHUNK_WORDS:
                yield from flush()
                held, size = [], 0
    if held:
        yield from flush()


@lean
def _repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ref, pos of the anchors met once in their slice whose hash occurs in another one; rows come sorted by hash."""
    for t, cut in whole_groups(batches, ["h"]):
        again = np.repeat(np.diff(cut) > 1, np.diff(cut)) & (t.column("kind").to_numpy() == ONCE)
        yield from _table(ref=t.column("ref").to_numpy()[again], pos=t.column("pos").to_numpy()[again])


def _later(hashes: tuple[np.ndarray, np.ndarray], doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Which occurrences come after the earliest place of their window."""
    one, two = hashes
    order = np.lexsort((pos, doc, two, one))
    a, b, ds, ps = one[order], two[order], doc[order], pos[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    out = np.zeros(len(order), bool)
    out[order] = (ds != ds[first]) | (ps != ps[first])
    return out


def _marks(w: Words, at: pa.Array) -> np.ndarray:
    """Which words of w begin a place that the lists of their rows name."""
    own = at.slice(w.lo, w.hi - w.lo)
    size = np.asarray(own.value_lengths().fill_null(0))
    row = np.repeat(np.arange(len(size)), size)
    place = np.asarray(own.flatten()).astype(np.int64)
    ok = place < np.diff(w.first)[row]
    out = np.zeros(len(w.hashes), bool)
    out[w.first[row[ok]] + place[ok]] = True
    return out


@lean
def _window_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """h, other, doc, ref, pos, kind of the windows that hold a repeated anchor, the earliest of each window and slice."""

    def flush() -> Iterator[pa.RecordBatch]:
        h, other, doc, ref, pos = (np.concatenate(c) for c in zip(*held, strict=True))
        later = _later((h, other), doc, pos)
        for some, kind in ((later, ANSWER), (~later, ONCE)):
            yield from _table(h=h[some], other=other[some], doc=doc[some], ref=ref[some], pos=pos[some], kind=np.full(int(some.sum()), kind, np.int32))

    held, size = [], 0
    for x in batches:
        refs, docs = _numbers(x.column("ref")), _numbers(x.column("doc"))
        for w in words(x.column("text"), lanes=2):
            marks = _marks(w, x.column("at"))
            if not marks.any():
                continue
            at, ref, pos = _places(w, refs, WINDOW)
            doc = docs[w.lo + w.row_of()[at]]
            sums = np.r_[0, np.cumsum(marks)]
            keep = sums[at + PERIOD] > sums[at]
            at = at[keep]
            held.append((ngrams(w.hashes, WINDOW)[at], ngrams(w.second, WINDOW, 2)[at], doc[keep], ref[keep], pos[keep]))
            size += len(at)
            if size >= CHUNK_WORDS:
                yield from flush()
                held, size = [], 0
    if held:
        yield from flush()


@lean
def _later_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, ref, pos of every occurrence after the earliest; rows come sorted by hash, other, doc and pos."""
    for t, cut in whole_groups(batches, ["h", "other"]):
        doc, pos = t.column("doc").to_numpy(), t.column("pos").to_numpy()
        first = np.repeat(cut[:-1], np.diff(cut))
        later = (doc != doc[first]) | (pos != pos[first])
        yield from _table(doc=doc[later], ref=t.column("ref").to_numpy()[later], pos=pos[later])


@lean
def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for x in batches:
        ids, texts = x.column("doc_id"), x.column("text")
        for w in words(texts):
            marks = _marks(w, x.column("at"))
            cover = np.r_[0, np.cumsum(marks)]
            at = np.arange(len(marks))
            # A window that begins in the text before cannot reach into this one: it lies within its own row.
            row = w.row_of()
            gone = cover[at + 1] > cover[np.maximum(at + 1 - WINDOW, w.first[row])] if len(at) else marks
            lost = np.diff(np.r_[0, np.cumsum(gone)][w.first])
            kept = []
            for k in range(w.hi - w.lo):
                tokens = (texts[w.lo + k].as_py() or "").encode("utf-8", "surrogatepass").split()
                if lost[k]:
                    tokens = compress(tokens, (~gone[w.first[k] : w.first[k + 1]]).tolist())
                kept.append(b" ".join(tokens))
            yield pa.record_batch({
                "doc_id": ids.slice(w.lo, w.hi - w.lo), "n_words": pa.array(np.diff(w.first).astype(np.int64)), "n_removed": pa.array(lost.astype(np.int64)),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()), "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
            })


def remove_repeats(documents: DataFrame, scratch: Scratch, keep_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text, if asked for) and kept_sha256 of every row."""
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = own.select("doc_id", "text", F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), F.xxhash64("doc_id", "text").alias("ref"))
    per = F.array_sort(F.collect_set("pos")).alias("at")

    anchors = scratch.table(texts.select("ref", "text").mapInArrow(_anchor_records, "h long, ref long, pos int, kind int"), "anchors")
    dealt = anchors.where(F.col("kind") != ANSWER).repartition("h").sortWithinPartitions("h").mapInArrow(_repeated_anchors, "ref long, pos int")
    marked = dealt.unionByName(anchors.where(F.col("kind") == ANSWER).select("ref", "pos")).groupBy("ref").agg(per)
    marked = scratch.table(marked, "marked")
    scratch.drop("anchors")
    # Merge joins at every size: what is marked grows with the corpus, so it is never broadcast.
    found = texts.select("ref", "doc", "text").join(marked.hint("merge"), "ref").mapInArrow(_window_records, "h long, other long, doc long, ref long, pos int, kind int")
    found = scratch.table(found, "windows")
    scratch.drop("marked")
    dealt = found.where(F.col("kind") != ANSWER).repartition("h").sortWithinPartitions("h", "other", "doc", "pos").mapInArrow(_later_windows, "doc long, ref long, pos int")
    repeats = dealt.unionByName(found.where(F.col("kind") == ANSWER).select("doc", "ref", "pos")).groupBy("doc", "ref").agg(per)
    repeats = scratch.table(repeats, "repeats")
    scratch.drop("windows")
    out = texts.join(repeats.hint("merge"), ["doc", "ref"], "left").select("doc_id", "text", "at").mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
    return out if keep_text else out.drop("kept")


def op8_substring_dedup(documents: DataFrame) -> DataFrame:
    """The rows of the contract."""
    return remove_repeats(documents, Scratch(documents.sparkSession, "substring"), keep_text=False)
