"""Benchmark decontamination by latent semantic retrieval, then longest common subsequence and answer checks.

1. Statistics: document frequencies of all documents' words, hashed into ``2**BITS`` buckets; each task sums dense
   arrays, so what is shuffled per task has a fixed size.  Weight of a word: sqrt(tf) * log((N + 1) / (df + 0.5)).
2. Latent space: benchmark items, cut into passages, are dealt into blocks of at most ``BLOCK`` passages.  A block's
   TF-IDF matrix A gets a randomised SVD, block by block in tasks of their own: subspace iteration Z <- orth(A'(A Z))
   from a random start, then a small eigenproblem; as many dimensions are kept as hold ``ENERGY`` of the variance.
3. Search: every document is cut into overlapping windows of two widths.  Projection and comparison are one product,
   words by passages, of which short runs of words are summed once and windows put together from runs; cosines of at
   least ``CANDIDATE`` give candidates.
   Items of at most ``BRIEF`` words, which other words of a window outweigh, are found by the share of their own weight
   that a window holds, ``COVERED`` or more, without the latent space: a verbatim one always has all of it.
4. Checks, on the words around the window: the longest common subsequence with the item must be ``COPIED`` of the item,
   or ``PARAPHRASED`` of it with the answer, the item's last words, found in order as well.
   Brief items found by their share are checked on spans of one and a half times their length.

What travels to the tasks is the benchmark's side only.  Its size is checked: blocks are gathered into groups of at
most ``RESIDENT_MB``, and documents are passed over once a group.

Words are lower-case runs of letters, digits and non-ASCII characters.

Cases: null and empty texts, and items without words, match nothing; repeated rows are judged each by itself; items of
fewer than ``SHORTEST`` words match only as a whole; very long texts are searched whole, in slices; an empty benchmark
or table of documents gives clean or no rows; extra columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowstream import whole_groups
from .runtime import Scratch, lean, unused
from .textwords import Words, words

BITS, RANGES = 18, 512
#: Words of an item's passages, and how far apart they begin.
WIDTH, STRIDE = 64, 32
#: Words of documents' windows and their distance: short ones for short items, which a long window would dilute.
SCALES = ((24, 8), (WIDTH, STRIDE))
#: Widths and strides are multiples of it.
STEP = 8
BLOCK, ENERGY, ROUNDS = 256, 0.99, 3
CANDIDATE = 0.22
#: FLOOR: what a word weighs besides its squared idf, so that words of all documents count too.
BRIEF, COVERED, FLOOR = 24, 0.5, 0.05
COPIED, PARAPHRASED, ANSWERED = 0.7, 0.5, 0.8
SHORTEST = 5
RESIDENT_MB = 64
#: Bytes of text searched at once: each run of words then has a number for every passage, several times over.
SLICE_BYTES = 1 << 18

_BETWEEN = np.ones(256, bool)
_BETWEEN[128:] = False
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789":
    _BETWEEN[_c] = False


class Block(NamedTuple):
    """One latent space: its words, their places in it, and the passages and items it finds."""

    terms: np.ndarray  # sorted buckets
    basis: np.ndarray  # terms x dimensions
    latent: np.ndarray  # passages x dimensions
    item: np.ndarray  # of each passage, an index of items
    ids: list[int]
    items: list[np.ndarray]  # word hashes


def _words(column: pa.Array) -> Iterator[Words]:
    return words(pc.utf8_lower(column), _BETWEEN, limit=SLICE_BYTES)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


@lean
def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(1 << BITS, np.int64), 0
    last, number = np.zeros(1 << BITS, np.int64), np.zeros(0, np.int64)
    for x in batches:
        rows += x.num_rows
        for w in _words(x.column("text")):
            bucket = _bucket(w.hashes)
            if len(bucket) > len(number):
                number = np.arange(2 * len(bucket))
            for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
                own = bucket[a:b]
                # Of places with one bucket the last one written stays: each bucket counts once per document.
                last[own] = number[: b - a]
                total[own[last[own] == number[: b - a]]] += 1
    if rows:
        cut = total.astype(np.int32).reshape(RANGES, -1)
        yield pa.record_batch({"range": pa.array(np.arange(RANGES, dtype=np.int32)), "counts": pa.array([c.tobytes() for c in cut], pa.binary())})
        yield pa.record_batch({"range": pa.array([-1], pa.int32()), "counts": pa.array([np.int64([rows]).tobytes()], pa.binary())})


@lean
def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, total = None, None
    out = lambda: pa.record_batch({"range": pa.array([now], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})
    for x in batches:
        for r, c in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True):
            part = np.frombuffer(c, np.int64 if r < 0 else np.int32).astype(np.int64)
            if r != now:
                if now is not None:
                    yield out()
                now, total = r, np.zeros(len(part), np.int64)
            total = total + part
    if now is not None:
        yield out()


def inverse_frequencies(documents: DataFrame, scratch: Scratch) -> np.ndarray:
    """The weight of each bucket, over all documents; 2**BITS numbers whatever the corpus."""
    parts = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(_frequencies, "range int, counts binary")
    sums = scratch.table(parts.repartition("range").sortWithinPartitions("range").mapInArrow(_sum, "range int, counts binary"), "frequencies")
    df, n = np.zeros(1 << BITS), 0
    width = (1 << BITS) // RANGES
    for r in sums.collect():
        if r.range < 0:
            n = int(np.frombuffer(r.counts, np.int64)[0])
        else:
            df[r.range * width : (r.range + 1) * width] = np.frombuffer(r.counts, np.int64)
    return np.maximum(np.log((n + 1) / (df + 0.5)), 0).astype(np.float32)


def weighted(window: np.ndarray, bucket: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """window number, bucket and sqrt(tf) * idf of each distinct word of each window."""
    both, n = np.unique((window << BITS) | bucket, return_counts=True)
    bucket = both & ((1 << BITS) - 1)
    return both >> BITS, bucket, np.sqrt(n) * idf[bucket]


def _passages(items: DataFrame) -> DataFrame:
    """item_id, item (all words) and words (of a passage) as binary arrays of hashes."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for w in _words(x.column("text")):
                ids, whole, part = [], [], []
                for k, i in enumerate(x.column("item_id").slice(w.lo, w.hi - w.lo).to_pylist()):
                    h = w.hashes[w.first[k] : w.first[k + 1]]
                    for at in range(0, max(1, len(h) - STRIDE), STRIDE) if len(h) else ():
                        ids.append(i)
                        whole.append(h.tobytes())
                        part.append(h[at : at + WIDTH].tobytes())
                yield pa.record_batch({"item_id": pa.array(ids, pa.int64()), "item": pa.array(whole, pa.binary()), "words": pa.array(part, pa.binary())})

    source = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null")
    return source.mapInArrow(run, "item_id long, item binary, words binary")


def _rows(parts: list[bytes], idf: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """TF-IDF rows of passages over the terms."""
    out = np.zeros((len(parts), len(terms)), np.float32)
    h = [np.frombuffer(p, np.uint64) for p in parts]
    window, bucket, value = weighted(np.repeat(np.arange(len(h)), [len(v) for v in h]), _bucket(np.concatenate(h)), idf)
    out[window, np.searchsorted(terms, bucket)] = value
    # Rows of length 1: a passage of common words weighs as much in the decomposition as one of rare words.
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def randomised_svd(a: np.ndarray, seed: int = 11) -> np.ndarray:
    """terms x dimensions: right singular vectors of a (passages x terms) that hold ENERGY of it."""
    a = a.astype(float)
    z = np.linalg.qr(np.random.default_rng(seed).normal(size=(a.shape[1], min(a.shape))))[0]
    for _ in range(ROUNDS):
        z = np.linalg.qr(a.T @ (a @ z))[0]
    y = a @ z
    value, vector = np.linalg.eigh(y.T @ y)
    order = np.argsort(value)[::-1]
    value = np.maximum(value[order], 0)
    rank = int(np.searchsorted(np.cumsum(value), ENERGY * value.sum())) + 1
    return (z @ vector[:, order[:rank]]).astype(np.float32)


def _spaces(idf: np.ndarray):
    """block, size and the pickled latent space of each block of passages, which come sorted by block."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cut in whole_groups(batches, ["block"]):
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                part = t.slice(lo, hi - lo)
                whole, parts = dict(zip(part.column("item_id").to_pylist(), part.column("item").to_pylist(), strict=True)), part.column("words").to_pylist()
                ids = sorted(whole)
                index = {i: j for j, i in enumerate(ids)}
                terms = np.unique(_bucket(np.concatenate([np.frombuffer(w, np.uint64) for w in parts])))
                a = _rows(parts, idf, terms)
                basis = randomised_svd(a)
                block = Block(terms, basis, a @ basis, np.array([index[i] for i in part.column("item_id").to_pylist()]), ids, [np.frombuffer(whole[i], np.uint64) for i in ids])
                size = block.basis.nbytes + block.latent.nbytes + sum(h.nbytes for h in block.items)
                yield pa.record_batch({"block": pa.array([t.column("block")[int(lo)].as_py()], pa.int32()), "size": pa.array([size], pa.int64()), "space": pa.array([pickle.dumps(tuple(block))], pa.binary())})

    return run


def build(items: DataFrame, idf: np.ndarray, scratch: Scratch) -> Iterator[list[Block]]:
    """The latent spaces of a benchmark, all made in one job, in groups of at most RESIDENT_MB (or one block)."""
    cut = scratch.table(_passages(items), "passages")
    n = cut.count()
    blocks = max(1, -(-n // BLOCK))
    dealt = cut.withColumn("block", F.expr(f"cast(pmod(xxhash64(item_id), {blocks}) as int)")).repartition(F.col("block")).sortWithinPartitions("block", "item_id", "words")
    spaces = scratch.table(dealt.mapInArrow(_spaces(idf), "block int, size long, space binary"), "spaces")
    groups, size = [[]], 0
    for r in spaces.select("block", "size").orderBy("block").collect():  # one row a block
        if groups[-1] and size + r.size > RESIDENT_MB << 20:
            groups.append([])
            size = 0
        groups[-1].append(r.block)
        size += r.size
    for group in groups:
        if group:
            rows = spaces.where(F.col("block").between(group[0], group[-1])).orderBy("block").collect()  # RESIDENT_MB at most
            yield [Block(*pickle.loads(r.space)) for r in rows]


def common_subsequence(masks: dict[int, int], n: int, text: list[int]) -> int:
    """Length of the longest common subsequence with n words whose places masks has as bits."""
    full = (1 << n) - 1
    s = full
    for h in text:
        m = masks.get(h)
        if m:
            u = s & m
            s = ((s + u) | (s - u)) & full
    return n - s.bit_count()


def _masks(h: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, v in enumerate(h):
        out[v] = out.get(v, 0) | 1 << k
    return out


class _Item:
    def __init__(self, h: np.ndarray):
        self.words = h.tolist()
        self.masks, self.n = _masks(self.words), len(self.words)
        answer = self.words[-max(3, self.n // 4) :]
        self.answer, self.answer_n = _masks(answer), len(answer)

    def check(self, text: list[int]) -> float:
        """The share of the item that the text has in order if it passes, else 0."""
        share = common_subsequence(self.masks, self.n, text) / self.n
        if self.n < SHORTEST:
            return share if share == 1 else 0.0
        if share >= COPIED or share >= PARAPHRASED and common_subsequence(self.answer, self.answer_n, text) / self.answer_n >= ANSWERED:
            return share
        return 0.0


    def check_close(self, text: list[int]) -> float:
        """The best check of the spans of one and a half times the item's length; more of a text may hold its words by chance."""
        best = self.check(text)
        if not best:
            return 0.0
        size = self.n + self.n // 2
        return max((self.check(text[k : k + size]) for k, h in enumerate(text) if h in self.masks), default=0.0)


def _cover(b: Block, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The brief items, and the share of each one's weight that an occurrence of each word adds; the last row is zero."""
    brief = np.array([j for j, h in enumerate(b.items) if len(h) <= BRIEF], np.int64)
    share = np.zeros((len(b.terms) + 1, len(brief)), np.float32)
    for k, j in enumerate(brief):
        bucket = _bucket(b.items[j])
        weight = idf[bucket].astype(float) ** 2 + FLOOR
        share[np.searchsorted(b.terms, bucket), k] = weight / weight.sum()
    return brief, share


def search(w: Words, blocks: list[Block], idf: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], items: list[list[_Item]]) -> dict[int, dict[int, tuple[float, float]]]:
    """Row: item_id: cosine and share of each item found in the rows of w.

    tables: of each block, the row of each bucket in the matrix of words by passages, whose last row is zero, for the
    words that the block lacks; and the brief items and their matrix.  Runs of STEP words are summed once, and windows are sums of runs.
    """
    found: dict[int, dict[int, tuple[float, float]]] = {}
    n = np.diff(w.first)
    runs = -(-n // STEP)
    row = np.repeat(np.arange(len(n)), runs)
    place = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs)
    if not len(row):
        return found
    at = (w.first[row] + place * STEP)[:, None] + np.arange(STEP)
    inside = at < w.first[row + 1][:, None]
    bucket = np.where(inside, _bucket(w.hashes)[np.minimum(at, len(w.hashes) - 1)], 0)
    square = np.where(inside, idf[bucket].astype(float) ** 2, 0).sum(1)
    for block, (number, matrix, brief, cover), own in zip(blocks, tables, items, strict=True):
        places = np.where(inside, number[bucket], len(matrix) - 1)
        sums = matrix[places[:, 0]]
        for k in range(1, STEP):
            sums += matrix[places[:, k]]
        for width, stride in SCALES:
            start = np.flatnonzero(place * STEP % stride == 0)
            dot, norm2 = sums[start], square[start]
            for k in range(1, width // STEP):
                on = np.minimum(start + k, len(row) - 1)
                same = (start + k < len(row)) & (row[on] == row[start])
                dot += sums[on] * same[:, None].astype(np.float32)
                norm2 = norm2 + square[on] * same
            # Occurrences are summed here, so words that recur count too much; the exact cosine is worked out for what is left.
            limit = (CANDIDATE * np.sqrt(np.maximum(norm2, 1e-9))).astype(np.float32)
            at_window, at_passage = np.nonzero(dot >= limit[:, None])
            if not len(at_window):
                continue
            cut = np.flatnonzero(np.r_[True, at_window[1:] != at_window[:-1]]).tolist()
            for lo, hi in zip(cut, [*cut[1:], len(at_window)], strict=True):
                k, passages = at_window[lo], at_passage[lo:hi]
                r = int(row[start[k]])
                begin = int(w.first[r] + place[start[k]] * STEP)
                end = min(begin + width, int(w.first[r + 1]))
                cosines = _cosines(_bucket(w.hashes[begin:end]), idf, block, passages)
                for p, cosine in zip(passages[cosines >= CANDIDATE].tolist(), cosines[cosines >= CANDIDATE].tolist(), strict=True):
                    i = int(block.item[p])
                    have, reach = found.setdefault(r, {}), own[i].n
                    old = have.get(block.ids[i], (0.0, 0.0))
                    share = old[1]
                    if share < 1:
                        text = w.hashes[max(int(w.first[r]), begin - reach) : min(int(w.first[r + 1]), end + reach)].tolist()
                        share = max(share, own[i].check(text))
                    if share > 0:
                        have[block.ids[i]] = (max(old[0], cosine), share)
        if len(brief):
            _search_brief(found, w, block, idf, cover, brief, own, places, row, place)
    return found


def _search_brief(found: dict, w: Words, block: Block, idf: np.ndarray, cover: np.ndarray, brief: np.ndarray, own: list[_Item], places: np.ndarray, row: np.ndarray, place: np.ndarray) -> None:
    """Adds the brief items of which a window of BRIEF words, from each run on, holds COVERED of their weight."""
    runs = cover[places[:, 0]]
    for k in range(1, STEP):
        runs += cover[places[:, k]]
    held = runs.copy()
    for k in range(1, BRIEF // STEP):
        held[:-k] += runs[k:] * (row[k:] == row[:-k])[:, None]
    for at, j in zip(*(a.tolist() for a in np.nonzero(held >= COVERED)), strict=True):
        r, i = int(row[at]), int(brief[j])
        have = found.setdefault(r, {})
        old = have.get(block.ids[i], (0.0, 0.0))
        if old[1] == 1:
            continue
        begin = int(w.first[r] + place[at] * STEP)
        end, n = min(begin + BRIEF, int(w.first[r + 1])), own[i].n
        share = own[i].check_close(w.hashes[max(int(w.first[r]), begin - n) : min(int(w.first[r + 1]), end + n)].tolist())
        if share > 0:
            cosine = float(_cosines(_bucket(w.hashes[begin:end]), idf, block, np.flatnonzero(block.item == i)).max())
            have[block.ids[i]] = (max(old[0], cosine), max(old[1], share))


def _cosines(bucket: np.ndarray, idf: np.ndarray, block: Block, passages: np.ndarray) -> np.ndarray:
    """Cosines of a window with passages in the latent space, by the window's full norm."""
    term, n = np.unique(bucket, return_counts=True)
    value = np.sqrt(n) * idf[term]
    norm = float(np.sqrt(value @ value))
    at = np.minimum(np.searchsorted(block.terms, term), len(block.terms) - 1)
    known = block.terms[at] == term
    return (value[known] @ block.basis[at[known]]) @ block.latent[passages].T / norm if norm else np.zeros(len(passages))


def _judge(blocks: list[Block], idf: np.ndarray, names: list[str]):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = []
        for b in blocks:
            number = np.full(1 << BITS, len(b.terms), np.int64)
            number[b.terms] = np.arange(len(b.terms))
            by_passage = (b.basis @ b.latent.T) * idf[b.terms][:, None]
            tables.append((number, np.r_[by_passage, np.zeros((1, by_passage.shape[1]))].astype(np.float32), *_cover(b, idf)))
        items = [[_Item(h) for h in b.items] for b in blocks]
        for x in batches:
            for w in _words(x.column(0)):
                found = search(w, blocks, idf, tables, items)
                hits = [sorted(found.get(k, {}).items()) for k in range(w.hi - w.lo)]
                lists = pa.array([[i for i, _ in h] for h in hits], pa.list_(pa.int64()))
                best = lambda k: pa.array([max((v[k] for _, v in h), default=0.0) for h in hits], pa.float64())  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([*(c.slice(w.lo, w.hi - w.lo) for c in x.columns[1:]), lists, best(0), best(1)], [*names, "items", "cosine", "share"])

    return run


def find_leaks(documents: DataFrame, benchmark: DataFrame, scratch: Scratch) -> DataFrame:
    """documents with items (sorted ids of the items a text holds), and the best cosine and share of words in order."""
    base = documents.drop("items", "cosine", "share")
    idf = inverse_frequencies(documents, scratch)
    out = base
    for k, group in enumerate([*build(benchmark, idf, scratch)] or [[]]):
        kept = ["items", "cosine", "share"] if k else []
        named = [c if c not in kept else f"__{c}" for c in out.columns]
        source = out.toDF(*named)
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
        source = source.select(F.col("text").cast("string").alias(unused(source, "__text")), *[F.col(f"`{c}`") for c in named])
        out = source.mapInArrow(_judge(group, idf, named), f"{kinds}, items array<bigint>, cosine double, share double")
        if k:
            out = out.withColumn("items", F.array_sort(F.array_union("items", "__items"))).withColumn("cosine", F.greatest("cosine", "__cosine")).withColumn("share", F.greatest("share", "__share")).drop("__items", "__cosine", "__share")
    return out


def op7_decontamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, items, cosine and share of every document."""
    out = find_leaks(documents.select("doc_id", "text"), benchmark, Scratch(documents.sparkSession, "leaks"))
    return out.select("doc_id", (F.size("items") > 0).alias("contaminated"), "items", "cosine", "share")
