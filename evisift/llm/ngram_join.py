"""N-gram Jaccard join: a MinHash LSH forest, then exact verification of word 5-gram sets at 0.8.

1. Classes: documents with equal word sequences are one class, by a 128-bit hash of two independent word hashes; its
   row of smallest doc_id stands for it.  From here on only representatives travel, so thousands of copies weigh as one.
2. Forest: ``TREES`` sorted prefix tries of ``DEEPEST`` MinHash labels each.  A node of depth d holds the texts that
   agree on a tree's first d labels, and a pair of similarity s shares it with chance s**d.
3. Adaptive prefixes: each text begins at the deepest prefix of every tree and shortens it, tree by tree, as far as
   ``SHALLOWEST`` while the shorter node is not crowded (``CROWDED`` texts or fewer).  If the trees together then still
   miss a pair at the threshold with a chance over 1 - ``TARGET``, crowded trees are shortened too, in the order of
   their hashes, until they do not.  So a text in sparse surroundings is looked up at short prefixes, and one among
   boilerplate at long ones of more trees.
4. Candidates: within a node that is not crowded, 256-bit sketches of the signatures rule out pairs far below the
   threshold, and the rest become edges, at most one per text and node; a crowded node gives a star to its smallest
   text, so no group is gathered.  Components of these edges are the blocks to verify in.
5. Verification: shingle sets of each block meet in cells of at most two parts of about ``PART`` texts; exact
   intersections are one product of 0/1 matrices.  A cell returns a number of links and one edge per text, never pairs.
   A block of m different texts sends each of them ceil(m / PART) times.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  A text of one to four words has one shingle: all its words.

Cases: null and empty texts have no shingle, link with nothing and are classes of their own; repeated rows are copies;
rows are told apart by doc_id and text, so a doc_id that comes with several texts has each text's own class and links;
documents without a doc_id link and count like others, but name a class only as null; very long texts are hashed in
slices; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowstream import whole_groups
from .components import components, roots
from .runtime import Scratch, lean
from .textwords import inside, mix, ngrams, words

SHINGLE, THRESHOLD, TARGET = 5, 0.8, 0.9999
TREES, DEEPEST, SHALLOWEST = 32, 8, 5
CROWDED = 128
#: Texts of a part, and shingles of them.
PART, PART_SHINGLES = 512, 1_000_000
#: Of 256 one-bit labels, a pair at 0.8 agrees on 230 with a deviation of 4.8.
AGREE = 200


def gain(depth: int, threshold: float = THRESHOLD) -> float:
    """What a lookup at this depth adds to the logarithm of one over the chance to miss a pair at the threshold."""
    return -math.log(1 - threshold**depth)


def needed(target: float = TARGET) -> float:
    return -math.log(1 - target)


def shingles(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """lo, hi, shingle hashes of rows lo..hi, where each row's begin (and the end), and two hashes of each row's words."""
    for w in words(column, lanes=2):
        n = np.diff(w.first)
        row = w.row_of()
        ok = inside(w, SHINGLE)
        at = np.flatnonzero(ok)
        sh, sh_row = (ngrams(w.hashes, SHINGLE)[at], row[at]) if len(at) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        short = np.flatnonzero((n > 0) & (n < SHINGLE))
        if len(short):
            own = np.array([_sequence(w.hashes[w.first[k] : w.first[k + 1]]) for k in short], np.uint64)
            sh, sh_row = np.r_[sh, own], np.r_[sh_row, short]
            order = np.argsort(sh_row, kind="stable")
            sh, sh_row = sh[order], sh_row[order]
        whole = np.zeros((w.hi - w.lo, 2), np.uint64)
        some = n > 0
        if some.any():
            with np.errstate(over="ignore"):
                place = mix((np.arange(len(row)) - w.first[row]).astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
                for k, own in enumerate((w.hashes, w.second)):
                    whole[some, k] = np.add.reduceat(mix(own ^ place), w.first[:-1][some])
        yield w.lo, w.hi, sh, np.searchsorted(sh_row, np.arange(w.hi - w.lo + 1)), whole


def _sequence(h: np.ndarray) -> int:
    x = len(h)
    for k in h.tolist():
        x = (x * 0xD1342543DE82EF95 + k) & (1 << 64) - 1
    return x


def _labels(m: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(0, 1 << 32, m, dtype=np.uint32), rng.integers(0, 1 << 31, m, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _signatures(m: int):
    """key, doc_id, words (hash of the word sequence), n_shingles, a signature of m 16-bit labels and a sketch of one bit
    of each of them, of each text with words."""
    flip, factor = _labels(m)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for lo, hi, sh, cut, whole in shingles(x.column("text")):
                some = np.flatnonzero(np.diff(cut) > 0)
                if not len(some):
                    continue
                low = (sh ^ (sh >> np.uint64(32))).astype(np.uint32)
                sig = np.empty((len(some), m), np.uint16)
                for k in range(m):
                    least = np.minimum.reduceat((low ^ flip[k]) * factor[k], cut[:-1][some])
                    sig[:, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
                take = pa.array(some)
                yield pa.record_batch({
                    "key": x.column("key").slice(lo, hi - lo).take(take), "doc_id": x.column("doc_id").slice(lo, hi - lo).take(take), "words": pa.array([w.tobytes() for w in whole[some]], pa.binary()),
                    "n_shingles": pa.array(np.diff(cut)[some].astype(np.int64)), "signature": pa.array([s.tobytes() for s in sig], pa.binary()),
                    "sketch": pa.array([s.tobytes() for s in np.packbits((sig & 1).astype(np.uint8), axis=1)], pa.binary()),
                })

    return run


@lean
def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """branch (hash of the tree and its first SHALLOWEST labels), rest (the other labels) and node of each text and tree."""
    for x in batches:
        if not x.num_rows:
            continue
        sig = np.frombuffer(b"".join(x.column("signature").to_pylist()), np.uint16).reshape(x.num_rows, -1).astype(np.uint64)
        for t in range(TREES):
            own = sig[:, t * DEEPEST : (t + 1) * DEEPEST]
            with np.errstate(over="ignore"):
                branch = mix(np.full(x.num_rows, t + 1, np.uint64))
                for k in range(SHALLOWEST):
                    branch = mix(branch * np.uint64(0x9FB21C651E98DF25) + own[:, k])
            rest = np.zeros(x.num_rows, np.uint64)
            for k in range(SHALLOWEST, DEEPEST):
                rest = rest << np.uint64(16) | own[:, k]
            yield pa.record_batch({"branch": pa.array(branch.view(np.int64)), "rest": pa.array(rest.view(np.int64)), "node": x.column("node")})


def _at(depth: str) -> str:
    """SQL for the key of a branch's node at a depth."""
    return f"xxhash64(branch, {depth}, shiftright(rest, 16 * ({DEEPEST} - {depth})))"


def chosen_depths(threshold: float = THRESHOLD, target: float = TARGET) -> str:
    """SQL over ``trees``, structs branch, n (texts at each depth from SHALLOWEST + 1 on) of a text's crowded trees, for
    the same with the depth that each is looked up at."""
    depths = range(SHALLOWEST + 1, DEEPEST + 1)
    first = "case " + " ".join(f"when get(t.n, {k}) <= {CROWDED} then {d}" for k, d in enumerate(depths)) + f" else {DEEPEST} end"
    worth = f"get(array({', '.join(f'{gain(d, threshold)!r}D' for d in range(SHALLOWEST, DEEPEST + 1))}), {{}} - {SHALLOWEST})"
    planned = f"transform(array_sort(trees, (a, b) -> case when a.branch < b.branch then -1 when a.branch > b.branch then 1 else 0 end), t -> named_struct('branch', t.branch, 'depth', {first}))"
    have = f"{gain(SHALLOWEST, threshold)!r}D * ({TREES} - size(trees)) + aggregate(p, 0D, (z, t) -> z + {worth.format('t.depth')})"
    # Each further tree that is shortened all the way adds the same or more, so those needed are a prefix of the order.
    step = f"named_struct('have', if(z.have < {needed(target)!r}D, z.have + {gain(SHALLOWEST, threshold)!r}D - {worth.format('t.depth')}, z.have), 'out', concat(z.out, array(named_struct('branch', t.branch, 'depth', if(z.have < {needed(target)!r}D, {SHALLOWEST}, t.depth)))))"
    return f"element_at(transform(array({planned}), p -> aggregate(p, named_struct('have', {have}, 'out', cast(array() as array<struct<branch:bigint,depth:int>>)), (z, t) -> {step}, z -> z.out)), 1)"


@lean
def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One edge per text to the smallest text of its part of the node."""
    for t, cut in whole_groups(batches, ["at"]):
        rep = t.column("node").to_numpy()
        sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint64).reshape(t.num_rows, -1)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        end = np.repeat(cut[1:], np.diff(cut))
        at = np.arange(len(end))
        for k in range(1, int(np.diff(cut).max(initial=1))):
            i = at[at + k < end]
            near = 256 - np.bitwise_count(sketch[i] ^ sketch[i + k]).sum(1, dtype=np.int64) >= AGREE
            left.append(i[near])
            right.append(i[near] + k)
        i, j = np.concatenate(left), np.concatenate(right)
        nodes, back = np.unique(np.r_[rep[i], rep[j]], return_inverse=True)
        root = nodes[roots(len(nodes), back[: len(i)], back[len(i) :])]
        off = root != nodes
        yield pa.record_batch({"u": nodes[off], "v": root[off]})


@lean
def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's shingle set, once for every cell it belongs to; of rows that repeat a text, a task sends the first."""
    seen: set[int] = set()
    for x in batches:
        parts, part, nodes = x.column("parts").to_numpy(), x.column("part").to_numpy(), x.column("node").to_pylist()
        for lo, hi, sh, cut, _ in shingles(x.column("text")):
            fresh = np.zeros(hi - lo, bool)
            for k in range(lo, hi):
                if nodes[k] not in seen:
                    seen.add(nodes[k])
                    fresh[k - lo] = True
            sets = [np.unique(sh[a:b]) if f else None for a, b, f in zip(cut[:-1], cut[1:], fresh, strict=True)]
            n = np.where(fresh, parts[lo:hi], 0)
            row = np.repeat(np.arange(hi - lo), n)
            other = np.concatenate([np.arange(k) for k in n]) if len(n) else np.zeros(0, np.int64)
            own = part[lo:hi][row]
            take = pa.array(lo + row)
            for s in range(0, len(row), 2048):
                e = slice(s, s + 2048)
                yield pa.record_batch({
                    "component": x.column("component").take(take[s : s + 2048]), "x": pa.array(np.minimum(own[e], other[e]).astype(np.int32)), "y": pa.array(np.maximum(own[e], other[e]).astype(np.int32)),
                    "part": pa.array(own[e].astype(np.int32)), "rep": x.column("node").take(take[s : s + 2048]), "copies": x.column("copies").take(take[s : s + 2048]),
                    "shingles": pa.array([sets[r].tobytes() for r in row[e]], pa.binary()),
                })


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of all intersections of a cell's sets, by products of 0/1 matrices over shared elements."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, back, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[back]
    owner, number = owner[number >= 0], number[number >= 0]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(number[-1]) + 1 if len(number) else 0, 8192):
        a, b = np.searchsorted(number, [lo, lo + 8192])
        m = np.zeros((len(sets), 8192), np.float32)
        m[owner[a:b], number[a:b] - lo] = 1
        out += m @ m.T
    return out


def _verify(threshold: float):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cut in whole_groups(batches, ["component", "x", "y"]):
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                c = t.slice(a, b - a)
                rep, at = np.unique(c.column("rep").to_numpy(), return_index=True)
                if len(rep) < 2:
                    continue
                part, copies = c.column("part").to_numpy()[at], c.column("copies").to_numpy()[at]
                across = c.column("x")[0].as_py() != c.column("y")[0].as_py()
                sets = [np.frombuffer(c.column("shingles")[int(k)].as_py(), np.uint64) for k in at]
                n = np.array([len(s) for s in sets], float)
                common = intersections(sets).astype(float)
                near = common >= threshold * (n[:, None] + n - common) - 1e-9
                np.fill_diagonal(near, False)
                if across:
                    near &= part[:, None] != part
                i, j = np.nonzero(np.triu(near))
                if len(i):
                    linked = np.flatnonzero(near.any(1))
                    root = rep[roots(len(rep), i, j)]
                    yield pa.record_batch({"rep": rep[linked], "n": (near @ copies)[linked].astype(np.int64), "root": root[linked]})

    return run


def _candidates(classes: DataFrame, scratch: Scratch, threshold: float, target: float) -> DataFrame:
    """u, v: edges between nodes that connect every pair the forest finds."""
    tries = scratch.table(classes.select("node", "signature").mapInArrow(_tries, "branch long, rest long, node long"), "tries")
    shared = tries.groupBy("branch").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("head")).where("size > 1")
    met = scratch.table(tries.join(shared.hint("merge"), "branch"), "met")
    scratch.drop("tries")
    crowded = met.where(F.col("size") > CROWDED)
    depths = ", ".join(map(str, range(SHALLOWEST + 1, DEEPEST + 1)))
    deeper = crowded.select("node", "branch", "rest", F.expr(f"explode(array({depths}))").alias("depth")).withColumn("at", F.expr(_at("depth")))
    counts = scratch.table(deeper.groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("first")), "counts")
    sizes = deeper.join(counts.hint("merge"), "at").groupBy("node", "branch").agg(F.transform(F.array_sort(F.collect_list(F.struct("depth", "n"))), lambda t: t["n"]).alias("n"))
    plan = sizes.groupBy("node").agg(F.collect_list(F.struct("branch", "n")).alias("trees")).select("node", F.expr(f"inline({chosen_depths(threshold, target)})"))
    plan = scratch.table(plan, "plan")
    # Looked up deeper: nodes of the crowded branches; all their members take part, whatever prefix they chose themselves.
    asked = crowded.join(plan.hint("merge"), ["node", "branch"]).withColumn("at", F.expr(_at("depth")))
    used = asked.where(F.col("depth") > SHALLOWEST).select("at").distinct().join(counts.where("n > 1").hint("merge"), "at")
    within = scratch.table(deeper.select("node", "at").join(used.hint("merge"), "at"), "within")
    wide = crowded.join(asked.where(F.col("depth") == SHALLOWEST).select("branch").distinct().hint("merge"), "branch", "left_semi")
    stars = wide.select(F.col("node").alias("u"), F.col("head").alias("v")).unionByName(within.where(F.col("n") > CROWDED).select(F.col("node").alias("u"), F.col("first").alias("v")))
    small = met.where(F.col("size") <= CROWDED).select("node", F.col("branch").alias("at")).unionByName(within.where(F.col("n") <= CROWDED).select("node", "at"))
    small = small.join(classes.select("node", "sketch").hint("merge"), "node")
    return small.repartition("at").sortWithinPartitions("at").mapInArrow(_sketched, "u long, v long").unionByName(stars)


def _judged(documents: DataFrame, scratch: Scratch, threshold: float, target: float) -> DataFrame:
    """key, repeats (rows of that key), class_id, first (key of the row that stands for the class), n_links of each
    distinct doc_id and text with words."""
    own = _keyed(documents)
    signed = own.where("text is not null").mapInArrow(_signatures(TREES * DEEPEST), "key long, doc_id long, words binary, n_shingles long, signature binary, sketch binary")
    signed = scratch.table(signed, "signed")
    smallest = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "key", "signature", "sketch")).alias("rep")
    classes = scratch.table(signed.groupBy("words").agg(smallest, F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("n_shingles")), "by-words")
    # A class goes by its doc_id, but where several classes share one or have none, by a hash of the words.
    several = classes.select("rep.doc_id").where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", F.lit(True).alias("several"))
    classes = classes.select("words", "rep.*", "copies", "n_shingles").join(several.hint("merge"), "doc_id", "left")
    classes = classes.select("words", "doc_id", "key", "copies", "n_shingles", "signature", "sketch", F.expr("if(doc_id is null or several, xxhash64(words), doc_id)").alias("node"))
    classes = scratch.table(classes, "classes")
    scratch.drop("by-words")
    blocks = scratch.table(components(_candidates(classes, scratch, threshold, target), scratch, "blocks"), "blocks").withColumnRenamed("id", "node")
    scratch.drop("met")
    member = scratch.table(blocks.join(classes.select("node", "key", "copies", "n_shingles").hint("merge"), "node"), "members")
    # Parts by number and weight of texts: a part of very long texts holds fewer of them.
    weight = scratch.table(member.groupBy("component").agg(F.count(F.lit(1)).alias("m"), F.sum("n_shingles").alias("w")), "weights")
    parts = F.ceil(F.greatest(F.col("m") / PART, F.col("w") / PART_SHINGLES)).cast("int")
    member = member.select("node", "key", "component", "copies").join(weight.select("component", parts.alias("parts")).hint("merge"), "component")
    member = scratch.table(member.withColumn("part", F.expr("cast(pmod(xxhash64(node), parts) as int)")), "placed")
    # A merge join at every size: what there is to verify grows with the corpus, so it is never broadcast.
    texts = own.select("key", "text").join(member.hint("merge"), "key")
    keys = ["component", "x", "y"]
    sets = texts.mapInArrow(_cells, "component long, x int, y int, part int, rep long, copies long, shingles binary")
    found = scratch.table(sets.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_verify(threshold), "rep long, n long, root long"), "found")
    groups = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")), scratch, "classes-cc")
    links = found.groupBy("rep").agg(F.sum("n").alias("n")).withColumnRenamed("rep", "node").join(groups.withColumnRenamed("id", "node"), "node", "left")
    per_class = classes.select("words", "node", "doc_id", "key", "copies").join(links.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    per_class = scratch.table(per_class, "per-class")
    heads = per_class.groupBy("component").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "key")).alias("head"))
    per_class = per_class.select("words", "component", F.expr("coalesce(n, 0L) + copies - 1").alias("n_links")).join(scratch.table(heads, "heads").hint("merge"), "component")
    per_key = signed.groupBy("words", "key").agg(F.count(F.lit(1)).alias("repeats"))
    return scratch.table(per_key.join(per_class.hint("merge"), "words").select("key", "repeats", "n_links", F.col("head.doc_id").alias("class_id"), F.col("head.key").alias("first")), "judged")


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("key"))


def similar_documents(documents: DataFrame, scratch: Scratch, threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """doc_id, class_id, n_links of every row: links are other documents at the threshold or over, copies included."""
    out = _keyed(documents).select("doc_id", "key").join(_judged(documents, scratch, threshold, target).hint("merge"), "key", "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def keep_first(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of documents that stand for their class, one of each: that of the smallest doc_id; texts without words stay."""
    judged = _judged(documents, scratch, THRESHOLD, TARGET).select(F.col("key").alias("__key"), F.col("repeats").alias("__repeats"), F.col("first").alias("__first"))
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    kept = documents.withColumn("__key", key).join(judged.hint("merge"), "__key", "left").where("__first is null or __first = __key")
    single = kept.where("__repeats is null or __repeats = 1").select(*documents.columns)
    # Rows that repeat a doc_id and text differ in other columns at most: the first of each is taken.
    several = kept.where("__repeats > 1").groupBy("__key").agg(*[F.first(c).alias(c) for c in documents.columns]).select(*documents.columns)
    return single.unionByName(several)


def op2_ngram_jaccard_join(documents: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id that links reach) and n_links of every document."""
    return similar_documents(documents, Scratch(documents.sparkSession, "ngrams"))
