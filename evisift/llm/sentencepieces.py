"""SentencePiece encoding and decoding with offsets into the original text.

Normalisation is done here, by the model's own specification: at each position the longest prefix that the compiled
character map (a double-array trie) knows is replaced, other characters stand for themselves, spaces become the meta
symbol, and for every byte of the normalised text the byte of the source it came from is recorded.  The normalised text
is then segmented by the sentencepiece library under the same model with a normaliser that changes nothing, so ids come
from the text normalised here, and each piece's bytes are projected to a span of source bytes.  Tests hold the ids
against the library's own encoding of the raw text.

The model is read once on the driver and its bytes travel with the tasks.  Texts are encoded whole, in slices of rows.

Cases: null text is empty; an empty text has no ids; repeated rows give equal results; an empty table gives no rows;
very long texts are one encode call each; added columns replace columns of the same name; if the library's pieces ever
failed to spell the normalised text, that text's spans would be null, its ids as they are.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import lean, unused

META = "▁".encode()
#: A second normaliser (field 3) overrides the first: no map, no dummy prefix, no blanks removed or escaped.
UNCHANGED = bytes([0x1A, 8, 0x12, 0, 0x18, 0, 0x20, 0, 0x28, 0])


class Spec(NamedTuple):
    """The normaliser's part of a model."""

    trie: np.ndarray
    strings: bytes
    dummy_prefix: bool
    remove_extra: bool
    escape: bool


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value, shift, i, more = value | (b[i] & 127) << shift, shift + 7, i + 1, b[i] & 128
        if not more:
            return value, i


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    i = 0
    while i < len(b):
        tag, i = _varint(b, i)
        if tag & 7 == 0:
            value, i = _varint(b, i)
        elif tag & 7 == 2:
            n, i = _varint(b, i)
            value, i = b[i : i + n], i + n
        else:
            n = 4 if tag & 7 == 5 else 8
            value, i = b[i : i + n], i + n
        yield tag >> 3, value


def char_map(blob: bytes) -> tuple[np.ndarray, bytes]:
    """Units of the trie and the replacement strings of a compiled character map."""
    if not blob:
        return np.zeros(0, np.uint32), b""
    (n,) = struct.unpack_from("<I", blob)
    return np.frombuffer(blob, "<u4", n // 4, 4), blob[4 + n :]


def read_spec(model: bytes) -> Spec:
    # Field 3 of a model is its normaliser: 2 the map, 3 dummy prefix, 4 extra spaces, 5 escaping.
    # Of a field that comes again the later value holds.
    found = dict(f for k, v in _fields(model) if k == 3 for f in _fields(v))
    trie, strings = char_map(found.get(2, b""))
    return Spec(trie, strings, bool(found.get(3, 1)), bool(found.get(4, 1)), bool(found.get(5, 1)))


def longest_prefix(spec: Spec, text: bytes, at: int) -> tuple[bytes, int]:
    """What the text's prefix from at on becomes, and how many of its bytes that replaces."""
    best, n = -1, 0
    if len(spec.trie):
        # In a unit, bit 8 says that a leaf follows, bits 10 up and bit 9 give the offset of the children.
        units, node = spec.trie, 0
        node ^= (int(units[0]) >> 10) << ((int(units[0]) & 512) >> 6)
        for k in range(at, len(text)):
            node ^= text[k]
            if node >= len(units) or int(units[node]) & 0x800000FF != text[k]:
                break
            unit = int(units[node])
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                best, n = int(units[node]) & 0x7FFFFFFF, k - at + 1
    if best >= 0:
        return spec.strings[best : spec.strings.index(b"\0", best)], n
    n = 1
    while at + n < len(text) and text[at + n] & 0xC0 == 0x80:
        n += 1
    return text[at : at + n], n


def normalise(spec: Spec, text: bytes) -> tuple[bytes, np.ndarray]:
    """Normalised bytes, and for each, and for their end, the byte of text it came from."""
    if not text:
        return b"", np.zeros(1, np.int64)
    if not len(spec.trie) and not spec.remove_extra:
        b = np.frombuffer(text, np.uint8)
        width = np.where(b == 32, len(META) if spec.escape else 1, 1)
        ends = np.cumsum(width)
        out, origin = np.repeat(b, width), np.repeat(np.arange(len(b)), width)
        if spec.escape:
            where = (ends - width)[b == 32]
            for k, x in enumerate(META):
                out[where + k] = x
        head = (META if spec.escape else b" ") if spec.dummy_prefix else b""
        return head + out.tobytes(), np.r_[np.zeros(len(head), np.int64), origin, len(b)]
    space = META if spec.escape else b" "
    out, origin, i = bytearray(), [], 0
    if spec.remove_extra:
        while i < len(text) and longest_prefix(spec, text, i)[0] == b" ":
            i += longest_prefix(spec, text, i)[1]
        if i == len(text):
            return b"", np.zeros(1, np.int64)
    if spec.dummy_prefix:
        out += space
        origin += [i] * len(space)
    after_space = spec.remove_extra
    while i < len(text):
        got, n = longest_prefix(spec, text, i)
        got = got.lstrip(b" ") if after_space else got
        for c in got:
            out += space if c == 32 else bytes([c])
            origin += [i] * (len(space) if c == 32 else 1)
        after_space = spec.remove_extra and (got.endswith(b" ") if got else after_space)
        i += n
    end = len(text)
    while spec.remove_extra and out.endswith(space):
        end = origin[len(out) - len(space)]
        del out[-len(space) :], origin[-len(space) :]
    return bytes(out), np.r_[np.array(origin, np.int64), end]


class Encoder:
    """A model's normaliser, done here, and its segmentation and decoding, which are the library's."""

    def __init__(self, model: bytes):
        self.spec, self.sp = read_spec(model), sentencepiece.SentencePieceProcessor(model_proto=model)
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=model + UNCHANGED)
        n = self.sp.get_piece_size()
        self.width = np.array([1 if self.sp.is_byte(i) else len(self.sp.id_to_piece(i).encode()) for i in range(n)], np.int64)
        self.unknown = self.sp.unk_id()
        self.names = [str(i) for i in range(n)]

    def encode(self, texts: list[bytes]) -> tuple[list[tuple[bytes, np.ndarray]], list[list[int]]]:
        """Normalised bytes and their origins, and the ids, of each text."""
        normal = [normalise(self.spec, t) for t in texts]
        return normal, self.plain.encode([t for t, _ in normal], num_threads=1)

    def spans(self, normal: bytes, origin: np.ndarray, ids: np.ndarray) -> np.ndarray | None:
        """Begin and end byte in the source of each id, one row each."""
        cut = np.r_[0, np.cumsum(self.width[ids])] if len(ids) else np.zeros(1, np.int64)
        if cut[-1] != len(normal) or (ids == self.unknown).any():
            return self._looked_up(normal, origin, ids)
        return np.stack([origin[cut[:-1]], origin[cut[1:]]], 1)

    def _looked_up(self, normal: bytes, origin: np.ndarray, ids: np.ndarray) -> np.ndarray | None:
        """Spans where a piece does not spell what it stands for (unknown ones): by the places the library gives."""
        found = self.plain.encode(normal, return_type="offset_mapping", return_bytes=True)
        return origin[np.array(found["offsets"], np.int64).reshape(-1, 2)] if found["ids"] == ids.tolist() else None


@lru_cache(2)
def encoder(model: bytes) -> Encoder:
    return Encoder(model)


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _encoded(texts: list[str | None], e: Encoder, limit: int = 1 << 19) -> Iterator[tuple[int, list[list[int]], list[np.ndarray | None]]]:
    """First row, ids and spans of runs of rows."""
    lo = 0
    while lo < len(texts):
        hi, n, part = lo, 0, []
        while hi < len(texts) and (hi == lo or n < limit):
            part.append((texts[hi] or "").encode("utf-8", "replace"))
            n += len(part[-1])
            hi += 1
        normal, ids = e.encode(part)
        yield lo, ids, [e.spans(t, origin, np.array(i, np.int64)) for (t, origin), i in zip(normal, ids, strict=True)]
        lo = hi


def _digests(model: bytes):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(model)
        hexed = lambda b: hashlib.sha256(b).hexdigest()
        for x in batches:
            rows = []
            for _, ids, spans in _encoded(x.column("text").to_pylist(), e):
                back = e.sp.decode(ids, num_threads=1)
                for i, d, s in zip(ids, back, spans, strict=True):
                    rows.append((len(i), hexed(",".join([e.names[k] for k in i]).encode()), hexed(d.encode()), None if s is None else hexed(s.astype("<i4").tobytes())))
            n, a, b, c = zip(*rows, strict=True) if rows else ([],) * 4
            yield pa.RecordBatch.from_arrays([x.column("doc_id"), pa.array(n, pa.int64()), *(pa.array(v, pa.string()) for v in (a, b, c))], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])

    return run


def _full(model: bytes, names: list[str]):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(model)
        for x in batches:
            for lo, ids, spans in _encoded(x.column(0).to_pylist(), e):
                back = e.sp.decode(ids, num_threads=1)
                cut = np.r_[0, np.cumsum([len(i) for i in ids])].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate([np.array(i, np.int32) for i in ids])))
                ends = [pa.array([None if s is None else s[:, k] for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, len(ids)) for c in x.columns[1:]), lists, *ends, pa.array(back, pa.string())], names)

    return run


def encode(df: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """df with ids, begins, ends (byte spans in the UTF-8 text) and decoded."""
    added = ["ids", "begins", "ends", "decoded"]
    source = df.select(F.col(text).cast("string").alias(unused(df, "__text")), *[F.col(f"`{c}`") for c in df.columns if c not in added])
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[1:]]
    schema = ", ".join([*kinds, "ids array<int>", "begins array<int>", "ends array<int>", "decoded string"])
    return source.mapInArrow(_full(read_model(model_path), [*source.columns[1:], *added]), schema)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op5_sentencepiece(documents: DataFrame, model_path: str | None = None) -> DataFrame:
    """The digests of the contract, and spans_sha256: of begin and end bytes as little-endian 32-bit pairs."""
    model = read_model(model_path or default_model())
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_digests(model), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")
