"""The few functions that no built-in expression covers, as Arrow batches.

Operators: P12 P24 P35 R1.
"""

from __future__ import annotations

import difflib
import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_END = re.compile(r"(?<=[.!?])[\"')\]]*\s+(?=[\"'(\[]*[A-ZÀ-Þ0-9])")
_SHORT = ("dr.", "prof.", "mr.", "mrs.", "ms.", "st.", "vs.", "etc.", "e.g.", "i.e.", "al.", "fig.", "no.", "z.b.", "bzw.", "ca.")


def split_sentences(text: str | None) -> list[str]:
    """Sentences with their punctuation; no break after common abbreviations and single initials."""
    out, held = [], ""
    for part in _END.split((text or "").strip()):
        held = f"{held} {part}" if held else part
        last = held.rsplit(None, 1)[-1].lower() if held.strip() else ""
        if last in _SHORT or re.fullmatch(r"[a-z]\.", last):
            continue
        if held.strip():
            out.append(held.strip())
        held = ""
    return [*out, held.strip()] if held.strip() else out


def ascii_fold(text: str | None) -> str:
    """Lower-case ASCII words, accents stripped."""
    t = unicodedata.normalize("NFKD", text or "").encode("ascii", "ignore").decode().lower()
    return " ".join(re.sub(r"[^a-z0-9]+", " ", re.sub(r"\.pdf$", "", t)).split())


def _objects(t: str, begin: int, met: set[int]) -> tuple[int, int] | None:
    """Begin and end of the first object that closes, reading from a brace on; met gets the braces read outside strings."""
    stack, quoted, escaped, found = [], False, False, None
    for i in range(begin, len(t)):
        c = t[i]
        if quoted:
            quoted, escaped = escaped or c != '"', not escaped and c == "\\"
        elif c == '"':
            quoted = True
        elif c == "{":
            met.add(i)
            stack.append(i)
        elif c == "}":
            at = stack.pop()
            if found is None or at < found[0]:
                found = (at, i + 1)
            if not stack:
                break
    return found


def json_object(text: str | None) -> str | None:
    """The first balanced object of a text, strings and escapes honoured.

    One reading settles all braces that it meets outside strings, so a text full of open braces is read once or twice.
    """
    t, met, best = text or "", set(), None
    begin = t.find("{")
    while begin >= 0 and (best is None or begin < best[0]):
        if begin not in met:
            found = _objects(t, begin, met)
            if found and (best is None or found[0] < best[0]):
                best = found
        begin = t.find("{", begin + 1)
    return t[best[0] : best[1]] if best else None


def without_authors(text: str | None, authors: str | None) -> str:
    """The text without the author line and without each of its parts."""
    t = text or ""
    for part in sorted({(authors or "").strip(), *(p.strip() for p in re.split(r"[;\n|]", authors or ""))} - {""}, key=len, reverse=True):
        t = re.sub(re.escape(part), " ", t, flags=re.I)
    return " ".join(t.split())


@F.pandas_udf(T.ArrayType(T.StringType()))
def sentences(text: pd.Series) -> pd.Series:
    return text.map(split_sentences)


@F.pandas_udf(T.StringType())
def folded(text: pd.Series) -> pd.Series:
    return text.map(ascii_fold)


@F.pandas_udf(T.StringType())
def first_json_object(text: pd.Series) -> pd.Series:
    return text.map(json_object)


@F.pandas_udf(T.StringType())
def redact_authors(text: pd.Series, authors: pd.Series) -> pd.Series:
    return pd.Series([without_authors(t, a) for t, a in zip(text, authors, strict=True)], dtype=object)


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity; what is known of b, and the ratio, serve the next row too if it is the same."""
    m, last, out = difflib.SequenceMatcher(None), (None, None), []
    for x, y in zip(a, b, strict=True):
        x, y = x or "", y or ""
        if y != last[1]:
            m.set_seq2(y)
        if (x, y) != last:
            m.set_seq1(x)
            out.append(m.ratio())
        else:
            out.append(out[-1])
        last = (x, y)
    return pd.Series(out, dtype=float)
