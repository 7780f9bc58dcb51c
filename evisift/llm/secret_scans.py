"""Secret scans [native]: fixed patterns, and Shannon entropy in sliding windows per character class.

Everything is one projection of SQL expressions over each row: no shuffle, no Python on the executors.

* Patterns: ``assign``, ``access`` and ``hex``, leftmost non-overlapping per kind over the whole text.
* Entropy: a candidate is a maximal run of one character class (``HEX``, ``BASE64``) of at least ``WINDOW``
  characters with a digit in it, or in ``BASE64`` a capital right after a small letter.  A fold over its characters keeps a count per symbol of the class, and the sum of
  c*log2(c) changes by one entering and one leaving symbol per step: H = log2(w) - sum/w.  Windows at or over the
  class's limit are hot; hot windows that touch or overlap are one span of kind ``hexent`` or ``b64ent``.
* Allow list: a candidate that matches an anchored one of ``ALLOW`` (UUIDs, dates), or follows a digest label, or a
  span within a pattern's span, is suppressed.  Of the others (placeholders) only the part between / = _ and - that
  holds the match is left out; what is before and after it is judged by itself.  Pattern spans are never suppressed.

Cases: null text is empty; an empty text has no span, an empty ``spans`` and the digest of the empty string; very
long texts and repeated rows are scanned whole, each row by itself, so ties need no rule; an empty table gives no
rows; columns of the input with the names of added ones are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import unused
from .sqltext import SPANS, let, lit, spans

# The patterns of the three kinds and the least length of a hit.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Both need no check afterwards: a run that is too short cannot match from a later start either.
ACCESS, HEX = r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ["assign", "access", "hex", "hexent", "b64ent"]

WINDOW = 20
#: Kind: alphabet, least entropy in bits of a window, candidate pattern.
CLASSES = {
    "hexent": ("0123456789abcdef", 3.0, r"(?<![0-9A-Za-z])(?=[a-fA-F]*[0-9])[0-9a-fA-F]{%d,}+(?![0-9A-Za-z])"),
    "b64ent": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", 3.9, r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/=_-]*(?:[0-9]|[a-z][A-Z]))[A-Za-z0-9+/=_-]{%d,}+"),
}
ALLOW = [
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"(?i)example|sample|dummy|placeholder|changeme|x{6,}",
    r"^[0-9/=_+-]+$",
]
DIGEST_LABEL = r"(?i)(?:sha-?(?:1|256|384|512)|md5|checksum|integrity)[ :=-]{1,3}$"


def hot_windows(run: str, alphabet: str, limit: float, window: int) -> str:
    """SQL for the merged hot windows of a string: array of structs a, b."""
    gain = "array(" + ", ".join(f"{(c * math.log2(c)) if c else 0.0!r}D" for c in range(window + 1)) + ")"
    folded = f"lower({run})" if alphabet == alphabet.lower() and "A" not in alphabet else run
    codes = f"transform(filter(split({folded}, ''), c -> c != ''), c -> instr({lit(alphabet)}, c) - 1)"
    code, out, count = "get(codes, i)", f"if(i >= {window}, get(codes, i - {window}), -1)", "get(z.counts, {})"
    change = f"if(code = gone, 0D, get(gain, {count.format('code')} + 1) - get(gain, {count.format('code')}) + if(gone < 0, 0D, get(gain, {count.format('gone')} - 1) - get(gain, {count.format('gone')})))"
    hot = f"(i >= {window - 1} and {math.log2(window)!r}D - s / {window} >= {limit!r}D)"
    fresh = f"(z.open < 0 or i - {window - 1} > z.last)"
    step = f"""named_struct(
        'counts', transform(z.counts, (x, k) -> x + if(k = code, 1, 0) - if(k = gone, 1, 0)), 's', s,
        'open', if({hot} and {fresh}, i - {window - 1}, z.open), 'last', if({hot}, i + 1, z.last),
        'out', if({hot} and {fresh} and z.open >= 0, concat(z.out, array(named_struct('a', z.open, 'b', z.last))), z.out))"""
    step = let(code, "code", let(out, "gone", let(f"z.s + {change}", "s", step)))
    zero = f"named_struct('counts', array_repeat(0, {len(alphabet)}), 's', 0D, 'open', -1, 'last', -1, 'out', cast(array() as array<struct<a:int,b:int>>))"
    fold = f"aggregate(sequence(0, size(codes) - 1), {zero}, (z, i) -> {step}, z -> if(z.open < 0, z.out, concat(z.out, array(named_struct('a', z.open, 'b', z.last)))))"
    return let(gain, "gain", let(codes, "codes", fold))


def _entropy_spans(text: str, kind: str, allow: list[str], window: int) -> str:
    alphabet, limit, pattern = CLASSES[kind]
    whole = [x for x in allow if "_" not in alphabet or x.startswith(("^", "(?i)^"))]
    ok = " and ".join([f"not c.m rlike {lit(x)}" for x in whole] + [f"not substring({text}, greatest(1, c.a - 15), least(16, c.a)) rlike {lit(DIGEST_LABEL)}"])
    kept = f"filter({spans(text, pattern % window)}, c -> {ok})"
    words = [x for x in allow if x not in whole]
    hot = lambda m, at: f"transform({hot_windows(m, alphabet, limit, window)}, h -> named_struct('a', {at} + h.a, 'b', {at} + h.b, 'm', ''))"
    if words:
        part = "(?<![^/=_-])[^/=_-]*?(?:" + "|".join(f"(?:{x})" for x in words) + ")[^/=_-]*+"
        begin = "if(i = 0, 0, get(p, i - 1).b)"
        gaps = f"transform(sequence(0, size(p)), i -> named_struct('a', c.a + {begin}, 'm', substring(c.m, {begin} + 1, if(i < size(p), get(p, i).a, length(c.m)) - {begin})))"
        left = let(spans("c.m", part), "p", f"filter({gaps}, x -> length(x.m) >= {window})")
        kept = f"flatten(transform({kept}, c -> {left}))"
    return f"flatten(transform({kept}, c -> {hot('c.m', 'c.a')}))"


def _kind(array: str, no: int) -> str:
    return f"transform({array}, s -> named_struct('a', s.a, 'k', {no}, 'b', s.b))"


def find_secrets(df: DataFrame, text: str = "text", allow: list[str] | None = None, window: int = WINDOW) -> DataFrame:
    """df with ``secrets``: every span as struct a, k, b (start, number of kind, end), sorted by start, then kind."""
    allow = ALLOW if allow is None else allow
    t, base = unused(df, "__text"), unused(df, "__base")
    df = df.withColumn(t, F.coalesce(F.col(text).cast("string"), F.lit("")))
    assign = f"filter({spans(t, ASSIGN)}, s -> length(regexp_extract(s.m, {lit('^' + ASSIGN)}, 2)) >= {ASSIGN_LEAST})"
    own = [_kind(assign, 0), _kind(spans(t, ACCESS), 1), _kind(spans(t, HEX), 2)]
    df = df.withColumn(base, F.expr(f"concat({', '.join(own)})"))
    more = f"concat({_kind(_entropy_spans(t, 'hexent', allow, window), 3)}, {_kind(_entropy_spans(t, 'b64ent', allow, window), 4)})"
    added = f"if({t} rlike {lit(r'[0-9A-Za-z+/=_-]{%d}' % window)} and {t} rlike '[0-9]|[a-z][A-Z]', filter({more}, e -> not exists({base}, s -> s.a <= e.a and e.b <= s.b)), cast(array() as array<struct<a:int,k:int,b:int>>))"
    return df.withColumn("secrets", F.expr(f"array_sort(concat({base}, {added}))")).drop(base, t)


def listed(array: str = "secrets", kinds: int = len(KINDS)) -> Column:
    """kind:start:end of each span whose kind is among the first so many, comma-joined."""
    names = "array(" + ", ".join(map(lit, KINDS)) + ")"
    return F.expr(f"concat_ws(',', transform(filter({array}, s -> s.k < {kinds}), s -> concat_ws(':', get({names}, s.k), s.a, s.b)))")


def redact_secrets(df: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """df with every span of its text replaced by mask, spans that overlap by one mask; null stays null."""
    step = "if(size(z) > 0 and element_at(z, -1).b > s.a, concat(slice(z, 1, size(z) - 1), array(named_struct('a', element_at(z, -1).a, 'b', greatest(element_at(z, -1).b, s.b)))), concat(z, array(named_struct('a', s.a, 'b', s.b))))"
    merged = f"aggregate(secrets, cast(array() as array<struct<a:int,b:int>>), (z, s) -> {step})"
    was = unused(df, "__was")
    cut = f"concat(array_join(transform(m, (s, i) -> concat(substring({was}, if(i = 0, 0, get(m, i - 1).b) + 1, s.a - if(i = 0, 0, get(m, i - 1).b)), {lit(mask)})), ''), substring({was}, element_at(m, -1).b + 1))"
    out = find_secrets(df, text).withColumn(was, F.col(text))
    return out.withColumn(text, F.expr(f"if(size(secrets) = 0, {was}, {let(merged, 'm', cut)})")).drop(was, "secrets")


def op1_secret_scans(documents: DataFrame) -> DataFrame:
    """The digests of the contract, and n_entropy, the number of spans that the entropy windows add."""
    found = find_secrets(documents.select("doc_id", "text"))
    n = lambda k: F.expr(f"cast(size(filter(secrets, s -> s.k = {k})) as long)")
    return found.select(
        "doc_id",
        n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(listed(kinds=3), 256).alias("base_sha256"), listed().alias("spans"), F.expr("cast(size(filter(secrets, s -> s.k > 2)) as long)").alias("n_entropy"),
    )


__all__ = ["ALLOW", "CLASSES", "KINDS", "SPANS", "WINDOW", "find_secrets", "hot_windows", "listed", "op1_secret_scans", "redact_secrets"]
