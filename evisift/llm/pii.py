"""PII [native]: format-preserving Feistel pseudonyms.

Each kind of value is keyed-permuted within its own format, by a fixed number of Feistel rounds over mixed radices,
so equal values get equal pseudonyms in every document and distinct values distinct ones:

* ``card``: 13 to 19 digits, plain or in fours, that pass the Luhn check: all digits but the last are permuted and
  the check digit is worked out anew.  Numbers that fail the check are left alone.
* ``phone``: + and 10 to 15 digits with usual separators: the digits after the country code, which is read off the
  digits themselves, so the same number is the same value however it is spaced.
* ``ssn``: ddd-dd-dddd with a valid area, group and serial, permuted among the valid ones.
* ``ipv4``: four octets of 0 to 255: the 32 bits.
* ``date``: valid yyyy-mm-dd, dd.mm.yyyy and mm/dd/yyyy from 1900-01-01 on, within 270*270 days.
* ``email``: a local part of at most 64 characters: its letters and digits, each among their own; capitals stay where
  they are and the domain as it is.

The permutation of a part depends on the key, the kind and the part's length.  Everything is one projection of SQL
expressions over each row: no shuffle, no Python on the executors.

Cases: null text stays null and has no values; empty texts likewise have none; very long texts are rewritten whole;
repeated rows get equal results; an empty table gives no rows; input columns with added names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import unused
from .sqltext import found, let, lit, pieces

KINDS = ["email", "date", "ipv4", "ssn", "phone", "card"]
#: One alternation, so that values never overlap: the leftmost wins, then the order of KINDS.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-][A-Za-z0-9.-]*\.[A-Za-z]{2,}",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9])(?![./-][0-9])",
    "ipv4": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])(?!\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9+])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])",
}
#: Country codes of one and of two digits; all others have three.
COUNTRY = (["1", "7"], "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
#: Valid social security numbers have areas 001 to 899 but 666, groups 01 to 99 and serials 0001 to 9999.
AREAS, GROUPS, SERIALS = 898, 99, 9999
ROUNDS = 8
#: Days from FIRST_DAY that dates are permuted within: a square, so that both halves have one radix.
FIRST_DAY, DAY_RADIX = "1900-01-01", 270
BLOCK = 24


def feistel(left: str, right: str, left_radix: str, right_radix: str, key: str, tweak: str) -> str:
    """SQL for a struct l, r: a keyed bijection of [0, left_radix) x [0, right_radix).

    In turn, one half is added, modulo its radix, to a keyed hash of the round, tweak and other half.
    """
    prf = lambda half: f"cast(conv(substring(sha2(concat_ws('|', {lit(key)}, {tweak}, cast(i as string), cast({half} as string)), 256), 1, 15), 16, 10) as bigint)"
    step = f"if(i % 2 = 0, named_struct('l', (z.l + {prf('z.r')} % {left_radix}) % {left_radix}, 'r', z.r), named_struct('l', z.l, 'r', (z.r + {prf('z.l')} % {right_radix}) % {right_radix}))"
    return f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('l', cast({left} as bigint), 'r', cast({right} as bigint)), (z, i) -> {step})"


def _digits(d: str, key: str, tweak: str) -> str:
    """SQL for a permuted string of up to 36 digits of the same length; the empty string stays."""
    n, half = f"length({d})", f"cast(floor(length({d}) / 2) as int)"
    radix = lambda k: f"cast(rpad('1', {k} + 1, '0') as bigint)"
    cut = lambda a, k: f"coalesce(cast(nullif(substring({d}, {a}, {k}), '') as bigint), 0)"
    f = feistel(cut(1, half), cut(f"{half} + 1", f"{n} - {half}"), radix(half), radix(f"({n} - {half})"), key, f"concat({lit(tweak)}, {n})")
    return f"if({n} = 0, '', " + let(f, "f", f"concat(if({half} = 0, '', lpad(cast(f.l as string), {half}, '0')), lpad(cast(f.r as string), {n} - {half}, '0'))") + ")"


def _letters(d: str, key: str, tweak: str) -> str:
    """SQL for a permuted string of up to BLOCK lower-case letters of the same length."""
    number = lambda s: f"aggregate(filter(split({s}, ''), c -> c != ''), 0L, (z, c) -> z * 26 + (ascii(c) - 97))"
    text = lambda v, k: f"if({k} = 0, '', array_join(transform(sequence(1, greatest(1, {k})), j -> chr(97 + cast(({v} div cast(pow(26, {k} - j) as bigint)) % 26 as int))), ''))"
    n, half = f"length({d})", f"cast(floor(length({d}) / 2) as int)"
    radix = lambda k: f"cast(pow(26, {k}) as bigint)"
    f = feistel(number(f"substring({d}, 1, {half})"), number(f"substring({d}, {half} + 1)"), radix(half), radix(f"({n} - {half})"), key, f"concat({lit(tweak)}, {n})")
    return f"if({n} = 0, '', " + let(f, "f", f"concat({text('f.l', half)}, {text('f.r', f'({n} - {half})')})") + ")"


def _refill(shape: str, pattern: str, filled: str) -> str:
    """SQL for shape with the characters that match pattern replaced, in order, by those of filled; capitals stay capitals."""
    new = "substring(q, z.n + 1, 1)"
    put = f"aggregate(filter(split({shape}, ''), c -> c != ''), named_struct('n', 0, 'out', ''), (z, c) -> if(c rlike {lit(pattern)}, named_struct('n', z.n + 1, 'out', concat(z.out, if(c between 'A' and 'Z', upper({new}), {new}))), named_struct('n', z.n, 'out', concat(z.out, c))), z -> z.out)"
    return let(filled, "q", put)


def _check_digit(d: str) -> str:
    """SQL for the Luhn digit that completes a digit string."""
    worth = "if(k % 2 = 0, if(cast(c as int) * 2 > 9, cast(c as int) * 2 - 9, cast(c as int) * 2), cast(c as int))"
    return f"cast((10 - aggregate(transform(filter(split(reverse({d}), ''), c -> c != ''), (c, k) -> {worth}), 0, (z, x) -> z + x) % 10) % 10 as string)"


def _only(m: str, kept: str) -> str:
    return f"regexp_replace({m}, {lit('[^' + kept + ']')}, '')"


def _blocks(s: str, size: int, each: str) -> str:
    """SQL for each block of a string of any length, permuted with its number, joined again."""
    return f"if(length({s}) = 0, '', array_join(transform(sequence(0, cast(floor((length({s}) - 1) / {size}) as int)), b -> {each}), ''))"


def _pseudonyms(key: str) -> dict[str, tuple[str, str]]:
    """Kind: SQL that says whether m is valid, and SQL for its pseudonym."""
    digits = _only("m", "0-9")
    code = f"case when substring(d, 1, 1) in ({', '.join(map(lit, COUNTRY[0]))}) then 1 when substring(d, 1, 2) in ({', '.join(map(lit, COUNTRY[1]))}) then 2 else 3 end"
    area = "cast(substring(d, 1, 3) as int) - if(substring(d, 1, 3) > '666', 2, 1)"
    ssn = feistel(f"({area}) * {GROUPS} + cast(substring(d, 4, 2) as int) - 1", "cast(substring(d, 6) as int) - 1", str(AREAS * GROUPS), str(SERIALS), key, "'ssn'")
    new_area = f"f.l div {GROUPS} + if(f.l div {GROUPS} >= 665, 2, 1)"
    ssn = let(ssn, "f", f"concat_ws('-', lpad(cast({new_area} as string), 3, '0'), lpad(cast(f.l % {GROUPS} + 1 as string), 2, '0'), lpad(cast(f.r + 1 as string), 4, '0'))")
    split_date = "if(m like '____-__-__', 'yyyy-MM-dd', if(m like '__.__.____', 'dd.MM.yyyy', 'MM/dd/yyyy'))"
    date = f"to_date(try_to_timestamp(m, {split_date}))"
    day = f"datediff({date}, date'{FIRST_DAY}')"
    ip = "aggregate(split(m, '[.]'), 0L, (z, x) -> z * 256 + cast(x as bigint))"
    dotted = "concat_ws('.', cast(floor(f.l / 256) as string), cast(f.l % 256 as string), cast(floor(f.r / 256) as string), cast(f.r % 256 as string))"
    local = "substring_index(m, '@', 1)"
    own = lambda kept: let(_only(local, kept), "w", _blocks("w", BLOCK, let(f"substring(w, b * {BLOCK} + 1, {BLOCK})", "x", (_digits if kept == "0-9" else _letters)("x", key, "email"))))
    lowered = f"transform(array(lower({_only(local, 'A-Za-z')})), w -> {_blocks('w', BLOCK, let(f'substring(w, b * {BLOCK} + 1, {BLOCK})', 'x', _letters('x', key, 'email')))})[0]"
    new_local = _refill(_refill(local, "[0-9]", own("0-9")), "[A-Za-z]", lowered)
    return {
        "email": ("true", f"concat({new_local}, substring(m, instr(m, '@')))"),
        "date": (f"coalesce({day} >= 0 and {day} < {DAY_RADIX**2}, false)", let(day, "d", let(feistel(f"floor(d / {DAY_RADIX})", f"d % {DAY_RADIX}", str(DAY_RADIX), str(DAY_RADIX), key, "'date'"), "f", f"date_format(date_add(date'{FIRST_DAY}', cast(f.l * {DAY_RADIX} + f.r as int)), {split_date})"))),
        "ipv4": ("forall(split(m, '[.]'), x -> cast(x as int) <= 255)", let(ip, "v", let(feistel("floor(v / 65536)", "v % 65536", "65536", "65536", key, "'ipv4'"), "f", dotted))),
        "ssn": ("not m rlike '^(000|666|9)|-00-|0000$'", let(digits, "d", ssn)),
        "phone": (f"length({digits}) between 10 and 15", let(digits, "d", let(code, "k", _refill("m", "[0-9]", f"concat(substring(d, 1, k), {_digits('substring(d, k + 1)', key, 'phone')})")))),
        "card": (f"luhn_check({digits})", let(_digits(f"substring({digits}, 1, length({digits}) - 1)", key, "card"), "d", _refill("m", "[0-9]", f"concat(d, {_check_digit('d')})"))),
    }


def pseudonymise(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """df with the values in its text replaced, and ``pii``: struct k, m, r (kind, value's place in the text's matches).

    ``pii`` is an array of structs kind, pseudonym in order of their place; the values themselves are not returned.
    """
    t, every = unused(df, "__text"), unused(df, "__all")
    any_kind = "|".join(PATTERNS.values())
    rules = _pseudonyms(key)
    kind = "case " + " ".join(f"when m rlike {lit('^(?:' + PATTERNS[k] + ')$')} and {rules[k][0]} then {lit(k)}" for k in KINDS) + " else '' end"
    new = "case k " + " ".join(f"when {lit(k)} then {rules[k][1]}" for k in KINDS) + " else m end"
    each = f"transform({found(t, any_kind)}, m -> " + let(kind, "k", f"named_struct('kind', k, 'pseudonym', {new})") + ")"
    none = "cast(array() as array<struct<kind:string,pseudonym:string>>)"
    df = df.withColumn(t, F.col(text).cast("string"))
    df = df.withColumn(every, F.expr(f"if({t} rlike '[0-9@]', {each}, {none})"))
    whole = f"array_join(zip_with({pieces(t, any_kind)}, {every}, (p, r) -> concat(p, coalesce(r.pseudonym, ''))), '')"
    return df.withColumn(text, F.expr(f"if(size({every}) = 0, {t}, {whole})")).withColumn("pii", F.expr(f"coalesce(filter({every}, r -> r.kind != ''), {none})")).drop(t, every)


def count(kind: str) -> Column:
    return F.expr(f"cast(size(filter(pii, r -> r.kind = {lit(kind)})) as long)").alias(f"n_{kind}")


def op3_pii_feistel(documents: DataFrame, key: str) -> DataFrame:
    """doc_id, the number of values of each kind, the rewritten text and the pseudonyms in order, kind:pseudonym."""
    out = pseudonymise(documents.select("doc_id", "text"), key)
    return out.select("doc_id", *[count(k) for k in KINDS], "text", F.expr("transform(pii, r -> concat(r.kind, ':', r.pseudonym))").alias("pseudonyms"))
