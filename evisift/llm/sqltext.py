"""SQL expression texts shared by the native operators: matches of a pattern as spans, literals, let-bindings."""

from __future__ import annotations

SPANS = "array<struct<a:int,b:int,m:string>>"


def lit(x: str) -> str:
    """A SQL string literal, whatever it holds."""
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(value: str, name: str, body: str) -> str:
    """body with name bound to value, which is then worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def pieces(text: str, pattern: str) -> str:
    """What lies between the leftmost non-overlapping matches: one piece more than matches."""
    return f"split({text}, {lit(pattern)}, -1)"


def found(text: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({text}, {lit(pattern)}, {group})"


#: Matches whose places are summed up together before the sums of all such runs are.
RUN = 128


def spans(text: str, pattern: str) -> str:
    """Matches as structs a, b, m: start and end in code points, end exclusive, and the match; none where none is.

    regexp_extract_all has no positions, so they are running sums of the lengths of pieces and matches: first within
    runs of RUN matches, then over the runs, as a fold copies its list at every step.
    """
    step = "named_struct('at', z.at + length(x.p) + length(x.m), 'out', concat(z.out, array(named_struct('a', z.at + length(x.p), 'b', z.at + length(x.p) + length(x.m), 'm', x.m))))"
    run = f"aggregate(slice(x, r * {RUN} + 1, {RUN}), named_struct('at', 0, 'out', cast(array() as {SPANS})), (z, x) -> {step})"
    runs = f"transform(sequence(0, (size(x) - 1) div {RUN}), r -> {run})"
    first = "aggregate(g, array(0), (z, q) -> concat(z, array(element_at(z, -1) + q.at)))"
    moved = "flatten(zip_with(g, slice(s, 1, size(g)), (q, o) -> transform(q.out, v -> named_struct('a', v.a + o, 'b', v.b + o, 'm', v.m))))"
    both = "zip_with(slice(p, 1, size(m)), m, (p, m) -> named_struct('p', p, 'm', m))"
    walk = let(both, "x", let(runs, "g", let(first, "s", moved)))
    return f"if({text} rlike {lit(pattern)}, " + let(pieces(text, pattern), "p", let(found(text, pattern), "m", walk)) + f", cast(array() as {SPANS}))"
