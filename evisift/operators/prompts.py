"""Prompt texts and settings: sections, term lists, flags and groups of domains.  One short text each, read on the driver.

Operators: R16 R17 R19 H54 H62 H70 H71 H72 H76 H78 H80 H81 H84.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from typing import Any, NamedTuple

from .contexts import CORE_FIELDS, EXCLUSION_PREFIXES
from .evidence import term_list, term_pattern

_LABELS = {"include", "exclude", "and", "or"}
LONGEST_KEYWORD, MOST_WORDS = 40, 4


def _key(name: str) -> str:
    return re.sub("[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def _heading(line: str) -> str:
    return re.sub(r"\s*/\s*", "/", " ".join(line.lower().replace("\\", "/").split()).strip(":"))


def rule_terms(prompt: str, headings: Iterable[str], rule: str = "include") -> list[str]:
    """Lower-case terms of the ``- Include:`` lines under any of the headings, each once, in order.

    A line that begins with neither a dash nor # is a heading; blank lines and # lines leave the section as it is."""
    wanted, inside, found = {_heading(h) for h in headings}, False, {}
    for line in filter(None, (raw.strip() for raw in prompt.splitlines())):
        if line.startswith("-"):
            label, colon, rest = line[1:].partition(":")
            if inside and colon and label.strip().lower() == rule.lower():
                for t in term_list(re.sub("[–—]", ",", rest), least=1):
                    term = re.sub(r"^(?:for example|e\.g\.)\s+", "", " ".join(t.split()).strip(" .:-").lower()).strip()
                    if 3 <= len(term) <= 120 and term not in _LABELS:
                        found[term] = None
        elif not line.startswith("#"):
            inside = _heading(line) in wanted
    return list(found)


def sections(prompt: str) -> list[tuple[str, str]]:
    """Heading and text of each part that a line ``# heading`` opens; what comes before the first is left out."""
    parts = re.split(r"(?m)^#[ \t]+(\S.*?)[ \t]*$", prompt)
    return [(h, body.strip()) for h, body in zip(parts[1::2], parts[2::2], strict=True)]


def guidance_blocks(prompt: str) -> list[str]:
    """The numbered blocks, ``1) ...``, of all sections on steps; a section without numbers is one block."""
    steps = [body for head, body in sections(prompt) if _key(head).startswith("steps")]
    return [b.strip() for body in steps for b in re.split(r"(?m)^(?=\s*[0-9]+\)\s)", body) if b.strip()]


def without_sections(prompt: str, starts: Iterable[str] = ("steps", "end goal")) -> str:
    """The prompt without sections whose heading begins so, with one blank line between what is left."""
    names = tuple(map(_key, starts))
    before = re.split(r"(?m)^#[ \t]+\S", prompt, maxsplit=1)[0].strip()
    kept = [f"# {h}\n{body}".strip() for h, body in sections(prompt) if not _key(h).startswith(names)]
    return "\n\n".join(filter(None, [before, *kept])) + "\n"


def required_keys(prompt: str) -> set[str]:
    """Names listed as ``- "name":`` lines between the headings END GOAL and NARROWING."""
    found, inside = set(), False
    for line in map(str.strip, prompt.splitlines()):
        if line.lower().startswith("# end goal"):
            inside = True
        elif inside and line.lower().startswith("# narrowing"):
            break
        elif inside and (m := re.fullmatch(r'-\s*"([A-Za-z_]\w*)"\s*:', line, re.ASCII)):
            found.add(m[1])
    return found


def is_exclusion_key(name: str) -> bool:
    k = _key(name)
    return bool(k) and k not in CORE_FIELDS and (k.startswith(tuple(EXCLUSION_PREFIXES)) or k.endswith("_context"))


class FlagSchema(NamedTuple):
    """Flags of a stage, those that may be neutral, and the reason that stands for too little context."""

    flags: list[str]
    neutral: list[str]
    insufficient: str | None


def flag_schema(tags: Iterable[str], prompt: str) -> FlagSchema:
    """Flags from tags and from a prompt's required keys, sorted; without any the stage cannot run."""
    flags = sorted({_key(t) for t in tags if _key(t)} | {_key(k) for k in required_keys(prompt) if is_exclusion_key(k)})
    if not flags:
        raise ValueError("neither tags nor the prompt name an exclusion flag")
    lacking = [f for f in flags if "insufficient" in f]
    return FlagSchema(flags, [f for f in flags if f.endswith("_context")], "insufficient_context" if "insufficient_context" in flags else next(iter(lacking), None))


class Signals(NamedTuple):
    """Patterns of a prompt's primary and secondary terms (None without terms) and keywords for thin sections."""

    source: str
    primary: str | None
    secondary: str | None
    keywords: list[str]


def signals(prompt: str, primary: Iterable[str], secondary: Iterable[str], generic: Iterable[str] = ()) -> Signals:
    """From the include terms under each kind of heading; keywords are the generic ones and all concise terms."""
    first, second = rule_terms(prompt, primary), rule_terms(prompt, secondary)
    short = {t for t in first + second if len(t) <= LONGEST_KEYWORD and len(t.split()) <= MOST_WORDS}
    pattern = lambda terms: term_pattern(terms) if terms else None
    return Signals("prompt_criteria" if first or second else "no_prompt_signals", pattern(first), pattern(second), sorted({*generic, *short}))


def domain_groups(domains: list[str], groups: Iterable[str | Iterable[str]] = ()) -> list[tuple[str, ...]]:
    """Configured groups, then each remaining domain by itself; an unknown domain is an error."""
    named = [tuple(dict.fromkeys(d.strip() for d in ([g] if isinstance(g, str) else g) if d.strip())) for g in groups]
    if unknown := {d for g in named for d in g} - set(domains):
        raise ValueError(f"unknown domains: {', '.join(sorted(unknown))}")
    return [g for g in named if g] + [(d,) for d in domains if not any(d in g for g in named)]


def for_domains(variables: list[tuple[str, str]], domains: Iterable[str]) -> list[tuple[str, str]]:
    """The (domain, variable) pairs of some domains; an unknown domain is an error."""
    wanted = list(domains)
    if unknown := set(wanted) - {d for d, _ in variables}:
        raise ValueError(f"unknown domains: {', '.join(sorted(unknown))}")
    return [v for v in variables if v[0] in wanted]


def second_look(context: str, answer: str, rules: Iterable[str]) -> str:
    """A context with the first answer and the rules by which to look again."""
    return "\n\n".join([context.rstrip(), "Earlier answer:\n" + answer.strip(), "Rules:\n" + "\n".join(f"- {r}" for r in rules)])


def setting(settings: Mapping[str, Any], name: str, kind: type, default: Any = None) -> Any:
    """A setting as int, float, bool or str; one that is absent is the default, or an error without any."""
    value = settings.get(name)
    if value is None:
        if default is None:
            raise KeyError(name)
        return default
    if kind is bool and isinstance(value, str):
        return value.strip().lower() in ("1", "true", "yes", "on")
    try:
        return kind(value)
    except (TypeError, ValueError) as e:
        raise ValueError(f"{name}: {value!r} is no {kind.__name__}") from e


def stage_rules(common: Mapping[str, Any], stage: Mapping[str, Any]) -> dict[str, Any]:
    """Common settings with those of a stage over them; nested ones merge, a null leaves the common one."""
    both = lambda a, b: stage_rules(a, b) if isinstance(a, Mapping) and isinstance(b, Mapping) else b
    return {**common, **{k: both(common.get(k), v) for k, v in stage.items() if v is not None}}
