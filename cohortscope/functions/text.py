"""Text expressions: guidance classification, list fields, identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from cohortscope import domain
from cohortscope.functions import literal, literals

SUMMARY_LENGTH = 500

# What Python's str.strip removes.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def blank_if_null(text: str) -> str:
    return f"coalesce({text}, '')"


def filled(text: str) -> str:
    """Null for an empty string."""
    return f"nullif({text}, '')"


def stripped(text: str) -> str:
    return f"btrim({text}, {literal(WHITESPACE)})"


def name_key(name: str) -> str:
    return f"lower({stripped(name)})"


def any_pattern(patterns: Sequence[str]) -> str:
    """One regular expression for a set; (?U) gives word borders for all letters."""
    return "(?U)" + "|".join(f"(?:{p})" for p in patterns)


def recommendation_flags(text: str, strength: str) -> tuple[str, str]:
    """(requires dose change, requires alternative) of a guidance text."""
    graded = f"{name_key(blank_if_null(strength))} NOT IN ({literals(domain.UNGRADED_STRENGTHS)})"
    lowered = f"lower({blank_if_null(text)})"
    change, alternative = (
        f"({graded} AND {lowered} RLIKE {literal(any_pattern(patterns))})"
        for patterns in (domain.DOSE_CHANGE_PATTERNS, domain.ALTERNATIVE_PATTERNS)
    )
    return change, alternative


def listed_names(names: str) -> str:
    """Names of a comma or semicolon list; a null list has one empty name."""
    return f"transform(split({blank_if_null(names)}, '[,;]'), n -> {name_key('n')})"


def cross_reference_ids(references: str, prefix: str) -> str:
    """Comma-joined values of the ``PREFIX:value`` entries of one prefix."""
    marker = f"{prefix}:"
    entries = f"transform(split({blank_if_null(references)}, ','), e -> {stripped('e')})"
    matching = f"filter({entries}, e -> startswith(e, {literal(marker)}))"
    return f"array_join(transform({matching}, e -> substring(e, {len(marker) + 1})), ',')"


def summary(text: str) -> str:
    return f"substring({blank_if_null(text)}, 1, {SUMMARY_LENGTH})"


def whole_number(value: str) -> str:
    """A bigint, or null where the value is not a whole number."""
    return f"try_cast({value} AS BIGINT)"
