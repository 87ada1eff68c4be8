"""String semantics of the finding queries: no nulls, whole-term search, case rules.

A missing string reads as ``""`` everywhere, so every predicate below is null-free.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Every JSON text of a time keeps the microseconds, which decide the newest copy.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
}
_ALNUM = re.compile(r"[A-Za-z0-9]")


def text(value: Column) -> Column:
    """The string itself, ``""`` when missing."""
    return F.coalesce(value, F.lit(""))


def is_empty(value: Column) -> Column:
    return text(value) == ""


def not_empty(value: Column) -> Column:
    return text(value) != ""


def first_text(*values: Column) -> Column:
    """First non-empty string, ``""`` when there is none."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def term_pattern(*terms: str) -> str:
    """Case-insensitive regex that finds any term as a whole run of letters and digits.

    A boundary is only asked for at an edge of the term that is itself a letter or digit, so ``S3/`` may be
    followed by anything while ``Tor`` matches neither ``TorClient`` nor ``Monitor``.
    """
    if not terms or not all(terms):
        raise ValueError("terms must be non-empty")
    parts = []
    for term in terms:
        left = "(?<![A-Za-z0-9])" if _ALNUM.match(term[0]) else ""
        right = "(?![A-Za-z0-9])" if _ALNUM.match(term[-1]) else ""
        parts.append(left + r"\Q" + term + r"\E" + right)
    return "(?i)(?:" + "|".join(parts) + ")"


def has(value: Column, *terms: str) -> Column:
    """True when any of the terms occurs as a whole term."""
    return F.rlike(text(value), F.lit(term_pattern(*terms)))


def contains(value: Column, needle: str) -> Column:
    """Case-insensitive substring test."""
    return F.contains(F.lower(text(value)), F.lit(needle.lower()))


def starts_with(value: Column, prefix: str) -> Column:
    """Case-insensitive prefix test."""
    return F.startswith(F.lower(text(value)), F.lit(prefix.lower()))


def is_true(value: Column) -> Column:
    return value.eqNullSafe(F.lit(True))


def is_false(value: Column) -> Column:
    return value.eqNullSafe(F.lit(False))


def first_match(rules, default: str) -> Column:
    """Label of the first rule whose condition holds; ``rules`` is ``[(condition, label), ...]``."""
    chain = None
    for condition, label in rules:
        chain = F.when(condition, F.lit(label)) if chain is None else chain.when(condition, F.lit(label))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def classify(value: Column, table, default: str) -> Column:
    """``first_match`` over a table of ``(label, terms)`` tested as whole terms of one column."""
    return first_match([(has(value, *terms), label) for label, terms in table], default)


def points(*scores) -> Column:
    """Sum of the points whose condition holds; ``scores`` is ``(condition, points), ...``."""
    total = F.lit(0)
    for condition, value in scores:
        total = total + F.when(condition, F.lit(value)).otherwise(F.lit(0))
    return total


def json_bag(*fields: Column) -> Column:
    """JSON object text of the named columns, keeping the members that are null; times in UTC with microseconds."""
    return F.to_json(F.struct(*fields), JSON_OPTIONS)
