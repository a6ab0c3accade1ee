"""Ordered replacement chains that run as Column expressions and print as SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A pattern and what replaces each match; groups are written \\1.
Chain = list[tuple[str, str]]


def replaced(c: Column, chain: Chain) -> Column:
    """c after every replacement of the chain in turn."""
    java = lambda r: re.sub(r"\\(\d)", r"$\1", r.replace("$", r"\$"))
    return reduce(lambda x, step: F.regexp_replace(x, step[0], java(step[1])), chain, c)


def replaced_sql(expression: str, chain: Chain) -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    return reduce(lambda x, step: f"regexp_replace({x}, {quoted(step[0])}, {quoted(step[1])}, 'g')", chain, expression)


def present(c: Column) -> Column:
    """c trimmed, null where nothing is left: the one missing-value policy of the library."""
    return F.nullif(F.trim(c), F.lit(""))


def contains_any(c: Column, needles: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(n) for n in needles])


def contains_any_sql(expression: str, needles: list[str]) -> str:
    return "(" + " OR ".join("contains({}, '{}')".format(expression, n.replace("'", "''")) for n in needles) + ")"


def first_match(c: Column, patterns: list[tuple[str, int]]) -> Column:
    """The group of the first pattern that matches, in order; null if none does."""
    return F.coalesce(*[F.when(c.rlike(p), F.regexp_extract(c, p, g)) for p, g in patterns])


def first_match_sql(expression: str, patterns: list[tuple[str, int]]) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({expression}, '{p}') THEN regexp_extract({expression}, '{p}', {g})" for p, g in patterns) + " END"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]
