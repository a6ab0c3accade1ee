"""Sections of a text's lines: what a line belongs to is told by the last line before it that begins something."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .chains import bound

#: What a line is, and the state that it begins; of several that hold, the first counts.
Rules = list[tuple[Callable[[Column], Column], str]]


def text_lines(text: Column) -> Column:
    """Trimmed lines of a text; a null text has one blank line."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), r"\n"), lambda x: F.trim(x, F.lit(" \t\r\x0b\x0c")))


def stated(lines: Column, rules: Rules, start: str) -> Column:
    """Each line with its state (array of line, state, begins): that of the last line up to it that begins one, else ``start``.

    Only the lines that begin a state are looked at together, so time grows
    with the lines and not with their square.
    """

    def state_of(line: Column) -> Column:
        found = F.when(rules[0][0](line), rules[0][1])
        for true, state in rules[1:]:
            found = found.when(true(line), state)
        return found

    def spread(xs: Column, marks: Column) -> Column:
        def until_next(mark: Column, k: Column) -> Column:
            first = F.greatest(mark["i"], F.lit(0))
            many = F.coalesce(F.get(marks, k + 1)["i"], F.size(xs)) - first
            return F.transform(F.slice(xs, first + 1, many), lambda x, j: F.struct(x.alias("line"), mark["state"].alias("state"), ((j == 0) & (mark["i"] >= 0)).alias("begins")))

        return F.flatten(F.transform(marks, until_next))

    def found(xs: Column) -> Column:
        each = F.transform(xs, lambda x, i: F.struct(i.alias("i"), state_of(x).alias("state")))
        marks = F.concat(F.array(F.struct(F.lit(-1).alias("i"), F.lit(start).alias("state"))), F.filter(each, lambda m: m["state"].isNotNull()))
        return bound(marks, lambda ms: spread(xs, ms))

    return bound(lines, found)


def lines_in(lines: Column, state: str) -> Column:
    """Of stated() lines those of a state, without the ones that begin it."""
    return F.transform(F.filter(lines, lambda r: (r["state"] == state) & ~r["begins"]), lambda r: r["line"])


def place_of(xs: Column, true: Callable[[Column], Column]) -> Column:
    """Place (from 1) of the first item that is so; one past the end if none is."""
    marked = F.transform(xs, lambda x, i: F.when(true(x), i + 1))
    return F.coalesce(F.array_min(marked), F.size(xs) + 1)


def cut(xs: Column, first: Column, end: Column) -> Column:
    """Items from one place up to, but without, another one; none if that is no later."""
    return F.slice(xs, first, F.greatest(end - first, F.lit(0)))


def unrepeated(rows: Column, key: Callable[[Column], Column], better: Callable[[Column], Column]) -> Column:
    """Of rows of one key the first that is ``better``, else the first, in their order; by sorting, so time is n log n."""
    numbered = F.transform(rows, lambda r, i: F.struct(key(r).alias("k"), F.when(better(r), 0).otherwise(1).alias("worse"), i.alias("i"), r.alias("r")))
    firsts = bound(F.array_sort(numbered), lambda xs: F.filter(xs, lambda x, i: (i == 0) | (F.get(xs, i - 1)["k"] != x["k"])))
    return F.transform(F.array_sort(F.transform(firsts, lambda x: F.struct(x["i"].alias("i"), x["r"].alias("r")))), lambda x: x["r"])
