"""Recipe layouts that go over several lines: blocks of names, amounts and units, scoped solutions, references, prose.

A text is split into lines once; blocks are found by the places of the first
and last lines of a kind, so each layout is one Column expression.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.chains import bound

# Fixed values.

#: What a line of a recipe may hold to be taken for an ingredient, in any case.
INDICATORS = [
    "cl", "so4", "po4", "no3", "co3", "hco3", "h2o", "x", "·", "na", "k", "mg", "ca", "fe", "zn", "cu", "mn", "nh4", "no2",
    "extract", "agar", "glucose", "peptone", "yeast", "starch", "casitone", "tryptone", "beef", "malt", "sucrose", "fructose", "lactose", "maltose", "glycerol", "ethanol", "acetate", "citrate",
    "pyruvate", "succinate", "fumarate", "malate", "vitamin", "biotin", "thiamine", "nicotinic", "folic", "cobalamin", "trace", "solution", "gellan", "carrageenan",
]
NO_INGREDIENT = ["medium", "distilled water", "adjust", "©", "reserved", "dsmz", "sterilize"]
UNIT_LINES = ["g", "mg", "ml", "l", "g/l", "mg/l", "mm", "μm", "m", "μl"]
SOLUTION_HEAD = r"(?i)solution|salts"
SOLUTION_SKIP = r"(?i)^(ph |adjust ph|©|distilled water)"
LINE_AMOUNT = r"([0-9]+(?:\.[0-9]+)?)\s*(g|mg|ml|mM|M|%)"
REFERENCE = r"(?i)medium\s+(\d+)"
ADDED = [rf"(?i){verb}\s+([0-9]+(?:\.[0-9]+)?%?)\s+([a-zA-Z\s]+)" for verb in ("add", r"supplemented\s+with", "plus")]
#: Phrases of prose, with the groups of name, amount and unit.
PROSE = [
    (r"(?i)supplemented\s+with\s+([0-9]+(?:\.[0-9]+)?)\s*(g|mg|ml)/l\s+(?:of\s+)?([^,\.;]+?)(?:\s+and|\.|,|$)", 3, 1, 2),
    (r"(?i)contains\s+([0-9]+(?:\.[0-9]+)?)\s*(g|mg|ml)\s+([^,\.;]+?)\s+per\s+(?:liter|litre)", 3, 1, 2),
    (r"(?i)([A-Z][^,\.;]*?)\s+([0-9]+(?:\.[0-9]+)?)\s*(g|mg|ml)/L", 1, 2, 3),
    (r"(?i)([A-Z][^,\.;]*?)\s+is\s+added\s+at\s+([0-9]+(?:\.[0-9]+)?)\s*(g|mg|ml)/l", 1, 2, 3),
    (r"(?i)([A-Za-z][^,\.;]*?)\s+([0-9]+(?:\.[0-9]+)?)\s*(g|mg|ml)(?:\s*,|\s+and|\s*$)", 1, 2, 3),
]
GENERIC = r"(?i)([A-Z][a-zA-Z0-9·\-\(\)]+(?:\s+[a-zA-Z0-9·\-\(\)]+)*)\s+([0-9]+(?:\.[0-9]+)?)\s*(g/L|g|mg/L|mg|mM|μM|M)\b"


def likely_chemical(name: Column) -> Column:
    """Whether a line or phrase may name an ingredient."""
    any_of = lambda words: "(?i)" + "|".join(map(re.escape, words))
    shaped = name.rlike(any_of(INDICATORS)) | name.rlike(r"[A-Z][a-z]*[0-9]|^[A-Z][a-z]?[0-9]?[A-Z]|^\p{Lu}(?=.{3}).*\p{Lu}")
    return F.length(name).between(2, 100) & ~name.rlike(any_of(NO_INGREDIENT)) & shaped


def _lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\n"), lambda x: F.trim(F.regexp_replace(x, r"^\s+|\s+$", ""))), lambda x: x != "")


def _first(xs: Column, true, after: Column | int = 0) -> Column:
    """Place (from 1) of the first item beyond ``after`` that is so; 0 if none is."""
    hits = F.filter(F.transform(xs, lambda x, i: F.when(true(x) & (i + 1 > after), i + 1)), lambda i: i.isNotNull())
    return F.coalesce(F.get(hits, 0), F.lit(0))


def _after(xs: Column, place: Column) -> Column:
    """Items from a place on; none for 0. The place is found once."""
    return bound(place, lambda p: F.slice(xs, F.greatest(p, F.lit(1)), F.when(p > 0, F.size(xs)).otherwise(0)))


def _until(xs: Column, true) -> Column:
    """Items before the first that is so."""
    return bound(xs, lambda ys: bound(_first(ys, true), lambda at: F.when(at > 0, F.slice(ys, 1, at - 1)).otherwise(ys)))


def _zipped(names: Column, amounts: Column, units: Column, method: str) -> Column:
    """Ingredients of names and amounts by place, as far as both go; where units end it is g."""
    n = F.least(F.size(names), F.size(amounts))
    rows = F.transform(F.slice(names, 1, n), lambda x, i: F.struct(x.alias("name"), F.get(amounts, i).alias("concentration"), F.coalesce(F.get(units, i), F.lit("g")).alias("unit"), F.lit(method).alias("extraction_method")))
    return F.filter(rows, lambda r: r["concentration"].isNotNull())


def _is_unit(line: Column) -> Column:
    return F.lower(line).isin(UNIT_LINES)


def _is_name(line: Column) -> Column:
    return likely_chemical(line) & ~line.rlike(r"^[0-9]") & ~_is_unit(line)


def tabular(text: Column) -> Column:
    """A block of names, then one of amounts, then one of units."""
    listed = lambda x: ~(F.lower(x).endswith("medium") | F.startswith(x, F.lit("©")) | F.lower(x).contains("adjust"))
    stops = lambda x: F.startswith(x, F.lit("©")) | F.lower(x).contains("adjust")
    number = lambda x: x.rlike(r"^[0-9]+(\.[0-9]*)?$")

    def paired(names: Column, rest: Column) -> Column:
        """rest: the lines from the first amount on."""
        numbers = lambda r: F.transform(_until(r, lambda x: ~number(x)), lambda x: x.cast("double"))
        units = lambda r, n: F.transform(F.filter(_until(F.slice(r, F.size(n) + 1, F.size(r)), stops), _is_unit), F.lower)
        return bound(rest, lambda r: bound(numbers(r), lambda n: bound(units(r, n), lambda u: _zipped(names, n, u, "tabular"))))

    def of_block(lines: Column, start: Column, block: Column) -> Column:
        amounts = _after(lines, _first(lines, lambda x: x.rlike(r"^[0-9]"), start + F.size(block) - 1))
        return bound(F.filter(block, _is_name), lambda names: paired(names, amounts))

    def found(lines: Column) -> Column:
        block = lambda start: _until(_after(lines, start), lambda x: listed(x) & x.rlike(r"^[0-9]"))
        return bound(_first(lines, lambda x: listed(x) & _is_name(x)), lambda start: bound(block(start), lambda b: of_block(lines, start, b)))

    return bound(_lines(text), found)


def reverse_tabular(text: Column) -> Column:
    """A block of decimal amounts (or such as ``20 mM``), then units, then names."""
    own_unit = r"^([0-9]+)\s+(mM|M|%)"
    ends = lambda x: F.lower(x).endswith("medium") | F.lower(x).contains("adjust")

    def paired(lines: Column, stop: Column, first: Column) -> Column:
        before = F.when(stop > 0, F.slice(lines, 1, stop - 1)).otherwise(lines)
        amounts = F.filter(F.transform(before, lambda x: F.when(x.rlike(r"^[0-9]+\.[0-9]+$"), x.cast("double")).when(x.rlike(own_unit), F.regexp_extract(x, own_unit, 1).cast("double"))), lambda x: x.isNotNull())
        own = F.transform(F.filter(before, lambda x: x.rlike(own_unit)), lambda x: F.regexp_extract(x, own_unit, 2))
        between = F.when((stop > 0) & (first > stop), F.slice(lines, F.greatest(stop, F.lit(1)), first - stop)).otherwise(F.slice(lines, 1, 0))
        units = F.concat(own, F.transform(F.filter(between, _is_unit), F.lower))
        names = F.filter(_until(_after(lines, first), ends), _is_name)
        return bound(F.struct(names.alias("x"), amounts.alias("n"), units.alias("u")), lambda s: _zipped(s["x"], s["n"], s["u"], "reverse_tabular"))

    def found(lines: Column) -> Column:
        stop = _first(lines, lambda x: F.lower(x).isin("g", "mg", "ml", "l") | _is_name(x))
        return bound(stop, lambda at: bound(_first(lines, _is_name), lambda first: paired(lines, at, first)))

    return bound(F.filter(_lines(text), lambda x: ~F.startswith(x, F.lit("©")) & ~F.lower(x).contains("reserved")), found)


def three_columns(text: Column) -> Column:
    """Names, then bare numbers, then units, anywhere in the text, paired by place."""

    name = lambda x: likely_chemical(x) & ~x.rlike(r"^[\d.\s]+$") & ~_is_unit(x)
    number = lambda x: x.rlike(r"^[\d.]+$")
    text_of = lambda rows: F.transform(rows, lambda r: r["x"])

    def paired(names: Column, rest: Column) -> Column:
        amounts = F.filter(F.transform(F.filter(rest, number), lambda x: x.try_cast("double")), lambda x: x.isNotNull())
        units = F.transform(F.filter(_after(rest, _first(rest, number)), _is_unit), lambda x: F.lower(x))
        return bound(F.struct(names.alias("x"), amounts.alias("n"), units.alias("u")), lambda s: _zipped(s["x"], s["n"], s["u"], "three_columns"))

    def found(lines: Column) -> Column:
        # Whether a line is a name is asked once for each line.
        marked = F.transform(lines, lambda x: F.struct(x.alias("x"), name(x).alias("named")))
        return bound(marked, lambda rows: bound(text_of(_after(rows, _first(rows, lambda r: r["named"]))), lambda rest: paired(text_of(F.filter(rows, lambda r: r["named"])), rest)))

    skipped = ["medium", "©", "adjust", "sterilize", "autoclave"]
    return bound(F.filter(_lines(text), lambda x: ~x.rlike("(?i)" + "|".join(skipped))), found)


def solutions(text: Column) -> Column:
    """Ingredients under the head lines of solutions (``Trace solution:``), with that head as solution; 1 g where a line tells no amount."""

    def found(lines: Column) -> Column:
        head = lambda x: x.rlike(SOLUTION_HEAD) & x.contains(":")
        heads = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda r: head(r["x"]))

        def below(hs: Column) -> Column:
            above = lambda i: bound(F.filter(hs, lambda h: h["i"] < i), lambda a: F.get(a, F.size(a) - 1)["x"])
            placed = F.transform(lines, lambda x, i: F.struct(x.alias("x"), above(i).alias("solution")))
            own = F.filter(placed, lambda r: r["solution"].isNotNull() & ~head(r["x"]) & ~r["x"].rlike(SOLUTION_SKIP) & likely_chemical(r["x"]))
            told = lambda r: r["x"].rlike(LINE_AMOUNT)
            part = lambda r, g: F.regexp_extract(r["x"], LINE_AMOUNT, g)
            name = lambda r: F.when(told(r), F.trim(F.regexp_replace(r["x"], r"\s*\([0-9]+(?:\.[0-9]+)?\s*[a-zA-Z%]+\)", ""))).otherwise(r["x"])
            return F.transform(own, lambda r: F.struct(name(r).alias("name"), F.when(told(r), part(r, 1).cast("double")).otherwise(1.0).alias("concentration"), F.when(told(r), part(r, 2)).otherwise("g").alias("unit"), F.lit("solutions").alias("extraction_method"), r["solution"].alias("solution")))

        return bound(heads, below)

    return bound(_lines(text), found)


def reference(text: Column) -> Column:
    """The medium that a text refers to, as one ingredient, and what it says is added; empty without a reference."""
    number = F.regexp_extract(text, REFERENCE, 1)
    item = F.struct(F.concat(F.lit("Reference to Medium "), number).alias("name"), F.lit(1.0).alias("concentration"), F.lit("reference").alias("unit"), F.lit("reference").alias("extraction_method"))
    return F.when(text.rlike(REFERENCE), F.concat(F.array(item), additions(text))).otherwise(F.slice(F.array(item), 1, 0))


def additions(text: Column) -> Column:
    """Ingredients that are added, supplemented or given plus: amounts in percent, or else in g."""
    part = lambda p, g: F.regexp_extract_all(F.lower(text), F.lit(p), g)
    pairs = F.concat(*[F.arrays_zip(part(p, 1).alias("a"), part(p, 2).alias("n")) for p in ADDED])
    kept = F.filter(pairs, lambda r: likely_chemical(F.trim(r["n"])))
    return F.transform(kept, lambda r: F.struct(F.initcap(F.trim(r["n"])).alias("name"), F.replace(r["a"], F.lit("%"), F.lit("")).cast("double").alias("concentration"), F.when(r["a"].contains("%"), "%").otherwise("g").alias("unit"), F.lit("addition").alias("extraction_method")))


def unrepeated(rows: Column, key=lambda r: r["name"]) -> Column:
    """Rows without those whose key an earlier one has."""
    return bound(rows, lambda rs: F.filter(rs, lambda r, i: F.array_position(F.transform(rs, key), key(r)) == i + 1))


def _phrases(text: Column, pattern: str, n: int, a: int, u: int, unit, method: str) -> Column:
    part = lambda g: F.regexp_extract_all(text, F.lit(pattern), g)
    rows = F.arrays_zip(part(n).alias("n"), part(a).alias("a"), part(u).alias("u"))
    name = lambda r: F.regexp_replace(F.trim(F.regexp_replace(r["n"], r"\s+", " ")), r"[.,;:]+$", "")
    return F.transform(rows, lambda r: F.struct(name(r).alias("name"), r["a"].cast("double").alias("concentration"), unit(r["u"]).alias("unit"), F.lit(method).alias("extraction_method")))


def prose(text: Column) -> Column:
    """Names with amounts within sentences, as amounts in a litre; of a name the first phrase counts."""
    found = F.concat(*[_phrases(text, *p, lambda u: F.concat(u, F.lit("/L")), "prose") for p in PROSE])
    return unrepeated(F.filter(found, lambda r: likely_chemical(r["name"]) & ~r["name"].rlike(r"(?i)\bis added at$")))


def generic(text: Column) -> Column:
    """Any capitalised words before a number and a unit; of a name the first."""
    return unrepeated(F.filter(_phrases(text, GENERIC, 1, 2, 3, lambda u: u, "generic"), lambda r: likely_chemical(r["name"])))


def first_found(found: list[Column], empty: Column) -> Column:
    """The first of the arrays that holds anything."""
    return F.coalesce(*[F.when(F.size(x) > 0, x) for x in found], empty)
