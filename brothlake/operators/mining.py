"""All ingredients that a recipe's text mentions, in any of five ways, with or without amounts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.chains import Chain, bound, replaced
from ..functions.sections import cut, lines_in, place_of, stated, text_lines, unrepeated

# Fixed values.

#: A compound's name: without numbering, brand and dash; hydrates as a word.
CLEAN_CHAIN: Chain = [(r"^\d+\.\s*", ""), (r"\s*\([^)]*\)\s*$", ""), (r"^\s*-\s*", ""), (r"\s*x\s*(\d+)\s*H2O", r" \1-hydrate"), (r"\s*\.\s*(\d+)\s*H2O", r" \1-hydrate"), (r"\s+", " ")]
NO_COMPOUND = [
    "page", "tel", "fax", "email", "www", "copyright", "dsmz", "approved", "reviewed", "created", "revision", "autoclave", "sterilize", "dissolve",
    "final", "volume", "adjust", "prepare", "add", "mix", "solution a", "solution b", "solution c", "solution d", "solution e",
]
KNOWN = [
    "nacl", "kcl", "cacl2", "mgcl2", "mgso4", "k2hpo4", "kh2po4", "nh4cl", "na2co3", "nahco3", "glucose", "sucrose", "lactose", "fructose", "mannitol", "yeast extract", "beef extract", "peptone", "tryptone", "casein", "agar",
    "biotin", "thiamine", "hepes", "tris", "edta", "resazurin", "cysteine", "sodium chloride", "potassium chloride", "calcium chloride", "magnesium chloride", "magnesium sulfate", "sodium carbonate", "sodium bicarbonate",
]
ENDINGS = ["chloride", "sulfate", "phosphate", "nitrate", "carbonate", "acetate", "citrate", "extract", "peptone", "acid", "ose"]
SECTION, SECTION_END = r"(?i)composition|ingredients|components|medium", r"(?i)^\d+\.\s|dissolve|autoclave|adjust ph"
AMOUNT = r"(?<!\d)(\d++(?:\.\d++)?+)\s*(g/l|g\s*l-1|mg/l|ml/l|mM|μM|uM|M(?!\w)|g|mg|ml)"
#: Units as they are written out.
UNITS = {"g/l": "g/L", "gl-1": "g/L", "mg/l": "mg/L", "ml/l": "ml/L", "mm": "mM", "μm": "μM", "um": "μM", "m": "M", "g": "g", "mg": "mg", "ml": "ml"}
PROCEDURE = [rf"(?i){verb}\s+(\d+\.?\d*)\s*([a-zA-Z/]+)\s+([^.]+?)(?:\.|,|;)" for verb in ("add", r"supplement.*?with", "dissolve")] + [r"(?i)(\d+\.?\d*)\s*([a-zA-Z/]+)\s+([^.]+?)\s+(?:added|dissolved|supplemented)"]
#: What a text holds, in some case, if the pattern of the same place in PROCEDURE fits.
VERBS = ["add", "supplement", "dissolve"]
SOLUTION = [r"(?i)solution\s+[A-Z]:\s*([^.]+)", r"(?i)stock\s+solution\s*\d*:\s*([^.]+)", r"(?i)(?:\G|\.)([^.]+)\s+solution\s+\((?:[^)]+)\)"]
#: How a compound may be named, in the order in which it is looked for: formulas, names by their endings, names with a brand, names before an amount.
COMPOUND = [
    r"\b([A-Z][a-z]?(?:(?:\d*[A-Z][a-z]?)+\d*)?(?:\([A-Z][a-z]?\d*\)\d*)*(?:\s*x?\s*\d*\s*H2O)?)\b",
    r"\b([A-Z][a-z]+(?:\s+[a-z]+)*(?:\s+(?:chloride|sulfate|phosphate|nitrate|carbonate|bicarbonate|acetate|citrate|hydroxide|oxide|extract|peptone|acid)))\b",
    r"\b([A-Z][a-z]+(?:\s+[a-z]+)*\s*\([^)]+\))\b",
    r"\b([A-Z][a-z]+(?:\s+[a-z]+){0,2})\s+(?=\d+\.?\d*\s*(?:g|mg|ml|mM|μM|M))",
]
#: Of a block of names, amounts and units: lines that end it or say nothing, its amounts and its units; other names that say nothing.
BLOCK_END, BLOCK_SKIPS = r"(?i)^\d+\.\s|dissolve|add", r"(?i)final ph|final volume|page|©"
BLOCK_NUMBER, FIRST_UNITS, BLOCK_UNITS = r"^\d+\.?\d*$", ["g", "mg", "ml", "mm", "μm", "um"], ["g", "mg", "ml", "mm", "μm", "um", "g/l", "mg/l", "ml/l"]
NO_NAME = r"(?i)page|copyright|tel:|fax:"

INGREDIENT = "array<struct<name:string,concentration:double,unit:string,strategy:string>>"


def cleaned(name: Column) -> Column:
    return F.trim(replaced(name, CLEAN_CHAIN))


def compound_like(text: Column) -> Column:
    """Whether a line or phrase looks like a compound's name."""
    any_of = lambda words: "(?i)" + "|".join(map(re.escape, words))
    unspelled = text.rlike(r"(?i)ph|h2o|co2") & (text.rlike(any_of(KNOWN)) | text.rlike("(?i)(" + "|".join(ENDINGS) + ")$") | text.rlike(r"^\p{L}{3,}$"))
    return (F.length(text) >= 2) & ~text.rlike(any_of(NO_COMPOUND)) & (text.rlike(r"^[A-Z]") | unspelled)


def _row(name: Column, amount: Column | None, unit: Column | None, strategy: str) -> Column:
    missing = lambda c, t: F.lit(None).cast(t) if c is None else c
    return F.struct(name.alias("name"), missing(amount, "double").alias("concentration"), missing(unit, "string").alias("unit"), F.lit(strategy).alias("strategy"))


def tabular(text: Column) -> Column:
    """A block of names, then of amounts, then of units, each on lines of their own and paired by place; without a unit it is g/L."""
    is_unit = lambda units: lambda x: F.lower(x).isin(units)
    number = lambda x: x.rlike(BLOCK_NUMBER)

    def paired(lines: Column, first: Column) -> Column:
        names, end = F.filter(cut(lines, F.lit(1), first), compound_like), F.size(lines) + 1
        rest = cut(lines, first, end)

        def of(block: Column) -> Column:
            stop = place_of(block, is_unit(FIRST_UNITS))
            amounts, units = F.filter(cut(block, F.lit(1), stop), number), F.filter(cut(block, stop, F.size(block) + 1), is_unit(BLOCK_UNITS))
            return bound(F.struct(names.alias("x"), amounts.alias("n"), units.alias("u")), zipped)

        return bound(rest, of)

    def zipped(s: Column) -> Column:
        unit = lambda i: F.get(s["u"], i)
        full = lambda i: F.when(F.lower(unit(i)).isin("g", "mg", "ml"), F.concat(unit(i), F.lit("/L"))).otherwise(F.coalesce(unit(i), F.lit("g/L")))
        rows = F.transform(F.slice(s["x"], 1, F.least(F.size(s["x"]), F.size(s["n"]))), lambda x, i: _row(cleaned(x), F.get(s["n"], i).cast("double"), full(i), "tabular"))
        return F.filter(rows, lambda r: r["concentration"] > 0)

    said = lambda lines: F.filter(cut(lines, F.lit(1), place_of(lines, lambda x: x.rlike(BLOCK_END))), lambda x: ~x.rlike(BLOCK_SKIPS))
    # Without an amount there is nothing to pair, so names are not looked for.
    block = lambda lines: bound(said(lines), lambda kept: bound(place_of(kept, number), lambda first: F.when(first <= F.size(kept), paired(kept, first)).otherwise(F.array()).cast(INGREDIENT)))
    return bound(F.filter(text_lines(text), lambda x: x != ""), block)


def _patterns(parity: bool) -> list[str]:
    """COMPOUND; with parity without regard to case, as published."""
    return [("(?i)" if parity else "") + p for p in COMPOUND]


def named_before(text: Column, parity: bool = False) -> Column:
    """The compound that the end of a text names: by the first pattern that fits there, else the last three, two or one words if they look like one.

    With parity by the last match, anywhere, of the first pattern whose last
    match looks like a compound.
    """
    if parity:
        last = [F.try_element_at(F.regexp_extract_all(text, F.lit(p), 1), F.lit(-1)) for p in _patterns(parity)]
    else:
        last = [F.regexp_extract(text, p + r"[\s:.,…-]*$", 1) for p in COMPOUND[:3]]
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    ends = lambda ws: [F.when(F.size(ws) >= n, F.array_join(F.slice(ws, -n, n), " ")) for n in (3, 2, 1)]
    # What comes later is looked for only where all before it has failed.
    like = lambda xs: F.coalesce(*[bound(x, lambda y: F.when(compound_like(y), y)) for x in xs])
    return bound(F.coalesce(like([F.trim(x) for x in last]), bound(words, lambda ws: like(ends(ws)))), cleaned)


def _amounts(line: Column, parity: bool) -> Column:
    """before, amount and unit of each amount of a line; before is what lies between it and the one before it, with parity all of the line up to it."""
    part = lambda g: F.regexp_extract_all(line, F.lit(r"(?i)\G(.*?)" + AMOUNT), g)

    def with_starts(rows: Column) -> Column:
        upto = lambda i: F.array_join(F.transform(F.slice(rows, 1, i), lambda r: r["all"]), "")
        return F.transform(rows, lambda r, i: F.struct((F.concat(upto(i), r["b"]) if parity else r["b"]).alias("before"), r["a"].cast("double").alias("amount"), r["u"].alias("unit")))

    whole = [part(0).alias("all")] if parity else []
    return bound(F.arrays_zip(*whole, part(1).alias("b"), part(2).alias("a"), part(3).alias("u")), with_starts)


def inline(text: Column, parity: bool = False) -> Column:
    """Names before an amount on their line."""
    units = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])
    unit = lambda r: F.element_at(units, F.lower(F.regexp_replace(r["unit"], r"\s", "")))
    of_line = lambda line: F.transform(_amounts(line, parity), lambda r: _row(named_before(r["before"], parity), r["amount"], unit(r), "inline"))
    rows = F.flatten(F.transform(F.filter(text_lines(text), lambda x: x.rlike("(?i)" + AMOUNT)), of_line))
    return F.filter(rows, lambda r: (r["concentration"] > 0) & (r["name"] != ""))


def lists(text: Column, parity: bool = False) -> Column:
    """Names in the lines after one that heads a list, up to one that begins the procedure; a line with an amount is no bare name, but with parity."""
    lines = stated(text_lines(text), [(lambda x: x.rlike(SECTION), "list"), (lambda x: x.rlike(SECTION_END), "procedure")], "head")
    bare = F.filter(lines_in(lines, "list"), lambda x: compound_like(x) if parity else compound_like(x) & ~x.rlike("(?i)" + AMOUNT))
    return F.transform(F.filter(F.transform(bare, cleaned), lambda x: x != ""), lambda x: _row(x, None, None, "compound_list"))


def procedures(text: Column) -> Column:
    """Amounts and names that the procedure tells to add, supplement or dissolve."""

    def found(pattern: str) -> Column:
        part = lambda g: F.regexp_extract_all(text, F.lit(pattern), g)
        return F.transform(F.arrays_zip(part(1).alias("a"), part(2).alias("u"), part(3).alias("n")), lambda r: _row(cleaned(F.trim(r["n"])), r["a"].cast("double"), r["u"], "procedure")).cast(INGREDIENT)

    none = F.array().cast(INGREDIENT)
    told = [F.when(F.lower(text).contains(verb), found(p)).otherwise(none) for verb, p in zip(VERBS, PROCEDURE)]
    added = F.when(text.rlike(r"(?i)\s(?:added|dissolved|supplemented)"), found(PROCEDURE[3])).otherwise(none)
    return F.filter(F.concat(*told, added), lambda r: (r["name"] != "") & (r["concentration"] > 0))


def solutions(text: Column, parity: bool = False) -> Column:
    """Formulas and named compounds in what a text says of its solutions, without amounts."""
    told = F.when(F.lower(text).contains("solution"), F.concat(*[F.regexp_extract_all(text, F.lit(p), 1) for p in SOLUTION])).otherwise(F.array().cast("array<string>"))
    named = lambda x: F.concat(*[F.regexp_extract_all(F.trim(x), F.lit(p), 1) for p in _patterns(parity)])
    names = F.filter(F.transform(F.flatten(F.transform(told, named)), lambda x: F.trim(x)), compound_like)
    return F.transform(names, lambda x: _row(cleaned(x), None, None, "solution"))


def every_ingredient(text: Column, parity: bool = False) -> Column:
    """What each of the five ways finds, one way after the other, repeated names and all."""
    known = F.coalesce(text, F.lit(""))
    return F.concat(tabular(known), inline(known, parity), lists(known, parity), procedures(known), solutions(known, parity)).cast(INGREDIENT)


def all_ingredients(text: Column, parity: bool = False) -> Column:
    """name, concentration, unit and strategy of every ingredient that any way finds.

    Of equal names the first with an amount, else the first; 0 and unknown
    without one. A null text has none. With ``parity`` patterns have no regard
    to case and a list's lines with amounts are names too, as published.
    """
    own = lambda rows: unrepeated(rows, lambda r: F.lower(F.trim(r["name"])), lambda r: F.coalesce(r["concentration"] > 0, F.lit(False)))
    kept = F.filter(bound(every_ingredient(text, parity), own), lambda r: (F.length(r["name"]) >= 2) & ~r["name"].rlike(NO_NAME))
    return F.transform(kept, lambda r: F.struct(r["name"].alias("name"), F.coalesce(r["concentration"], F.lit(0.0)).alias("concentration"), F.coalesce(r["unit"], F.lit("unknown")).alias("unit"), r["strategy"].alias("strategy")))
