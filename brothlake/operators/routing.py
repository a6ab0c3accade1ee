"""Lines of a recipe's text routed to ingredients or instructions, and what the lines of ingredients hold.

A line that begins the procedure, or a note, ends the ingredients. Before it a
line that looks like an ingredient opens a table, in which bare amounts and
units are ingredients too, and a line with the final pH or volume closes it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.chains import bound, replaced
from ..functions.sections import cut, place_of, stated, text_lines, unrepeated
from .mining import BLOCK_NUMBER, CLEAN_CHAIN

# Fixed values.

NO_LINE = r"(?i)©|page|dsmz - all rights reserved"
PROCEDURE_START = r"(?i)^\d+\.\s+(?:Dissolve|Add|Mix|Adjust|Autoclave|Sterilize|Prepare)|^note:|^reference:"
TITLE = r"(?i)^\d+[a-z]*\.\s+[A-Z][A-Z\s]+MEDIUM"
FINAL = r"(?i)final ph|final volume"
PROCEDURE_WORDS = [
    "dissolve", "add", "mix", "adjust", "autoclave", "sterilize", "filter", "prepare", "supplement", "replace", "omit", "incubate", "inoculate", "pressurize", "sparge", "distribute", "dispense", "cool", "heat",
    "bring to", "make up to", "final ph", "final volume", "upon autoclaving", "after inoculation", "for dsm", "note:", "reference:", "supplier:",
]
PURE = [
    "nacl", "kcl", "cacl2", "mgcl2", "mgso4", "k2hpo4", "kh2po4", "nh4cl", "na2co3", "nahco3", "na2so4", "caso4", "feso4", "znso4", "cuso4", "glucose", "sucrose", "lactose", "fructose", "mannitol", "glycerol",
    "yeast extract", "beef extract", "peptone", "tryptone", "casein", "agar", "biotin", "thiamine", "hepes", "tris", "edta", "resazurin", "cysteine",
]
PURE_ENDINGS = ["chloride", "sulfate", "phosphate", "nitrate", "carbonate", "acetate", "citrate", "extract", "peptone", "acid", "agar", "solution"]
INGREDIENT_WORDS = ["chloride", "sulfate", "phosphate", "extract", "peptone", "solution", "acid"]
NOT_PURE = ["page", "tel", "fax", "copyright", "approved", "reviewed", "final"]
PURE_FORMULA = r"^[A-Z][a-z]?(?:(?:\d*[A-Z][a-z]?)+\d*)?(?:\s*x?\s*\d*\s*H2O)?$"
TABLE_UNITS = ["g", "mg", "ml", "mm", "μm"]
LINE_AMOUNT = r"(?<!\d)(\d++(?:\.\d++)?+)\s*(g/l\b|g\s*l-1\b|mg/l\b|ml/l\b|mM\b|μM|uM\b|M\b)"
LINE_UNITS = {"g/l": "g/L", "gl-1": "g/L", "mg/l": "mg/L", "ml/l": "ml/L", "mm": "mM", "μm": "μM", "um": "μM", "m": "M"}

# End of fixed values.

INGREDIENT = "array<struct<name:string,concentration:double,unit:string,extraction_method:string>>"


def _any_of(words: list[str]) -> str:
    return "(?i)" + "|".join(map(re.escape, words))


def ingredient_line(line: Column) -> Column:
    """Whether a line names an ingredient and is no instruction."""
    return ~line.rlike(_any_of(PROCEDURE_WORDS)) & (line.rlike(r"^[A-Z]") | line.rlike(_any_of(PURE)) | line.rlike(_any_of(INGREDIENT_WORDS)))


def pure_name(text: Column) -> Column:
    """Whether a text is a compound's name and nothing else."""
    said = ~text.rlike(_any_of(PROCEDURE_WORDS)) & ~text.rlike(_any_of(NOT_PURE))
    return (F.length(text) >= 2) & said & (text.rlike(_any_of(PURE)) | text.rlike(PURE_FORMULA) | text.rlike("(?i)(" + "|".join(PURE_ENDINGS) + ")$"))


def embedded(title: Column) -> Column:
    """Names of compounds in a title line after the name of its medium: runs of capitalised words, up to a pH or a number."""
    words = F.split(F.trim(F.regexp_replace(title, TITLE + r"[^a-z]*", "")), r"\s+")
    said = cut(words, F.lit(1), place_of(words, lambda w: w.rlike(r"(?i)^(ph|adjust)$") | w.rlike(BLOCK_NUMBER)))
    part = lambda w: w.rlike(r"^[A-Z][A-Za-z\-]{2,}$") & ~w.rlike("(?i)medium|broth|agar")
    runs = F.split(F.array_join(F.transform(said, lambda w: F.when(part(w), w).otherwise("\n")), " "), r"\s*\n\s*")
    return F.filter(F.transform(runs, lambda x: F.trim(x)), lambda x: (x != "") & pure_name(x))


def routed(text: Column) -> Column:
    """Struct of ingredients and instructions: the lines of each, in their order. A null text has none."""
    number, unit = lambda x: x.rlike(BLOCK_NUMBER), lambda x: F.lower(x).isin(TABLE_UNITS)
    title = lambda x: x.rlike(TITLE)

    def of(lines: Column, stop: Column) -> Column:
        rules = [(lambda x: ingredient_line(x) & ~title(x), "table"), (lambda x: x.rlike(FINAL) & ~title(x), "text")]
        before = stated(cut(lines, F.lit(1), stop), rules, "text")
        taken = lambda r: ~title(r["line"]) & (r["begins"] & (r["state"] == "table") | ~r["begins"] & (r["state"] == "table") & (number(r["line"]) | unit(r["line"])))
        named = lambda r: F.when(title(r["line"]), embedded(r["line"])).when(taken(r), F.array(r["line"])).otherwise(F.array().cast("array<string>"))
        told = lambda rows: F.transform(F.filter(rows, lambda r: ~taken(r)), lambda r: r["line"])
        rest = cut(lines, stop, F.size(lines) + 1)
        return bound(before, lambda rows: F.struct(F.flatten(F.transform(rows, named)).alias("ingredients"), F.concat(told(rows), rest).alias("instructions")))

    said = F.filter(text_lines(text), lambda x: (x != "") & ~x.rlike(NO_LINE))
    return bound(said, lambda lines: bound(place_of(lines, lambda x: x.rlike(PROCEDURE_START)), lambda stop: of(lines, stop)))


def _cleaned(name: Column) -> Column:
    return F.trim(replaced(name, [step for step in CLEAN_CHAIN if step[0] not in (r"^\d+\.\s*", r"^\s*-\s*")]))


def _row(name: Column, amount: Column, unit: Column, method: str) -> Column:
    return F.struct(name.alias("name"), amount.cast("double").alias("concentration"), unit.cast("string").alias("unit"), F.lit(method).alias("extraction_method"))


def table_rows(lines: Column) -> Column:
    """Names, then amounts, then units, each on lines of their own and paired by place; without a unit it is g/L."""
    number, unit = lambda x: x.rlike(BLOCK_NUMBER), lambda x: F.lower(x).isin([*TABLE_UNITS, "um"])

    def paired(first: Column) -> Column:
        names, rest = F.filter(cut(lines, F.lit(1), first), pure_name), cut(lines, first, F.size(lines) + 1)

        def of(block: Column) -> Column:
            stop = place_of(block, unit)
            parts = F.struct(names.alias("x"), F.filter(cut(block, F.lit(1), stop), number).alias("n"), F.transform(F.filter(cut(block, stop, F.size(block) + 1), unit), lambda x: F.lower(x)).alias("u"))
            return bound(parts, rows)

        return bound(rest, of)

    def rows(s: Column) -> Column:
        told = lambda i: F.get(s["u"], i)
        full = lambda i: F.when(told(i).isin("g", "mg", "ml"), F.concat(told(i), F.lit("/L"))).otherwise(F.coalesce(told(i), F.lit("g/L")))
        return F.transform(F.slice(s["x"], 1, F.least(F.size(s["x"]), F.size(s["n"]))), lambda x, i: _row(_cleaned(x), F.get(s["n"], i), full(i), "tabular"))

    return F.filter(bound(place_of(lines, number), paired), lambda r: r["concentration"] > 0)


def line_rows(lines: Column) -> Column:
    """The name before the first amount of a line, if it is a pure one, and each amount of the line that follows it."""
    units = F.create_map(*[F.lit(x) for pair in LINE_UNITS.items() for x in pair])

    def of_line(line: Column) -> Column:
        part = lambda g: F.regexp_extract_all(line, F.lit("(?i)" + LINE_AMOUNT), g)
        name = F.trim(F.regexp_replace(F.regexp_extract(line, "(?i)^(.*?)" + LINE_AMOUNT, 1), r"^\d+\.\s*|^-\s*|[\s:,.…-]+$", ""))
        rows = lambda n: F.transform(F.arrays_zip(part(1).alias("a"), part(2).alias("u")), lambda r: _row(n, r["a"], F.element_at(units, F.lower(F.regexp_replace(r["u"], r"\s", ""))), "inline"))
        return bound(F.when(pure_name(name), _cleaned(name)), lambda n: F.when(n.isNotNull(), rows(n)).otherwise(F.array().cast(INGREDIENT)))

    return F.filter(F.flatten(F.transform(F.filter(lines, lambda x: x.rlike(r"\d") & ~x.rlike(_any_of(PROCEDURE_WORDS))), of_line)), lambda r: r["concentration"] > 0)


def name_rows(lines: Column) -> Column:
    """Lines that are a pure name, without an amount."""
    bare = F.filter(lines, lambda x: pure_name(x) & ~x.rlike("(?i)" + LINE_AMOUNT))
    return F.transform(bare, lambda x: _row(_cleaned(x), F.lit(None), F.lit(None), "list"))


def routed_ingredients(text: Column) -> Column:
    """name, concentration, unit and extraction_method of the ingredients in the lines that routed() gives to them; of equal names the first with an amount, else the first."""

    def of(lines: Column) -> Column:
        every = F.concat(table_rows(lines).cast(INGREDIENT), line_rows(lines).cast(INGREDIENT), name_rows(lines).cast(INGREDIENT))
        return F.filter(unrepeated(every, lambda r: F.lower(r["name"]), lambda r: F.coalesce(r["concentration"] > 0, F.lit(False))), lambda r: F.length(r["name"]) >= 2)

    return bound(routed(text)["ingredients"], of)


def instructions(text: Column) -> Column:
    """The lines that routed() gives to instructions, as one line; empty without any."""
    return F.trim(F.regexp_replace(F.array_join(routed(text)["instructions"], " "), r"\s+", " "))
