"""Ingredients out of recipe texts and HTML tables.

Layouts are read with Column expressions: blocks of lines and phrases (module
layouts), and lines that match a pattern. The first layout that finds anything
wins. Tables in HTML are read by a small parser in a pandas UDF, one document a
row.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.chains import bound
from ..functions.predicates import is_compound
from . import layouts

# Fixed values.

UNITS = r"(?:g/[lL]|mg/[lL]|ml/[lL]|µg/[lL]|mM|µM|g|mg|ml|µg|%|M)"
NUMBER = r"(\d+(?:[.,]\d+)?)"
NAME = r"([A-Za-z][A-Za-z0-9 ()\-·.,'+]*?)"

#: Layouts in order: pattern of a line or phrase, and the groups of name, amount and unit.
LAYOUTS = [
    ("dotted", rf"(?m)^\s*{NAME}\s*(?:\.{{3,}}|…+|\s{{3,}})\s*{NUMBER}\s*({UNITS})\b", 1, 2, 3),
    ("columnar", rf"(?m)^\s*{NAME}\s+{NUMBER}\s+({UNITS})\s*$", 1, 2, 3),
    ("parenthetical", rf"\b{NAME}\s*\(\s*{NUMBER}\s*({UNITS})\s*\)", 1, 2, 3),
    ("amount_first", rf"(?i)(?:add|dissolve|contains?|with|and)\s+{NUMBER}\s*({UNITS})\s+(?:of\s+)?{NAME}(?=[,.;\n]|\s+(?:in|to|and|per)\b|$)", 3, 1, 2),
]

#: A list of names, a line with "per litre", and the list of their amounts; lines that are neither, and those that end the amounts.
PER_LITRE = r"(?i)\bper\s+lit(?:re|er)\b"
LISTED_AMOUNT = rf"{NUMBER}\s*({UNITS}|mL|l|L)(?![A-Za-z])"
NOT_LISTED = r"(?i)©|adjust|sterili[sz]e|preparation|ccap|tel:|fax:|email:|web:|^SNA.*Seawater|^.?$"
LIST_END = r"(?i)make up|steam|autoclave"

MOST_INGREDIENTS = 50
REFERENCE = r"(?i)\bmedium\s+(?:no\.?\s*)?(\d+[a-z]?)\b"
ADDITION = rf"(?i)(?:add|supplemented with|plus)\s+{NUMBER}\s*%\s+([A-Za-z][A-Za-z \-]*)"
TITLE = [r"(?im)^\s*\d+[a-z]?\.\s*([A-Z][^\n]{3,80})$", r"(?im)^\s*(?:medium|name)\s*:\s*([^\n]+)$", r"(?m)^\s*([A-Z][A-Z0-9 \-]{3,60}MEDIUM)\s*$"]
PREPARATION = r"(?is)\b(?:preparation|instructions|procedure|method)\s*:?\s*(.+)"
MOST_PREPARATION = 500

INGREDIENT = "array<struct<name:string,concentration:double,unit:string,extraction_method:string>>"


def _most(rows: Column, parity: bool) -> Column:
    return F.slice(rows, 1, MOST_INGREDIENTS) if parity else rows


def layout(text: Column, name: str, parity: bool = False) -> Column:
    """The ingredients with a compound's name that one layout finds in a text, in order; with ``parity`` the first MOST_INGREDIENTS."""
    _, pattern, n, a, u = next(x for x in LAYOUTS if x[0] == name)
    part = lambda g: F.regexp_extract_all(text, F.lit(pattern), g)
    rows = F.transform(F.arrays_zip(part(n).alias("n"), part(a).alias("a"), part(u).alias("u")), lambda r: F.struct(F.trim(r["n"]).alias("name"), F.regexp_replace(r["a"], ",", ".").cast("double").alias("concentration"), r["u"].alias("unit"), F.lit(name).alias("extraction_method")))
    return _most(F.filter(rows, lambda r: is_compound(r["name"]) & ~r["name"].rlike(PER_LITRE)), parity)


def listed(text: Column, parity: bool = False) -> Column:
    """The names before the first line with "per litre", each with the amount at its place after it, as far as both go."""
    lines = F.transform(F.split(F.replace(text, F.lit("\u00a0"), F.lit(" ")), r"\n"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))
    first = lambda xs, true: F.array_position(F.transform(xs, true), F.lit(True)).cast("int")
    part = lambda r, g: F.regexp_extract(r["a"], LISTED_AMOUNT, g)

    def paired(named: Column, amounts: Column) -> Column:
        pairs = F.slice(F.arrays_zip(named.alias("n"), amounts.alias("a")), 1, F.least(F.size(named), F.size(amounts)))
        return F.transform(pairs, lambda r: F.struct(r["n"].alias("name"), F.regexp_replace(part(r, 1), ",", ".").cast("double").alias("concentration"), part(r, 2).alias("unit"), F.lit("list").alias("extraction_method")))

    def found(lines: Column, at: Column) -> Column:
        named = F.filter(F.slice(lines, 1, F.greatest(at - 1, F.lit(0))), lambda x: (F.length(x) > 3) & (F.lower(x) != "medium") & ~x.rlike(r"^\d"))
        rest = F.slice(lines, at + 1, F.size(lines))
        end = lambda xs: first(xs, lambda x: x.rlike(LIST_END) & ~x.rlike(LISTED_AMOUNT))
        own = bound(rest, lambda xs: bound(end(xs), lambda e: F.slice(xs, 1, F.when(e > 0, e - 1).otherwise(F.size(xs)))))
        amounts = F.filter(own, lambda x: x.rlike(LISTED_AMOUNT) & ~x.rlike(PER_LITRE))
        return bound(F.struct(named.alias("n"), amounts.alias("a")), lambda s: paired(s["n"], s["a"]))

    rows = bound(F.filter(lines, lambda x: ~x.rlike(NOT_LISTED)), lambda xs: bound(first(xs, lambda x: x.rlike(PER_LITRE)), lambda at: found(xs, at)))
    return _most(rows, parity)


def ingredients(text: Column, parity: bool = False) -> Column:
    """Those of the first layout that finds any; an empty array if none does or the text is null."""
    line = {name: layout(text, name, parity) for name, *_ in LAYOUTS}
    blocks = [layouts.tabular(text), layouts.reverse_tabular(text), F.transform(layouts.solutions(text), lambda r: r.dropFields("solution")), layouts.reference(text)]
    rest = [layouts.three_columns(text), listed(text, parity), layouts.prose(text)]
    found = [*blocks, line["dotted"], line["columnar"], line["parenthetical"], *rest, line["amount_first"], layouts.generic(text)]
    any_of = lambda xs: F.when(F.size(xs) > 0, _most(xs, parity).cast(INGREDIENT))
    return F.coalesce(*[bound(x, any_of) for x in found], F.array().cast(INGREDIENT))


def references(text: Column) -> Column:
    """Numbers of the media that a text refers to."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(REFERENCE), 1))


def additions(text: Column) -> Column:
    """Ingredients added in percent: name, concentration in g/l."""
    amount, name = (F.regexp_extract_all(text, F.lit(ADDITION), g) for g in (1, 2))
    return F.transform(F.arrays_zip(amount.alias("a"), name.alias("n")), lambda r: F.struct(F.trim(r["n"]).alias("name"), (F.regexp_replace(r["a"], ",", ".").cast("double") * 10).alias("concentration")))


def title(text: Column, default: Column) -> Column:
    return F.coalesce(*[F.nullif(F.trim(F.regexp_extract(text, p, 1)), F.lit("")) for p in TITLE], default)


def preparation(text: Column, parity: bool = False) -> Column:
    """What follows the heading of the instructions; with ``parity`` its first MOST_PREPARATION characters."""
    found = F.regexp_extract(text, PREPARATION, 1)
    return F.nullif(F.regexp_replace(F.substring(found, 1, MOST_PREPARATION) if parity else found, r"^\s+|\s+$", ""), F.lit(""))


def recipe_rows(docs: DataFrame, key: str, text: str = "text", parity: bool = False) -> DataFrame:
    """A row for each ingredient of each document: key, pos, name, concentration, unit, extraction_method."""
    return docs.select(key, F.posexplode(ingredients(F.col(text), parity)).alias("pos", "i")).select(key, "pos", "i.*")


def deduplicated(rows: DataFrame, key: str) -> DataFrame:
    """One row for each lower-cased name of a document: the first with an amount above 0, else the first."""
    from .matching import first_rows

    named = rows.withColumn("_name", F.lower(F.regexp_replace("name", r"\s+", "")))
    return first_rows(named, [key, "_name"], F.desc(F.coalesce(F.col("concentration"), F.lit(0.0)) > 0), F.asc("pos")).drop("_name")


class _Tables(HTMLParser):
    """Cells of all table rows, as lists of collapsed text; scripts and styles are left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows, self.row, self.cell, self.hidden = [], None, None, 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.hidden += 1
        elif tag == "tr":
            self.row = []
        elif tag in ("td", "th") and self.row is not None:
            self.cell = []

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        elif tag in ("td", "th") and self.cell is not None:
            self.row.append(" ".join("".join(self.cell).split()))
            self.cell = None
        elif tag == "tr" and self.row is not None:
            self.rows.append(self.row)
            self.row = None

    def handle_data(self, data):
        if self.cell is not None and not self.hidden:
            self.cell.append(data)


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def table_cells(pages: pd.Series) -> pd.Series:
    """Rows of cells of all tables of a page."""

    def read(page) -> list[list[str]]:
        parser = _Tables()
        parser.feed(page if isinstance(page, str) else "")
        return parser.rows

    return pages.map(read)


def table_ingredients(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """key, pos, name, concentration, unit of table rows whose second cell is an amount: two cells (amount with unit) or three (amount, unit)."""
    rows = pages.select(key, F.posexplode(table_cells(F.col(html))).alias("pos", "c")).where(F.size("c") >= 2)
    amount = F.regexp_extract(F.col("c")[1], r"(\d+(?:\.\d+)?)", 1).try_cast("double")
    unit = F.when(F.size("c") >= 3, F.trim(F.col("c")[2])).otherwise(F.trim(F.regexp_extract(F.col("c")[1], r"\d+(?:\.\d+)?\s*(.*)$", 1)))
    return rows.where(amount.isNotNull() & (F.lower(F.col("c")[0]) != "distilled water")).select(key, "pos", F.col("c")[0].alias("name"), amount.alias("concentration"), unit.alias("unit"))
