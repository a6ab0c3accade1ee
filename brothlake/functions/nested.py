"""Arrays and maps to and from their text forms, and figures out of free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_list(text: Column, kind: str = "double") -> Column:
    """'2.15, 7.20' as an array; entries that are no numbers are left out, a null or blank text is an empty array."""
    parts = F.split(F.coalesce(text, F.lit("")), ",")
    return F.array_compact(F.transform(parts, lambda x: F.trim(x).try_cast(kind)))


def pair_map(text: Column) -> Column:
    """'Na+:1,Cl-:-1' as a map; entries without colon or number are left out, of repeated keys the last counts."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x).rlike(r"^[^:]+:\s*-?\d+$"))
    entries = F.transform(parts, lambda x: F.struct(F.trim(F.split_part(x, F.lit(":"), F.lit(1))).alias("key"), F.trim(F.split_part(x, F.lit(":"), F.lit(2))).cast("int").alias("value")))
    last = F.filter(entries, lambda e: F.size(F.filter(F.slice(entries, F.array_position(entries, e).cast("int") + 1, F.greatest(F.size(entries), F.lit(1))), lambda o: o["key"] == e["key"])) == 0)
    return F.map_from_entries(F.array_distinct(last))


def pka_text(values: Column) -> Column:
    return F.concat_ws(",", F.transform(values, lambda x: F.format_string("%.2f", x)))


def charges_text(values: Column) -> Column:
    text = F.concat_ws(",", F.transform(values, lambda x: x.cast("string")))
    return F.when(F.coalesce(F.size(values), F.lit(0)) <= 0, "0").otherwise(text)


def ions_text(values: Column) -> Column:
    return F.concat_ws(",", F.transform(F.map_entries(values), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))))


# Fixed values.

PKA_MENTION = r"pka?\s*[=:]?\s*([0-9]+\.?[0-9]*)"
SOLUBILITY_MENTIONS = [r"([0-9]+\.?[0-9]*)\s*g\s*/\s*l", r"([0-9]+\.?[0-9]*)\s*mg\s*/\s*ml"]


def synonyms(text: Column) -> Column:
    """'a|b||c' as an array of trimmed, non-empty names."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != "")


def pka_mentions(text: Column) -> Column:
    """All pKa values between 0 and 14 that a text mentions, in order."""
    found = F.regexp_extract_all(F.lower(text), F.lit(PKA_MENTION), 1)
    return F.filter(F.transform(found, lambda x: x.cast("double")), lambda x: x.between(0, 14))


def solubility_mention(text: Column) -> Column:
    """The first solubility in g/l, else in mg/ml, that a text mentions; they are the same number."""
    lowered = F.lower(text)
    return F.coalesce(*[F.nullif(F.regexp_extract(lowered, p, 1), F.lit("")) for p in SOLUBILITY_MENTIONS]).cast("double")
