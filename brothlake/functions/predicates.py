"""Predicates on ingredient names. They are never null: a null name fails."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.

WATERS = ["distilled water", "water"]

#: A name that holds one of these is a mixture or biological material.
BIOLOGICAL = [
    "extract", "broth", "blood", "seawater", "sea water", "agar base", "medium", "peptone", "trypticase", "casein", "amino acids", "sludge",
    "beef", "horse", "sheep", "columbia", "brain heart", "pplo", "rcm",
]

#: Text of a procedure, not a compound.
PROCEDURE = [
    r"(?i)\b(ml|ml/10|room|temperature|hour|times|washed|three|distilled|water)\b",
    r"(?i)\b(Agar|Difco|EDTAFeNa|EDTANa2)\b",
    r"(?i)^\(\d+\).*\d+(\.\d+)?\s*g\b",
    r"(?i)^\(\d+\).*ml\b",
    r"(?i)and\s+\d+M",
    r"(?i)thiosulphate",
    r"(?i)glycerophosphate",
    r"(?i)sodium\s+thiosulphate",
    r"(?i)glucose.*ml",
    r"^\(\d{4}\)",
    r"^\(\d+\).*[,\.]",
]

PROCEDURE_WORDS = ["distilled", "washed", "room", "temperature", "hour", "times", "three", "Difco", "Agar"]

COMPOUND_SHAPES = [
    r"^[A-Z][a-z]?[A-Z0-9]",
    r"^[A-Z][a-z]*\s",
    r"[A-Z][a-z]?[0-9]",
    r"(Cl|SO4|PO4|NO3|CO3|HCO3|acetate|citrate|phosphate|sulfate|chloride|nitrate)",
]

NOT_DOWNLOADED = ["extract", "peptone", "mixture", "medium", "agar", "broth"]


def sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def any_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, columns)


def is_water(name: Column) -> Column:
    return sure(F.lower(F.trim(name)).isin(WATERS))


def is_ingredient(name: Column) -> Column:
    """Not null, not blank and not water."""
    return sure(F.length(F.trim(name)) > 0) & ~is_water(name)


def is_biological(name: Column) -> Column:
    return sure(any_of([F.lower(name).contains(w) for w in BIOLOGICAL]))


def is_compound(name: Column) -> Column:
    """A clean compound name: no procedure text, and a compound's shape or at least five characters."""
    c = F.trim(name)
    procedure = any_of([c.rlike(p) for p in PROCEDURE] + [c.contains(w) for w in PROCEDURE_WORDS])
    return sure((F.length(c) >= 2) & ~procedure & (any_of([c.rlike(p) for p in COMPOUND_SHAPES]) | (F.length(c) >= 5)))


def is_download_candidate(name: Column) -> Column:
    return sure((F.length(F.trim(name)) > 2) & ~any_of([F.lower(name).contains(w) for w in NOT_DOWNLOADED]))


def is_hydrated(name: Column) -> Column:
    return sure(name.rlike("(?i)H2O|hydrate"))


def is_suspect_hydrate(original: Column, mapped: Column) -> Column:
    """A hydrate mapped to an ingredient id instead of a compound."""
    return is_hydrated(original) & sure(mapped.startswith("ingredient:"))


def is_confident(confidence: Column, status: Column) -> Column:
    """High or very high, or mapped from the start; never if unmapped. Nulls are not confident."""
    return (sure(confidence.isin("high", "very_high")) | sure(status == "original_only")) & sure(status != "unmapped")


def entity_class(curie: Column) -> Column:
    prefix = F.split_part(curie, F.lit(":"), F.lit(1))
    return F.when(F.coalesce(F.trim(curie), F.lit("")) == "", "unmapped").when(prefix.isin("CHEBI", "PubChem", "CAS-RN", "solution", "ingredient", "medium"), prefix).otherwise("other")
