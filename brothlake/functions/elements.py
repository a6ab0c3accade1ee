"""Chemical elements that names and formulas tell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.

SYMBOLS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba La Ce Pr Nd "
    "Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U Np Pu Am Cm Bk Cf Es Fm"
).split()

#: Metals and other elements that recipes name in words.
NAMES = {
    "sodium": "Na", "potassium": "K", "calcium": "Ca", "magnesium": "Mg", "iron": "Fe", "ferric": "Fe", "ferrous": "Fe", "copper": "Cu", "cupric": "Cu", "zinc": "Zn", "manganese": "Mn", "cobalt": "Co",
    "nickel": "Ni", "aluminum": "Al", "aluminium": "Al", "lead": "Pb", "silver": "Ag", "chromium": "Cr", "molybdenum": "Mo", "tungsten": "W", "selenium": "Se", "sulfur": "S", "phosphorus": "P",
    "nitrogen": "N", "carbon": "C", "chlorine": "Cl", "bromine": "Br", "iodine": "I", "fluorine": "F", "boron": "B", "silicon": "Si", "vanadium": "V", "lithium": "Li", "strontium": "Sr", "barium": "Ba",
}

#: Elements that are in too many compounds to tell one from another.
COMMON = ["H", "O"]


def elements_in(text: Column) -> Column:
    """Sorted symbols of the elements that a name holds in words, or as symbols of formula-like tokens. Upper and lower case count."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    named = F.array_compact(F.array(*[F.when(lowered.rlike(rf"\b{n}"), F.lit(s)) for n, s in NAMES.items()]))
    formulas = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\b(?:\(?[A-Z][a-z]?\)?\d*)+(?![a-z])"), 0)
    symbols = F.flatten(F.transform(formulas, lambda f: F.regexp_extract_all(f, F.lit(r"[A-Z][a-z]?"), 0)))
    known = F.filter(symbols, lambda s: s.isin(SYMBOLS))
    return F.array_sort(F.array_distinct(F.concat(named, known)))


def element_mismatch(original: Column, label: Column, formula: Column) -> Column:
    """A struct of elements missing from and extra in a match, by its label and formula; common ones don't count."""
    common = F.array(*map(F.lit, COMMON))
    mine = F.array_except(elements_in(original), common)
    theirs = F.array_except(F.array_union(elements_in(label), elements_in(formula)), common)
    return F.struct(F.array_except(mine, theirs).alias("missing"), F.array_except(theirs, mine).alias("extra"))
