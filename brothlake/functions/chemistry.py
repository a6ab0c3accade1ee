"""Formulas, ions, activity, and properties estimated from names, as Column functions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from .chains import bound, contains_any, contains_any_sql

# Fixed values.

DEBYE = 0.5115
DAVIES_SLOPE = 0.3
LEAST_IONIC_STRENGTH = 1e-7
CONDUCTIVITY, CONDUCTIVITY_POWER, NACL_CONDUCTIVITY = 0.013, 0.9, 0.0126

ATOMIC_WEIGHTS = {
    "H": 1.008, "C": 12.011, "N": 14.007, "O": 15.999, "F": 18.998, "Na": 22.990, "Mg": 24.305, "Al": 26.982, "Si": 28.085, "P": 30.974, "S": 32.06, "Cl": 35.45,
    "K": 39.098, "Ca": 40.078, "V": 50.942, "Cr": 51.996, "Mn": 54.938, "Fe": 55.845, "Co": 58.933, "Ni": 58.693, "Cu": 63.546, "Zn": 65.38, "As": 74.922, "Se": 78.971,
    "Br": 79.904, "Mo": 95.95, "I": 126.904, "W": 183.84, "B": 10.81, "Li": 6.94,
}

POLYATOMIC = [("SO4", "SO42-", -2), ("PO4", "PO43-", -3), ("HPO4", "HPO42-", -2), ("H2PO4", "H2PO4-", -1), ("CO3", "CO32-", -2), ("HCO3", "HCO3-", -1), ("NO3", "NO3-", -1)]
MONATOMIC = [
    ("Na", "Na+", 1), ("K", "K+", 1), ("Ca", "Ca2+", 2), ("Mg", "Mg2+", 2), ("Fe", "Fe2+", 2), ("Zn", "Zn2+", 2), ("Cu", "Cu2+", 2), ("Mn", "Mn2+", 2),
    ("Co", "Co2+", 2), ("Ni", "Ni2+", 2), ("Cl", "Cl-", -1), ("Br", "Br-", -1), ("I", "I-", -1),
]

METALS = ["Na", "K", "Ca", "Mg", "Fe", "Zn", "Cu", "Mn", "Co", "Ni"]
ANIONS = ["Cl", "Br", "I", "SO4", "PO4", "CO3", "NO3"]
SOLUBLE = ["sodium", "potassium", "chloride", "acetate", "glucose", "sucrose", "glycine", "alanine", "tris", "hepes"]
INSOLUBLE = ["carbonate", "phosphate", "sulfate", "hydroxide"]

#: Needles in a lower-cased name, and the pKa values that they bring.
NAME_PKA = [(["acid", "carboxylic"], [4.75]), (["amine", "amino"], [10.8]), (["phosphate"], [2.15, 7.20, 12.35]), (["acetate"], [4.76]), (["tris"], [8.07]), (["hepes"], [7.55])]
FORMULA_PKA = [(["PO4"], [2.15, 7.20, 12.35]), (["CO3"], [6.37, 10.33])]


class Estimate(NamedTuple):
    """A rule: names that hold one of ``any_of`` (and one of ``also``; and end in ``suffix``) have these properties."""

    any_of: list[str]
    also: list[str]
    suffix: str
    weight: float
    pka: list[float]
    charges: list[int]
    ions: dict[str, int]
    solubility: float
    activity: float


_SODIUM, _POTASSIUM, _CHLORIDE, _ORGANIC = ["na ", "sodium ", "na-", "na2-"], ["k ", "potassium ", "k-", "k2-"], ["chloride", "hcl", " cl "], ["acid", "ate"]

#: In order: the first rule that fits counts.
ESTIMATES = [
    Estimate(_SODIUM, ["na2-", "disodium"], "", 200.0, [4.0], [-2, -1, 0], {"Na+": 1, "Anion2-": -2}, 500.0, 0.9),
    Estimate(_SODIUM, [], "", 150.0, [4.5], [-1, 0], {"Na+": 1, "Anion-": -1}, 400.0, 0.9),
    Estimate(_POTASSIUM, ["k2-", "dipotassium"], "", 220.0, [4.0], [-2, -1, 0], {"K+": 1, "Anion2-": -2}, 450.0, 0.9),
    Estimate(_POTASSIUM, [], "", 170.0, [4.5], [-1, 0], {"K+": 1, "Anion-": -1}, 350.0, 0.9),
    Estimate(_CHLORIDE, ["mg", "magnesium"], "", 120.0, [], [0], {"Mg2+": 2, "Cl-": -1}, 600.0, 1.0),
    Estimate(_CHLORIDE, ["ca", "calcium"], "", 140.0, [], [0], {"Ca2+": 2, "Cl-": -1}, 700.0, 1.0),
    Estimate(_CHLORIDE, [], "", 100.0, [], [0], {"Cation+": 1, "Cl-": -1}, 300.0, 1.0),
    Estimate(["sulfate", "sulphate", "so4"], [], "", 180.0, [], [0], {"Cation2+": 2, "SO42-": -2}, 250.0, 1.0),
    Estimate(_ORGANIC, [], "ate", 160.0, [4.0], [-1, 0], {"Cation+": 1, "Anion-": -1}, 300.0, 0.85),
    Estimate(_ORGANIC, [], "", 140.0, [4.5], [-1, 0], {"H+": 1, "Anion-": -1}, 200.0, 0.8),
    Estimate(["extract", "peptone", "hydrolysate", "broth"], [], "", 180.0, [2.5, 9.0], [-1, 0, 1], {"COO-": -1, "NH3+": 1}, 250.0, 0.6),
]


def _fits(name: Column, rule: Estimate) -> Column:
    fits = contains_any(name, rule.any_of)
    if rule.also:
        fits = fits & contains_any(name, rule.also)
    return fits & name.endswith(rule.suffix) if rule.suffix else fits


def estimated_properties(name: Column) -> Column:
    """A struct of molecular_weight, pka_values, charge_states, ion_charges, solubility, activity of the first rule that fits; null if none does."""
    lowered = F.lower(F.trim(name))
    out = None
    for rule in ESTIMATES:
        value = F.struct(
            F.lit(rule.weight).alias("molecular_weight"),
            F.array(*map(F.lit, rule.pka)).cast("array<double>").alias("pka_values"),
            F.array(*map(F.lit, rule.charges)).cast("array<int>").alias("charge_states"),
            F.create_map(*[F.lit(x) for pair in rule.ions.items() for x in pair]).cast("map<string,int>").alias("ion_charges"),
            F.lit(rule.solubility).alias("solubility"),
            F.lit(rule.activity).alias("activity"),
        )
        out = F.when(_fits(lowered, rule), value) if out is None else out.when(_fits(lowered, rule), value)
    return out


def estimate_case_sql(name: str, value) -> str:
    """SQL CASE over the rules, with value(rule) as its results."""
    def fits(rule: Estimate) -> str:
        parts = [contains_any_sql(name, rule.any_of)] + [contains_any_sql(name, rule.also)] * bool(rule.also) + [f"ends_with({name}, '{rule.suffix}')"] * bool(rule.suffix)
        return " AND ".join(parts)

    return "CASE " + " ".join(f"WHEN {fits(r)} THEN {value(r)}" for r in ESTIMATES) + " END"


def davies_activity(charge: Column, ionic_strength: Column) -> Column:
    """Activity coefficient of an ion at 25 degrees; 1 without charge."""
    root = F.sqrt(ionic_strength)
    exponent = F.lit(-DEBYE) * charge * charge * (root / (1 + root) - DAVIES_SLOPE * ionic_strength)
    return F.when(charge == 0, F.lit(1.0)).otherwise(F.pow(F.lit(10.0), exponent))


def salinity_percent(ionic_strength: Column, dissolved: Column) -> Column:
    """NaCl equivalent in percent by mass, from ionic strength and grams dissolved in a litre."""
    return CONDUCTIVITY * F.pow(ionic_strength, F.lit(CONDUCTIVITY_POWER)) / NACL_CONDUCTIVITY / (1000 + dissolved) * 100


def alpha_fractions(h: Column, pka: Column) -> Column:
    """Fractions of the forms of a polyprotic acid, from fully protonated on; [1] without pKa values."""
    n = F.size(pka)
    terms = F.transform(F.sequence(F.lit(0), n), lambda i: F.aggregate(F.slice(pka, 1, i), F.pow(h, (n - i).cast("double")), lambda a, p: a * F.pow(F.lit(10.0), -p)))
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.when(n == 0, F.array(F.lit(1.0))).otherwise(F.transform(terms, lambda x: x / total))


def _elements(formula: Column, nesting: int) -> Column:
    """The elements of a formula as (e, n), in order, repeated ones more than once."""
    tokens = F.regexp_extract_all(_expanded(formula, nesting), F.lit(r"([A-Z][a-z]?)(\d*)"), 0)
    return F.transform(tokens, lambda t: F.struct(F.regexp_extract(t, "^[A-Za-z]+", 0).alias("e"), F.coalesce(F.regexp_extract(t, r"\d+$", 0).try_cast("long"), F.lit(1)).alias("n")))


def element_counts(formula: Column, nesting: int = 2) -> Column:
    """Map of elements to counts; groups in parentheses are multiplied, up to ``nesting`` deep."""

    def counted(pairs: Column) -> Column:
        of = lambda e: F.aggregate(F.filter(pairs, lambda p: p["e"] == e), F.lit(0).cast("long"), lambda a, p: a + p["n"])
        return bound(F.array_distinct(F.transform(pairs, lambda p: p["e"])), lambda elements: F.map_from_arrays(elements, F.transform(elements, of)))

    return bound(_elements(formula, nesting), counted)


def _expanded(formula: Column, nesting: int) -> Column:
    """The formula with its innermost groups written out, ``nesting`` times over."""
    c = F.coalesce(formula, F.lit(""))
    for _ in range(nesting):
        pieces = F.regexp_extract_all(c, F.lit(r"\([^()]*\)\d*|[^()]+|[()]"), 0)

        def written(p: Column) -> Column:
            times = F.coalesce(F.regexp_extract(p, r"\)(\d+)$", 1).try_cast("long"), F.lit(1).cast("long"))
            inner = F.regexp_extract_all(F.regexp_extract(p, r"^\(([^()]*)\)", 1), F.lit(r"[A-Z][a-z]?\d*"), 0)
            each = F.transform(inner, lambda t: F.concat(F.regexp_extract(t, "^[A-Za-z]+", 0), (F.coalesce(F.regexp_extract(t, r"\d+$", 0).try_cast("long"), F.lit(1).cast("long")) * times).cast("string")))
            return F.when(p.rlike(r"^\([^()]*\)"), F.concat_ws("", each)).otherwise(p)

        c = F.concat_ws("", F.transform(pieces, written))
    return c


def formula_weight(formula: Column, unknown: float = 0.0, default: float = 100.0) -> Column:
    """Sum of atomic weights; an unknown element weighs ``unknown``, a formula without weight ``default``."""
    weights = F.create_map(*[F.lit(x) for pair in ATOMIC_WEIGHTS.items() for x in pair])
    total = F.aggregate(_elements(formula, 2), F.lit(0.0), lambda a, p: a + F.coalesce(F.try_element_at(weights, p["e"]), F.lit(unknown)) * p["n"])
    return bound(total, lambda t: F.when(t > 0, t).otherwise(F.lit(default)))


def ion_charges(formula: Column) -> Column:
    """Map of the ions whose symbols a formula holds, by plain containment."""
    rules = [*POLYATOMIC, *MONATOMIC]
    entries = F.array(*[F.when(formula.contains(needle), F.struct(F.lit(ion).alias("key"), F.lit(z).alias("value"))) for needle, ion, z in rules])
    return F.map_from_entries(F.array_compact(entries))


def is_ionic(formula: Column) -> Column:
    return F.coalesce(contains_any(formula, METALS) & contains_any(formula, ANIONS), F.lit(False))


def pka_values(name: Column, formula: Column) -> Column:
    """Sorted distinct pKa values that a name and a formula suggest."""
    lowered, none = F.lower(name), F.array().cast("array<double>")
    parts = [F.when(F.coalesce(contains_any(c, needles), F.lit(False)), F.array(*map(F.lit, values))).otherwise(none) for c, rules in ((lowered, NAME_PKA), (formula, FORMULA_PKA)) for needles, values in rules]
    return F.array_sort(F.array_distinct(F.flatten(F.array(*parts))))


def charge_states(pka: Column, formal_charge: Column) -> Column:
    """Charges from minus to plus the number of pKa values, or around the formal charge, or 0; within -3 and 3."""
    n = F.size(pka)
    wide = F.when(n > 0, F.sequence(-n, n)).when(formal_charge.isNotNull(), F.sequence(formal_charge - 1, formal_charge + 1)).otherwise(F.array(F.lit(0)))
    return F.filter(wide, lambda z: F.abs(z) <= 3)


def solubility(name: Column, formula: Column, xlogp: Column) -> Column:
    """g/l: from log P within 0.001 and 2000, else by words of the name, else by whether it is ionic."""
    lowered = F.lower(name)
    return (
        F.when(xlogp.isNotNull(), F.greatest(F.lit(0.001), F.least(F.lit(2000.0), F.pow(F.lit(10.0), 2 - 0.5 * xlogp))))
        .when(contains_any(lowered, SOLUBLE), 500.0)
        .when(contains_any(lowered, INSOLUBLE), 1.0)
        .when(is_ionic(formula), 200.0)
        .otherwise(100.0)
    )


def activity_by_charge(ions: Column) -> Column:
    top = F.coalesce(F.array_max(F.transform(F.map_values(ions), lambda z: F.abs(z))), F.lit(0))
    return F.when(top == 1, 0.9).when(top == 2, 0.8).when(top >= 3, 0.7).otherwise(1.0)


def scaled_concentration(dose: Column, dose_unit: Column, amount: Column) -> Column:
    """What a stock solution's component comes to in the medium: a dose in ml/l or g/l counts in thousandths, others leave it as it is."""
    unit = F.lower(dose_unit)
    scaled = unit.endswith("/l") & (unit.contains("ml") | unit.contains("g"))
    return F.when(F.coalesce(dose, F.lit(0.0)).isin(0.0) | F.coalesce(amount, F.lit(0.0)).isin(0.0), amount).when(F.coalesce(scaled, F.lit(False)), amount * dose / 1000).otherwise(amount)


def score_label(score: Column) -> Column:
    return F.when(score >= 95, "very_high").when(score >= 85, "high").when(score >= 75, "medium").when(score >= 70, "low").otherwise("no_match")
