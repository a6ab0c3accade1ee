"""Hydrates: number of waters, base compound, weights and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .chains import first_match, replaced

WATER = 18.015

# Fixed values.

PREFIXES = [
    ("mono", 1), ("uni", 1), ("di", 2), ("bi", 2), ("tri", 3), ("ter", 3), ("tetra", 4), ("quad", 4), ("penta", 5), ("quin", 5), ("hexa", 6), ("sex", 6),
    ("hepta", 7), ("sept", 7), ("octa", 8), ("oct", 8), ("nona", 9), ("non", 9), ("deca", 10), ("dec", 10), ("undeca", 11), ("dodeca", 12),
]

NUMBERED = [(r"(?i)\s*[x×]\s*(\d+(?:\.\d+)?)\s*H2O", 1), (r"(?i)\.(\d+(?:\.\d+)?)\s*H2O", 1)]
SINGLE = r"(?i)\s*[x×]\s*H2O\b"
WORDS = ["mono", "di", "tri", "tetra", "penta", "hexa", "hepta", "octa", "nona", "deca", "undeca", "dodeca"]

#: Weights of anhydrous compounds; others count as UNKNOWN_WEIGHT.
WEIGHTS = {
    "CaCl2": 110.98, "CuSO4": 159.61, "FeSO4": 151.91, "MgSO4": 120.37, "NaCl": 58.44, "FeCl3": 162.20, "AlK(SO4)2": 258.21, "Na2SO4": 142.04, "MnSO4": 151.00, "ZnSO4": 161.47,
    "NiCl2": 129.60, "CoCl2": 129.84, "Na2WO4": 293.82, "HBO3": 61.83, "glucose": 180.16, "KCl": 74.55, "MgCl2": 95.21, "Na2HPO4": 141.96, "KH2PO4": 136.09, "NH4Cl": 53.49,
}
UNKNOWN_WEIGHT = 100.0

#: Ids of anhydrous compounds.
BASE_IDS = {
    "CaCl2": "CHEBI:3312", "CuSO4": "CHEBI:23414", "FeSO4": "CHEBI:75832", "MgSO4": "CHEBI:32599", "NaCl": "CHEBI:26710", "FeCl3": "CHEBI:30808",
    "Na2SO4": "CHEBI:32149", "MnSO4": "CHEBI:135251", "ZnSO4": "CHEBI:62984", "NiCl2": "CHEBI:34887", "CoCl2": "CHEBI:35696",
}

WELL_KNOWN = ["CaCl2", "CuSO4", "FeSO4", "MgSO4"]

BASE_CHAIN = [(r"(?i)\s*[.x×]\s*\d*\.?\d*\s*H2O.*$", ""), (r"(?i)\s*\w*hydrate.*$", "")]


def looked_up(table: dict, key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def hydration_number(name: Column, parity: bool = False) -> Column:
    """Waters that a name tells in figures or by a prefix word; null if none.

    The longest prefix counts; with ``parity`` the first that occurs, so that
    undeca- and dodecahydrates have 10.
    """
    c = F.lower(F.trim(name))
    figures = first_match(c, [(r"[x•·]\s*(\d+)\s*h2o", 1), (r"\.\s*(\d+)\s*h2o", 1), (r"[x•·]\s*(\d+)\s*h₂o", 1)]).cast("int")
    order = PREFIXES if parity else sorted(PREFIXES, key=lambda p: -len(p[0]))
    words = F.coalesce(*[F.when(c.contains(f"{p}hydrate"), F.lit(n)) for p, n in order])
    return F.coalesce(figures, words)


def parsed(name: Column, parity: bool = False) -> Column:
    """A struct of everything a name tells about its hydrate.

    Fields: base_compound, base_formula, hydration_number, hydrate_formula,
    base_id, base_weight, water_weight, hydrated_weight, confidence, method.
    Words and a lone 'x H2O' count too; with ``parity`` only figures do.
    """
    c = F.trim(name)
    waters = first_match(c, NUMBERED).cast("double")
    if not parity:
        lowered = F.lower(c)
        words = sorted(enumerate(WORDS, 1), key=lambda w: -len(w[1]))
        waters = F.coalesce(waters, F.when(c.rlike(SINGLE), F.lit(1.0)), *[F.when(lowered.contains(f"{w}hydrate"), F.lit(float(n))) for n, w in words])
    found = waters.isNotNull()
    waters = F.coalesce(waters, F.lit(0.0))
    base = F.when(found, F.trim(replaced(c, BASE_CHAIN))).otherwise(c)
    formula = F.regexp_replace(base, r"\s+", "")
    count = F.when(waters == F.floor(waters), waters.cast("long").cast("string")).otherwise(waters.cast("string"))
    weight = F.coalesce(looked_up(WEIGHTS, formula), F.lit(UNKNOWN_WEIGHT))
    label = F.when(~found, "high").when((waters > 0) & (waters <= 12), F.when(base.isin(WELL_KNOWN), "very_high").otherwise("high")).when(waters > 12, "medium").otherwise("low")
    return F.struct(
        base.alias("base_compound"),
        formula.alias("base_formula"),
        waters.alias("hydration_number"),
        F.when(waters > 0, F.concat(formula, F.lit("."), count, F.lit("H2O"))).otherwise(formula).alias("hydrate_formula"),
        F.coalesce(looked_up(BASE_IDS, formula), looked_up(BASE_IDS, base)).alias("base_id"),
        weight.alias("base_weight"),
        (waters * WATER).alias("water_weight"),
        (weight + waters * WATER).alias("hydrated_weight"),
        label.alias("confidence"),
        F.when(found, "hydrate_pattern").otherwise("no_hydration").alias("method"),
    )


def corrected_mmol(value: Column, hydrated_weight: Column) -> Column:
    """mmol/l as text with six decimals, of values that are plain numbers; '' for others."""
    text = value.cast("string")
    return F.when(text.rlike(r"^[0-9.]+$"), F.format_string("%.6f", F.try_divide(text.cast("double"), hydrated_weight) * 1000)).otherwise("")


def hydrated_weight(base_weight: Column, waters: Column) -> Column:
    """base + n * 18.015; an unknown number of waters (blank, n, x) adds nothing."""
    return base_weight + F.coalesce(waters.try_cast("double"), F.lit(0.0)) * WATER
