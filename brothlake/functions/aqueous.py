"""Properties of compounds told from names, formulas and structures, by the rules of the second property pipeline."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .chains import contains_any

# Fixed values.

#: Known compounds and their pKa values, in the order in which names are tried.
KNOWN_PKA = {
    "phosphoric acid": [2.15, 7.20, 12.35], "carbonic acid": [6.37, 10.33], "sulfuric acid": [-3.0, 1.9], "hydrochloric acid": [-7.0], "nitric acid": [-1.4], "boric acid": [9.24, 12.74, 13.80],
    "glycine": [2.34, 9.60], "alanine": [2.34, 9.69], "cysteine": [1.96, 8.18, 10.28], "glutamic acid": [2.19, 4.25, 9.67], "lysine": [2.18, 8.95, 10.53], "histidine": [1.82, 6.00, 9.17],
    "acetic acid": [4.76], "citric acid": [3.13, 4.76, 6.40], "lactic acid": [3.86], "pyruvic acid": [2.50], "formic acid": [3.75], "succinic acid": [4.21, 5.64], "malic acid": [3.40, 5.20], "fumaric acid": [3.03, 4.44],
    "tris": [8.07], "hepes": [7.55], "mes": [6.15], "mops": [7.20], "pipes": [6.76], "bis-tris": [6.50],
    "ammonia": [9.25], "imidazole": [6.95], "ethanolamine": [9.50],
    "ascorbic acid": [4.10, 11.79], "nicotinic acid": [2.00, 4.85], "pantothenic acid": [4.40],
}

#: For other names: the first of these that a name holds.
PKA_BY_WORD = [(["phosphate"], [2.15, 7.20, 12.35]), (["carbonate"], [6.37, 10.33]), (["acetate"], [4.76]), (["chloride", "sulfate"], []), (["amino", "glycine", "alanine"], [2.3, 9.6])]

#: Structures (SMILES) and the pKa value of the group that they show.
PKA_BY_STRUCTURE = [
    (r"C\(=O\)O[H]?", 4.75), (r"c[OH]", 10.0), (r"[CH][OH]", 15.5), (r"[CH2]N[H2]?", 10.8), (r"[CH]N[H]?[CH]", 11.0), (r"[N][CH3]{3}|[N]\([CH]\)", 9.8), (r"S\(=O\)\(=O\)O", -3.0),
]
PHOSPHATE_PKA = [2.15, 7.20, 12.35]

#: Grams that dissolve in a litre at 20 degrees.
KNOWN_SOLUBILITY = {
    "sodium chloride": 360.0, "potassium chloride": 344.0, "magnesium chloride": 546.0, "calcium chloride": 745.0, "sodium sulfate": 284.0, "magnesium sulfate": 353.0,
    "glucose": 909.0, "sucrose": 2000.0, "calcium carbonate": 0.0013, "sodium bicarbonate": 96.0, "sodium carbonate": 215.0, "boric acid": 49.8,
}

#: Symbols that a formula holds, with their ion and its charge.
FORMULA_IONS = [("Na", "Na+", 1), ("K", "K+", 1), ("Ca", "Ca2+", 2), ("Mg", "Mg2+", 2), ("Cl", "Cl-", -1), ("SO4", "SO42-", -2), ("PO4", "PO43-", -3), ("CO3", "CO32-", -2), ("NO3", "NO3-", -1)]

#: Weights of compounds that a source may lack.
KNOWN_WEIGHT = {"sodium chloride": 58.44, "glucose": 180.16, "calcium carbonate": 100.09, "potassium chloride": 74.55, "magnesium sulfate": 120.37}

#: The curated source: name, formula, molecular weight, solubility.
CURATED = [("sodium chloride", "NaCl", 58.44, 360.0), ("glucose", "C6H12O6", 180.16, 909.0), ("calcium carbonate", "CaCO3", 100.09, 0.0013)]


def _doubles(values: list[float]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<double>")


def known_pka(name: Column) -> Column:
    """pKa values of the first known compound that the name holds or that holds the name, else those that a word tells; empty without any."""
    low = F.lower(F.trim(name))
    rules = [F.when((low != "") & (low.contains(k) | F.contains(F.lit(k), low)), _doubles(v)) for k, v in KNOWN_PKA.items()]
    return F.coalesce(*rules, *[F.when(contains_any(low, needles), _doubles(v)) for needles, v in PKA_BY_WORD], _doubles([]))


def charge_ladder(pka: Column) -> Column:
    """Charges from +1 down by one for each pKa value; 0 alone without any."""
    n = F.size(pka)
    return F.when(n > 0, F.sequence(F.lit(1), -n, F.lit(-1))).otherwise(F.array(F.lit(0)))


def structure_pka(smiles: Column) -> Column:
    """Sorted distinct pKa values of the groups that a structure shows."""
    shown = [F.when(smiles.rlike(p), F.lit(v)) for p, v in PKA_BY_STRUCTURE] + [F.when(F.lower(smiles).contains("phosphate"), F.lit(v)) for v in PHOSPHATE_PKA]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*shown))))


def last_counts(formula: Column) -> Column:
    """Map of a formula's elements to counts, without regard to groups; of an element that is written again the last count holds."""
    tokens = F.regexp_extract_all(F.coalesce(formula, F.lit("")), F.lit(r"([A-Z][a-z]?)(\d*)"), 0)
    element = lambda t: F.regexp_extract(t, r"^[A-Za-z]+", 0)
    count = lambda t: F.coalesce(F.regexp_extract(t, r"\d+$", 0).try_cast("int"), F.lit(1))
    last = F.aggregate(tokens, F.create_map().cast("map<string,int>"), lambda m, t: F.map_concat(F.map_filter(m, lambda k, _: k != element(t)), F.create_map(element(t), count(t))))
    return last


def pair_ions(formula: Column) -> Column:
    """Ions of a formula of sodium or calcium with chlorine, or of magnesium with sulphate; an empty map for others."""
    has = lambda e: F.regexp_like(formula, F.lit(rf"{e}(?![a-z])"))
    ions = lambda *xs: F.create_map(*map(F.lit, xs)).cast("map<string,int>")
    rules = F.when(has("Na") & has("Cl"), ions("Na+", 1, "Cl-", -1)).when(has("Ca") & has("Cl"), ions("Ca2+", 2, "Cl-", -1)).when(has("Mg") & formula.contains("SO4"), ions("Mg2+", 2, "SO42-", -2))
    return F.coalesce(rules, F.create_map().cast("map<string,int>"))


def formula_ions(formula: Column) -> Column:
    """Map of the common ions whose symbols a formula holds, by plain containment."""
    return F.map_from_entries(F.array_compact(F.array(*[F.when(formula.contains(s), F.struct(F.lit(ion).alias("key"), F.lit(z).alias("value"))) for s, ion, z in FORMULA_IONS])))


def known_solubility(name: Column) -> Column:
    """g/l: that of the first known compound that the name holds, else by its class, else 100."""
    low = F.lower(name)
    out = F.coalesce(*[F.when(low.contains(k), F.lit(v)) for k, v in KNOWN_SOLUBILITY.items()])
    classes = (
        F.when(low.contains("chloride"), 400.0).when(low.contains("sulfate"), 300.0).when(low.contains("carbonate") & ~low.contains("sodium"), 0.01).when(low.contains("phosphate"), 100.0)
        .when(contains_any(low, ["glucose", "sucrose", "fructose"]), 1000.0).when(contains_any(low, ["glycine", "alanine", "amino"]), 200.0).otherwise(100.0)
    )
    return F.coalesce(out, classes)


def known_weight(name: Column) -> Column:
    """Weight of the first known compound that the name holds; null without any."""
    return F.coalesce(*[F.when(F.lower(name).contains(k), F.lit(v)) for k, v in KNOWN_WEIGHT.items()])
