"""Keys of ontology labels, formulas within names, and notations of strength in names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .chains import Chain, replaced

# Fixed values.

_HYDRATE_WORDS = ["mono", "di", "hepta", "hexa", "penta", "tetra", "tri"]

#: Keys under which a recipe's name and an ontology's label are compared.
LABEL_CHAIN: Chain = [
    (r"\s+", " "), (r"[()\[\]]", ""), (r"[-_]", " "),
    (r"\s*\d+\s*hydrate.*", ""), (r"\s*x\s*h2o.*", ""), (r"\s*\d+\s*h2o.*", ""), *[(rf"\s*{w}hydrate.*", "") for w in _HYDRATE_WORDS],
    (r"l cysteine", "cysteine"), (r"l ", ""), (r"d ", ""), (r"dl ", ""), (r"alpha ", ""), (r"beta ", ""), (r"gamma ", ""),
    (r" acid", ""), (r"ic acid", "ic"), (r"benzoic", "aminobenzoic"), (r"lipoic", "alpha lipoic"),
    (r"hcl", "hydrochloride"), (r" cl", " chloride"), (r" so4", " sulfate"), (r" no3", " nitrate"), (r" co3", " carbonate"), (r" po4", " phosphate"),
    (r"h2po4", "dihydrogen phosphate"), (r"hpo4", "hydrogen phosphate"), (r"hco3", "hydrogencarbonate"), (r"moo4", "molybdate"), (r"seo3", "selenite"), (r"wo4", "tungstate"),
    (r"\s*\(\d+[+-]\)\s*", " "), (r"\s*\d+[+-]\s*", " "), (r"\s+", " "),
]

#: Strengths in parentheses, such as (10% w/v); the first that a name holds is taken out.
STRENGTH = [r"(?i)\s*\(\s*\d+%\s*\([wv]/[wv]\)\s*\)", r"(?i)\s*\(\s*\d+%\s*w/v\s*\)", r"(?i)\s*\(\s*\d+\.\d+%\s*\([wv]/[wv]\)\s*\)", r"(?i)\s*\(\s*\d+\.\d+%\s*w/v\s*\)"]

#: Signs that stand for the dot of a hydrate's formula.
DOTS = r"[¬∑•․‧⋅*]"

FORMULA = r"\b([A-Z][a-z]?\d*)+\b"


def label_key(name: Column) -> Column:
    """Empty for a null name."""
    return F.trim(replaced(F.lower(F.trim(F.coalesce(name, F.lit("")))), LABEL_CHAIN))


def formula_in(name: Column) -> Column:
    """The first word of a name that is spelled as a formula is; null without one."""
    return F.nullif(F.regexp_extract(name, FORMULA, 0), F.lit(""))


def without_strength(name: Column) -> Column:
    """A name without the notation of its strength, trimmed; one without any stays as it is."""
    return F.coalesce(*[F.when(name.rlike(p), F.trim(F.regexp_replace(name, p, ""))) for p in STRENGTH], name)


def dotted(formula: Column) -> Column:
    return F.regexp_replace(formula, DOTS, "·")
