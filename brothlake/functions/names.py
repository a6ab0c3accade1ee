"""Normalisers of ingredient names, as Column functions. A null name gives a null, or '' where noted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .chains import Chain, replaced

# Patterns and spellings that recipes are known to use.

#: Knowledge-graph keys: only hydrates are respelled, and what follows them is dropped.
KG_CHAIN: Chain = [
    (r"\s+", " "),
    (r"(?i)^(.+?)\s+x\s+(\d+)\s+H2O.*$", r"\1·\2H2O"),
    (r"(?i)^(.+?)\s+(\d+)-hydrate.*$", r"\1·\2H2O"),
]

#: Loose keys: prefixes, hydrates, parentheses and punctuation go.
LOOSE_CHAIN: Chain = [
    (r"^(d|l|dl)-", ""),
    (r"^(\+|-)\s*", ""),
    (r"\s*x\s*\d+\s*h2o", ""),
    (r"\s*•\s*\d+\s*h2o", ""),
    (r"\s*\.\s*\d+\s*h2o", ""),
    (r"\([^)]*\)", ""),
    (r"[,;]", ""),
    (r"\s+", " "),
]

HYDRATE_WORDS = ["mono", "di", "tri", "tetra", "penta", "hexa", "hepta", "octa", "nona", "deca"]

#: Ontology keys: hydrates in any spelling, stereochemistry, spacing, end punctuation.
ONTOLOGY_CHAIN: Chain = [
    (r"\s*[x•·]\s*\d+\s*h2o\s*$", ""),
    (r"\s*[x•·]\s*\d+\s*h₂o\s*$", ""),
    (r"\s*\.\s*\d+\s*h2o\s*$", ""),
    (rf"\s*({'|'.join(HYDRATE_WORDS)})?hydrate\s*$", ""),
    (r"^[dl]-", ""),
    (r"^[lr]-", ""),
    (r"^[+-]", ""),
    (r"^\([dlr+-]+\)-?", ""),
    (r"\([dlr][+-]?\)|\([+-]\)|\(cis\)|\(trans\)|\(alpha\)|\(beta\)|\(gamma\)|\([ezrs]\)", ""),
    (r"\s*,\s*", ", "),
    (r"\s+", " "),
]

#: The same as published: 'hydrate' goes first, so 'monohydrate' leaves 'mono'.
ONTOLOGY_CHAIN_PARITY: Chain = [*ONTOLOGY_CHAIN[:3], (r"\s*hydrate\s*$", ""), *ONTOLOGY_CHAIN[4:]]

PROPERTY_CHAIN: Chain = [
    (r"\s*[·•]\s*\d+\s*h2o", ""),
    (r"\s*\.\s*\d+\s*h2o", ""),
    (r"\s*x\s*\d+\s*h2o", ""),
    (r"^[dl]-", ""),
    (r"^[+-]-", ""),
]

#: Names that mean a compound of the property table.
PROPERTY_SYNONYMS = {
    "sodium chloride": "nacl",
    "table salt": "nacl",
    "potassium chloride": "kcl",
    "magnesium chloride": "mgcl2",
    "calcium chloride": "cacl2",
    "sodium sulfate": "na2so4",
    "dipotassium phosphate": "k2hpo4",
    "dipotassium hydrogen phosphate": "k2hpo4",
    "potassium phosphate dibasic": "k2hpo4",
    "monopotassium phosphate": "kh2po4",
    "potassium dihydrogen phosphate": "kh2po4",
    "potassium phosphate monobasic": "kh2po4",
    "ammonium chloride": "nh4cl",
    "iron sulfate": "feso4",
    "ferrous sulfate": "feso4",
    "zinc sulfate": "znso4",
    "copper sulfate": "cuso4",
    "cupric sulfate": "cuso4",
    "dextrose": "glucose",
    "na malate": "sodium_malate",
    "sodium malate": "sodium_malate",
    "na2-fumarate": "disodium_fumarate",
    "na2 fumarate": "disodium_fumarate",
    "disodium fumarate": "disodium_fumarate",
    "na-formate": "sodium_formate",
    "na formate": "sodium_formate",
    "sodium formate": "sodium_formate",
    "na acetate": "sodium_acetate",
    "na-acetate": "sodium_acetate",
    "sodium acetate": "sodium_acetate",
    "trypticase peptone": "peptone_mix",
    "peptone": "peptone_mix",
    "yeast extract": "yeast_extract",
}

STANDARD_CHAIN: Chain = [
    (r"^(?:\d+\.?\d*\s*%\s+|\d+\.?\d*\s+m\s+|\d+\.?\d*\s*m?g\s+|g\s+)", ""),
    (r"^[dl]-", ""),
    (r"^[+-]-", ""),
    (r"\s*\([^)]*\)", ""),
    (r"\s*(?:x|×|·|\.)\s*\d*\s*h2o", ""),
    (r"\s*(?:\(\s*\d*\s*\)|\+|×|·\s*n|x\s*n?|\bmon[oa]?|\btri?)\s*$", ""),
    (r"\s+", " "),
]

DOTTED_CHAIN: Chain = [
    (r"(?i)\s*x\s*(\d+)\s*H2O", r".\1H2O"),
    (r"(?i)\.(\d+)\s*H2O", r".\1H2O"),
    (r"(?i)\s*monohydrate", ".H2O"),
    (r"(?i)\s*dihydrate", ".2H2O"),
    (r"(?i)\s*trihydrate", ".3H2O"),
    (r"(?i)\s*tetrahydrate", ".4H2O"),
    (r"(?i)\s*pentahydrate", ".5H2O"),
    (r"(?i)\s*hexahydrate", ".6H2O"),
    (r"(?i)\s*heptahydrate", ".7H2O"),
    (r"(?i)\s*n\s*H2O", ""),
]

SALT_CHAIN: Chain = [
    (r"\s*[x×]\s*\d*\s*h2o\s*$", ""),
    (r"\s*[·•]\s*\d*\s*h2o\s*$", ""),
    (r"\s*\.\s*\d*\s*h2o\s*$", ""),
    (r"\s*\*\s*\d*\s*h2o\s*$", ""),
    (r"\s+\d*\s*h2o\s*$", ""),
    (r"\s*\(\d*\s*h2o\)\s*$", ""),
    (r"\s*\bmonohydrate\b\s*$", ""),
    (r"\s*\bdihydrate\b\s*$", ""),
    (r"\s*\btrihydrate\b\s*$", ""),
    (r"\s*\bhydrate\b\s*$", ""),
    (r"^na\s+", "sodium "),
    (r"^na-", "sodium "),
    (r"^na2-", "disodium "),
    (r"^nh4-", "ammonium "),
    (r"\s+", " "),
]

BRAND_CHAIN: Chain = [(r"\s*\([^)]*\)", "")]

SYMBOLS, SYMBOL_FIXES = "·•⋅∑¬", "..."


def _folded(c: Column) -> Column:
    """Lower case, no-break spaces as spaces, trimmed."""
    return F.trim(F.lower(F.translate(c, "\u00a0", " ")))


def kg_key(c: Column) -> Column:
    return F.nullif(F.lower(F.trim(replaced(F.trim(F.translate(c, "\u00a0", " ")), KG_CHAIN))), F.lit(""))


def loose_key(c: Column) -> Column:
    return F.trim(replaced(_folded(c), LOOSE_CHAIN))


def ontology_key(c: Column, parity: bool = False) -> Column:
    """With ``parity`` the order of the published chain, which keeps the number words."""
    return F.rtrim(F.trim(replaced(_folded(c), ONTOLOGY_CHAIN_PARITY if parity else ONTOLOGY_CHAIN)), F.lit(".,;:"))


def property_key(c: Column) -> Column:
    key = replaced(_folded(c), PROPERTY_CHAIN)
    known = F.create_map(*[F.lit(x) for pair in PROPERTY_SYNONYMS.items() for x in pair])
    return F.coalesce(F.element_at(known, key), key)


def standard_key(c: Column) -> Column:
    return F.trim(replaced(_folded(c), STANDARD_CHAIN))


def dotted_hydrate(c: Column) -> Column:
    return F.trim(replaced(F.trim(c), DOTTED_CHAIN))


def salt_key(c: Column) -> Column:
    return F.trim(replaced(_folded(c), SALT_CHAIN))


def without_brand(c: Column) -> Column:
    return replaced(_folded(c), BRAND_CHAIN)


def repaired_symbols(c: Column) -> Column:
    """Middle dots and bullets as full stops; stray sum and not signs go."""
    return F.translate(c, SYMBOLS, SYMBOL_FIXES)


def hydration_variants(base: Column) -> Column:
    """Spellings of the hydrates of a base name, 1 to 10 waters, as an array that starts with the base."""
    numbered = [F.concat(base, F.lit(f"{mark}{n}{gap}h2o")) for n in range(1, 11) for mark, gap in ((" x ", " "), (" • ", ""), (".", ""))]
    worded = [F.concat(base, F.lit(f" {w}hydrate")) for w in HYDRATE_WORDS]
    return F.array(base, *numbered, *worded)
