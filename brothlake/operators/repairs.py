"""Repairs of mapping tables, and lists of what is left to map."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hydrates, labels
from ..functions.chains import present

# Fixed values.

#: The salt that a recipe's short name may be given for another: pattern of names, wrong id, right id, label, formula, weight.
POTASSIUM_ACETATE = (r"(?i)K-acetate", "CHEBI:88550", "CHEBI:32047", "potassium acetate", "C2H3KO2", 98.1)
SALT_PREFIXES = {"na-": "sodium", "k-": "potassium", "ca-": "calcium", "mg-": "magnesium"}
ID_PREFIXES = r"^(CHEBI:|PubChem:|CAS-RN:)"


def without_ontology_id(mapped: DataFrame, prefix: str = "CHEBI:") -> DataFrame:
    """original: each distinct name without an id of the ontology, in order; single characters, two capitals and names without a letter are left out."""
    c = F.trim("original")
    short = (F.length(c) == 2) & (F.upper(c) == c) & (F.lower(c) != c)
    rest = mapped.where(~F.coalesce(F.startswith("mapped", F.lit(prefix)), F.lit(False)) & F.col("original").isNotNull())
    return rest.where((F.length(c) > 1) & ~short & c.rlike(r"\p{L}")).select("original").distinct().orderBy("original")


def repaired_strengths(df: DataFrame) -> DataFrame:
    """df with notations of strength taken out of original and base_compound where the original has one."""
    has = reduce(lambda a, b: a | b, [F.col("original").rlike(p) for p in labels.STRENGTH])
    return df.withColumns({c: F.when(F.coalesce(has, F.lit(False)), labels.without_strength(F.col(c))).otherwise(F.col(c)) for c in ("base_compound", "original")})


def repaired_acetate(df: DataFrame) -> DataFrame:
    """df with the rows of potassium acetate that have another salt's id given its id, label, formula and weights, water included."""
    pattern, wrong, right, label, formula, weight = POTASSIUM_ACETATE
    bad = F.coalesce(F.col("original").rlike(pattern) & (F.col("base_chebi_id") == wrong), F.lit(False))
    waters = F.when(F.col("water_molecules").rlike(r"^\d+$"), F.col("water_molecules").try_cast("int")).otherwise(F.lit(0))
    put = lambda c, v: F.when(bad, v).otherwise(F.col(c))
    return df.withColumns({
        "mapped": put("mapped", F.lit(right)), "base_chebi_id": put("base_chebi_id", F.lit(right)), "base_chebi_label": put("base_chebi_label", F.lit(label)), "base_chebi_formula": put("base_chebi_formula", F.lit(formula)),
        "base_molecular_weight": put("base_molecular_weight", F.lit(weight)), "water_molecular_weight": F.when(bad & (waters > 0), hydrates.WATER * waters).otherwise(F.col("water_molecular_weight")),
        "hydrated_molecular_weight": put("hydrated_molecular_weight", weight + hydrates.WATER * waters),
    })


def salt_issues(df: DataFrame, original: str = "original", label: str = "base_chebi_label") -> DataFrame:
    """Rows whose name tells one metal and whose label another: original, label, expected."""
    low, told = F.lower(original), F.lower(present(F.col(label)))

    def wrong(prefix: str, metal: str) -> Column:
        others = reduce(lambda a, b: a | b, [told.contains(m) for m in SALT_PREFIXES.values() if m != metal])
        return F.when(low.contains(prefix) & ~told.contains(metal) & others, F.lit(metal))

    return df.select(original, label, F.explode(F.array_compact(F.array(*[wrong(p, m) for p, m in SALT_PREFIXES.items()]))).alias("expected"))


def repaired_states(df: DataFrame) -> DataFrame:
    """df with proper dots in hydrate_formula, and rows with an id marked already_mapped instead of by their hydration; those get the base of their name."""
    mapped = F.coalesce(F.col("mapped").rlike(ID_PREFIXES) & F.col("hydration_state").isin("hydrated", "anhydrous"), F.lit(False))
    marked = df.withColumn("hydrate_formula", labels.dotted(F.col("hydrate_formula"))).withColumn("base_compound_for_mapping", F.when(mapped, F.col("original")).otherwise(F.col("base_compound_for_mapping")))
    marked = marked.withColumn("hydration_state", F.when(mapped, "already_mapped").otherwise(F.col("hydration_state")))
    watery = F.coalesce((F.col("hydration_state") == "already_mapped") & F.col("base_compound").rlike(r"(?i)hydrate|\d+\s*H2O"), F.lit(False))
    return marked.withColumn("base_compound", F.when(watery, hydrates.parsed(F.col("original"))["base_compound"]).otherwise(F.col("base_compound")))


def final_schema(df: DataFrame) -> DataFrame:
    """df with hydration_number as water_molecules (instead of older columns of that name), already_mapped as anhydrous, and waters as whole numbers, x, or 0 where missing."""
    kept = df.drop("water_molecules", "hydration_number_extracted").withColumnRenamed("hydration_number", "water_molecules") if "hydration_number" in df.columns else df.drop("hydration_number_extracted")
    text = F.trim(F.col("water_molecules").cast("string"))
    number = text.try_cast("double").cast("long").cast("string")
    waters = F.when(text.isNull() | F.lower(text).isin("", "nan"), "0").when(text == "x", "x").otherwise(F.coalesce(number, text))
    state = F.when(F.col("hydration_state") == "already_mapped", "anhydrous").otherwise(F.col("hydration_state"))
    return kept.withColumns({"water_molecules": waters, "hydration_state": state})
