"""Property tables assembled from raw rows of several sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import aqueous, chemistry
from .matching import first_rows


def _first_named(raw: DataFrame) -> DataFrame:
    named = raw.withColumn("name", F.trim("name")).where("name <> ''")
    return first_rows(named.withColumn("name_key", F.lower("name")), ["name_key"], F.asc("pos")).drop("name_key")


def by_source(raw: DataFrame) -> DataFrame:
    """Properties of the first row of each name (ignoring case, by pos) of raw (name, formula, molecular_weight, solubility, source, pos).

    Names become snake case; a missing weight or solubility (or 0) is that of a
    known compound or a class, else 100.
    """
    pka = aqueous.known_pka(F.col("name"))
    return _first_named(raw).select(
        F.replace(F.lower("name"), F.lit(" "), F.lit("_")).alias("compound_name"),
        F.coalesce(F.nullif("molecular_weight", F.lit(0.0)), aqueous.known_weight(F.col("name")), F.lit(100.0)).alias("molecular_weight"),
        pka.alias("pka_values"),
        aqueous.charge_ladder(pka).alias("charge_states"),
        aqueous.pair_ions(F.coalesce("formula", F.lit(""))).alias("ion_charges"),
        F.coalesce(F.nullif("solubility", F.lit(0.0)), aqueous.known_solubility(F.col("name"))).alias("solubility_g_per_L"),
        F.lit(1.0).alias("activity_coefficient"),
        F.col("name").alias("description"),
        F.coalesce("formula", F.lit("")).alias("formula"),
        "source",
    )


def from_list(raw: DataFrame, parity: bool = False) -> DataFrame:
    """Properties of the first row of each name of raw (name, formula, molecular_weight, pka_values, solubility, sources, pos), names kept as they are.

    A missing weight is that of the formula; with ``parity`` it is 100, as
    published, where no formula's weight is ever computed. pKa values are told
    from names that have a formula.
    """
    formula = F.coalesce("formula", F.lit(""))
    told = F.when(formula != "", aqueous.known_pka(F.col("name"))).otherwise(F.array().cast("array<double>"))
    pka = F.when(F.coalesce(F.size("pka_values"), F.lit(0)) > 0, F.col("pka_values")).otherwise(told)
    missing = F.lit(100.0) if parity else F.when(formula != "", F.round(chemistry.formula_weight(formula), 2)).otherwise(F.lit(100.0))
    return _first_named(raw).select(
        F.col("name").alias("compound_name"),
        F.coalesce(F.nullif("molecular_weight", F.lit(0.0)), missing).alias("molecular_weight"),
        pka.alias("pka_values"),
        aqueous.charge_ladder(pka).alias("charge_states"),
        aqueous.pair_ions(formula).alias("ion_charges"),
        F.coalesce("solubility", aqueous.known_solubility(F.col("name"))).alias("solubility_g_per_L"),
        F.lit(1.0).alias("activity_coefficient"),
        formula.alias("formula"),
        F.coalesce(F.array_join("sources", ", "), F.lit("unknown")).alias("source"),
    )
