"""pH, salinity, ionic strength and coverage of each medium, as two grouped aggregations."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import chemistry, names
from ..functions.nested import number_list, pair_map
from ..sources.scratch import scratch_path

#: Compounds in whose formula an ion counts twice.
DOUBLED = {"mgcl2": "Cl-", "cacl2": "Cl-", "na2so4": "Na+"}


def property_table(df: DataFrame, lower_keys: bool = True, pos: str | None = None) -> DataFrame:
    """key, molecular_weight, pka_values, charge_states, ion_charges from text columns; without ``lower_keys`` keys stay as they are written.

    Of rows of one key the first by ``pos`` counts; of those, or without it,
    the one whose name is written as its key, then the smallest by name and by
    the texts of its other columns. So the rows' order and partitioning never
    matter. Rows without a name have no key.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("compound_name", "molecular_weight", "pka_values", "charge_states", "ion_charges")]
    key = F.lower("compound_name") if lower_keys else F.col("compound_name")
    values = F.struct(F.col("molecular_weight").try_cast("double").alias("molecular_weight"), number_list(F.col("pka_values")).alias("pka_values"), number_list(F.col("charge_states"), "int").alias("charge_states"), pair_map(F.col("ion_charges")).alias("ion_charges"))
    order = F.struct(*([F.col(pos).alias("pos")] if pos else []), (F.col("compound_name") != key).alias("apart"), *[t.alias(f"t{i}") for i, t in enumerate(texts)])
    first = df.where(F.col("compound_name").isNotNull()).groupBy(key.alias("key")).agg(F.min_by(values, order).alias("v"))
    return first.select("key", "v.*")


def ingredients(compositions: DataFrame, properties: DataFrame, kept: list[str] | None = None) -> DataFrame:
    """Each row of compositions (medium_id, compound, g_l) with its moles, pKa values, charge sum and how it was accounted for, and its ``kept`` columns.

    What a compound alone tells is worked out once for each distinct one and
    written to the session's scratch folder: where it is small its size is
    known before the rows are joined, and they are not shuffled for it.
    """
    distinct = compositions.select("compound").distinct().withColumn("key", names.property_key(F.col("compound")))
    known = distinct.join(properties, "key", "left").withColumn("estimate", chemistry.estimated_properties(F.col("compound")))
    own = F.col("molecular_weight").isNotNull()
    facts = known.select(
        F.col("compound").alias("_compound"),
        "key",
        F.when(own, F.struct("molecular_weight", "pka_values", "charge_states", "ion_charges")).otherwise(F.struct("estimate.molecular_weight", "estimate.pka_values", "estimate.charge_states", "estimate.ion_charges")).alias("p"),
        F.when(own, "recognized").when(F.col("estimate").isNotNull(), "estimated").otherwise("unaccounted").alias("account"),
    )
    doubled = F.coalesce(*[F.when(F.col("key") == k, F.lit(ion)) for k, ion in DOUBLED.items()], F.lit(""))
    charge = F.aggregate(F.map_entries("p.ion_charges"), F.lit(0.0), lambda a, e: a + e["value"] * e["value"] * F.when((doubled != "") & e["key"].contains(doubled), 2.0).otherwise(1.0))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    pka = F.col("p.pka_values")
    facts = facts.withColumns({
        "charge_sum": F.coalesce(charge, F.lit(0.0)), "ionic": F.size(F.map_keys("p.ion_charges")) > 0,
        "pkas": F.size(pka), "pka_total": total(pka), "buffer": total(F.transform(pka, lambda p: F.exp(-F.abs(7.0 - p)))),
    })
    path = scratch_path(compositions.sparkSession, "compound-facts")
    facts.write.parquet(path)
    facts = compositions.sparkSession.read.schema(facts.schema).parquet(path)
    amount = F.coalesce("g_l", F.lit(0.0))
    joined = compositions.join(facts, compositions["compound"].eqNullSafe(facts["_compound"]), "left").drop("_compound")
    return joined.select("medium_id", "compound", "key", amount.alias("g_l"), F.when(amount > 0, amount / F.col("p.molecular_weight")).alias("molar"), F.col("p.pka_values").alias("pka_values"), F.col("p.charge_states").alias("charge_states"), "charge_sum", "account", "ionic", "pkas", "pka_total", "buffer", *(kept or []))


def media_figures(compositions: DataFrame, properties: DataFrame) -> DataFrame:
    """One row for each medium: ph, salinity and their uncertainties, strength, tds, and the numbers of its compounds by account."""
    return figures_of(ingredients(compositions, properties))


def figures_of(parts: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """media_figures() of rows of ingredients(), with further aggregates of a medium's rows by name."""
    buffered = (F.col("molar") > 0) & (F.col("pkas") > 0)
    sums = parts.groupBy("medium_id").agg(
        F.sum("g_l").alias("tds"),
        F.sum(0.5 * F.coalesce("molar", F.lit(0.0)) * F.col("charge_sum")).alias("strength"),
        F.count_if(buffered).alias("buffers"),
        F.sum(F.when(buffered, F.col("molar") * F.col("pka_total"))).alias("pka_sum"),
        F.sum(F.when(buffered, F.col("molar") * F.col("pkas"))).alias("pka_weight"),
        F.sum(F.when(buffered, F.col("molar") * F.col("buffer"))).alias("buffering"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("account") == "recognized").alias("recognized"),
        F.count_if(F.col("account") == "estimated").alias("estimated"),
        F.count_if((F.col("account") == "recognized") & (F.col("key") != "nacl") & F.col("ionic")).alias("other_salts"),
        *[c.alias(name) for name, c in (more or {}).items()],
    )
    mean = F.col("pka_sum") / F.col("pka_weight")
    ph = F.when(F.col("buffers") == 0, 7.0).otherwise(F.least(F.lit(13.0), F.greatest(F.lit(1.0), F.when(F.col("buffers") > 1, 0.7 * mean + 0.3 * 7.0).otherwise(mean))))
    doubt = F.when(F.col("buffers") == 0, 0.5).otherwise(F.least(F.lit(1.5), 0.5 + 0.1 * F.col("buffers") + F.when(F.col("buffering") < 0.001, 0.3).otherwise(0.0)))
    strength = F.greatest(F.col("strength"), F.lit(chemistry.LEAST_IONIC_STRENGTH))
    salt_doubt = F.least(F.lit(0.1), 0.01 + F.when(strength < 0.001, 0.005).otherwise(0.0) + 0.005 * F.col("other_salts"))
    return sums.select("medium_id", ph.alias("ph"), doubt.alias("ph_uncertainty"), chemistry.salinity_percent(strength, F.col("tds")).alias("salinity"), salt_doubt.alias("salinity_uncertainty"), strength.alias("strength"), "tds", "n", "recognized", "estimated", *(more or {}))


def _confidence(doubt: str, high: float, medium: float):
    return F.when(F.col(doubt) < high, "high").when(F.col(doubt) < medium, "medium").otherwise("low")


def _percent(c):
    return F.coalesce(F.round(F.try_divide(100.0 * c, F.col("n")), 1), F.lit(0.0))


def media_summary(compositions: DataFrame, properties: DataFrame) -> DataFrame:
    """One row for each medium: ph, salinity_percent, ionic_strength, total_dissolved_solids, shares of recognised and estimated compounds, labels."""
    return media_figures(compositions, properties).select(
        "medium_id",
        F.round("ph", 2).alias("ph"),
        _confidence("ph_uncertainty", 0.3, 0.7).alias("ph_confidence"),
        F.round("salinity", 4).alias("salinity_percent"),
        _confidence("salinity_uncertainty", 0.02, 0.05).alias("salinity_confidence"),
        F.round("strength", 6).alias("ionic_strength"),
        F.round("tds", 2).alias("total_dissolved_solids"),
        _percent(F.col("recognized")).alias("compounds_recognized"),
        _percent(F.col("estimated")).alias("compounds_estimated"),
        _percent(F.col("recognized") + F.col("estimated")).alias("total_coverage"),
    )


def notes(summary: DataFrame) -> DataFrame:
    """summary with the column notes: what limits its figures."""
    messages = F.array_compact(
        F.array(
            F.when(F.col("compounds_estimated") > 0, "estimated compounds add uncertainty"),
            F.when(F.col("total_coverage") < 100, "unaccounted compounds may change pH and salinity"),
            F.when(F.col("ionic_strength") > 0.1, "high ionic strength"),
            F.when(F.col("ionic_strength") < 0.001, "low ionic strength, results are less certain"),
        )
    )
    return summary.withColumn("notes", messages)


@F.pandas_udf(T.DoubleType())
def _balanced_ph(molar: pd.Series, pka: pd.Series, charges: pd.Series, strength: pd.Series) -> pd.Series:
    """pH at which the charges of each row's acids and of water balance, halving 0.5 to 14; molar, pka and charges are lists by acid."""
    owner = np.repeat(np.arange(len(molar)), molar.map(len))
    amount = np.concatenate(molar.tolist() or [[]]).astype(float)
    steps = [np.asarray(x, float) for row in pka for x in row]
    forms = [np.asarray(x, float)[: len(k) + 1] for row, ks in zip(charges, pka) for x, k in zip(row, ks)]
    widest = max(map(len, steps), default=0)
    table, z = np.full((len(steps), widest), 400.0), np.zeros((len(steps), widest + 1))  # a missing step never dissociates
    for i, (x, f) in enumerate(zip(steps, forms)):
        table[i, : len(x)], z[i, : len(f)] = x, f
    root = np.sqrt(strength.to_numpy(float))[owner][:, None]
    ionic = strength.to_numpy(float)[owner][:, None]
    effective = z * 10.0 ** (-chemistry.DEBYE * z * z * (root / (1 + root) - chemistry.DAVIES_SLOPE * ionic))
    low, high = np.full(len(molar), 0.5), np.full(len(molar), 14.0)
    for _ in range(60):
        mid = (low + high) / 2
        logs = np.concatenate([np.zeros((len(steps), 1)), np.cumsum(mid[owner][:, None] - table, axis=1)], axis=1)
        terms = 10.0 ** (logs - logs.max(axis=1, keepdims=True))
        charge = (terms * effective).sum(1) / terms.sum(1)
        total = 10.0**-mid - 10.0 ** (mid - 14) + np.bincount(owner, amount * charge, minlength=len(molar))
        low, high = np.where(total > 0, mid, low), np.where(total > 0, high, mid)
    return pd.Series((low + high) / 2)


def charge_balance_ph(compositions: DataFrame, properties: DataFrame) -> DataFrame:
    """medium_id, ph and ph_uncertainty: where the charges of its acids, weakened by activity, and of water balance.

    An acid's charge states pair with its forms by position, from the most
    protonated on, as far as both go; each counts with its Davies coefficient
    at the medium's ionic strength. The pH is the root between 0.5 and 14, or
    the end that halving comes to where there is none; a medium without acids
    is neutral, with an uncertainty of 0.5. A row gathers one medium's few
    acids.
    """
    parts = ingredients(compositions, properties)
    acid = (F.col("molar") > 0) & (F.size("pka_values") > 0)
    list_of = lambda c: F.array_sort(F.collect_list(F.when(acid, F.struct(F.col("molar").alias("m"), F.col("pka_values").alias("k"), F.coalesce("charge_states", F.array().cast("array<int>")).alias("z")))))
    media = parts.groupBy("medium_id").agg(F.greatest(F.sum(0.5 * F.coalesce("molar", F.lit(0.0)) * F.col("charge_sum")), F.lit(chemistry.LEAST_IONIC_STRENGTH)).alias("strength"), list_of("acids").alias("acids"))
    n = F.size("acids")
    uncertainty = F.when(n == 0, 0.5).otherwise(F.least(F.lit(1.0), 0.1 + 0.05 * n + 0.1 * F.sqrt("strength")))
    solved = _balanced_ph(F.col("acids.m"), F.col("acids.k"), F.col("acids.z"), F.col("strength"))
    return media.select("medium_id", F.round(F.when(n == 0, 7.0).otherwise(solved), 3).alias("ph"), F.round(uncertainty, 4).alias("ph_uncertainty"))
