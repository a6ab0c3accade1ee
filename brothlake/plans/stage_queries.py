"""Staged matching, repairs and whole jobs over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import elements, hydrates
from ..operators import properties, staged
from . import stages
from .mapping_queries import nodes
from .media_queries import _FACTS, compositions, property_rows
from .name_queries import _FORMULA_CASE
from .registry import Tables, query


@query("staged_matches", """
WITH a AS (SELECT DISTINCT n_name AS original, 'exact_normalized' AS m, n_nationkey AS k FROM nation UNION SELECT concat(n_name, ' dihydrate'), 'hydration_variant_exact', n_nationkey FROM nation UNION SELECT concat('zz ', n_name, ' qqqqqq wwwwww'), 'none', NULL FROM nation)
SELECT original, CASE WHEN m <> 'none' THEN concat('CHEBI:', k) END AS chebi_id, CASE WHEN m = 'none' THEN 0.0 ELSE 100.0 END::DOUBLE AS similarity_score, CASE WHEN m = 'none' THEN 'no_match' ELSE 'very_high' END AS match_confidence, m AS matching_method FROM a""")
def staged_matches(t: Tables) -> DataFrame:
    name = F.col("n_name")
    asked = t.nation.select(F.explode(F.array(name, F.concat(name, F.lit(" dihydrate")), F.concat(F.lit("zz "), name, F.lit(" qqqqqq wwwwww")))).alias("original"))
    return staged.matched_in_stages(asked, nodes(t), fuzzy=False).drop("chebi_name")


@query("staged_fuzzy_matches")
def staged_fuzzy_matches(t: Tables) -> DataFrame:
    typos = t.part.select(F.concat(F.substring("p_name", 1, 3), F.substring("p_name", 5, 100)).alias("original"))
    known = t.part.groupBy("p_name").agg(F.min("p_partkey").alias("k")).select(F.concat(F.lit("CHEBI:"), F.col("k").cast("string")).alias("id"), F.col("p_name").alias("name"))
    return staged.matched_in_stages(typos, known)


@query("backfilled_weights", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_retailprice ELSE round(22.990 + p_size * 35.45, 2) END AS base_weight FROM part")
def backfilled_weights(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.concat(F.lit("NaCl"), F.col("p_size").cast("string")).alias("base_formula"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_retailprice")).when(F.col("p_partkey") % 3 == 1, 100.0).alias("base_weight"))
    return staged.backfilled_weights(rows).select("p_partkey", "base_weight")


@query("element_mismatches", """
SELECT p_partkey, CASE p_partkey % 4 WHEN 1 THEN 'Mg' WHEN 2 THEN 'K' ELSE '' END AS missing, CASE p_partkey % 4 WHEN 1 THEN 'Zn' WHEN 3 THEN 'Fe' ELSE '' END AS extra FROM part WHERE p_partkey % 4 > 0""")
def element_mismatches(t: Tables) -> DataFrame:
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("p_partkey") % 4 + 1).cast("int"))
    rows = t.part.select("p_partkey", pick(["NaCl", "MgSO4 x 7 H2O", "Potassium chloride, NaCl", "Na2SO4"]).alias("original"), pick(["sodium chloride", "zinc sulfate", "sodium chloride", "iron salt"]).alias("label"), pick(["NaCl", "ZnO4S", "NaCl", "Na2O4S"]).alias("formula"))
    return staged.element_mismatches(rows, "original", "label", "formula").select("p_partkey", F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"))


@query("aligned_ids", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 1 AND p_size % 2 = 0 THEN 'CHEBI:62984' ELSE concat('CHEBI:', p_size) END AS mapped, CASE WHEN p_partkey % 3 = 1 AND p_size % 2 = 0 THEN 'CHEBI:62984' WHEN p_partkey % 3 = 1 THEN concat('CHEBI:', p_size + 1) ELSE concat('CHEBI:', p_size) END AS base_chebi_id FROM part")
def aligned_ids(t: Tables) -> DataFrame:
    chebi = lambda c: F.concat(F.lit("CHEBI:"), c.cast("string"))
    rows = t.part.select("p_partkey", F.when(F.col("p_size") % 2 == 0, "ZnSO4").otherwise("other").alias("base"), chebi(F.col("p_size")).alias("mapped"), chebi(F.col("p_size") + F.when(F.col("p_partkey") % 3 == 1, 1).otherwise(0)).alias("base_chebi_id"))
    return staged.aligned_ids(rows, "mapped", "base_chebi_id", {"ZnSO4": "CHEBI:62984"}, F.col("base")).drop("base")


@query("code_usage", """
WITH p AS (SELECT p_size % 10 AS code, p_name AS name, count(*) AS n FROM part GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY name) AS k FROM p)
SELECT code, sum(n)::BIGINT AS n, count(*) AS names, string_agg(name, '; ' ORDER BY name) FILTER (k <= 3) AS examples FROM k GROUP BY code""")
def code_usage(t: Tables) -> DataFrame:
    return staged.code_usage(t.part.select((F.col("p_size") % 10).alias("code"), F.col("p_name").alias("name")), "name", "code")


@query("mapping_job", """
WITH d AS (SELECT lower(trim(n_name)) AS key, concat('CHEBI:', n_nationkey) AS id FROM nation)
SELECT c_custkey, original, d.id AS mapped, CASE WHEN d.id IS NULL THEN 'none' ELSE 'string' END AS mapping_method FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN concat(' nation_', c_nationkey, ' ') ELSE c_mktsegment END AS original FROM customer) LEFT JOIN d ON d.key = lower(trim(original))""")
def mapping_job(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.col("c_custkey").alias("medium_id"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit(" nation_"), F.col("c_nationkey").cast("string"), F.lit(" "))).otherwise(F.col("c_mktsegment")).alias("compound"))
    return stages.mapped_compositions(rows, nodes(t)).select("c_custkey", "original", "mapped", "mapping_method")


@query("hydrate_job", f"""
SELECT p_partkey, w AS hydration_number, printf('%.6f', p_size / (bw + w * 18.015) * 1000) AS corrected_mmol_l FROM (SELECT p_partkey, p_size, (p_size % 9 + 1)::DOUBLE AS w, CASE {_FORMULA_CASE} {' '.join(f"WHEN '{k}' THEN {v}" for k, v in hydrates.WEIGHTS.items())} ELSE 100.0 END::DOUBLE AS bw FROM part)""")
def hydrate_job(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.concat(F.expr(_FORMULA_CASE), F.lit(" x "), (F.col("p_size") % 9 + 1).cast("string"), F.lit(" H2O")).alias("original"), F.col("p_size").alias("value"))
    return stages.with_hydrates(rows).select("p_partkey", "hydration_number", "corrected_mmol_l")


@query("unaccounted_frequency", """
SELECT source, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))) AS word, count(*) AS frequency FROM documents GROUP BY source, word""")
def unaccounted_frequency(t: Tables) -> DataFrame:
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), 0))
    return t.documents.select("source", F.explode(words).alias("word")).groupBy("source", "word").agg(F.count(F.lit(1)).alias("frequency"))


query("elements_of_formulas", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Cl,Na' WHEN 1 THEN 'Mg,O,S' ELSE 'Ca,Cl,K' END AS elements FROM part")(
    lambda t: t.part.select("p_partkey", F.array_join(elements.elements_in(F.element_at(F.array(F.lit("NaCl"), F.lit("MgSO4"), F.lit("calcium with KCl")), (F.col("p_partkey") % 3 + 1).cast("int"))), ",").alias("elements"))
)


@query("ingredient_usage", f"WITH {_FACTS} SELECT compound, any_value(CASE WHEN own_weight IS NOT NULL THEN 'recognized' WHEN weight IS NOT NULL THEN 'estimated' ELSE 'unaccounted' END) AS account, count(*) AS n, count(DISTINCT medium_id) AS media, round(sum(g_l), 4) AS grams, round(max(molar), 9) AS most_molar FROM lines GROUP BY 1")
def ingredient_usage(t: Tables) -> DataFrame:
    """Each compound's account, rows, media, grams in all and strongest solution."""
    parts = properties.ingredients(compositions(t), property_rows(t))
    return parts.groupBy("compound").agg(F.any_value("account").alias("account"), F.count(F.lit(1)).alias("n"), F.countDistinct("medium_id").alias("media"), F.round(F.sum("g_l"), 4).alias("grams"), F.round(F.max("molar"), 9).alias("most_molar"))


@query("unaccounted_compounds", f"""
WITH {_FACTS}
SELECT compound, count(*) AS frequency FROM lines WHERE weight IS NULL AND lower(compound) NOT IN ('water', 'distilled water') GROUP BY 1""")
def unaccounted_compounds(t: Tables) -> DataFrame:
    """How often each compound is in a medium without being accounted for; water doesn't count."""
    parts = properties.ingredients(compositions(t), property_rows(t)).where((F.col("account") == "unaccounted") & ~F.lower("compound").isin("water", "distilled water"))
    return parts.groupBy("compound").agg(F.count(F.lit(1)).alias("frequency"))


@query("compound_usage", f"WITH {_FACTS} SELECT compound, count(*) AS n, count(DISTINCT medium_id) AS media FROM lines GROUP BY 1")
def compound_usage(t: Tables) -> DataFrame:
    """How many rows and media use each ingredient."""
    return compositions(t).groupBy("compound").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("medium_id").alias("media"))
