"""Names, hydrates and predicates over names built from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hydrates, names, predicates
from ..functions.chains import contains_any_sql, first_match_sql, replaced_sql
from .registry import Tables, query

#: Ways to write a part's name; which one is told by p_partkey.
SPELLINGS = [
    ("{n} x {k} H2O", "concat({n}, ' x ', {k}, ' H2O')"),
    ("D-{n}, pure (grade A)", "concat('D-', {n}, ', pure (grade A)')"),
    ("{N}•{k}H2O", "concat(upper({n}), '•', {k}, 'H2O')"),
    ("{n}  dihydrate ", "concat({n}, '  dihydrate ')"),
    ("Na2-{n}.{k} H2O", "concat('Na2-', {n}, '.', {k}, ' H2O')"),
    ("{n} {k}-hydrate", "concat({n}, ' ', {k}, '-hydrate')"),
    ("{k} mg {n} (trans)", "concat({k}, ' mg ', {n}, ' (trans)')"),
    ("MgSO4 x {k} H2O", "concat('MgSO4 x ', {k}, ' H2O')"),
]

_CASE = "CASE p_partkey % 8 " + " ".join(f"WHEN {i} THEN {sql.format(n='p_name', k='p_size % 13')}" for i, (_, sql) in enumerate(SPELLINGS)) + " END"
SPELLED = f"(SELECT p_partkey, {_CASE} AS name FROM part)"


def spelled(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.expr(_CASE).alias("name"))


def _normaliser(name: str, column, sql: str) -> None:
    query(name, f"SELECT p_partkey, name, {sql} AS key FROM {SPELLED}")(lambda t: spelled(t).select("p_partkey", "name", column(F.col("name")).alias("key")))


_LOW = "trim(lower(name))"
_normaliser("name_kg_key", names.kg_key, f"nullif(lower(trim({replaced_sql('trim(name)', names.KG_CHAIN)})), '')")
_normaliser("name_loose_key", names.loose_key, f"trim({replaced_sql(_LOW, names.LOOSE_CHAIN)})")
_normaliser("name_ontology_key", names.ontology_key, f"rtrim(trim({replaced_sql(_LOW, names.ONTOLOGY_CHAIN)}), '.,;:')")
_normaliser("name_ontology_key_parity", lambda c: names.ontology_key(c, parity=True), f"rtrim(trim({replaced_sql(_LOW, names.ONTOLOGY_CHAIN_PARITY)}), '.,;:')")
_normaliser("name_standard_key", names.standard_key, f"trim({replaced_sql(_LOW, names.STANDARD_CHAIN)})")
_normaliser("name_dotted_hydrate", names.dotted_hydrate, f"trim({replaced_sql('trim(name)', names.DOTTED_CHAIN)})")
_normaliser("name_salt_key", names.salt_key, f"trim({replaced_sql(_LOW, names.SALT_CHAIN)})")
_normaliser("name_without_brand", names.without_brand, replaced_sql(_LOW, names.BRAND_CHAIN))
_normaliser("name_repaired_symbols", names.repaired_symbols, "translate(name, '·•⋅∑¬', '...')")

_SYNONYM_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.PROPERTY_SYNONYMS.items())
_SALTS = ["Sodium chloride", "D-glucose", "MgCl2 x 6 H2O", "Dextrose ", "Potassium phosphate dibasic", "Zinc Sulfate • 7 H2O", "Yeast extract", "l-glycine"]
_SALT_CASE = "CASE l_partkey % 8 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_SALTS)) + " END"


@query("name_property_key", f"""
WITH d AS (SELECT DISTINCT l_linenumber, {_SALT_CASE} AS name FROM lineitem),
k AS (SELECT l_linenumber, name, {replaced_sql(_LOW, names.PROPERTY_CHAIN)} AS k FROM d)
SELECT l_linenumber, name, CASE k {_SYNONYM_CASE} ELSE k END AS key FROM k""")
def name_property_key(t: Tables) -> DataFrame:
    return t.lineitem.select("l_linenumber", F.expr(_SALT_CASE).alias("name")).distinct().withColumn("key", names.property_key(F.col("name")))


@query("hydration_variants", """
SELECT p_partkey, unnest(list_concat([p_name], flatten(list_transform(range(1, 11), lambda n: [concat(p_name, ' x ', n, ' h2o'), concat(p_name, ' • ', n, 'h2o'), concat(p_name, '.', n, 'h2o')])),
  list_transform(['mono','di','tri','tetra','penta','hexa','hepta','octa','nona','deca'], lambda w: concat(p_name, ' ', w, 'hydrate')))) AS variant FROM part""")
def hydration_variants(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.explode(names.hydration_variants(F.col("p_name"))).alias("variant"))


def _number_sql(parity: bool) -> str:
    order = hydrates.PREFIXES if parity else sorted(hydrates.PREFIXES, key=lambda p: -len(p[0]))
    figures = first_match_sql("c", [(r"[x•·]\s*(\d+)\s*h2o", 1), (r"\.\s*(\d+)\s*h2o", 1)])
    return f"coalesce(({figures})::INTEGER, CASE " + " ".join(f"WHEN contains(c, '{p}hydrate') THEN {n}" for p, n in order) + " END)"


@query("hydration_number", f"""
WITH w AS (SELECT p_partkey, name, lower(trim(name)) AS c FROM {SPELLED} UNION ALL
  SELECT p_partkey, n, n FROM (SELECT p_partkey, concat(p_name, ' ', ['undeca','dodeca','tri','quin','mono'][p_size % 5 + 1], 'hydrate') AS n FROM part))
SELECT p_partkey, name, coalesce({_number_sql(False)}, 0) AS waters, coalesce({_number_sql(True)}, 0) AS waters_parity FROM w""")
def hydration_number(t: Tables) -> DataFrame:
    words = F.element_at(F.array(*map(F.lit, ["undeca", "dodeca", "tri", "quin", "mono"])), F.col("p_size") % 5 + 1)
    both = spelled(t).unionByName(t.part.select("p_partkey", F.concat("p_name", F.lit(" "), words, F.lit("hydrate")).alias("name")))
    waters = lambda parity: F.coalesce(hydrates.hydration_number(F.col("name"), parity), F.lit(0))
    return both.select("p_partkey", "name", waters(False).alias("waters"), waters(True).alias("waters_parity"))


_FORMULAS = ["CaCl2", "CuSO4", "MgSO4", "NaCl", "Na2WO4", "glucose"]
_FORMULA_CASE = "CASE p_partkey % 6 " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(_FORMULAS)) + " END"
_WEIGHT_SQL = "CASE base_formula " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in hydrates.WEIGHTS.items()) + " ELSE 100.0 END"
_ID_SQL = "CASE base_formula " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in hydrates.BASE_IDS.items()) + " END"


@query("hydrate_parse", f"""
WITH n AS (SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN {_FORMULA_CASE} WHEN p_size % 4 = 1 THEN concat({_FORMULA_CASE}, '.', p_size, 'H2O') ELSE concat({_FORMULA_CASE}, ' x ', p_size, ' H2O') END AS name, p_retailprice FROM part),
m AS (SELECT *, regexp_extract(name, '(?:x|\\.)\\s*(\\d+)\\s*H2O', 1) AS w FROM n),
b AS (SELECT *, CASE WHEN w = '' THEN 0 ELSE w::INTEGER END::DOUBLE AS hydration_number, regexp_replace(name, '\\s*[.x]\\s*\\d*\\.?\\d*\\s*H2O.*$', '') AS base_formula FROM m),
c AS (SELECT *, {_WEIGHT_SQL}::DOUBLE AS base_weight FROM b)
SELECT p_partkey, name, base_formula, hydration_number, CASE WHEN hydration_number > 0 THEN concat(base_formula, '.', w, 'H2O') ELSE base_formula END AS hydrate_formula, {_ID_SQL} AS base_id,
  round(base_weight + hydration_number * 18.015, 6) AS hydrated_weight, CASE WHEN w = '' THEN 'high' WHEN hydration_number BETWEEN 1 AND 12 THEN CASE WHEN base_formula IN ('CaCl2','CuSO4','FeSO4','MgSO4') THEN 'very_high' ELSE 'high' END WHEN hydration_number > 12 THEN 'medium' ELSE 'low' END AS confidence,
  CASE WHEN w = '' THEN 'no_hydration' ELSE 'hydrate_pattern' END AS method, round(p_retailprice / (base_weight + hydration_number * 18.015) * 1000, 2) AS mmol
FROM c""")
def hydrate_parse(t: Tables) -> DataFrame:
    name = F.expr(f"CASE WHEN p_size % 4 = 0 THEN {_FORMULA_CASE} WHEN p_size % 4 = 1 THEN concat({_FORMULA_CASE}, '.', p_size, 'H2O') ELSE concat({_FORMULA_CASE}, ' x ', p_size, ' H2O') END")
    parsed = t.part.select("p_partkey", name.alias("name"), "p_retailprice").withColumn("h", hydrates.parsed(F.col("name")))
    mmol = hydrates.corrected_mmol(F.col("p_retailprice"), F.col("h.hydrated_weight")).cast("double")
    return parsed.select("p_partkey", "name", "h.base_formula", "h.hydration_number", "h.hydrate_formula", "h.base_id", F.round("h.hydrated_weight", 6).alias("hydrated_weight"), "h.confidence", "h.method", F.round(mmol, 2).alias("mmol"))


@query("hydration_distribution", f"""
WITH w AS (SELECT p_partkey, lower(trim(name)) AS c FROM {SPELLED})
SELECT coalesce({_number_sql(False)}, 0) AS waters, count(*) AS n FROM w GROUP BY 1""")
def hydration_distribution(t: Tables) -> DataFrame:
    return spelled(t).groupBy(F.coalesce(hydrates.hydration_number(F.col("name")), F.lit(0)).alias("waters")).agg(F.count(F.lit(1)).alias("n"))


#: Texts on which predicates differ.
_TEXTS = ["concat(initcap_name, ' chloride')", "concat('(', p_size, ') washed three times')", "p_name", "concat('Na', p_size, 'Cl')", "'Water'", "concat(p_name, ' extract')", "substr(p_name, 1, 3)", "concat(upper(p_name), ' Agar')", "''", "concat('(1983) ', p_name)"]
_TEXT_SQL = "CASE p_partkey % 10 " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(_TEXTS)) + " END"
TEXTS = f"(SELECT p_partkey, {_TEXT_SQL} AS name FROM (SELECT *, concat(upper(substr(p_name, 1, 1)), substr(p_name, 2)) AS initcap_name FROM part))"


def texts(t: Tables) -> DataFrame:
    return t.part.withColumn("initcap_name", F.expr("concat(upper(substr(p_name, 1, 1)), substr(p_name, 2))")).select("p_partkey", F.expr(_TEXT_SQL).alias("name"))


def _any(patterns: list[str], c: str = "c") -> str:
    return "(" + " OR ".join(f"regexp_matches({c}, '{p}')" for p in patterns) + ")"


_IS_COMPOUND = f"length(c) >= 2 AND NOT ({_any(predicates.PROCEDURE)} OR {contains_any_sql('c', predicates.PROCEDURE_WORDS)}) AND ({_any(predicates.COMPOUND_SHAPES)} OR length(c) >= 5)"


@query("name_predicates", f"""
WITH n AS (SELECT p_partkey, name, trim(name) AS c FROM {TEXTS})
SELECT p_partkey, name, lower(c) IN ('distilled water', 'water') AS water, length(c) > 0 AND NOT lower(c) IN ('distilled water', 'water') AS ingredient,
  {contains_any_sql('lower(name)', predicates.BIOLOGICAL)} AS biological, {_IS_COMPOUND} AS compound, length(c) > 2 AND NOT {contains_any_sql('lower(name)', predicates.NOT_DOWNLOADED)} AS candidate FROM n""")
def name_predicates(t: Tables) -> DataFrame:
    n = F.col("name")
    return texts(t).select("p_partkey", "name", predicates.is_water(n).alias("water"), predicates.is_ingredient(n).alias("ingredient"), predicates.is_biological(n).alias("biological"), predicates.is_compound(n).alias("compound"), predicates.is_download_candidate(n).alias("candidate"))


@query("clean_compounds", f"SELECT DISTINCT c AS name FROM (SELECT trim(name) AS c FROM {TEXTS}) WHERE {_IS_COMPOUND} ORDER BY c")
def clean_compounds(t: Tables) -> DataFrame:
    return texts(t).where(predicates.is_compound(F.col("name"))).select(F.trim("name").alias("name")).distinct().orderBy("name")


@query("suspect_hydrates", f"""
SELECT name AS original, mapped, count(*) AS n FROM (SELECT name, CASE WHEN p_partkey % 3 = 0 THEN 'ingredient:' WHEN p_partkey % 3 = 1 THEN 'CHEBI:' END || p_partkey % 7 AS mapped FROM {SPELLED})
WHERE regexp_matches(name, '(?i)H2O|hydrate') AND starts_with(mapped, 'ingredient:') GROUP BY 1, 2""")
def suspect_hydrates(t: Tables) -> DataFrame:
    mapped = F.concat(F.when(F.col("p_partkey") % 3 == 0, "ingredient:").when(F.col("p_partkey") % 3 == 1, "CHEBI:"), (F.col("p_partkey") % 7).cast("string"))
    return spelled(t).withColumn("mapped", mapped).where(predicates.is_suspect_hydrate(F.col("name"), F.col("mapped"))).groupBy(F.col("name").alias("original"), "mapped").agg(F.count(F.lit(1)).alias("n"))
