"""Queries on property sources, name indexes, repairs and nested media documents."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import aqueous, labels
from ..functions.chains import contains_any_sql, replaced_sql
from ..operators import assembly, lookups, media_documents, repairs, reports
from ..sources.scratch import scratch_path
from .media_queries import _FACTS, _PH, INGREDIENTS, property_rows
from .registry import Tables, query

# Names of every shape, told by a part's numbers; the SQL builds the same.

_HEADS = ["Sodium chloride", "glucose", "Calcium carbonate", "L-Glycine", "Boric acid", "Tris", "potassium phosphate", "Magnesium sulfate", "Sodium bicarbonate", "amino blend", "Copper acetate", "HCl", "agar", "Acid", "d-alanine"]
_TAILS = ["", " solution", " x 2 H2O", " (10% w/v)", " 5-hydrate", " (2.5% (w/v))", " monohydrate"]
_FORMULAS = ["NaCl", "C6H12O6", "CaCO3", "CaCl2", "MgSO4", "Na2Cl3Na", "", "K2HPO4", "NaHCO3", "C2H5NO2", "FeCl3Ca"]
_SMILES = ["CC(=O)O", "c1ccccc1O", "NCC(=O)O", "CP(=O)(O)O phosphate", "CS(=O)(=O)O", "[Na+].[Cl-]", "C[CH2]N", "CN(C)C"]


def _pick(values: list[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))


def _pick_sql(values: list[str], n: str) -> str:
    return "([" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"])[{n} % {len(values)} + 1]"


def _parts(t: Tables) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    return t.part.select("p_partkey", "p_size", "p_name", "p_retailprice", F.concat(_pick(_HEADS, k), _pick(_TAILS, s)).alias("name"), _pick(_FORMULAS, k + s).alias("formula"), _pick(_SMILES, k * 3 + s).alias("smiles"))


_PARTS = f"parts AS (SELECT p_partkey, p_size, p_name, p_retailprice, concat({_pick_sql(_HEADS, 'p_partkey')}, {_pick_sql(_TAILS, 'p_size')}) AS name, {_pick_sql(_FORMULAS, '(p_partkey + p_size)')} AS formula, {_pick_sql(_SMILES, '(p_partkey * 3 + p_size)')} AS smiles FROM part)"
_LISTED = lambda xs: f"{[float(x) for x in xs]}::DOUBLE[]"
_KNOWN_PKA = "CASE " + " ".join(f"WHEN contains(low, '{k}') OR contains('{k}', low) THEN {_LISTED(v)}" for k, v in aqueous.KNOWN_PKA.items()) + " " + " ".join(f"WHEN {contains_any_sql('low', n)} THEN {_LISTED(v)}" for n, v in aqueous.PKA_BY_WORD) + " ELSE []::DOUBLE[] END"
_SOLUBLE = (
    "CASE " + " ".join(f"WHEN contains(low, '{k}') THEN {v}" for k, v in aqueous.KNOWN_SOLUBILITY.items())
    + " WHEN contains(low, 'chloride') THEN 400 WHEN contains(low, 'sulfate') THEN 300 WHEN contains(low, 'carbonate') AND NOT contains(low, 'sodium') THEN 0.01 WHEN contains(low, 'phosphate') THEN 100"
    + f" WHEN {contains_any_sql('low', ['glucose', 'sucrose', 'fructose'])} THEN 1000 WHEN {contains_any_sql('low', ['glycine', 'alanine', 'amino'])} THEN 200 ELSE 100 END"
)
_WEIGHT = "CASE " + " ".join(f"WHEN contains(low, '{k}') THEN {v}" for k, v in aqueous.KNOWN_WEIGHT.items()) + " END"
_HAS = lambda e: f"regexp_matches(formula, '{e}([^a-z]|$)')"
_PAIRS = f"CASE WHEN {_HAS('Na')} AND {_HAS('Cl')} THEN 'Cl-:-1,Na+:1' WHEN {_HAS('Ca')} AND {_HAS('Cl')} THEN 'Ca2+:2,Cl-:-1' WHEN {_HAS('Mg')} AND contains(formula, 'SO4') THEN 'Mg2+:2,SO42-:-2' ELSE '' END"
_texts = lambda c: F.array_join(F.transform(c, lambda x: F.format_string("%.2f", x)), ",")
_TEXTS = lambda c: f"array_to_string(list_transform({c}, lambda x: printf('%.2f', x)), ',')"
_map_text = lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",")


@query("aqueous_properties", f"""
WITH {_PARTS}, l AS (SELECT *, lower(trim(name)) AS low FROM parts), p AS (SELECT *, {_KNOWN_PKA} AS pka FROM l)
SELECT p_partkey, name, formula, {_TEXTS('pka')} AS pka, CASE WHEN len(pka) = 0 THEN '0' ELSE array_to_string(range(1, -len(pka) - 1, -1), ',') END AS charges, ({_SOLUBLE})::DOUBLE AS solubility, {_PAIRS} AS pair_ions,
  array_to_string(list_sort(list_filter([{', '.join(f"CASE WHEN contains(formula, '{s}') THEN '{ion}:{z}' END" for s, ion, z in aqueous.FORMULA_IONS)}], lambda x: x IS NOT NULL)), ',') AS formula_ions FROM p""")
def aqueous_properties(t: Tables) -> DataFrame:
    pka = aqueous.known_pka(F.col("name"))
    ions = F.array_join(F.array_sort(F.transform(F.map_entries(aqueous.formula_ions(F.col("formula"))), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))), ",")
    return _parts(t).select("p_partkey", "name", "formula", _texts(pka).alias("pka"), F.array_join(aqueous.charge_ladder(pka).cast("array<string>"), ",").alias("charges"), aqueous.known_solubility(F.col("name")).alias("solubility"), _map_text(aqueous.pair_ions(F.col("formula"))).alias("pair_ions"), ions.alias("formula_ions"))


@query("structure_pka", f"""
WITH {_PARTS}
SELECT p_partkey, smiles, {_TEXTS("list_sort(list_distinct(list_filter([" + ', '.join([f"CASE WHEN regexp_matches(smiles, '{p}') THEN {v}::DOUBLE END" for p, v in aqueous.PKA_BY_STRUCTURE] + [f"CASE WHEN contains(lower(smiles), 'phosphate') THEN {v}::DOUBLE END" for v in aqueous.PHOSPHATE_PKA]) + "], lambda x: x IS NOT NULL)))")} AS pka FROM parts""")
def structure_pka(t: Tables) -> DataFrame:
    return _parts(t).select("p_partkey", "smiles", _texts(aqueous.structure_pka(F.col("smiles"))).alias("pka"))


@query("last_element_counts", f"""
WITH {_PARTS}, f AS (SELECT DISTINCT formula FROM parts WHERE formula <> ''),
e AS (SELECT formula, unnest(regexp_extract_all(formula, '[A-Z][a-z]?\\d*')) AS token, unnest(range(len(regexp_extract_all(formula, '[A-Z][a-z]?\\d*')))) AS i FROM f),
s AS (SELECT formula, i, regexp_extract(token, '^[A-Za-z]+') AS element, coalesce(try_cast(regexp_extract(token, '\\d+$') AS INTEGER), 1) AS n FROM e)
SELECT formula, element, arg_max(n, i) AS n FROM s GROUP BY 1, 2""")
def last_element_counts(t: Tables) -> DataFrame:
    formulas = _parts(t).select("formula").where("formula <> ''").distinct()
    return formulas.select("formula", F.explode(aqueous.last_counts(F.col("formula"))).alias("element", "n"))


_RAW = f"""{_PARTS}, raw AS (SELECT trim(name) AS name, formula, CASE WHEN p_size % 3 = 0 THEN 0.0 WHEN p_size % 3 = 1 THEN p_retailprice END AS molecular_weight, CASE WHEN p_size % 4 = 0 THEN p_size::DOUBLE END AS solubility,
  CASE WHEN p_size % 2 = 0 THEN 'first' ELSE 'second' END AS source, CASE WHEN p_size % 5 = 0 THEN [1.5, p_size] ELSE []::DOUBLE[] END AS pka_values, p_partkey AS pos FROM parts),
kept AS (SELECT *, lower(name) AS low FROM raw QUALIFY row_number() OVER (PARTITION BY lower(name) ORDER BY pos) = 1)"""


def _raw(t: Tables) -> DataFrame:
    s = F.col("p_size")
    return _parts(t).select("name", "formula", F.when(s % 3 == 0, 0.0).when(s % 3 == 1, F.col("p_retailprice")).alias("molecular_weight"), F.when(s % 4 == 0, s.cast("double")).alias("solubility"), F.when(s % 2 == 0, "first").otherwise("second").alias("source"), F.when(s % 5 == 0, F.array(F.lit(1.5), s.cast("double"))).otherwise(F.array().cast("array<double>")).alias("pka_values"), F.col("p_partkey").alias("pos"))


@query("assembled_by_source", f"""
WITH {_RAW}, p AS (SELECT *, {_KNOWN_PKA} AS pka FROM kept)
SELECT replace(low, ' ', '_') AS compound_name, coalesce(nullif(molecular_weight, 0), {_WEIGHT}, 100)::DOUBLE AS molecular_weight, {_TEXTS('pka')} AS pka, {_PAIRS} AS ions, coalesce(nullif(solubility, 0), {_SOLUBLE})::DOUBLE AS solubility, formula, source FROM p""")
def assembled_by_source(t: Tables) -> DataFrame:
    return assembly.by_source(_raw(t)).select("compound_name", "molecular_weight", _texts(F.col("pka_values")).alias("pka"), _map_text(F.col("ion_charges")).alias("ions"), F.col("solubility_g_per_L").alias("solubility"), "formula", "source")


@query("assembled_from_list", f"""
WITH {_RAW}, p AS (SELECT *, CASE WHEN len(pka_values) > 0 THEN pka_values WHEN formula <> '' THEN {_KNOWN_PKA} ELSE []::DOUBLE[] END AS pka FROM kept)
SELECT name AS compound_name, coalesce(nullif(molecular_weight, 0), 100)::DOUBLE AS molecular_weight, {_TEXTS('pka')} AS pka, CASE WHEN len(pka) = 0 THEN '0' ELSE array_to_string(range(1, -len(pka) - 1, -1), ',') END AS charges, coalesce(solubility, {_SOLUBLE})::DOUBLE AS solubility, concat(source, ', other') AS source FROM p""")
def assembled_from_list(t: Tables) -> DataFrame:
    rows = assembly.from_list(_raw(t).withColumn("sources", F.array("source", F.lit("other"))), parity=True)
    return rows.select("compound_name", "molecular_weight", _texts(F.col("pka_values")).alias("pka"), F.array_join(F.col("charge_states").cast("array<string>"), ",").alias("charges"), F.col("solubility_g_per_L").alias("solubility"), "source")


_CURATED = "(VALUES " + ", ".join(str(r) for r in aqueous.CURATED) + ") c(name, formula, weight, solubility)"


@query("coalesced_sources", f"""
WITH {_PARTS}, a AS (SELECT lower(trim(name)) AS key, min(CASE WHEN p_size % 3 > 0 THEN nullif(formula, '') END) AS formula FROM parts WHERE p_partkey % 2 = 0 GROUP BY 1),
b AS (SELECT lower(trim(name)) AS key, max(p_retailprice) AS weight FROM parts WHERE p_partkey % 3 = 0 GROUP BY 1), n AS (SELECT DISTINCT name FROM parts)
SELECT n.name, coalesce(a.formula, c.formula) AS formula, coalesce(b.weight, c.weight)::DOUBLE AS weight, c.solubility::DOUBLE AS solubility, concat_ws(',', CASE WHEN a.key IS NOT NULL THEN 'first' END, CASE WHEN b.key IS NOT NULL THEN 'second' END, CASE WHEN c.name IS NOT NULL THEN 'curated' END) AS sources
FROM n LEFT JOIN a ON lower(trim(n.name)) = a.key LEFT JOIN b ON lower(trim(n.name)) = b.key LEFT JOIN {_CURATED} ON lower(trim(n.name)) = c.name WHERE a.key IS NOT NULL OR b.key IS NOT NULL OR c.name IS NOT NULL""")
def coalesced_sources(t: Tables) -> DataFrame:
    parts, k = _parts(t), F.col("p_partkey")
    key = F.lower(F.trim("name")).alias("name")
    first = parts.where(k % 2 == 0).groupBy(key).agg(F.min(F.when(F.col("p_size") % 3 > 0, F.nullif("formula", F.lit("")))).alias("formula"))
    second = parts.where(k % 3 == 0).groupBy(key).agg(F.max("p_retailprice").alias("weight"))
    curated = t.spark.createDataFrame(aqueous.CURATED, "name string, formula string, weight double, solubility double")
    found = lookups.coalesced_sources(parts, {"first": first, "second": second, "curated": curated}, ["formula", "weight", "solubility"])
    return found.withColumn("sources", F.array_join("sources", ","))


_INDEX = """i AS (SELECT lower(trim(concat(p_name, ' ', p_size % 7))) AS key, p_partkey::VARCHAR AS cid, 1 AS tier, p_partkey AS pos FROM part UNION ALL SELECT lower(trim(concat(p_name, ' ', p_size % 11))), concat('s', p_partkey), 0, -p_partkey FROM part),
x AS (SELECT key, cid FROM i QUALIFY row_number() OVER (PARTITION BY key ORDER BY tier DESC, pos DESC) = 1)"""


def _index(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    named = lambda n, cid: t.part.select(cid.alias("cid"), F.concat(F.initcap("p_name"), F.lit(" "), (F.col("p_size") % n).cast("string")).alias("name"), k.alias("pos"))
    return lookups.name_index(named(7, k.cast("string")), named(11, F.concat(F.lit("s"), k.cast("string"))))


@query("name_index", f"WITH {_INDEX} SELECT * FROM x")
def name_index(t: Tables) -> DataFrame:
    return _index(t)


@query("name_lookup", f"WITH {_INDEX}, a AS (SELECT l_orderkey, l_linenumber, concat(upper(p_name), ' ', l_linenumber * 2) AS name FROM lineitem JOIN part ON l_partkey = p_partkey) SELECT l_orderkey, l_linenumber, name, cid FROM a LEFT JOIN x ON lower(name) = key")
def name_lookup(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "name-index")
    lookups.write_index(_index(t), path)
    asked = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", F.concat(F.upper("p_name"), F.lit(" "), (F.col("l_linenumber") * 2).cast("string")).alias("name"))
    return lookups.looked_up(asked, t.spark.read.parquet(path), "name").select("l_orderkey", "l_linenumber", "name", "cid")


@query("name_files", "SELECT p_partkey::VARCHAR AS cid, concat(p_name, ' ', p_size) AS name FROM part")
def name_files(t: Tables) -> DataFrame:
    """Packed tab-separated files of ids and names, written and read back."""
    path = scratch_path(t.spark, "names")
    t.part.select(F.concat_ws("\t", F.col("p_partkey").cast("string"), F.concat(F.col("p_name"), F.lit(" "), F.col("p_size").cast("string")))).write.option("compression", "gzip").text(path)
    return lookups.named_ids(t.spark, path).select("cid", "name")


@query("label_keys", f"WITH {_PARTS} SELECT p_partkey, name, trim({replaced_sql('lower(trim(name))', labels.LABEL_CHAIN)}) AS label, nullif(regexp_extract(name, '{labels.FORMULA}'), '') AS formula FROM parts")
def label_keys(t: Tables) -> DataFrame:
    return _parts(t).select("p_partkey", "name", labels.label_key(F.col("name")).alias("label"), labels.formula_in(F.col("name")).alias("formula"))


_STRENGTH_SQL = "CASE " + " ".join(f"WHEN regexp_matches(name, '{p}') THEN trim(regexp_replace(name, '{p}', '', 'g'))" for p in labels.STRENGTH) + " ELSE name END"


@query("repaired_strengths", f"WITH {_PARTS} SELECT p_partkey, {_STRENGTH_SQL} AS original, {_STRENGTH_SQL} AS base_compound FROM parts")
def repaired_strengths(t: Tables) -> DataFrame:
    return repairs.repaired_strengths(_parts(t).select("p_partkey", F.col("name").alias("original"), F.col("name").alias("base_compound")))


_SALTS = ["K-acetate", "Na-acetate", "k-acetate x 2", "Mg-citrate", "Ca-lactate"]
_SALT_LABELS = ["sodium acetate", "potassium acetate", "magnesium citrate", "calcium lactate", ""]
_SALT_IDS = ["CHEBI:88550", "CHEBI:32047", "CHEBI:1"]


@query("repaired_acetate", f"""
WITH r AS (SELECT p_partkey, {_pick_sql(_SALTS, 'p_partkey')} AS original, {_pick_sql(_SALT_IDS, 'p_size')} AS id, ([2, 0, NULL])[p_size % 3 + 1] AS w, p_retailprice AS mw FROM part),
b AS (SELECT *, lower(original) LIKE '%k-acetate%' AND id = 'CHEBI:88550' AS bad FROM r)
SELECT p_partkey, original, CASE WHEN bad THEN 'CHEBI:32047' ELSE id END AS base_chebi_id, CASE WHEN bad THEN 98.1 ELSE mw END::DOUBLE AS base_molecular_weight, CASE WHEN bad AND w > 0 THEN 18.015 * w END::DOUBLE AS water_molecular_weight, CASE WHEN bad THEN 98.1 + 18.015 * coalesce(w, 0) ELSE mw END::DOUBLE AS hydrated_molecular_weight FROM b""")
def repaired_acetate(t: Tables) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    rows = t.part.select("p_partkey", _pick(_SALTS, k).alias("original"), _pick(_SALT_IDS, s).alias("mapped"), _pick(_SALT_IDS, s).alias("base_chebi_id"), F.lit("x").alias("base_chebi_label"), F.lit("y").alias("base_chebi_formula"), F.col("p_retailprice").alias("base_molecular_weight"), F.lit(None).cast("double").alias("water_molecular_weight"), F.col("p_retailprice").alias("hydrated_molecular_weight"), F.element_at(F.array(F.lit("2"), F.lit("0"), F.lit(None)), (s % 3 + 1).cast("int")).alias("water_molecules"))
    return repairs.repaired_acetate(rows).select("p_partkey", "original", "base_chebi_id", "base_molecular_weight", "water_molecular_weight", "hydrated_molecular_weight")


_METALS = "(VALUES ('na-', 'sodium'), ('k-', 'potassium'), ('ca-', 'calcium'), ('mg-', 'magnesium')) m(prefix, metal)"


@query("salt_issues", f"""
WITH r AS (SELECT p_partkey, {_pick_sql(_SALTS, 'p_partkey')} AS original, {_pick_sql(_SALT_LABELS, 'p_size')} AS label FROM part)
SELECT original, label AS base_chebi_label, metal AS expected, count(*) AS n FROM r JOIN {_METALS} ON contains(lower(original), prefix) WHERE label <> '' AND NOT contains(label, metal) AND regexp_matches(label, 'sodium|potassium|calcium|magnesium') GROUP BY 1, 2, 3""")
def salt_issues(t: Tables) -> DataFrame:
    rows = t.part.select(_pick(_SALTS, F.col("p_partkey")).alias("original"), _pick(_SALT_LABELS, F.col("p_size")).alias("base_chebi_label"))
    return repairs.salt_issues(rows).groupBy("original", "base_chebi_label", "expected").agg(F.count(F.lit(1)).alias("n"))


_ODD_NAMES = ["A", "KB", "Kb", "12.5", " x ", "NaCl", "beef extract", "Étuve"]


@query("without_ontology_id", f"""
WITH r AS (SELECT CASE WHEN p_size % 3 = 0 THEN p_name ELSE {_pick_sql(_ODD_NAMES, 'p_partkey')} END AS original, ([NULL, 'CHEBI:1', 'CAS-RN:2'])[p_size % 3 + 1] AS mapped FROM part)
SELECT DISTINCT original FROM r WHERE coalesce(NOT starts_with(mapped, 'CHEBI:'), true) AND length(trim(original)) > 1 AND NOT regexp_full_match(trim(original), '[A-Z]{{2}}') AND regexp_matches(original, '\\pL')""")
def without_ontology_id(t: Tables) -> DataFrame:
    s = F.col("p_size")
    rows = t.part.select(F.when(s % 3 == 0, F.col("p_name")).otherwise(_pick(_ODD_NAMES, F.col("p_partkey"))).alias("original"), F.element_at(F.array(F.lit(None), F.lit("CHEBI:1"), F.lit("CAS-RN:2")), (s % 3 + 1).cast("int")).alias("mapped"))
    return repairs.without_ontology_id(rows)


_STATES, _WATERS = ["hydrated", "anhydrous", "already_mapped"], ["2", "", "nan", "x", "3.0", "n"]


@query("final_schema", f"""
WITH r AS (SELECT p_partkey, {_pick_sql(_STATES, 'p_partkey')} AS state, {_pick_sql(_WATERS, 'p_size')} AS w FROM part)
SELECT p_partkey, CASE WHEN state = 'already_mapped' THEN 'anhydrous' ELSE state END AS hydration_state, CASE WHEN w IN ('', 'nan') THEN '0' WHEN w = 'x' THEN 'x' ELSE coalesce(try_cast(w AS DOUBLE)::BIGINT::VARCHAR, w) END AS water_molecules FROM r""")
def final_schema(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", _pick(_STATES, F.col("p_partkey")).alias("hydration_state"), F.lit("old").alias("water_molecules"), F.lit("gone").alias("hydration_number_extracted"), _pick(_WATERS, F.col("p_size")).alias("hydration_number"))
    return repairs.final_schema(rows)


_HYDRATES, _ANY_IDS = ["CaCl2•2H2O", "MgSO4*7H2O", "NaCl", "FeSO4⋅7H2O"], ["CHEBI:1", "", "CAS-RN:2", "kg:3"]


@query("repaired_states", f"""
WITH r AS (SELECT p_partkey, {_pick_sql(_HYDRATES, 'p_partkey')} AS f, {_pick_sql(_ANY_IDS, 'p_size')} AS id, {_pick_sql(_STATES, '(p_partkey + p_size)')} AS state FROM part),
m AS (SELECT *, regexp_matches(id, '^(CHEBI:|PubChem:|CAS-RN:)') AND state IN ('hydrated', 'anhydrous') AS mapped FROM r)
SELECT p_partkey, regexp_replace(f, '[•*⋅]', '·', 'g') AS hydrate_formula, CASE WHEN mapped THEN 'already_mapped' ELSE state END AS hydration_state, CASE WHEN mapped THEN 'CaCl2 x 2 H2O' ELSE 'b' END AS base_compound_for_mapping, CASE WHEN mapped OR state = 'already_mapped' THEN 'CaCl2' ELSE 'CaCl2 2 H2O' END AS base_compound FROM m""")
def repaired_states(t: Tables) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    rows = t.part.select("p_partkey", F.lit("CaCl2 x 2 H2O").alias("original"), _pick(_ANY_IDS, s).alias("mapped"), _pick(_HYDRATES, k).alias("hydrate_formula"), _pick(_STATES, k + s).alias("hydration_state"), F.lit("b").alias("base_compound_for_mapping"), F.lit("CaCl2 2 H2O").alias("base_compound"))
    return repairs.repaired_states(rows).select("p_partkey", "hydrate_formula", "hydration_state", "base_compound_for_mapping", "base_compound")


@query("strategy_counts", "SELECT l_orderkey, array_to_string(list_sort(list(concat(l_shipmode, ':', n))), ',') AS strategies FROM (SELECT l_orderkey, coalesce(nullif(concat('m', l_linenumber % 3), 'm0'), 'unknown') AS l_shipmode, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def strategy_counts(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", F.nullif(F.concat(F.lit("m"), (F.col("l_linenumber") % 3).cast("string")), F.lit("m0")).alias("extraction_method"))
    return reports.strategy_counts(rows, "l_orderkey").select("l_orderkey", _map_text(F.col("strategies")).alias("strategies"))


_OUTCOMES = ["processed", "failed", "empty", "unprocessed", "downloaded"]


@query("run_statistics", f"""
WITH r AS (SELECT {_pick_sql(_OUTCOMES, 'user_id')} AS status FROM events)
SELECT count(*) AS total, count(*) FILTER (status IN ('processed', 'unprocessed', 'downloaded')) AS downloads, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'empty') AS empty, count(*) FILTER (status = 'processed') AS processed, count(*) FILTER (status = 'unprocessed') AS unprocessed,
  round(100.0::DOUBLE * downloads / total, 1) AS download_rate, round(100.0::DOUBLE * processed / total, 1) AS processing_rate FROM r""")
def run_statistics(t: Tables) -> DataFrame:
    return reports.run_statistics(t.events.select(_pick(_OUTCOMES, F.col("user_id")).alias("status")))


# A medium's document for each order: the list of its lines as JSON, text that is no JSON, or JSON that is no list.

#: Lines of a task that makes documents of them and reads these: their bytes are few and the work on them is long.
LINES_A_TASK = 250_000


def _medium_documents(t: Tables) -> DataFrame:
    line = F.struct("l_linenumber", _pick(INGREDIENTS, F.col("l_partkey")).alias("compound"), (F.col("l_quantity") / 10).alias("g_l"))
    tasks = max(t.spark.sparkContext.defaultParallelism, math.ceil(t.lineitem.count() / LINES_A_TASK))
    dealt = t.lineitem.select(F.col("l_orderkey").alias("medium_id"), "l_partkey", "l_linenumber", "l_quantity").repartition(tasks, "medium_id")
    lines = dealt.groupBy("medium_id").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    listed = F.to_json(F.transform("lines", lambda x: F.struct(x["compound"].alias("compound"), x["g_l"].alias("g_l"))))
    kind = F.col("medium_id") % 10
    return lines.select("medium_id", F.when(kind == 7, F.substring(listed, F.lit(1), F.length(listed) - 1)).when(kind == 8, '{"name": "no list"}').otherwise(listed).alias("content"))


_DOCUMENT_SQL = f"""
WITH {_FACTS}, ok AS (SELECT * FROM sums WHERE medium_id % 10 NOT IN (7, 8)),
d AS (SELECT *, {_PH} AS ph, CASE WHEN buffers = 0 THEN 0.5 ELSE least(1.5, 0.5::DOUBLE + 0.1::DOUBLE * buffers + CASE WHEN buffering < 0.001 THEN 0.3 ELSE 0.0 END::DOUBLE) END::DOUBLE AS doubt FROM ok),
l AS (SELECT medium_id, array_to_string(list(compound ORDER BY line, compound) FILTER (own_weight IS NOT NULL), '; ') AS recognized_list FROM (SELECT l_orderkey AS medium_id, l_linenumber AS line, compound, own_weight FROM lineitem JOIN facts f ON l_partkey % {len(INGREDIENTS)} = f.i) GROUP BY 1),
m AS (SELECT DISTINCT l_orderkey AS medium_id FROM lineitem)
SELECT m.medium_id, round(ph, 2) AS ph_value, round(ph - doubt, 2) AS ph_range_min, CASE WHEN d.medium_id IS NULL THEN 'none' WHEN doubt < 0.3 THEN 'high' WHEN doubt < 0.7 THEN 'medium' ELSE 'low' END AS ph_confidence, round(tds, 2) AS tds,
  concat(recognized, '/', nullif(n, 0)) AS compounds_recognized, CASE WHEN d.medium_id IS NULL THEN '' ELSE coalesce(recognized_list, '') END AS recognized_compounds_list, coalesce(recognized, 0)::INTEGER AS recognized_compounds_count,
  CASE WHEN d.medium_id IS NULL THEN 0 ELSE (estimated > 0)::INTEGER + (recognized + estimated < n)::INTEGER + (round(strength, 6) > 0.1)::INTEGER + (round(strength, 6) < 0.001)::INTEGER END AS notes_count
FROM m LEFT JOIN d USING (medium_id) LEFT JOIN l USING (medium_id)"""


def _flat(documents: DataFrame) -> DataFrame:
    return media_documents.flattened(documents).select("medium_id", "ph_value", "ph_range_min", "ph_confidence", F.col("total_dissolved_solids_value").alias("tds"), "compounds_recognized", "recognized_compounds_list", "recognized_compounds_count", "notes_count")


@query("media_documents", _DOCUMENT_SQL.replace("concat(recognized, '/', nullif(n, 0))", "CASE WHEN n > 0 THEN concat(recognized, '/', n) END"))
def nested_media(t: Tables) -> DataFrame:
    return _flat(media_documents.analysed(_medium_documents(t), property_rows(t)))


@query("media_document_files", _DOCUMENT_SQL.replace("concat(recognized, '/', nullif(n, 0))", "CASE WHEN n > 0 THEN concat(recognized, '/', n) END"))
def media_document_files(t: Tables) -> DataFrame:
    """Documents as JSON texts, one a medium, packed in files, and back to flat rows by the id in a text's name."""
    from ..sources.writers import packed_files

    folder = scratch_path(t.spark, "media")
    found = media_documents.as_json(media_documents.analysed(_medium_documents(t), property_rows(t)))
    packed_files(found.select(F.concat(F.lit("medium_"), F.col("medium_id").cast("string"), F.lit("_composition_properties.json")).alias("file_name"), "content"), folder)
    return _flat(media_documents.read_documents(t.spark, folder, packed=True).withColumn("medium_id", F.col("medium_id").cast("long")))


@query("sorted_lookups", r"""
WITH w AS (SELECT lower(w) AS key, min(doc_id) AS cid FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w FROM documents) GROUP BY 1),
a AS (SELECT item_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+')[1] AS word FROM benchmark UNION ALL SELECT -p_partkey, p_name FROM part)
SELECT item_id, word, cid::VARCHAR AS cid FROM a LEFT JOIN w ON key = lower(word)""")
def sorted_lookups(t: Tables) -> DataFrame:
    """First words of benchmark items and names of parts, looked up in a sorted index of all words of the documents."""
    word = F.lit(r"[^\x20\x09-\x0D]+")
    words = t.documents.select("doc_id", F.explode(F.regexp_extract_all("text", word, 0)).alias("w"))
    index = words.groupBy(F.lower("w").alias("key")).agg(F.min("doc_id").cast("string").alias("cid"))
    path = scratch_path(t.spark, "sorted-index")
    lookups.write_sorted_index(index, path, 32)
    asked = t.benchmark.select("item_id", F.get(F.regexp_extract_all("text", word, 0), F.lit(0)).alias("word")).unionByName(t.part.select((-F.col("p_partkey")).alias("item_id"), F.col("p_name").alias("word")))
    return lookups.sorted_lookup(asked, path, "word").select("item_id", "word", "cid")
