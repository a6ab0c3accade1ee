"""Chemistry of media: orders stand for media and their lines for ingredients."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import chemistry, names, nested
from ..functions.chains import contains_any_sql, replaced_sql
from ..operators import properties, reports
from .registry import Tables, query

#: Ingredient names; which one a line has is told by its part.
INGREDIENTS = [
    "Sodium chloride", "Glucose", "KCl", "MgCl2 x 6 H2O", "yeast extract", "dipotassium phosphate", "Tris", "Na2-fumarate", "potassium nitrate", "calcium chloride hydrate",
    "zinc sulfate", "citric acid", "Ammonium acetate", "peptone", "vitamin B12", "agar", "Na2SO4", "disodium fumarate", "L-Glycine", "Magnesium chloride",
]

#: Properties in their text form.
PROPERTIES = [
    ("NaCl", 58.44, "", "0", "Na+:1,Cl-:-1"), ("KCl", 74.55, "", "0", "K+:1,Cl-:-1"), ("MgCl2", 95.21, "", "0", "Mg2+:2,Cl-:-1"), ("CaCl2", 110.98, "", "0", "Ca2+:2,Cl-:-1"),
    ("Na2SO4", 142.04, "", "0", "Na+:1,SO42-:-2"), ("K2HPO4", 174.18, "2.15,7.20,12.35", "-2,-1,0", "K+:1,HPO42-:-2"), ("glucose", 180.16, "", "0", ""),
    ("glycine", 75.07, "2.34, 9.60", "-1,0,1", ""), ("tris", 121.14, "8.07", "0,1", "TrisH+:1"),
]
_COLUMNS = "compound_name string, molecular_weight double, pka_values string, charge_states string, ion_charges string"


def compositions(t: Tables) -> DataFrame:
    pick = F.element_at(F.array(*map(F.lit, INGREDIENTS)), (F.col("l_partkey") % len(INGREDIENTS) + 1).cast("int"))
    return t.lineitem.select(F.col("l_orderkey").alias("medium_id"), pick.alias("compound"), (F.col("l_quantity") / 10).alias("g_l"))


def property_rows(t: Tables) -> DataFrame:
    return properties.property_table(t.spark.createDataFrame(PROPERTIES, _COLUMNS))


_LIST = "[" + ", ".join(f"'{n}'" for n in INGREDIENTS) + "]"
_SYN = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.PROPERTY_SYNONYMS.items())


def _numbers(text: str) -> list[float]:
    return [float(x) for x in text.split(",") if x.strip()]


def _known(value) -> str:
    return "CASE key " + " ".join(f"WHEN '{r[0].lower()}' THEN {value(r)}" for r in PROPERTIES) + " END"


def _charge_sum(key: str, ions: str) -> float:
    total = 0.0
    for pair in filter(None, ions.split(",")):
        ion, z = pair.split(":")
        total += int(z) ** 2 * (2 if ion == properties.DOUBLED.get(key) else 1)
    return total


def _buffering(pka: list[float]) -> float:
    return sum(math.exp(-abs(7 - p)) for p in pka)


_DOUBLES = lambda xs: f"{[float(x) for x in xs]}::DOUBLE[]"
_ESTIMATED = lambda f: chemistry.estimate_case_sql("name", f)
_FACTS = f"""
names AS (SELECT i, n AS compound, trim(lower(n)) AS name FROM (SELECT unnest(range(len({_LIST}))) AS i, unnest({_LIST}) AS n)),
keys AS (SELECT *, {replaced_sql('name', names.PROPERTY_CHAIN)} AS k FROM names), keyed AS (SELECT *, CASE k {_SYN} ELSE k END AS key FROM keys),
facts AS (SELECT *, {_known(lambda r: r[1])}::DOUBLE AS own_weight,
  coalesce({_known(lambda r: r[1])}, {_ESTIMATED(lambda r: r.weight)})::DOUBLE AS weight,
  coalesce({_known(lambda r: len(_numbers(r[2])))}, {_ESTIMATED(lambda r: len(r.pka))}) AS n_pka,
  coalesce({_known(lambda r: sum(_numbers(r[2])))}, {_ESTIMATED(lambda r: sum(r.pka))})::DOUBLE AS pka_sum,
  coalesce({_known(lambda r: _buffering(_numbers(r[2])))}, {_ESTIMATED(lambda r: _buffering(r.pka))})::DOUBLE AS buffer, coalesce({_known(lambda r: str(bool(r[4])))}, false) AS ionic,
  coalesce({_known(lambda r: _DOUBLES(_numbers(r[2])))}, {_ESTIMATED(lambda r: _DOUBLES(r.pka))}) AS pka, coalesce({_known(lambda r: _DOUBLES(_numbers(r[3])))}, {_ESTIMATED(lambda r: _DOUBLES(r.charges))}) AS charges,
  coalesce({_known(lambda r: _charge_sum(r[0].lower(), r[4]))}, {_ESTIMATED(lambda r: sum(z * z for z in r.ions.values()))})::DOUBLE AS charge_sum FROM keyed),
lines AS (SELECT l_orderkey AS medium_id, f.*, l_quantity / 10 AS g_l, l_quantity / 10 / weight AS molar FROM lineitem JOIN facts f ON l_partkey % {len(INGREDIENTS)} = f.i),
sums AS (SELECT medium_id, sum(g_l) AS tds, greatest(coalesce(sum(0.5 * molar * charge_sum), 0), 1e-7) AS strength, count(*) FILTER (molar > 0 AND n_pka > 0) AS buffers,
  sum(molar * pka_sum) FILTER (molar > 0 AND n_pka > 0) AS ps, sum(molar * n_pka) FILTER (molar > 0 AND n_pka > 0) AS pw, sum(molar * buffer) FILTER (molar > 0 AND n_pka > 0) AS buffering, count(*) FILTER (own_weight IS NOT NULL AND key <> 'nacl' AND ionic) AS salts,
  list({{'m': molar, 'k': pka, 'z': charges}}) FILTER (molar > 0 AND n_pka > 0) AS acids, count(*) AS n, count(own_weight) AS recognized,
  count(*) FILTER (own_weight IS NULL AND weight IS NOT NULL) AS estimated FROM lines GROUP BY medium_id)"""
_PH = "CASE WHEN buffers = 0 THEN 7.0 ELSE least(13.0, greatest(1.0, CASE WHEN buffers > 1 THEN 0.7 * (ps / pw) + 0.3 * 7.0 ELSE ps / pw END)) END"


@query("media_summary", f"""
WITH {_FACTS}
SELECT medium_id, round({_PH}, 2) AS ph, CASE WHEN doubt < 0.3 THEN 'high' WHEN doubt < 0.7 THEN 'medium' ELSE 'low' END AS ph_confidence, CASE WHEN salt_doubt < 0.02 THEN 'high' WHEN salt_doubt < 0.05 THEN 'medium' ELSE 'low' END AS salinity_confidence, round(0.013 * pow(strength, 0.9) / 0.0126 / (1000 + tds) * 100, 4) AS salinity_percent, round(strength, 6) AS ionic_strength, round(tds, 2) AS total_dissolved_solids,
  round(100.0::DOUBLE * recognized / n, 1) AS compounds_recognized, round(100.0::DOUBLE * estimated / n, 1) AS compounds_estimated, round(100.0::DOUBLE * (recognized + estimated) / n, 1) AS total_coverage
FROM (SELECT *, CASE WHEN buffers = 0 THEN 0.5 ELSE least(1.5, 0.5::DOUBLE + 0.1::DOUBLE * buffers + CASE WHEN buffering < 0.001 THEN 0.3 ELSE 0.0 END::DOUBLE) END::DOUBLE AS doubt,
  least(0.1, 0.01::DOUBLE + CASE WHEN strength < 0.001 THEN 0.005 ELSE 0.0 END::DOUBLE + 0.005::DOUBLE * salts)::DOUBLE AS salt_doubt FROM sums)""")
def media_summary(t: Tables) -> DataFrame:
    return properties.media_summary(compositions(t), property_rows(t))


@query("media_notes", f"""
WITH {_FACTS},
m AS (SELECT medium_id, strength, estimated, n, recognized FROM sums)
SELECT note, count(*) AS media FROM (
  SELECT 'estimated compounds add uncertainty' AS note FROM m WHERE estimated > 0 UNION ALL SELECT 'unaccounted compounds may change pH and salinity' FROM m WHERE recognized + estimated < n
  UNION ALL SELECT 'high ionic strength' FROM m WHERE round(strength, 6) > 0.1 UNION ALL SELECT 'low ionic strength, results are less certain' FROM m WHERE round(strength, 6) < 0.001) GROUP BY note""")
def media_notes(t: Tables) -> DataFrame:
    noted = properties.notes(properties.media_summary(compositions(t), property_rows(t)))
    return noted.select(F.explode("notes").alias("note")).groupBy("note").agg(F.count(F.lit(1)).alias("media"))


@query("compound_accounts", f"""
WITH {_FACTS}
SELECT compound, CASE WHEN own_weight IS NOT NULL THEN 'recognized' WHEN weight IS NOT NULL THEN 'estimated' ELSE 'unaccounted' END AS account, count(*) AS frequency FROM lines GROUP BY 1, 2""")
def compound_accounts(t: Tables) -> DataFrame:
    return properties.ingredients(compositions(t), property_rows(t)).groupBy("compound", "account").agg(F.count(F.lit(1)).alias("frequency"))


@query("media_statistics", f"""
WITH {_FACTS},
v AS (SELECT {_PH} AS ph, tds FROM sums)
SELECT 'ph' AS metric, round(avg(p), 6) AS mean, round(stddev_samp(p), 6) AS std, min(p) AS least, max(p) AS most FROM (SELECT round(ph, 2) AS p FROM v)
UNION ALL SELECT 'total_dissolved_solids', round(avg(p), 6), round(stddev_samp(p), 6), min(p), max(p) FROM (SELECT round(tds, 2) AS p FROM v)""")
def media_statistics(t: Tables) -> DataFrame:
    summary = properties.media_summary(compositions(t), property_rows(t))
    return reports.described(summary, ["ph", "total_dissolved_solids"]).withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


_FORM = "pow(10.0::DOUBLE, i * mid - coalesce(list_sum(a.k[1:i]), 0))"
_GAMMA = f"pow(10.0::DOUBLE, -{chemistry.DEBYE}::DOUBLE * a.z[i + 1] * a.z[i + 1] * (sqrt(strength) / (1 + sqrt(strength)) - {chemistry.DAVIES_SLOPE}::DOUBLE * strength))"


@query("media_ph_by_charge_balance", f"""
WITH RECURSIVE {_FACTS},
m AS (SELECT medium_id, strength, coalesce(acids, []) AS acids FROM sums),
b AS (SELECT medium_id, 0.5::DOUBLE AS lo, 14.0::DOUBLE AS hi, 0 AS step FROM m UNION ALL
  SELECT medium_id, CASE WHEN f > 0 THEN mid ELSE lo END, CASE WHEN f > 0 THEN hi ELSE mid END, step + 1 FROM (
    SELECT medium_id, lo, hi, mid, step, pow(10.0::DOUBLE, -mid) - pow(10.0::DOUBLE, mid - 14) + coalesce(list_sum(list_transform(acids, lambda a: a.m
      * list_sum(list_transform(range(least(len(a.z), len(a.k) + 1)), lambda i: a.z[i + 1] * {_GAMMA} * {_FORM})) / list_sum(list_transform(range(len(a.k) + 1), lambda i: {_FORM})))), 0) AS f
    FROM (SELECT *, (lo + hi) / 2 AS mid FROM b JOIN m USING (medium_id) WHERE step < 60)))
SELECT m.medium_id, round(CASE WHEN len(acids) = 0 THEN 7.0 ELSE (lo + hi) / 2 END, 3) AS ph, round(CASE WHEN len(acids) = 0 THEN 0.5 ELSE least(1.0, 0.1::DOUBLE + 0.05::DOUBLE * len(acids) + 0.1::DOUBLE * sqrt(strength)) END, 4) AS ph_uncertainty
FROM m JOIN b USING (medium_id) WHERE step = 60""")
def media_ph_by_charge_balance(t: Tables) -> DataFrame:
    return properties.charge_balance_ph(compositions(t), property_rows(t))


@query("ionic_strength", "SELECT l_orderkey AS medium_id, round(greatest(sum(0.5 * l_quantity / p_retailprice * (l_linenumber % 4) * (l_linenumber % 4)), 1e-7), 6) AS ionic_strength FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def ionic_strength(t: Tables) -> DataFrame:
    z = F.col("l_linenumber") % 4
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy(F.col("l_orderkey").alias("medium_id")).agg(F.round(F.greatest(F.sum(0.5 * F.col("l_quantity") / F.col("p_retailprice") * z * z), F.lit(1e-7)), 6).alias("ionic_strength"))


@query("davies_activity", """
SELECT p_partkey, z, round(CASE WHEN z = 0 THEN 1.0 ELSE pow(10.0, -0.5115 * z * z * (sqrt(i) / (1 + sqrt(i)) - 0.3 * i)) END, 6) AS activity, round(0.013 * pow(i, 0.9) / 0.0126 / (1000 + p_size) * 100, 6) AS salinity
FROM (SELECT p_partkey, p_size, p_partkey % 4 AS z, p_retailprice / 10000 AS i FROM part)""")
def davies_activity(t: Tables) -> DataFrame:
    i, z = F.col("p_retailprice") / 10000, F.col("p_partkey") % 4
    return t.part.select("p_partkey", z.alias("z"), F.round(chemistry.davies_activity(z, i), 6).alias("activity"), F.round(chemistry.salinity_percent(i, F.col("p_size")), 6).alias("salinity"))


@query("alpha_fractions", """
WITH h AS (SELECT p_partkey, pow(10.0, -(p_size % 14)::DOUBLE) AS h FROM part), t AS (SELECT p_partkey, h * h * h AS a, pow(10.0, -2.15) * h * h AS b, pow(10.0, -2.15) * pow(10.0, -7.2) * h AS c, pow(10.0, -2.15) * pow(10.0, -7.2) * pow(10.0, -12.35) AS d FROM h)
SELECT p_partkey, round(a / (a + b + c + d), 6) AS h3, round(b / (a + b + c + d), 6) AS h2, round(c / (a + b + c + d), 6) AS h1, round(d / (a + b + c + d), 6) AS h0 FROM t""")
def alpha_fractions(t: Tables) -> DataFrame:
    h = F.pow(F.lit(10.0), -(F.col("p_size") % 14).cast("double"))
    alphas = t.dealt("part").select("p_partkey", chemistry.alpha_fractions(h, F.array(F.lit(2.15), F.lit(7.2), F.lit(12.35))).alias("a"))
    return alphas.select("p_partkey", *[F.round(F.col("a")[i], 6).alias(f"h{3 - i}") for i in range(4)])


@query("formula_weight", """
SELECT p_partkey, concat('Na', n, 'SO4') AS formula, round(22.990 * n + 32.06 + 4 * 15.999, 4) AS weight, concat('Ca', n, '(PO4)', m) AS grouped, round(40.078 * n + m * (30.974 + 4 * 15.999), 4) AS grouped_weight,
  concat('Fe((CN)', m, 'NO)', n) AS nested, round(55.845 + n * (m * (12.011 + 14.007) + 14.007 + 15.999), 4) AS nested_weight FROM (SELECT p_partkey, p_size % 5 + 2 AS n, p_partkey % 3 + 2 AS m FROM part)""")
def formula_weight(t: Tables) -> DataFrame:
    n, m = (F.col("p_size") % 5 + 2).cast("string"), (F.col("p_partkey") % 3 + 2).cast("string")
    formulas = t.dealt("part").select("p_partkey", F.concat(F.lit("Na"), n, F.lit("SO4")).alias("formula"), F.concat(F.lit("Ca"), n, F.lit("(PO4)"), m).alias("grouped"), F.concat(F.lit("Fe((CN)"), m, F.lit("NO)"), n).alias("nested"))
    weight = lambda c: F.round(chemistry.formula_weight(F.col(c)), 4)
    return formulas.select("p_partkey", "formula", weight("formula").alias("weight"), "grouped", weight("grouped").alias("grouped_weight"), "nested", weight("nested").alias("nested_weight"))


_FORMULAS = ["NaCl", "K2HPO4", "MgSO4", "C6H12O6", "CaCO3", "Fe2O3", "KNO3", "ZnI2"]
_FORMULA = "CASE p_partkey % 8 " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(_FORMULAS)) + " END"
_NAME = "CASE p_size % 6 WHEN 0 THEN 'Acetic acid' WHEN 1 THEN 'Sodium acetate' WHEN 2 THEN 'tris phosphate' WHEN 3 THEN 'Amino compound' WHEN 4 THEN p_name ELSE 'zinc hydroxide' END"


def _listed(rules: list, text: str) -> str:
    return "list_concat(" + ", ".join(f"CASE WHEN {contains_any_sql(text, needles)} THEN {values} ELSE []::DOUBLE[] END" for needles, values in rules) + ")"


@query("property_estimates", f"""
WITH f AS (SELECT p_partkey, {_NAME} AS name, {_FORMULA} AS formula, CASE WHEN p_partkey % 5 = 0 THEN (p_size % 9 - 4)::DOUBLE END AS xlogp FROM part),
p AS (SELECT *, list_sort(list_distinct(list_concat({_listed(chemistry.NAME_PKA, 'lower(name)')}, {_listed(chemistry.FORMULA_PKA, 'formula')}))) AS pka, ({contains_any_sql('formula', chemistry.METALS)} AND {contains_any_sql('formula', chemistry.ANIONS)}) AS ionic FROM f)
SELECT p_partkey, name, formula, array_to_string(list_transform(pka, lambda x: printf('%.2f', x)), ',') AS pka, ionic,
  CASE WHEN xlogp IS NOT NULL THEN round(greatest(0.001, least(2000.0, pow(10.0, 2 - 0.5 * xlogp))), 6) WHEN {contains_any_sql('lower(name)', chemistry.SOLUBLE)} THEN 500.0 WHEN {contains_any_sql('lower(name)', chemistry.INSOLUBLE)} THEN 1.0 WHEN ionic THEN 200.0 ELSE 100.0 END AS solubility,
  CASE WHEN len(pka) > 0 THEN least(3, len(pka)) * 2 + 1 ELSE len(list_filter([p_partkey % 5 - 2, p_partkey % 5 - 1, p_partkey % 5], lambda z: abs(z) <= 3)) END AS n_states FROM p""")
def property_estimates(t: Tables) -> DataFrame:
    named = t.dealt("part").select("p_partkey", F.expr(_NAME).alias("name"), F.expr(_FORMULA).alias("formula"), F.when(F.col("p_partkey") % 5 == 0, (F.col("p_size") % 9 - 4).cast("double")).alias("xlogp"))
    pka = chemistry.pka_values(F.col("name"), F.col("formula"))
    return named.select("p_partkey", "name", "formula", nested.pka_text(pka).alias("pka"), chemistry.is_ionic(F.col("formula")).alias("ionic"), F.round(chemistry.solubility(F.col("name"), F.col("formula"), F.col("xlogp")), 6).alias("solubility"), F.size(chemistry.charge_states(pka, (F.col("p_partkey") % 5 - 1).cast("int"))).alias("n_states"))


_IONS = [*chemistry.POLYATOMIC, *chemistry.MONATOMIC]


@query("ion_charges", f"""
WITH f AS (SELECT p_partkey, {_FORMULA} AS formula FROM part),
i AS (SELECT p_partkey, formula, {' UNION ALL SELECT p_partkey, formula, '.join(f"'{ion}' AS ion, {z} AS charge FROM f WHERE contains(formula, '{needle}')" for needle, ion, z in _IONS)})
SELECT p_partkey, formula, ion, charge FROM i""")
def ion_charges(t: Tables) -> DataFrame:
    return t.dealt("part").select("p_partkey", F.expr(_FORMULA).alias("formula")).select("p_partkey", "formula", F.explode(chemistry.ion_charges(F.col("formula"))).alias("ion", "charge"))


@query("activity_by_charge", "SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 1.0 WHEN 1 THEN 0.9 WHEN 2 THEN 0.8 ELSE 0.7 END::DOUBLE AS activity FROM part")
def activity_by_charge(t: Tables) -> DataFrame:
    z = F.col("p_size") % 5
    ions = F.when(z == 0, F.create_map().cast("map<string,int>")).otherwise(F.create_map(F.lit("a"), -z.cast("int"), F.lit("b"), F.lit(1)))
    return t.part.select("p_partkey", chemistry.activity_by_charge(ions).alias("activity"))


@query("scaled_concentration", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity = 0 OR l_discount = 0 THEN l_discount WHEN l_linenumber % 4 IN (0, 1, 3) THEN round(l_discount * l_quantity / 1000, 9) ELSE l_discount END AS amount FROM lineitem""")
def scaled_concentration(t: Tables) -> DataFrame:
    unit = F.element_at(F.array(*map(F.lit, ["ml/L", "g/l", "drops", "mg/L"])), F.col("l_linenumber") % 4 + 1)
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(chemistry.scaled_concentration(F.col("l_quantity"), unit, F.col("l_discount")), 9).alias("amount"))


@query("score_labels", "SELECT CASE WHEN p_size * 2 >= 95 THEN 'very_high' WHEN p_size * 2 >= 85 THEN 'high' WHEN p_size * 2 >= 75 THEN 'medium' WHEN p_size * 2 >= 70 THEN 'low' ELSE 'no_match' END AS label, count(*) AS n FROM part GROUP BY 1")
def score_labels(t: Tables) -> DataFrame:
    return t.part.groupBy(chemistry.score_label(F.col("p_size") * 2).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("list_texts", """
SELECT p_partkey, concat(printf('%.2f', p_size / 8.0 + 0.001), ',', printf('%.2f', p_size + 0.25)) AS pka, concat(-(p_size % 3), ',', p_size % 3) AS charges, concat('Na+:', p_size % 3, ',Cl-:', -(p_size % 4)) AS ions, (p_size % 3 - p_size % 4)::INTEGER AS total FROM part""")
def list_texts(t: Tables) -> DataFrame:
    texts = t.part.select(
        "p_partkey",
        F.concat_ws(",", F.format_string("%.2f", F.col("p_size") / 8.0 + 0.001), F.lit(" "), F.format_string(" %.2f", F.col("p_size") + 0.25)).alias("pka"),
        F.concat_ws(",", (-(F.col("p_size") % 3)).cast("string"), F.lit("x"), (F.col("p_size") % 3).cast("string")).alias("charges"),
        F.concat(F.lit("Na+: "), (F.col("p_size") % 3).cast("string"), F.lit(", Cl-:"), (-(F.col("p_size") % 4)).cast("string"), F.lit(",bad")).alias("ions"),
    )
    ions = nested.pair_map(F.col("ions"))
    return texts.select("p_partkey", nested.pka_text(nested.number_list(F.col("pka"))).alias("pka"), nested.charges_text(nested.number_list(F.col("charges"), "int")).alias("charges"), nested.ions_text(ions).alias("ions"), F.aggregate(F.map_values(ions), F.lit(0), lambda a, x: a + x).alias("total"))


@query("text_figures", """
SELECT p_partkey, concat((p_size % 20), ',', (p_size % 3) + 0.5) AS raw, array_to_string(list_filter([(p_size % 20)::DOUBLE, (p_size % 3) + 0.5], lambda x: x <= 14), ',') AS pka, CASE WHEN p_partkey % 2 = 0 THEN p_retailprice ELSE p_size END::DOUBLE AS solubility FROM part""")
def text_figures(t: Tables) -> DataFrame:
    said = F.concat(F.lit("The pKa = "), F.col("p_size") % 20, F.lit("; second PKA: "), (F.col("p_size") % 3) + 0.5, F.lit(". Dissolves "), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.col("p_retailprice").cast("string"), F.lit(" g / L"))).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(" mg/mL"))))
    texts = t.part.select("p_partkey", "p_size", said.alias("said"))
    return texts.select("p_partkey", F.concat_ws(",", F.col("p_size") % 20, (F.col("p_size") % 3) + 0.5).alias("raw"), F.concat_ws(",", nested.pka_mentions(F.col("said")).cast("array<string>")).alias("pka"), nested.solubility_mention(F.col("said")).alias("solubility"))
