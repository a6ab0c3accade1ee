import difflib
import json
import random

import pytest
from pyspark.sql import functions as F

from brothlake.functions import names
from brothlake.operators import matching, properties, recipes, reports, tables
from brothlake.sources import readers, writers

MEDIA = [
    (1, [("tryptone", 10.0), ("yeast extract", 5.0), ("sodium chloride", 10.0)]),
    (5, [("peptone", 5.0), ("beef extract", 3.0), ("sodium chloride", 8.0)]),
    (4, [("peptone", 5.0), ("yeast extract", 1.0), ("ferric citrate", 0.1), ("sodium chloride", 19.45), ("magnesium chloride", 5.9), ("magnesium sulfate", 3.24), ("calcium chloride", 1.8), ("potassium chloride", 0.55), ("sodium bicarbonate", 0.16)]),
    (3, [("tryptone", 17.0), ("soy peptone", 3.0), ("sodium chloride", 5.0), ("dipotassium hydrogen phosphate", 2.5), ("glucose", 2.5)]),
    (2, [("glucose", 4.0), ("sodium phosphate dibasic", 6.78), ("potassium phosphate monobasic", 3.0), ("sodium chloride", 0.5), ("ammonium chloride", 1.0), ("magnesium sulfate", 0.493), ("calcium chloride", 0.011)]),
]
GOLDEN = {1: (5.65, 0.012, 0.094444, 25.0, 0.0, 66.7), 2: (5.25, 0.0113, 0.087372, 15.78, 14.3, 85.7), 3: (5.57, 0.0101, 0.078409, 30.0, 20.0, 60.0), 4: (5.54, 0.0462, 0.425998, 37.2, 0.0, 100.0), 5: (5.8, 0.0125, 0.097778, 16.0, 0.0, 100.0)}


def media(spark):
    return spark.createDataFrame([(m, c, g) for m, parts in MEDIA for c, g in parts], "medium_id long, compound string, g_l double")


def property_rows(spark):
    return properties.property_table(spark.createDataFrame([("glucose", 180.16, None, "0", None), ("NaCl", 58.44, "", "0", "Na+:1,Cl-:-1")], "compound_name string, molecular_weight double, pka_values string, charge_states string, ion_charges string"), lower_keys=False)


def test_media_summary_golden(spark):
    rows = {r.medium_id: r for r in properties.media_summary(media(spark), property_rows(spark)).collect()}
    for m, (ph, salinity, strength, tds, recognized, estimated) in GOLDEN.items():
        r = rows[m]
        assert (r.ph, r.salinity_percent, r.ionic_strength, r.total_dissolved_solids, r.compounds_recognized, r.compounds_estimated) == pytest.approx((ph, salinity, strength, tds, recognized, estimated))
        assert (r.ph_confidence, r.salinity_confidence) == ("low", "high")


def test_charge_balance(spark):
    acid = spark.createDataFrame([(1, "x", 1.0)], "medium_id long, compound string, g_l double")
    props = spark.createDataFrame([("x", 100.0, [4.76], [0, -1], {})], "key string, molecular_weight double, pka_values array<double>, charge_states array<int>, ion_charges map<string,int>")
    # h = ka * (c - h) / h of a weak acid of 0.01 mol/l
    assert properties.charge_balance_ph(acid, props).first().ph == pytest.approx(3.39, abs=0.02)


def test_cascade_last_row_wins_and_tiers(spark):
    nodes = spark.createDataFrame([("A", 0, "salt", "x|y"), ("B", 1, "salt", None), ("C", 2, "Sugar", "salt")], "id string, pos long, name string, synonym string")
    asked = spark.createDataFrame([("salt",), ("x",), ("SUGAR ",), ("none",), (None,)], "original string")
    got = {r.original: (r.mapped, r.match_tier) for r in matching.exact_cascade(asked, nodes, "original", names.loose_key).collect()}
    assert got == {"salt": ("B", 1), "x": ("A", 2), "SUGAR ": ("C", 3), "none": (None, None), None: (None, None)}


def test_fuzzy_equals_brute_force(spark):
    left = ["sodium chlorite", "glucos", "magnesum sulfate", "agar"]
    right = ["sodium chloride", "glucose", "fructose", "magnesium sulfate", "manganese sulfate"]
    got = {(r.left_name, r.right_name, r.score) for r in matching.fuzzy_best(spark.createDataFrame([(x,) for x in left], "l string"), spark.createDataFrame([(x,) for x in right], "r string"), "l", "r", least=70, top=9).collect()}
    scores = {(a, b, round(100 * difflib.SequenceMatcher(None, a, b).ratio())) for a in left for b in right}
    assert got == {x for x in scores if x[2] >= 70}




def test_contained_and_update(spark):
    left = spark.createDataFrame([("Iron sulfate heptahydrate",), ("sulfate",)], "l string")
    right = spark.createDataFrame([("sulfate",), ("Iron sulfate",), ("zzzz",)], "r string")
    got = {r.left_name: (r.right_name, round(r.score)) for r in matching.contained_best(left, right, "l", "r").collect()}
    assert got == {"Iron sulfate heptahydrate": ("Iron sulfate", 48), "sulfate": ("sulfate", 100)}
    rows = spark.createDataFrame([("a", None), ("b", "CHEBI:1")], "original string, mapped string")
    changes = spark.createDataFrame([("a", "CHEBI:9"), ("b", "CHEBI:9")], "key string, value string")
    assert {r.original: r.mapped for r in matching.updated(rows, changes, "original", "mapped", F.col("mapped").isNull()).collect()} == {"a": "CHEBI:9", "b": "CHEBI:1"}


def test_two_hops(spark):
    rows = [("medium:1", "biolink:has_part", "solution:1"), ("solution:1", "biolink:has_part", "CHEBI:1"), ("medium:1", "biolink:has_part", "CHEBI:2"), ("medium:1", "other", "CHEBI:3")]
    edges = spark.createDataFrame(rows, "subject string, predicate string, object string")
    assert {r.component for r in matching.medium_components(edges).collect()} == {"CHEBI:1", "CHEBI:2"}
    assert {r.component for r in matching.medium_components(edges, direct=False).collect()} == {"CHEBI:1"}


def test_split_is_a_partition(spark):
    labels = ["very_high", "high", "medium", "low", None]
    status = ["original_only", "unmapped", "chebi_only", None]
    df = spark.createDataFrame([(c, s) for c in labels for s in status], "match_confidence string, mapping_status string")
    high, low = tables.split_confident(df)
    assert high.count() + low.count() == df.count() and high.where("mapping_status = 'unmapped'").count() == 0


def test_merge_fills_and_appends(spark):
    comps = spark.createDataFrame([("m1", "a", ""), ("m1", "b", "CHEBI:5")], "medium_id string, original string, mapped string")
    found = spark.createDataFrame([("a", 0, "CHEBI:1", "high"), ("a", 1, "CHEBI:2", "high"), ("z", 0, "CHEBI:3", "low")], "original_compound string, pos int, chebi_id string, match_confidence string")
    got = {(r.medium_id, r.original, r.mapped, r.mapping_status) for r in tables.with_status(tables.merged(comps, found)).collect()}
    assert got == {("m1", "a", "CHEBI:2", "original_and_chebi_match"), ("m1", "b", "CHEBI:5", "original_only"), ("multiple", "z", "CHEBI:3", "original_and_chebi_match")}
    with pytest.raises(ValueError):
        tables.require(comps, ["value"])


def test_expansion_counts(spark):
    rows = spark.createDataFrame([("m", "stock", "solution:1", 10.0, "ml/L"), ("m", "x", "solution:9", 1.0, "ml/L"), ("m", "y", None, 1.0, "g")], "medium_id string, original string, mapped string, value double, unit string")
    stock = spark.createDataFrame([("1", [("a", 2.0, "g/L"), ("b", 0.0, "g/L")])], "solution_id string, composition array<struct<name:string,concentration:double,unit:string>>")
    got = {(r.original, r.value, r.expansion_status) for r in tables.expanded_solutions(rows, stock).collect()}
    assert got == {("a", 0.02, "expanded"), ("b", 0.0, "expanded"), ("x", 1.0, "unresolved"), ("y", 1.0, "direct")}
    assert tables.expanded_solutions(rows, stock, keep_unresolved=False).count() == 3


def test_reports_on_empty_tables(spark):
    empty = spark.createDataFrame([], "original string, mapped string, a string, b string")
    assert reports.mapping_rates(empty, ["original"]).count() == 0
    assert reports.agreement(empty, "a", "b").first().total == 0
    assert reports.bucket_histogram(empty, "original").count() == 0


def test_recipes_and_tables(spark):
    texts = ["NaCl ...... 5.0 g/L\nKNO3 .... 2,5 mg/L", "MgSO4 3 g\nK2HPO4 1.5 mM", "Use Glucose (10 g/L).", "Add 2 g of Na2CO3 in water.", "no recipe", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [(r.doc_id, r.name, r.concentration, r.extraction_method) for r in recipes.recipe_rows(docs, "doc_id").orderBy("doc_id", "pos").collect()]
    assert rows == [(0, "NaCl", 5.0, "dotted"), (0, "KNO3", 2.5, "dotted"), (1, "MgSO4", 3.0, "columnar"), (1, "K2HPO4", 1.5, "columnar"), (2, "Use Glucose", 10.0, "parenthetical"), (3, "Na2CO3", 2.0, "amount_first")]
    html = spark.createDataFrame([(1, "<table><tr><td>NaCl<td>5 g/l</tr><tr><td>Distilled water</td><td>1 l</td></tr><tr><td>KCl</td><td>2</td><td>mM</td></tr></table>"), (2, None)], "page_id long, html string")
    got = [(r.name, r.concentration, r.unit) for r in recipes.table_ingredients(html, "page_id").orderBy("pos").collect()]
    assert ("KCl", 2.0, "mM") in got and all(n != "Distilled water" for n, *_ in got)


def test_round_trip_tsv_and_json(spark, tmp_path):
    rows = spark.createDataFrame([("m1", 'a "quoted" name', "CHEBI:1", 1.5), ("m2", "NA", None, None)], "medium_id string, original string, mapped string, value double")
    writers.tsv(writers.ordered_columns(rows), str(tmp_path / "t"), ["medium_id"])
    back = readers.tsv(spark, str(tmp_path / "t"), readers.MAPPING).select("medium_id", "original", "mapped", "value")
    assert sorted(back.collect()) == sorted(rows.collect())
    (tmp_path / "medium_7_composition.json").write_text(json.dumps([{"compound": "NaCl", "g_l": 5.0}]))
    (tmp_path / "medium_8_composition.json").write_text(json.dumps({"composition": [{"name": "KCl", "concentration": "2.5", "unit": "mM"}]}))
    got = {(r.medium_id, r.compound, r.g_l, r.unit) for r in readers.compositions(spark, str(tmp_path)).collect()}
    assert got == {("7", "NaCl", 5.0, "g/L"), ("8", "KCl", 2.5, "mM")}


def test_stream_equals_batch(spark, tmp_path):
    from brothlake.streaming import incoming

    docs = spark.createDataFrame([(i, f"NaCl ..... {i}.5 g/L") for i in range(20)], "doc_id long, text string").withColumn("arrived", F.current_timestamp())
    docs.repartition(3).write.parquet(str(tmp_path / "in"))
    q = incoming.started(incoming.ingredient_stream(incoming.document_stream(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == recipes.recipe_rows(docs, "doc_id").count() == 20
