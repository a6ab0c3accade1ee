"""Recipe texts, pages and solutions: blanks, nulls and layouts that compete."""

from pyspark.sql import functions as F

from brothlake.operators import jcm, layouts, lookups, media_documents, mining, properties, recipes, repairs, solution_texts

TEXTS = [None, "", "\n\n", "12\n13", "MgSO4\nKH2PO4\n1.5\n2\ng\nmg", "1.5\n20 mM\nMgSO4\nKH2PO4", "Trace solution:\nMgSO4 (5 mg)\npH 7\nKH2PO4", "Use medium 12. Add 5% beef extract.", "Glucose 5 g/L and Agar 15 g, boiled"]


def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "k long, text string")


def test_layouts(spark):
    rows = recipes.recipe_rows(texts(spark), "k").collect()
    got = {k: [(r.name, r.concentration, r.unit, r.extraction_method) for r in sorted(rows, key=lambda r: r.pos) if r.k == k] for k in range(len(TEXTS))}
    assert not got[0] and not got[1] and not got[2] and not got[3]
    assert got[4] == [("MgSO4", 1.5, "g", "tabular"), ("KH2PO4", 2.0, "mg", "tabular")]
    assert got[5] == [("MgSO4", 1.5, "mM", "reverse_tabular"), ("KH2PO4", 20.0, "g", "reverse_tabular")]
    assert got[6] == [("MgSO4", 5.0, "mg", "solutions"), ("KH2PO4", 1.0, "g", "solutions")]
    assert got[7] == [("Reference to Medium 12", 1.0, "reference", "reference"), ("Beef Extract", 5.0, "%", "addition")]
    assert ("Glucose", 5.0, "g/L", "prose") in got[8]
    three = texts(spark).select("k", layouts.three_columns(F.col("text")).alias("x")).collect()
    assert [(r.name, r.concentration, r.unit) for r in three[4].x] == [("MgSO4", 1.5, "g"), ("KH2PO4", 2.0, "mg")]


def test_mining_and_solutions_of_blank_texts(spark):
    rows = texts(spark).select("k", mining.all_ingredients(F.col("text")).alias("x")).where("k < 4").collect()
    assert all(not r.x for r in rows)
    found = {r.solution_id: r for r in solution_texts.parsed(texts(spark), "k").collect()}
    assert found[0].solution_name == "Unknown Solution" and not found[0].composition and not found[1].composition


def test_pages_without_anything(spark):
    pages = spark.createDataFrame([("a/jcm_5.html", None), ("jcm_6.html", ""), ("jcm_7.html", "No data")], "path string, html string")
    got = {r.path: (r.medium_id, r.composition_type, r.medium_name) for r in jcm.media(pages).collect()}
    assert got == {"a/jcm_5.html": (None, "unknown", "Unknown JCM Medium"), "jcm_6.html": (None, "unknown", "Unknown JCM Medium"), "jcm_7.html": ("jcm_7", "no_data", "JCM 7 (No Data)")}
    assert jcm.ingredient_rows(jcm.media(pages)).count() == 0


def test_index_on_disk(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, "cid string, name string, pos long")
    index = lookups.name_index(frame([("1", "Salt", 0), ("2", "salt ", 1), ("3", None, 2)]), frame([("4", "SALT", 0), ("5", "sugar", 1), ("6", "Sugar", 2), ("7", " ", 3)]))
    lookups.write_index(index, str(tmp_path / "index"), buckets=4)
    asked = spark.createDataFrame([("SALT",), ("sugar",), ("none",), (None,)], "name string")
    got = [(r.name, r.cid) for r in lookups.looked_up(asked, spark.read.parquet(str(tmp_path / "index")), "name", buckets=4).collect()]
    assert sorted(got, key=str) == sorted([("SALT", "2"), ("sugar", "5"), ("none", None), (None, None)], key=str)


def test_documents_with_errors(spark):
    known = properties.property_table(spark.createDataFrame([("NaCl", 58.44, "", "0", "Na+:1,Cl-:-1")], "compound_name string, molecular_weight double, pka_values string, charge_states string, ion_charges string"))
    docs = spark.createDataFrame([("a", '[{"compound": "NaCl", "g_l": 5}]'), ("b", "{"), ("c", "{}"), ("d", None), ("e", "[]")], "medium_id string, content string")
    got = {r.medium_id: r for r in media_documents.analysed(docs, known).collect()}
    assert got["a"].error is None and got["a"].compound_details.recognized_compounds == ["NaCl"] and got["a"].analysis_quality.compounds_recognized == "1/1"
    assert [got[k].error for k in "bcd"] == [media_documents.NOT_JSON, media_documents.NOT_A_LIST, media_documents.NOT_JSON]
    assert got["b"].ph.confidence == "none" and got["b"].ph.value is None and got["e"].ph is None


def test_names_without_ids(spark):
    rows = spark.createDataFrame([("NaCl", None), ("KCl", "CHEBI:1"), ("A", None), ("AB", None), ("ab", ""), ("1.5", None), (None, None), ("NaCl", "kg:1")], "original string, mapped string")
    assert [r.original for r in repairs.without_ontology_id(rows).collect()] == ["NaCl", "ab"]


def test_three_columns_ask_a_line_once_whether_it_is_a_name(spark):
    plan = texts(spark).select(layouts.three_columns(F.col("text")).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("gellan") == 1


def test_amounts_are_read_in_three_passes(spark):
    """Before, amount and unit of each amount of a line; all of it is asked for with parity only."""
    plan = lambda **options: texts(spark).select(mining.inline(F.col("text"), **options).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan().count("regexp_extract_all(") == 3
