"""Jobs that a cap, a length limit or a missing stage would cut."""

from pyspark.sql import functions as F

import __spark_entry__
from brothlake.operators import matching, recipes, staged

SMALL = "/root/testdata/sf0.001"


def dictionary(spark, rows):
    return spark.createDataFrame(rows, "id string, name string")


def asked(spark, *originals):
    return spark.createDataFrame([(x,) for x in originals], "original string")


def test_staged_fuzzy_compares_all_names(spark):
    stem = "potassium magnesium citrat"
    known = dictionary(spark, [(f"CHEBI:{9 - k}", stem + c) for k, c in enumerate("abcdefgh")] + [("CHEBI:99", stem + "z dihydrate")])
    got = {r.original: (r.chebi_id, r.matching_method) for r in staged.matched_in_stages(asked(spark, stem + "x dihydrate", stem + "x", stem + "x trihydrate"), known).collect()}
    assert got == {stem + "x dihydrate": ("CHEBI:99", "hydration_aware_fuzzy"), stem + "x": ("CHEBI:2", "hydration_aware_fuzzy"), stem + "x trihydrate": ("CHEBI:2", "fuzzy_normalized")}


def test_unified_sorted_keeps_all_rows(spark):
    queries = __spark_entry__.queries()
    rows = [tuple(r) for r in queries["unified_sorted"](spark, SMALL).collect()]
    assert len(rows) == queries["unified_mapping"](spark, SMALL).count() > 100
    assert rows == sorted(rows)


def test_short_names_match_as_a_whole_only(spark):
    left, right = asked(spark, "KCl", "HCl in water", "NaF", "agar", ""), asked(spark, "kcl", "HCl", "water", "agar", "aga", "")
    got = {r.left_name: (r.right_name, round(r.score)) for r in matching.contained_best(left, right, "original", "original").collect()}
    assert got == {"KCl": ("kcl", 100), "HCl in water": ("water", 42), "agar": ("agar", 100)}


def test_respelled_and_held_names(spark):
    index = spark.createDataFrame([("Sodium Chloride", 1), ("iron(II) sulfate", 2), ("calcium chloride dihydrate", 3), ("calcium", 4), ("ab", 5)], "name string, pos long")
    left = asked(spark, " sodium chloride", "sodium-chloride", "sodium_chloride", "[iron(II)] sulfate", "chloride dihydrate", "calcium carbonate", "chloride", "abc", "agar", None)
    got = {r.left_name: (r.right_name, r.method) for r in matching.respelled_best(left, index, "original", "name", "pos").collect()}
    assert got == {
        " sodium chloride": ("Sodium Chloride", "exact"), "sodium-chloride": ("Sodium Chloride", "respelled"), "sodium_chloride": ("Sodium Chloride", "respelled"), "[iron(II)] sulfate": ("iron(II) sulfate", "respelled"),
        "chloride dihydrate": ("calcium chloride dihydrate", "partial"), "calcium carbonate": ("calcium", "partial"), "chloride": ("Sodium Chloride", "partial"),
    }


def test_staged_label_beats_a_lower_normalised_score(spark):
    known = dictionary(spark, [("CHEBI:1", "sodium citrate dihydrate"), ("CHEBI:2", "agar")])
    got = [(r.chebi_id, r.matching_method) for r in staged.matched_in_stages(asked(spark, "sodium cit dihydrat"), known).collect()]
    assert got == [("CHEBI:1", "fuzzy_label")]


def test_lists_of_names_and_amounts(spark):
    texts = ["Medium\n©\nSodium nitrate\nKH2PO4\nVitamin B12\nper litre\n5,5 g\n20 mg\n1 mL\nMake up to 1 litre\nagar 15 g", "NaCl 5 g\nKCl 2 g\nper litre", "names only\nper litre", "per litre\n5 g"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [(r.doc_id, r.name, r.concentration, r.unit, r.extraction_method) for r in recipes.recipe_rows(docs, "doc_id").orderBy("doc_id", "pos").collect()]
    assert got == [(0, "Sodium nitrate", 5.5, "g", "list"), (0, "KH2PO4", 20.0, "mg", "list"), (0, "Vitamin B12", 1.0, "mL", "list"), (1, "NaCl", 5.0, "g", "columnar"), (1, "KCl", 2.0, "g", "columnar")]


def test_expansion_has_the_components_of_all_lines(spark):
    rows = __spark_entry__.queries()["expanded_all_lines"](spark, SMALL)
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").selectExpr("l_suppkey AS sid", "l_partkey % 50 AS part").distinct()
    orders = spark.read.parquet(f"{SMALL}/orders.parquet").where("o_orderkey % 3 > 0")
    want = orders.where("o_orderkey % 4 > 0").selectExpr("o_orderkey % 120 AS sid").join(lines, "sid").count()
    assert rows.where("expansion_status = 'expanded'").count() == want > 0
    assert rows.where("expansion_status = 'unresolved'").count() >= orders.where("o_orderkey % 4 = 0").count() > 0


def test_unaccounted_compounds_are_those_of_the_accounts(spark):
    queries = __spark_entry__.queries()
    accounts = queries["compound_accounts"](spark, SMALL).collect()
    want = {r.compound: r.frequency for r in accounts if r.account == "unaccounted"}
    assert {r.compound: r.frequency for r in queries["unaccounted_compounds"](spark, SMALL).collect()} == want and any(len(x) < 12 for x in want)
    assert {r.compound: r.n for r in queries["compound_usage"](spark, SMALL).collect()} == {r.compound: r.frequency for r in accounts}


def test_long_recipes_stay_whole(spark):
    text = "\n".join(f"K{n}Cl ...... {n}.5 g/L" for n in range(1, 61)) + "\nPreparation: " + "x" * 700
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [recipes.recipe_rows(docs, "doc_id", parity=p).count() for p in (False, True)] == [60, 50]
    assert [docs.select(F.length(recipes.preparation(F.col("text"), p))).first()[0] for p in (False, True)] == [700, 500]
