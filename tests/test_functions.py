import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brothlake.functions import chemistry, hydrates, names, nested, predicates, urls


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "name, key",
    [("MgSO4 x 7 H2O", "mgso4·7h2o"), ("  Calcium   chloride 2-hydrate", "calcium chloride·2h2o"), ("CaCl2 x 2 H2O (pure)", "cacl2·2h2o"), ("", None), (None, None)],
)
def test_kg_key(spark, name, key):
    assert one(spark, name, names.kg_key) == key


def test_ontology_key_modes(spark):
    assert one(spark, "Sulfate Monohydrate", names.ontology_key) == "sulfate"
    assert one(spark, "Sulfate Monohydrate", lambda c: names.ontology_key(c, parity=True)) == "sulfate mono"
    assert one(spark, "(+)-Alanine (cis) , acid.", names.ontology_key) == "alanine, acid"
    assert one(spark, "FeSO4 x 7 H2O", names.ontology_key) == "feso4"


def test_property_and_other_keys(spark):
    assert one(spark, "D-Glucose", names.property_key) == "glucose"
    assert one(spark, "Sodium chloride", names.property_key) == "nacl"
    assert one(spark, "100 mg L-Alanine (grade A)", names.standard_key) == "alanine"
    assert one(spark, "Na2-fumarate", names.salt_key) == "disodium fumarate"
    assert one(spark, "MgSO4 x 7 H2O", names.dotted_hydrate) == "MgSO4.7H2O"
    assert one(spark, "Agar (Difco)", names.without_brand) == "agar"
    assert one(spark, "CuSO4·5H2O∑", names.repaired_symbols) == "CuSO4.5H2O"


@pytest.mark.parametrize("name, waters, parity", [("CaCl2 x 2 H2O", 2, 2), ("sodium dodecahydrate", 12, 10), ("salt undecahydrate", 11, 10), ("nothing", None, None), ("K • 3H2O", 3, 3)])
def test_hydration_number(spark, name, waters, parity):
    assert one(spark, name, hydrates.hydration_number) == waters
    assert one(spark, name, lambda c: hydrates.hydration_number(c, parity=True)) == parity


def test_hydrate_examples(spark):
    row = one(spark, "CaCl2 x 2 H2O", hydrates.parsed)
    assert (row.base_compound, row.hydration_number, row.confidence, row.base_id, round(row.hydrated_weight, 3)) == ("CaCl2", 2, "very_high", "CHEBI:3312", 147.01)
    row = one(spark, "MgSO4.7H2O", hydrates.parsed)
    assert (row.base_formula, row.hydration_number, row.hydrate_formula) == ("MgSO4", 7, "MgSO4.7H2O")
    words = "sodium chloride monohydrate"
    assert one(spark, words, hydrates.parsed).hydration_number == 1
    assert one(spark, words, lambda c: hydrates.parsed(c, parity=True)).method == "no_hydration"


def test_predicates_are_never_null(spark):
    for f in (predicates.is_water, predicates.is_ingredient, predicates.is_biological, predicates.is_compound, predicates.is_download_candidate, predicates.is_hydrated):
        assert one(spark, None, f) is False
    assert one(spark, "NaCl", predicates.is_compound) and not one(spark, "washed three times", predicates.is_compound)


def test_chemistry(spark):
    assert one(spark, "Ca(OH)2", lambda c: F.round(chemistry.formula_weight(c), 3)) == pytest.approx(40.078 + 2 * (15.999 + 1.008))
    assert one(spark, "Al2(SO4)3", chemistry.element_counts) == {"Al": 2, "S": 3, "O": 12}
    assert one(spark, None, chemistry.formula_weight) == 100.0
    assert one(spark, "NaCl", chemistry.ion_charges) == {"Na+": 1, "Cl-": -1}
    assert one(spark, "Na2-fumarate", chemistry.estimated_properties).molecular_weight == 200.0
    assert one(spark, "vitamin", chemistry.estimated_properties) is None
    assert one(spark, [2.15, 7.2], lambda c: F.size(chemistry.charge_states(c, F.lit(None).cast("int"))), "array<double>") == 5
    alphas = one(spark, [4.76], lambda c: chemistry.alpha_fractions(F.lit(10**-4.76), c), "array<double>")
    assert alphas == pytest.approx([0.5, 0.5])


def test_text_forms(spark):
    assert one(spark, "2.15, 7.20,x", nested.number_list) == [2.15, 7.2]
    assert one(spark, "Na+:1,Cl-:-1,Na+:2,bad", nested.pair_map) == {"Na+": 2, "Cl-": -1}
    assert one(spark, None, nested.pair_map) == {}
    assert one(spark, " a | b||c", nested.synonyms) == ["a", "b", "c"]
    assert one(spark, [], nested.charges_text, "array<int>") == "0"
    assert one(spark, "pKa: 4.76, pKa 99", nested.pka_mentions) == [4.76]


def test_urls(spark):
    assert one(spark, 'see <a href="https://x.org/medium/7?a">', urls.urls_in) == ["https://x.org/medium/7?a"]
    assert one(spark, "https://mediadive.dsmz.de/medium/12", urls.medium_id) == "12"
    assert one(spark, "http://www.example.org", urls.source_medium_id).startswith("url_")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("NaClx 27H2O().,-dlmohyrate·", max_size=20), min_size=1, max_size=30))
def test_normalisers_are_idempotent_on_loose_keys(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    once = df.select(names.without_brand(F.col("x")).alias("a"))
    assert all(r.a == r.b for r in once.select("a", names.without_brand(F.col("a")).alias("b")).collect())
