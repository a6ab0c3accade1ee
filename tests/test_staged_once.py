"""What staged matching asks for is read once, and keys are made of distinct names only."""

from pyspark.sql import functions as F

from brothlake.functions import names
from brothlake.operators import staged


def test_each_name_gets_its_keys_once(spark, monkeypatch):
    made, key = spark.sparkContext.accumulator(0), names.ontology_key
    counted = F.udf(lambda x: made.add(1) or x)
    monkeypatch.setattr(staged.names, "ontology_key", lambda c, parity=False: key(counted(c), parity))
    known = spark.createDataFrame([("CHEBI:1", "sodium citrate"), ("CHEBI:2", "agar")], "id string, name string")
    asked = spark.createDataFrame([(x,) for x in ["sodium citrat", "agar dihydrate", "qqqqq", None] * 25], "original string")
    got = {r.original: (r.chebi_id, r.matching_method) for r in staged.matched_in_stages(asked, known).collect()}
    assert got == {"sodium citrat": ("CHEBI:1", "hydration_aware_fuzzy"), "agar dihydrate": ("CHEBI:2", "hydration_variant_exact"), "qqqqq": (None, "none")}
    assert made.value <= 5
