"""Composition documents are read once, and what a compound alone tells is worked out once for each distinct one."""

from pyspark.sql import functions as F

from brothlake.functions import names
from brothlake.operators import media_documents, properties


def known(spark):
    return properties.property_table(spark.createDataFrame([("NaCl", "58.44", "", "0", "Na+:1,Cl-:-1")], "compound_name string, molecular_weight string, pka_values string, charge_states string, ion_charges string"))


def test_documents_are_read_once(spark):
    """The plan reads the components that were written, not the documents."""
    docs = spark.createDataFrame([(1, '[{"compound":"NaCl","g_l":2}]'), (2, "{}"), (3, None)], "medium_id long, content string")
    found = media_documents.analysed(docs, known(spark))
    assert "try_parse_json" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert {r.medium_id: (r.error, r.compound_details and r.compound_details.recognized_compounds) for r in found.collect()} == {1: (None, ["NaCl"]), 2: (media_documents.NOT_A_LIST, None), 3: (media_documents.NOT_JSON, None)}


def test_keys_are_made_of_distinct_compounds(spark, monkeypatch):
    rows, made, key = spark.createDataFrame([(m, "NaCl", 1.0) for m in range(50)] + [(1, None, 1.0)], "medium_id long, compound string, g_l double"), spark.sparkContext.accumulator(0), names.property_key
    counted = F.udf(lambda x: made.add(1) or x)
    monkeypatch.setattr(properties.names, "property_key", lambda c: key(counted(c)))
    got = properties.ingredients(rows, known(spark), ["compound"]).collect()
    assert len(got) == 51 and sum(r.account == "recognized" for r in got) == 50
    assert made.value <= 4


def test_packed_documents_come_back(spark, tmp_path):
    """A document written as JSON once read comes back from its packed file as it was."""
    from brothlake.sources import writers

    docs = spark.createDataFrame([(1, '[{"compound":"NaCl","g_l":2},{"compound":"mud"}]'), (2, "[]")], "medium_id long, content string")
    found = media_documents.analysed(docs, known(spark))
    texts = media_documents.as_json(found).select(F.concat(F.lit("medium_"), "medium_id", F.lit("_composition_properties.json")).alias("file_name"), "content")
    writers.packed_files(texts, str(tmp_path / "packed"))
    back = {int(r.medium_id): r.compound_details for r in media_documents.read_documents(spark, str(tmp_path / "packed"), packed=True).collect()}
    assert back == {r.medium_id: r.compound_details for r in found.collect()}
    assert "try_parse_json" not in texts._jdf.queryExecution().optimizedPlan().toString().lower()


def test_rows_are_not_shuffled_for_few_compounds(spark):
    """What compounds tell is written, so its size is known and rows are joined where they are."""
    rows = spark.createDataFrame([(m, x, 1.0) for m in range(20) for x in ("NaCl", "mud")], "medium_id long, compound string, g_l double")
    found = properties.ingredients(rows, known(spark))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted({(r.compound, r.account, r.key) for r in found.collect()}) == [("NaCl", "recognized", "nacl"), ("mud", "unaccounted", "mud")]
