"""Queries whose work on a row is long deal their rows out, however few row groups their table's files have."""

import pytest

import __spark_entry__

QUERIES = ["layout_ingredients", "mined_ingredients", "listed_ingredients", "mined_strategies", "table_components", "routed_ingredients", "formula_weight", "recipe_ingredients", "three_column_ingredients", "solution_texts", "collection_resolved"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("dealt"))
    spark.range(64).selectExpr("id AS p_partkey", "int(id) AS p_size", "concat('name ', id) AS p_name", "'brand' AS p_brand", "'type' AS p_type", "double(id) AS p_retailprice").coalesce(1).write.parquet(f"{path}/part.parquet")
    return path


@pytest.mark.parametrize("name", QUERIES)
def test_rows_of_one_row_group_are_dealt_out(spark, folder, name):
    plan = __spark_entry__.queries()[name](spark, folder)._jdf.queryExecution().sparkPlan().toString()
    assert "RoundRobin" in plan or "REPARTITION_BY_NUM" in plan
