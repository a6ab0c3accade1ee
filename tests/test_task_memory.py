"""Rows are not sorted where a task would hold more of them than its groups ask for."""

from pyspark.sql import functions as F

from brothlake.operators import matching


def test_matches_in_a_medium_are_not_sorted(spark):
    names = spark.createDataFrame([(1, "m", "b"), (2, "m", "B"), (3, "n", "a"), (4, None, None)], "k long, medium string, name string")
    parts = spark.createDataFrame([("m", "C:10"), ("m", "C:9"), ("m", "C:1"), ("n", "C:1")], "medium_id string, component string")
    nodes = spark.createDataFrame([("C:10", "x", "b|z"), ("C:9", "y", "b"), ("C:1", "b", None), (None, "a", "a")], "id string, name string, synonym string")
    found = matching.matched_in_medium(names, parts, nodes, "name", "medium", F.lower)
    assert "SortAggregate" not in found._jdf.queryExecution().sparkPlan().toString()
    assert {r.k: r.medium_match for r in found.collect()} == {1: "C:1", 2: "C:1", 3: None, 4: None}
    tied = matching.matched_in_medium(names, parts.where("component <> 'C:1'"), nodes, "name", "medium", F.lower)
    assert {r.k: r.medium_match for r in tied.collect()} == {1: "C:10", 2: "C:10", 3: None, 4: None}
