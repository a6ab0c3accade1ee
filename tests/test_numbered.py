"""Places over all partitions: keys of the sort are columns, and orders may tell a direction."""

from pyspark.sql import functions as F

from brothlake.operators import tables


def test_sort_keys_are_worked_out_once_a_row(spark, monkeypatch):
    """A sort by an expression would work it out at every comparison."""
    frame, sorts = type(spark.range(1)), []
    sort = frame.sortWithinPartitions
    monkeypatch.setattr(frame, "sortWithinPartitions", lambda df, *cols: sorts.append(cols) or sort(df, *cols))
    rows = spark.createDataFrame([("10",), ("9",), (None,), ("b",), ("a",), ("-1",)], "id string")
    got = {r.id: r.place for r in tables.numbered(rows, tables.numeric_first(F.col("id"))).collect()}
    assert got == {"-1": 1, "9": 2, "10": 3, None: 4, "a": 5, "b": 6}
    assert all(isinstance(c, str) for c in sorts[0])


def test_directions_stay(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, id string")
    got = {r.k: r.place for r in tables.numbered(rows, [F.col("id").desc_nulls_first(), F.asc("k")]).collect()}
    assert got == {3: 1, 2: 2, 1: 3}
    assert tables.numbered(rows, [F.col("id").desc()]).columns == ["k", "id", "place"]
