"""Keyed tables changed in place: versions, retries, buckets that stay, and defaults."""

import pytest
from pyspark.sql import functions as F

from brothlake.sources import versioned
from brothlake.sources.versioned import ConflictError, VersionedTable
from brothlake.streaming import incoming

SCHEMA = "compound_name string, molecular_weight double, pka_values string, charge_states string, ion_charges string, solubility_g_per_L double, activity_coefficient double, description string"


def row(name, weight, solubility=1.0, pka=None):
    return (name, weight, pka, "0", None, solubility, 1.0, name)


@pytest.fixture
def table(spark, tmp_path):
    made = VersionedTable(spark, str(tmp_path / "table"))
    made.create(spark.createDataFrame([row("NaCl", 58.44), row("Agar", 100.0), row("Tris", 121.1)], SCHEMA), "compound_name", 8)
    return made


def weights(table, version=None):
    return {r.compound_name: r.molecular_weight for r in table.read(version).collect()}


def test_versions(spark, table):
    new = spark.createDataFrame([(*row("KCl", 74.0), 2), (*row("KCl", 75.0), 1), (*row("nacl", 1.0), 0), (*row(None, 1.0), 0)], SCHEMA + ", pos int")
    before = table.manifest()
    after = table.upserted(new, "add-1", "pos")
    assert (after.version, weights(table)) == (1, {"NaCl": 58.44, "Agar": 100.0, "Tris": 121.1, "KCl": 75.0}) and "KCl" not in weights(table, 0)
    touched = {r[0] for r in new.select(F.pmod(F.xxhash64(F.lower("compound_name")), F.lit(8))).distinct().collect()}
    assert {b: p for b, p in after.buckets.items() if b not in touched} == {b: p for b, p in before.buckets.items() if b not in touched}
    assert table.upserted(new, "add-1", "pos") == after and table.manifest().version == 1
    assert table.create(new, "compound_name", change="create").version == 1
    with pytest.raises(ConflictError):
        table.create(new, "compound_name", change="other")


def test_a_writer_that_dies_or_comes_second_changes_nothing(spark, table, monkeypatch):
    new = spark.createDataFrame([row("KCl", 74.0)], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_committed", lambda self, manifest: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            table.upserted(new, "add")
    assert table.manifest().version == 0 and "KCl" not in weights(table)
    stale = table.manifest()
    assert table.upserted(new, "add").version == 1 and weights(table)["KCl"] == 74.0
    monkeypatch.setattr(VersionedTable, "manifest", lambda self, version=None: stale)
    with pytest.raises(ConflictError):
        table.upserted(new, "late")


def test_point_updates(spark, table):
    updates = spark.createDataFrame([("NaCl", 1.0, None, 1), ("NaCl", 2.0, "3.1", 2), ("NaCl", None, None, 3), ("unknown", 5.0, "1", 1), ("agar", 9.0, None, 1)], "compound_name string, molecular_weight double, pka_values string, pos int")
    table.updated(updates, "fix", "pos")
    assert weights(table) == {"NaCl": 2.0, "Agar": 100.0, "Tris": 121.1}
    assert {r.compound_name: r.pka_values for r in table.read().collect()}["NaCl"] == "3.1"


def test_rows_with_defaults(spark, table):
    rows = spark.createDataFrame([("KCl", 74.5, None), ("Bad", 0.0, None), ("Worse", 3.0, -1.0), ("", 5.0, None), (None, 5.0, None), ("Urea", 60.0, 7.0)], "compound_name string, molecular_weight double, solubility_g_per_L double")
    table.appended(rows, "manual", versioned.property_defaults(), versioned.valid_property)
    got = {r.compound_name: r for r in table.read().collect()}
    assert set(got) == {"NaCl", "Agar", "Tris", "KCl", "Urea"}
    assert (got["KCl"].solubility_g_per_L, got["KCl"].activity_coefficient, got["KCl"].charge_states, got["KCl"].description) == (100.0, 1.0, "0", "KCl") and got["Urea"].solubility_g_per_L == 7.0


def test_empty_changes_and_missing_tables(spark, table, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert table.upserted(none, "nothing").version == 1 and len(weights(table)) == 3
    missing = VersionedTable(spark, str(tmp_path / "none"))
    for attempt in (missing.read, lambda: missing.upserted(none, "x")):
        with pytest.raises(FileNotFoundError):
            attempt()
    missing.create(none, "compound_name")
    assert missing.read().count() == 0 and missing.upserted(spark.createDataFrame([row("KCl", 74.0)], SCHEMA), "x").version == 1


def test_arrivals_in_any_order(spark, tmp_path):
    """Overlapping arrivals, one tried twice, give what one batch gives."""
    first, second = [row("KCl", 74.0), row("Urea", 60.0)], [row("kcl", 1.0), row("Tris", 121.1), row("Urea", 60.0)]
    for k, order in enumerate(([first, second], [first, first, second])):
        folder, made = tmp_path / f"in{k}", VersionedTable(spark, str(tmp_path / f"t{k}"))
        made.create(spark.createDataFrame([], SCHEMA), "compound_name", 4)
        for rows in order:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
            incoming.property_arrivals(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder)), made, str(tmp_path / f"c{k}")).awaitTermination()
        assert weights(made) == {"KCl": 74.0, "Urea": 60.0, "Tris": 121.1}
        version = made.manifest().version
        incoming.property_arrivals(spark.readStream.schema(SCHEMA).parquet(str(folder)), made, str(tmp_path / f"c{k}")).awaitTermination()
        assert made.manifest().version == version
