"""Names in texts, numbers over all partitions, and tables that don't depend on the order of rows."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from brothlake.operators import contained, jcm, lookups, matching, properties, tables


def frame(spark, xs, c="t"):
    return spark.createDataFrame([(x,) for x in xs], f"{c} string")


@pytest.mark.parametrize("sizes", [(10**6, 10**6), (40, 60)])
def test_occurrences_equal_brute_force(spark, sizes):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abß\U0001f600 ") for _ in range(rng.randrange(30))) for _ in range(60)] + [None, "", "aaaa"]
    names = ["".join(rng.choice("abß\U0001f600 ") for _ in range(rng.randrange(1, 4))) for _ in range(30)] + [None, "", "aa", "aa"]
    got = sorted(tuple(r) for r in contained.occurrences(frame(spark, texts + texts), frame(spark, names, "n"), "t", "n", *sizes).collect())
    want = {(t, n, i) for t in texts if t for n in names if n for i in range(len(t)) if t.startswith(n, i)}
    assert got == sorted(want)


def test_containing_pairs(spark):
    names = ["Iron sulfate", "sulfate", "Iron sulfate heptahydrate", "SULFATE", "iron", "ron", None, ""]
    got = sorted(tuple(r) for r in contained.containing_pairs(frame(spark, names), "t").collect())
    assert got == sorted({(a, b) for a in names if a for b in names if b and a != b and len(b) >= 4 and b.lower() in a.lower()})
    assert contained.containing_pairs(frame(spark, []), "t").count() == 0 and contained.occurrences(frame(spark, ["a"]), frame(spark, [], "n"), "t", "n").count() == 0


def test_both_directions(spark):
    left = frame(spark, ["glucose broth", "suc", "sucr", "Nothing here", "ABC"], "l")
    right = spark.createDataFrame([("glucose", 2), ("broth", 1), ("sucrose", 3), ("abc", 4)], "r string, pos int")
    got = {r.left_name: (r.right_name, r.method) for r in matching.respelled_best(left, right, "l", "r", "pos").collect()}
    assert got == {"glucose broth": ("broth", "partial"), "sucr": ("sucrose", "partial"), "ABC": ("abc", "exact")}


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_numbered(spark, parts):
    rng = random.Random(2)
    ids = [str(rng.randrange(50)) for _ in range(200)] + ["x1", "x10", "x2", "", None]
    df = spark.createDataFrame(list(enumerate(ids)), "k int, id string").repartition(parts)
    got = tables.numbered(df, [*tables.numeric_first(F.col("id")), F.col("k")])
    number = lambda s: int(s) if s and s.isdigit() else None
    order = sorted(enumerate(ids), key=lambda r: (number(r[1]) is None, number(r[1]) or 0, r[1] is not None, r[1] or "", r[0]))
    assert [(r.place, r.k) for r in got.orderBy("place").collect()] == [(i + 1, k) for i, (k, _) in enumerate(order)]
    assert tables.numbered(df.where("false"), [F.col("k")]).count() == 0


def test_properties_of_names_that_differ_in_case(spark):
    rows = [("NaCl", "58.44", None, "0", None, 3), ("NaCL", "1.0", None, "0", None, 1), ("Nacl", "58.44", None, "1", None, 2), ("NACL", "2.0", None, "0", None, 4), (None, "9", None, None, None, 5)]
    schema = "compound_name string, molecular_weight string, pka_values string, charge_states string, ion_charges string, pos int"
    seen = {"lower": set(), "pos": set(), "own": set()}
    for order, parts in itertools.product(itertools.islice(itertools.permutations(rows), 0, 120, 17), (1, 4)):
        df = spark.createDataFrame(list(order), schema).repartition(parts)
        seen["lower"].add(str(properties.property_table(df).collect()))
        seen["pos"].add(properties.property_table(df, pos="pos").first().molecular_weight)
        seen["own"].add(str(sorted((r.key, r.molecular_weight) for r in properties.property_table(df, lower_keys=False).collect())))
    assert len(seen["lower"]) == 1 and seen["pos"] == {1.0} and seen["own"] == {str(sorted((n, float(w)) for n, w, *_ in rows if n))}
    spelled = spark.createDataFrame([("NACL", "2.0", None, None, None, 0), ("nacl", "3.0", None, None, None, 1)], schema)
    assert properties.property_table(spelled).first().molecular_weight == 3.0


@pytest.mark.parametrize("parts", [1, 4])
def test_upserted_takes_the_first(spark, parts):
    old = spark.createDataFrame([("Agar", 1.0, 2), ("Agar", 2.0, 1), ("KCl", 3.0, 3)], "name string, weight double, pos int").repartition(parts)
    new = spark.createDataFrame([("agar", 9.0, 1), ("Tris", 5.0, 2), ("Tris", 4.0, 1)], "name string, weight double, pos int").repartition(parts)
    assert [tuple(r) for r in tables.upserted(old, new, "name", "pos").collect()] == [("Agar", 2.0), ("KCl", 3.0), ("Tris", 4.0)]
    assert [tuple(r) for r in tables.upserted(old.drop("pos"), new.drop("pos"), "name").collect()] == [("Agar", 1.0), ("KCl", 3.0), ("Tris", 4.0)]


def test_sorted_index(spark, tmp_path):
    """Lookups open only files whose range holds a name; keys of any script; last lines win across files."""
    rng = random.Random(5)
    keys = sorted({"".join(rng.choice("abcé日\U0001f600z") for _ in range(rng.randrange(1, 6))) for _ in range(600)})
    index = spark.createDataFrame([(k, str(i)) for i, k in enumerate(keys)], "key string, cid string")
    path = str(tmp_path / "index")
    lookups.write_sorted_index(index, path, 12)
    one = spark.createDataFrame([(keys[7],)], "key string")
    many = spark.createDataFrame([(k,) for k in keys], "key string")
    assert len(lookups.touched_files(one, path)) == 1 and 6 < len(lookups.touched_files(many, path)) <= 12
    assert lookups.touched_files(spark.createDataFrame([("",), (None,)], "key string"), path) == []
    for asked in (keys[:5], keys, ["nothing", None, "", keys[3].upper(), keys[3]], ["\x01"]):
        got = lookups.sorted_lookup(spark.createDataFrame([(k,) for k in asked], "name string"), path, "name").collect()
        known = {k: str(i) for i, k in enumerate(keys)}
        assert sorted((str(r.name), r.cid) for r in got) == sorted((str(k), known.get((k or "").lower().strip()) if k else None) for k in asked)


def test_order_of_lines_over_files(spark, tmp_path):
    for k, size in enumerate((3, 900, 1, 40)):
        (tmp_path / f"part{k}.tsv").write_text("".join(f"{k}-{i}\tname{i % 50}\n" for i in range(size)))
    rows = lookups.named_ids(spark, str(tmp_path)).orderBy("pos").collect()
    assert [r.cid for r in rows] == [f"{k}-{i}" for k, size in enumerate((3, 900, 1, 40)) for i in range(size)]
    none = spark.createDataFrame([], "cid string, name string, pos long")
    last = {r.key: r.cid for r in lookups.name_index(lookups.named_ids(spark, str(tmp_path)), none).collect()}
    assert last["name0"] == "3-0" and last["name45"] == "1-895" and last["name39"] == "3-39"


def test_base_media(spark):
    schema = "medium_id string, name string, concentration double, unit string, action string"
    base = lambda m, b: (f"jcm_{m}", f"Base Medium {b}", 1.0, "reference", "base")
    own = lambda m, n: (f"jcm_{m}", n, 1.0, "g", "table")
    gone = lambda m, n: (f"jcm_{m}", n, 0.0, "removed", "remove")
    rows = [own(1, "Agar"), own(1, "NaCl"), base(2, 1), own(2, "KCl"), gone(2, "agar"), base(3, 2), own(3, "Agar"), base(4, 3), base(5, 6), own(5, "A"), base(6, 5), own(6, "B"), base(7, 99), own(7, "C"), (None, "Agar", 1.0, "g", "table")]
    df = spark.createDataFrame(rows + rows[:1], schema).repartition(3)
    got = sorted((r.medium_id, r.name, r.action) for r in jcm.resolved(df).where("medium_id IS NOT NULL").collect())
    want = [("1", "Agar", "table"), ("1", "Agar", "table"), ("1", "NaCl", "table"), ("2", "KCl", "table"), ("2", "NaCl", "inherited"), ("3", "Agar", "table"), ("3", "KCl", "inherited"), ("3", "NaCl", "inherited")]
    want += [("4", "Agar", "inherited"), ("4", "KCl", "inherited"), ("4", "NaCl", "inherited"), ("5", "A", "table"), ("5", "B", "inherited"), ("6", "A", "inherited"), ("6", "B", "table"), ("7", "C", "table")]
    assert got == sorted((f"jcm_{m}", n, a) for m, n, a in want)
    assert sorted(tuple(r) for r in jcm.unresolved(df).collect()) == [("jcm_5", "cycle"), ("jcm_6", "cycle"), ("jcm_7", "missing")]
    assert jcm.resolved(df.where("false")).count() == 0
