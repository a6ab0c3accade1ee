"""Large JSON files in ranges of few bytes against a whole parse."""

import json
import random

import pytest
from pyspark.sql import functions as F

from brothlake.sources import json_ranges

PARTS = ["}", "{", '"', "\\", '\\"', "é", "\U0001f600", "a", " ", "\n", "],[", "null"]


def text_of(rng):
    return "".join(rng.choice(PARTS) for _ in range(rng.randrange(12)))


def record(rng, depth=0):
    values = [None, 1.5, True, text_of(rng), [text_of(rng), {"x": text_of(rng)}]] + ([record(rng, depth + 1)] if depth < 3 else [])
    return {text_of(rng): rng.choice(values) for _ in range(rng.randrange(4))}


@pytest.fixture(params=["4", "37", "1000000"])
def ranged(spark, request):
    keys = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def read(spark, folder, level=1):
    rows = json_ranges.objects(spark, str(folder), level).collect()
    return [json.loads(r.content) for r in sorted(rows, key=lambda r: (r.path, r.number))]


def test_equals_a_whole_parse(ranged, tmp_path):
    rng = random.Random(1)
    files = [[record(rng) for _ in range(n)] for n in (25, 0, 1)]
    for i, rows in enumerate(files):
        (tmp_path / f"a{i}.json").write_text(json.dumps(rows, ensure_ascii=i == 1, indent=None if i < 2 else 1), encoding="utf-8")
    assert read(ranged, tmp_path) == [r for rows in files for r in rows]


def test_levels(ranged, tmp_path):
    rng = random.Random(2)
    rows = [{"r": record(rng)} for _ in range(9)]
    (tmp_path / "a.json").write_text(json.dumps({"head": {"a": "}"}, "data": rows, "tail": 1}))
    assert read(ranged, tmp_path, 2) == [{"a": "}"}, *rows]
    assert read(ranged, tmp_path, 3) == [r["r"] for r in rows]


@pytest.mark.parametrize("text, want", [('[{"a": 1}, {"b": "x', [{"a": 1}]), ('{"a": "}"', []), ('{"a": 1}', [{"a": 1}]), ("[1, null, \"{}\"]", []), ('{"a": {}}\n{}\n', [{"a": {}}, {}]), (" ", []), ('{"a": "\\\\"}', [{"a": "\\"}])])
def test_cut_and_other_files(spark, tmp_path, text, want):
    (tmp_path / "a.json").write_text(text)
    assert read(spark, tmp_path) == want


def test_one_line_is_read_by_many_tasks(spark, tmp_path):
    rows = [{"k": i, "t": "}{" * (i % 5), "n": {"x": None}} for i in range(3_000)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = json_ranges.objects(spark, str(tmp_path))
        assert json_ranges._pieces(spark, str(tmp_path)).select("block").distinct().count() > 4
        got = found.select(F.from_json("content", "k int, t string").alias("r")).select("r.*").orderBy("k").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r.k, r.t) for r in got] == [(r["k"], r["t"]) for r in rows]
