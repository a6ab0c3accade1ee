import base64
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from brothlake.llm import ann, mixing, warc


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def water_filled(sizes):
    """Targets of the sources by sharing out what is above a limit again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values())
    while left > 1e-9:
        open_ = [s for s in names if target[s] < 2 * sizes[s] - 1e-9]
        total, given = sum(weight[s] for s in open_), 0.0
        for s in open_:
            more = min(left * weight[s] / total, 2 * sizes[s] - target[s])
            target[s] += more
            given += more
        left -= given
    return target


def test_mix_reaches_its_targets(docs, texts):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(texts)
    sizes, taken = {}, {}
    for _, t, s in texts:
        sizes[s] = sizes.get(s, 0) + size_of(t)
    targets = water_filled(sizes)
    for r in mixing.mix(docs, carry=("source",)).collect():
        assert r.taken in (0, r.size, 2 * r.size)
        assert r.target == pytest.approx(targets[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    largest = max(size_of(t) for _, t, _ in texts)
    assert sum(taken.values()) <= 1.5 * sum(sizes.values()) and all(abs(taken[s] - targets[s]) <= 2 * largest for s in sizes)


def test_mix_equals_its_sql(spark, docs):
    plain = docs.where("doc_id IS NOT NULL AND doc_id NOT IN (0, 1)").select("doc_id", "text", "source")
    documents = plain.toPandas()  # noqa: F841  read by DuckDB
    want = duckdb.sql(mixing.ORACLE).fetchall()
    got = [tuple(r) for r in mixing.mix(plain, block_rows=3).collect()]
    key = lambda rows: sorted((a, b, c, round(d, 6), e) for a, b, c, d, e in rows)
    assert key(got) == key(want)
    assert key([tuple(r) for r in mixing.mix(plain.repartition(7)).collect()]) == key(got)


def test_mixed_documents(docs, no_docs):
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    want = sum((r.taken // r.size for r in mixing.mix(docs).where("taken > 0").collect()))
    assert out.count() == want > 0
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def vectors(spark, n=400, d=16):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(d).tolist()) for i in range(n)]
    rows[7] = (7, rows[50][1])
    rows[8] = (8, rows[50][1])
    odd = [(1000, None), (1050, [0.0] * d), (1100, [math.nan] * d), (1150, [1.0, None] * (d // 2)), (1200, [math.inf] * d), (1250, [1.0]), (None, rows[0][1]), (1300, [])]
    return spark.createDataFrame([(i, v, "x", 1) for i, v in [*rows, *odd, rows[60]]], "vec_id long, embedding array<float>, cell string, rank int")


def exact(rows, top=5):
    ids = np.array([r.vec_id for r in rows])
    v = np.array([r.embedding for r in rows], np.float64)
    out = {}
    for q in np.flatnonzero(ids % 50 == 0):
        score = (v * v[q]).sum(1) / (np.sqrt((v * v).sum(1)) * np.sqrt((v[q] * v[q]).sum()))
        score[ids == ids[q]] = -np.inf
        out[ids[q]] = [(int(ids[i]), score[i]) for i in np.lexsort((ids, -score))[:top]]
    return out


def test_search(spark):
    df = vectors(spark)
    want = exact(df.where("vec_id < 1000").collect())
    whole = ann.nearest(df, F.col("vec_id") % 50 == 0, probe_share=1.0, chunk_rows=16).collect()
    got = {}
    for r in sorted(whole, key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    assert all(a[1] == pytest.approx(b[1], abs=1e-12) for q in want for a, b in zip(got[q], want[q]))
    part = ann.nearest(df, F.col("vec_id") % 50 == 0).collect()
    hits = sum(r.vec_id in [i for i, _ in want[r.query_id]] for r in part)
    assert hits / sum(map(len, want.values())) >= 0.9 and all(r.vec_id != r.query_id for r in part)


def test_search_of_clusters_visits_little(spark):
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((40, 24)) * 4
    rows = [(i, (centres[i % 40] + rng.standard_normal(24) * 0.3).tolist()) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = ann.usable(df)
    books = ann.codebooks(index)
    celled = ann.with_cells(index, books).cache()
    sizes = {r["cell"]: r["count"] for r in celled.groupBy("cell").count().collect()}
    assert ann.needed_share(celled, celled.where("vec_id % 50 = 0"), books, sizes, 5) < 0.2
    want = exact(df.collect())
    hits = sum(r.vec_id in [i for i, _ in want[r.query_id]] for r in ann.nearest(df, F.col("vec_id") % 50 == 0).collect())
    assert hits / sum(map(len, want.values())) >= 0.9


def test_search_of_repeated_ids_and_huge_components(spark):
    rng = np.random.default_rng(12)
    base = rng.standard_normal((60, 8))
    rows = [(i, (v * 1e200).tolist()) for i, v in enumerate(base)] + [(0, (base[30] * 1e-200).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(df, F.col("vec_id") == 0, probe_share=1.0).collect()
    assert sorted(r["rank"] for r in got) == sorted([1, 2, 3, 4, 5] * 2)
    assert any(r.vec_id == 30 and r.score == pytest.approx(1.0, abs=1e-12) for r in got)


def test_search_small_and_empty(spark):
    df = vectors(spark)
    assert ann.nearest(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0
    assert ann.nearest(df.where("vec_id IN (0, 1, 2)"), F.col("vec_id") % 50 == 0).count() == 2
    assert ann.nearest(df.where("vec_id >= 1000"), F.col("vec_id") % 50 == 0).count() == 0


def test_cells_come_in_order_of_distance():
    rng = np.random.default_rng(6)
    a, b = rng.random(7), rng.random(5)
    order = list(ann.cell_order(a, b))
    assert len(set(order)) == 35
    sums = [a[i] + b[j] for i, j in order]
    assert sums == sorted(sums)


PAGES = [(5, "http://a/x y\r\nInjected: 1", "same é"), (3, None, "same é"), (9, "http://b", "same é"), (1, "u", None), (2, "u", ""), (4, "u", "WARC/1.1\r\nfake\r\n\r\n\r\n" * 5), (6, "u", "z" * 200_000), (None, "u", "same é"), (None, "u", "alone"), (3, None, "same é")]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, digest string, first string")
    firsts = {}
    for i, _, h in PAGES:
        if i is not None:
            firsts[h or ""] = min(firsts.get(h or "", i), i)
    want = []
    for i, _, h in PAGES:
        raw, first = (h or "").encode(), firsts.get(h or "")
        revisit = first is not None and first != i
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    got = [tuple(r) for r in warc.archived(pages).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert warc.archived(pages.where("false")).count() == 0


def test_small_payloads_stay_responses(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    assert all(not r.revisit for r in warc.marked_revisits(pages, least_bytes=1_000_000).collect())


def read(data):
    found = list(warc.salvage(data))
    return [warc.page_row(x)[0] for x in found if isinstance(x, warc.Record)], [x for x in found if isinstance(x, warc.Gap)]


def test_salvage_of_members():
    parts = [warc.member(warc.record(i, "http://x", b"text %d " % i * 400)) for i in range(5)]
    assert read(b"".join(parts)) == ([0, 1, 2, 3, 4], [])
    torn = parts[1][:40] + b"\x00" * 7 + parts[1][47:]
    ids, gaps = read(parts[0] + torn + b"junk\x1f\x8bjunk" + parts[2] + parts[3][:-30])
    assert ids == [0, 2] and [g.start for g in gaps][0] == len(parts[0]) and gaps[-1].end == len(parts[0] + torn) + 10 + len(parts[2]) + len(parts[3]) - 30
    assert all(g.reason for g in gaps)


def test_salvage_of_a_cut_member_of_many_records():
    records = [warc.record(i, "u", bytes(np.random.default_rng(i).integers(0, 256, 40_000, np.uint8))) for i in range(3)]
    packed, after = warc.member(b"".join(records)), warc.member(warc.record(9, "u", b"x"))
    ids, gaps = read(packed[: int(len(packed) * 0.85)])
    assert ids == [0, 1] and len(gaps) == 1 and gaps[0].end == int(len(packed) * 0.85) and len(packed) / 3 < gaps[0].start < len(packed) * 0.7
    at = int(len(packed) * 0.8)
    ids, gaps = read(packed[:at] + bytes(200) + packed[at + 200 :] + after)
    assert ids[:2] == [0, 1] and ids[-1] == 9 and gaps


def test_salvage_of_plain_records():
    a, b, c = (warc.record(i, "u", b"payload WARC/1.1\r\n of %d" % i) for i in range(3))
    wrong = b.replace(b"of 1", b"of 7")
    ids, gaps = read(a + wrong + c)
    assert ids == [0, 2] and gaps[0].start == len(a) and "digest" in gaps[0].reason
    short = b.replace(b"Content-Length: ", b"Content-Length: 9", 1)
    assert read(a + short + c)[0] == [0, 2]
    assert read(a + b[:50])[0] == [0] and read(b"") == ([], []) and read(b"no archive")[0] == []
    broken = zlib.compress(b"x")
    assert read(broken + a)[0] == [0]


def test_gaps_are_logged(spark, tmp_path):
    path = tmp_path / "a.warc.gz"
    good = warc.member(warc.record(1, "u", b"x"))
    path.write_bytes(good + b"damage" + good)
    manifest = spark.createDataFrame([(str(path),)], "path string")
    assert [(r.gap_start, r.gap_end) for r in warc.read_gaps(manifest).collect()] == [(len(good), len(good) + 6)]
    assert warc.read_archives(manifest).count() == 2


@pytest.mark.parametrize("kind", ["uniform", "clustered"])
def test_recall_on_5000_vectors(spark, kind):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(5_000, 24))
    if kind == "clustered":
        x = rng.normal(size=(60, 24))[rng.integers(0, 60, 5_000)] * 3 + x * 0.4
    x = x.astype(np.float32).astype(float)
    table = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>").repartition(6)
    got = ann.nearest(table, F.col("vec_id") % 10 == 0).toPandas()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q, rows in got.groupby("query_id"):
        score = unit @ unit[q]
        score[q] = -2
        hits += len(set(rows["vec_id"]) & set(np.argsort(-score)[:5]))
    assert hits >= 0.95 * 5 * 500
