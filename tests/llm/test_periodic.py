import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brothlake.llm import periodic
from brothlake.llm import words as W


def brute_force(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(12, 2 * q):
                found.setdefault((start, i + q - start), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def found(words):
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    block = next(W.blocks(pa.array([" ".join(words)])))
    rows = [tuple(r) for r in periodic.runs(ids, periodic.next_places(block)).tolist()]
    assert rows == sorted(rows, key=lambda r: (r[0], r[2]))
    return sorted(rows)


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def thue_morse(n):
    s = "0"
    while len(s) < n:
        s += s.translate(str.maketrans("01", "10"))
    return list(s[:n])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), min_size=1, max_size=120))
def test_few_letters(words):
    assert found(words) == brute_force(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=25), st.integers(1, 7), st.lists(st.integers(0, 3), max_size=20), st.lists(st.integers(0, 3), max_size=20))
def test_powers(root, times, before, after):
    words = list(map(str, before + root * times + after))
    assert found(words) == brute_force(words)


@pytest.mark.parametrize("words", [["a"] * 300, ["a"] * 11, ["a"] * 12, ["a", "b"] * 6, fibonacci(400), thue_morse(600), (["a"] * 17 + ["b"]) * 9 + ["a"] * 40, ["x"], list("abcdef") * 2, list("abcdefg") * 2])
def test_known_sequences(words):
    assert found(words) == brute_force(words)


def test_long_sequences_take_little_more_than_linear_time():
    began = time.perf_counter()
    assert found(["a"] * 150_000) == [(0, 150_000, 1)]
    assert len(found(fibonacci(60_000))) > 10_000
    assert len(found((["a"] * 500 + ["b"]) * 100)) == 101
    assert time.perf_counter() - began < 60


def test_hashes_that_collide_do_no_harm(monkeypatch):
    """Words on which prefix hashes modulo a power of two agree though the words differ."""
    words = thue_morse(1 << 12) + ["|"] + thue_morse(1 << 13)
    assert found(words) == brute_force_fast(words)
    monkeypatch.setattr(periodic.Extension, "_equal", lambda self, at, size, q: np.ones(len(at), bool))
    short = list("abcabcabcabcabcabx") + ["y"] * 14
    assert found(short) == brute_force(short)


def brute_force_fast(words):
    ids, found = np.unique(words, return_inverse=True)[1], {}
    for q in range(1, len(ids) // 2 + 1):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (ids[:-q] == ids[q:]).astype(int), [0]])))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if e - s + q >= max(12, 2 * q):
                found.setdefault((s, e - s + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeated(i, text):
    words = words_of(text)
    if i is None or not words or zlib.crc32(str(i).encode()) % 10:
        return words
    g, n = zlib.crc32(str(i).encode()) // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]


def digest(i, words):
    rows = brute_force_fast(words) if words else []
    rows.sort(key=lambda r: (r[0], r[2]))
    best = min(rows, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    gone = {k for s, n, q in rows for k in range(s + q, s + n)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return i if i is not None else -1, len(rows), *best, 1000 * best[1] // best[2] if rows else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in rows)), sha(" ".join(w for k, w in enumerate(words) if k not in gone))


def key(row):
    return tuple((x is not None, x) for x in row)


def rows_of(df):
    return sorted(((r.doc_id if r.doc_id is not None else -1, *r[1:]) for r in df.collect()), key=key)


def test_documents_equal_brute_force(spark, docs, texts):
    rng = random.Random(3)
    more = [(100 + i, " ".join([f"w{rng.randrange(9)}" for _ in range(rng.randrange(60))] * rng.randrange(1, 5))) for i in range(60)]
    more += [(200, " \t".join(["é", "日本"] * 9)), (201, "a\n" * 12), (202, "\x0b".join("abcdef" * 3)), (203, "a\xa0a " * 12)]
    table = docs.select("doc_id", "text", "token").unionByName(spark.createDataFrame([(i, t, "x") for i, t in more], "doc_id long, text string, token string"))
    every = [(i, t) for i, t, _ in texts if len(t or "") < 100_000] + more
    got = periodic.digests(periodic.periodic_runs(table.where("text IS NULL OR length(text) < 100000")))
    assert rows_of(got) == sorted((digest(i, words_of(t)) for i, t in every), key=key)
    got = periodic.digests(periodic.periodic_runs(periodic.repeating(table.where("text IS NULL OR length(text) < 100000"))))
    assert rows_of(got) == sorted((digest(i, repeated(i, t)) for i, t in every), key=key)


def test_collapsed_texts_and_spans(spark):
    text = "start " + "alpha beta gamma " * 5 + "end"
    row = periodic.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(1, 15, 3)] and row.collapsed == "start alpha beta gamma end"


def test_empty_tables(no_docs):
    assert periodic.digests(periodic.periodic_runs(periodic.repeating(no_docs))).count() == 0


def test_query(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = periodic.query(spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes) | {"runs_sha256": "string"} == {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"}
    assert rows_of(got) == sorted((digest(r.doc_id, repeated(r.doc_id, r.text)) for r in table), key=key)
