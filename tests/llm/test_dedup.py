import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from brothlake.llm import components, ngram_join, substrings
from brothlake.llm import words as W

from .conftest import sentence


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, k=3):
    w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def grouped(rows, k=3, percent=90):
    """doc_id, size and smallest reachable doc_id of each row, pair by pair."""
    sets = [shingles(t, k) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (doc, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc or -1, len(sets[i]), min(ids) if ids and sets[i] else doc if not sets[i] else None))
    return sorted(out, key=str)


def test_join_equals_brute_force(docs, texts):
    got = [(r.doc_id or -1, r.n_shingles, r.component_id) for r in ngram_join.joined(docs).collect()]
    assert sorted(got, key=str) == grouped(texts)


@pytest.mark.parametrize("k, percent, tile_rows", [(3, 90, 4), (5, 80, 2048), (5, 80, 5)])
def test_join_of_many_near_copies(spark, k, percent, tile_rows):
    """A family of copies that drift apart, in tiles split into blocks."""
    rng = random.Random(3)
    words, rows = sentence(rng, 120).split(), []
    for i in range(60):
        rows.append((1000 - i, " ".join(words)))
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
    rows += [(i, sentence(rng, 50, 50)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id or -1, r.n_shingles, r.component_id) for r in ngram_join.joined(df, k=k, percent=percent, tile_rows=tile_rows).collect()]
    assert sorted(got, key=str) == grouped(rows, k, percent)


def test_join_of_one_large_group(spark, tmp_path):
    """Links grow with the rows of a group, not with its pairs, in one block or in many."""
    rng = random.Random(5)
    base, rows = sentence(rng, 120, 3000).split(), []
    for i in range(1200):
        words = list(base)
        words[rng.randrange(len(words))] = f"n{i}"
        rows.append((i, " ".join(words)))
    rows += [(5000 + i, sentence(rng, 60, 3000)) for i in range(50)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    for tile_rows in (4096, 300):
        got = {r.doc_id: r.component_id for r in ngram_join.joined(docs, k=5, percent=80, tile_rows=tile_rows).collect()}
        assert got == {i: 0 if i < 5000 else i for i, _ in rows}


def test_forest_equals_all_pairs():
    rng = np.random.default_rng(8)
    for _ in range(60):
        base = rng.choice(200, 30, replace=False)
        sets = [np.unique(np.where(rng.random(30) < 0.08, rng.integers(0, 400, 30), base)).astype(np.uint64) for _ in range(rng.integers(2, 25))]
        comp = rng.integers(0, 20, len(sets))
        ways = [ngram_join.forest(sets, comp, 80), [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(set(sets[i]) & set(sets[j])) >= 80 * len(set(sets[i]) | set(sets[j]))]]
        roots = []
        for links in ways:
            root = list(comp)
            for i, j in links:
                root = [root[j] if r == root[i] else r for r in root]
            roots.append([root.index(r) for r in root])
        assert roots[0] == roots[1] and len(ways[0]) < len(sets)


def test_batches_by_tile():
    rng = np.random.default_rng(2)
    tokens = np.sort(rng.integers(0, 12, 90))
    whole = pa.record_batch({"token": tokens, "i": np.zeros(90, np.int32), "j": np.zeros(90, np.int32), "row": np.arange(90)})
    for size in (1, 2, 7, 90):
        out = list(ngram_join.by_tile(whole.slice(at, size) for at in range(0, 90, size)))
        assert np.concatenate([b.column("row").to_numpy() for b in out]).tolist() == list(range(90))
        owners = [set(b.column("token").to_pylist()) for b in out]
        assert sum(map(len, owners)) == len(set(tokens))


def test_bitmap_bound_loses_nothing():
    rng = np.random.default_rng(4)
    for _ in range(200):
        x = np.unique(rng.integers(0, 1 << 62, rng.integers(1, 400)).astype(np.uint64))
        y = np.unique(np.concatenate([rng.choice(x, max(1, int(len(x) * rng.uniform(0.8, 1))), replace=False), rng.integers(0, 1 << 62, rng.integers(0, 20)).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both >= 90 * (len(x) + len(y) - both):
            bits = ngram_join.Bitmaps(np.array([ngram_join.bitmap(x), ngram_join.bitmap(y)], object))
            differ = bits.differing(np.array([0]), bits, np.array([1]))
            assert ngram_join.may_link(np.array([len(x)]), np.array([len(y)]), differ, 90)[0]


def test_representatives(docs, no_docs):
    kept = ngram_join.representatives(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 20 in ids and not {21, 22, 30} & set(ids) and ids.count(0) == 1 and {50, 51, 53, 54} <= set(ids)
    assert ngram_join.representatives(no_docs).count() == 0 and ngram_join.joined(no_docs).count() == 0


def test_clashing_names_and_null_ids(spark):
    rng = random.Random(6)
    text, other = sentence(rng, 80), sentence(rng, 80)
    rows = [(1, text, "a", 1), (2, text, "b", 2), (None, other, "c", 3), (None, other, "d", 4), (None, sentence(rng, 80), "e", 5), (3, None, "f", 6), (3, "", "g", 7)]
    for names in (("node", "first_id"), ("_node", "_of"), ("_sha", "_spans"), ("_size", "_copies"), ("of", "source")):
        docs = spark.createDataFrame(rows, f"doc_id long, text string, {names[0]} string, {names[1]} long")
        kept = ngram_join.representatives(docs)
        assert kept.columns == docs.columns
        assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "None", "None"]
        assert substrings.cut_documents(docs).columns == docs.columns
        assert substrings.cut_documents(docs).where("text = ''").count() == 2


def test_joined_components(spark):
    frame = lambda xs: spark.createDataFrame(xs, "a long, b long")
    rng = random.Random(2)
    for n in (5, 40):
        first, more = ([(rng.randrange(60), rng.randrange(60)) for _ in range(n)] for _ in range(2))
        want = {r.node: r.root for r in components.components(frame(first + more)).collect()}
        assert {r.node: r.root for r in components.joined_components(components.components(frame(first)), frame(more)).collect()} == want
    assert components.joined_components(components.components(frame([(1, 2)])), frame([])).count() == 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 5), (200, 201), (201, 200), (7, 7), (300, 300)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(2, 61)}, 100: 1, 201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def kept_words(rows, window=50):
    firsts = {}
    for doc, text, *_ in rows:
        w = words_of(text)
        for i in range(len(w) - window + 1):
            if doc is not None:
                key = tuple(w[i : i + window])
                firsts[key] = min(firsts.get(key, doc), doc)
    out = []
    for doc, text, *_ in rows:
        w = words_of(text)
        gone = {j for i in range(len(w) - window + 1) if doc is not None and firsts[tuple(w[i : i + window])] < doc for j in range(i, i + window)}
        left = [x for j, x in enumerate(w) if j not in gone]
        out.append((doc or -1, len(w), len(gone), hashlib.sha256(" ".join(left).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"shard_words": 60, "stream_chars": 500, "many_shards": 10**6}, {"shard_words": 60, "many_shards": 0}])
def test_substrings_equal_brute_force(docs, texts, options):
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.deduplicated(docs, **options).collect())
    assert got == kept_words(texts)


def test_substrings_of_variants(spark):
    """Passages that overlap, repeat within a text, and recur with changes."""
    rng = random.Random(9)
    pool = [sentence(rng, n, 50) for n in (60, 80, 55, 49)]
    rows = []
    for i in range(60):
        parts = [sentence(rng, rng.randrange(1, 40), 50)]
        for _ in range(rng.randrange(4)):
            w = rng.choice(pool).split()
            cut = rng.randrange(0, 12)
            parts += [" ".join(w[cut:]), sentence(rng, rng.randrange(0, 9), 50)]
        rows.append((i * 7 % 61, "  \n".join(parts)))
    rows += [(70, "For " * 120), (71, "x " + "For " * 90), (72, "For " * 49)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for options in ({}, {"shard_words": 200, "many_shards": 1}):
        got = sorted((r.doc_id or -1, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.deduplicated(df, **options).collect())
        assert got == kept_words(rows)


def test_cut_documents_agree_with_digests(docs, no_docs):
    cut = substrings.cut_documents(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    got = sorted((r.doc_id or -1, hashlib.sha256(" ".join(words_of(r.text)).encode()).hexdigest()) for r in cut.collect())
    assert got == sorted((r.doc_id or -1, r.kept_sha256) for r in substrings.deduplicated(docs).collect())
    assert substrings.deduplicated(no_docs).count() == 0 and substrings.cut_documents(no_docs).count() == 0


def test_word_blocks_equal_the_pattern(texts):
    values = [t for _, t, _ in texts]
    for block_bytes in (1, 500, 1 << 20):
        for block in W.blocks(pa.array(values, pa.string()), block_bytes=block_bytes):
            for i, (a, b) in enumerate(zip(block.bounds[:-1], block.bounds[1:])):
                got = [block.data[s:e].tobytes().decode() for s, e in zip(block.starts[a:b], block.ends[a:b])]
                assert got == words_of(values[block.first + i])


def test_long_texts_hash_alike():
    rng = np.random.default_rng(1)
    text = " ".join(str(x) for x in rng.integers(0, 10**6, 900_000))
    whole = next(W.blocks(pa.array([text], pa.string())))
    at = text.index(" ", 3_000_000) + 1
    parts = [next(W.blocks(pa.array([x], pa.string()))) for x in (text[:at], text[at:at + 1_000_000].rpartition(" ")[0])]
    joined = np.concatenate([p.hashes for p in parts])
    assert (whole.hashes[: len(joined)] == joined).all()
    some = W.mixed(np.arange(2_500_000, dtype=np.uint64))
    assert (W.grams(some, 50)[1_048_000:1_049_000] == W.grams(some[1_048_000:1_049_049], 50)).all()
