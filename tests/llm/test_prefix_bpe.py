import base64
import hashlib
import time

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brothlake.llm import prefix_bpe

FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = prefix_bpe.ranks(FILE)
MIXED = st.text(alphabet="aab  'srelvtdm\n\t1é日xX!-\U0001f600\x1c ", max_size=40)


@pytest.fixture(scope="module")
def library():
    import tiktoken

    with open(FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def row(i, ids, raw):
    return i or -1, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(raw).hexdigest()


def test_digests_equal_the_library(docs, texts, library):
    got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in prefix_bpe.digests(docs).collect())
    want = [(i, library.encode_ordinary(t or "")) for i, t, _ in texts]
    assert got == sorted(row(i, ids, library.decode_bytes(ids)) for i, ids in want)


def test_query_reads_whole_texts(spark, library):
    got = prefix_bpe.query(spark, "/root/testdata/sf0.001")
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = [row(r.doc_id, library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in rows]
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()) == sorted(want)


def test_round_trip_and_empty_tables(docs, texts, no_docs):
    back = prefix_bpe.decoded(prefix_bpe.encoded(docs))
    assert sorted((r.doc_id or -1, bytes(r.raw)) for r in back.collect()) == sorted((i or -1, (t or "").encode()) for i, t, _ in texts)
    assert prefix_bpe.digests(no_docs).count() == 0 and prefix_bpe.decoded(prefix_bpe.encoded(no_docs)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.one_of(MIXED, st.text(max_size=60)))
def test_any_text(library, text):
    assert RANKS.encode(text) == library.encode_ordinary(text) and RANKS.decode(RANKS.encode(text)) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=120), st.binary(max_size=40), st.data())
def test_appended_and_replaced_bytes(library, raw, more, data):
    word = prefix_bpe.Prefixes(RANKS, raw)
    kept = list(word.last)
    word.append(more)
    assert word.last[: len(kept)] == kept and word.ids() == library._encode_single_piece(raw + more)
    start = data.draw(st.integers(0, len(word.raw)))
    stop = data.draw(st.integers(start, len(word.raw)))
    word.replace(start, stop, more)
    fresh = prefix_bpe.Prefixes(RANKS, word.raw)
    assert word.last == fresh.last and (not word.raw or word.ids() == library._encode_single_piece(word.raw))


@settings(max_examples=300, deadline=None)
@given(MIXED, st.lists(st.tuples(st.integers(0, 50), st.integers(0, 6), st.text(alphabet="ab '\nx1é", max_size=5)), max_size=4))
def test_edited_texts(library, text, edits):
    state = prefix_bpe.Edited(RANKS, text)
    for at, n, new in edits:
        at = min(at, len(state.text))
        state.replace(at, min(len(state.text), at + n), new)
        assert state.ids() == library.encode_ordinary(state.text)


def test_edits_work_out_little(library):
    text = "the quick brown fox, 12 times; " * 2_000
    state = prefix_bpe.Edited(RANKS, text)
    state.replace(30_000, 30_003, "slow")
    assert state.worked < 40 and state.ids() == library.encode_ordinary(state.text)
    state.append("and more")
    assert state.worked < 40 and state.ids() == library.encode_ordinary(state.text)
    word = prefix_bpe.Prefixes(RANKS, b"internationalisation" * 500)
    assert word.replace(4_000, 4_001, b"q") < 4 * RANKS.longest and word.ids() == library._encode_single_piece(word.raw)


def test_long_words_take_linear_time(library):
    began = time.perf_counter()
    for word in ("x" * 300_000, "ab" * 150_000, "=" * 300_000):
        assert RANKS.encode(word) == library.encode_ordinary(word)
    assert time.perf_counter() - began < 30


def test_edited_rows(spark, library):
    rows = [
        (1, "one two", [(0, 3, "three"), (None, None, " four"), None]),
        (2, None, [(5, 9, "new")]),
        (3, "", None),
        (None, "kept as it is", []),
        (4, "abcdef", [(-3, 2, None), (99, 1, "z"), (3, 1, "y")]),
        (4, "abcdef", [(-3, 2, None), (99, 1, "z"), (3, 1, "y")]),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, edits array<struct<start int, stop int, text string>>, ids string")
    after = [(1, "three two four"), (2, "new"), (3, ""), (None, "kept as it is"), (4, "cdeyfz"), (4, "cdeyfz")]
    got = prefix_bpe.edited(docs).collect()
    assert sorted((r.doc_id or -1, list(r.ids)) for r in got) == sorted((i or -1, library.encode_ordinary(t)) for i, t in after)
    assert prefix_bpe.edited(docs.where("false")).count() == 0
