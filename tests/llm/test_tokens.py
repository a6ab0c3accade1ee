import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brothlake.llm import bpe, tokencount

CODEC = bpe.codec(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_equals_the_library(docs, texts, library):
    got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs).collect())
    want = []
    for i, t, _ in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i or -1, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)


def test_bpe_round_trip(docs, texts):
    back = bpe.decoded(bpe.encoded(docs).select("doc_id", "ids"))
    assert sorted((r.doc_id or -1, r.text) for r in back.collect()) == sorted((i or -1, t or "") for i, t, _ in texts)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_bpe_any_text(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert CODEC.encode(text).tolist() == ids and CODEC.decode(ids) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=200))
def test_long_words_merge_alike(word):
    assert CODEC.merged(word) == bpe.merged_long(CODEC, word)


def test_empty_tables(no_docs):
    assert bpe.digests(no_docs).count() == 0 and tokencount.token_counts(no_docs).count() == 0


def brute_force(word, scores, longest):
    best = [(0.0, 0)] + [None] * len(word)
    byte = min(scores.values()) - 10.0
    for end in range(1, len(word) + 1):
        width = len(word[end - 1].encode())
        options = [(best[end - 1][0] + width * byte, -(best[end - 1][1] + width))]
        options += [(best[s][0] + scores[word[s:end]], -(best[s][1] + 1)) for s in range(max(0, end - longest), end) if word[s:end] in scores]
        score, tokens = max(options)
        best[end] = (score, -tokens)
    return best[-1][1]


def test_token_counts_equal_brute_force(docs, texts):
    scores = tokencount.unigram_scores(public_tokenizers.path("piece_bpe_32k.model"))
    longest = max(map(len, scores))
    want = []
    for i, t, _ in texts:
        words = [w for w in (t or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
        want.append((i or -1, len(words), sum(brute_force("▁" + w, scores, longest) for w in words)))
    assert sorted((r.doc_id or -1, r.n_words, r.n_tokens) for r in tokencount.token_counts(docs).collect()) == sorted(want)


def test_trie_shares_prefixes_and_starts_anew():
    trie = tokencount.Trie({"a": -1.0, "ab": -1.5, "b": -1.0}, nodes=4)
    assert [trie.count(w) for w in ("ab", "abab", "aba", "")] == [1, 2, 2, 0]
    assert trie.size <= 4 + 5
