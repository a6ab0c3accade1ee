"""Token counts under a unigram vocabulary, by dynamic programming over a shared trie.

Distinct pre-tokens go into a trie. A node is a prefix, and its forward score,
the best sum of piece scores over all ways to cut the prefix, is computed once
for all words that begin with it. A word's count of tokens stays at its last
node.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame

from .words import WORD_PATTERN

#: Nodes before a task's trie starts anew, and the characters of a word that it shares.
TRIE_NODES, SHARED_CHARS = 1_200_000, 48

SPACE = "▁"
SCHEMA = "doc_id long, n_words long, n_tokens long"


def unigram_scores(path: str) -> dict[str, float]:
    """Log-probabilities of the pieces of a public vocabulary, by Zipf's law over its order; nothing is trained.

    The file's own order is by merge, so a piece's place is its rank. Control
    and byte pieces are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    total = math.log(sum(1 / (r + 1) for r in range(1, len(pieces) + 1)))
    return {piece: -math.log(r + 1) - total for r, piece in enumerate(pieces, 1)}


class Trie:
    """Forward scores and token counts of prefixes.

    Nodes are numbers; one table leads from a node and a character to a node,
    and two lists hold score and tokens. An automaton of the vocabulary tells
    the pieces that end at each new node. A character that no piece covers is
    written as its UTF-8 bytes: a token a byte, each worse than any piece.
    """

    def __init__(self, scores: dict[str, float], nodes: int = TRIE_NODES):
        import ahocorasick

        self.most = nodes
        self.byte = min(scores.values(), default=0.0) - 10.0
        self.pieces = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.pieces.add_word(piece, (len(piece), score))
        self.pieces.make_automaton()
        self.clear()

    def clear(self) -> None:
        self.edges, self.best, self.tokens = {}, [0.0], [0]

    @property
    def size(self) -> int:
        return len(self.best)

    def count(self, word: str) -> int:
        """Tokens of one pre-token: of equal scores, the fewest. Prefixes beyond SHARED_CHARS are scored but not stored."""
        if len(self.best) > self.most:
            self.clear()
        edges, node, best, tokens = self.edges, 0, [0.0], [0]
        for c in word[:SHARED_CHARS]:
            after = edges.get(node << 21 | ord(c))
            if after is None:
                break
            node = after
            best.append(self.best[node])
            tokens.append(self.tokens[node])
        known, ending = len(best) - 1, {}
        if known < len(word):
            for end, piece in self.pieces.iter(word):
                if end >= known:
                    ending.setdefault(end, []).append(piece)
        for at in range(known, len(word)):
            c = word[at]
            width = 1 if c < "\x80" else len(c.encode("utf-8", "surrogatepass"))
            score, count = best[at] + width * self.byte, tokens[at] + width
            for length, value in ending.get(at, ()):
                other, more = best[at + 1 - length] + value, tokens[at + 1 - length] + 1
                if other > score or (other == score and more < count):
                    score, count = other, more
            best.append(score)
            tokens.append(count)
            if at < SHARED_CHARS:
                key, node = node << 21 | ord(c), len(self.best)
                edges[key] = node
                self.best.append(score)
                self.tokens.append(count)
        return tokens[-1]


class _Counts(dict):
    """Counts of the distinct pre-tokens of a task."""

    def __init__(self, trie: Trie):
        self.trie = trie

    def __missing__(self, word: str) -> int:
        n = self.trie.count(SPACE + word)
        if len(word) <= SHARED_CHARS:
            if len(self) >= self.trie.most:
                self.clear()
            self[word] = n
        return n


_counters: dict[str, _Counts] = {}


def counter(path: str) -> _Counts:
    if path not in _counters:
        _counters[path] = _Counts(Trie(unigram_scores(path)))
    return _counters[path]


def token_counts(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    """For each row of docs its doc_id, words and tokens of its whole text.

    Pre-tokens are the words between white space (0x20, 0x09-0x0D), each with
    the vocabulary's space mark before it. A null or empty text has none of
    either. Null doc_ids and repeated rows give a row each; an empty table
    gives none; other columns are ignored. Each task keeps its own bounded
    trie, so nothing is shuffled.
    """

    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = counter(public_tokenizers.path(vocabulary))
        find = re.compile(WORD_PATTERN).findall
        for batch in batches:
            words = [find(text or "") for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_words": [len(w) for w in words], "n_tokens": [sum(map(counts.__getitem__, w)) for w in words]})
        counts.clear()
        counts.trie.clear()

    return docs.select("doc_id", "text").mapInPandas(kernel, SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
