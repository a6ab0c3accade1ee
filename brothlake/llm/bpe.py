"""Byte-level BPE encoding and decoding with a contiguous rank array.

A pre-token of n bytes is n parts: one array holds the part boundaries, another
beside it the rank of each part joined with its right neighbour. The smallest
rank is found by a scan, its boundary is deleted, and the ranks of the two
neighbours are looked up again, until no rank is left. Words are short, so the
scans are cheaper than a heap; each distinct word is merged once a task, and its
ids are kept, as digits with commas between, for its other places.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Splits text into pre-tokens; \p{White_Space} is the tokenizer's \s.
PATTERN = regex.compile(public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))

#: A cached word's bytes at most, and cached words at most before the cache starts anew.
CACHED_BYTES, CACHED_WORDS = 64, 150_000

#: Rows in a batch that a task returns.
ROWS = 512

NO_RANK = 1 << 30
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file: itself where it is printable, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        letters = byte_alphabet()
        to_byte = {c: b for b, c in enumerate(letters)}
        spelled = lambda token: bytes(to_byte[c] for c in token)
        vocab = model["model"]["vocab"]
        self.id_of = {spelled(token): i for token, i in vocab.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.size = 1 + max(self.id_of.values())
        self.rank = {self.id_of[spelled(a)] * self.size + self.id_of[spelled(b)]: r for r, (a, b) in enumerate(merges)}
        self.joined = [self.id_of[spelled(a) + spelled(b)] for a, b in merges]
        self.byte_ids = [self.id_of[bytes([b])] for b in range(256)]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.splitter = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        size = 1 + max([*self.id_of.values(), *self.special.values()])
        self.bytes_of = [b""] * size
        for token, i in self.id_of.items():
            self.bytes_of[i] = token
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.special_ids = frozenset(self.special.values())
        self.words = _Words(self)

    def merged(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        rank, size = self.rank.get, self.size
        bounds, parts = list(range(len(word) + 1)), [self.byte_ids[b] for b in word]  # the parts between the boundaries, by id
        ranks = [rank(a * size + b, NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == NO_RANK:
                break
            at = ranks.index(low)
            parts[at] = self.joined[low]
            del bounds[at + 1], parts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank(parts[at] * size + parts[at + 1], NO_RANK)
            if at:
                ranks[at - 1] = rank(parts[at - 1] * size + parts[at], NO_RANK)
        return [self.id_of[word[a:b]] for a, b in zip(bounds, bounds[1:])]

    def digits(self, text: str) -> str:
        """Decimal ids of a text with commas between; a special token's string is that token."""
        out, at = [], 0
        for found in self.splitter.finditer(text) if self.splitter else ():
            out += map(self.words.__getitem__, PATTERN.findall(text[at : found.start()]))
            out.append(str(self.special[found[0]]))
            at = found.end()
        out += map(self.words.__getitem__, PATTERN.findall(text[at:] if at else text))
        return ",".join(out)

    def encode(self, text: str) -> np.ndarray:
        return ids_of(self.digits(text))

    def decode(self, ids) -> str:
        """Text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def ids_of(digits: str) -> np.ndarray:
    return np.fromstring(digits, np.int32, sep=",") if digits else np.zeros(0, np.int32)


class _Words(dict):
    """Words seen by this task, merged when first asked for."""

    def __init__(self, codec: Codec):
        self.codec = codec

    def __missing__(self, word: str) -> str:
        raw = word.encode()
        digits = ",".join(map(str, self.codec.merged(raw) if len(raw) <= 4 * CACHED_BYTES else merged_long(self.codec, raw)))
        if len(raw) <= CACHED_BYTES:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = digits
        return digits


def merged_long(codec: Codec, word: bytes) -> list[int]:
    """merged() for words of any length: neighbours are linked and a heap holds the ranks, so the time is not quadratic."""
    import heapq

    n, parts = len(word), [codec.byte_ids[b] for b in word]
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    rank = lambda i: codec.rank.get(parts[i] * codec.size + parts[right[i]], NO_RANK) if right[i] < n else NO_RANK
    heap = [(r, i) for i in range(n - 1) if (r := rank(i)) != NO_RANK]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        if not alive[i] or rank(i) != r:
            continue
        gone = right[i]
        alive[gone], parts[i], right[i] = False, codec.joined[r], right[gone]
        if right[i] < n:
            left[right[i]] = i
        for j in (i, left[i]):
            if j >= 0 and (r := rank(j)) != NO_RANK:
                heapq.heappush(heap, (r, j))
    return [parts[i] for i in range(n) if alive[i]]


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, loaded once a worker process."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def digests(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """For each row of docs its doc_id, the number of tokens of its whole text, and digests of ids and decoded text.

    ``vocabulary`` is a file of the public tokenizers, read on the executors. A
    null text is an empty one: no tokens, and digests of nothing. Repeated rows
    and null doc_ids give a row each; an empty table gives none; other columns
    are ignored. The decoded text is that of the ids, not a copy of the input.
    """

    return _mapped(docs, vocabulary, SCHEMA)


def _mapped(docs: DataFrame, vocabulary: str, schema: str) -> DataFrame:
    """Rows of doc_id, n_tokens, the digests, and the ids if the schema has them, ROWS at a time; the words that a task has cached go with it."""
    names = [c.split()[0] for c in schema.split(", ")]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(public_tokenizers.path(vocabulary))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids, shas, texts = [], [], []
                for text in part.column(1).to_pylist():
                    digits = c.digits(text or "")
                    ids.append(ids_of(digits))
                    shas.append(hashlib.sha256(digits.encode()).hexdigest())
                    texts.append(hashlib.sha256(c.decode(ids[-1].tolist()).encode()).hexdigest())
                size = np.array([len(x) for x in ids], np.int64)
                columns = [part.column(0).cast(pa.int64()), pa.array(size), pa.array(shas), pa.array(texts)]
                if "ids" in names:
                    columns.append(pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(size)]).astype(np.int32), np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays(columns, names)
        c.words.clear()

    return docs.select("doc_id", "text").mapInArrow(kernel, schema)


def encoded(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """digests() and the token ids of each row's whole text; a very long text is encoded whole, and nulls, empty texts, repeated rows and empty tables are as there."""
    return _mapped(docs, vocabulary, f"{SCHEMA}, ids array<int>")


def decoded(tokens: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id and text of each row of (doc_id, ids); null ids give an empty text."""

    def kernel(batches):
        c = codec(public_tokenizers.path(vocabulary))
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": [c.decode(i if i is not None else ()) for i in batch["ids"]]})

    return tokens.select("doc_id", "ids").mapInPandas(kernel, "doc_id long, text string")


def query(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
