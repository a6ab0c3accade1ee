"""Byte-level BPE by dynamic programming over byte prefixes.

The encoding of a prefix is that of a shorter prefix and one last token, so it
is enough to keep that token for each prefix. Of the tokens that end there,
exactly one may follow the last token of the prefix before it: tokens make up
an encoding if, for each two neighbours, no merge across their border comes
before the merges within them. Nothing after a prefix changes what is kept for
it, so text is appended exactly, and after an edit only the prefixes from the
edit to where the kept tokens agree again are worked out anew.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import chain

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import PATTERN

#: A cached word's bytes at most; words cached at most, twice; prefixes of words and pairs of tokens cached at most before the cache starts anew.
CACHED_BYTES, CACHED_WORDS, CACHED_PREFIXES, CACHED_PAIRS = 64, 250_000, 800_000, 400_000

#: Rows in a batch that a task returns.
ROWS = 512

NO_RANK = 1 << 30
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Ranks:
    """The tokens of one file of ranks, and which of them may be neighbours."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, f)))}
        self.size = 1 + max(self.rank.values())
        self.bytes_of, self.digits_of = [b""] * self.size, list(map(str, range(self.size)))
        self.endings = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in self.rank.items():
            self.bytes_of[rank] = token
            self.endings.add_word(token.decode("latin-1"), rank)
        self.endings.make_automaton()
        self.longest, self.length_of = max(map(len, self.rank)), list(map(len, self.bytes_of))
        self.growth: dict[int, tuple | None] = {}
        self.pairs: dict[int, bool] = {}
        self.prefixes: dict[bytes, int] = {b"": -1}
        self.words = _Words(self)

    def grown(self, token: int) -> tuple | None:
        """How merges make the token of its bytes, in their order: (rank, leftmost part after it, rightmost part after it); None if they make something else of them."""
        if token not in self.growth:
            raw = self.bytes_of[token]
            parts, steps = [raw[i : i + 1] for i in range(len(raw))], [(-1, self.rank[raw[:1]], self.rank[raw[-1:]])]
            while len(parts) > 1:
                low, at = min((self.rank.get(a + b, NO_RANK), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if low == NO_RANK:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                steps.append((low, self.rank[parts[0]], self.rank[parts[-1]]))
            self.growth[token] = tuple(steps) if len(parts) == 1 else None
        return self.growth[token]

    def neighbours(self, left: int, right: int) -> bool:
        """Whether merges keep the two tokens apart: of merges of one rank the leftmost comes first. With nothing, -1, to its left: whether they make the token."""
        known = self.pairs.get(left * self.size + right)
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[left * self.size + right] = self._kept_apart(left, right) if left >= 0 else self.grown(right) is not None
        return known

    def _kept_apart(self, left: int, right: int) -> bool:
        a, b = self.grown(left), self.grown(right)
        if a is None or b is None:
            return False
        i = j = 0
        while True:
            across = self.rank.get(self.bytes_of[a[i][2]] + self.bytes_of[b[j][1]], NO_RANK)
            in_a, in_b = a[i + 1][0] if i + 1 < len(a) else NO_RANK, b[j + 1][0] if j + 1 < len(b) else NO_RANK
            if across < in_a and across <= in_b:
                return False
            if in_a == in_b == NO_RANK:
                return True
            if in_a <= in_b:
                i += 1
            else:
                j += 1

    def short(self, raw: bytes) -> list[int]:
        """Ids of a short word; the last tokens of its prefixes are kept for all words that begin alike."""
        prefixes, rank, pairs = self.prefixes, self.rank, self.pairs
        if len(prefixes) >= CACHED_PREFIXES:
            prefixes.clear()
            prefixes[b""] = -1
        known = len(raw)
        while raw[:known] not in prefixes:
            known -= 1
        for end in range(known + 1, len(raw) + 1):
            for begin in range(end - 1, max(0, end - self.longest) - 1, -1):
                token = rank.get(raw[begin:end])
                if token is not None:
                    left = prefixes[raw[:begin]]
                    apart = pairs.get(left * self.size + token)
                    if apart or apart is None and self.neighbours(left, token):
                        prefixes[raw[:end]] = token
                        break
        out = []
        while raw:
            out.append(prefixes[raw])
            raw = raw[: -self.length_of[out[-1]]]
        return out[::-1]

    def encode(self, text: str) -> list[int]:
        """Ids of a text, each match of the public pattern encoded separately."""
        return list(chain.from_iterable(map(self.words.__getitem__, PATTERN.findall(text))))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class Prefixes:
    """A pre-token and the last token of each of its prefixes."""

    def __init__(self, ranks: Ranks, raw: bytes = b""):
        self.ranks, self.raw, self.last = ranks, b"", [-1]
        self.append(raw)

    def append(self, raw: bytes) -> None:
        """Bytes at the end; what is kept so far stays as it is."""
        at = len(self.raw)
        self.raw += raw
        self._go_on(at)

    def replace(self, start: int, stop: int, raw: bytes) -> int:
        """Other bytes in place of raw[start:stop]. Returns how many prefixes were worked out anew."""
        tail, after = self.last[stop + 1 :], len(self.raw) - stop
        self.raw = self.raw[:start] + raw + self.raw[stop:]
        del self.last[start + 1 :]
        return self._go_on(start, tail, len(self.raw) - after)

    def _go_on(self, at: int, tail: list[int] = (), tail_at: int = 0) -> int:
        """Prefixes longer than ``at``; where as many in a row as a token is long equal those of ``tail``, kept for the prefixes after ``tail_at``, so do all after them."""
        ranks, last = self.ranks, self.last
        begin = max(0, at - ranks.longest)
        length_of, pairs, size, same, done = ranks.length_of, ranks.pairs, ranks.size, 0, at
        for end, token in ranks.endings.iter(self.raw[begin:].decode("latin-1")):
            end += begin + 1
            if end > done:
                left = last[end - length_of[token]]
                apart = pairs.get(left * size + token)
                if apart is None:
                    apart = ranks.neighbours(left, token)
                if apart:
                    last.append(token)
                    done = end
                    if tail and end > tail_at:
                        same = same + 1 if tail[end - tail_at - 1] == token else 0
                        if same >= ranks.longest:
                            last.extend(tail[end - tail_at :])
                            break
        return done - at

    def ids(self) -> list[int]:
        if self.raw in self.ranks.rank:
            return [self.ranks.rank[self.raw]]
        out, at = [], len(self.raw)
        while at:
            out.append(self.last[at])
            at -= len(self.ranks.bytes_of[out[-1]])
        return out[::-1]


class _Words(dict):
    """Ids of the words that this worker has seen: once there are CACHED_WORDS, those asked for again before as many more have come stay."""

    def __init__(self, ranks: Ranks):
        self.ranks, self.before = ranks, {}

    def __missing__(self, word: str) -> Sequence[int]:
        ids = self.before.get(word)
        if ids is None:
            raw = word.encode()
            whole = self.ranks.rank.get(raw)
            if len(raw) > CACHED_BYTES:
                return Prefixes(self.ranks, raw).ids() if whole is None else [whole]
            ids = tuple(self.ranks.short(raw)) if whole is None else (whole,)
        if len(self) >= CACHED_WORDS:
            self.before = dict(self)
            self.clear()
        self[word] = ids
        return ids


class Edited:
    """A text that changes, with the prefixes of each of its pre-tokens.

    Where a pre-token ends depends on the characters just after it alone, and
    where it begins on nothing but the end of the one before. So an edit is
    split anew from two pre-tokens before it, until a border is met that was
    one before; pre-tokens of an old start or end keep what is known of their
    prefixes.
    """

    def __init__(self, ranks: Ranks, text: str = ""):
        self.ranks, self.text = ranks, text
        words = PATTERN.findall(text)
        self.starts = np.cumsum([0, *map(len, words)])[:-1].tolist() if words else []
        self.words = [Prefixes(ranks, w.encode()) for w in words]
        self.worked = len(text.encode())

    def append(self, text: str) -> None:
        self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, stop: int, text: str) -> None:
        """Other characters in place of text[start:stop]; ``worked`` is then the number of prefixes that were worked out for it."""
        size, shift = len(self.text), len(text) - (stop - start)
        self.text = self.text[:start] + text + self.text[stop:]
        first = max(0, bisect_right(self.starts, max(0, start - 1)) - 3)
        at = self.starts[first] if self.starts else 0
        place = {s + shift: i for i, s in enumerate(self.starts) if s >= stop}
        place[size + shift] = len(self.starts)
        starts, words, upto = [], [], None
        self.worked, kept = 0, first
        for found in PATTERN.finditer(self.text, at):
            begin, end = found.span()
            if begin > start + len(text) and begin in place:
                upto = place[begin]
                break
            starts.append(begin)
            raw = found[0].encode()
            while kept + 1 < len(self.starts) and self.starts[kept] < begin and begin <= start:
                kept += 1
            if kept < len(self.words) and self.starts[kept] == begin and begin <= start:
                word = self.words[kept]
                self.worked += _changed(word, raw)
            else:
                word = Prefixes(self.ranks, raw)
                self.worked += len(raw)
            words.append(word)
        upto = len(self.starts) if upto is None else upto
        self.words[first:upto] = words
        self.starts = self.starts[:first] + starts + [s + shift for s in self.starts[upto:]]

    def ids(self) -> list[int]:
        return list(chain.from_iterable(w.ids() for w in self.words))


def _changed(word: Prefixes, raw: bytes) -> int:
    """Turns a word into another one that shares a beginning or an end with it; returns how many prefixes were worked out anew."""
    was, most = word.raw, min(len(word.raw), len(raw))
    head = next((i for i in range(most) if was[i] != raw[i]), most)
    if head == len(was) == len(raw):
        return 0
    end = next((i for i in range(most - head) if was[-1 - i] != raw[-1 - i]), most - head)
    return word.replace(head, len(was) - end, raw[head : len(raw) - end])


_ranks: dict[str, Ranks] = {}


def ranks(path: str) -> Ranks:
    """The tokens of a file, loaded once a worker process."""
    if path not in _ranks:
        _ranks[path] = Ranks(path)
    return _ranks[path]


def _row(r: Ranks, ids: list[int]) -> tuple[str, str]:
    return hashlib.sha256(" ".join(map(r.digits_of.__getitem__, ids)).encode()).hexdigest(), hashlib.sha256(r.decode(ids)).hexdigest()


def _mapped(rows: DataFrame, vocabulary: str, schema: str, encode) -> DataFrame:
    """A row for each of rows: doc_id, n_tokens, the digests, then what else the schema has of ids and worked; encode gives ids and worked of a row's other columns."""
    names = [c.split()[0] for c in schema.split(", ")]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = ranks(public_tokenizers.path(vocabulary))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                got = [encode(r, *row) for row in zip(*[c.to_pylist() for c in part.columns[1:]])]
                shas = [_row(r, ids) for ids, _ in got]
                size = np.array([len(ids) for ids, _ in got], np.int64)
                made = {"doc_id": part.column(0).cast(pa.int64()), "n_tokens": pa.array(size), "ids_sha256": pa.array([s for s, _ in shas]), "decoded_sha256": pa.array([s for _, s in shas])}
                if "ids" in names:
                    made["ids"] = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(size)]).astype(np.int32), np.fromiter(chain.from_iterable(ids for ids, _ in got), np.int32, int(size.sum())))
                if "worked" in names:
                    made["worked"] = pa.array([w for _, w in got], pa.int64())
                yield pa.RecordBatch.from_arrays([made[n] for n in names], names)

    return rows.mapInArrow(kernel, schema)


def digests(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """For each row of docs its doc_id, the number of tokens of its whole text, and digests of the ids and of the bytes decoded from them.

    ``vocabulary`` is a file of ranks of the public tokenizers, read on the
    executors. A null text is an empty one: no tokens, and digests of nothing.
    A very long text or word takes time in proportion to its length. Repeated
    rows and null doc_ids give a row each; an empty table gives none; other
    columns are ignored. The decoded bytes are those of the ids, not a copy of
    the input.
    """
    return _mapped(docs.select("doc_id", "text"), vocabulary, SCHEMA, lambda r, text: (r.encode(text or ""), 0))


def encoded(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """digests() and the token ids of each row's whole text; odd cases are as there."""
    return _mapped(docs.select("doc_id", "text"), vocabulary, f"{SCHEMA}, ids array<int>", lambda r, text: (r.encode(text or ""), 0))


def edited(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """encoded() of texts after their edits, and ``worked``, the prefixes that the edits had worked out anew.

    docs has doc_id, text and edits, an array of (start, stop, text): in their
    order, characters from start to stop (at most the length then; null:
    length) are replaced by the text (null: empty). A null text is an empty
    one, null edits are none, null entries are passed over; places beyond the
    end are the end, below 0 are 0, and a stop before its start is the start.
    """

    def encode(r: Ranks, text: str | None, edits: list | None):
        state, worked = Edited(r, text or ""), 0
        for e in edits or ():
            if e is None:
                continue
            size = len(state.text)
            start = size if e["start"] is None else min(max(e["start"], 0), size)
            stop = size if e["stop"] is None else min(max(e["stop"], start), size)
            state.replace(start, stop, e["text"] or "")
            worked += state.worked
        return state.ids(), worked

    return _mapped(docs.select("doc_id", "text", "edits"), vocabulary, f"{SCHEMA}, ids array<int>, worked long", encode)


def decoded(tokens: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """doc_id and the bytes (binary) of each row of (doc_id, ids); null ids give none."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = ranks(public_tokenizers.path(vocabulary))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([r.decode(ids or ()) for ids in batch.column(1).to_pylist()], pa.binary())], ["doc_id", "raw"])

    return tokens.select("doc_id", "ids").mapInArrow(kernel, "doc_id long, raw binary")


def query(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
