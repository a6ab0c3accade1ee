"""Runs of words that repeat with a period, found by matching aligned blocks.

A run of period q holds, in what lies more than a period before its end, a
block of words that starts at a multiple of its own length, a power of two
that fits the period, and the block occurs again q words later. For each such
length the aligned blocks of a document are the keys of an automaton over word
numbers, the whole document is searched, and occurrences at a distance that
fits the length are extended in both directions. Blocks that cannot recur so
near, by the hashes of six words, are no keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

#: Words that a run has at least; and the words that recur in any run: at least 12 - q or q of them, so never fewer than 6.
LEAST, GRAM = 12, 6

#: Rows in a batch that a task returns.
ROWS = 512

NEVER = 1 << 62
_BASE = 0xA0761D6478BD642F | 3
RUN = "struct<start:long,length:long,period:long>"
SCHEMA = f"doc_id long, runs array<{RUN}>, collapsed string"


def next_places(block: W.Block) -> np.ndarray:
    """For each place of W.grams(hashes, GRAM) how many words later the same words come next in the same document, NEVER if they don't."""
    fits = np.flatnonzero(W.fitting(block.bounds, GRAM))
    out = np.full(len(block.hashes), NEVER)
    if len(fits):
        doc = np.searchsorted(block.bounds, fits, "right").astype(np.uint64)
        keys = W.mixed(W.grams(block.hashes, GRAM)[fits] ^ W.mixed(doc))
        order = np.argsort(keys, kind="stable")
        same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
        out[fits[order[same]]] = fits[order[same + 1]] - fits[order[same]]
    return out


def scales(n: int) -> Iterator[tuple[int, int, int]]:
    """Length of blocks, and the least and greatest period that they are matched for."""
    yield 2, 1, min(7, n // 2)
    size = 4
    while 2 * size <= n // 2:
        yield size, 2 * size, min(4 * size - 1, n // 2)
        size *= 2


class Names:
    """A number for the words from each place on, as many as a power of two: places have one number if their words are the same. Each comes from the two numbers of half as many words."""

    def __init__(self, ids: np.ndarray):
        self.size, self.numbers = 1, ids

    def of(self, size: int) -> np.ndarray:
        """For ``size`` words, no fewer than asked for before."""
        while self.size < size:
            left, right = self.numbers[: -self.size], self.numbers[self.size :]
            self.numbers = np.unique(left * (1 + self.numbers.max()) + right, return_inverse=True)[1]
            self.size *= 2
        return self.numbers


def seeds(names: Names, n: int, near: np.ndarray, size: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of aligned blocks, and the distances from low to high at which they occur again.

    A key is a block as up to four numbers of its parts, so that it has few
    ends that begin other keys; the document is searched once for each place
    that a part can start at, modulo its length, all in one sequence.
    """
    none = np.zeros(0, np.int64)
    good = np.concatenate([[0], np.cumsum(near <= high)])
    at = np.arange(0, n - size + 1, size)
    kept = at[good[np.minimum(at + 1, n)] > good[np.maximum(at + min(0, size - GRAM), 0)]]
    if not len(kept):
        return none, none
    part = max(1, size // 4)
    numbers = names.of(part)
    height, stop = -(-len(numbers) // part) + 1, int(numbers.max()) + 1
    table = np.full((height, part), stop)
    table.ravel()[: len(numbers)] = numbers
    keys, which = np.unique(numbers[kept[:, None] + np.arange(0, size, part)], axis=0, return_inverse=True)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for k, key in enumerate(map(tuple, keys.tolist())):
        automaton.add_word(key, k)
    automaton.make_automaton()
    hits = np.array(list(automaton.iter(tuple(table.T.ravel().tolist()))), np.int64).reshape(-1, 2)
    first = hits[:, 0] - size // part + 1
    place, found_key = first % height * part + first // height, hits[:, 1]
    key_of = np.full(n // size + 1, -1)
    key_of[kept // size] = which.ravel()
    found = [(none, none)]
    for back in range((high - low) // size + 1):
        start = (place - low) // size * size - back * size
        fits = np.flatnonzero((start >= 0) & (place - start <= high))
        fits = fits[key_of[start[fits] // size] == found_key[fits]]
        found.append((start[fits], place[fits] - start[fits]))
    return np.concatenate([p for p, _ in found]), np.concatenate([q for _, q in found])


class Extension:
    """How far words at two places agree: by hashes of prefixes, found for many pairs at once by halving; exact() settles it on the words."""

    def __init__(self, ids: np.ndarray):
        self.ids, n = ids, len(ids)
        self.powers = W.powers(_BASE, n + 1)[0]
        self.sums = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(W.mixed(ids.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=self.sums[1:])

    def _equal(self, at: np.ndarray, size: np.ndarray, q: np.ndarray) -> np.ndarray:
        s = self.sums
        with np.errstate(over="ignore"):
            return (s[at + size] - s[at]) * self.powers[q] == s[at + q + size] - s[at + q]

    def stretches(self, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the longest stretch around p in which words q apart agree."""
        right, left = self._farthest(len(self.ids) - p - q, lambda m: self._equal(p, m, q)), self._farthest(p, lambda m: self._equal(p - m, m, q))
        return p - left, p + q + right

    @staticmethod
    def _farthest(most: np.ndarray, equal) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            good = equal(middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low

    def exact(self, q: int, start: int, end: int) -> list[tuple[int, int]]:
        """The stretch itself if its words q apart agree, which makes it the longest, as hashes differ only if words do; else all stretches of the document in which they do."""
        ids = self.ids
        if (ids[start : end - q] == ids[start + q : end]).all():
            return [(start, end)]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], ids[:-q] == ids[q:], [False]]).astype(np.int8)))
        return list(zip(edges[::2].tolist(), (edges[1::2] + q).tolist()))


def runs(ids: np.ndarray, near: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence of word numbers, by start, then period.

    near: next_places() of its words; it may name places that only hashes take
    for equal. A stretch whose period is a multiple of a smaller one of its
    own is that of the smaller one's run. Time is n log n but for what the
    runs' own lengths add up to.
    """
    n = len(ids)
    found: dict[tuple[int, int], int] = {}
    names, extension = Names(ids), Extension(ids)
    cover = np.full(n + 1, -1)  # of the runs around a word, the last one found
    known = np.zeros((0, 3), np.int64)
    for size, low, high in scales(n):
        p, q = seeds(names, n, near, size, low, high)
        if len(known) and len(p):
            around = cover[p]
            start, end, period = known[around].T
            fresh = (around < 0) | (p < start) | (p + q + size > end) | (q % np.maximum(period, 1) > 0)
            p, q = p[fresh], q[fresh]
        if not len(p):
            continue
        start, end = extension.stretches(p, q)
        long = np.flatnonzero(end - start >= np.maximum(least, 2 * q))
        new = []
        for first, last, period in np.unique(np.stack([start, end, q], 1)[long], axis=0).tolist():
            for s, e in extension.exact(period, first, last):
                if e - s >= max(least, 2 * period) and found.get((s, e), n) > period:
                    found[s, e] = period
                    new.append((s, e, period))
        for k, (s, e, _) in enumerate(new):
            cover[s:e] = len(known) + k
        known = np.concatenate([known, np.array(new, np.int64).reshape(-1, 3)])
    out = np.array(sorted((s, e - s, period) for (s, e), period in found.items()), np.int64).reshape(-1, 3)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def kept_words(n: int, found: np.ndarray) -> np.ndarray:
    """Whether each of n words is in no run after that run's first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (array of start, length, period, by start, then period) and the collapsed text of each row of docs.

    Words are those of words.WORD_PATTERN, numbered from 0; a run is a stretch
    of at least 12 words and two of its smallest period, as long as it gets.
    The collapsed text has the words, one space between them, without those
    that any run holds after its first period. A null or empty text has no
    runs and collapses to an empty text; a very long one is worked on whole,
    alone in its block. Repeated rows and null doc_ids give a row each; an
    empty table gives none; other columns are ignored.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows, texts = [], []
                for block in W.blocks(part.column(1)):
                    near = next_places(block)
                    for d, (first, last) in enumerate(zip(block.bounds, block.bounds[1:])):
                        spelled = block.data[block.offsets[d] : block.offsets[d + 1]].tobytes().split()
                        some = np.zeros((0, 3), np.int64)
                        if (near[first:last] < NEVER).any():
                            number: dict[bytes, int] = {}
                            ids = np.fromiter((number.setdefault(w, len(number)) for w in spelled), np.int64, len(spelled))
                            some = runs(ids, near[first:last])
                            if len(some):
                                spelled = [w for w, keep in zip(spelled, kept_words(len(ids), some).tolist()) if keep]
                        rows.append([dict(zip(("start", "length", "period"), r)) for r in some.tolist()])
                        texts.append(b" ".join(spelled).decode())
                kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(rows, kind), pa.array(texts, pa.string())], ["doc_id", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(kernel, SCHEMA)


def repeating(docs: DataFrame) -> DataFrame:
    """doc_id and text of docs; about a tenth of the documents, chosen by doc_id, repeat some of their words from some place on.

    With h the CRC-32 of the decimal doc_id, g = h // 10 and n words: if h % 10
    is 0, each word i from a = g % n on is word a + (i - a) % p, with p = 1 +
    (n - a) // (3 + g % 8). Other texts, and those with a null doc_id, stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(f"({W.WORD_PATTERN})"), F.lit(1))
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words")).withColumn("n", F.size("words").cast("long"))
    chosen = chosen.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    again = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return chosen.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Of periodic_runs(): the number of runs, the longest (of equally long ones that of the smallest start, then period), and digests of all runs and the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("").alias("listed"), "collapsed")
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return rows.select(
        "doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return digests(periodic_runs(repeating(spark.read.parquet(f"{sf_dir}/documents.parquet"))))


#: The CRC-32 is worked out bit by bit: -1 stands for a shift. Word sequences of six that come again give the stretches.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), hashed AS (
  SELECT *, len(words) AS n, CASE WHEN doc_id IS NOT NULL THEN xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) END AS h FROM d
), placed AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM hashed
), repeated AS (
  SELECT k, doc_id, n, CASE WHEN a IS NULL THEN words ELSE list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) END AS words FROM placed
), grams AS (
  SELECT k, i, array_to_string(words[i + 1 : i + 6], ' ') AS gram FROM (SELECT k, words, unnest(range(n - 5)) AS i FROM repeated WHERE n > 5)
), pairs AS (
  SELECT x.k, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.k = y.k AND x.gram = y.gram AND x.i < y.i
), stretches AS (
  SELECT k, q, min(i) AS start, count(*) + 5 + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM pairs) GROUP BY k, q, island
), runs AS (
  SELECT k, start, length, min(q) AS period FROM stretches WHERE length >= greatest(12, 2 * q) GROUP BY k, start, length
), best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY k ORDER BY length DESC, start, period) = 1
), listed AS (
  SELECT k, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM runs GROUP BY k
), dropped AS (
  SELECT k, list(i) AS gone FROM (SELECT DISTINCT k, unnest(range(start + period, start + length)) AS i FROM runs) GROUP BY k
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length, best.period::BIGINT AS period, (1000 * best.length // best.period)::BIGINT AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256,
       sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN words ELSE list_transform(list_filter(range(n), lambda i: NOT list_contains(gone, i)), lambda i: words[i + 1]) END, ' '), '')) AS collapsed_sha256
FROM repeated LEFT JOIN best USING (k) LEFT JOIN listed USING (k) LEFT JOIN dropped USING (k)
"""
