"""Quality rules as a short-circuit cascade.

Each rule's cost and share of rejected documents are measured by the executors
on a sample chosen by hash; the rules then run in order of rejection per cost,
each only on the documents that all before it have kept. The verdict is the
same in any order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

#: Documents on which costs and rejections are estimated, about, and bytes of their texts that one task looks at.
SAMPLE_ROWS, SAMPLE_BYTES = 2_000, 8 << 20

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BULLET = np.zeros(256, bool)
_BULLET[list(b"-*")] = True


class Base(NamedTuple):
    """Statistics that every document has."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_lines: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray


def _by_doc(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[at[1:]] - sums[at[:-1]]


def _doc_of(bounds: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def _lines(block: W.Block, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and end of each line with a word."""
    breaks = np.flatnonzero(block.data == 10)
    starts = np.unique(np.concatenate([at[:-1][np.diff(at) > 0], breaks + 1]))
    starts = starts[starts < len(block.data)]
    ends = np.concatenate([starts[1:], [len(block.data)]]) if len(starts) else starts
    ends = ends - ((ends > starts) & (block.data[np.maximum(ends - 1, 0)] == 10)) if len(starts) else ends
    doc = np.searchsorted(at, starts, "right") - 1
    ends = np.minimum(ends, at[doc + 1]) if len(starts) else ends
    worded = np.searchsorted(block.starts, ends) > np.searchsorted(block.starts, starts)
    return doc[worded], starts[worded], ends[worded]


def base_statistics(block: W.Block, at: np.ndarray) -> Base:
    n = len(at) - 1
    n_words = np.diff(block.bounds)
    inside = W._IS_WORD[block.data]
    word_chars = _by_doc(inside & ((block.data & 0xC0) != 0x80), at)
    doc, starts, ends = _lines(block, at)
    lines = np.bincount(doc, minlength=n)
    keys = W.mixed(W.span_hashes(block.data, starts, ends) ^ W.mixed(doc.astype(np.uint64)))
    first = np.unique(keys, return_index=True)[1]
    dup_lines = lines - np.bincount(doc[first], minlength=n)
    repeat = np.zeros(len(block.hashes) + 1, np.int64)
    places = np.flatnonzero(W.fitting(block.bounds, 3))
    if len(places):
        doc_of = _doc_of(block.bounds)
        keys = W.mixed(W.grams(block.hashes, 3)[places] ^ W.mixed(doc_of[places].astype(np.uint64)))
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        twice = places[counts[inverse] > 1]
        np.add.at(repeat, twice, 1)
        np.add.at(repeat, twice + 3, -1)
    return Base(n_words, word_chars, _by_doc(_SYMBOL[block.data], at), lines, dup_lines, _by_doc(np.cumsum(repeat)[:-1] > 0, block.bounds))


def base_failed(base: Base) -> np.ndarray:
    return (base.n_words < 50) | (100 * base.n_repeat_words > 50 * base.n_words)


# A rule tells which of the documents ``some`` of a block fail.


def symbols(block, at, base, some):
    """More than 15 symbols for 100 words."""
    return 100 * base.n_symbols[some] > 15 * base.n_words[some]


def duplicate_lines(block, at, base, some):
    """More than 30% of the lines equal an earlier one."""
    return 100 * base.n_dup_lines[some] > 30 * base.n_lines[some]


def word_length(block, at, base, some):
    """Words of under 3 or over 15 characters in the mean."""
    return (base.word_chars[some] < 3 * base.n_words[some]) | (base.word_chars[some] > 15 * base.n_words[some])


def letters(block, at, base, some):
    """Under 70% of the words have a letter."""
    out = np.zeros(len(some), bool)
    for i, d in enumerate(some):
        a, b = block.bounds[d], block.bounds[d + 1]
        sums = np.concatenate([[0], np.cumsum(_LETTER[block.data[at[d] : at[d + 1]]])])
        lettered = np.count_nonzero(sums[block.ends[a:b] - at[d]] > sums[block.starts[a:b] - at[d]])
        out[i] = 100 * lettered < 70 * (b - a)
    return out


def _own_lines(block: W.Block, at: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a document, and where its lines start and end."""
    data = block.data[at[d] : at[d + 1]]
    breaks = np.flatnonzero(data == 10)
    return data, np.concatenate([[0], np.stack([breaks, breaks + 1], axis=1).ravel(), [len(data)]]).reshape(-1, 2)


def bullets(block, at, base, some):
    """Over 90% of the lines begin with a bullet."""
    out = np.zeros(len(some), bool)
    for i, d in enumerate(some):
        data, lines = _own_lines(block, at, d)
        starts = lines[:, 0][lines[:, 0] < lines[:, 1]]
        out[i] = 100 * np.count_nonzero(_BULLET[data[starts]]) > 90 * base.n_lines[d]
    return out


def ellipses(block, at, base, some):
    """Over 30% of the lines end with three dots."""
    out = np.zeros(len(some), bool)
    for i, d in enumerate(some):
        data, lines = _own_lines(block, at, d)
        ends = lines[:, 1][lines[:, 1] - lines[:, 0] >= 3]
        dots = (data[ends - 1] == 46) & (data[ends - 2] == 46) & (data[ends - 3] == 46)
        out[i] = 100 * np.count_nonzero(dots) > 30 * base.n_lines[d]
    return out


def common_pair(block, at, base, some):
    """Over 20% of the characters in words are those of the most frequent pair of words, all its places together."""
    out = np.zeros(len(some), bool)
    for i, d in enumerate(some):
        a, b = block.bounds[d], block.bounds[d + 1]
        starts = np.concatenate([[0], np.cumsum((block.data[at[d] : at[d + 1]] & 0xC0) != 0x80)])
        chars = starts[block.ends[a:b] - at[d]] - starts[block.starts[a:b] - at[d]]
        _, inverse = np.unique(W.grams(block.hashes[a:b], 2), return_inverse=True)
        most = np.bincount(inverse, chars[:-1] + chars[1:]).max() if len(inverse) else 0
        out[i] = 100 * most > 20 * base.word_chars[d]
    return out


Rule = Callable[[W.Block, np.ndarray, Base, np.ndarray], np.ndarray]
RULES: dict[str, Rule] = {"symbols": symbols, "duplicate_lines": duplicate_lines, "word_length": word_length, "letters": letters, "bullets": bullets, "ellipses": ellipses, "common_pair": common_pair}


def _blocks(texts: pa.Array):
    for block in W.blocks(texts):
        yield block, block.offsets


def measured(docs: DataFrame, rows: int = SAMPLE_ROWS, rules: dict[str, Rule] = RULES) -> dict[str, tuple[float, float]]:
    """Seconds and share of rejected documents of each rule on about ``rows`` rows chosen by hash, all rules on all of it.

    A task measures its own part of the sample and returns a row for each rule.
    """
    share = min(1.0, rows / max(1, docs.count()))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(1_000_000)) < share * 1_000_000).select("text")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, failed, n, held = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0), 0, 0
        for batch in batches:
            for block, at in _blocks(batch.column(0)):
                held += len(block.data)
                if held > SAMPLE_BYTES and n:
                    continue
                base = base_statistics(block, at)
                some = np.flatnonzero(~base_failed(base))
                n += len(some)
                for name, rule in rules.items():
                    began = time.perf_counter()
                    failed[name] += int(rule(block, at, base, some).sum())
                    cost[name] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays([pa.array(list(rules)), pa.array(list(cost.values())), pa.array(list(failed.values()), pa.int64()), pa.array([n] * len(rules), pa.int64())], ["rule", "cost", "failed", "n"])

    sums = sample.mapInArrow(kernel, "rule string, cost double, failed long, n long").groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("cost", "failed", "n")])
    got = {r["rule"]: (r["cost"] / max(1, r["n"]), r["failed"] / max(1, r["n"])) for r in sums.toLocalIterator()}
    return {name: got.get(name, (0.0, 0.0)) for name in rules}


def cascade_order(figures: dict[str, tuple[float, float]]) -> list[str]:
    """Rules by rejection per cost, the highest first."""
    return sorted(figures, key=lambda name: (-figures[name][1] / max(figures[name][0], 1e-9), figures[name][0], name))


def judged(docs: DataFrame, order: list[str] | None = None, rules: dict[str, Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """A row for each row of docs with its statistics, base_failed and kept.

    kept is false if the base rules fail, or else if any rule of the cascade
    does. A null or empty text has no words and fails the base rules. A very
    long text is worked on whole, alone in its block. Null doc_ids and repeated rows give a row each; an empty table gives none; other
    columns are ignored. ``order`` overrides the sampled order of the rules.
    """
    order = order or cascade_order(measured(docs, sample_rows, rules))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for block, at in _blocks(batch.column(1)):
                n = len(at) - 1
                base = base_statistics(block, at)
                failed = base_failed(base)
                alive = np.flatnonzero(~failed)
                for name in order:
                    if not len(alive):
                        break
                    alive = alive[~rules[name](block, at, base, alive)]
                kept = np.zeros(n, bool)
                kept[alive] = True
                columns = [ids.slice(block.first, n), *[pa.array(x.astype(np.int64)) for x in (base.n_words, base.word_chars, base.n_symbols, base.n_dup_lines, base.n_repeat_words)], pa.array(failed), pa.array(kept)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCHEMA.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(kernel, SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), lines AS (
  SELECT n, unnest(string_split(text, chr(10))) AS line FROM d
), line_stats AS (
  SELECT n, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup, count(*) FILTER (line[1] IN ('-', '*')) AS n_bullet, count(*) FILTER (ends_with(line, '...')) AS n_dots
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY n
), places AS (
  SELECT n, unnest(range(1, len(words) - 1)) AS i, words FROM d WHERE len(words) >= 3
), windows AS (
  SELECT n, i, count(*) OVER (PARTITION BY n, words[i], words[i + 1], words[i + 2]) AS c FROM places
), pairs AS (
  SELECT n, max(chars) AS pair_chars FROM (SELECT n, sum(length(words[i]) + length(words[i + 1])) AS chars FROM (SELECT n, words, unnest(range(1, len(words))) AS i FROM d WHERE len(words) >= 2) GROUP BY n, words[i], words[i + 1]) GROUP BY n
), repeats AS (
  SELECT n, count(DISTINCT j) AS n_repeat FROM (SELECT n, unnest([i, i + 1, i + 2]) AS j FROM windows WHERE c > 1) GROUP BY n
), stats AS (
  SELECT d.n, doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
         coalesce(n_bullet, 0) AS n_bullet, coalesce(n_dots, 0) AS n_dots, coalesce(pair_chars, 0) AS pair_chars, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words, len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS lettered
  FROM d LEFT JOIN line_stats USING (n) LEFT JOIN pairs USING (n) LEFT JOIN repeats USING (n)
), based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stats
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 15 * n_words OR 100 * n_dup_lines > 30 * n_lines OR word_chars < 3 * n_words OR word_chars > 15 * n_words
            OR 100 * lettered < 70 * n_words OR 100 * n_bullet > 90 * n_lines OR 100 * n_dots > 30 * n_lines OR 100 * pair_chars > 20 * word_chars) AS kept
FROM based
"""
