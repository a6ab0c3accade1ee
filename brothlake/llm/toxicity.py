"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input is the embedding of its lower-cased letters joined to the sum
of the embeddings of its byte n-grams, so unseen forms of known words are
recognised. The network reads windows of WINDOW words that overlap by half,
all of them, and a document's score is that of its most toxic window. It is
trained in numpy on a bounded sample of labelled documents: a document's label
is taken for its highest window only (and, where it is 0, for a random one).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

WINDOW, STRIDE = 32, 16
#: Labelled documents of class 0 and of class 1 to train on at most, and the characters of the longest among them.
TRAIN_DOCS, TRAIN_CHARS = (3_000, 1_500), 12_000
THRESHOLD = 0.7

BUCKETS, DIM, HIDDEN, ATTEND = 1 << 15, 8, 8, 8
GRAMS = (3, 5)
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Words(NamedTuple):
    """Distinct words of a block by their inputs; grams of word i are ``codes[at[i]:at[i+1]]``."""

    ids: np.ndarray
    codes: np.ndarray
    at: np.ndarray
    index: np.ndarray  # distinct word of each word of the block


def word_inputs(block: W.Block) -> Words:
    _, first, index = np.unique(block.hashes, return_index=True, return_inverse=True)
    starts, size = block.starts[first], (block.ends - block.starts)[first]
    begin = np.concatenate([[0], np.cumsum(size)])
    data = W._LOWER[block.data[np.arange(begin[-1]) - np.repeat(begin[:-1] - starts, size)]]
    lettered = _LETTERS[data]
    upto = np.concatenate([[0], np.cumsum(lettered)])
    lo, hi = upto[begin[:-1]], upto[begin[1:]]
    data = data[lettered]
    ids = (W.span_hashes(data, lo, hi) % np.uint64(BUCKETS)).astype(np.int64)
    of = np.repeat(np.arange(len(lo)), hi - lo)
    codes, owners = [], []
    for n in GRAMS:
        if len(data) < n:
            continue
        place = np.arange(len(data) - n + 1)
        place = place[place + n <= hi[of[place]]]
        h = W.span_hashes(data, place, place + n) + np.uint64(n) * (place == lo[of[place]]).astype(np.uint64)
        codes.append((W.mixed(h) % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(of[place])
    codes, owners = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (codes, owners))
    order = np.argsort(owners, kind="stable")
    return Words(ids, codes[order], np.searchsorted(owners[order], np.arange(len(lo) + 1)), index.reshape(-1))


def window_rows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word and length of every window; the last of a document ends with it, a document without words has none."""
    n = np.diff(bounds)
    count = np.where(n == 0, 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)))
    doc = np.repeat(np.arange(len(n)), count)
    turn = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = turn * STRIDE
    return doc, bounds[doc] + start, np.minimum(WINDOW, n[doc] - start)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def summed_grams(table: np.ndarray, words: Words) -> np.ndarray:
    sums = np.zeros((len(words.codes) + 1, DIM), np.float32)
    np.cumsum(table[words.codes], axis=0, out=sums[1:], dtype=np.float32)
    scale = 1 / np.sqrt(np.maximum(1, np.diff(words.at))).astype(np.float32)
    return (sums[words.at[1:]] - sums[words.at[:-1]]) * scale[:, None]


class Network:
    """Parameters by name; directions 0 and 1 read forwards and backwards."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        init = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"word": init(BUCKETS, DIM) * 8, "gram": init(BUCKETS, DIM) * 8, "attend": init(2 * HIDDEN, ATTEND), "attend_b": np.zeros(ATTEND, np.float32), "query": init(ATTEND), "out": init(2 * HIDDEN), "out_b": np.full(1, -1.0, np.float32)}
        for d in (0, 1):
            self.p |= {f"in{d}": init(2 * DIM, 3 * HIDDEN), f"b{d}": np.zeros(3 * HIDDEN, np.float32), f"u{d}": init(HIDDEN, 3 * HIDDEN)}

    def inputs(self, words: Words) -> np.ndarray:
        return np.concatenate([self.p["word"][words.ids], summed_grams(self.p["gram"], words)], axis=1)

    def run(self, projected: list[np.ndarray], index: np.ndarray, first: np.ndarray, size: np.ndarray, keep: bool = False):
        """Logit of each window; with ``keep`` also what backward() needs."""
        n, p = len(first), self.p
        states = np.zeros((WINDOW, n, 2 * HIDDEN), np.float32)
        at = np.minimum(first[None] + np.arange(WINDOW)[:, None], len(index) - 1)
        token = index[at]
        mask = (np.arange(WINDOW)[:, None] < size[None]).astype(np.float32)
        kept: list[list[tuple]] = [[], []]
        for d in (0, 1):
            h, u = np.zeros((n, HIDDEN), np.float32), p[f"u{d}"]
            for t in range(WINDOW) if d == 0 else reversed(range(WINDOW)):
                x, back = projected[d][token[t]], h @ u
                gates = sigmoid(x[:, : 2 * HIDDEN] + back[:, : 2 * HIDDEN])
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                new = np.tanh(x[:, 2 * HIDDEN :] + r * back[:, 2 * HIDDEN :])
                m = mask[t][:, None]
                after = h + m * (1 - z) * (new - h)
                if keep:
                    kept[d].append((t, h, z, r, new, back[:, 2 * HIDDEN :], m))
                h = after
                states[t, :, d * HIDDEN : (d + 1) * HIDDEN] = h
        focus = np.tanh(states @ p["attend"] + p["attend_b"])
        weight = np.where(mask > 0, focus @ p["query"], np.float32(-1e9))
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = (weight[:, :, None] * states).sum(0)
        logit = pooled @ p["out"] + p["out_b"][0]
        return (logit, (states, focus, weight, pooled, kept, token, mask)) if keep else logit

    def logits(self, block: W.Block, words: Words | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Document, first word, length and logit of every window of a block."""
        doc, first, size = window_rows(block.bounds)
        if not len(doc):
            return doc, first, size, np.zeros(0, np.float32)
        words = words or word_inputs(block)
        x = self.inputs(words)
        projected = [x @ self.p[f"in{d}"] + self.p[f"b{d}"] for d in (0, 1)]
        parts = [self.run(projected, words.index, first[i : i + 4096], size[i : i + 4096]) for i in range(0, len(doc), 4096)]
        return doc, first, size, np.concatenate(parts)

    def scores(self, block: W.Block, words: Words | None = None) -> np.ndarray:
        """Score of each document: its highest window's; without words that of an empty window."""
        doc, _, _, logit = self.logits(block, words)
        best = np.full(len(block.bounds) - 1, -np.inf)
        np.maximum.at(best, doc, logit)
        return sigmoid(np.where(np.isinf(best), float(self.p["out_b"][0]), best).astype(np.float64))

    def gradients(self, words: Words, first: np.ndarray, size: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log-loss of windows."""
        p = self.p
        x = self.inputs(words)
        projected = [x @ p[f"in{d}"] + p[f"b{d}"] for d in (0, 1)]
        logit, (states, focus, weight, pooled, kept, token, mask) = self.run(projected, words.index, first, size, keep=True)
        g: dict[str, np.ndarray] = {}
        d_logit = ((sigmoid(logit) - label) / len(label)).astype(np.float32)
        g["out"], g["out_b"] = pooled.T @ d_logit, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * p["out"]
        d_weight = (states * d_pooled).sum(2)
        d_states = weight[:, :, None] * d_pooled
        d_raw = weight * (d_weight - (weight * d_weight).sum(0))
        g["query"] = np.einsum("tna,tn->a", focus, d_raw)
        d_focus = d_raw[:, :, None] * p["query"] * (1 - focus**2)
        g["attend"], g["attend_b"] = np.einsum("tnh,tna->ha", states, d_focus), d_focus.sum((0, 1))
        d_states = d_states + d_focus @ p["attend"].T
        d_x = np.zeros_like(x)
        for d in (0, 1):
            u = p[f"u{d}"]
            d_u, d_projected, d_h = np.zeros_like(u), np.zeros_like(projected[d]), np.zeros((len(first), HIDDEN), np.float32)
            for t, h, z, r, new, back, m in reversed(kept[d]):
                d_all = d_h + d_states[t, :, d * HIDDEN : (d + 1) * HIDDEN]
                d_now = m * d_all
                d_new = d_now * (1 - z) * (1 - new**2)
                d_gate = np.concatenate([d_now * (h - new) * z * (1 - z), d_new * back * r * (1 - r), d_new], axis=1)
                d_back = np.concatenate([d_gate[:, : 2 * HIDDEN], d_new * r], axis=1)
                d_u += h.T @ d_back
                np.add.at(d_projected, token[t], d_gate)
                d_h = d_all - d_now + d_now * z + d_back @ u.T
            g[f"u{d}"], g[f"in{d}"], g[f"b{d}"] = d_u, x.T @ d_projected, d_projected.sum(0)
            d_x += d_projected @ p[f"in{d}"].T
        g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
        np.add.at(g["word"], words.ids, d_x[:, :DIM])
        n = np.diff(words.at)
        np.add.at(g["gram"], words.codes, np.repeat(d_x[:, DIM:] / np.sqrt(np.maximum(1, n))[:, None], n, axis=0))
        return g


def log_odds(blocks: list[tuple[W.Block, Words]], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Shrunken log-odds of label 1 for each bucket of words and grams, by documents that have it."""
    seen = {k: np.zeros((2, BUCKETS)) for k in ("word", "gram")}
    totals = np.zeros(2)
    for (block, words), label in zip(blocks, labels):
        doc = np.repeat(np.arange(len(label)), np.diff(block.bounds))
        n = np.diff(words.at)[words.index]
        grams = words.codes[np.repeat(words.at[words.index] - (np.cumsum(n, dtype=np.int64) - n), n) + np.arange(n.sum())]
        for k, (d, code) in {"word": (doc, words.ids[words.index]), "gram": (np.repeat(doc, n), grams)}.items():
            pairs = np.unique(d * BUCKETS + code)
            np.add.at(seen[k], (label[pairs // BUCKETS], pairs % BUCKETS), 1)
        totals += np.bincount(label, minlength=2)
    return {k: np.log((s[1] + 0.5) / (totals[1] + 1)) - np.log((s[0] + 0.5) / (totals[0] + 1)) for k, s in seen.items()} | {f"{k}_seen": s.sum(0) for k, s in seen.items()}


def trained(texts: pa.Array, labels: np.ndarray, epochs: int = 8, batch: int = 128, rate: float = 0.01, seed: int = 5, seeded: bool = True) -> Network:
    """A network for labelled texts, by Adam over each document's highest window, found anew in each epoch.

    With ``seeded`` the first coordinate of each embedding starts at the
    shrunken log-odds of its words or n-grams, which also choose the windows of
    the first epoch; all of it is trained further. Without, embeddings start at
    random.
    """
    net, rng = Network(), np.random.default_rng(seed)
    blocks = [(b._replace(data=None, starts=None, ends=None, hashes=None, offsets=None), Words(*[x.astype(np.int32) for x in word_inputs(b)])) for b in W.blocks(texts, block_bytes=1 << 18)]  # what training needs, in little room
    labelled = [labels[b.first : b.first + len(b.bounds) - 1].astype(np.int64) for b, _ in blocks]
    if not sum(map(len, labelled)):
        return net
    odds = log_odds(blocks, labelled) if seeded else None
    evidence = {}
    for k in ("word", "gram") if seeded else ():
        evidence[k] = np.clip(odds[k] * odds[f"{k}_seen"] / (odds[f"{k}_seen"] + 4), -2, 4)
        net.p[k] *= 0.1
        net.p[k][:, 0] += (0.5 if k == "word" else 0.3) * evidence[k]
    mean, square, step = {}, {}, 0
    for epoch in range(epochs):
        chosen = []
        for i, ((block, words), label) in enumerate(zip(blocks, labelled)):
            if epoch or not seeded:
                doc, first, size, value = net.logits(block, words)
            else:
                doc, first, size = window_rows(block.bounds)
                own = np.concatenate([[0], np.cumsum(np.maximum(0, evidence["word"][words.ids[words.index]]) ** 2)])
                value = own[first + size] - own[first]
            order = np.lexsort((-value, doc))
            best = order[np.searchsorted(doc[order], np.unique(doc))]
            other = np.searchsorted(doc, np.unique(doc)) + (rng.random(len(best)) * np.bincount(doc, minlength=len(label))[np.unique(doc)]).astype(np.int64)
            picked = np.unique(np.concatenate([best, other[label[doc[other]] == 0]]))
            chosen += [(i, first[w], size[w], label[doc[w]]) for w in picked]
        chosen = [chosen[j] for j in rng.permutation(len(chosen))]
        for at in range(0, len(chosen), batch):
            words, first, size, label = gathered(blocks, chosen[at : at + batch])
            step += 1
            for k, g in net.gradients(words, first, size, label).items():
                mean[k] = 0.9 * mean.get(k, 0) + 0.1 * g
                square[k] = 0.999 * square.get(k, 0) + 0.001 * g * g
                move = rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-6)
                net.p[k] = (net.p[k] - move).astype(np.float32)
    return net


def gathered(blocks: list[tuple[W.Block, Words]], chosen: list[tuple[int, int, int, int]]) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """The windows of a batch, one after another, with the inputs of their words."""
    ids, codes, counts, first, size = [], [], [], [], []
    for i, start, n, _ in chosen:
        words = blocks[i][1]
        own = words.index[start : start + n]
        ids.append(words.ids[own])
        spans = [words.codes[words.at[w] : words.at[w + 1]] for w in own]
        codes += spans
        counts += map(len, spans)
        first.append(sum(size))
        size.append(n)
    at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    ids = np.concatenate(ids)
    return Words(ids, np.concatenate(codes), at, np.arange(len(ids))), np.array(first), np.array(size), np.array([c[3] for c in chosen], np.float32)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, most: tuple[int, int] = TRAIN_DOCS, chars: int = TRAIN_CHARS) -> tuple[pa.Array, np.ndarray]:
    """Texts and labels of at most ``most`` documents of class 0 and 1, those of least hash, that are not held out and have at most ``chars`` characters.

    Documents are chosen by id, so only the chosen ids are broadcast and no
    text is shuffled but theirs."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    short = docs.select("doc_id", F.length("text").alias("n")).where(F.col("n").between(1, chars)).select("doc_id").distinct()
    ranked = known.join(short, "doc_id").withColumn("h", F.xxhash64("doc_id", F.lit(7)))
    parts = [ranked.where(F.col("toxic") == c).orderBy("h", "doc_id").limit(most[c]) for c in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    texts = docs.select("doc_id", "text").where(F.length("text").between(1, chars)).join(F.broadcast(chosen), "doc_id")
    rows = texts.select("text", "toxic", "h").orderBy("h", "text").limit(4 * sum(most)).toArrow().combine_chunks()
    return rows["text"], rows["toxic"].to_numpy().astype(np.int64)


def fitted(docs: DataFrame, labels: DataFrame, **options) -> Network:
    return trained(*training_sample(docs, labels, **options))


def scored(docs: DataFrame, network: Network, threshold: float = THRESHOLD) -> DataFrame:
    """For each row of docs doc_id, held_out, score and predicted (1 if score >= threshold) of its whole text.

    A null or empty text has the score of an empty window. A null doc_id is not
    held out. A very long text is scored whole. Repeated rows give a row each; an empty table gives none; other
    columns are ignored. The parameters, of fixed size, are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network.p)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.__new__(Network)
        net.p = shared.value
        for batch in batches:
            for block in W.blocks(batch.column(2), block_bytes=1 << 19):
                n = len(block.bounds) - 1
                score = net.scores(block)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, n), batch.column(1).slice(block.first, n), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(kernel, SCHEMA)


def clean_documents(docs: DataFrame, network: Network, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs whose score is below the threshold, with the columns of docs.

    A null or empty text has the score of an empty window; a very long text is
    scored whole, alone in its block; null doc_ids and repeated rows are judged
    each for itself; an empty table gives no rows.
    """
    shared, place = docs.sparkSession.sparkContext.broadcast(network.p), docs.columns.index("text")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.__new__(Network)
        net.p = shared.value
        for batch in batches:
            for block in W.blocks(batch.column(place), block_bytes=1 << 19):
                yield batch.slice(block.first, len(block.bounds) - 1).filter(pa.array(net.scores(block) < threshold))

    return docs.mapInArrow(kernel, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scored(docs, fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
