"""Removal of passages that an earlier document has, by repeated-phrase automata.

A window is WINDOW consecutive words. Its anchor is the smallest hash among its
ANCHOR-word phrases, so equal windows have equal anchors, and neighbouring
windows mostly share theirs. Anchors of more than one document lead to the
windows that recur; the smallest doc_id that has a window owns it, and runs of
owned windows are the confirmed passages. Passages are cut into blocks of half
a window, of which every window in a passage holds one. The blocks are compiled
into Aho-Corasick automata, in shards by owner, and of every document the words
under windows that have an anchor of a shard's stream through its automaton.
Windows around each hit are then looked up among the shard's own. A phrase that
very many passages go on from differently would send its documents to all
shards; the windows under such anchors are joined by their hashes instead.

Equal texts are one: all but the first are removed whole. Each document meets
the shards it needs only, and the documents of a popular shard are dealt out to
copies of its automaton, so nothing is gathered in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .tables import few, free_names, written

WINDOW, ANCHOR = 50, 20
#: Words of passages in one automaton, and characters of documents that one copy of it reads, about.
SHARD_WORDS, STREAM_CHARS = 400_000, 8_000_000
#: An anchor that more shards have is not streamed: its windows are looked up by their hashes.
MANY_SHARDS = 8

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
PROFILE = "doc_id long, n_words long, kept_sha256 string, anchors array<long>"


def joined_words(block: W.Block, keep: np.ndarray | None = None) -> list[bytes]:
    """The words of each document (of those kept, if ``keep`` is given) with one space between."""
    keep = np.ones(len(block.starts), bool) if keep is None else keep
    flags = np.zeros(len(block.data) + 1, np.int8)
    np.add.at(flags, block.starts[keep], 1)
    np.add.at(flags, block.ends[keep], -1)
    inside = np.cumsum(flags[:-1]).astype(bool)
    data = block.data.copy()
    kept = np.flatnonzero(keep)
    doc = np.searchsorted(block.bounds, kept, "right") - 1
    spaces = block.ends[kept[:-1][doc[1:] == doc[:-1]]]
    data[spaces] = 0x20
    inside[spaces] = True
    upto = np.concatenate([[0], np.cumsum(inside)])[block.offsets]
    data = data[inside]
    return [data[a:b].tobytes() for a, b in zip(upto[:-1], upto[1:])]


def windows_of(block: W.Block, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, hash and anchor of every window of the block's documents."""
    if len(block.hashes) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    place = np.flatnonzero(W.fitting(block.bounds, window))
    lowest = W.sliding_min(W.grams(block.hashes, anchor), window - anchor + 1)
    return place, W.grams(block.hashes, window)[place], lowest[place]


def native_words_sha(text: Column) -> Column:
    """The kept_sha256 of a text of which nothing is removed."""
    return F.sha2(F.concat_ws(" ", F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(W.WORD_PATTERN), 0)).cast("binary"), 256)


def profiled(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """For each row of docs its words, their digest, and the anchors of its windows."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch.column(1)):
                n = len(block.bounds) - 1
                place, _, anchors = windows_of(block, window, anchor)
                cuts = np.searchsorted(place, block.bounds)
                own = [np.unique(anchors[a:b]).view(np.int64) for a, b in zip(cuts[:-1], cuts[1:])]
                shas = [hashlib.sha256(x).hexdigest() for x in joined_words(block)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, n), pa.array(np.diff(block.bounds)), pa.array(shas), pa.array(own, pa.list_(pa.int64()))], [c.split()[0] for c in PROFILE.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(kernel, PROFILE)


def recurring_texts(docs: DataFrame, profiles: DataFrame) -> DataFrame:
    """doc_id, kept_sha256, text and recurring anchors of one document for each different text that has any."""
    anchored = profiles.select("doc_id", "kept_sha256", F.explode("anchors").alias("anchor"))
    recurring = anchored.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("anchor")
    marked = written(anchored.join(recurring, "anchor").groupBy("doc_id", "kept_sha256").agg(F.collect_list("anchor").alias("anchors")), "substring-marked")
    ids = written(marked.select("doc_id").distinct(), "substring-ids")

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas = [hashlib.sha256(x).hexdigest() for block in W.blocks(batch.column(2)) for x in joined_words(block)]
            yield batch.filter(pa.array([a == b for a, b in zip(shas, batch.column(1).to_pylist())], pa.bool_()))

    found = docs.select("doc_id", "text").join(few(ids), "doc_id", "left_semi").join(marked, "doc_id").select("doc_id", "kept_sha256", "text", "anchors")
    return found.mapInArrow(same, "doc_id long, kept_sha256 string, text string, anchors array<long>").dropDuplicates(["doc_id", "kept_sha256"])


def owned_windows(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """hash, owner and anchor of every window that more than one document has; the owner is the smallest doc_id."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wanted = batch.column(0).to_numpy(), batch.column(2)
            for block in W.blocks(batch.column(1)):
                place, hashes, anchors = windows_of(block, window, anchor)
                cuts = np.searchsorted(place, block.bounds)
                for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    row = block.first + i
                    some = np.isin(anchors[a:b], wanted[row].values.to_numpy().view(np.uint64))
                    found, at = np.unique(hashes[a:b][some], return_index=True)
                    if len(found):
                        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(np.full(len(found), ids[row])), pa.array(anchors[a:b][some][at].view(np.int64))], ["hash", "doc_id", "anchor"])

    rows = texts.select("doc_id", "text", "anchors").mapInArrow(kernel, "hash long, doc_id long, anchor long")
    return rows.groupBy("hash").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), F.min("anchor").alias("anchor")).where("owner < last").drop("last")


def passages(texts: DataFrame, owned: DataFrame, window: int, anchor: int) -> DataFrame:
    """owner, text and n_words of each run of windows that a document owns."""
    lists = owned.groupBy("owner").agg(F.collect_list("hash").alias("hashes"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, text, size = [], [], []
            for block in W.blocks(batch.column(1)):
                place, hashes, _ = windows_of(block, window, anchor)
                cuts = np.searchsorted(place, block.bounds)
                for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    row = block.first + i
                    own = place[a:b][np.isin(hashes[a:b], batch.column(2)[row].values.to_numpy().view(np.uint64))]
                    breaks = np.flatnonzero(np.diff(own) > 1)
                    for first, last in zip(own[np.concatenate([[0], breaks + 1])] if len(own) else (), own[np.concatenate([breaks, [len(own) - 1]])] if len(own) else ()):
                        end = last + window
                        owner.append(batch.column(0)[row].as_py())
                        text.append(block.data[block.starts[first] : block.ends[end - 1]].tobytes().decode())
                        size.append(end - first)
            yield pa.RecordBatch.from_arrays([pa.array(owner, pa.int64()), pa.array(text, pa.string()), pa.array(size, pa.int64())], ["owner", "text", "n_words"])

    return texts.join(lists, texts["doc_id"] == lists["owner"]).select("owner", "text", "hashes").mapInArrow(kernel, "owner long, text string, n_words long")


def spelled(hashes: np.ndarray) -> str:
    """A character for each word; words rarely share one."""
    return (hashes.astype(np.uint32) % np.uint32(1 << 20) + np.uint32(0x10000)).astype("<u4").tobytes().decode("utf-32-le")


class Shard:
    """Automaton and windows of the passages of one shard."""

    def __init__(self, owners: list[int], texts: list[str], window: int, anchor: int):
        import ahocorasick

        self.window, half = window, window // 2
        first: dict[str, int] = {}
        hashes, owned = [], []
        for block in W.blocks(pa.array(texts, pa.string())):
            place, found, _ = windows_of(block, window, anchor)
            doc = np.searchsorted(block.bounds, place, "right") - 1
            hashes.append(found)
            owned.append(np.array(owners[block.first : block.first + len(block.bounds) - 1], np.int64)[doc])
            line = spelled(block.hashes)
            for i, (a, b) in enumerate(zip(block.bounds[:-1], block.bounds[1:])):
                owner = owners[block.first + i]
                for at in range(a, b - half + 1, half):
                    key = line[at : at + half]
                    if first.get(key, owner) >= owner:
                        first[key] = owner
        hashes, owned = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((hashes, np.uint64), (owned, np.int64)))
        order = np.lexsort((owned, hashes))
        keep = order[np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])] if len(order) else order
        self.hashes, self.owners = hashes[keep], owned[keep]
        self.automaton = ahocorasick.Automaton()
        for key, owner in first.items():
            self.automaton.add_word(key, owner)
        self.automaton.make_automaton()
        self.half = half

    def covered(self, block: W.Block, ids: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """Document of the block, and starts and ends of the runs of its words in windows of smaller ids."""
        if not len(self.hashes):
            return
        line, every = spelled(block.hashes), W.grams(block.hashes, self.window)
        for i, (a, b) in enumerate(zip(block.bounds[:-1], block.bounds[1:])):
            if b - a < self.window:
                continue
            mine = ids[block.first + i]
            ends = np.array([end for end, owner in self.automaton.iter(line[a:b]) if owner < mine], np.int64)
            if not len(ends):
                continue
            near = np.zeros(b - a + 1, np.int64)
            np.add.at(near, np.maximum(0, ends + 1 - self.window), 1)
            np.add.at(near, ends + 2 - self.half, -1)
            starts = np.flatnonzero(np.cumsum(near)[: b - a - self.window + 1])
            found = every[a + starts]
            at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
            starts = starts[(self.hashes[at] == found) & (self.owners[at] < mine)]
            if len(starts):
                flags = np.zeros(b - a + 2, np.int64)
                np.add.at(flags, starts + 1, 1)
                np.add.at(flags, starts + 1 + self.window, -1)
                edges = np.flatnonzero(np.diff((np.cumsum(flags) > 0).astype(np.int8)))
                yield i, edges.tolist()


def segments(texts: DataFrame, routes: DataFrame, window: int, anchor: int) -> DataFrame:
    """shard, doc_id, kept_sha256, start, text: for each shard the runs of words under the windows whose anchors it has.

    routes: doc_id, kept_sha256 and routes, an array of (anchor, shard). A
    shard is sent these runs only, not the whole text.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, row, start, text = [], [], [], []
            lists = batch.column(3)
            for block in W.blocks(batch.column(2)):
                place, _, anchors = windows_of(block, window, anchor)
                cuts = np.searchsorted(place, block.bounds)
                for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    wanted = lists[block.first + i].values.flatten()
                    keys, shards = wanted[0].to_numpy().view(np.uint64), wanted[1].to_numpy()
                    for s in np.unique(shards):
                        starts = place[a:b][np.isin(anchors[a:b], keys[shards == s])]
                        if not len(starts):
                            continue
                        breaks = np.flatnonzero(np.diff(starts) > window)
                        for first, last in zip(starts[np.concatenate([[0], breaks + 1])], starts[np.concatenate([breaks, [len(starts) - 1]])]):
                            shard.append(s)
                            row.append(block.first + i)
                            start.append(first - block.bounds[i])
                            text.append(block.data[block.starts[first] : block.ends[last + window - 1]].tobytes().decode())
            rows = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(start, pa.int64()), pa.array(text, pa.string())], ["shard", "doc_id", "kept_sha256", "start", "text"])

    joined = texts.select("doc_id", "kept_sha256", "text").join(routes, ["doc_id", "kept_sha256"]).select("doc_id", "kept_sha256", "text", "routes")
    return joined.mapInArrow(kernel, "shard int, doc_id long, kept_sha256 string, start long, text string")


def looked_up(texts: DataFrame, anchors: DataFrame, owned: DataFrame, window: int, anchor: int) -> DataFrame:
    """doc_id, kept_sha256, spans of the windows with one of the anchors that a smaller doc_id owns, by equality of hashes."""
    lists = texts.select("doc_id", "kept_sha256", F.explode("anchors").alias("anchor")).join(anchors, "anchor").groupBy("doc_id", "kept_sha256").agg(F.collect_list("anchor").alias("wanted"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch.column(2)):
                place, hashes, lowest = windows_of(block, window, anchor)
                cuts = np.searchsorted(place, block.bounds)
                for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    row = block.first + i
                    some = np.flatnonzero(np.isin(lowest[a:b], batch.column(3)[row].values.to_numpy().view(np.uint64)))
                    if len(some):
                        same = pa.array(np.full(len(some), row))
                        yield pa.RecordBatch.from_arrays([pa.array(hashes[a:b][some].view(np.int64)), batch.column(0).take(same), batch.column(1).take(same), pa.array(place[a:b][some] - block.bounds[i])], ["hash", "doc_id", "kept_sha256", "start"])

    rows = texts.join(lists, ["doc_id", "kept_sha256"]).select("doc_id", "kept_sha256", "text", "wanted").mapInArrow(kernel, "hash long, doc_id long, kept_sha256 string, start long")
    hits = rows.join(owned.select("hash", "owner"), "hash").where("owner < doc_id")
    return hits.groupBy("doc_id", "kept_sha256").agg(F.flatten(F.collect_list(F.array("start", F.col("start") + window))).alias("spans"))


def located(texts: DataFrame, found: DataFrame, owned: DataFrame, window: int, anchor: int, shard_words: int = SHARD_WORDS, stream_chars: int = STREAM_CHARS, many_shards: int = MANY_SHARDS) -> DataFrame:
    """doc_id, kept_sha256 and spans (starts and ends of words, in turn) of the passages of smaller doc_ids in each text."""
    shards = max(1, -(-(found.agg(F.sum("n_words")).first()[0] or 0) // shard_words))
    shard = lambda c: F.pmod(F.xxhash64(c), F.lit(shards)).cast("int")
    holders = owned.groupBy("anchor", shard("owner").alias("shard")).agg(F.min("owner").alias("least"))
    held_by_many = shards > many_shards
    if held_by_many:
        many = written(holders.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > many_shards).select("anchor"), "substring-many")
        holders = holders.join(many, "anchor", "left_anti")
    routes = texts.select("doc_id", "kept_sha256", F.explode("anchors").alias("anchor")).join(holders, "anchor").where("least < doc_id")
    routes = written(routes.groupBy("doc_id", "kept_sha256").agg(F.collect_list(F.struct("anchor", "shard")).alias("routes")), "substring-routes")
    sent = written(segments(texts, routes, window, anchor), "substring-segments")
    copies = sent.groupBy("shard").agg(F.greatest(F.lit(1), F.ceil(F.sum(F.length("text")) / stream_chars)).cast("int").alias("copies"))
    turn = F.pmod(F.xxhash64("doc_id"), F.col("copies")).cast("int")
    reading = sent.join(copies, "shard").select("shard", turn.alias("copy"), F.lit(1).alias("kind"), "doc_id", "kept_sha256", "start", "text")
    told = found.withColumn("shard", shard("owner")).join(copies, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("kind"), F.col("owner").alias("doc_id"), F.lit("").alias("kept_sha256"), F.lit(0).cast("long").alias("start"), "text")

    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, built, owners, phrases = None, None, [], []
        for batch in batches:
            out = []
            for (shard_no, copy, kind), part in batch.groupby(["shard", "copy", "kind"], sort=True):
                if key != (shard_no, copy):
                    key, built, owners, phrases = (shard_no, copy), None, [], []
                if kind == 0:
                    owners += part["doc_id"].tolist()
                    phrases += part["text"].tolist()
                    continue
                built = built or Shard(owners, phrases, window, anchor)
                ids, shas, starts = (part[c].to_numpy() for c in ("doc_id", "kept_sha256", "start"))
                for block in W.blocks(pa.array(part["text"], pa.string())):
                    out += [(ids[block.first + i], shas[block.first + i], [int(x + starts[block.first + i]) for x in spans]) for i, spans in built.covered(block, ids)]
            yield pd.DataFrame(out, columns=["doc_id", "kept_sha256", "spans"])

    streamed = told.unionByName(reading).repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind").mapInPandas(kernel, "doc_id long, kept_sha256 string, spans array<long>")
    if held_by_many:
        streamed = streamed.unionByName(looked_up(texts, many, owned, window, anchor))
    return streamed.groupBy("doc_id", "kept_sha256").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _kept_flags(n: int, spans: np.ndarray) -> np.ndarray:
    flags = np.zeros(n + 1, np.int64)
    np.add.at(flags, spans[0::2], 1)
    np.add.at(flags, spans[1::2], -1)
    return np.cumsum(flags[:-1]) == 0


def repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_words: int = SHARD_WORDS, stream_chars: int = STREAM_CHARS, many_shards: int = MANY_SHARDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """profiles of all rows; firsts (kept_sha256, first_id) of the texts long enough; spans of words to remove, with the text."""
    docs = docs.select("doc_id", "text")
    profiles = written(profiled(docs, window, anchor), "substring-profiles")
    firsts = written(profiles.where(F.col("n_words") >= window).groupBy("kept_sha256").agg(F.min("doc_id").alias("first_id")), "substring-firsts")
    alone = profiles.join(firsts.withColumnRenamed("first_id", "doc_id"), ["doc_id", "kept_sha256"], "left_semi").dropDuplicates(["doc_id", "kept_sha256"])
    texts = written(recurring_texts(docs, alone), "substring-texts")
    owned = written(owned_windows(texts, window, anchor), "substring-windows")
    found = written(passages(texts, owned, window, anchor), "substring-passages")
    spans = located(texts, found, owned, window, anchor, shard_words, stream_chars, many_shards)
    return profiles, firsts, spans.join(texts.drop("anchors"), ["doc_id", "kept_sha256"])


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """For each row of docs: doc_id, n_words, n_removed, kept_sha256 of its kept words joined by single spaces.

    A word is removed if a window of ``window`` words over it also starts in a
    document with a smaller doc_id; the input alone is judged, not what is left
    of it. A null, empty or shorter text loses nothing. A null doc_id is
    neither smaller nor larger than any, so its row loses nothing and takes
    nothing from others. Repeated rows, and other texts of one doc_id, don't
    count against each other; a very long text is worked on whole, alone in its
    block; an empty table gives no rows; other columns are ignored.
    """
    profiles, firsts, spans = repeats(docs, **options)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, shas = [], []
            for block in W.blocks(batch.column(2)):
                keep = np.concatenate([_kept_flags(b - a, batch.column(3)[block.first + i].values.to_numpy()) for i, (a, b) in enumerate(zip(block.bounds[:-1], block.bounds[1:]))])
                removed += np.add.reduceat(~keep, block.bounds[:-1], dtype=np.int64).tolist()
                shas += [hashlib.sha256(x).hexdigest() for x in joined_words(block, keep)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(shas, pa.string())], ["doc_id", "kept_sha256", "n_removed", "left_sha256"])

    cut = spans.select("doc_id", "kept_sha256", "text", "spans").mapInArrow(kernel, "doc_id long, kept_sha256 string, n_removed long, left_sha256 string")
    rows = profiles.drop("anchors").join(firsts, "kept_sha256", "left").join(cut, ["doc_id", "kept_sha256"], "left")
    copy = F.col("n_words").isNotNull() & F.coalesce(F.col("first_id") < F.col("doc_id"), F.lit(False))
    return rows.select("doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"), F.when(copy, F.lit(EMPTY_SHA)).otherwise(F.coalesce("left_sha256", "kept_sha256")).alias("kept_sha256"))


def cut_documents(docs: DataFrame, **options) -> DataFrame:
    """docs with the words that deduplicated() removes, and the white space after each, cut out of their texts; the columns of docs.

    Rows stay, even without any word left; a null text stays null; repeated
    rows, ties and very long texts are as in deduplicated(); an empty table
    gives no rows.
    """
    sha, of, first_id, some_id, some_sha, cuts = free_names(docs, "sha", "of", "first_id", "some_id", "some_sha", "spans")
    _, firsts, spans = repeats(docs, **options)
    keyed = docs.withColumn(sha, native_words_sha(F.col("text")))
    first = firsts.select(F.col("kept_sha256").alias(of), F.col("first_id").alias(first_id))
    some = spans.select(F.col("doc_id").alias(some_id), F.col("kept_sha256").alias(some_sha), F.col("spans").alias(cuts))
    marked = keyed.join(first, F.col(sha) == F.col(of), "left").join(some, (F.col("doc_id") == F.col(some_id)) & (F.col(sha) == F.col(some_sha)), "left")

    @F.pandas_udf("string")
    def without(text: pd.Series, spans: pd.Series) -> pd.Series:
        out = text.copy()
        for at in np.flatnonzero(spans.notna().to_numpy()):
            block = next(W.blocks(pa.array([text.iloc[at]], pa.string())))
            keep = _kept_flags(len(block.starts), np.asarray(spans.iloc[at]))
            stops = np.concatenate([block.starts[1:], [len(block.data)]])
            parts = [block.data[a:b].tobytes() for a, b in zip(block.starts[keep], stops[keep])]
            out.iloc[at] = (block.data[: block.starts[0]].tobytes() + b"".join(parts)).decode()
        return out

    text = F.when(F.coalesce(F.col(first_id) < F.col("doc_id"), F.lit(False)), F.lit("")).when(F.col(cuts).isNotNull(), without("text", cuts)).otherwise(F.col("text"))
    return marked.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return deduplicated(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50
), windows AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY md5(array_to_string(w[i : i + 49], ' '))) AS first FROM p
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM windows WHERE first < doc_id
), flat AS (
  SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM d
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY j) AS text FROM flat ANTI JOIN covered USING (doc_id, j) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
