"""N-gram Jaccard join in size-banded tiles with hashed bitmap signatures.

Texts are sets of k-word shingles. Two sets can only be similar enough if they
share one of their first shingles in an order common to all sets (prefix
filter; rarest first), so a tile is the sets that have such a shingle, in
order of size, and a set meets only those of the sizes that the threshold
allows. A bitmap holds the parity of a set's hashes; the bits in which two
bitmaps differ bound their overlap from above.

A tile gives the sets that have a partner by these bounds, never the pairs.
Those sets meet again in the tile with their texts, are intersected exactly as
sorted arrays, and give a spanning forest of the tile's links: fewer links than
sets, however many pairs there are. Equal sets are one node.

First each set is in the tiles of its HEADS rarest shared shingles only, which
joins groups of near copies. Then all tiles that still hold more than one
component are searched for links between different components, leaving out
pairs that a tile of the first search has seen. No pair that could join two is
left out, so components are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .components import components, joined_components
from .tables import few, free_names, written

#: A shingle is frequent if a share of all documents has it. At most the mean set size divided by it are: the only table that is broadcast.
FREQUENT = 0.001
#: Sets and shingles in one block of a tile, about, and of how many tiles a set is in the first search.
TILE_ROWS, TILE_SHINGLES, HEADS = 2_048, 2_000_000, 4

SIGNATURES = "doc_id long, n_shingles long, node long, tokens array<long>, bitmap binary"


def shingle_sets(block: W.Block, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct shingle hashes of each document, and the bytes of each; a text of fewer words is one shingle, one without words none."""
    grams, size = W.grams(block.hashes, k), (block.ends - block.starts)
    lengths = np.convolve(size, np.ones(k, np.int64), "valid") if len(size) >= k else size[:0]
    with np.errstate(over="ignore"):
        for a, b in zip(block.bounds[:-1], block.bounds[1:]):
            if b - a >= k:
                sets, first = np.unique(grams[a : b - k + 1], return_index=True)
                yield sets, lengths[a : b - k + 1][first]
            elif b > a:
                yield W.mixed(W.grams(block.hashes[a:b], b - a) + np.uint64(b - a)), size[a:b].sum(keepdims=True)
            else:
                yield grams[:0], size[:0]


def needed(n: int, percent: int) -> int:
    """The smallest overlap with which a set of n can be similar enough to any other."""
    return -(-percent * n // 100)


def bitmap(hashes: np.ndarray) -> bytes:
    """Parities of the hashes in a power of two of bits, at least 64 and their number."""
    bits = 64
    while bits < len(hashes):
        bits *= 2
    return np.packbits(np.bincount((hashes >> np.uint64(7)).astype(np.int64) & (bits - 1), minlength=bits) & 1).tobytes()


def frequent_shingles(docs: DataFrame, k: int, share: float = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the shingles that about ``share`` of all documents have, at least.

    Each task counts lossily: shingles below a quarter of the share of what it
    has seen are forgotten when its table is full. It returns those above half
    the share, so what is gathered is bounded by the mean size of a set over
    the share. The order of shingles depends on it, links don't.
    """
    full, run = 250_000, 500_000

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times, seen, held, size = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, [], 0

        def counted() -> tuple[np.ndarray, np.ndarray]:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            if len(known):
                at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                old = known[at] == found
                times[at[old]] += n[old]
                found, n = np.concatenate([known, found[~old]]), np.concatenate([times, n[~old]])
                order = np.argsort(found, kind="stable")
                found, n = found[order], n[order]
            keep = n > (max(1, seen * share / 4) if len(found) > full else 0)
            return found[keep], n[keep]

        for batch in batches:
            for block in W.blocks(batch.column(0), lower=True):
                for hashes, _ in shingle_sets(block, k):
                    held.append(hashes)
                    size += len(hashes)
                    seen += 1
                    if size >= run:
                        known, times = counted()
                        held, size = [], 0
        if held:
            known, times = counted()
        keep = times >= max(4, seen * share / 2)
        yield pa.RecordBatch.from_arrays([pa.array(known[keep].view(np.int64)), pa.array(times[keep])], ["shingle", "n"])

    least = max(8, docs.count() * share)
    found = docs.select("text").mapInArrow(kernel, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toPandas()
    found["shingle"] = found["shingle"].to_numpy(np.int64).view(np.uint64)
    found = found.sort_values("shingle")
    return found["shingle"].to_numpy(), found["n"].to_numpy(np.int64)


def node_of(hashes: np.ndarray) -> int:
    """64-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def signatures(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], k: int, percent: int) -> DataFrame:
    """For each row of docs the size, name, prefix shingles and bitmap of its set; a set without shingles has none of the latter."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts = shared.value
        common, counts = np.append(common, np.uint64(2**64 - 1)), np.append(counts, 0)
        for batch in batches:
            for block in W.blocks(batch.column(1), lower=True):
                size, names, tokens, bits = [], [], [], []
                for hashes, length in shingle_sets(block, k):
                    n = len(hashes)
                    at = np.searchsorted(common, hashes)
                    rank = np.where(common[at] == hashes, counts[at], 0)
                    order = np.lexsort((hashes, -length, rank))[: n - needed(n, percent) + 1] if n else []
                    size.append(n)
                    names.append(node_of(hashes) if n else None)
                    tokens.append(hashes[order].view(np.int64) if n else [])
                    bits.append(bitmap(hashes) if n else None)
                columns = [batch.column(0).slice(block.first, len(size)), pa.array(size, pa.int64()), pa.array(names, pa.int64()), pa.array(tokens, pa.list_(pa.int64())), pa.array(bits, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SIGNATURES.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(kernel, SIGNATURES)


def _halved(bits: np.ndarray) -> np.ndarray:
    return bits[:, : bits.shape[1] // 2] ^ bits[:, bits.shape[1] // 2 :]


class Bitmaps:
    """Bitmaps of many sets, packed by width."""

    def __init__(self, bits: np.ndarray):
        self.width = np.array([len(x) for x in bits], np.int64)
        self.place, self.packed = np.zeros(len(bits), np.int64), {}
        for w in np.unique(self.width).tolist():
            rows = np.flatnonzero(self.width == w)
            self.place[rows] = np.arange(len(rows))
            self.packed[w] = np.frombuffer(b"".join(bits[rows]), np.uint8).reshape(len(rows), w)

    def differing(self, a: np.ndarray, other: Bitmaps, b: np.ndarray) -> np.ndarray:
        """Bits in which the bitmaps a of this and b of the other differ; the wider of a pair is folded."""
        out, wide, others = np.zeros(len(a), np.int64), self.width[a], other.width[b]
        for w1, w2 in {tuple(x) for x in np.stack([wide, others], axis=1).tolist()}:
            some = np.flatnonzero((wide == w1) & (others == w2))
            one, two = self.packed[w1][self.place[a[some]]], other.packed[w2][other.place[b[some]]]
            while one.shape[1] > two.shape[1]:
                one = _halved(one)
            while two.shape[1] > one.shape[1]:
                two = _halved(two)
            x = np.ascontiguousarray(one ^ two)
            out[some] = np.bitwise_count(x.view(np.uint64) if x.shape[1] % 8 == 0 else x).sum(1, dtype=np.int64)
        return out


def may_link(n1: np.ndarray, n2: np.ndarray, differ: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of sets can be similar enough, by sizes and differing bits."""
    most = np.minimum(np.minimum(n1, n2), (n1 + n2 - differ) // 2)
    return 100 * most >= percent * (n1 + n2 - most)


def by_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a partition in order of (token, i, j), cut and joined so that no tile is in two."""
    held: list[pa.RecordBatch] = []

    def whole() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        last = np.ones(batch.num_rows, bool)
        for c in ("token", "i", "j"):
            x = batch.column(c).to_numpy()
            last &= x == x[-1]
        cut = 0 if last.all() else int(np.flatnonzero(~last)[-1]) + 1
        if held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in ("token", "i", "j")):
            yield whole()
            held = []
        if cut:
            held.append(batch.slice(0, cut))
            yield whole()
            held = []
        held.append(batch.slice(cut))
    if held:
        yield whole()


def possible(tiles: DataFrame, percent: int, again: bool) -> DataFrame:
    """The rows (token, i, j, node, component) of tiles that have a partner by size and bitmap: of another component and, in a tile of two blocks, of the other block.

    tiles: token, i, j, block, node, component, n_shingles, bitmap and the
    columns h0, h1 and on, the node's heads whose tile of the first search is
    of one block (0: none). Of such tiles that two sets share only the one
    with the smallest token looks at the pair, and no tile does ``again``.
    """
    heads = [f"h{k}" for k in range(HEADS)]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_tile(batches):
            token, i, j, block, node, comp, n = (t.column(c).to_numpy() for c in ("token", "i", "j", "block", "node", "component", "n_shingles"))
            own = np.stack([t.column(h).to_numpy() for h in heads], axis=1)
            mixed, alone = i != j, (own == token[:, None]).any(1)
            maps = Bitmaps(np.array(t.column("bitmap").to_pylist(), object))
            marked, left = np.zeros(len(n), bool), np.arange(len(n))
            for lag in range(1, len(n)):
                left = left[left + lag < len(n)]
                right = left + lag
                left = left[(token[left] == token[right]) & (i[left] == i[right]) & (j[left] == j[right]) & (100 * n[left] >= percent * n[right])]
                if not len(left):
                    break
                right = left + lag
                asked = (comp[left] != comp[right]) & (~mixed[left] | (block[left] != block[right])) & ~(marked[left] & marked[right])
                a, b = left[asked], right[asked]
                if len(a):
                    ok = may_link(n[a], n[b], maps.differing(a, maps, b), percent)
                    a, b = a[ok], b[ok]
                for x in range(HEADS) if len(a) else ():
                    both = (own[b] == own[a, x][:, None]).any(1) & (own[a, x] != 0)
                    seen = both if again else both & ((own[a, x] < token[a]) | ~alone[a])
                    a, b = a[~seen], b[~seen]
                marked[a] = True
                marked[b] = True
            yield t.filter(pa.array(marked)).select(["token", "i", "j", "node", "component"])

    sorted_tiles = tiles.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "n_shingles")
    return sorted_tiles.mapInArrow(kernel, "token long, i int, j int, node long, component long")


def first_tiles(sets: DataFrame, tile_rows: int) -> tuple[DataFrame, DataFrame]:
    """Tiles of the heads of the sets, of a tile of several blocks each block by itself; and sets with the heads h0, h1 and on that have tiles of one block."""
    rows = sets.select("node", F.explode(F.slice("tokens", 1, HEADS)).alias("token"), "n_shingles")
    sized = rows.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.sum("n_shingles").alias("s")).where("m > 1")
    blocks = rows.join(sized.select("token", _blocks("m", "s", tile_rows).alias("blocks")), "token")
    placed = written(blocks.select("node", "token", F.pmod(F.xxhash64("node", "token"), F.col("blocks")).cast("int").alias("block"), "blocks"), "join-heads")
    single = placed.where("blocks = 1").groupBy("node").agg(F.collect_set("token").alias("heads"))
    headed = sets.join(single, "node", "left").select("*", *[F.coalesce(F.try_element_at("heads", F.lit(k + 1)), F.lit(0)).alias(f"h{k}") for k in range(HEADS)]).drop("heads")
    headed = written(headed, "join-headed")
    tiles = placed.join(headed.drop("tokens"), "node").select("token", F.col("block").alias("i"), F.col("block").alias("j"), "block", "node", F.col("node").alias("component"), "n_shingles", "bitmap", *[f"h{k}" for k in range(HEADS)])
    return tiles, headed


def _blocks(rows: str, shingles: str, tile_rows: int) -> Column:
    return F.greatest(F.ceil(F.col(rows) / tile_rows), F.ceil(F.col(shingles) / TILE_SHINGLES)).cast("int")


def open_tiles(headed: DataFrame, roots: DataFrame, tile_rows: int) -> DataFrame | None:
    """The rows of the tiles that hold sets of more than one component (roots: node, root); None without any.

    The largest component of a tile of several blocks is dealt to blocks 0 and
    on, the rest to blocks -1 and on; only pairs of blocks that hold some of
    the rest are formed.
    """
    placed = headed.select("node", F.explode("tokens").alias("token"), "n_shingles").join(roots, "node", "left").select("node", "token", "n_shingles", F.coalesce("root", "node").alias("component"))
    parts = placed.groupBy("token", "component").agg(F.count(F.lit(1)).alias("m"), F.sum("n_shingles").alias("s"))
    largest = F.max(F.struct("m", "s", "component")).alias("top")
    still = parts.groupBy("token").agg(F.sum("m").alias("m"), F.sum("s").alias("s"), largest, F.count(F.lit(1)).alias("parts")).where("parts > 1")
    still = still.select("token", F.col("top.component").alias("top"), _blocks("m", "s", tile_rows).alias("blocks"), F.col("top.m").alias("tm"), F.col("top.s").alias("ts"), (F.col("m") - F.col("top.m")).alias("rm"), (F.col("s") - F.col("top.s")).alias("rs"))
    still = written(still.select("token", "top", "blocks", _blocks("tm", "ts", tile_rows).alias("major"), _blocks("rm", "rs", tile_rows).alias("minor")), "join-open")
    if still.isEmpty():
        return None
    rows = placed.join(still, "token")
    turn = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    block = F.when(F.col("blocks") == 1, F.lit(0)).when(F.col("component") == F.col("top"), turn("major")).otherwise(-1 - turn("minor"))
    rest = F.sequence(-F.col("minor"), F.lit(-1))
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).when(F.col("block") >= 0, rest).otherwise(F.concat(rest, F.sequence(F.lit(0), F.col("major") - 1)))
    dealt = rows.withColumn("block", block).select("token", "node", "component", "block", F.explode(others).alias("o"))
    tiles = dealt.select("token", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "node", "component")
    return tiles.join(headed.drop("tokens"), "node").select("token", "i", "j", "block", "node", "component", "n_shingles", "bitmap", *[f"h{k}" for k in range(HEADS)])


def forest(sets: list[np.ndarray], comp: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join all of the sets that links join, each between two parts not joined before; sets of one component are joined from the start."""
    n = np.array([len(s) for s in sets])
    if len(n) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return [(0, 1)] if 100 * both >= percent * (n.sum() - both) and comp[0] != comp[1] else []
    order = np.argsort(n, kind="stable")
    n, comp = n[order], comp[order]
    _, flat = np.unique(np.concatenate([sets[x] for x in order]), return_inverse=True)
    at = np.concatenate([[0], np.cumsum(n)])
    flags, left, links = np.zeros(flat.max() + 1, np.int32), np.ones(len(n), bool), []
    for root in range(len(n)):
        if not left[root]:
            continue
        stack = np.flatnonzero(left & (comp == comp[root])).tolist()
        left[stack] = False
        while stack and left.any():
            x = stack.pop()
            lo, hi = np.searchsorted(n, -(-percent * n[x] // 100)), np.searchsorted(n, 100 * n[x] // percent, "right")
            if not left[lo:hi].any():
                continue
            flags[flat[at[x] : at[x + 1]]] = 1
            both = np.add.reduceat(flags[flat[at[lo] : at[hi]]], at[lo:hi] - at[lo])
            flags[flat[at[x] : at[x + 1]]] = 0
            for y in lo + np.flatnonzero(left[lo:hi] & (100 * both >= percent * (n[x] + n[lo:hi] - both))):
                if left[y]:
                    links.append((int(order[x]), int(order[y])))
                    joined = np.flatnonzero(left & (comp == comp[y]))
                    left[joined] = False
                    stack += joined.tolist()
    return links


def texts_of(nodes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """node and a text that has its set, for each node of nodes (node, first_id: the doc_id of such a text), a written table.

    Where nodes are few they are broadcast, so that no other text is shuffled.
    """

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch.column(1), lower=True):
                mine = pa.array([node_of(hashes) if len(hashes) else None for hashes, _ in shingle_sets(block, k)], pa.int64())
                part = batch.slice(block.first, len(mine))
                yield pa.RecordBatch.from_arrays([mine, part.column(0), part.column(1)], ["node", "wanted", "text"])

    schema = "node long, wanted long, text string"
    asked = nodes.where("first_id IS NOT NULL").select(F.col("first_id").alias("doc_id"), F.col("node").alias("wanted"))
    by_id = docs.join(few(asked), "doc_id").select("wanted", "text").mapInArrow(named, schema).where("node = wanted").select("node", "text")
    unnamed = docs.where("doc_id IS NULL").select(F.lit(None).cast("long").alias("wanted"), "text").mapInArrow(named, schema).select("node", "text")
    without = nodes.where("first_id IS NULL").select("node")
    return by_id.unionByName(unnamed.join(without, "node", "left_semi")).dropDuplicates(["node"])


def links_in(tiles: DataFrame, docs: DataFrame, firsts: DataFrame, k: int, percent: int, again: bool) -> DataFrame:
    """Links (a, b) between nodes that join all that the links within the tiles join, by exact intersection of the sets."""
    rows = written(possible(tiles, percent, again), "join-possible")
    texts = texts_of(written(rows.select("node").distinct().join(firsts, "node"), "join-wanted"), docs, k)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_tile(batches):
            keys = np.stack([t.column(c).to_numpy().astype(np.int64) for c in ("token", "i", "j")], axis=1)
            edges = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]])
            node, comp, found = t.column("node").to_numpy(), t.column("component").to_numpy(), []
            for lo, hi in zip(edges[:-1], edges[1:]):
                if hi - lo > 1:
                    sets = [hashes for block in W.blocks(t.column("text").slice(lo, hi - lo), lower=True) for hashes, _ in shingle_sets(block, k)]
                    found += [(node[lo + x], node[lo + y]) for x, y in forest(sets, comp[lo:hi], percent)]
            pairs = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    with_texts = rows.join(texts, "node").select("token", "i", "j", "node", "component", "text")
    return written(with_texts.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j").mapInArrow(kernel, "a long, b long"), "join-links")


def labelled(docs: DataFrame, k: int = 3, percent: int = 90, tile_rows: int = TILE_ROWS, frequent: float = FREQUENT) -> DataFrame:
    """For each row of docs doc_id, n_shingles, component_id (the smallest doc_id among the documents that links lead to) and node, the name of its set.

    Two documents link when 100 * intersection >= percent * union of their
    sets. A null or empty text, or one without words, has no shingles, links
    with nothing and is a component of its own. A null doc_id never is the
    smallest, unless all of a component's are null. Repeated rows give a row
    each; an empty table gives none; other columns are ignored. Sets are told
    apart by 64-bit digests, shingles by 64-bit hashes. A very long text is
    one row of its tiles like any other.
    """
    docs = docs.select("doc_id", "text")
    sig = written(signatures(docs, frequent_shingles(docs, k, frequent), k, percent), "join-signatures")
    nodes = written(sig.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first_id"), *[F.first(c).alias(c) for c in ("n_shingles", "tokens", "bitmap")]), "join-sets")
    postings = nodes.select("node", F.posexplode("tokens").alias("pos", "token"))
    shared = postings.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("token")
    tokens = postings.join(shared, "token").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("tokens"))
    sets = written(nodes.select("node", "n_shingles", "bitmap").join(tokens, "node").withColumn("tokens", F.col("tokens.token")), "join-shared")
    firsts = nodes.select("node", "first_id")

    tiles, headed = first_tiles(sets, tile_rows)
    roots = components(links_in(tiles, docs, firsts, k, percent, again=False))
    rest = open_tiles(headed, roots, tile_rows)
    if rest is not None:
        roots = joined_components(roots, links_in(rest, docs, firsts, k, percent, again=True))

    rooted = firsts.join(roots, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = rooted.join(smallest, "root").select("node", "component_id")
    return sig.select("doc_id", "n_shingles", "node").join(labels, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "node")


def joined(docs: DataFrame, **options) -> DataFrame:
    """labelled() without the names of the sets."""
    return labelled(docs, **options).drop("node")


def representatives(docs: DataFrame, k: int = 3, **options) -> DataFrame:
    """One row of docs for each component of labelled(), that of the smallest doc_id, with the columns of docs.

    Of repeated rows one stays. A null or empty text is a component of its
    own, so it stays, once for each doc_id; so does a component whose doc_ids
    are all null, once for each different set. An empty table gives no rows.
    """
    place, names = docs.columns.index("text"), [f.name for f in docs.schema]
    node, of, first_id = free_names(docs, "node", "of", "first_id")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch.column(place), lower=True):
                nodes = [node_of(hashes) if len(hashes) else None for hashes, _ in shingle_sets(block, k)]
                part = batch.slice(block.first, len(nodes))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(nodes, pa.int64())], [*names, node])

    first = labelled(docs, k=k, **options).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(first_id), F.col("node").alias(of)).distinct()
    named = docs.mapInArrow(kernel, T.StructType([*docs.schema.fields, T.StructField(node, T.LongType())]))
    kept = named.join(first, F.col("doc_id").eqNullSafe(F.col(first_id)) & F.col(node).eqNullSafe(F.col(of)), "left_semi")
    return kept.dropDuplicates(["doc_id", node]).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    return joined(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM d
), sized AS (
  SELECT doc_id, g, len(g)::BIGINT AS n FROM s
), flat AS (
  SELECT doc_id, n, unnest(g) AS x FROM sized
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), edges AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach AS (
  SELECT doc_id AS node, doc_id AS other FROM sized UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a
)
SELECT z.doc_id, z.n AS n_shingles, min(r.other) AS component_id FROM sized z JOIN reach r ON r.node = z.doc_id GROUP BY z.doc_id, z.n
"""
