"""Approximate nearest neighbours by an inverted multi-index.

Unit vectors are cut in two halves, each quantised to its own codebook; a cell
is a pair of centroids; there are about as many as the square root of the rows.
A query goes through the cells in order of summed distance, with a heap over
the two sorted centroid lists, until the cells hold its share of all rows. The
share is the least one that finds enough of the true neighbours of a bounded
sample of queries, which are compared with all rows. The visited rows are
reranked by exact cosine, cell by cell and in chunks of bounded size, so no
cell has to fit into one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

#: Vectors that the codebooks are fitted on, about, and queries on which the visited share is measured, about; every row is indexed.
FIT_ROWS, TRIAL_QUERIES = 20_000, 256
#: Recall that the visited share is chosen for, and the most centroids of a codebook.
RECALL, MOST_CENTROIDS = 0.96, 1_024
CHUNK_ROWS = 4_096
TOP = 5
EVERY = 50


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (array<double>) of the rows that take part, all of one length.

    Left out: null ids, null, empty or zero vectors, those holding null or
    non-finite components, and those whose length isn't the commonest (of
    equally common ones, the shortest).
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).where("vec_id IS NOT NULL AND size(vector) > 0").where(F.forall("vector", finite)).where(F.exists("vector", lambda x: x != 0))
    commonest = v.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return v.where(F.size("vector") == (commonest["d"] if commonest else 0))


def k_means(x: np.ndarray, k: int, rounds: int = 15, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = distances(x, centres).argmin(1)
        for c in range(len(centres)):
            if (near == c).any():
                centres[c] = x[near == c].mean(0)
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared, less the part that is the same for all centres."""
    return (centres**2).sum(1)[None] - 2 * x @ centres.T


def unit(rows) -> np.ndarray:
    x = np.stack([np.asarray(r, float) for r in rows])
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def codebooks(vectors: DataFrame, centroids: int | None = None, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray] | None:
    """Centroids of both halves, by k-means on about ``fit_rows`` rows chosen by hash, all if there are fewer.

    Without ``centroids`` each half has the fourth root of the rows, times 1.5.
    """
    n = vectors.count()
    share = min(1.0, fit_rows / max(1, n))
    centroids = centroids or max(4, min(MOST_CENTROIDS, round(1.5 * n**0.25)))
    sample = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < share * 1_000_000).select("vec_id", "vector").toPandas().sort_values("vec_id", kind="stable")["vector"]
    if not len(sample):
        return None
    x = unit(sample)
    half = max(1, x.shape[1] // 2)
    return k_means(x[:, :half], centroids), k_means(x[:, half:], centroids, seed=4)


def cell_order(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of centroids by summed distance: a heap over the two sorted lists, each pair pushed after both that precede it."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, done = [(first[a[0]] + second[b[0]], 0, 0)], set()
    while heap:
        _, i, j = heapq.heappop(heap)
        done.add((i, j))
        yield int(a[i]), int(b[j])
        if i + 1 < len(a) and (j == 0 or (i + 1, j - 1) in done):
            heapq.heappush(heap, (first[a[i + 1]] + second[b[j]], i + 1, j))
        if j + 1 < len(b) and (i == 0 or (i - 1, j + 1) in done):
            heapq.heappush(heap, (first[a[i]] + second[b[j + 1]], i, j + 1))


def with_cells(vectors: DataFrame, books: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """vectors with the column cell."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    @F.pandas_udf("int")
    def cell(v: pd.Series) -> pd.Series:
        one, two = shared.value
        x, half = unit(v), one.shape[1]
        return pd.Series(distances(x[:, :half], one).argmin(1) * len(two) + distances(x[:, half:], two).argmin(1), dtype="int32")

    return vectors.withColumn("cell", cell("vector"))


def ordered_cells(v, books: tuple[np.ndarray, np.ndarray], size: dict[int, int]) -> Iterator[Iterator[int]]:
    """For each vector the cells that hold rows, nearest first."""
    one, two = books
    x, half = unit(v), one.shape[1]
    for d1, d2 in zip(distances(x[:, :half], one), distances(x[:, half:], two)):
        yield (i * len(two) + j for i, j in cell_order(d1, d2) if size.get(i * len(two) + j))


def visited(queries: DataFrame, books: tuple[np.ndarray, np.ndarray], sizes: dict[int, int], enough: int) -> DataFrame:
    """vec_id, key and each cell that the query visits: the nearest ones until they hold ``enough`` rows."""
    shared = queries.sparkSession.sparkContext.broadcast((books, sizes))

    @F.pandas_udf("array<int>")
    def cells(v: pd.Series) -> pd.Series:
        books, size = shared.value
        out = []
        for order in ordered_cells(v, books, size):
            got, held = [], 0
            for c in order:
                got.append(c)
                held += size[c]
                if held >= enough:
                    break
            out.append(got)
        return pd.Series(out)

    return queries.select("vec_id", "key", F.explode(cells("vector")).alias("cell"))


def needed_share(index: DataFrame, asked: DataFrame, books: tuple[np.ndarray, np.ndarray], sizes: dict[int, int], top: int, recall: float = RECALL, trials: int = TRIAL_QUERIES) -> float:
    """The least share of the rows whose visit finds ``recall`` of the true neighbours of about ``trials`` queries.

    The trial queries are chosen by hash and broadcast; every task compares
    its rows with them and keeps the ``top`` best of each. The walk through
    the cells, of all of which a query's distances are sorted at once, is the
    executors' work too: the driver gets a share for each true neighbour.
    """
    share = min(1.0, trials / max(1, asked.count()))
    chosen = asked.where(F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1_000_000)) < share * 1_000_000).select("vec_id", "vector").toPandas()
    if not len(chosen):
        return 1.0
    shared = index.sparkSession.sparkContext.broadcast((chosen["vec_id"].to_numpy(), unit(chosen["vector"])))

    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, q = shared.value
        for batch in batches:
            if not len(batch):
                continue
            score = q @ unit(batch["vector"]).T
            score[ids[:, None] == batch["vec_id"].to_numpy()[None]] = -np.inf
            k = min(top, len(batch))
            best = np.argpartition(-score, k - 1, axis=1)[:, :k]
            row = np.repeat(np.arange(len(q)), k)
            found = pd.DataFrame({"row": row, "score": score[row, best.ravel()], "vec_id": batch["vec_id"].to_numpy()[best.ravel()], "cell": batch["cell"].to_numpy()[best.ravel()]})
            yield found[np.isfinite(found["score"])]

    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    found = index.select("vec_id", "vector", "cell").mapInPandas(kernel, "row int, score double, vec_id long, cell int")
    true = found.withColumn("k", F.row_number().over(order)).where(F.col("k") <= top).select("row", "cell").toPandas()
    if not len(true):
        return 1.0
    cells = np.array(sorted(sizes), np.int64)
    told = index.sparkSession.sparkContext.broadcast((books, cells, np.array([sizes[c] for c in cells.tolist()], np.int64)))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The share of the rows that each trial query has visited once it is through with a true neighbour's cell."""
        (one, two), cells, counts = told.value
        q, half = shared.value[1], one.shape[1]
        for batch in batches:
            out = []
            for row, wanted in zip(batch["row"], batch["cells"]):
                d1, d2 = distances(q[row : row + 1, :half], one)[0], distances(q[row : row + 1, half:], two)[0]
                order, held = np.argsort(d1[cells // len(two)] + d2[cells % len(two)], kind="stable"), np.empty(len(cells))
                held[order] = np.cumsum(counts[order])
                out += (held[np.searchsorted(cells, wanted)] / counts.sum()).tolist()
            yield pd.DataFrame({"share": np.array(out, float)})

    asked_cells = true.groupby("row")["cell"].apply(list)
    trial_rows = index.sparkSession.createDataFrame([(int(r), [int(c) for c in cs]) for r, cs in asked_cells.items()], "row int, cells array<int>")
    shares = np.sort(trial_rows.repartition(max(1, min(64, len(asked_cells)))).mapInPandas(walk, "share double").toPandas()["share"])
    return float(shares[min(len(shares), int(np.ceil(recall * len(shares)))) - 1])


def _scaled(rows) -> np.ndarray:
    """The vectors, each times a power of two so that its largest component is near 1: cosines stay as they are, to the bit."""
    x = np.stack(rows)
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _best(found: pd.DataFrame, asked: pd.DataFrame, top: int) -> pd.DataFrame:
    """The nearest rows of one chunk for each query that visits it, by exact cosine; ties to the smaller vec_id."""
    out = {"query_id": [], "key": [], "vec_id": [], "score": []}
    if len(found) and len(asked):
        found = found.sort_values("vec_id", kind="stable")
        v, q = _scaled(found["vector"].to_numpy()), _scaled(asked["vector"].to_numpy())
        ids, mine, key = found["vec_id"].to_numpy(), asked["query_id"].to_numpy(), asked["key"].to_numpy()
        v_norm, q_norm = np.sqrt((v * v).sum(1)), np.sqrt((q * q).sum(1))
        for at in range(0, len(q), 512):
            part = (q[at : at + 512] / q_norm[at : at + 512, None]) @ (v / v_norm[:, None]).T
            part[mine[at : at + 512, None] == ids[None]] = -np.inf
            k = min(top, len(v))
            least = np.partition(part, len(v) - k, axis=1)[:, len(v) - k] - 1e-9
            row, col = np.nonzero((part >= least[:, None]) & np.isfinite(part))
            exact = (q[at + row] * v[col]).sum(1) / (q_norm[at + row] * v_norm[col])
            order = np.lexsort((ids[col], -exact, row))
            row, col, exact = row[order], col[order], exact[order]
            keep = np.arange(len(row)) - np.searchsorted(row, row) < top
            out["query_id"].append(mine[at + row[keep]])
            out["key"].append(key[at + row[keep]])
            out["vec_id"].append(ids[col[keep]])
            out["score"].append(exact[keep])
    return pd.DataFrame({k: np.concatenate(x) if x else np.zeros(0, "float64" if k == "score" else "int64") for k, x in out.items()})


def nearest(vectors: DataFrame, is_query: Column, top: int = TOP, probe_share: float | None = None, centroids: int | None = None, chunk_rows: int = CHUNK_ROWS, fit_rows: int = FIT_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest rows found for each row that ``is_query`` is true of.

    A query visits the cells that hold ``probe_share`` of all rows: 1 is exact;
    without it, needed_share(). Rows with the query's own id are no candidates.
    Rows that usable() leaves out take no part. Repeated vectors are candidates
    each; of repeated queries each different vector of an id is a query with
    ``top`` rows of its own. With fewer candidates than ``top`` in the visited
    cells those are returned. An empty table gives no rows; other columns are
    ignored.
    """
    rows = usable(vectors)
    books = codebooks(rows, centroids, fit_rows)
    if books is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = written(with_cells(rows.withColumn("asked", is_query.eqNullSafe(True)), books), "ann-index")
    sizes = {r["cell"]: r["count"] for r in index.groupBy("cell").count().toLocalIterator()}
    asked = written(index.where("asked").select("vec_id", "vector", F.xxhash64("vector").alias("key")).dropDuplicates(["vec_id", "key"]), "ann-queries")
    share = needed_share(index, asked, books, sizes, top) if probe_share is None else probe_share
    visits = written(visited(asked, books, sizes, max(top + 1, int(np.ceil(share * sum(sizes.values()))))), "ann-visits")

    # A cell's rows are dealt to chunks and its visitors to blocks, each pair of which is one task's work; there are at most as many cells as pairs of centroids.
    parts = lambda n: F.ceil(F.col(n) / chunk_rows).cast("int")
    visitors = visits.groupBy("cell").agg(F.count(F.lit(1)).alias("visitors"))
    plan = F.broadcast(index.groupBy("cell").agg(F.count(F.lit(1)).alias("rows")).join(visitors, "cell").select("cell", parts("rows").alias("chunks"), parts("visitors").alias("blocks")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    found = index.join(plan, "cell").select("vec_id", "vector", "cell", F.pmod(F.xxhash64("vec_id", "vector"), F.col("chunks")).cast("int").alias("chunk"), every("blocks").alias("block"))
    wanted = visits.join(plan, "cell").select("vec_id", "key", "cell", F.pmod(F.xxhash64("vec_id", "key"), F.col("blocks")).cast("int").alias("block"), every("chunks").alias("chunk"))
    wanted = wanted.join(asked, ["vec_id", "key"]).select(F.col("vec_id").alias("query_id"), "key", "vector", "cell", "chunk", "block")
    keys = ["cell", "chunk", "block"]
    local = found.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInPandas(lambda f, w: _best(f, w, top), "query_id long, key long, vec_id long, score double")
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % EVERY == 0)
