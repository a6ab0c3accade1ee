"""Whitening of embeddings by a compensated covariance.

Entries become integers, so their sums are exact. A second pass centres the
rows in double-double and adds their outer products up, block by block, by
error-free transformations; each task sends a high and a low part of its sums,
which are merged the same way, a row of the matrix at a time. The driver gets a
matrix whose size depends on the length of the vectors alone; its eigenvectors
come from a tridiagonal divide-and-conquer solver and are improved in
double-double. Rows are then projected where they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import doubled as D
from .tables import written

#: An entry c counts as floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8

#: Rows worked on at once; scaled entries of a magnitude above 2^MOST_BITS have no integer and leave their row out.
BLOCK_ROWS, MOST_BITS = 1_024, 62
#: A component whose share of all variance is smaller has none but that of rounding.
LEAST_SHARE = 2.0**-88

PARTS = "i int, high array<double>, low array<double>"


class Fit(NamedTuple):
    """What the rows are whitened with: n and exact sums, mean, unit eigenvectors as columns, their eigenvalues, and the trace."""

    n: int
    sums: list[int]
    mean: D.Pair
    vectors: D.Pair
    values: np.ndarray
    trace: float


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaled floors of all entries, the place of each row's first one, and each row's length, 0 where the row takes no part."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = column.offsets.to_numpy()
    entries = np.asarray(column.values.to_numpy(zero_copy_only=False), float)
    with np.errstate(over="ignore", invalid="ignore"):
        floors = np.floor(entries * SCALE)
    bad = np.concatenate([[0], np.cumsum(~(np.abs(floors) < 2.0**MOST_BITS))])
    lengths = np.where((bad[at[1:]] == bad[at[:-1]]) & pc.is_valid(column).to_numpy(zero_copy_only=False), np.diff(at), 0)
    return floors, at[:-1], lengths


def _integers(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and integer vectors of the rows that take part, a block at a time."""
    floors, at, lengths = _numbers(column)
    rows = np.flatnonzero(lengths == length) if length else np.zeros(0, int)
    for k in range(0, len(rows), BLOCK_ROWS):
        some = rows[k : k + BLOCK_ROWS]
        yield some, floors[at[some][:, None] + np.arange(length)].astype(np.int64) + SHIFT


def exact_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of rows that take part, and the sum of their integers for each dimension.

    Vectors are of the commonest length, of equally common ones of the
    shortest; of lengths, one row a task and length is sent.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            floors, at, lengths = _numbers(batch.column(0))
            for d in map(int, np.unique(lengths[lengths > 0])):
                rows, sums = np.flatnonzero(lengths == d), found.setdefault(d, [0, np.zeros(d, np.int64), np.zeros(d, np.int64)])
                sums[0] += len(rows)
                for k in range(0, len(rows), BLOCK_ROWS):
                    x = floors[at[rows[k : k + BLOCK_ROWS]][:, None] + np.arange(d)].astype(np.int64) + SHIFT
                    sums[1] += (x >> 32).sum(0)
                    sums[2] += (x & 0xFFFFFFFF).sum(0)
        schema = pa.schema([("d", pa.int32()), ("n", pa.int64()), ("high", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))])
        yield pa.RecordBatch.from_pylist([{"d": d, "n": n, "high": high.tolist(), "low": low.tolist()} for d, (n, high, low) in found.items()], schema)

    parts = written(vectors.select("v").mapInArrow(kernel, "d int, n long, high array<long>, low array<long>"), "whitening-sums")
    best = parts.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "d").first()
    if best is None:
        return 0, []
    each = parts.where(F.col("d") == best["d"]).select(F.posexplode(F.arrays_zip("high", "low")).alias("i", "x"))
    wide = lambda c: F.sum(F.col(f"x.{c}").cast("decimal(38,0)")).alias(c)
    sums = sorted(each.groupBy("i").agg(wide("high"), wide("low")).collect())
    return int(best["n"]), [(int(r["high"]) << 32) + int(r["low"]) for r in sums]


def merged(parts: DataFrame, rows: int) -> D.Pair:
    """The sums of high and low parts by i, in double-double, for i below ``rows``; each task holds only what it has summed up so far."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, D.Pair] = {}
        for batch in batches:
            for i, high, low in zip(*[c.to_pylist() for c in batch.columns]):
                part = np.array(high), np.array(low)
                sums[i] = D.add(sums[i], part) if i in sums else part
        yield _parts((i, *s) for i, s in sums.items())

    got = sorted(parts.repartition("i").mapInArrow(kernel, PARTS).collect())
    width = len(got[0]["high"]) if got else rows
    out = D.pair(np.zeros((rows, width)))
    for r in got:
        out[0][r["i"]], out[1][r["i"]] = r["high"], r["low"]
    return out


def _parts(rows) -> pa.RecordBatch:
    schema = pa.schema([("i", pa.int32()), ("high", pa.list_(pa.float64())), ("low", pa.list_(pa.float64()))])
    return pa.RecordBatch.from_pylist([{"i": int(i), "high": np.asarray(h), "low": np.asarray(l)} for i, h, l in rows], schema)


def outer_products(vectors: DataFrame, blocks: Callable[[pa.Array], Iterator[D.Pair]], length: int) -> D.Pair:
    """The sum of the outer products of centred rows, which ``blocks`` makes of a batch of the column v."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = D.pair(np.zeros((length, length))), False
        for batch in batches:
            for high, low in blocks(batch.column(0)):
                total, seen = D.add(total, D.product((high.T, low.T), (high, low))), True
        yield _parts(zip(range(length), *total) if seen else ())

    return merged(vectors.select("v").mapInArrow(kernel, PARTS), length)


def _mean(sums: list, n: int) -> D.Pair:
    means = [Fraction(s) / n for s in sums]
    high = [float(m) for m in means]
    return np.array(high), np.array([float(m - Fraction(h)) for m, h in zip(means, high)])


def _centred(x: np.ndarray, mean: D.Pair) -> D.Pair:
    return D.add(D.whole(x), D.minus((mean[0][None], mean[1][None])))


def fitted(vectors: DataFrame) -> Fit | None:
    """The fit on all rows of the column v (array<double>) that take part; None if there are none."""
    n, sums = exact_sums(vectors)
    if not n:
        return None
    mean, d = _mean(sums, n), len(sums)
    products = outer_products(vectors, lambda column: (_centred(x, mean) for _, x in _integers(column, d)), d)
    covariance = D.over(products, float(n))
    covariance = D.scaled(D.add(covariance, (covariance[0].T, covariance[1].T)), 0.5)
    values, directions = D.eigen(covariance)
    trace = float(sum(Fraction(h) + Fraction(l) for h, l in zip(covariance[0].diagonal(), covariance[1].diagonal())))
    return Fit(n, sums, mean, directions, values, trace)


def projected(rows: DataFrame, fit: Fit, components: int = COMPONENTS) -> DataFrame:
    """vec_id, deviation (decimal(38,0), null beyond that) and whitened (array<double>) of each row that takes part; a component without variance has null."""
    d, n, k = len(fit.sums), fit.n, min(components, len(fit.sums))
    varied = _varied(fit)[:k]
    basis, roots = (fit.vectors[0][:, :k], fit.vectors[1][:, :k]), np.sqrt(np.where(varied, fit.values[:k], 1.0))
    least = max(map(abs, fit.sums), default=0)

    def deviations(x: np.ndarray) -> pa.Array:
        bound = n * int(np.abs(x).max(initial=0)) + least
        if d * bound * bound < 2**63:
            return pa.array(((n * x - np.array(fit.sums, np.int64)) ** 2).sum(1)).cast(pa.decimal128(38, 0))
        exact = ((n * x.astype(object) - np.array(fit.sums, object)) ** 2).sum(1)
        return pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, x in _integers(batch.column(1), d):
                high, low = D.product(_centred(x, fit.mean), basis)
                white = np.where(varied, (high + low) / roots, 0.0)
                entries = pa.array(white.ravel(), mask=np.tile(~varied, len(some)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some)).cast(pa.int64()), deviations(x), pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * k, entries)], ["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "v").mapInArrow(kernel, "vec_id long, deviation decimal(38,0), whitened array<double>")


def _varied(fit: Fit) -> np.ndarray:
    return fit.values > max(fit.trace, 0.0) * LEAST_SHARE


def identity_error(white: DataFrame, n: int, components: int) -> float | None:
    """The largest absolute entry of the covariance of whitened, less the identity, over components with variance; None without any."""
    if not components:
        return None
    v = white.select(F.slice("whitened", 1, components).alias("v"))

    def rows(column: pa.Array) -> Iterator[np.ndarray]:
        x = np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(-1, components)
        yield from (x[k : k + BLOCK_ROWS] for k in range(0, len(x), BLOCK_ROWS))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = D.pair(np.zeros((1, components)))
        for batch in batches:
            for x in rows(batch.column(0)):
                total = D.add(total, D.product(D.pair(np.ones((1, len(x)))), D.pair(x)))
        yield _parts([(0, total[0][0], total[1][0])])

    mean = D.over(merged(v.mapInArrow(sums, PARTS), 1), float(n))
    products = outer_products(v, lambda column: (D.add(D.pair(x), D.minus(mean)) for x in rows(column)), components)
    return float(np.abs(D.add(D.over(products, float(n)), D.minus(D.pair(np.eye(components))))[0]).max())


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """For each row and component up to ``components`` (at most the length of the vectors) its whitened value.

    Columns: vec_id, component (from 1, by falling eigenvalue), n, deviation,
    whitened, explained, identity_error. Rows are left out whose embedding is
    null, empty or holds null or non-finite entries, and those of another
    length than the commonest (of equally common ones, the shortest) or with
    an entry of 2^52 or more in magnitude, which no integer of 64 bits stands
    for. Repeated rows and null vec_ids count and give rows each. Components
    without variance have null for whitened, explained 0 (null without any
    variance) and don't count for identity_error. deviation is decimal(38,0),
    null beyond it. An empty table gives no rows; other columns are ignored.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    fit = fitted(rows)
    if fit is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    white = written(projected(rows, fit, components), "whitening-rows")
    k = min(components, len(fit.sums))
    error = identity_error(white, fit.n, int(_varied(fit)[:k].sum()))
    shares = [float(e) / fit.trace if v else 0.0 for e, v in zip(fit.values[:k], _varied(fit))] if fit.trace > 0 else [None] * k
    shares = F.array(*[F.lit(s).cast("double") for s in shares])
    each = white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, "at").alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def query(spark, sf_dir: str) -> DataFrame:
    """whitened() with deviation as a long; null where that isn't enough."""
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumn("deviation", F.col("deviation").try_cast("long"))
