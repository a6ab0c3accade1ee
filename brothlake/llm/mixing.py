"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Every shuffled document is given a virtual finish time: the words its source
has sent up to its end, divided by the source's target. A document can be sent
twice, so it has a second finish time one whole source later. All entries are
range-sorted by finish time over all partitions and cut at the total budget:
partitions give their sums, the driver adds up those few numbers, and only the
partition in which the budget ends is summed row by row.

The sums within a source are two-level, so no source is summed in one task:
blocks of rows get their sums, the sums are accumulated, and each block is
accumulated from its start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import free_names, written
from .words import WORD_PATTERN

WEIGHTS = (3, 1, 2)
#: Blocks of one source at most: their sums are added up in one task.
MOST_BLOCKS = 65_536
SHARE = 1.5
REPEATS = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """One row for each source: rank, size, rows, weight and target.

    ``share`` times all sizes go to the sources by weight; a target above
    ``repeats`` times its source's size stops there, and the excess goes to the
    others by weight. In order of the level at which a source is full, all that
    are full below the common level stop at their limit.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    by_level = Window.orderBy("full_at", "rank").rowsBetween(Window.unboundedPreceding, -1)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    out = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
        .withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
        .withColumn("limit", F.col("source_size") * float(repeats))
        .withColumn("full_at", F.col("limit") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(everything) * float(share) - F.coalesce(F.sum("limit").over(by_level), F.lit(0.0)))
        .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_level), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.col("left_weight"))
        .withColumn("full", F.col("level") >= F.col("full_at"))
        .withColumn("common", F.min_by(F.when(~F.col("full"), F.col("level")), F.when(~F.col("full"), F.struct("full_at", "rank"))).over(everything))
    )
    return out.select("source", "rank", "source_size", "source_rows", "weight", F.when(F.col("full"), F.col("limit")).otherwise(F.col("common") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, carry: tuple[str, ...] = (), block_rows: int = 2_000, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """One row for each row of docs: doc_id, size, source_size, target, taken, and the columns named in ``carry``.

    taken is 0, size or 2 * size: documents are whole, and those up to the
    budget are taken in order of virtual finish time. The order within a
    source is that of md5 of doc_id, so reruns agree. A null or empty text has
    size 0 and takes nothing; a null source is a source of its own, last; rows
    without a doc_id are ordered by md5 of their text; repeated rows count one
    by one, and rows of one doc_id are next to each other; a very long text
    counts whole; an empty table gives no rows; other columns are ignored.
    """
    others = [c for c in carry if c not in ("doc_id", "source")]
    turn = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit("null")).cast("binary"))
    sized = written(docs.select("doc_id", "source", *others, word_count(F.col("text")).alias("size"), turn.alias("turn")), "mix-sized")
    targets = written(source_targets(sized, weights, share, repeats).coalesce(1), "mix-targets")
    span = float(1 << 32)
    blocks = F.least(F.ceil(F.col("source_rows") / block_rows), F.lit(MOST_BLOCKS))
    placed = (
        sized.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .drop("of")
        .withColumn("block", F.floor(F.conv(F.substring("turn", 1, 8), 16, 10).cast("double") / span * blocks).cast("long"))
    )
    starts = written(
        placed.groupBy("rank", "block").agg(F.sum("size").alias("words")).withColumn("before", F.coalesce(F.sum("words").over(Window.partitionBy("rank").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("words"),
        "mix-blocks",
    )
    inside = Window.partitionBy("rank", "block").orderBy("turn", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    timed = written(
        placed.join(starts, ["rank", "block"])
        .withColumn("sent", F.col("before") + F.sum("size").over(inside))
        .select("doc_id", "source", *others, "size", "source_size", "rank", "target", *[F.coalesce(F.try_divide(F.col("sent") + F.lit(k) * F.col("source_size"), F.col("target")), F.lit(0.0)).alias(f"finish_{k}") for k in range(repeats)]),
        "mix-timed",
    )
    last, rank = _cut(timed, targets, share, repeats)
    due = lambda k: (F.col(f"finish_{k}") < F.lit(last)) | ((F.col(f"finish_{k}") == F.lit(last)) & (F.col("rank") <= F.lit(rank)))
    taken = sum((F.when(due(k), F.col("size")).otherwise(F.lit(0)) for k in range(1, repeats)), F.when(due(0), F.col("size")).otherwise(F.lit(0)))
    return timed.select("doc_id", *carry, "size", "source_size", "target", taken.cast("long").alias("taken"))


def _cut(timed: DataFrame, targets: DataFrame, share: float, repeats: int) -> tuple[float, int]:
    """Finish time and source rank of the last entry within the budget.

    The entries are range-sorted into partitions. The driver gets a number for
    each partition and one row of the partition in which the budget ends.
    """
    budget = (targets.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]) * share
    spark = timed.sparkSession
    entries = timed.select("rank", "size", F.explode(F.array(*[F.col(f"finish_{k}") for k in range(repeats)])).alias("finish")).where("size > 0")
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    queue = written(entries.repartitionByRange(partitions, "finish", "rank").sortWithinPartitions("finish", "rank").withColumn("part", F.spark_partition_id()), "mix-queue")
    before = 0
    for part, words in sorted(queue.groupBy("part").agg(F.sum("size")).toLocalIterator()):
        if before + words > budget:
            break
        before += words
    else:
        return float("inf"), 1 << 30
    ordered = Window.partitionBy("part").orderBy("finish", "rank").rowsBetween(Window.unboundedPreceding, 0)
    ending = queue.where(F.col("part") == part).withColumn("upto", F.sum("size").over(ordered) + F.lit(before))
    last = ending.agg(F.max(F.when(F.col("upto") <= budget, F.struct("finish", "rank"))), F.min(F.struct("finish", "rank"))).first()
    return (last[0]["finish"], last[0]["rank"]) if last[0] else (last[1]["finish"], last[1]["rank"] - 1)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that the mix takes, with the columns of docs; a document taken twice is there twice.

    Rows of one doc_id and size are alike to the mix; what it takes of them
    goes to them one by one, so their number is right. A null or empty text
    has nothing to take and goes; an empty table gives no rows; a very long
    text is taken whole or not at all.
    """
    size, turn, copies, id_, words, nth, copy = free_names(docs, "size", "turn", "copies", "id", "words", "nth", "copy")
    alike = Window.partitionBy("doc_id", size).orderBy(F.xxhash64("text"))
    numbered = docs.withColumn(size, word_count(F.col("text"))).withColumn(turn, F.row_number().over(alike))
    taken = mix(docs, **options).where("taken > 0").withColumn("copies", (F.col("taken") / F.col("size")).cast("int"))
    ranked = taken.select(F.col("doc_id").alias(id_), F.col("size").alias(words), F.col("copies").alias(copies), F.row_number().over(Window.partitionBy("doc_id", "size").orderBy(F.desc("taken"))).alias(nth))
    joined = numbered.join(ranked, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(size) == F.col(words)) & (F.col(turn) == F.col(nth)))
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, text, 'null')) AS turn
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS rnk FROM sources
), weighed AS (
  SELECT *, ([3.0, 1.0, 2.0])[((rnk - 1) % 3 + 1)]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS lim FROM ranked
), levelled AS (
  SELECT *, lim / weight AS full_at FROM weighed
), filled AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE - coalesce(sum(lim) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS lvl
  FROM levelled WINDOW w AS (ORDER BY full_at, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT *, CASE WHEN lvl >= full_at THEN lim ELSE (SELECT lvl FROM filled WHERE NOT lvl >= full_at ORDER BY full_at, rnk LIMIT 1) * weight END AS target FROM filled
), sent AS (
  SELECT s.doc_id, s.size, t.source_size, t.rnk, t.target,
         sum(s.size) OVER (PARTITION BY t.rnk ORDER BY turn, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto, row_number() OVER () AS n
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), entries AS (
  SELECT *, unnest([0, 1]) AS k FROM sent
), timed AS (
  SELECT *, coalesce((upto + k * source_size)::DOUBLE / nullif(target, 0), 0) AS finish FROM entries
), queued AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rnk, n ROWS UNBOUNDED PRECEDING) AS total FROM timed WHERE size > 0
), taken AS (
  SELECT n, sum(size) AS words FROM queued WHERE total <= 1.5 * (SELECT sum(size) FROM sized) GROUP BY n
)
SELECT s.doc_id, s.size, s.source_size, s.target, coalesce(t.words, 0)::BIGINT AS taken FROM sent s LEFT JOIN taken t USING (n)
"""
