"""Similarity join of names: by their lengths, or by the rarest letters that they share, several at a time.

Names of at most WORD letters meet where their lengths do: for two lengths it
is known how many letters must be shared, and a task takes a block of names of
the one and a block of the other (letter_counts.sharing()).

Longer names, and those that must have columns in common, have keys. A name's letters are numbered (the first a, the second a ...) and put in one
order for all names, the rarest first. Two names that must share t letters
share at least k of the first n - t + k of each, so the first k that they share
are a key: a pair meets once, where its key is. Keys begin with KEY_LETTERS
letters; those of too many pairs are split by the next shared letter, and what
is still too large then is dealt out in blocks. Nothing is lost by any of it.
"""

from __future__ import annotations

import difflib
import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.chains import bound
from ..sources.scratch import written as _written
from .letter_counts import STEP, matched, numbered, raised, sharing

#: Letters of the first keys and of the longest ones, and the pairs of one key at most.
KEY_LETTERS, MOST_LETTERS, MOST_PAIRS = 2, 4, 250_000

#: Names and pairs of a task: their bytes are few and their work is long, so sizes in bytes would make too few tasks; and tasks of a join at most.
TASK_NAMES, TASK_PAIRS, MOST_TASKS = 10_000, 1_000_000, 4_096

#: Letters of a name that meets others by its length, and the pairs of names of one block: a task looks at some hundred million pairs a second.
WORD, BLOCK_PAIRS = 64, 2_000_000_000

#: Parts of a name's signature: two of its letters, two of its pairs of letters.
BITS = ("one", "two", "three", "four")

#: Letters from common to rare; others are rarer still.
COMMON = "etaoinsrhldcumfpgwybvkxjqz 0123456789-"


def ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    """100 times the matching share of two strings, rounded; 0 with a null. What is known of a second string is kept for all its pairs."""
    out, matcher, second = np.zeros(len(a), np.int32), difflib.SequenceMatcher(None), None
    firsts, seconds = a.tolist(), b.tolist()
    for i in b.fillna("").argsort(kind="stable"):
        x, y = firsts[i], seconds[i]
        if isinstance(x, str) and isinstance(y, str):
            if y != second:
                matcher.set_seq2(y)
                second = y
            matcher.set_seq1(x)
            out[i] = round(100 * matcher.ratio())
    return pd.Series(out)


ratio = F.pandas_udf(ratios, T.IntegerType())


def numbered_letters(c: Column) -> Column:
    """The letters of a string as sorted distinct numbers: later ones of a letter before earlier ones, then rare letters before common ones."""
    place = lambda x: F.when(F.instr(F.lit(COMMON), F.lower(x)) > 0, F.instr(F.lit(COMMON), F.lower(x))).otherwise(F.lit(99))
    code = lambda x, n: ((F.lit(1 << 22).cast("long") - n) * 128 + (99 - place(x))) * F.lit(1 << 21).cast("long") + _point(x)
    each = lambda letters: F.flatten(F.transform(F.array_distinct(letters), lambda x: F.transform(F.sequence(F.lit(1), F.size(F.filter(letters, lambda y: y == x))), lambda n: code(x, n))))
    return F.when(c == "", F.array().cast("array<long>")).otherwise(F.array_sort(bound(F.regexp_extract_all(c, F.lit("(?s)."), 0), each)))


def signatures(spelling: Column, letters: Column) -> Column:
    """Bits of a name: those of its numbered letters (two longs) and of its pairs of neighbouring letters.

    Names differ in at most as many letter bits as letters that they don't
    share. One letter put in or taken out changes at most three pairs, so names
    that come to each other by d such steps differ in at most 3 d pair bits.
    """
    bit = lambda x, seed: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(x, F.lit(seed)), F.lit(64)).cast("int"))
    bits = lambda xs, seed, mine: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(F.when(mine(x), bit(x, seed)).otherwise(F.lit(0).cast("long"))))
    half = lambda x: F.pmod(F.xxhash64(x, F.lit(5)), F.lit(2))
    pairs = bound(F.regexp_extract_all(spelling, F.lit("(?s)."), 0), lambda xs: F.transform(F.slice(xs, 1, F.greatest(F.size(xs) - 1, F.lit(0))), lambda x, i: F.concat(x, F.get(xs, i + 1))))
    return F.struct(bits(letters, 1, lambda x: half(x) == 0).alias("one"), bits(letters, 1, lambda x: half(x) == 1).alias("two"), bits(pairs, 2, lambda x: half(x) == 0).alias("three"), bits(pairs, 2, lambda x: half(x) == 1).alias("four"))


def _point(letter: Column) -> Column:
    """The code point of a letter."""
    return F.conv(F.hex(F.encode(letter, "UTF-32")), 16, 10).cast("long")


def least_shared(n: Column, m: Column, least: int) -> Column:
    """How many letters names of n and m letters share at least if their ratio rounds to ``least`` or more."""
    return F.ceil((F.lit(least) - 0.5) * (n + m) / 200 - 1e-9)


def least_shared_of(n: int, m: int, least: int) -> int:
    """least_shared() of two numbers."""
    return math.ceil((least - 0.5) * (int(n) + int(m)) / 200 - 1e-9)


def _tasks(df: DataFrame, n: int, each: int) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, min(MOST_TASKS, math.ceil(n / each)))


def dealt_names(df: DataFrame, more: list[Column]) -> DataFrame:
    """df, a table of names, with columns whose work on a name is long; both steps are written, and names are dealt out by their number."""
    found = _written(df, "names")
    return _written(found.repartition(_tasks(found, found.count(), TASK_NAMES)).select("*", *more), "names-keyed")


def candidates(left: DataFrame, right: DataFrame, least: int, shared: list[str] | None = None, most_pairs: int = MOST_PAIRS, longer: int = 0) -> DataFrame:
    """Pairs of rows (a, of left, and b, of right, with equal ``shared`` columns) that share enough letters for a ratio of ``least``, and of which one has more than ``longer`` letters.

    left and right have id (long, distinct), letters (numbered_letters()), the
    shared columns and, both or neither, bits (signatures()). Columns: a, b and shared. Each pair comes once.
    """
    shared = shared or []
    if "bits" not in left.columns:
        left, right = (df.withColumn("bits", F.struct(*[F.lit(0).cast("long").alias(x) for x in BITS])) for df in (left, right))
    # n letters need at least `own` shared ones, with the shortest partner that is long enough.
    share = (least - 0.5) / (200.5 - least)
    sized = lambda df, side: df.select(F.lit(side).alias("side"), "id", *shared, "letters", "bits", F.size("letters").alias("n"), F.greatest(F.lit(1), F.ceil(F.size("letters") * share - 1e-9).cast("int")).alias("own")).where("n > 0")
    rows = sized(left, 0).unionByName(sized(right, 1)).withColumns({"key": F.array().cast("array<long>"), "at": F.lit(0)})
    found, by = [], ["key", *shared]
    for k in range(1, MOST_LETTERS + 1):
        rows = _longer(rows, k)
        if k < KEY_LETTERS:
            found.append(_met(rows.where(F.col("own") <= k), by, least, k, longer, exactly=True))
            continue
        rows = _written(rows, "similar-keys")
        many = lambda side: F.count_if(F.col("side") == side)
        sizes = rows.groupBy(*by).agg(many(0).alias("lefts"), many(1).alias("rights"), (many(0) * many(1)).alias("pairs")).where("pairs > 0")
        sizes = _written(sizes, "similar-sizes")
        large = sizes.where(F.col("pairs") > most_pairs)
        small = sizes.where(F.col("pairs") <= most_pairs)
        tasks = _tasks(rows, small.agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0], TASK_PAIRS)
        found.append(_met(rows.join(small.select(*by), by, "left_semi").repartition(tasks, *by), by, least, k, longer))
        if large.isEmpty():
            break
        rows = rows.join(large, by)
        if k == MOST_LETTERS:
            tasks = _tasks(rows, large.agg(F.sum("pairs")).first()[0], TASK_PAIRS)
            found.append(_met(_in_blocks(rows, most_pairs).repartition(tasks, *by, "i", "j"), [*by, "i", "j"], least, k, longer))
        else:
            rows = rows.drop("lefts", "rights", "pairs")
            found.append(_met(rows.where(F.col("own") <= k), by, least, k, longer, exactly=True))
    return reduce(DataFrame.unionByName, found).select("a", "b", *shared)


def _longer(rows: DataFrame, k: int) -> DataFrame:
    """The rows with keys of k letters: each key with each later letter that can be the k-th shared one."""
    last = F.col("n") - F.greatest(F.col("own"), F.lit(k)) + k
    return rows.withColumn("at", F.explode(F.when(F.col("at") < last, F.sequence(F.col("at") + 1, last)))).withColumn("key", F.concat("key", F.array(F.element_at("letters", F.col("at")))))


def _in_blocks(rows: DataFrame, most_pairs: int) -> DataFrame:
    """The rows of large keys with blocks i and j of left and right rows: a left row is in one i and every j."""
    side = int(most_pairs**0.5)
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.ceil(F.col(n) / side)).cast("int")
    every = lambda n: F.sequence(F.lit(0), (F.ceil(F.col(n) / side) - 1).cast("int"))
    left = F.col("side") == 0
    placed = rows.withColumn("i", F.explode(F.when(left, F.array(dealt("lefts"))).otherwise(every("lefts"))))
    return placed.withColumn("j", F.explode(F.when(left, every("rights")).otherwise(F.array(dealt("rights"))))).drop("lefts", "rights", "pairs")


def _met(rows: DataFrame, by: list[str], least: int, k: int, longer: int, exactly: bool = False) -> DataFrame:
    """Pairs of the keys whose letters are the first k that they share, and which share enough; with ``exactly`` those only for which k are enough."""
    side = lambda s, name: rows.where(F.col("side") == s).select(*by, F.col("id").alias(name), F.col("letters").alias(f"{name}_letters"), *[F.col(f"bits.{x}").alias(f"{name}_{x}") for x in BITS], F.col("n").alias(f"{name}_n"), F.col("at").alias(f"{name}_at"))
    t = least_shared(F.col("a_n"), F.col("b_n"), least)
    most = k + F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))
    enough = (t == k) if exactly else (t >= k)
    # What compares numbers only stands in the join, and drops nearly all pairs before their letters are looked at.
    apart = lambda *xs: sum((F.bit_count(F.col(f"a_{x}").bitwiseXOR(F.col(f"b_{x}"))) for x in xs), F.lit(0))
    unshared = F.col("a_n") + F.col("b_n") - 2 * t
    near = (apart("one", "two") <= unshared) & (apart("three", "four") <= 3 * unshared)
    met = side(0, "a").join(side(1, "b"), by).where((F.greatest("a_n", "b_n") > longer) & enough & (t <= F.least("a_n", "b_n")) & (most >= t) & near)
    first = F.size(F.array_intersect(F.slice("a_letters", 1, F.col("a_at")), F.slice("b_letters", 1, F.col("b_at")))) == k
    return met.where(first).where(F.size(F.array_intersect("a_letters", "b_letters")) >= t).drop("i", "j", "key")


def _by_length(left: DataFrame, right: DataFrame, least: int, block_pairs: int, top: int | None = None) -> DataFrame:
    """x, y and score of the spellings of left and right, distinct and of at most WORD letters, with a ratio of at least ``least``; with ``top`` only those that may be among the best of x, ties included."""
    spark, side = left.sparkSession, max(1, int(block_pairs**0.5))
    lefts, rights = ({r["n"]: r["count"] for r in df.groupBy("n").count().collect()} for df in (left, right))
    met = [(n, m, math.ceil(lefts[n] / side), math.ceil(rights[m] / side)) for n in lefts for m in rights if least_shared_of(n, m, least) <= min(n, m)]
    lengths = F.broadcast(spark.createDataFrame(met, "n int, m int, lefts int, rights int"))
    dealt = lambda n: F.pmod(F.xxhash64("spelling"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = left.join(lengths, "n").select("n", "m", dealt("lefts").alias("i"), every("rights").alias("j"), F.lit(0).alias("side"), "spelling")
    b = right.withColumnRenamed("n", "m").join(lengths, "m").select("n", "m", every("lefts").alias("i"), dealt("rights").alias("j"), F.lit(1).alias("side"), "spelling")

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(batches)
        a, b = (rows["spelling"][rows["side"] == s].to_numpy() for s in (0, 1))
        if not len(a) or not len(b):
            return
        n, m = (int(x) for x in rows[["n", "m"]].iloc[0])
        best, (letters_a, letters_b) = np.zeros((len(a), top or 1), np.int32), numbered(a, b)
        rounded = lambda letters: np.round(100 * (2.0 * letters / (n + m))).astype(np.int32)
        for i, j, letters in sharing(letters_a, letters_b, least_shared_of(n, m, least)):
            # A pair scores as its letters at most; what matches is looked for in none that others are surely better than.
            for length in np.unique(letters)[::-1]:
                asked = (letters == length) & ((rounded(int(length)) >= best[i, -1]) | (top is None))
                x, y = i[asked], j[asked]
                score = rounded(np.concatenate([np.zeros(0, np.int64), *[matched(letters_a[x[p : p + STEP]], letters_b[y[p : p + STEP]]) for p in range(0, len(x), STEP)]]))
                if top:
                    best = raised(best, x, score)
                kept = (score >= least) & ((score >= best[x, -1]) | (top is None))
                yield pd.DataFrame({"x": a[x[kept]], "y": b[y[kept]], "score": score[kept]})

    by = ["n", "m", "i", "j"]
    tasks = max(spark.sparkContext.defaultParallelism, min(MOST_TASKS, sum(i * j for _, _, i, j in met)))
    return a.unionByName(b).repartition(tasks, *by).groupBy(*by).applyInPandas(scored, "x string, y string, score int")


def scored_pairs(left: DataFrame, right: DataFrame, left_name: str, right_name: str, least: int, prepared: Callable[[Column], Column] = F.lower, shared: list[str] | None = None, most_pairs: int = MOST_PAIRS, block_pairs: int = BLOCK_PAIRS, top: int | None = None) -> DataFrame:
    """left_name, right_name and score of all pairs of distinct names with a ratio of at least ``least`` and equal ``shared`` columns.

    What matches in two strings is at most their longest common subsequence,
    and that at most the letters that they share, so no pair that sharing() or
    candidates() leaves out can reach the score. With ``top`` pairs may be left
    out that score less than as many others of their left name. Names that
    ``prepared`` makes equal are compared once. Null and empty names are like
    none; so is a null in a shared column. Tables of intermediate keys are
    written to the session's scratch folder.
    """
    shared = shared or []

    def spelled(df: DataFrame, name: str, kept: str) -> DataFrame:
        names = df.select(F.col(name).alias(kept), *shared).where(F.col(kept).isNotNull()).distinct().withColumn("spelling", prepared(F.col(kept))).where("spelling <> ''")
        return _written(names, "similar-spellings")

    def distinct(names: DataFrame) -> DataFrame:
        return _written(names.select("spelling", *shared, F.length("spelling").alias("n")).distinct(), "similar-distinct")

    def keyed(found: DataFrame) -> DataFrame:
        dealt = found.drop("n").repartition(_tasks(found, found.count(), TASK_NAMES)).withColumn("id", F.xxhash64("spelling", F.lit(1))).withColumn("letters", numbered_letters(F.col("spelling")))
        return _written(dealt.withColumn("bits", signatures(F.col("spelling"), F.col("letters"))), "similar-names")

    def by_keys(one: DataFrame, two: DataFrame, longer: int) -> DataFrame:
        one, two = keyed(one), keyed(two)
        near = candidates(one.select("id", "letters", "bits", *shared), two.select("id", "letters", "bits", *shared), least, shared, most_pairs, longer)
        word = lambda df, key, name: df.select(F.col("id").alias(key), F.col("spelling").alias(name), *shared)
        pairs = near.join(word(one, "a", "x"), ["a", *shared]).join(word(two, "b", "y"), ["b", *shared])
        return pairs.withColumn("score", ratio("x", "y")).where(F.col("score") >= least).select("x", "y", *shared, "score")

    a, b = spelled(left, left_name, "left_name"), spelled(right, right_name, "right_name")
    one, two = distinct(a), distinct(b)
    if shared:
        scored = by_keys(one, two, 0)
    else:
        short = F.col("n") <= WORD
        scored = _by_length(one.where(short), two.where(short), least, block_pairs, top)
        if not one.where(~short).isEmpty() or not two.where(~short).isEmpty():
            # What has a partner of more than WORD letters has as many letters as this at least.
            long = F.col("n") >= next(n for n in range(1, WORD + 2) if least_shared_of(n, WORD + 1, least) <= n)
            scored = scored.unionByName(by_keys(one.where(long), two.where(long), WORD))
    named = scored.join(a.withColumnRenamed("spelling", "x"), ["x", *shared]).join(b.withColumnRenamed("spelling", "y"), ["y", *shared])
    return named.select("left_name", "right_name", *shared, "score")
