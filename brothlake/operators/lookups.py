"""Keyed lookups of names: an index of names and ids on disk, and sources of properties asked in turn."""

from __future__ import annotations

import bisect
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import numbered

#: Folders of an index on disk; a lookup reads those of its names only.
BUCKETS = 64

#: So many keys at most are told to the scan of a sorted index, which then passes over row groups by their Bloom filters.
PUSHED_KEYS = 200


def _key(name: Column) -> Column:
    return F.trim(F.lower(name))


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def name_index(systematic: DataFrame, synonyms: DataFrame) -> DataFrame:
    """key and cid of every name of two tables (cid, name, pos): of equal systematic names the last counts, of equal synonyms the first, and those only where no systematic name is equal.

    One aggregation over both tables, combined before the shuffle.
    """
    rank = lambda tier, pos: F.struct(F.lit(tier).alias("tier"), pos.alias("pos"), F.col("cid"))
    names = systematic.select(_key(F.col("name")).alias("key"), rank(1, F.col("pos")).alias("r")).unionByName(synonyms.select(_key(F.col("name")).alias("key"), rank(0, -F.col("pos")).alias("r")))
    return names.where("key <> ''").groupBy("key").agg(F.max("r").alias("r")).select("key", F.col("r.cid").alias("cid"))


def named_ids(spark: SparkSession, path: str) -> DataFrame:
    """cid, name and pos of the lines of tab-separated files without header, packed or not; pos numbers the lines of all files, in the order of the files' paths."""
    rows = spark.read.option("sep", "\t").option("quote", "").schema("cid string, name string").csv(path)
    placed = rows.select("cid", "name", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line")).where("name IS NOT NULL")
    return numbered(placed, [F.col("_file"), F.col("_block"), F.col("_line")], "pos").select("cid", "name", "pos")


def write_index(index: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """An index as Parquet, in a folder for each bucket and sorted by key within, so a lookup reads few row groups."""
    bucketed = index.withColumn("bucket", _bucket(F.col("key"), buckets))
    bucketed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "key").write.partitionBy("bucket").parquet(path)


def looked_up(names: DataFrame, index: DataFrame, name: str, buckets: int = BUCKETS) -> DataFrame:
    """names with cid from an index on disk; null for a name that it lacks. Distinct names are looked up once, in their buckets."""
    asked = names.select(F.col(name).alias("asked"), _key(F.col(name)).alias("key")).where("asked IS NOT NULL").distinct().withColumn("bucket", _bucket(F.col("key"), buckets))
    found = asked.join(index, ["bucket", "key"]).select("asked", "cid")
    return names.join(found, names[name] == found["asked"], "left").drop("asked")


def write_sorted_index(index: DataFrame, path: str, files: int | None = None) -> None:
    """An index as files of ranges of keys, sorted, with Bloom filters of their keys, and a table of fences: each file's first and last key.

    ``files`` ranges at most; without it as many as the shuffle has partitions.
    """
    ranged = index.repartitionByRange(files, "key") if files else index.repartitionByRange("key")
    ranged.sortWithinPartitions("key").write.option("parquet.bloom.filter.enabled#key", "true").parquet(f"{path}/data")
    written = index.sparkSession.read.schema(index.schema).parquet(f"{path}/data")
    fences = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min("key").alias("first"), F.max("key").alias("last"))
    fences.coalesce(1).write.parquet(f"{path}/fences")


def touched_files(asked: DataFrame, path: str) -> list[str]:
    """The files of a sorted index that can hold a key of asked (key)."""
    fences = asked.sparkSession.read.schema("file string, first string, last string").parquet(f"{path}/fences")
    # Fences are one row a file. The ranges of files don't overlap, so of the fences only the last that begins at or before a key can hold it.
    told = sorted((r["first"].encode(), r["last"].encode(), r["file"]) for r in fences.collect())
    firsts, lasts = [t[0] for t in told], [t[1] for t in told]

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        at = [bisect.bisect_right(firsts, k.encode()) - 1 for k in keys]
        return pd.Series([i if i >= 0 and k.encode() <= lasts[i] else -1 for i, k in zip(at, keys)], dtype="int32")

    hit = asked.where("key IS NOT NULL").select(place("key").alias("i")).where("i >= 0").distinct().collect()
    return [told[r["i"]][2] for r in sorted(hit)]


def sorted_lookup(names: DataFrame, path: str, name: str) -> DataFrame:
    """names with cid from a sorted index; null for a name that it lacks. Only the files that can hold a name are opened."""
    asked = names.select(F.col(name).alias("asked"), _key(F.col(name)).alias("key")).where("asked IS NOT NULL").distinct()
    files = touched_files(asked.select("key").distinct(), path)
    if not files:
        return names.withColumn("cid", F.lit(None).cast("string"))
    index = names.sparkSession.read.schema("key string, cid string").parquet(*files)
    keys = [r["key"] for r in asked.select("key").distinct().limit(PUSHED_KEYS + 1).collect()]
    if len(keys) <= PUSHED_KEYS:
        index = index.where(F.col("key").isin(keys))
    found = asked.join(index, "key").select("asked", "cid")
    return names.join(found, names[name] == found["asked"], "left").drop("asked")


def coalesced_sources(names: DataFrame, sources: dict[str, DataFrame], fields: list[str]) -> DataFrame:
    """name, fields and sources (who knows it, in turn) of each distinct name that a source knows, ignoring case; each field is the first source's that has it.

    The sources' rows (name, fields; absent ones are null) are tagged and
    aggregated once, so there is no chain of joins.
    """
    column = lambda df, c: (F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c)
    types = {c: next(f.dataType for df in sources.values() for f in df.schema if f.name == c) for c in fields}
    tagged = [df.select(F.lit(i).alias("turn"), F.lit(s).alias("origin"), _key(F.col("name")).alias("key"), *[column(df, c).cast(types[c]).alias(c) for c in fields]) for i, (s, df) in enumerate(sources.items())]
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("turn"))).alias(c)
    known = reduce(DataFrame.unionByName, tagged).groupBy("key").agg(*map(first, fields), F.array_sort(F.collect_set(F.struct("turn", "origin"))).alias("s"))
    asked = names.select("name").where("name IS NOT NULL").distinct().withColumn("key", _key(F.col("name")))
    return asked.join(known, "key").select("name", *fields, F.transform("s", lambda x: x["origin"]).alias("sources"))
