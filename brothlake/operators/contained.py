"""Names found in texts, by automata over shards of the names.

The names are dealt to shards of a bounded size and the texts to blocks; each
shard meets each block once, builds one Aho-Corasick automaton and streams the
block through it. So time grows with the texts and their hits, not with the
parts of texts that could be names, and a task holds one shard and one block.
"""

from __future__ import annotations

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of names in one shard and of texts in one block, about.
SHARD_CHARS, BLOCK_CHARS = 4_000_000, 16_000_000

HIT = "text string, name string, at int"


def _dealt(df: DataFrame, column: str, chars: int) -> tuple[DataFrame, int]:
    """Distinct values of a column with a place below the number of parts of about ``chars`` characters, and that number; a very long value is a part's only one at worst."""
    distinct = df.select(F.col(column).alias("value")).where("value <> ''").distinct()
    total = distinct.agg(F.sum(F.length("value"))).first()[0] or 0
    parts = max(1, -(-int(total) // chars))
    return distinct.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(parts)).cast("int")), parts


def _found(texts: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
    rows = []
    if len(texts) and len(names):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for name in names["value"]:
            automaton.add_word(name)
        automaton.make_automaton()
        rows = [(text, text[end + 1 - n : end + 1], end + 1 - n) for text in texts["value"] for end, n in automaton.iter(text)]
    return pd.DataFrame({c: pd.Series([r[k] for r in rows], dtype=kind) for k, (c, kind) in enumerate((("text", object), ("name", object), ("at", "int32")))})


def occurrences(texts: DataFrame, names: DataFrame, text: str, name: str, shard_chars: int = SHARD_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """text, name and at (from 0) of every place at which a name occurs in a distinct text, overlapping ones too.

    Null and empty texts and names are left out, repeated ones count once;
    empty tables give no rows.
    """
    blocks, many_blocks = _dealt(texts, text, block_chars)
    shards, many_shards = _dealt(names, name, shard_chars)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = blocks.select("value", F.col("part").alias("block"), every(many_shards).alias("shard"))
    right = shards.select("value", F.col("part").alias("shard"), every(many_blocks).alias("block"))
    keys = ["block", "shard"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_found, HIT)


def containing_pairs(df: DataFrame, name: str, prepared: Column | None = None, least_length: int = 4) -> DataFrame:
    """name and part of all pairs of different names of one table of which one holds the other, of ``least_length`` or more, in lower case; each pair once."""
    keyed = df.select(F.col(name).alias("name"), F.lower(prepared if prepared is not None else F.col(name)).alias("key")).where("key <> ''").distinct()
    hits = occurrences(keyed, keyed.where(F.length("key") >= least_length), "key", "key").select("text", F.col("name").alias("part_key")).distinct()
    whole = hits.join(keyed.withColumnRenamed("key", "text"), "text")
    part = keyed.select(F.col("name").alias("part"), F.col("key").alias("part_key"))
    return whole.join(part, "part_key").where("name <> part").select("name", "part")
