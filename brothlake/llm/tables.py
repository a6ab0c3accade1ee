"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Keys of one or two longs that are broadcast at most; more meet their rows in a shuffle.
FEW_KEYS = 2_000_000


def few(keys: DataFrame) -> DataFrame:
    """keys, a written table of one or two longs a row, to be broadcast if there are at most FEW_KEYS."""
    return F.broadcast(keys) if keys.count() <= FEW_KEYS else keys


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; where it is unset in local mode (tests), a new temporary folder is set as the checkpoint folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="brothlake-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table of the shared folder: computed once, and readable after an executor is lost."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with so many underscores before it that df has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
