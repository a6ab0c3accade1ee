"""Sinks of the library's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .readers import MAPPING

FIRST_COLUMNS = [f.name for f in MAPPING.fields]


def ordered_columns(df: DataFrame, first: list[str] = FIRST_COLUMNS) -> DataFrame:
    """df with the named columns first, those that it lacks as nulls, then its others."""
    present = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in first]
    return df.select(*present, *[c for c in df.columns if c not in first])


def tsv(df: DataFrame, path: str, order: list | None = None) -> None:
    """A folder of TSV files with header; with ``order`` sorted over all of them."""
    (df.orderBy(*order) if order else df).write.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def documents(df: DataFrame, path: str, key: str) -> None:
    """JSON lines in a folder for each value of a column."""
    df.write.partitionBy(key).json(path)


def failures(results: DataFrame, kind: str, path: str, failed) -> DataFrame:
    """kind and the sorted paths that failed, for a dead-letter table."""
    return results.where(failed).groupBy(kind).agg(F.sort_array(F.collect_set(path)).alias("paths"), F.count(F.lit(1)).alias("n"))


def named_files(df: DataFrame, folder: str) -> None:
    """A folder for each file_name with its content as text, so that other programs find it by path; for few files."""
    df.select("file_name", "content").repartition("file_name").write.partitionBy("file_name").text(folder)


def packed_files(df: DataFrame, folder: str) -> None:
    """Files by name, many in one Parquet file and sorted by name within it, so that there are as many files as tasks and not as documents."""
    df.select("file_name", "content").sortWithinPartitions("file_name").write.parquet(folder)
