"""Reports on coverage, agreement and quality of mappings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.chains import present
from ..functions.predicates import entity_class, sure


def mapping_rates(df: DataFrame, group: list[str], original: str = "original", mapped: str = "mapped") -> DataFrame:
    """Rows, mapped rows, rate in percent, distinct originals and targets of each group (or of all, without one)."""
    has = present(F.col(mapped)).isNotNull()
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(has).alias("mapped_rows"),
        F.round(100.0 * F.count_if(has) / F.count(F.lit(1)), 1).alias("rate"),
        F.countDistinct(original).alias("originals"),
        F.countDistinct(F.when(has, F.col(mapped))).alias("targets"),
    )


def top_counts(df: DataFrame, value: Column, k: int, name: str = "value") -> DataFrame:
    """The k commonest values, ties by value."""
    return df.where(value.isNotNull()).groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(name)).limit(k)


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """How often two methods map a row, alone, alike or differently."""
    x, y = F.col(a).isNotNull(), F.col(b).isNotNull()
    same = sure(F.col(a) == F.col(b))
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(x).alias("by_a"), F.count_if(y).alias("by_b"), F.count_if(x & y).alias("both"), F.count_if(x & ~y).alias("only_a"), F.count_if(~x & y).alias("only_b"),
        F.count_if(same).alias("agree"), F.count_if(x & y & ~same).alias("disagree"), F.count_if(~x & ~y).alias("neither"),
    )


def class_coverage(df: DataFrame, curie: str, original: str) -> DataFrame:
    """Rows, distinct originals and percent of all rows of each class of id."""
    classed = df.groupBy(entity_class(F.col(curie)).alias("entity")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(original).alias("originals"))
    return classed.crossJoin(F.broadcast(df.agg(F.count(F.lit(1)).alias("total")))).select("entity", "n", "originals", F.round(100.0 * F.col("n") / F.col("total"), 2).alias("percent"))


def bucket_histogram(df: DataFrame, key: str, width: int = 10) -> DataFrame:
    """Groups by their number of rows, in buckets of a width."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy((F.floor(F.col("n") / width) * width).cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n_groups"))


def quality_bucket(n: Column) -> Column:
    return F.when(n >= 10, "high").when(n >= 5, "medium").when(n >= 2, "low").otherwise("very_low")


def described(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each column: mean, sample deviation, least and greatest."""
    one = lambda c: df.agg(F.lit(c).alias("metric"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("least"), F.max(c).cast("double").alias("most"))
    stats = df.agg(*[F.struct(F.lit(c).alias("metric"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("least"), F.max(c).cast("double").alias("most")).alias(c) for c in columns])
    return stats.select(F.explode(F.array(*columns)).alias("s")).select("s.*") if columns else one(columns)


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each column: nulls, blanks and distinct values."""
    stats = df.agg(*[F.struct(F.lit(c).alias("name"), F.count_if(F.col(c).isNull()).alias("nulls"), F.count_if(F.trim(F.col(c).cast("string")) == "").alias("blanks"), F.countDistinct(c).alias("distinct")).alias(c) for c in columns])
    return stats.select(F.explode(F.array(*columns)).alias("s")).select("s.*")


def pattern_frequency(df: DataFrame, text: str, flag: Column, patterns: dict[str, str]) -> DataFrame:
    """For each pattern the rows that match it, with and without the flag, in one pass."""
    hits = df.select(sure(flag).alias("flag"), F.explode(F.array_compact(F.array(*[F.when(F.col(text).rlike(p), F.lit(name)) for name, p in patterns.items()]))).alias("pattern"))
    return hits.groupBy("pattern").agg(F.count_if("flag").alias("with_flag"), F.count_if(~F.col("flag")).alias("without_flag"))


def word_jaccard(a: Column, b: Column) -> Column:
    """Similarity of the sets of lower-cased words of two texts."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"[^a-z0-9]+"), lambda w: w != ""))
    x, y = words(a), words(b)
    return F.coalesce(F.try_divide(F.size(F.array_intersect(x, y)).cast("double"), F.size(F.array_union(x, y)).cast("double")), F.lit(0.0))


def strategy_counts(rows: DataFrame, key: str, strategy: str = "extraction_method") -> DataFrame:
    """key and strategies: a map of each way in which its rows were found to their number."""
    counts = rows.groupBy(key, F.coalesce(F.col(strategy), F.lit("unknown")).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("s", "n")))).alias("strategies"))


def run_statistics(requests: DataFrame, status: str = "status") -> DataFrame:
    """One row: requests by outcome (downloaded, failed, empty; processed, unprocessed are downloaded ones) and the rates of success in percent."""
    was = lambda *s: F.count_if(F.col(status).isin(*s))
    rate = lambda *s: F.coalesce(F.round(F.try_divide(100.0 * was(*s), F.count(F.lit(1))), 1), F.lit(0.0))
    got = ("downloaded", "processed", "unprocessed")
    return requests.agg(
        F.count(F.lit(1)).alias("total"), was(*got).alias("downloads"), was("failed").alias("failed"), was("empty").alias("empty"), was("processed").alias("processed"), was("unprocessed").alias("unprocessed"),
        rate(*got).alias("download_rate"), rate("processed").alias("processing_rate"),
    )
