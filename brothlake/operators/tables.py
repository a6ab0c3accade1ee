"""Merges, splits, expansions and upserts of mapping tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import chemistry, predicates
from ..functions.chains import present
from ..sources.scratch import scratch_path
from .matching import first_rows

MATCH_COLUMNS = ["normalized_compound", "hydration_number", "chebi_match", "chebi_id", "chebi_original_name", "similarity_score", "match_confidence", "matching_method"]

#: How a Column that tells a direction ends.
SORT_ORDER = re.compile(r" (?:ASC|DESC) NULLS (?:FIRST|LAST)'>$")


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """df; a ValueError names the columns that it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def merged(compositions: DataFrame, matches: DataFrame, key: str = "original", carried: list[str] | None = None) -> DataFrame:
    """compositions with the columns of their match, and a row of medium_id 'multiple' for each match that no composition has.

    matches: original_compound, pos and the carried columns, chebi_id among
    them; of repeated names the last position counts. An empty mapped is
    filled from the match.
    """
    carried = carried or [c for c in MATCH_COLUMNS if c in matches.columns]
    last = first_rows(matches, ["original_compound"], F.desc("pos")).select("original_compound", *carried)
    joined = compositions.join(last, compositions[key] == last["original_compound"], "left").drop("original_compound")
    joined = joined.withColumn("mapped", F.coalesce(present(F.col("mapped")), F.col("chebi_id")))
    new = last.join(compositions.select(F.col(key).alias("original_compound")).distinct(), "original_compound", "left_anti")
    new = new.withColumnRenamed("original_compound", key).withColumn("medium_id", F.lit("multiple")).withColumn("mapped", F.col("chebi_id")).withColumn("source", F.lit("chebi_match"))
    return joined.unionByName(new, allowMissingColumns=True)


def with_status(df: DataFrame) -> DataFrame:
    """mapping_status and mapping_quality from mapped, chebi_id and match_confidence."""
    mapped, found = present(F.col("mapped")), present(F.col("chebi_id"))
    status = (
        F.when(mapped.isNotNull() & found.isNotNull(), F.when(mapped == found, "original_and_chebi_match").otherwise("original_plus_chebi_alternative"))
        .when(mapped.isNotNull(), "original_only")
        .when(found.isNotNull(), "chebi_only")
        .otherwise("unmapped")
    )
    s, c = F.col("mapping_status"), F.col("match_confidence")
    quality = (
        F.when(s == "original_and_chebi_match", "excellent")
        .when(s == "original_plus_chebi_alternative", "very_good")
        .when(s == "original_only", "good")
        .when(s == "chebi_only", F.when(c.isin("very_high", "high"), "good").when(c == "medium", "fair").otherwise("poor"))
        .otherwise("none")
    )
    return df.withColumn("mapping_status", status).withColumn("mapping_quality", quality)


def split_confident(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The confident rows, and all others."""
    flag = predicates.is_confident(F.col("match_confidence"), F.col("mapping_status"))
    return df.where(flag), df.where(~flag)


def best_per_name(df: DataFrame, name: str, *ranks: Column) -> DataFrame:
    return first_rows(df, [name], *ranks)


def ranked(c: Column, order: list[str]) -> Column:
    """Place of a label in an order; unknown labels and nulls come last."""
    return F.coalesce(*[F.when(c == label, F.lit(i)) for i, label in enumerate(order)], F.lit(len(order)))


def without_duplicates(df: DataFrame, group: list[str], exact: list[str], score: Column, pos: str) -> DataFrame:
    """One row for each ``exact`` key, then for each ``group`` key that of the highest score; nulls are a group, ties go to the first position."""
    return first_rows(first_rows(df, exact, F.asc(pos)), group, F.desc_nulls_last(score), F.asc(pos))


def expanded_solutions(rows: DataFrame, solutions: DataFrame, keep_unresolved: bool = True) -> DataFrame:
    """Rows mapped to a stock solution as a row for each of its components; all others as they are.

    rows: medium_id, original, mapped, value, unit. solutions: solution_id,
    composition (array of name, concentration, unit). Amounts are scaled by the
    dose. expansion_status is direct, expanded or unresolved; without
    ``keep_unresolved`` solutions of unknown composition are dropped.
    """
    is_solution = F.coalesce(F.col("mapped").startswith("solution:"), F.lit(False))
    direct = rows.where(~is_solution).withColumn("expansion_status", F.lit("direct"))
    doses = rows.where(is_solution).withColumn("solution_id", F.split_part("mapped", F.lit(":"), F.lit(2)))
    joined = doses.join(solutions.select("solution_id", "composition"), "solution_id", "left")
    known = F.coalesce(F.size("composition") > 0, F.lit(False))
    parts = joined.where(known).withColumn("c", F.explode("composition"))
    parts = parts.withColumn("value", chemistry.scaled_concentration(F.col("value"), F.col("unit"), F.col("c.concentration"))).withColumn("original", F.col("c.name")).withColumn("unit", F.col("c.unit")).withColumn("mapped", F.lit(None).cast("string")).withColumn("expansion_status", F.lit("expanded"))
    out = direct.unionByName(parts.select(*direct.columns))
    return out.unionByName(joined.where(~known).withColumn("expansion_status", F.lit("unresolved")).select(*direct.columns)) if keep_unresolved else out


def upserted(existing: DataFrame, new: DataFrame, name: str, pos: str | None = None) -> DataFrame:
    """existing and those rows of new whose lower-cased name it lacks, one row a name, in order of name.

    Of rows of one name those of existing come first, then the first by
    ``pos``, a column that is not part of the result; of those, or without it,
    the smallest by the text of its columns.
    """
    fresh = new.join(existing.select(F.lower(name).alias("_key")).distinct(), F.lower(new[name]) == F.col("_key"), "left_anti")
    both = existing.withColumn("_old", F.lit(0)).unionByName(fresh.withColumn("_old", F.lit(1)))
    order = [F.asc("_old"), *([F.asc(pos)] if pos else []), F.to_json(F.struct(*[c for c in existing.columns if c != pos])).asc()]
    return first_rows(both, [name], *order).drop("_old", *([pos] if pos else [])).orderBy(name)


def patched(df: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """df with the non-null values of updates in the rows of the same key."""
    changed = [c for c in updates.columns if c != key]
    new = updates.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in changed])
    return df.join(new, df[key] == F.col("_key"), "left").select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in changed else F.col(c) for c in df.columns])


def compared(new: DataFrame, old: DataFrame, name: str, weight: str, tolerance: float = 0.05) -> DataFrame:
    """Lower-cased name and change: new, gone, conflict (weights apart by more than the tolerance) or same."""
    a = new.select(F.lower(name).alias("name"), F.col(weight).alias("new_weight"), F.lit(1).alias("in_new"))
    b = old.select(F.lower(name).alias("name"), F.col(weight).alias("old_weight"), F.lit(1).alias("in_old"))
    apart = F.abs(F.col("new_weight") - F.col("old_weight")) > tolerance * F.col("old_weight")
    change = F.when(F.col("in_old").isNull(), "new").when(F.col("in_new").isNull(), "gone").when(apart, "conflict").otherwise("same")
    return a.join(b, "name", "full").select("name", "new_weight", "old_weight", change.alias("change"))


def numeric_first(c: Column) -> list[Column]:
    """Sort keys: whole numbers by value before all else by text."""
    number = c.try_cast("long")
    return [number.isNull(), number, c]


def numbered(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """df with the place (from 1) of each row in an order, as row_number() gives it, but over all partitions.

    The rows are range-partitioned, sorted and written; a row's place is its
    place in its partition after the rows of the partitions before it, whose
    numbers, one for each partition, go through the driver. Rows that the
    order doesn't tell apart get any of their places; an empty table gives
    none.
    """
    path = scratch_path(df.sparkSession, "numbered")
    # What is no sort order but an expression becomes a column, for a sort works its expressions out at each comparison.
    keys = {f"_key{i}": c for i, c in enumerate(order) if not SORT_ORDER.search(str(c))}
    places = [f"_key{i}" if f"_key{i}" in keys else c for i, c in enumerate(order)]
    df.withColumns(keys).repartitionByRange(*places).sortWithinPartitions(*places).drop(*keys).withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_id", 33))
    sizes = sorted(rows.groupBy("_part").count().collect())
    before, starts = 0, []
    for part, n in sizes:
        starts.append((part, before))
        before += n
    offsets = F.broadcast(df.sparkSession.createDataFrame(starts, "_part long, _before long"))
    return rows.join(offsets, "_part").withColumn(name, F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_id", "_part", "_before")
