"""Matching in stages, each on what the stages before have left, and quality repairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import chemistry, hydrates, names
from ..functions.elements import element_mismatch
from .matching import first_rows
from .similar import dealt_names, scored_pairs

MATCH = ["original", "chebi_id", "chebi_name", "similarity_score", "match_confidence", "matching_method"]


def matched_in_stages(unaccounted: DataFrame, dictionary: DataFrame, least: int = 70, hydration_least: int = 90, fuzzy: bool = True) -> DataFrame:
    """The best match of each distinct original, by the first stage that finds one.

    unaccounted: original. dictionary: id, name. Stages: equal normalised name;
    the same waters and nearly the same base; equal base name of any hydrate;
    similar normalised name, or the name as it is where that is more similar
    and the normalised one below ``hydration_least``. Without a match the score
    is 0 and the method none. ``fuzzy`` off leaves out the stages that compare
    by similarity. The names and their keys are written to the session's
    scratch folder.
    """
    # Both sides are written with their keys, for each stage reads them; else each would read the tables anew, and joins moved beneath distinct() would make keys for every row.
    keys = lambda c: [names.kg_key(F.col(c)).alias("full_key"), names.ontology_key(F.col(c)).alias("base_key"), F.coalesce(hydrates.hydration_number(F.col(c)), F.lit(0)).alias("waters")]
    known = dealt_names(dictionary.select(F.col("id").alias("chebi_id"), F.col("name").alias("chebi_name")), keys("chebi_name"))
    asked = dealt_names(unaccounted.select("original").where("original IS NOT NULL").distinct(), keys("original"))

    # Each stage is planned once over its own rest, found by anti joins on keys, and the earliest stage of an original wins at the end: a chain of stages, each on the last one's rest, doubles its plan with every stage.
    def stage(found: DataFrame, place: int, method: str) -> DataFrame:
        return found.select("original", "chebi_id", "chebi_name", F.col("similarity_score").cast("double").alias("similarity_score"), F.lit(method).alias("matching_method"), F.lit(place).alias("place"))

    def exact(key: list[str]) -> DataFrame:
        return asked.join(known.select("chebi_id", "chebi_name", *key), key).withColumn("similarity_score", F.lit(100.0))

    def unlike(*keys: list[str]) -> DataFrame:
        return reduce(lambda d, key: d.join(known.select(*key), key, "left_anti"), keys, asked)

    def similar(left: DataFrame, score: int, shared: list[str], name: str = "base_key") -> DataFrame:
        # All names that tie at the best score stay, for the id decides between them.
        place = F.rank().over(Window.partitionBy("left_name", *shared).orderBy(F.desc("score")))
        near = scored_pairs(left, known, "base_key", name, score, shared=shared).withColumn("_n", place).where("_n = 1").drop("_n")
        right = known.select("chebi_id", "chebi_name", F.col(name).alias("right_name"), *shared)
        return asked.join(near.withColumnRenamed("left_name", "base_key"), ["base_key", *shared]).join(right, ["right_name", *shared]).withColumnRenamed("score", "similarity_score")

    found = [stage(exact(["full_key"]), 0, "exact_normalized"), stage(exact(["base_key", "waters"]), 1, "hydration_aware_exact"), stage(exact(["base_key"]), 3, "hydration_variant_exact")]
    if fuzzy:
        rest = unlike(["full_key"], ["base_key"])
        found.append(stage(similar(unlike(["full_key"], ["base_key", "waters"]), hydration_least, ["waters"]), 2, "hydration_aware_fuzzy"))
        found.append(stage(similar(rest, least, []), 5, "fuzzy_normalized").withColumn("place", F.when(F.col("similarity_score") >= hydration_least, 4).otherwise(5)))
        found.append(stage(similar(rest, least, [], "chebi_name"), 5, "fuzzy_label"))
    order = [F.asc("place"), F.desc("similarity_score"), F.desc("matching_method"), F.asc("chebi_id")]
    best = first_rows(reduce(DataFrame.unionByName, found), ["original"], *order)
    out = asked.select("original").join(best, "original", "left").withColumn("similarity_score", F.coalesce("similarity_score", F.lit(0.0)))
    confidence = F.when(F.col("matching_method").isNull(), "no_match").otherwise(chemistry.score_label(F.col("similarity_score")))
    return out.withColumn("match_confidence", confidence).withColumn("matching_method", F.coalesce("matching_method", F.lit("none"))).select(*MATCH)


def backfilled_weights(df: DataFrame, formula: str = "base_formula", weight: str = "base_weight", default: float = hydrates.UNKNOWN_WEIGHT) -> DataFrame:
    """df with the weights that are missing or the default computed from the formula, rounded to two decimals."""
    unknown = F.coalesce(F.col(weight).cast("double") == default, F.lit(True))
    return df.withColumn(weight, F.when(unknown, F.round(chemistry.formula_weight(F.col(formula), default=default), 2)).otherwise(F.col(weight)))


def aligned_ids(df: DataFrame, mapped: str, base: str, agreed: dict[str, str], key: Column) -> DataFrame:
    """df with both id columns set to the agreed id of a row's key where they differ."""
    target = hydrates.looked_up(agreed, key)
    differ = F.coalesce(F.col(mapped) != F.col(base), F.lit(False)) & target.isNotNull()
    return df.withColumns({c: F.when(differ, target).otherwise(F.col(c)) for c in (mapped, base)})


def element_mismatches(df: DataFrame, original: str, label: str, formula: str) -> DataFrame:
    """Rows whose match has other elements than their name tells, with missing and extra ones."""
    return df.withColumn("m", element_mismatch(F.col(original), F.col(label), F.col(formula))).select(*df.columns, "m.missing", "m.extra").where("size(missing) > 0 OR size(extra) > 0")


def code_usage(df: DataFrame, name: str, code: str, examples: int = 3) -> DataFrame:
    """For each code its rows, distinct names and the first few of them by name."""
    per = df.where(F.col(code).isNotNull()).groupBy(code, name).agg(F.count(F.lit(1)).alias("n"))
    top = per.withColumn("k", F.row_number().over(Window.partitionBy(code).orderBy(name)))
    return top.groupBy(code).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("names"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("k") <= examples, F.col(name)))), "; ").alias("examples"))
