"""The library's jobs: tables in, tables out. Paths are parameters; nothing is looked for beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hydrates, names
from ..operators import matching, properties, recipes, staged, tables
from ..sources import readers


def mapped_compositions(compositions: DataFrame, nodes: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """Ingredient rows with their id: within the medium where edges are given, else by name. nodes need a position column pos."""
    by_name = matching.exact_cascade(compositions.withColumnRenamed("compound", "original"), nodes, "original", names.kg_key).withColumnRenamed("mapped", "string_match")
    if edges is None:
        return by_name.withColumn("mapped", F.col("string_match")).withColumn("mapping_method", F.when(F.col("mapped").isNull(), "none").otherwise("string"))
    in_medium = matching.matched_in_medium(by_name.withColumn("_medium_id", F.concat(F.lit("medium:"), F.col("medium_id").cast("string"))), matching.medium_components(edges), nodes, "original", "_medium_id", names.kg_key)
    return matching.preferred(in_medium).drop("_medium_id")


def with_hydrates(mapped: DataFrame, parity: bool = False) -> DataFrame:
    """Mapping rows with the hydrate columns and corrected_mmol_l."""
    parsed = mapped.withColumn("h", hydrates.parsed(F.col("original"), parity))
    return parsed.select(*mapped.columns, "h.*").withColumn("corrected_mmol_l", hydrates.corrected_mmol(F.col("value"), F.col("hydrated_weight")))


def unified(mapped: DataFrame, dictionary: DataFrame, least: int = 70) -> DataFrame:
    """Mapping rows merged with the staged matches of those without an id, with status and quality."""
    missing = mapped.where(F.coalesce(F.trim("mapped"), F.lit("")) == "").select("original")
    found = staged.matched_in_stages(missing, dictionary, least).where("chebi_id IS NOT NULL")
    matches = found.withColumnsRenamed({"original": "original_compound", "chebi_name": "chebi_match"}).withColumn("pos", F.lit(0))
    return tables.with_status(tables.merged(mapped, matches, carried=["chebi_match", "chebi_id", "similarity_score", "match_confidence", "matching_method"]))


def media_summary(compositions: DataFrame, property_rows: DataFrame, mapped: DataFrame | None = None) -> DataFrame:
    """Chemistry of each medium, with its mapping figures where mapped rows are given; media without any have zeros."""
    summary = properties.notes(properties.media_summary(compositions, property_rows))
    if mapped is None:
        return summary
    has = F.nullif(F.col("mapped"), F.lit(""))
    stats = mapped.groupBy("medium_id").agg(F.count(F.lit(1)).alias("total_compounds"), F.count(has).alias("mapped_compounds"))
    joined = summary.join(stats, "medium_id", "left").fillna(0, ["total_compounds", "mapped_compounds"])
    return joined.withColumn("mapping_rate", F.coalesce(F.round(F.try_divide(100.0 * F.col("mapped_compounds"), F.col("total_compounds")), 1), F.lit(0.0)))


def extracted_texts(spark: SparkSession, folder: str, parity: bool = False, packed: bool = False) -> DataFrame:
    """Ingredient rows of the text files of a folder (``packed``: of packed ones), with title, references and preparation of each file; ``parity`` cuts long ones as published."""
    files = readers.packed_texts(spark, folder) if packed else readers.named_texts(spark, folder)
    rows = recipes.deduplicated(recipes.recipe_rows(files, "file_name", parity=parity), "file_name")
    heads = files.select("file_name", recipes.title(F.col("text"), F.col("file_name")).alias("medium_name"), recipes.references(F.col("text")).alias("reference_media"), recipes.preparation(F.col("text"), parity).alias("preparation_instructions"))
    return heads.join(rows, "file_name", "left")


def property_database(names_rows: DataFrame, known: DataFrame, found: DataFrame) -> DataFrame:
    """A property table: known rows first, found ones for the distinct names that they lack."""
    wanted = found.join(names_rows.select(F.lower("name").alias("_name")).distinct(), F.lower(found["compound_name"]) == F.col("_name"), "left_semi")
    return tables.upserted(known, wanted, "compound_name")


def expanded(spark: SparkSession, mapped: DataFrame, solutions_folder: str, keep_unresolved: bool = True, **options) -> DataFrame:
    """Mapping rows with stock solutions replaced by their components, read from a folder."""
    return tables.expanded_solutions(mapped, readers.solutions(spark, solutions_folder, **options), keep_unresolved)
