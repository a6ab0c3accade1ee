"""Media pages of a culture collection in HTML: tables of ingredients, media told by reference to another, and pages without data."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import scratch_path
from . import layouts, recipes

# Fixed values.

NO_DATA = r"Nothing found|No data"
PAGE_ID = r"Search for medium no\. = \[(\d+)\]"
NAME = r"(?is)<font[^>]*\bsize\s*=\s*[\"']?3\b[^>]*>(.*?)</font>"
BASE = r"(?is)<a\b[^>]*href\s*=\s*[\"']?[^\"'>]*jcm_grmd\?GRMD=(\d+)"
CHANGE = r"(?is)Use Medium No\.(.*?)</(?:p|div|td)>"
RECIPE = r"(?is)<i\b[^>]*>([^<]*solution:[^<]*)</i>([^<]*)"
BORDERED = r"(?is)<table\b[^>]*\bborder\b[^>]*>.*?</table>"
AFTER_TABLES = r"(?is)^.*</table>(.*?)(?:<hr\b.*)?$"
#: Changes to a medium: groups are amount, unit and compound; the last tells what is left out.
WITH = [
    r"(?i)with\s+([\d\.]+)\s*(g|mg|mM|ml)/L\s+([^,\.\(]+?)(?:\s*\([^)]*\))?\s*(?:final|$|\.|,)",
    r"(?i)supplemented\s+with\s+([\d\.]+)\s*(g|mg|mM|ml)/L\s+([^,\.\(]+?)(?:\s*\([^)]*\))?\s*\(final\)",
    r"(?i)([\d\.]+)\s*(g|mg|mM|ml)/L\s+([A-Z][^,\.\(]+?)(?:\s*\([^)]*\))?(?:\s|$|\.|,)",
]
WITHOUT = r"(?i)without\s+([^,\.]+?)(?:\s+and\s+([^,\.]+?))?(?:\s|$|\.|,)"
COMPONENT = [r"(?i)(\d+(?:\.\d+)?)\s*(mg|g)\s+([^,\.\n]+?)(?:\s+(?:first\s+)?in\s+\d+\s*ml)", r"(?i)(\d+(?:\.\d+)?)\s*(mg|g)\s+([^,\.\n]+?)(?:\s|$|\.|,)"]


@F.pandas_udf(T.StringType())
def unescaped(text: pd.Series) -> pd.Series:
    """Text with HTML entities resolved."""
    return text.map(lambda x: html.unescape(x) if isinstance(x, str) else x)


def plain(markup: Column) -> Column:
    """Text of markup: without tags, entities resolved, white space as single blanks."""
    return F.trim(F.regexp_replace(unescaped(F.regexp_replace(markup, r"(?s)<[^>]*>", "")), r"[\s ]+", " "))


def _phrases(text: Column, pattern: str) -> Column:
    part = lambda g: F.regexp_extract_all(text, F.lit(pattern), g)
    return F.arrays_zip(part(1).alias("a"), part(2).alias("u"), part(3).alias("n"))


def changes(text: Column) -> Column:
    """What is added to or left out of a medium: name, concentration, unit, action; a phrase that several patterns fit counts for each, as published."""
    clean = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    row = lambda n, a, u, action: F.struct(n.alias("name"), a.alias("concentration"), u.alias("unit"), F.lit(action).alias("action"))
    added = F.transform(F.concat(*[_phrases(text, p) for p in WITH]), lambda r: row(clean(r["n"]), r["a"].try_cast("double"), F.concat(r["u"], F.lit("/L")), "add"))
    gone = F.flatten(F.transform(F.arrays_zip(F.regexp_extract_all(text, F.lit(WITHOUT), 1).alias("x"), F.regexp_extract_all(text, F.lit(WITHOUT), 2).alias("y")), lambda r: F.array(r["x"], r["y"])))
    removed = F.transform(F.filter(gone, lambda x: x != ""), lambda x: row(F.trim(x), F.lit(0.0), F.lit("removed"), "remove"))
    return F.filter(F.concat(added, removed), lambda r: layouts.likely_chemical(r["name"]))


def components(text: Column) -> Column:
    """Components of a solution's recipe; one that both patterns fit counts for each, as published."""
    rows = F.transform(F.concat(*[_phrases(text, p) for p in COMPONENT]), lambda r: F.struct(F.trim(r["n"]).alias("name"), r["a"].cast("double").alias("concentration"), r["u"].alias("unit"), F.lit("recipe").alias("action")))
    return F.filter(rows, lambda r: layouts.likely_chemical(r["name"]))


def media(pages: DataFrame, path: str = "path", content: str = "html") -> DataFrame:
    """One row for each page: path, medium_id, medium_name, composition_type (no_data, tables, reference or unknown), base_medium, preparation, and the page's own parts.

    A page without data is named by its file; one without an id is unknown.
    """
    page = F.coalesce(F.col(content), F.lit(""))
    part = lambda p, g=1: F.nullif(F.regexp_extract(page, p, g), F.lit(""))
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1), "^jcm_", "")
    number, base = part(PAGE_ID), part(BASE)
    kind = F.when(page.rlike(NO_DATA), "no_data").when(number.isNull(), "unknown").when(page.rlike(BORDERED), "tables").when(base.isNotNull(), "reference").otherwise("unknown")
    recipe = F.transform(F.arrays_zip(F.regexp_extract_all(page, F.lit(RECIPE), 1).alias("name"), F.regexp_extract_all(page, F.lit(RECIPE), 2).alias("text")), lambda r: F.struct(F.trim(F.replace(r["name"], F.lit(":"), F.lit(""))).alias("name"), r["text"].alias("text")))
    told = F.regexp_replace(F.trim(plain(F.coalesce(part(CHANGE), F.lit("")))), r"^\d+\s*", "")
    rows = pages.select(
        path,
        F.when(kind == "no_data", F.concat(F.lit("jcm_"), stem)).otherwise(F.concat(F.lit("jcm_"), number)).alias("medium_id"),
        kind.alias("composition_type"),
        F.when(kind == "reference", F.concat(F.lit("jcm_"), base)).alias("base_medium"),
        F.regexp_replace(plain(F.coalesce(part(NAME), F.lit(""))), r"^\d+\s+", "").alias("name"),
        F.when(kind == "reference", F.trim(F.concat_ws(" ", F.nullif(told, F.lit("")), F.array_join(F.transform(recipe, lambda r: F.trim(r["text"])), " ")))).when(kind == "tables", plain(part(AFTER_TABLES))).otherwise("").alias("preparation"),
        recipe.alias("recipes"),
        F.array_join(F.regexp_extract_all(page, F.lit(BORDERED), 0), "").alias("tables"),
    )
    name = F.when(F.col("composition_type") == "no_data", F.concat(F.lit("JCM "), F.regexp_replace("medium_id", "^jcm_", ""), F.lit(" (No Data)"))).otherwise(F.coalesce(F.nullif("name", F.lit("")), F.lit("Unknown JCM Medium")))
    return rows.withColumn("medium_name", name).drop("name")


def ingredient_rows(found: DataFrame) -> DataFrame:
    """medium_id, name, concentration, unit, action of the rows of media(): of tables, or the base medium with its changes and solutions."""
    schema = "medium_id", "name", "concentration", "unit", "action"
    tables = recipes.table_ingredients(found.where("composition_type = 'tables'"), "medium_id", "tables").withColumn("action", F.lit("table")).select(*schema)
    base = F.array(F.struct(F.concat(F.lit("Base Medium "), F.regexp_replace("base_medium", "^jcm_", "")).alias("name"), F.lit(1.0).alias("concentration"), F.lit("reference").alias("unit"), F.lit("base").alias("action")))
    parts = F.concat(base, changes(F.col("preparation")), F.flatten(F.transform("recipes", lambda r: components(r["text"]))))
    by_reference = found.where("composition_type = 'reference'").select("medium_id", F.explode(parts).alias("r")).select("medium_id", "r.*")
    return tables.unionByName(by_reference)


def base_media(rows: DataFrame) -> DataFrame:
    """medium, base, steps: all media that the rows of a medium rest on, with the least number of references between them.

    Found by pointer jumping: a round joins the pairs with themselves and
    doubles the steps that are known, so rounds grow with the logarithm of the
    longest chain. A medium that comes to itself is in a cycle, which ends as
    any chain does. Null ids refer to nothing.
    """
    spark = rows.sparkSession

    def kept(pairs: DataFrame) -> DataFrame:
        path = scratch_path(spark, "bases")
        pairs.groupBy("medium", "base").agg(F.min("steps").alias("steps")).write.parquet(path)
        return spark.read.parquet(path)

    known = kept(rows.where("action = 'base' AND medium_id IS NOT NULL").select(F.col("medium_id").alias("medium"), F.concat(F.lit("jcm_"), F.regexp_extract("name", r"(\d+)$", 1)).alias("base"), F.lit(1).alias("steps")))
    size = lambda pairs: tuple(pairs.agg(F.count(F.lit(1)), F.sum("steps")).first())
    now, before = size(known), None
    while now != before:
        further = known.select(F.col("medium").alias("base"), F.col("base").alias("far"), F.col("steps").alias("more"))
        known = kept(known.unionByName(known.join(further, "base").select("medium", F.col("far").alias("base"), (F.col("steps") + F.col("more")).alias("steps"))))
        now, before = size(known), now
    return known


def unresolved(rows: DataFrame, bases: DataFrame | None = None) -> DataFrame:
    """medium_id and reason of media whose base is missing, or that rest on themselves (cycle)."""
    bases = base_media(rows) if bases is None else bases
    cycles = bases.where("medium = base").select(F.col("medium").alias("medium_id"), F.lit("cycle").alias("reason"))
    there = rows.select(F.col("medium_id").alias("base")).distinct()
    missing = bases.where("steps = 1").join(there, "base", "left_anti").select(F.col("medium").alias("medium_id"), F.lit("missing").alias("reason"))
    return cycles.unionByName(missing).distinct()


def resolved(rows: DataFrame, bases: DataFrame | None = None) -> DataFrame:
    """rows of ingredient_rows() with those of all base media, however far, in the place of the references.

    A row of a base is left out if a medium nearer than that base, on the way
    from it, leaves out its name; what a nearer one adds again stays. A medium
    takes nothing from itself, so cycles add each row once.
    """
    bases = (base_media(rows) if bases is None else bases).where("medium <> base")
    own = rows.where("action NOT IN ('base', 'remove')").select("medium_id", "name", "concentration", "unit", "action")
    near = bases.unionByName(rows.select(F.col("medium_id").alias("medium"), F.col("medium_id").alias("base"), F.lit(0).alias("steps")).distinct())
    gone = rows.where("action = 'remove'").select(F.col("medium_id").alias("base"), F.lower("name").alias("low")).distinct()
    removed = near.join(gone, "base").groupBy("medium", "low").agg(F.min("steps").alias("removed_at"))
    inherited = bases.join(own.withColumnRenamed("medium_id", "base"), "base").withColumn("low", F.lower("name")).join(removed, ["medium", "low"], "left")
    kept = inherited.where(F.coalesce(F.col("removed_at") >= F.col("steps"), F.lit(True)))
    return own.unionByName(kept.select(F.col("medium").alias("medium_id"), "name", "concentration", "unit", F.lit("inherited").alias("action")))
