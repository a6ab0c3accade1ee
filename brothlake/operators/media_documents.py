"""A medium's chemistry as one nested document, from a composition document and to a flat row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chains import bound
from ..sources.readers import packed_texts
from ..sources.scratch import scratch_path
from . import properties as P

# Fixed values.

METHOD = "Henderson-Hasselbalch with Davies activity coefficients and pattern-based estimation"
NOT_JSON, NOT_A_LIST = "Invalid JSON format", "Composition must be a list of components"

LIST = "array<struct<compound:string,g_l:double,value:double>>"
DOCUMENT = (
    "error string, ph struct<value:double,uncertainty:double,range:array<double>,confidence:string>, salinity struct<percent_nacl:double,uncertainty:double,range:array<double>,confidence:string>, "
    "ionic_strength struct<value:double,unit:string>, total_dissolved_solids struct<value:double,unit:string>, "
    "analysis_quality struct<compounds_recognized:string,compounds_estimated:string,compounds_unaccounted:string,total_coverage_rate:double,recognition_rate:double,estimation_rate:double,calculation_method:string>, "
    "compound_details struct<recognized_compounds:array<string>,estimated_compounds:array<string>,unaccounted_compounds:array<string>>, notes array<string>"
)


def compositions_of(documents: DataFrame) -> DataFrame:
    """medium_id, compound, g_l, pos of the components of documents (medium_id, content) that are JSON lists."""
    return _components(documents.select("medium_id", _read(F.col("content"))["components"].alias("components")))


def _read(content: Column) -> Column:
    """What is wrong with a document and the list of its components, null where it is no JSON list; the text is made once and parsed once by each parser."""
    return bound(content, lambda text: bound(_error(text), lambda error: F.struct(error.alias("error"), F.when(error.isNull(), F.from_json(text, LIST)).alias("components"))))


def _components(lists: DataFrame) -> DataFrame:
    """A row for each component of lists (medium_id, components)."""
    rows = lists.select("medium_id", F.posexplode("components").alias("pos", "c"))
    amount = F.coalesce(F.nullif("c.g_l", F.lit(0.0)), F.nullif("c.value", F.lit(0.0)), F.lit(0.0))
    return rows.select("medium_id", F.coalesce("c.compound", F.lit("")).alias("compound"), amount.alias("g_l"), "pos")


def _error(content: Column) -> Column:
    """What is wrong with a composition document; null if nothing is. What follows its first JSON value doesn't count."""
    return F.when(F.try_parse_json(content).isNull(), NOT_JSON).when(~F.startswith(F.trim(content), F.lit("[")), NOT_A_LIST)


def analysed(documents: DataFrame, property_rows: DataFrame) -> DataFrame:
    """medium_id and the nested document of each document (medium_id, content); for content that is no list of components one with an error and labels none. What is read of the documents is written to the session's scratch folder."""
    # Documents are read once; their components are used for the distinct compounds and for the figures.
    path = scratch_path(documents.sparkSession, "components")
    documents.select("medium_id", _read(F.col("content")).alias("d")).select("medium_id", "d.*").write.parquet(path)
    read = documents.sparkSession.read.parquet(path)
    parts = P.ingredients(_components(read), property_rows, ["pos"])
    named = lambda a: F.transform(F.sort_array(F.collect_list(F.when(F.col("account") == a, F.struct("pos", "compound")))), lambda x: x["compound"])
    figures = P.figures_of(parts, {f"{a}_compounds": named(a) for a in ("recognized", "estimated", "unaccounted")})
    around = lambda v, u, digits, low=None: F.array(F.round(v - u if low is None else F.greatest(F.lit(low), v - u), digits), F.round(v + u, digits))
    of_all = lambda n: F.concat(n.cast("string"), F.lit("/"), F.col("n").cast("string"))
    known = F.col("recognized") + F.col("estimated")
    whole = P.notes(figures.withColumns({"compounds_estimated": P._percent(F.col("estimated")), "total_coverage": P._percent(known), "ionic_strength": F.round("strength", 6)}))
    found = whole.select(
        "medium_id",
        F.struct(F.round("ph", 2).alias("value"), F.round("ph_uncertainty", 2).alias("uncertainty"), around(F.col("ph"), F.col("ph_uncertainty"), 2).alias("range"), P._confidence("ph_uncertainty", 0.3, 0.7).alias("confidence")).alias("ph"),
        F.struct(F.round("salinity", 4).alias("percent_nacl"), F.round("salinity_uncertainty", 4).alias("uncertainty"), around(F.col("salinity"), F.col("salinity_uncertainty"), 4, 0.0).alias("range"), P._confidence("salinity_uncertainty", 0.02, 0.05).alias("confidence")).alias("salinity"),
        F.struct(F.col("ionic_strength").alias("value"), F.lit("M").alias("unit")).alias("ionic_strength"),
        F.struct(F.round("tds", 2).alias("value"), F.lit("g/L").alias("unit")).alias("total_dissolved_solids"),
        F.struct(
            of_all(F.col("recognized")).alias("compounds_recognized"), of_all(F.col("estimated")).alias("compounds_estimated"), of_all(F.col("n") - known).alias("compounds_unaccounted"),
            F.col("total_coverage").alias("total_coverage_rate"), P._percent(F.col("recognized")).alias("recognition_rate"), F.col("compounds_estimated").alias("estimation_rate"), F.lit(METHOD).alias("calculation_method"),
        ).alias("analysis_quality"),
        F.struct("recognized_compounds", "estimated_compounds", "unaccounted_compounds").alias("compound_details"),
        "notes",
    )
    # The narrow side is hashed: else both are sorted, and the documents' rows are wide.
    joined = read.select("medium_id", "error").hint("shuffle_hash").join(found, "medium_id", "left")
    none = lambda field: F.from_json(F.lit('{"confidence": "none"}'), f"{field} double, uncertainty double, range array<double>, confidence string")
    return joined.withColumn("ph", F.when(F.col("error").isNotNull(), none("value")).otherwise(F.col("ph"))).withColumn("salinity", F.when(F.col("error").isNotNull(), none("percent_nacl")).otherwise(F.col("salinity")))


def as_json(analysed_rows: DataFrame) -> DataFrame:
    """medium_id and the document as JSON text; absent parts are left out."""
    return analysed_rows.select("medium_id", F.to_json(F.struct(*[c for c in analysed_rows.columns if c != "medium_id"])).alias("content"))


def read_documents(spark: SparkSession, folder: str, packed: bool = False) -> DataFrame:
    """Nested documents of the files of a folder and those below (``packed``: of packed ones), keyed by the id in medium_<id>_composition_properties.json, the name of a file or of its folder."""
    if packed:
        rows = packed_texts(spark, folder).select(F.col("file_name").alias("path"), F.col("text").alias("value"))
    else:
        rows = spark.read.option("recursiveFileLookup", True).text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    medium = F.regexp_extract("path", r"medium_([^_/]+)_composition_properties\.json", 1)
    return rows.select(medium.alias("medium_id"), F.from_json("value", DOCUMENT).alias("d")).where("medium_id <> ''").select("medium_id", "d.*")


def flattened(documents: DataFrame) -> DataFrame:
    """One flat row for each nested document: ranges as two columns, lists as their length and a text with semicolons."""
    detail = lambda a: F.coalesce(F.col(f"compound_details.{a}_compounds"), F.array().cast("array<string>"))
    told = F.coalesce("notes", F.array().cast("array<string>"))
    return documents.select(
        "medium_id",
        F.col("ph.value").alias("ph_value"), F.col("ph.uncertainty").alias("ph_uncertainty"), F.get("ph.range", 0).alias("ph_range_min"), F.get("ph.range", 1).alias("ph_range_max"), F.col("ph.confidence").alias("ph_confidence"),
        F.col("salinity.percent_nacl").alias("salinity_percent_nacl"), F.col("salinity.uncertainty").alias("salinity_uncertainty"), F.get("salinity.range", 0).alias("salinity_range_min"), F.get("salinity.range", 1).alias("salinity_range_max"), F.col("salinity.confidence").alias("salinity_confidence"),
        F.col("ionic_strength.value").alias("ionic_strength_value"), F.col("ionic_strength.unit").alias("ionic_strength_unit"),
        F.col("total_dissolved_solids.value").alias("total_dissolved_solids_value"), F.col("total_dissolved_solids.unit").alias("total_dissolved_solids_unit"),
        "analysis_quality.*",
        *[F.size(detail(a)).alias(f"{a}_compounds_count") for a in ("recognized", "estimated", "unaccounted")],
        *[F.array_join(detail(a), "; ").alias(f"{a}_compounds_list") for a in ("recognized", "estimated", "unaccounted")],
        F.size(told).alias("notes_count"), F.array_join(told, "; ").alias("notes_content"),
    )
