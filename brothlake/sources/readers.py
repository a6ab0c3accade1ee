"""Readers of recipe documents, graph tables and ontologies into typed DataFrames. Paths may be anything Spark's readers take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.chains import present
from ..functions.nested import synonyms

LIST_FORM = "array<struct<compound:string,g_l:double,mmol_l:double,optional:string,medium_id:string>>"
DICT_FORM = "struct<medium_id:string,name:string,medium_name:string,source:string,composition:array<struct<name:string,compound:string,concentration:string,g_l:string,amount:string,unit:string,optional:string>>,components:array<struct<name:string,compound:string,concentration:string,g_l:string,amount:string,unit:string,optional:string>>,preparation_instructions:string>"

MAPPING = T.StructType([T.StructField(n, T.DoubleType() if n in ("value", "mmol_l") else T.StringType()) for n in ("medium_id", "original", "mapped", "value", "concentration", "unit", "mmol_l", "optional", "source")])
NODES = "id string, category string, name string, synonym string"
EDGES = "subject string, predicate string, object string"
SOLUTIONS = "solution_id string, solution_name string, composition array<struct<name:string,concentration:double,unit:string,extraction_method:string,original_text:string>>, source string, url string"

#: Kinds of file by name.
FILE_TYPES = [(r"_composition\.json$", "composition_json"), (r"(?i)(^|/)jcm_[^/]*\.html?$", "jcm_html"), (r"(?i)(^|/)cyanosite_[^/]*\.html?$", "cyanosite_html"), (r"(?i)(^|/)ccap_[^/]*\.(pdf|md|txt)$", "ccap_text"), (r"(?i)(^|/)dsmz_[^/]*\.(pdf|md|txt)$", "dsmz_text"), (r"(?i)\.json$", "json"), (r"(?i)\.html?$", "html"), (r"(?i)\.(pdf|md|txt)$", "text")]


def file_type(path: Column) -> Column:
    return F.coalesce(*[F.when(path.rlike(p), F.lit(t)) for p, t in FILE_TYPES], F.lit("unknown"))


def tsv(spark: SparkSession, path: str, schema: T.StructType | str, missing: list[str] | None = None) -> DataFrame:
    """A TSV file with header as typed columns: text is trimmed, blanks are null, and what is no number is null in a number column.

    'NA', 'None' and the like are data, unless listed in ``missing``. Columns
    are found by name, so their order and further ones don't matter.
    """
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    raw = spark.read.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').csv(path)

    def typed(f: T.StructField) -> Column:
        if f.name not in raw.columns:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = present(F.col(f"`{f.name}`"))
        c = F.when(~c.isin(missing), c) if missing else c
        return (c if isinstance(f.dataType, T.StringType) else c.try_cast(f.dataType)).alias(f.name)

    return raw.select(*map(typed, fields))


def composition_rows(documents: DataFrame) -> DataFrame:
    """Ingredient rows of composition documents (path, content), in list or in dict form; documents of neither give none.

    medium_id, compound, g_l, unit, mmol_l, optional, pos. The medium is that of
    the document, else of the file name.
    """
    stem = F.regexp_extract("path", r"([^/]+?)(\.json)?$", 1)
    by_name = F.coalesce(F.nullif(F.regexp_extract("path", r"medium_([^_/]+)_composition\.json$", 1), F.lit("")), F.regexp_replace(stem, "_composition$", ""))
    text = F.trim("content")
    listed = documents.where(F.startswith(text, F.lit("["))).select(by_name.alias("file_id"), F.posexplode(F.from_json("content", LIST_FORM)).alias("pos", "r"))
    listed = listed.select(F.coalesce("r.medium_id", "file_id").alias("medium_id"), F.col("r.compound").alias("compound"), F.col("r.g_l").alias("g_l"), F.lit("g/L").alias("unit"), F.col("r.mmol_l").alias("mmol_l"), F.col("r.optional").alias("optional"), "pos")
    parsed = documents.where(F.startswith(text, F.lit("{"))).select(by_name.alias("file_id"), F.from_json("content", DICT_FORM).alias("d"))
    rows = parsed.select("file_id", "d.medium_id", F.posexplode(F.coalesce("d.components", "d.composition")).alias("pos", "r"))
    rows = rows.select(F.coalesce("medium_id", "file_id").alias("medium_id"), F.coalesce("r.name", "r.compound").alias("compound"), F.coalesce("r.amount", "r.concentration", "r.g_l").try_cast("double").alias("g_l"), F.coalesce("r.unit", F.lit("g/L")).alias("unit"), F.lit(None).cast("double").alias("mmol_l"), F.col("r.optional").alias("optional"), "pos")
    return listed.unionByName(rows)


def compositions(spark: SparkSession, path: str) -> DataFrame:
    """composition_rows() of the *_composition.json files of a folder."""
    files = spark.read.option("pathGlobFilter", "*_composition.json").text(path, wholetext=True)
    return composition_rows(files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")))


def graph(spark: SparkSession, nodes: str, edges: str, categories: str = "ChemicalEntity|ChemicalSubstance") -> tuple[DataFrame, DataFrame]:
    """Chemical nodes and all edges of a graph in two TSV files."""
    return tsv(spark, nodes, NODES).where(F.col("category").rlike(categories)), tsv(spark, edges, EDGES)


def ontology_names(nodes: DataFrame, normaliser) -> DataFrame:
    """key, id, name: main names before synonyms, then the smaller id."""
    main = nodes.select("id", "name", F.lit(0).alias("rank"), normaliser(F.col("name")).alias("key"))
    others = nodes.select("id", "name", F.explode(synonyms(F.col("synonym"))).alias("s")).select("id", "name", F.lit(1).alias("rank"), normaliser(F.col("s")).alias("key"))
    best = main.unionByName(others).where("key IS NOT NULL AND key <> ''").groupBy("key").agg(F.min(F.struct("rank", "id", "name")).alias("b"))
    return best.select("key", "b.id", "b.name")


def owl_classes(spark: SparkSession, path: str) -> DataFrame:
    """id, label and synonyms of the classes of an ontology in RDF/XML."""
    schema = "`_rdf:about` string, `rdfs:label` string, `oboInOwl:hasExactSynonym` array<string>, `oboInOwl:hasRelatedSynonym` array<string>"
    rows = spark.read.format("xml").option("rowTag", "owl:Class").schema(schema).load(path)
    empty = F.array().cast("array<string>")
    return rows.select(F.regexp_replace(F.regexp_extract("`_rdf:about`", r"([^/#]+)$", 1), "_", ":").alias("id"), F.col("`rdfs:label`").alias("label"), F.concat(F.coalesce("`oboInOwl:hasExactSynonym`", empty), F.coalesce("`oboInOwl:hasRelatedSynonym`", empty)).alias("synonyms")).where("id <> ''")


def entity_field(xml: Column, field: str) -> Column:
    """Text of the first element of a name in an entity's XML: a label or a formula."""
    return present(F.regexp_extract(xml, rf"(?s)<{field}>\s*([^<]*?)\s*</{field}>", 1))


def solutions(spark: SparkSession, path: str, pattern: str = "solution_*_composition.json") -> DataFrame:
    """Compositions of stock solutions in the JSON files of a folder whose names fit a pattern: one a file, or one a line of files that fit another pattern."""
    return spark.read.option("pathGlobFilter", pattern).option("multiLine", pattern.startswith("solution_")).schema(SOLUTIONS).json(path)


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """match_string and object_id of annotations, a JSON array or an object a line, the first CHEBI id (by id) of each lower-cased string."""
    text = spark.read.text(path, wholetext=True)
    listed = F.when(F.startswith(F.trim("value"), F.lit("[")), F.col("value")).otherwise(F.concat(F.lit("["), F.array_join(F.split(F.trim(F.regexp_replace("value", r"\s+$", "")), r"\n"), ","), F.lit("]")))
    rows = text.select(F.inline(F.from_json(listed, "array<struct<match_string:string,object_id:string>>")))
    return rows.where(F.col("object_id").startswith("CHEBI:")).groupBy(F.lower("match_string").alias("match_string")).agg(F.min("object_id").alias("object_id"))


def pdf_files(spark: SparkSession, path: str) -> DataFrame:
    """Binary files that begin as PDF does."""
    return spark.read.format("binaryFile").load(path).where(F.substring("content", 1, 4) == F.lit(b"%PDF"))


def markdown_table(rows: DataFrame) -> DataFrame:
    """medium_id and a Markdown table of its ingredients in order of pos."""
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", cell("compound"), cell("g_l"), cell("unit")), F.lit(" |"))
    head = "| Component | Amount | Unit |\n|---|---|---|\n"
    ordered = F.array_sort(F.collect_list(F.struct("pos", line.alias("line"))))
    return rows.groupBy("medium_id").agg(F.concat(F.lit(head), F.array_join(F.transform(ordered, lambda x: x["line"]), "\n")).alias("markdown"))


def named_texts(spark: SparkSession, folder: str) -> DataFrame:
    """file_name and text of each file of a folder, or of each folder file_name=... below it."""
    rows = spark.read.option("recursiveFileLookup", True).text(folder, wholetext=True)
    own = F.regexp_extract(F.col("_metadata.file_path"), r"file_name=([^/]+)/", 1)
    return rows.select(F.coalesce(F.nullif(F.url_decode(own), F.lit("")), F.col("_metadata.file_name")).alias("file_name"), F.col("value").alias("text"))


def packed_texts(spark: SparkSession, folder: str) -> DataFrame:
    """file_name and text of the files that writers.packed_files() has put together."""
    return spark.read.schema("file_name string, content string").parquet(folder).withColumnRenamed("content", "text")
