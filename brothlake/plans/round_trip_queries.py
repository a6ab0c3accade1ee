"""Sinks and sources against each other, and whole jobs: tables are written by the library's writers and read back by its readers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import media_documents, properties
from ..sources import json_ranges, readers, writers
from ..sources.scratch import scratch_path
from ..sources.versioned import VersionedTable, property_defaults, valid_property
from . import stages
from .mapping_queries import nodes
from .media_queries import _FACTS, _PH, compositions, property_rows
from .registry import Tables, query

_text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _written_lines(t: Tables, lines: DataFrame, name: str) -> str:
    path = scratch_path(t.spark, name)
    lines.write.text(path)
    return path


@query("tsv_round_trip", """
SELECT c_custkey::VARCHAR AS medium_id, CASE WHEN c_custkey % 5 > 0 THEN concat('a "', c_nationkey, '" b') END AS original, CASE WHEN c_custkey % 7 > 0 THEN c_acctbal END AS value, 'NA' AS unit, NULL::VARCHAR AS source FROM customer""")
def tsv_round_trip(t: Tables) -> DataFrame:
    """Fixed columns first, blanks as nulls, quotes within text, NA as data, what is no number as null; sorted over all files."""
    k = F.col("c_custkey")
    rows = t.customer.select(k.cast("string").alias("medium_id"), F.when(k % 5 > 0, _text(" a \"", F.col("c_nationkey"), "\" b ")).otherwise("  ").alias("original"), F.when(k % 7 > 0, F.col("c_acctbal").cast("string")).otherwise("none").alias("value"), F.lit("NA").alias("unit"))
    path = scratch_path(t.spark, "rows")
    writers.tsv(writers.ordered_columns(rows), path, [F.asc("medium_id")])
    return readers.tsv(t.spark, path, readers.MAPPING).select("medium_id", "original", "value", "unit", "source")


@query("graph_round_trip", """
SELECT concat('CHEBI:', n_nationkey) AS id, n_name AS name, concat('REGION:', n_regionkey) AS object FROM nation WHERE n_nationkey % 3 < 2""")
def graph_round_trip(t: Tables) -> DataFrame:
    """Nodes and edges as TSV files; the nodes of chemical categories with their edges."""
    k = F.col("n_nationkey")
    own = t.nation.select(_text("CHEBI:", k).alias("id"), F.element_at(F.array(F.lit("biolink:ChemicalEntity"), F.lit("x|ChemicalSubstance"), F.lit("biolink:Taxon")), (k % 3 + 1).cast("int")).alias("category"), F.col("n_name").alias("name"), F.lit("").alias("synonym"))
    edges = t.nation.select(_text("CHEBI:", k).alias("subject"), F.lit("biolink:part_of").alias("predicate"), _text("REGION:", F.col("n_regionkey")).alias("object"))
    paths = [scratch_path(t.spark, n) for n in ("nodes", "edges")]
    writers.tsv(own, paths[0])
    writers.tsv(edges, paths[1])
    chemical, links = readers.graph(t.spark, *paths)
    return chemical.join(links, chemical["id"] == links["subject"]).select("id", "name", "object")


@query("owl_round_trip", "SELECT concat('CHEBI:', n_nationkey) AS id, concat(n_name, ' & co') AS label, CASE WHEN n_regionkey % 2 = 0 THEN concat('syn ', n_regionkey, '|old') ELSE 'old' END AS synonyms FROM nation")
def owl_round_trip(t: Tables) -> DataFrame:
    synonym = F.when(F.col("n_regionkey") % 2 == 0, _text("<oboInOwl:hasExactSynonym>syn ", F.col("n_regionkey"), "</oboInOwl:hasExactSynonym>")).otherwise("")
    own = _text("<owl:Class rdf:about=\"http://purl.obolibrary.org/obo/CHEBI_", F.col("n_nationkey"), "\"><rdfs:label>", F.col("n_name"), " &amp; co</rdfs:label>", synonym, "<oboInOwl:hasRelatedSynonym>old</oboInOwl:hasRelatedSynonym></owl:Class>")
    document = t.nation.agg(F.concat(F.lit("<rdf:RDF xmlns:rdf=\"r\" xmlns:owl=\"o\" xmlns:rdfs=\"s\" xmlns:oboInOwl=\"b\">"), F.array_join(F.collect_list(own), "\n"), F.lit("</rdf:RDF>")))
    classes = readers.owl_classes(t.spark, _written_lines(t, document, "owl"))
    return classes.select("id", "label", F.array_join("synonyms", "|").alias("synonyms"))


@query("annotation_round_trip", "SELECT lower(n_name) AS match_string, concat('CHEBI:', n_nationkey) AS object_id FROM nation")
def annotation_round_trip(t: Tables) -> DataFrame:
    """A JSON list of matches, some of other ontologies; of a string's ids the first by order."""
    found = F.explode(F.array(_text("GO:", F.col("n_nationkey")), _text("CHEBI:", F.col("n_nationkey")), _text("CHEBI:x", F.col("n_nationkey")))).alias("object_id")
    lines = t.nation.select(F.col("n_name").alias("match_string"), found).select(F.to_json(F.struct("match_string", "object_id")))
    return readers.annotations(t.spark, _written_lines(t, lines, "annotations"))


@query("entity_fields", "SELECT p_partkey, p_name AS label, CASE WHEN p_size % 3 > 0 THEN concat('C', p_size, 'H2') END AS formula FROM part")
def entity_fields(t: Tables) -> DataFrame:
    xml = _text("<return><chebiAsciiName>\n ", F.col("p_name"), " </chebiAsciiName><Formulae><data>", F.when(F.col("p_size") % 3 > 0, _text("C", F.col("p_size"), "H2")).otherwise(" "), "</data></Formulae></return>")
    return t.part.select("p_partkey", readers.entity_field(xml, "chebiAsciiName").alias("label"), readers.entity_field(xml, "data").alias("formula"))


@query("solution_round_trip", "SELECT s_suppkey::VARCHAR AS solution_id, s_name AS name, s_acctbal AS concentration, CASE WHEN s_suppkey % 2 = 0 THEN 'g' ELSE 'mg' END AS unit FROM supplier")
def solution_round_trip(t: Tables) -> DataFrame:
    part = F.struct(F.col("s_name").alias("name"), F.col("s_acctbal").alias("concentration"), F.when(F.col("s_suppkey") % 2 == 0, "g").otherwise("mg").alias("unit"))
    path = scratch_path(t.spark, "solutions")
    t.supplier.select(F.col("s_suppkey").cast("string").alias("solution_id"), F.array(part).alias("composition")).write.json(path)
    rows = readers.solutions(t.spark, path, pattern="*.json")
    return rows.select("solution_id", F.explode("composition").alias("c")).select("solution_id", "c.name", "c.concentration", "c.unit")


@query("pdf_signatures", "SELECT 1::BIGINT AS files")
def pdf_signatures(t: Tables) -> DataFrame:
    """Of two files, one of which begins as PDF does."""
    folder = scratch_path(t.spark, "binaries")
    rows = t.region.limit(1).select(F.explode(F.array(F.lit("%PDF-1.7 x"), F.lit("<html> %PDF"))).alias("content")).withColumn("file_name", F.when(F.col("content").startswith("%PDF"), "a").otherwise("b"))
    writers.named_files(rows, folder)
    return readers.pdf_files(t.spark, f"{folder}/*/*").agg(F.count(F.lit(1)).alias("files"))


@query("document_round_trip", "SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders")
def document_round_trip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "documents")
    writers.documents(t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice"), path, "o_orderpriority")
    return t.spark.read.schema("o_orderkey long, o_totalprice double, o_orderpriority string").json(path).select("o_orderpriority", "o_orderkey", "o_totalprice")


@query("failure_table", "SELECT p_type AS kind, count(*) AS n, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS paths FROM part WHERE p_size % 4 = 0 GROUP BY 1")
def failure_table(t: Tables) -> DataFrame:
    found = writers.failures(t.part.withColumnRenamed("p_type", "kind"), "kind", "p_brand", F.col("p_size") % 4 == 0)
    return found.select("kind", "n", F.array_join("paths", ",").alias("paths"))


@query("media_json_round_trip", f"""
WITH {_FACTS} SELECT medium_id, round({_PH}, 2) AS ph_value, n::VARCHAR AS parts FROM sums""")
def media_json_round_trip(t: Tables) -> DataFrame:
    """JSON in and JSON out: a list of components, the medium's document, and its text back as a document."""
    line = F.struct("compound", "g_l")
    media = compositions(t).groupBy("medium_id").agg(F.to_json(F.collect_list(line)).alias("content"))
    text = media_documents.as_json(media_documents.analysed(media, property_rows(t)))
    back = text.select("medium_id", F.from_json("content", media_documents.DOCUMENT).alias("d")).select("medium_id", "d.*")
    return back.select("medium_id", F.col("ph.value").alias("ph_value"), F.split_part("analysis_quality.compounds_recognized", F.lit("/"), F.lit(2)).alias("parts"))


# Whole jobs.


@query("unified_job", """
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN n_name ELSE concat(n_name, ' hydrate') END AS original, CASE WHEN c_custkey % 3 = 0 THEN 'kg:1' END AS mapped FROM customer JOIN nation ON c_nationkey = n_nationkey),
m AS (SELECT DISTINCT original FROM c WHERE mapped IS NULL), f AS (SELECT original, concat('CHEBI:', n_nationkey) AS chebi_id FROM m JOIN nation ON original IN (n_name, concat(n_name, ' hydrate')))
SELECT c_custkey, c.original, coalesce(mapped, chebi_id) AS mapped, chebi_id, CASE WHEN mapped IS NOT NULL THEN 'original_plus_chebi_alternative' ELSE 'original_and_chebi_match' END AS mapping_status FROM c JOIN f ON c.original = f.original""")
def unified_job(t: Tables) -> DataFrame:
    """Mapping rows, the staged matches of those without an id, merged with status."""
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = joined.select("c_custkey", F.lit("1").alias("medium_id"), F.when(F.col("c_custkey") % 2 == 0, F.col("n_name")).otherwise(F.concat("n_name", F.lit(" hydrate"))).alias("original"), F.when(F.col("c_custkey") % 3 == 0, "kg:1").alias("mapped"), F.lit("kg").alias("source"))
    return stages.unified(rows, nodes(t), least=100).select("c_custkey", "original", "mapped", "chebi_id", "mapping_status")


@query("summary_job", f"""
WITH {_FACTS} SELECT medium_id, round({_PH}, 2) AS ph, CASE WHEN medium_id % 2 = 0 THEN n ELSE 0 END AS total_compounds, CASE WHEN medium_id % 2 = 0 THEN recognized ELSE 0 END AS mapped_compounds, CASE WHEN medium_id % 2 = 0 THEN round(100.0::DOUBLE * recognized / n, 1) ELSE 0 END AS mapping_rate,
  (estimated > 0)::INTEGER + (recognized + estimated < n)::INTEGER + (round(strength, 6) > 0.1)::INTEGER + (round(strength, 6) < 0.001)::INTEGER AS notes FROM sums""")
def summary_job(t: Tables) -> DataFrame:
    """Chemistry of each medium with its mapping figures; media without mapped rows have zeros."""
    accounts = properties.ingredients(compositions(t), property_rows(t)).where("medium_id % 2 = 0")
    mapped = accounts.select("medium_id", F.when(F.col("account") == "recognized", "x").otherwise("").alias("mapped"))
    found = stages.media_summary(compositions(t), property_rows(t), mapped)
    return found.select("medium_id", "ph", "total_compounds", "mapped_compounds", "mapping_rate", F.size("notes").alias("notes"))


@query("extraction_job", """
SELECT concat('f', p_partkey, '.txt') AS file_name, CASE WHEN p_partkey % 2 = 0 THEN 'BROTH MEDIUM' ELSE concat('f', p_partkey, '.txt') END AS medium_name, 'NaCl' AS name, p_size + 0.5::DOUBLE AS concentration, 'Boil it.' AS preparation_instructions FROM part""")
def extraction_job(t: Tables) -> DataFrame:
    """Text files with a title, an ingredient given twice and instructions."""
    folder = scratch_path(t.spark, "texts")
    title = F.when(F.col("p_partkey") % 2 == 0, "BROTH MEDIUM\n").otherwise("")
    text = F.concat(title, _text("NaCl (", F.col("p_size"), ".5 g/L), NaCl (1 mg)\nPreparation: Boil it.\n"))
    writers.packed_files(t.dealt("part").select(_text("f", F.col("p_partkey"), ".txt").alias("file_name"), text.alias("content")), folder)
    return stages.extracted_texts(t.spark, folder, packed=True).select("file_name", "medium_name", "name", "concentration", "preparation_instructions")


@query("property_database_job", "SELECT p_name AS compound_name, 1.0::DOUBLE AS molecular_weight FROM part WHERE p_size % 2 = 0 UNION SELECT p_name, 2.0 FROM part WHERE p_size % 2 = 1 AND p_size % 3 = 0 AND lower(p_name) NOT IN (SELECT lower(p_name) FROM part WHERE p_size % 2 = 0)")
def property_database_job(t: Tables) -> DataFrame:
    """Known rows, and found ones of the names asked for that they lack."""
    rows = lambda c, w: t.part.where(c).select(F.col("p_name").alias("compound_name"), F.lit(w).alias("molecular_weight")).distinct()
    return stages.property_database(t.part.where("p_size % 3 = 0").select(F.upper("p_name").alias("name")), rows("p_size % 2 = 0", 1.0), rows("p_size % 2 = 1", 2.0))


@query("expansion_job", """
SELECT l_orderkey, l_linenumber, s_name AS original, CASE WHEN l_quantity = 0 OR s_acctbal = 0 THEN s_acctbal ELSE round(s_acctbal * l_quantity / 1000, 6) END AS value FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")
def expansion_job(t: Tables) -> DataFrame:
    """Rows mapped to stock solutions, whose compositions are read from JSON files."""
    folder = scratch_path(t.spark, "stock")
    part = F.struct(F.col("s_name").alias("name"), F.col("s_acctbal").alias("concentration"), F.lit("g").alias("unit"))
    t.supplier.select(F.col("s_suppkey").cast("string").alias("solution_id"), F.array(part).alias("composition")).write.json(folder)
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.lit("stock").alias("original"), _text("solution:", F.col("l_suppkey")).alias("mapped"), F.col("l_quantity").cast("double").alias("value"), F.lit("ml/l").alias("unit"))
    return stages.expanded(t.spark, rows, folder, pattern="*.json").select("l_orderkey", "l_linenumber", "original", F.round("value", 6).alias("value"))


def _versioned(t: Tables) -> VersionedTable:
    """A table of sizes of parts, of each the first part's price, in a scratch folder."""
    rows = t.part.groupBy(F.concat(F.lit("c"), F.col("p_size").cast("string")).alias("name")).agg(F.min_by("p_retailprice", "p_partkey").cast("double").alias("weight"), F.lit(None).cast("string").alias("note"))
    table = VersionedTable(t.spark, scratch_path(t.spark, "versioned"))
    table.create(rows, "name", 16)
    return table


_SIZES = "WITH e AS (SELECT concat('c', p_size) AS name, arg_min(p_retailprice, p_partkey)::DOUBLE AS weight, NULL::VARCHAR AS note FROM part GROUP BY 1)"


@query("versioned_upserts", _SIZES + """, n AS (SELECT concat('C', c_custkey % 90) AS name, c_acctbal::DOUBLE AS weight, c_mktsegment AS note, c_custkey FROM customer)
SELECT name, round(weight, 4) AS weight, note FROM e UNION ALL SELECT name, round(weight, 4), note FROM (SELECT * FROM n WHERE lower(name) NOT IN (SELECT name FROM e) QUALIFY row_number() OVER (PARTITION BY lower(name) ORDER BY c_custkey) = 1)""")
def versioned_upserts(t: Tables) -> DataFrame:
    """Names that the table lacks are added, of equal ones the first; made twice, once in effect."""
    table, key = _versioned(t), F.col("c_custkey")
    new = t.customer.select(F.concat(F.lit("C"), (key % 90).cast("string")).alias("name"), F.col("c_acctbal").cast("double").alias("weight"), F.col("c_mktsegment").alias("note"), key.alias("pos"))
    for _ in range(2):
        table.upserted(new, "customers", "pos")
    return table.read().withColumn("weight", F.round("weight", 4))


@query("versioned_updates", _SIZES + """, u AS (SELECT concat('c', o_custkey % 70) AS name, arg_max(o_totalprice, o_orderkey) FILTER (o_orderkey % 3 > 0)::DOUBLE AS weight, arg_max(o_orderstatus, o_orderkey) AS note FROM orders GROUP BY 1)
SELECT name, round(coalesce(u.weight, e.weight), 4) AS weight, coalesce(u.note, e.note) AS note FROM e LEFT JOIN u USING (name)""")
def versioned_updates(t: Tables) -> DataFrame:
    """The last value of each column that is not null takes the place of the table's."""
    table, key = _versioned(t), F.col("o_orderkey")
    updates = t.orders.select(F.concat(F.lit("c"), (F.col("o_custkey") % 70).cast("string")).alias("name"), F.when(key % 3 > 0, F.col("o_totalprice").cast("double")).alias("weight"), F.col("o_orderstatus").alias("note"), key.alias("pos"))
    table.updated(updates, "orders", "pos")
    return table.read().withColumn("weight", F.round("weight", 4))


@query("appended_properties", """
WITH s AS (SELECT s_name AS compound_name, s_acctbal::DOUBLE AS molecular_weight, CASE WHEN s_suppkey % 4 = 0 THEN s_nationkey - 3.0 END::DOUBLE AS given FROM supplier)
SELECT compound_name, round(molecular_weight, 4) AS molecular_weight, '' AS pka_values, '0' AS charge_states, '' AS ion_charges, coalesce(given, 100) AS "solubility_g_per_L", 1.0::DOUBLE AS activity_coefficient, compound_name AS description FROM s WHERE molecular_weight > 0 AND coalesce(given, 100) >= 0""")
def appended_properties(t: Tables) -> DataFrame:
    """Rows by hand, in two changes, with defaults where nothing is given; rows that aren't valid are left out."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "properties"))
    columns = "compound_name string, molecular_weight double, pka_values string, charge_states string, ion_charges string, solubility_g_per_L double, activity_coefficient double, description string"
    table.create(t.spark.createDataFrame([], columns), "compound_name", 8)
    rows = t.supplier.select(F.col("s_name").alias("compound_name"), F.col("s_acctbal").cast("double").alias("molecular_weight"), F.when(F.col("s_suppkey") % 4 == 0, F.col("s_nationkey") - 3.0).alias("solubility_g_per_L"), "s_suppkey")
    for k, part in enumerate((rows.where("s_suppkey % 2 = 0"), rows.where("s_suppkey % 2 = 1"))):
        table.appended(part.drop("s_suppkey"), f"manual-{k}", property_defaults(), valid_property)
    return table.read().withColumn("molecular_weight", F.round("molecular_weight", 4))


@query("json_objects", "SELECT doc_id, source, md5(text) AS text_md5, n_chars AS size FROM documents UNION ALL SELECT page_id, url, md5(html), -1 FROM pages")
def json_objects(t: Tables) -> DataFrame:
    """Documents and pages as JSON files of one line each, nested objects and braces in texts and all, read back in ranges."""
    folder = scratch_path(t.spark, "objects")
    docs = t.documents.select(F.struct("doc_id", "source", F.struct("text", F.struct(F.col("n_chars").cast("long").alias("size")).alias("n")).alias("body")).alias("r"))
    pages = t.pages.select(F.struct(F.col("page_id").cast("long").alias("doc_id"), F.col("url").alias("source"), F.struct(F.col("html").alias("text"), F.struct(F.lit(-1).cast("long").alias("size")).alias("n")).alias("body")).alias("r"))
    docs.unionByName(pages).select(F.to_json("r")).write.option("lineSep", ",").text(folder)
    rows = json_ranges.objects(t.spark, folder).select(F.from_json("content", "doc_id long, source string, body struct<text:string,n:struct<size:long>>").alias("r"))
    return rows.select("r.doc_id", "r.source", F.md5(F.col("r.body.text").cast("binary")).alias("text_md5"), F.col("r.body.n.size").alias("size"))
