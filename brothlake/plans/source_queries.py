"""Sources: URLs, JSON columns and HTML."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.chains import contains_any_sql
from ..operators import layouts, recipes
from ..sources import readers
from .registry import Tables, query

_URLS = "[^ \\t\\n\\r\"'<>)}\\],]*"


@query("url_scan", f"SELECT page_id, unnest(list_distinct(regexp_extract_all(concat(url, ' ', html), 'https?://{_URLS.replace(chr(39), chr(39) * 2)}'))) AS url FROM pages")
def url_scan(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.explode(urls.urls_in(F.concat_ws(" ", "url", "html"))).alias("url"))


_RECIPE = "concat(['https://mediadive.dsmz.de/medium/', 'https://www.dsmz.de/microorganisms/medium/pdf/DSMZ_Medium', 'https://www.jcm.riken.jp/cgi-bin/jcm/jcm_grmd?GRMD=', 'https://www.ccap.ac.uk/wp/MR_', 'https://www.atcc.org/-/docs/atcc-medium-', 'http://www.example.org/a/b', 'https://cyanosite.bio.purdue.edu/media/table/B'][p_partkey % 7 + 1], p_partkey, ['', '.pdf', '&x=1', '.pdf', '.pdf', '', '.html'][p_partkey % 7 + 1])"
_SPARK_RECIPE = _RECIPE.replace("concat([", "concat(array(").replace("][p_partkey % 7 + 1]", ")[p_partkey % 7]").replace(", ['',", ", array('',")


def recipe_urls(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.expr(_SPARK_RECIPE).alias("url"))


@query("url_filter", f"SELECT p_partkey, url FROM (SELECT p_partkey, {_RECIPE} AS url FROM part) WHERE {contains_any_sql('lower(url)', urls.KEYWORDS)}")
def url_filter(t: Tables) -> DataFrame:
    return recipe_urls(t).where(urls.about_media(F.col("url")))


@query("url_medium_id", f"""
WITH u AS (SELECT p_partkey, {_RECIPE} AS url FROM part)
SELECT p_partkey, coalesce(nullif(regexp_extract(url, '/medium/([^/?]+)', 1), ''), nullif(regexp_extract(url, 'DSMZ_Medium([^.]+)\\.pdf', 1), '')) AS medium_id,
  CASE p_partkey % 7 WHEN 0 THEN concat('dsmz_', p_partkey) WHEN 1 THEN concat('dsmz_', p_partkey) WHEN 2 THEN concat('jcm_', p_partkey) WHEN 3 THEN concat('ccap_', p_partkey) WHEN 4 THEN concat('atcc_', p_partkey) WHEN 5 THEN concat('example_org_b', p_partkey) ELSE concat('cyanosite_B', p_partkey) END AS source_id FROM u""")
def url_medium_id(t: Tables) -> DataFrame:
    return recipe_urls(t).select("p_partkey", urls.medium_id(F.col("url")).alias("medium_id"), urls.source_medium_id(F.col("url")).alias("source_id"))


@query("json_properties", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def json_properties(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.from_json("props", "k int")["k"].alias("k")).where("k IS NOT NULL")


_TEXT = "CASE p_partkey % 5 WHEN 0 THEN concat('Na', p_size, 'Cl ...... ', p_size, '.5 g/L\nKNO3 ... 2,5 mg/L\n') WHEN 1 THEN concat('MgSO4 ', p_size, ' g\nwater\nK2HPO4 1.5 mM') WHEN 2 THEN concat('Take Glucose (', p_size, ' g/L) and boil.') WHEN 3 THEN concat('Dissolve ', p_size, ' g of Na2CO3 in water.') ELSE p_name END"


@query("recipe_ingredients", """
SELECT p_partkey, 0 AS pos, CASE p_partkey % 5 WHEN 0 THEN concat('Na', p_size, 'Cl') WHEN 1 THEN 'MgSO4' WHEN 2 THEN 'Take Glucose' ELSE 'Na2CO3' END AS name, CASE p_partkey % 5 WHEN 0 THEN p_size + 0.5 ELSE p_size END::DOUBLE AS concentration,
  ['g/L', 'g', 'g/L', 'g'][p_partkey % 5 + 1] AS unit, ['dotted', 'columnar', 'parenthetical', 'amount_first'][p_partkey % 5 + 1] AS extraction_method FROM part WHERE p_partkey % 5 < 4
UNION ALL SELECT p_partkey, 1, CASE p_partkey % 5 WHEN 0 THEN 'KNO3' ELSE 'K2HPO4' END, CASE p_partkey % 5 WHEN 0 THEN 2.5 ELSE 1.5 END, CASE p_partkey % 5 WHEN 0 THEN 'mg/L' ELSE 'mM' END, CASE p_partkey % 5 WHEN 0 THEN 'dotted' ELSE 'columnar' END FROM part WHERE p_partkey % 5 < 2""")
def recipe_ingredients(t: Tables) -> DataFrame:
    return recipes.recipe_rows(t.dealt("part").select("p_partkey", F.expr(_TEXT.replace("\n", "\\n")).alias("text")), "p_partkey")


_LISTED = "concat('Medium\\nSodium nitrate\\nKH2PO4\\nSoil extract\\nper litre\\n', p_size, '.5 g\\n20 mg\\n', p_partkey % 9 + 1, ' ml\\nMake up to 1 litre\\nAutoclave at 15 psi\\n')"


@query("listed_ingredients", """
SELECT p_partkey, 0 AS pos, 'Sodium nitrate' AS name, p_size + 0.5::DOUBLE AS concentration, 'g' AS unit, 'list' AS extraction_method FROM part
UNION ALL SELECT p_partkey, 1, 'KH2PO4', 20, 'mg', 'list' FROM part UNION ALL SELECT p_partkey, 2, 'Soil extract', p_partkey % 9 + 1, 'ml', 'list' FROM part""")
def listed_ingredients(t: Tables) -> DataFrame:
    return recipes.recipe_rows(t.dealt("part").select("p_partkey", F.expr(_LISTED).alias("text")), "p_partkey")


@query("html_table_ingredients", """
SELECT page_id, 1 AS pos, 'NaCl' AS name, (page_id % 90)::DOUBLE AS concentration, 'g/l' AS unit FROM pages UNION ALL SELECT page_id, 3, 'K2HPO4 & co', 2.5, 'mM' FROM pages""")
def html_table_ingredients(t: Tables) -> DataFrame:
    table = F.concat(F.lit("<table><tr><th>Name</th><th>Amount</th></tr><tr><td>NaCl</td><td>"), (F.col("page_id") % 90).cast("string"), F.lit(" g/l</td></tr><tr><td>Distilled water</td><td>1 l</td></tr><tr><td><b>K2HPO4</b> &amp; co<td>dropped</td></tr>".replace("<td>dropped</td>", "</td><td>2.5</td><td>mM</td>") + "</table>"))
    return recipes.table_ingredients(t.pages.select("page_id", F.concat(table, "html").alias("html")), "page_id")


@query("composition_documents", """
SELECT concat('m', o_orderkey) AS medium_id, 'NaCl' AS compound, o_custkey::DOUBLE AS g_l, 'g/L' AS unit, 0 AS pos FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey::VARCHAR, 'KCl', 1.5, 'mM', 0 FROM orders WHERE o_orderkey % 3 = 1 UNION ALL SELECT o_orderkey::VARCHAR, 'agar', o_custkey, 'g/L', 1 FROM orders WHERE o_orderkey % 3 = 1""")
def composition_documents(t: Tables) -> DataFrame:
    key, amount = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    listed = F.concat(F.lit('[{"compound":"NaCl","g_l":'), amount, F.lit(',"medium_id":"m'), key, F.lit('"}]'))
    formed = F.concat(F.lit('{"composition":[{"name":"KCl","concentration":"1.5","unit":"mM"},{"compound":"agar","amount":"'), amount, F.lit('"}]}'))
    content = F.when(F.col("o_orderkey") % 3 == 0, listed).when(F.col("o_orderkey") % 3 == 1, formed).otherwise("not JSON")
    docs = t.orders.select(F.concat(F.lit("/x/medium_"), key, F.lit("_composition.json")).alias("path"), content.alias("content"))
    return readers.composition_rows(docs).select("medium_id", "compound", "g_l", "unit", "pos")


@query("file_types", """
SELECT t, count(*) AS n FROM (SELECT ['composition_json', 'jcm_html', 'ccap_text', 'text', 'unknown'][p_partkey % 5 + 1] AS t FROM part) GROUP BY 1""")
def file_types(t: Tables) -> DataFrame:
    names = F.element_at(F.array(*map(F.lit, ["/a/medium_1_composition.json", "/a/jcm_12.html", "ccap_bb.pdf", "/x/other.PDF", "/x/y.bin"])), (F.col("p_partkey") % 5 + 1).cast("int"))
    return t.part.groupBy(readers.file_type(names).alias("t")).agg(F.count(F.lit(1)).alias("n"))


@query("ontology_names", """
WITH k AS (SELECT lower(n_name) AS key, 0 AS r, concat('CHEBI:', n_nationkey) AS id, n_name AS name FROM nation UNION ALL SELECT concat('group ', n_regionkey), 1, concat('CHEBI:', n_nationkey), n_name FROM nation)
SELECT key, arg_min(id, (r, id)) AS id, arg_min(name, (r, id)) AS name FROM k GROUP BY key""")
def ontology_names(t: Tables) -> DataFrame:
    nodes = t.nation.select(F.concat(F.lit("CHEBI:"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("name"), F.concat(F.lit(" Group "), F.col("n_regionkey").cast("string"), F.lit("|")).alias("synonym"))
    return readers.ontology_names(nodes, F.lower)


@query("markdown_tables", """
SELECT medium_id, concat('| Component | Amount | Unit |', chr(10), '|---|---|---|', chr(10), string_agg(line, chr(10) ORDER BY pos, line)) AS markdown
FROM (SELECT l_orderkey AS medium_id, concat('| part ', l_partkey, ' | ', l_partkey, ' | g |') AS line, l_linenumber AS pos FROM lineitem) GROUP BY 1""")
def markdown_tables(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.col("l_orderkey").alias("medium_id"), F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("compound"), F.col("l_partkey").alias("g_l"), F.lit("g").alias("unit"), F.col("l_linenumber").alias("pos"))
    return readers.markdown_table(rows)


# Texts in layouts of several lines, with one to four ingredients each, told by a part's numbers.

_NAMES = ["MgSO4", "Yeast extract", "K2HPO4 x 3 H2O", "Beef extract", "NaCl", "Casitone", "CaCl2"]


def _layout_texts(t: Tables) -> DataFrame:
    each, kind = F.sequence(F.lit(0), (F.col("p_size") % 4).cast("int")), F.col("p_partkey") % 6
    name = lambda i: F.element_at(F.array(*map(F.lit, _NAMES)), ((F.col("p_partkey") + i) % len(_NAMES) + 1).cast("int"))
    amount = lambda i: F.concat((F.col("p_size") + i).cast("string"), F.lit(".5"))
    block = lambda f: F.concat_ws("\n", F.transform(each, f))
    names, amounts = block(name), block(amount)
    units = F.concat_ws("\n", F.transform(F.filter(each, lambda i: i > 0), lambda i: F.lit("mg")))
    solution = F.concat(F.lit("Take care\nTrace solution:\n"), block(lambda i: F.concat(name(i), F.lit(" ("), amount(i), F.lit(" mg)"))), F.lit("\npH 7\nDistilled water"))
    sentence = F.concat(F.lit("The broth contains "), amount(F.lit(0)), F.lit(" g yeast extract per litre. Casitone is added at "), amount(F.lit(1)), F.lit(" mg/l."))
    text = (
        F.when(kind == 0, F.concat_ws("\n", F.lit("Some medium"), names, amounts, units, F.lit("Adjust pH")))
        .when(kind == 1, F.concat_ws("\n", amounts, F.lit("mg"), names, F.lit("Final medium")))
        .when(kind == 2, solution)
        .when(kind == 3, F.concat(F.lit("Use Medium "), F.col("p_size").cast("string"), F.lit(" and add 5% beef extract. plus "), amount(F.lit(0)), F.lit(" agar")))
        .when(kind == 4, F.concat_ws("\n", names, F.lit("see below"), amounts, F.lit("in"), units))
        .otherwise(sentence)
    )
    return t.dealt("part").select("p_partkey", text.alias("text"))


_LAYOUT_ROWS = f"""
rows AS (SELECT p_partkey, p_size, p_partkey % 6 AS kind, unnest(range(p_size % 4 + 1)) AS i FROM part),
named AS (SELECT *, ({_NAMES})[(p_partkey + i) % {len(_NAMES)} + 1] AS name, p_size + i + 0.5::DOUBLE AS amount, p_size % 4 + 1 AS n FROM rows)"""


@query("layout_ingredients", f"""
WITH {_LAYOUT_ROWS}
SELECT p_partkey, i::INTEGER AS pos, name, amount AS concentration, CASE WHEN kind = 2 OR (kind = 0 AND i < n - 1) OR (kind = 1 AND i = 0) OR (kind = 4 AND i < n - 1) THEN 'mg' ELSE 'g' END AS unit, ['tabular', 'reverse_tabular', 'solutions', '', 'tabular'][kind + 1] AS extraction_method FROM named WHERE kind IN (0, 1, 2, 4)
UNION ALL SELECT p_partkey, 0, concat('Reference to Medium ', p_size), 1.0, 'reference', 'reference' FROM part WHERE p_partkey % 6 = 3
UNION ALL SELECT p_partkey, 1, 'Beef Extract', 5.0, '%', 'addition' FROM part WHERE p_partkey % 6 = 3 UNION ALL SELECT p_partkey, 2, 'Agar', p_size + 0.5, 'g', 'addition' FROM part WHERE p_partkey % 6 = 3
UNION ALL SELECT p_partkey, 0, 'yeast extract', p_size + 0.5, 'g/L', 'prose' FROM part WHERE p_partkey % 6 = 5 UNION ALL SELECT p_partkey, 1, x, p_size + 1.5, 'mg/L', 'prose' FROM (SELECT *, 'Casitone' AS x FROM part) WHERE p_partkey % 6 = 5""")
def layout_ingredients(t: Tables) -> DataFrame:
    return recipes.recipe_rows(_layout_texts(t), "p_partkey")


@query("three_column_ingredients", f"WITH {_LAYOUT_ROWS} SELECT p_partkey, i AS pos, name, amount AS concentration, CASE WHEN i < n - 1 THEN 'mg' ELSE 'g' END AS unit, 'three_columns' AS extraction_method FROM named WHERE kind IN (0, 4)")
def three_column_ingredients(t: Tables) -> DataFrame:
    return _layout_texts(t).select("p_partkey", F.posexplode(layouts.three_columns(F.col("text"))).alias("pos", "r")).select("p_partkey", "pos", "r.*")


@query("solution_ingredients", f"WITH {_LAYOUT_ROWS} SELECT p_partkey, name, amount AS concentration, 'Trace solution:' AS solution FROM named WHERE kind = 2")
def solution_ingredients(t: Tables) -> DataFrame:
    rows = _layout_texts(t).select("p_partkey", F.explode(layouts.solutions(F.col("text"))).alias("r"))
    return rows.select("p_partkey", "r.name", "r.concentration", "r.solution")
