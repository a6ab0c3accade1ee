"""Queries on pages of a culture collection, texts of stock solutions, and ingredients mined from whole recipes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.chains import replaced_sql
from ..operators import jcm, mining, reports, routing, solution_texts
from .registry import Tables, query

_SALTS = ["NaCl", "MgSO4", "KH2PO4", "CaCl2", "FeSO4"]
_salt = lambda n: F.element_at(F.array(*map(F.lit, _SALTS)), (n % len(_SALTS) + 1).cast("int"))
_SALT = lambda n: f"({_SALTS})[{n} % {len(_SALTS)} + 1]"
_text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _pages(t: Tables) -> DataFrame:
    """Pages of every kind: without data, with tables, by reference to another medium, and without an id."""
    k, s = F.col("p_partkey"), F.col("p_size")
    head = _text("<html>Search for medium no. = [", k, "]<font size=\"3\"><b>", k, "  Broth &amp; ", F.col("p_name"), "</b></font>")
    table = _text(head, "<table border=1><tr><td>", _salt(k), "</td><td>", s, ".5</td><td>g</td></tr><tr><td>Agar</td><td>15</td><td>g</td></tr></table>Adjust to <b>pH</b> ", s % 9, ".<hr>gone")
    change = _text(head, "<p>Use Medium No. <a href=\"/cgi-bin/jcm_grmd?GRMD=", k - 2, "\">", k - 2, "</a> supplemented with ", s, ".5 g/L ", _salt(s), " (final) without agar.</p><i>Trace solution:</i> ", s, " mg ", _salt(s + 1), " in 100 ml water")
    kind = k % 4
    html = F.when(kind == 0, _text("<html>Nothing found ", k)).when(kind == 1, table).when(kind == 3, change).otherwise("<html><p>no id</p>")
    return t.dealt("part").select(_text("/x/jcm_", k, ".html").alias("path"), html.alias("html"))


@query("collection_media", """
SELECT concat('/x/jcm_', p_partkey, '.html') AS path, CASE WHEN p_partkey % 4 <> 2 THEN concat('jcm_', p_partkey) END AS medium_id, ['no_data', 'tables', 'unknown', 'reference'][p_partkey % 4 + 1] AS composition_type,
  CASE WHEN p_partkey % 4 = 3 THEN concat('jcm_', p_partkey - 2) END AS base_medium, CASE p_partkey % 4 WHEN 0 THEN concat('JCM ', p_partkey, ' (No Data)') WHEN 2 THEN 'Unknown JCM Medium' ELSE concat('Broth & ', p_name) END AS medium_name,
  CASE p_partkey % 4 WHEN 1 THEN concat('Adjust to pH ', p_size % 9, '.') ELSE '' END AS table_text FROM part""")
def collection_media(t: Tables) -> DataFrame:
    return jcm.media(_pages(t)).select("path", "medium_id", "composition_type", "base_medium", "medium_name", F.when(F.col("composition_type") == "tables", F.col("preparation")).otherwise("").alias("table_text"))


_COLLECTED = f"""
rows AS (SELECT concat('jcm_', p_partkey) AS medium_id, {_SALT('p_partkey')} AS name, p_size + 0.5::DOUBLE AS concentration, 'g' AS unit, 'table' AS action FROM part WHERE p_partkey % 4 = 1
UNION ALL SELECT concat('jcm_', p_partkey), 'Agar', 15, 'g', 'table' FROM part WHERE p_partkey % 4 = 1
UNION ALL SELECT concat('jcm_', p_partkey), concat('Base Medium ', p_partkey - 2), 1, 'reference', 'base' FROM part WHERE p_partkey % 4 = 3
UNION ALL SELECT concat('jcm_', p_partkey), {_SALT('p_size')}, p_size + 0.5, 'g/L', 'add' FROM part, range(2) WHERE p_partkey % 4 = 3
UNION ALL SELECT concat('jcm_', p_partkey), 'agar', 0, 'removed', 'remove' FROM part WHERE p_partkey % 4 = 3
UNION ALL SELECT concat('jcm_', p_partkey), {_SALT('(p_size + 1)')}, p_size, 'mg', 'recipe' FROM part, range(2) WHERE p_partkey % 4 = 3)"""


@query("collection_ingredients", f"WITH {_COLLECTED} SELECT medium_id, name, action, unit, concentration, count(*) AS n FROM rows GROUP BY ALL")
def collection_ingredients(t: Tables) -> DataFrame:
    rows = jcm.ingredient_rows(jcm.media(_pages(t)))
    return rows.groupBy("medium_id", "name", "action", "unit", "concentration").agg(F.count(F.lit(1)).alias("n"))


@query("collection_resolved", f"""
WITH {_COLLECTED}, own AS (SELECT * FROM rows WHERE action NOT IN ('base', 'remove')),
inherited AS (SELECT b.medium_id, o.name, o.concentration, o.unit, 'inherited' AS action FROM rows b JOIN own o ON o.medium_id = concat('jcm_', regexp_extract(b.name, '\\d+$')) WHERE b.action = 'base' AND NOT EXISTS (SELECT 1 FROM rows g WHERE g.medium_id = b.medium_id AND g.action = 'remove' AND lower(g.name) = lower(o.name)))
SELECT * FROM own UNION ALL SELECT * FROM inherited""")
def collection_resolved(t: Tables) -> DataFrame:
    return jcm.resolved(jcm.ingredient_rows(jcm.media(_pages(t))))


#: Chains of ten media, each based on the one before it; of a hundred, two are based on each other and one on a medium that isn't there.
_CHAINS = f"""
WITH RECURSIVE p AS (SELECT p_partkey AS k, p_size AS s, {_SALT('p_partkey')} AS salt FROM part),
links AS (SELECT k, CASE WHEN k % 100 = 97 THEN k + 1 WHEN k % 100 = 55 THEN 0 ELSE k - 1 END AS base FROM p WHERE k % 10 > 0),
walk AS (SELECT k, base, 1 AS steps FROM links UNION ALL SELECT w.k, l.base, steps + 1 FROM walk w JOIN links l ON w.base = l.k WHERE steps < 12),
bases AS (SELECT k, base, min(steps) AS steps FROM walk GROUP BY 1, 2),
own AS (SELECT k, salt AS name, s::DOUBLE AS concentration FROM p UNION ALL SELECT k, concat('Agar ', s % 3), 1 FROM p),
gone AS (SELECT k, concat('agar ', s % 3) AS low FROM p WHERE s % 2 = 0)"""


def _chained(t: Tables) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    base = F.when(k % 100 == 97, k + 1).when(k % 100 == 55, F.lit(0)).otherwise(k - 1)
    agar = _text("Agar ", s % 3)
    row = lambda name, amount, unit, action: F.struct(name.alias("name"), amount.cast("double").alias("concentration"), F.lit(unit).alias("unit"), F.lit(action).alias("action"))
    rows = F.array(row(_salt(k), s, "g", "table"), row(agar, F.lit(1), "g", "table"), F.when(k % 10 > 0, row(_text("Base Medium ", base), F.lit(1), "reference", "base")), F.when(s % 2 == 0, row(agar, F.lit(0), "removed", "remove")))
    return t.part.select(_text("jcm_", k).alias("medium_id"), F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select("medium_id", "r.*")


@query("chained_media", _CHAINS + """
SELECT concat('jcm_', k) AS medium_id, name, concentration, 'table' AS action FROM own
UNION ALL SELECT concat('jcm_', b.k), name, concentration, 'inherited' FROM bases b JOIN own o ON b.base = o.k WHERE b.k <> b.base AND NOT EXISTS (
  SELECT 1 FROM gone g WHERE g.low = lower(o.name) AND (g.k = b.k OR EXISTS (SELECT 1 FROM bases n WHERE n.k = b.k AND n.base = g.k AND n.base <> n.k AND n.steps < b.steps)))""")
def chained_media(t: Tables) -> DataFrame:
    """Media based on media that are based on media, with what each on the way leaves out."""
    return jcm.resolved(_chained(t)).select("medium_id", "name", "concentration", "action")


@query("unresolved_media", _CHAINS + """
SELECT concat('jcm_', k) AS medium_id, 'cycle' AS reason FROM bases WHERE k = base UNION ALL SELECT concat('jcm_', k), 'missing' FROM links WHERE base NOT IN (SELECT k FROM p)""")
def unresolved_media(t: Tables) -> DataFrame:
    return jcm.unresolved(_chained(t))


def _solutions(t: Tables) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    amounts = _text("{\"name\": \"Trace solution ", k, "\"}\nsodium chloride ", s, ",5 g\n", _salt(k), " ", s, " mg\nbiotin 2 mg\n")
    bare = _text("Name: Mineral salts ", k, "\n- Ferrous sulfate\n(Agar)\n")
    return t.dealt("part").select("p_partkey", F.when(k % 2 == 0, amounts).otherwise(bare).alias("text"))


@query("solution_texts", f"""
WITH r AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN concat('Trace solution ', p_partkey) ELSE concat('Mineral salts ', p_partkey) END AS solution_name, p_size, p_partkey % 2 AS kind FROM part),
c AS (SELECT p_partkey, 'NaCl' AS name, CASE WHEN {_SALT('p_partkey')} = 'NaCl' THEN p_size ELSE p_size + 0.5 END::DOUBLE AS concentration FROM r WHERE kind = 0
UNION ALL SELECT p_partkey, {_SALT('p_partkey')}, p_size FROM r WHERE kind = 0 AND {_SALT('p_partkey')} <> 'NaCl' UNION ALL SELECT p_partkey, 'biotin', 2 FROM r WHERE kind = 0
UNION ALL SELECT p_partkey, x, 0 FROM (SELECT *, unnest(['FeSO4', 'Agar']) AS x FROM r) WHERE kind = 1)
SELECT p_partkey, solution_name, name, concentration FROM r JOIN c USING (p_partkey)""")
def solution_text_rows(t: Tables) -> DataFrame:
    rows = solution_texts.parsed(_solutions(t), "p_partkey").select(F.col("solution_id").alias("p_partkey"), "solution_name", F.explode_outer("composition").alias("c"))
    # explode() would have the size of the composition asked for before the rows are dealt out, in few tasks.
    return rows.where("c IS NOT NULL").select("p_partkey", "solution_name", "c.name", "c.concentration")


@query("table_components", f"SELECT p_partkey, 'sodium chloride' AS name, p_size + 0.5::DOUBLE AS concentration, 'g' AS unit FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, {_SALT('p_partkey')}, p_size, 'mg' FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, 'biotin', 2, 'mg' FROM part WHERE p_partkey % 2 = 0")
def table_components(t: Tables) -> DataFrame:
    rows = _solutions(t).select("p_partkey", F.explode(solution_texts.table_components(F.col("text"))).alias("r"))
    return rows.select("p_partkey", "r.*")


_TAILS = ["(Difco)", "x 7 H2O", "", ". 2 H2O"]
_tail = lambda n: F.element_at(F.array(*map(F.lit, _TAILS)), (n % len(_TAILS) + 1).cast("int"))


@query("cleaned_compounds", f"SELECT p_partkey, trim({replaced_sql('concat(p_size, chr(46) || chr(32), ' + _SALT('p_partkey') + f', chr(32), ({_TAILS})[p_size % {len(_TAILS)} + 1])', mining.CLEAN_CHAIN)}) AS name FROM part")
def cleaned_compounds(t: Tables) -> DataFrame:
    raw: Column = _text(F.col("p_size"), ". ", _salt(F.col("p_partkey")), " ", _tail(F.col("p_size")))
    return t.dealt("part").select("p_partkey", mining.cleaned(raw).alias("name"))


def _recipes(t: Tables) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    head = F.when(s % 2 == 0, "Ingredients\nPeptone\n").otherwise("Notes\nPeptone\n")
    lines = _text(_salt(k), " ", s, ".5 g/L and Yeast extract ", s, " mg\n1. Dissolve ", s, " g Resazurin, then boil.\nStock solution 2: ", _salt(k + 1), " and H3BO3. Done\n")
    return t.dealt("part").select("p_partkey", F.concat(head, lines).alias("text"))


@query("mined_ingredients", f"""
WITH r AS (SELECT * FROM part), m AS (
SELECT p_partkey, {_SALT('p_partkey')} AS name, p_size + 0.5::DOUBLE AS concentration, 'g/L' AS unit, 'inline' AS strategy FROM r
UNION ALL SELECT p_partkey, 'Yeast extract', p_size, 'mg', 'inline' FROM r UNION ALL SELECT p_partkey, 'Resazurin', p_size, 'g', 'procedure' FROM r
UNION ALL SELECT p_partkey, {_SALT('(p_partkey + 1)')}, 0, 'unknown', 'solution' FROM r UNION ALL SELECT p_partkey, 'H3BO3', 0, 'unknown', 'solution' FROM r
UNION ALL SELECT p_partkey, 'Peptone', 0, 'unknown', 'compound_list' FROM r WHERE p_size % 2 = 0)
SELECT * FROM m WHERE concentration > 0 OR strategy <> 'procedure'""")
def mined_ingredients(t: Tables) -> DataFrame:
    return _recipes(t).select("p_partkey", F.explode(mining.all_ingredients(F.col("text"))).alias("i")).select("p_partkey", "i.*")


@query("mined_strategies", """
WITH n AS (SELECT p_partkey, unnest(['inline', 'procedure', 'solution', 'compound_list']) AS strategy, unnest([2, 1, 2, 1 - p_size % 2]) AS k FROM part)
SELECT strategy, count(*) AS recipes, sum(k)::BIGINT AS ingredients FROM n WHERE k > 0 GROUP BY 1""")
def mined_strategies(t: Tables) -> DataFrame:
    rows = _recipes(t).select("p_partkey", F.explode(mining.every_ingredient(F.col("text"))).alias("i")).select("p_partkey", "i.strategy")
    counts = reports.strategy_counts(rows, "p_partkey", "strategy")
    return counts.select(F.explode("strategies").alias("strategy", "k")).groupBy("strategy").agg(F.count(F.lit(1)).alias("recipes"), F.sum("k").alias("ingredients"))


_UNIT_SIGNS = ["g", "mg", "ml", "mM"]
_ENDS = ["1. Dissolve it", "Then add water", "Final pH 7", "Page 2"]


@query("mined_blocks", f"""
WITH r AS (SELECT p_partkey, p_size AS s, {_SALT('p_partkey')} AS salt, p_size % 4 AS k FROM part),
b AS (SELECT p_partkey, salt AS name, s + 0.25 AS concentration, 0 AS place, * FROM r UNION ALL SELECT p_partkey, 'Magnesium sulfate', s, 1, * FROM r UNION ALL SELECT p_partkey, 'Beef extract', 2, 2, * FROM r WHERE k >= 2)
SELECT p_partkey, name, concentration::DOUBLE AS concentration, CASE WHEN k < 2 AND place = 1 THEN 'g/L' ELSE (['g/L', 'mg/L', 'ml/L', 'mM'])[s % 4 + 1] END AS unit FROM b""")
def mined_blocks(t: Tables) -> DataFrame:
    """Blocks of names, amounts and units that end early, late or never, with lines between that say nothing."""
    k, s = F.col("p_partkey"), F.col("p_size")
    sign = lambda xs, n: F.element_at(F.array(*map(F.lit, xs)), (n % len(xs) + 1).cast("int"))
    third = s % 4 >= 2
    names = _text("Medium ", k, " of page 7\n", _salt(k), " (Difco)\nwater\nMagnesium sulfate\n", F.when(third, "Beef extract (Oxoid)\nFinal volume 1\n").otherwise(""))
    amounts = _text(s, ".25\nabout\n", s, "\n", F.when(third, "2\n0\n").otherwise(""))
    unit = sign(_UNIT_SIGNS, s)
    units = F.when(third, _text(unit, "\n", unit, "\n", unit, "\n")).otherwise(_text(unit, "\n"))
    text = _text(F.regexp_replace(names, "^Medium [^\n]*\n", ""), "\n", amounts, units, sign(_ENDS, k), "\n", "KCl\n5\n")
    return t.dealt("part").select("p_partkey", F.explode(mining.tabular(text)).alias("i")).select("p_partkey", "i.name", "i.concentration", "i.unit")


@query("mined_solutions", f"""
WITH r AS (SELECT p_partkey, {_SALT('p_partkey')} AS salt, p_size % 3 AS k FROM part)
SELECT p_partkey, unnest(CASE k WHEN 0 THEN [salt, 'Sodium chloride', 'Magnesium sulfate'] WHEN 1 THEN ['Boric acid', salt] ELSE ['Zinc sulfate'] END) AS name FROM r""")
def mined_solutions(t: Tables) -> DataFrame:
    """Formulas and named compounds of solutions told of in each of three ways."""
    k, salt = F.col("p_size") % 3, _salt(F.col("p_partkey"))
    text = F.when(k == 0, _text("Solution A: Sodium chloride and Magnesium sulfate with ", salt, ". More\n")).when(k == 1, _text("Stock solution 3: ", salt, " and Boric acid. Dilute")).otherwise("No water. Zinc sulfate solution (sterile) is made")
    return t.dealt("part").select("p_partkey", F.explode(mining.solutions(text)).alias("i")).select("p_partkey", "i.name")


#: Kinds of recipe text: table before procedure, procedure first, table closed and opened again, title with embedded names.
_ROUTED = f"""
WITH r AS (SELECT p_partkey AS k, p_size % 4 AS kind, p_size + 0.5 AS a, p_size + 1 AS s, {_SALT('p_partkey')} AS salt FROM part)"""


def _routed(t: Tables) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    table = _text(_salt(k), "\nMagnesium sulfate\n", s, ".5\n", s + 1, "\nmg\nml\n")
    title = _text(k, ". MARINE MEDIUM: Tryptone Yeast water KNO-X Sodium pH 7\n")
    text = F.when(s % 4 == 0, F.concat(_text("see below\n© page\n"), table, _text("Final pH 7\n5\nmg\n1. Dissolve Agar\nKCl 3 g/L\n")))
    text = text.when(s % 4 == 1, F.concat(_text("Note: none\n"), table))
    text = text.when(s % 4 == 2, F.concat(_text("7\nBoric acid 2 mM\nFinal volume 1\n9\n"), table, _text("Reference: a\n")))
    return t.dealt("part").select("p_partkey", text.otherwise(F.concat(title, _text("12\n- Beef extract ", s + 1, " g/L\nheat\n"))).alias("text"))


@query("routed_lines", _ROUTED + """, l AS (
SELECT k, CASE kind WHEN 0 THEN [salt, 'Magnesium sulfate', a::VARCHAR, s::VARCHAR, 'mg', 'ml'] WHEN 1 THEN []
  WHEN 2 THEN ['Boric acid 2 mM', salt, 'Magnesium sulfate', a::VARCHAR, s::VARCHAR, 'mg', 'ml'] ELSE ['Tryptone Yeast', concat('- Beef extract ', s, ' g/L')] END AS ingredients,
CASE kind WHEN 0 THEN ['see below', 'Final pH 7', '5', 'mg', '1. Dissolve Agar', 'KCl 3 g/L'] WHEN 1 THEN ['Note: none', salt, 'Magnesium sulfate', a::VARCHAR, s::VARCHAR, 'mg', 'ml']
  WHEN 2 THEN ['7', 'Final volume 1', '9', 'Reference: a'] ELSE [concat(k, '. MARINE MEDIUM: Tryptone Yeast water KNO-X Sodium pH 7'), '12', 'heat'] END AS instructions FROM r)
SELECT k AS p_partkey, array_to_string(ingredients, ' | ') AS ingredients, array_to_string(instructions, ' ') AS instructions FROM l""")
def routed_lines(t: Tables) -> DataFrame:
    return _routed(t).select("p_partkey", F.array_join(routing.routed(F.col("text"))["ingredients"], " | ").alias("ingredients"), routing.instructions(F.col("text")).alias("instructions"))


@query("routed_ingredients", _ROUTED + """
SELECT k AS p_partkey, salt AS name, a::DOUBLE AS concentration, 'mg/L' AS unit, 'tabular' AS extraction_method FROM r WHERE kind = 0
UNION ALL SELECT k, 'Magnesium sulfate', s, 'ml/L', 'tabular' FROM r WHERE kind = 0
UNION ALL SELECT k, 'Boric acid', 2, 'mM', 'inline' FROM r WHERE kind = 2
UNION ALL SELECT k, salt, a, 'mg/L', 'tabular' FROM r WHERE kind = 2 UNION ALL SELECT k, 'Magnesium sulfate', s, 'ml/L', 'tabular' FROM r WHERE kind = 2
UNION ALL SELECT k, 'Tryptone Yeast', NULL, NULL, 'list' FROM r WHERE kind = 3 UNION ALL SELECT k, 'Beef extract', s, 'g/L', 'inline' FROM r WHERE kind = 3""")
def routed_ingredients(t: Tables) -> DataFrame:
    return _routed(t).select("p_partkey", F.explode(routing.routed_ingredients(F.col("text"))).alias("i")).select("p_partkey", "i.*")
