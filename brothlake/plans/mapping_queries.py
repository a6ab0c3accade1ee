"""Matching of names to ids: nations stand for the nodes of a graph, orders for media, parts for components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names, predicates
from ..functions.chains import bound, replaced_sql
from ..operators import contained, matching, reports
from ..sources.scratch import written
from .registry import Tables, query

_NODES_SQL = "(SELECT concat('CHEBI:', n_nationkey) AS id, n_nationkey AS pos, n_name AS name, concat('alias ', n_nationkey % 20, '| ', 'salt of ', n_regionkey, '||') AS synonym FROM nation)"
_ASKED_CASE = "CASE c_custkey % 6 WHEN 0 THEN concat('NATION_', c_nationkey) WHEN 1 THEN concat('alias ', c_nationkey % 20) WHEN 2 THEN concat('d-Nation_', c_nationkey, ' x ', 2, ' H2O') WHEN 3 THEN concat('salt of ', c_nationkey % 5) WHEN 4 THEN c_mktsegment END"


def nodes(t: Tables) -> DataFrame:
    return t.nation.select(F.concat(F.lit("CHEBI:"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_nationkey").alias("pos"), F.col("n_name").alias("name"), F.concat(F.lit("alias "), (F.col("n_nationkey") % 20).cast("string"), F.lit("| salt of "), F.col("n_regionkey").cast("string"), F.lit("||")).alias("synonym"))


def asked(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.expr(_ASKED_CASE).alias("original"))


_LOOSE = lambda c: f"trim({replaced_sql(f'trim(lower({c}))', names.LOOSE_CHAIN)})"
_DICTIONARY = f"""
nodes AS (SELECT * FROM {_NODES_SQL}), raw AS (SELECT id, pos, 1 AS tier, name AS key FROM nodes UNION ALL SELECT id, pos, 2, trim(unnest(string_split(synonym, '|'))) FROM nodes),
keyed AS (SELECT * FROM raw WHERE key <> '' UNION ALL SELECT id, pos, 3, {_LOOSE('key')} FROM raw WHERE key <> ''),
dictionary AS (SELECT key, tier, arg_max(id, pos) AS id FROM keyed WHERE key <> '' GROUP BY key, tier)"""
_CASCADE = f"""{_DICTIONARY},
asked AS (SELECT c_custkey, {_ASKED_CASE} AS original FROM customer),
mapped AS (SELECT a.c_custkey, a.original, coalesce(d1.id, d2.id, d3.id) AS mapped, CASE WHEN d1.id IS NOT NULL THEN 1 WHEN d2.id IS NOT NULL THEN 2 WHEN d3.id IS NOT NULL THEN 3 ELSE 0 END AS match_tier FROM asked a
  LEFT JOIN dictionary d1 ON d1.tier = 1 AND d1.key = original LEFT JOIN dictionary d2 ON d2.tier = 2 AND d2.key = original LEFT JOIN dictionary d3 ON d3.tier = 3 AND d3.key = {_LOOSE('original')})"""


def cascade(t: Tables) -> DataFrame:
    return matching.exact_cascade(asked(t), nodes(t), "original", names.loose_key).withColumn("match_tier", F.coalesce("match_tier", F.lit(0)))


query("exact_cascade", f"WITH {_CASCADE} SELECT * FROM mapped")(cascade)


@query("name_dictionary", f"WITH {_DICTIONARY} SELECT key, tier, id FROM dictionary")
def name_dictionary(t: Tables) -> DataFrame:
    return matching.name_dictionary(nodes(t), names.loose_key)


@query("mapping_rates", f"WITH {_CASCADE} SELECT match_tier, count(*) AS total, count(mapped) AS mapped_rows, round(100.0::DOUBLE * count(mapped) / count(*), 1) AS rate, count(DISTINCT original) AS originals, count(DISTINCT mapped) AS targets FROM mapped GROUP BY 1")
def mapping_rates(t: Tables) -> DataFrame:
    return reports.mapping_rates(cascade(t), ["match_tier"])


@query("mapping_rates_overall", f"WITH {_CASCADE} SELECT count(*) AS total, count(mapped) AS mapped_rows, round(100.0::DOUBLE * count(mapped) / count(*), 1) AS rate, count(DISTINCT original) AS originals, count(DISTINCT mapped) AS targets FROM mapped")
def mapping_rates_overall(t: Tables) -> DataFrame:
    return reports.mapping_rates(cascade(t), [])


@query("top_unmapped", f"WITH {_CASCADE} SELECT original, count(*) AS n FROM mapped WHERE mapped IS NULL AND original IS NOT NULL GROUP BY 1 ORDER BY n DESC, original LIMIT 10")
def top_unmapped(t: Tables) -> DataFrame:
    return reports.top_counts(cascade(t).where("mapped IS NULL"), F.col("original"), 10, "original")


_EDGES_SQL = """(SELECT concat('medium:', o_custkey % 300) AS subject, 'biolink:has_part' AS predicate, concat('solution:', o_orderkey) AS object FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT concat('solution:', l_orderkey), CASE WHEN l_linenumber = 7 THEN 'biolink:related_to' ELSE 'biolink:has_part' END, concat('CHEBI:', l_partkey) FROM lineitem
  UNION ALL SELECT concat('medium:', o_custkey % 300), 'biolink:has_part', concat('ingredient:', o_custkey % 11) FROM orders)"""


def edges(t: Tables) -> DataFrame:
    part_of = F.lit("biolink:has_part")
    text = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    medium = text("medium:", F.col("o_custkey") % 300)
    first = t.orders.where("o_orderkey % 3 = 0").select(medium.alias("subject"), part_of.alias("predicate"), text("solution:", F.col("o_orderkey")).alias("object"))
    second = t.lineitem.select(text("solution:", F.col("l_orderkey")).alias("subject"), F.when(F.col("l_linenumber") == 7, "biolink:related_to").otherwise(part_of).alias("predicate"), text("CHEBI:", F.col("l_partkey")).alias("object"))
    return first.unionByName(second).unionByName(t.orders.select(medium.alias("subject"), part_of.alias("predicate"), text("ingredient:", F.col("o_custkey") % 11).alias("object")))


_PARTS = f"""edges AS (SELECT subject, object FROM {_EDGES_SQL} WHERE predicate = 'biolink:has_part'),
hops AS (SELECT a.subject AS medium_id, b.object AS component FROM edges a JOIN edges b ON a.object = b.subject WHERE starts_with(a.subject, 'medium:') AND starts_with(a.object, 'solution:')),
parts AS (SELECT * FROM hops UNION SELECT subject, object FROM edges WHERE starts_with(subject, 'medium:') AND NOT starts_with(object, 'solution:'))"""


@query("medium_components", f"WITH {_PARTS} SELECT DISTINCT medium_id, component FROM parts")
def medium_components(t: Tables) -> DataFrame:
    return matching.medium_components(edges(t))


@query("medium_components_two_hops", f"WITH {_PARTS} SELECT DISTINCT medium_id, component FROM hops")
def medium_components_two_hops(t: Tables) -> DataFrame:
    return matching.medium_components(edges(t), direct=False)


@query("component_media", f"WITH {_PARTS} SELECT component, count(DISTINCT medium_id) AS media FROM parts GROUP BY 1")
def component_media(t: Tables) -> DataFrame:
    return matching.medium_components(edges(t)).groupBy("component").agg(F.count(F.lit(1)).alias("media"))


_IN_MEDIUM = f"""{_PARTS},
nodes AS (SELECT concat('CHEBI:', p_partkey) AS id, p_name AS name, concat(p_brand, '|', p_type) AS synonym FROM part),
keyed AS (SELECT id, 1 AS tier, name AS key FROM nodes UNION ALL SELECT id, 2, {_LOOSE('name')} FROM nodes UNION ALL SELECT id, 3, unnest(string_split(synonym, '|')) FROM nodes UNION ALL SELECT id, 4, {_LOOSE('s')} FROM (SELECT id, unnest(string_split(synonym, '|')) AS s FROM nodes)),
known AS (SELECT medium_id, id, tier, key FROM parts JOIN keyed ON component = id),
asked AS (SELECT p_partkey, concat('medium:', p_partkey % 300) AS medium_id, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_brand WHEN 2 THEN concat('D-', p_name) ELSE 'unknown salt' END AS original FROM part),
best AS (SELECT a.p_partkey, arg_min(k.id, (k.tier, k.id)) AS medium_match FROM asked a JOIN known k ON a.medium_id = k.medium_id AND (k.key = a.original OR k.key = {_LOOSE('a.original')}) GROUP BY 1),
by_name AS (SELECT name, min(id) AS string_match FROM nodes GROUP BY name),
paired AS (SELECT a.p_partkey, a.medium_id, a.original, b.medium_match, n.string_match FROM asked a LEFT JOIN best b USING (p_partkey) LEFT JOIN by_name n ON n.name = a.original)"""


def in_medium(t: Tables) -> DataFrame:
    chemicals = t.part.select(F.concat(F.lit("CHEBI:"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("name"), F.concat_ws("|", "p_brand", "p_type").alias("synonym"))
    original = F.when(F.col("p_partkey") % 4 == 0, F.col("p_name")).when(F.col("p_partkey") % 4 == 1, F.col("p_brand")).when(F.col("p_partkey") % 4 == 2, F.concat(F.lit("D-"), F.col("p_name"))).otherwise("unknown salt")
    rows = t.part.select("p_partkey", F.concat(F.lit("medium:"), (F.col("p_partkey") % 300).cast("string")).alias("medium_id"), original.alias("original"))
    found = matching.matched_in_medium(rows, matching.medium_components(edges(t)), chemicals, "original", "medium_id", names.loose_key)
    by_name = chemicals.groupBy("name").agg(F.min("id").alias("string_match"))
    return found.join(by_name, found["original"] == by_name["name"], "left").drop("name")


@query("medium_match", f"WITH {_IN_MEDIUM} SELECT p_partkey, medium_id, original, coalesce(medium_match, string_match) AS mapped, CASE WHEN medium_match IS NOT NULL THEN 'medium' WHEN string_match IS NOT NULL THEN 'string' ELSE 'none' END AS mapping_method FROM paired")
def medium_match(t: Tables) -> DataFrame:
    return matching.preferred(in_medium(t)).select("p_partkey", "medium_id", "original", "mapped", "mapping_method")


@query("method_agreement", f"""WITH {_IN_MEDIUM} SELECT count(*) AS total, count(medium_match) AS by_a, count(string_match) AS by_b, count(*) FILTER (medium_match IS NOT NULL AND string_match IS NOT NULL) AS both, count(*) FILTER (medium_match IS NOT NULL AND string_match IS NULL) AS only_a,
  count(*) FILTER (medium_match IS NULL AND string_match IS NOT NULL) AS only_b, count(*) FILTER (medium_match = string_match) AS agree, count(*) FILTER (medium_match <> string_match) AS disagree, count(*) FILTER (medium_match IS NULL AND string_match IS NULL) AS neither FROM paired""")
def method_agreement(t: Tables) -> DataFrame:
    return reports.agreement(in_medium(t), "medium_match", "string_match")


@query("update_join", """SELECT p_partkey, CASE WHEN m.v IS NOT NULL AND p_size > 10 THEN m.v ELSE concat('ingredient:', p_size) END AS mapped FROM part LEFT JOIN (SELECT p_brand AS k, min(concat('CHEBI:', p_partkey)) AS v FROM part WHERE p_partkey % 7 = 0 AND p_size < 25 GROUP BY 1) m ON m.k = p_brand""")
def update_join(t: Tables) -> DataFrame:
    changes = t.part.where("p_partkey % 7 = 0 AND p_size < 25").select(F.col("p_brand").alias("key"), F.concat(F.lit("CHEBI:"), F.col("p_partkey").cast("string")).alias("value"))
    rows = t.part.withColumn("mapped", F.concat(F.lit("ingredient:"), F.col("p_size").cast("string")))
    return matching.updated(rows, changes, "p_brand", "mapped", F.col("p_size") > 10).select("p_partkey", "mapped")


@query("contained_name", """
WITH b AS (SELECT lower(w) AS key, min(w) AS right_name FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) WHERE length(w) >= 4 GROUP BY 1), a AS (SELECT DISTINCT p_name AS left_name FROM part),
m AS (SELECT left_name, right_name, length(key) * 100.0::DOUBLE / length(left_name) AS s, key, lower(left_name) = key AS exact FROM a JOIN b ON contains(lower(left_name), key))
SELECT left_name, right_name, round(CASE WHEN exact THEN 100 ELSE s END, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY left_name ORDER BY exact DESC, s DESC, key) AS n FROM m) WHERE n = 1""")
def contained_name(t: Tables) -> DataFrame:
    words = t.part.select(F.explode(F.split("p_name", " ")).alias("word"))
    return matching.contained_best(t.part, words, "p_name", "word").withColumn("score", F.round("score", 6))


@query("contained_short_name", """
WITH b AS (SELECT DISTINCT w AS right_name FROM (SELECT unnest([left(p_name, 3), left(p_name, 2), split_part(p_name, ' ', 1)]) AS w FROM part)), a AS (SELECT DISTINCT unnest([left(p_name, 3), p_name]) AS left_name FROM part),
m AS (SELECT left_name, right_name, lower(left_name) = lower(right_name) AS exact, length(right_name) * 100.0::DOUBLE / length(left_name) AS s FROM a JOIN b ON lower(left_name) = lower(right_name) OR length(right_name) >= 4 AND contains(lower(left_name), lower(right_name)))
SELECT left_name, right_name, round(CASE WHEN exact THEN 100 ELSE s END, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY left_name ORDER BY exact DESC, s DESC, lower(right_name), right_name) AS n FROM m) WHERE n = 1""")
def contained_short_name(t: Tables) -> DataFrame:
    """Names of up to three letters, which match as a whole only, among longer ones."""
    asked = t.part.select(F.explode(F.array(F.substring("p_name", 1, 3), "p_name")).alias("asked"))
    known = t.part.select(F.explode(F.array(F.substring("p_name", 1, 3), F.substring("p_name", 1, 2), F.split_part("p_name", F.lit(" "), F.lit(1)))).alias("word"))
    return matching.contained_best(asked, known, "asked", "word").withColumn("score", F.round("score", 6))


_ASKED = "CASE p_partkey % 6 WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(p_name, ' ', '-') WHEN 2 THEN concat('(', p_name, ')') WHEN 3 THEN substring(p_name, 3, 100) WHEN 4 THEN concat(p_name, ' hydrate') ELSE concat('[', replace(p_name, ' ', '_'), ']') END"


@query("respelled_names", f"""
WITH b AS (SELECT lower(p_name) AS key, p_name AS right_name, min(p_partkey) AS pos FROM part GROUP BY 1, 2), a AS (SELECT DISTINCT {_ASKED} AS left_name FROM part),
k AS (SELECT left_name, lower(left_name) AS a FROM a),
v AS (SELECT left_name, unnest(range(7)) AS tier, unnest([a, replace(a, '-', ' '), replace(a, ' ', '-'), replace(a, '_', ' '), replace(a, ' ', ''), replace(replace(a, '(', ''), ')', ''), replace(replace(a, '[', ''), ']', '')]) AS key FROM k),
w AS (SELECT left_name, right_name, tier, row_number() OVER (PARTITION BY left_name ORDER BY tier) AS n FROM v JOIN b USING (key)),
p AS (SELECT left_name, right_name, row_number() OVER (PARTITION BY left_name ORDER BY pos) AS n FROM k JOIN b ON (contains(a, key) OR contains(key, a)) AND length(a) > 3 AND length(key) > 3 WHERE left_name NOT IN (SELECT left_name FROM w))
SELECT left_name, right_name, CASE WHEN tier = 0 THEN 'exact' ELSE 'respelled' END AS method FROM w WHERE n = 1 UNION ALL SELECT left_name, right_name, 'partial' FROM p WHERE n = 1""")
def respelled_names(t: Tables) -> DataFrame:
    return matching.respelled_best(t.part.select(F.expr(_ASKED).alias("asked")), t.part, "asked", "p_name", "p_partkey")


@query("containing_words", """
WITH w AS (SELECT DISTINCT lower(w) AS w FROM (SELECT unnest(list_slice(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), 1, 4)) AS w FROM documents) WHERE w <> '')
SELECT a.w AS name, b.w AS part FROM w a JOIN w b ON contains(a.w, b.w) AND a.w <> b.w AND length(b.w) >= 4""")
def containing_words(t: Tables) -> DataFrame:
    """Of the words that begin a document's text all pairs of which one holds the other."""
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)
    return contained.containing_pairs(t.documents.select(F.explode(F.slice(words, 1, 4)).alias("w")).select(F.lower("w").alias("w")).distinct(), "w")


@query("fuzzy_names")
def fuzzy_names(t: Tables) -> DataFrame:
    """The nearest other spelling of each part name: no SQL, for the ratio is no SQL function."""
    typos = t.part.select(F.concat(F.substring("p_name", 1, 3), F.substring("p_name", 5, 100)).alias("typo"))
    return matching.fuzzy_best(typos, t.part, "typo", "p_name", least=85, top=3)


@query("fuzzy_words")
def fuzzy_words(t: Tables) -> DataFrame:
    """For the longest word of each document the nearest of the next longest ones of all documents: no SQL, for the ratio is no SQL function."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[^\x20\x09-\x0D]+"), 0))
    # Only words as long as the fourth longest are put in order.
    fourth = lambda ws: F.get(F.sort_array(F.transform(ws, F.length), asc=False), F.least(F.size(ws), F.lit(4)) - 1)
    long = bound(words, lambda ws: bound(fourth(ws), lambda n: F.filter(ws, lambda w: F.length(w) >= n)))
    first = F.slice(F.transform(F.array_sort(F.transform(long, lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))), lambda x: x["w"]), 1, 4)
    ranked = written(t.dealt("documents").select(first.alias("words")), "longest-words")
    asked, known = ranked.select(F.get("words", F.lit(0)).alias("asked")), ranked.select(F.explode(F.slice("words", 2, 3)).alias("known"))
    return matching.fuzzy_best(asked, known, "asked", "known", least=85, top=3)


@query("class_coverage", """
WITH d AS (SELECT CASE WHEN doc_id % 6 = 0 THEN NULL ELSE concat(['CHEBI', 'PubChem', 'solution', 'x', 'medium'][doc_id % 5 + 1], ':', doc_id) END AS curie, source FROM documents)
SELECT CASE WHEN curie IS NULL THEN 'unmapped' WHEN starts_with(curie, 'x:') THEN 'other' ELSE split_part(curie, ':', 1) END AS entity, count(*) AS n, count(DISTINCT source) AS originals, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM d), 2) AS percent FROM d GROUP BY 1""")
def class_coverage(t: Tables) -> DataFrame:
    prefix = F.element_at(F.array(*map(F.lit, ["CHEBI", "PubChem", "solution", "x", "medium"])), (F.col("doc_id") % 5 + 1).cast("int"))
    rows = t.documents.select("source", F.when(F.col("doc_id") % 6 != 0, F.concat(prefix, F.lit(":"), F.col("doc_id").cast("string"))).alias("curie"))
    return reports.class_coverage(rows, "curie", "source")


@query("pattern_frequency", """
WITH n AS (SELECT p_name AS c, p_size % 2 = 0 AS flag FROM part), p AS (SELECT unnest(['ring', 'widget', 'hot_start']) AS pattern, unnest(['ring', 'wid.et', '^hot']) AS rx)
SELECT pattern, count(*) FILTER (flag) AS with_flag, count(*) FILTER (NOT flag) AS without_flag FROM n JOIN p ON regexp_matches(c, rx) GROUP BY 1""")
def pattern_frequency(t: Tables) -> DataFrame:
    return reports.pattern_frequency(t.part, "p_name", F.col("p_size") % 2 == 0, {"ring": "ring", "widget": "wid.et", "hot_start": "^hot"})


@query("confident_split", """
WITH r AS (SELECT l_orderkey, l_linenumber, ['very_high', 'high', 'medium', NULL][l_linenumber % 4 + 1] AS c, ['original_only', 'unmapped', 'chebi_only', NULL, 'original_and_chebi_match'][l_partkey % 5 + 1] AS s FROM lineitem)
SELECT coalesce((coalesce(c IN ('high', 'very_high'), false) OR coalesce(s = 'original_only', false)) AND s <> 'unmapped', false) AS confident, count(*) AS n, count(DISTINCT l_orderkey) AS media FROM r GROUP BY 1""")
def confident_split(t: Tables) -> DataFrame:
    c = F.element_at(F.array(*map(F.lit, ["very_high", "high", "medium", None])), F.col("l_linenumber") % 4 + 1)
    s = F.element_at(F.array(*map(F.lit, ["original_only", "unmapped", "chebi_only", None, "original_and_chebi_match"])), (F.col("l_partkey") % 5 + 1).cast("int"))
    rows = t.lineitem.select("l_orderkey", c.alias("c"), s.alias("s"))
    return rows.groupBy(predicates.is_confident(F.col("c"), F.col("s")).alias("confident")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("l_orderkey").alias("media"))


# Misspelled names, each of which is like one nation's name only.

_TYPO_SQL = "CASE WHEN c_custkey % 3 = 0 THEN concat('NATION_', c_nationkey) WHEN c_custkey % 3 = 1 THEN concat('NATIOM_', c_nationkey) ELSE concat('quite other ', c_nationkey) END"


@query("full_cascade", f"SELECT c_custkey, {_TYPO_SQL} AS original, CASE WHEN c_custkey % 3 < 2 THEN concat('CHEBI:', c_nationkey) END AS mapped, [1, 4, 0][c_custkey % 3 + 1] AS match_tier FROM customer")
def full_cascade(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.expr(_TYPO_SQL).alias("original"))
    return matching.full_cascade(rows, nodes(t), "original", names.loose_key).withColumn("match_tier", F.coalesce("match_tier", F.lit(0)))


_OWN_TYPO_SQL = _TYPO_SQL.replace("c_custkey % 3 = 0", "c_custkey % 3 = 0 AND c_nationkey % 5 = c_custkey % 5").replace("ELSE", "WHEN c_custkey % 3 = 0 THEN 'quite other' ELSE")


@query("similar_in_medium", f"SELECT c_custkey, {_OWN_TYPO_SQL} AS original, CASE WHEN c_custkey % 3 < 2 AND c_nationkey % 5 = c_custkey % 5 THEN concat('CHEBI:', c_nationkey) END AS medium_match FROM customer")
def similar_in_medium(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.expr(_OWN_TYPO_SQL).alias("original"), F.concat(F.lit("medium:"), (F.col("c_custkey") % 5).cast("string")).alias("medium_id"))
    parts = t.nation.select(F.concat(F.lit("medium:"), (F.col("n_nationkey") % 5).cast("string")).alias("medium_id"), F.concat(F.lit("CHEBI:"), F.col("n_nationkey").cast("string")).alias("component"))
    return matching.similar_in_medium(rows, parts, nodes(t), "original", "medium_id", names.loose_key).select("c_custkey", "original", "medium_match")
