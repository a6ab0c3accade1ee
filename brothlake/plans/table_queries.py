"""Merges, splits, deduplication, expansion and reports of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import reports, tables
from .registry import Tables, query

_MATCHES = """(SELECT concat('c', o_custkey) AS original_compound, arg_max(CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat('CHEBI:', o_orderkey) END, o_orderkey) AS chebi_id, arg_max(['very_high', 'high', 'medium', 'low'][o_orderkey % 4 + 1], o_orderkey) AS match_confidence
  FROM orders WHERE o_orderkey % 5 < 3 GROUP BY 1 UNION ALL SELECT concat('extra', r_regionkey), concat('CHEBI:', r_regionkey), 'high' FROM region)"""
_MERGED = f"""m AS (SELECT original_compound, chebi_id, match_confidence FROM {_MATCHES}),
c AS (SELECT concat('m', c_nationkey) AS medium_id, concat('c', c_custkey) AS original, CASE WHEN c_custkey % 3 = 0 THEN concat('CHEBI:', c_custkey) WHEN c_custkey % 3 = 1 THEN '' END AS mapped FROM customer),
u AS (SELECT medium_id, original, coalesce(nullif(trim(mapped), ''), chebi_id) AS mapped, chebi_id, match_confidence FROM c LEFT JOIN m ON original = original_compound
  UNION ALL SELECT 'multiple', original_compound, chebi_id, chebi_id, match_confidence FROM m WHERE original_compound NOT IN (SELECT original FROM c)),
s AS (SELECT *, CASE WHEN nullif(mapped, '') IS NOT NULL AND nullif(chebi_id, '') IS NOT NULL THEN CASE WHEN mapped = chebi_id THEN 'original_and_chebi_match' ELSE 'original_plus_chebi_alternative' END WHEN nullif(mapped, '') IS NOT NULL THEN 'original_only' WHEN nullif(chebi_id, '') IS NOT NULL THEN 'chebi_only' ELSE 'unmapped' END AS mapping_status FROM u),
q AS (SELECT *, CASE mapping_status WHEN 'original_and_chebi_match' THEN 'excellent' WHEN 'original_plus_chebi_alternative' THEN 'very_good' WHEN 'original_only' THEN 'good' ELSE 'none' END AS mapping_quality FROM s)"""


def matches(t: Tables) -> DataFrame:
    label = F.element_at(F.array(*map(F.lit, ["very_high", "high", "medium", "low"])), (F.col("o_orderkey") % 4 + 1).cast("int"))
    found = t.orders.where("o_orderkey % 5 < 3").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("original_compound"), F.col("o_orderkey").alias("pos"), F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.concat(F.lit("CHEBI:"), F.col("o_orderkey").cast("string"))).alias("chebi_id"), label.alias("match_confidence"))
    region = F.col("r_regionkey").cast("string")
    return found.unionByName(t.region.select(F.concat(F.lit("extra"), region).alias("original_compound"), F.lit(0).cast("long").alias("pos"), F.concat(F.lit("CHEBI:"), region).alias("chebi_id"), F.lit("high").alias("match_confidence")))


def unified(t: Tables) -> DataFrame:
    mapped = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("CHEBI:"), F.col("c_custkey").cast("string"))).when(F.col("c_custkey") % 3 == 1, " ")
    rows = t.customer.select(F.concat(F.lit("m"), F.col("c_nationkey").cast("string")).alias("medium_id"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("original"), mapped.alias("mapped"))
    merged = tables.merged(tables.require(rows, ["medium_id", "original", "mapped"]), matches(t))
    return tables.with_status(merged)


@query("unified_mapping", f"WITH {_MERGED} SELECT medium_id, original, mapped, chebi_id, match_confidence, mapping_status, mapping_quality FROM q")
def unified_mapping(t: Tables) -> DataFrame:
    return unified(t).select("medium_id", "original", "mapped", "chebi_id", "match_confidence", "mapping_status", "mapping_quality")


@query("status_histogram", f"WITH {_MERGED} SELECT mapping_status, mapping_quality, count(*) AS n FROM q GROUP BY 1, 2")
def status_histogram(t: Tables) -> DataFrame:
    return unified(t).groupBy("mapping_status", "mapping_quality").agg(F.count(F.lit(1)).alias("n"))


@query("medium_statistics", f"""WITH {_MERGED} SELECT medium_id, count(*) AS total, count(nullif(mapped, '')) AS mapped_rows, round(100.0::DOUBLE * count(nullif(mapped, '')) / count(*), 1) AS rate, count(nullif(chebi_id, '')) AS chebi_matches,
  count(*) FILTER (match_confidence = 'very_high') AS very_high, count(*) FILTER (match_confidence = 'high') AS high, count(*) FILTER (mapping_quality = 'excellent') AS excellent, count(*) FILTER (mapping_quality = 'good') AS good FROM q GROUP BY 1""")
def medium_statistics(t: Tables) -> DataFrame:
    has = lambda c: F.nullif(F.col(c), F.lit(""))
    n = F.count(F.lit(1))
    return unified(t).groupBy("medium_id").agg(
        n.alias("total"), F.count(has("mapped")).alias("mapped_rows"), F.round(100.0 * F.count(has("mapped")) / n, 1).alias("rate"), F.count(has("chebi_id")).alias("chebi_matches"),
        *[F.count_if(F.col("match_confidence") == x).alias(x) for x in ("very_high", "high")], *[F.count_if(F.col("mapping_quality") == x).alias(x) for x in ("excellent", "good")],
    )


@query("retention", f"WITH {_MERGED}, f AS (SELECT *, coalesce(match_confidence IN ('high', 'very_high') OR mapping_status = 'original_only', false) AND mapping_status <> 'unmapped' AS high FROM q) SELECT high, count(*) AS n, count(DISTINCT medium_id) AS media, count(DISTINCT original) AS originals FROM f GROUP BY 1")
def retention(t: Tables) -> DataFrame:
    high, low = tables.split_confident(unified(t))
    rows = high.withColumn("high", F.lit(True)).unionByName(low.withColumn("high", F.lit(False)))
    return rows.groupBy("high").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("medium_id").alias("media"), F.countDistinct("original").alias("originals"))


@query("unified_order", f"WITH {_MERGED} SELECT mapping_quality, medium_id, original FROM q ORDER BY mapping_quality, medium_id, original")
def unified_order(t: Tables) -> DataFrame:
    return unified(t).select("mapping_quality", "medium_id", "original").orderBy("mapping_quality", "medium_id", "original")


@query("unified_sorted", f"WITH {_MERGED} SELECT mapping_quality, medium_id, original FROM q ORDER BY mapping_quality, medium_id, original")
def unified_sorted(t: Tables) -> DataFrame:
    return unified(t).select("mapping_quality", "medium_id", "original").orderBy("mapping_quality", "medium_id", "original")


@query("best_per_name", """
WITH r AS (SELECT l_partkey, l_orderkey, l_linenumber, ['excellent', 'good', 'poor', NULL][l_linenumber % 4 + 1] AS quality, l_quantity AS score FROM lineitem),
k AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY CASE quality WHEN 'excellent' THEN 0 WHEN 'good' THEN 1 WHEN 'poor' THEN 2 ELSE 3 END, score DESC, l_orderkey, l_linenumber) AS n FROM r)
SELECT l_partkey, l_orderkey, l_linenumber, quality, score FROM k WHERE n = 1""")
def best_per_name(t: Tables) -> DataFrame:
    quality = F.element_at(F.array(*map(F.lit, ["excellent", "good", "poor", None])), F.col("l_linenumber") % 4 + 1)
    rows = t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", quality.alias("quality"), F.col("l_quantity").alias("score"))
    return tables.best_per_name(rows, "l_partkey", tables.ranked(F.col("quality"), ["excellent", "good", "poor"]), F.desc("score"), F.asc("l_orderkey"), F.asc("l_linenumber"))


@query("two_level_dedup", """
WITH e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, value ORDER BY event_id) AS n FROM events) WHERE n = 1)
SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC NULLS LAST, event_id) AS k FROM e) WHERE k = 1""")
def two_level_dedup(t: Tables) -> DataFrame:
    return tables.without_duplicates(t.events, ["user_id", "event_type"], ["user_id", "event_type", "value"], F.col("value"), "event_id").select("event_id", "user_id", "event_type")


_SOLUTIONS = """(SELECT l_suppkey AS sid, concat('comp', l_partkey % 50) AS name, min(l_extendedprice) AS conc FROM lineitem GROUP BY 1, 2)"""


@query("expanded_solutions", f"""
WITH r AS (SELECT o_orderkey, o_custkey % 100 AS medium_id, o_orderpriority AS original, CASE WHEN o_orderkey % 3 = 0 THEN concat('CHEBI:', o_orderkey) ELSE concat('solution:', o_orderkey % 120) END AS mapped, o_totalprice AS value, ['ml/L', 'g/L', 'drops'][o_orderkey % 3 + 1] AS unit FROM orders),
s AS {_SOLUTIONS}
SELECT o_orderkey, original, round(value, 1) AS value, unit, 'direct' AS expansion_status FROM r WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, name, round(CASE WHEN unit IN ('ml/L', 'g/L') THEN conc * value / 1000 ELSE conc END, 1), 'g/L', 'expanded' FROM r JOIN s ON mapped = concat('solution:', sid)
UNION ALL SELECT o_orderkey, original, round(value, 1), unit, 'unresolved' FROM r WHERE o_orderkey % 3 > 0 AND mapped NOT IN (SELECT concat('solution:', sid) FROM s)""")
def expanded_solutions(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    mapped = F.when(key % 3 == 0, F.concat(F.lit("CHEBI:"), key.cast("string"))).otherwise(F.concat(F.lit("solution:"), (key % 120).cast("string")))
    unit = F.element_at(F.array(*map(F.lit, ["ml/L", "g/L", "drops"])), (key % 3 + 1).cast("int"))
    rows = t.orders.select("o_orderkey", (F.col("o_custkey") % 100).alias("medium_id"), F.col("o_orderpriority").alias("original"), mapped.alias("mapped"), F.col("o_totalprice").alias("value"), unit.alias("unit"))
    parts = t.lineitem.groupBy("l_suppkey", F.concat(F.lit("comp"), (F.col("l_partkey") % 50).cast("string")).alias("name")).agg(F.min("l_extendedprice").alias("concentration"))
    solutions = parts.groupBy(F.col("l_suppkey").cast("string").alias("solution_id")).agg(F.collect_list(F.struct("name", "concentration", F.lit("g/L").alias("unit"))).alias("composition"))
    return tables.expanded_solutions(rows, solutions).select("o_orderkey", "original", F.round("value", 1).alias("value"), "unit", "expansion_status")


@query("expanded_all_lines", """
WITH r AS (SELECT o_orderkey, o_custkey % 100 AS medium_id, o_orderpriority AS original, CASE WHEN o_orderkey % 3 = 0 THEN concat('CHEBI:', o_orderkey) WHEN o_orderkey % 4 = 0 THEN concat('solution:none', o_orderkey % 120) ELSE concat('solution:', o_orderkey % 120) END AS mapped, o_totalprice AS value, ['ml/L', 'g/L', 'drops'][o_orderkey % 3 + 1] AS unit FROM orders),
s AS (SELECT l_suppkey AS sid, concat('comp', l_partkey % 50) AS name, min(l_extendedprice) AS conc FROM lineitem GROUP BY 1, 2)
SELECT o_orderkey, original, round(value, 1) AS value, unit, 'direct' AS expansion_status FROM r WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, name, round(CASE WHEN unit IN ('ml/L', 'g/L') THEN conc * value / 1000 ELSE conc END, 1), 'g/L', 'expanded' FROM r JOIN s ON mapped = concat('solution:', sid)
UNION ALL SELECT o_orderkey, original, round(value, 1), unit, 'unresolved' FROM r WHERE o_orderkey % 3 > 0 AND mapped NOT IN (SELECT concat('solution:', sid) FROM s)""")
def expanded_all_lines(t: Tables) -> DataFrame:
    """Solutions of all lines of all suppliers; the unresolved ones have ids that no supplier has."""
    key = F.col("o_orderkey")
    number = (key % 120).cast("string")
    mapped = F.when(key % 3 == 0, F.concat(F.lit("CHEBI:"), key.cast("string"))).when(key % 4 == 0, F.concat(F.lit("solution:none"), number)).otherwise(F.concat(F.lit("solution:"), number))
    unit = F.element_at(F.array(*map(F.lit, ["ml/L", "g/L", "drops"])), (key % 3 + 1).cast("int"))
    rows = t.orders.select("o_orderkey", (F.col("o_custkey") % 100).alias("medium_id"), F.col("o_orderpriority").alias("original"), mapped.alias("mapped"), F.col("o_totalprice").alias("value"), unit.alias("unit"))
    parts = t.lineitem.groupBy("l_suppkey", F.concat(F.lit("comp"), (F.col("l_partkey") % 50).cast("string")).alias("name")).agg(F.min("l_extendedprice").alias("concentration"))
    solutions = parts.groupBy(F.col("l_suppkey").cast("string").alias("solution_id")).agg(F.collect_list(F.struct("name", "concentration", F.lit("g/L").alias("unit"))).alias("composition"))
    return tables.expanded_solutions(rows, solutions).select("o_orderkey", "original", F.round("value", 1).alias("value"), "unit", "expansion_status")


@query("upserted_names", """
WITH old AS (SELECT s_name AS name, s_acctbal AS weight FROM supplier WHERE s_suppkey % 2 = 0), new AS (SELECT upper(s_name) AS name, s_acctbal + 1 AS weight FROM supplier WHERE s_suppkey % 3 = 0)
SELECT name, round(weight, 4) AS weight FROM old UNION ALL SELECT name, round(weight, 4) FROM new WHERE lower(name) NOT IN (SELECT lower(name) FROM old)""")
def upserted_names(t: Tables) -> DataFrame:
    old = t.supplier.where("s_suppkey % 2 = 0").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("weight"))
    new = t.supplier.where("s_suppkey % 3 = 0").select(F.upper("s_name").alias("name"), (F.col("s_acctbal") + 1).alias("weight"))
    return tables.upserted(old, new, "name").withColumn("weight", F.round("weight", 4))


@query("patched_rows", "SELECT p.p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'patched' ELSE p_name END AS p_name, CASE WHEN p_partkey % 10 = 0 THEN -1 ELSE p_size END AS p_size FROM part p")
def patched_rows(t: Tables) -> DataFrame:
    updates = t.part.where("p_partkey % 5 = 0").select("p_partkey", F.lit("patched").alias("p_name"), F.when(F.col("p_partkey") % 10 == 0, -1).alias("p_size"))
    return tables.patched(t.part.select("p_partkey", "p_name", "p_size"), updates, "p_partkey")


@query("table_diff", """
WITH a AS (SELECT lower(s_name) AS name, s_acctbal AS w FROM supplier WHERE s_suppkey % 3 < 2), b AS (SELECT lower(s_name) AS name, s_acctbal * (1 + (s_suppkey % 4) / 30.0) AS w FROM supplier WHERE s_suppkey % 3 > 0)
SELECT change, count(*) AS n FROM (SELECT CASE WHEN b.name IS NULL THEN 'new' WHEN a.name IS NULL THEN 'gone' WHEN abs(a.w - b.w) > 0.05 * b.w THEN 'conflict' ELSE 'same' END AS change FROM a FULL JOIN b ON a.name = b.name) GROUP BY 1""")
def table_diff(t: Tables) -> DataFrame:
    new = t.supplier.where("s_suppkey % 3 < 2").select("s_name", F.col("s_acctbal").alias("w"))
    old = t.supplier.where("s_suppkey % 3 > 0").select("s_name", (F.col("s_acctbal") * (1 + (F.col("s_suppkey") % 4) / 30.0)).alias("w"))
    return tables.compared(new, old, "s_name", "w").groupBy("change").agg(F.count(F.lit(1)).alias("n"))


@query("bucket_histogram", "SELECT (n // 10 * 10)::BIGINT AS bucket, count(*) AS n_groups FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) GROUP BY 1")
def bucket_histogram(t: Tables) -> DataFrame:
    return reports.bucket_histogram(t.lineitem, "l_partkey")


@query("quality_buckets", "SELECT CASE WHEN n >= 10 THEN 'high' WHEN n >= 5 THEN 'medium' WHEN n >= 2 THEN 'low' ELSE 'very_low' END AS bucket, count(*) AS n FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) GROUP BY 1")
def quality_buckets(t: Tables) -> DataFrame:
    sizes = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("k"))
    return sizes.groupBy(reports.quality_bucket(F.col("k")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("described_columns", """SELECT 'l_quantity' AS metric, round(avg(l_quantity), 4) AS mean, round(stddev_samp(l_quantity), 4) AS std, min(l_quantity) AS least, max(l_quantity) AS most FROM lineitem
UNION ALL SELECT 'l_discount', round(avg(l_discount), 4), round(stddev_samp(l_discount), 4), min(l_discount), max(l_discount) FROM lineitem""")
def described_columns(t: Tables) -> DataFrame:
    return reports.described(t.lineitem, ["l_quantity", "l_discount"]).withColumn("mean", F.round("mean", 4)).withColumn("std", F.round("std", 4))


@query("column_profile", "SELECT 'source' AS name, count(*) FILTER (source IS NULL) AS nulls, count(*) FILTER (trim(source) = '') AS blanks, count(DISTINCT source) AS \"distinct\" FROM documents UNION ALL SELECT 'lang', count(*) FILTER (lang IS NULL), count(*) FILTER (trim(lang) = ''), count(DISTINCT lang) FROM documents")
def column_profile(t: Tables) -> DataFrame:
    return reports.column_profile(t.documents, ["source", "lang"])


@query("numeric_first_order", "SELECT id, row_number() OVER (ORDER BY TRY_CAST(id AS BIGINT) IS NULL, TRY_CAST(id AS BIGINT), id) AS place FROM (SELECT CASE WHEN n_nationkey % 4 = 0 THEN concat('x', n_nationkey) ELSE n_nationkey::VARCHAR END AS id FROM nation)")
def numeric_first_order(t: Tables) -> DataFrame:
    ids = t.nation.select(F.when(F.col("n_nationkey") % 4 == 0, F.concat(F.lit("x"), F.col("n_nationkey").cast("string"))).otherwise(F.col("n_nationkey").cast("string")).alias("id"))
    return tables.numbered(ids, tables.numeric_first(F.col("id")))


@query("numbered_orders", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN concat('c', o_custkey, '-', o_orderkey) WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey::VARCHAR END AS id FROM orders)
SELECT o_orderkey, id, row_number() OVER (ORDER BY TRY_CAST(id AS BIGINT) IS NULL, TRY_CAST(id AS BIGINT) NULLS FIRST, id NULLS FIRST, o_orderkey) AS place FROM o""")
def numbered_orders(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    ids = t.orders.select("o_orderkey", F.when(k % 5 == 0, F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("-"), k.cast("string"))).when(k % 7 != 0, k.cast("string")).alias("id"))
    return tables.numbered(ids, [*tables.numeric_first(F.col("id")), k])


@query("top_counts", "SELECT l_shipdate::DATE::VARCHAR AS day, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, day LIMIT 10")
def top_counts(t: Tables) -> DataFrame:
    return reports.top_counts(t.lineitem, F.date_format("l_shipdate", "yyyy-MM-dd"), 10, "day")


@query("word_jaccard", """
WITH w AS (SELECT p_partkey, list_distinct(list_filter(string_split_regex(lower(p_name), '[^a-z0-9]+'), lambda w: w <> '')) AS a, list_distinct(list_filter(string_split_regex(lower(concat(p_type, ' ', p_name)), '[^a-z0-9]+'), lambda w: w <> '')) AS b FROM part)
SELECT p_partkey, round(len(list_intersect(a, b))::DOUBLE / len(list_distinct(list_concat(a, b))), 6) AS jaccard FROM w""")
def word_jaccard(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.round(reports.word_jaccard(F.col("p_name"), F.concat_ws(" ", "p_type", "p_name")), 6).alias("jaccard"))


@query("missing_compositions", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def missing_compositions(t: Tables) -> DataFrame:
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("download_targets", "SELECT DISTINCT p_brand AS name FROM part UNION SELECT DISTINCT s_name FROM supplier WHERE length(s_name) > 2")
def download_targets(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_brand").alias("name")).unionByName(t.supplier.where(F.length("s_name") > 2).select(F.col("s_name").alias("name"))).distinct().orderBy("name")


@query("seeded_sample", "SELECT p_partkey, p_name FROM part ORDER BY md5(concat(p_partkey, '-42')), p_partkey LIMIT 50")
def seeded_sample(t: Tables) -> DataFrame:
    """A sample of 50 rows that reruns repeat; the sampling is the feature."""
    return t.part.orderBy(F.md5(F.concat(F.col("p_partkey").cast("string"), F.lit("-42")).cast("binary")), "p_partkey").limit(50).select("p_partkey", "p_name")
