"""Resolution of ingredient names to ids: exact cascade, fuzzy argmax, graph-restricted matching, update joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nested import synonyms
from .contained import occurrences
from .similar import scored_pairs

#: More than there are ids: a tier and an id's place in one number.
TIER = 1 << 48


def first_rows(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in an order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def name_dictionary(nodes: DataFrame, normaliser: Callable[[Column], Column]) -> DataFrame:
    """key, tier, id for every name of the nodes (id, name, synonym, pos).

    Tier 1 are names as they are, 2 are synonyms, 3 are normalised names of
    both. Of equal keys in a tier the last position wins, as in a dictionary
    filled row by row; equal positions go to the larger id.
    """
    names = nodes.select("id", "pos", F.lit(1).alias("tier"), F.col("name").alias("key"))
    others = nodes.select("id", "pos", F.lit(2).alias("tier"), F.explode(synonyms(F.col("synonym"))).alias("key"))
    raw = names.unionByName(others)
    keyed = raw.unionByName(raw.select("id", "pos", F.lit(3).alias("tier"), normaliser(F.col("key")).alias("key"))).where("key IS NOT NULL AND key <> ''")
    return keyed.groupBy("key", "tier").agg(F.max(F.struct("pos", "id")).alias("last")).select("key", "tier", F.col("last.id").alias("id"))


def exact_cascade(names: DataFrame, nodes: DataFrame, name: str, normaliser: Callable[[Column], Column]) -> DataFrame:
    """names with mapped and match_tier: by name, else by synonym, else by normalised key; null if none fits.

    Each distinct name is looked up once, in one join over all tiers, so a hot
    name is shuffled as one row.
    """
    dictionary = name_dictionary(nodes, normaliser)
    distinct = names.select(F.col(name).alias("_name")).where("_name IS NOT NULL").distinct()
    probes = distinct.select("_name", F.explode(F.array(F.struct(F.lit(1).alias("tier"), F.col("_name").alias("key")), F.struct(F.lit(2).alias("tier"), F.col("_name").alias("key")), F.struct(F.lit(3).alias("tier"), normaliser(F.col("_name")).alias("key")))).alias("p")).select("_name", "p.*")
    best = probes.join(dictionary, ["tier", "key"]).groupBy("_name").agg(F.min(F.struct("tier", "id")).alias("best"))
    return names.join(best, names[name] == best["_name"], "left").drop("_name").withColumn("mapped", F.col("best.id")).withColumn("match_tier", F.col("best.tier")).drop("best")


def token_sorted(c: Column) -> Column:
    """Lower-cased alphanumeric words in order."""
    words = F.filter(F.split(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "), " "), lambda x: x != "")
    return F.array_join(F.array_sort(words), " ")


def fuzzy_best(left: DataFrame, right: DataFrame, left_name: str, right_name: str, least: int = 85, top: int = 1, prepared: Callable[[Column], Column] = F.lower) -> DataFrame:
    """For each distinct left name the ``top`` right names of the best ratio of at least ``least``, with score and rank; ties go to the smaller right name."""
    scored = scored_pairs(left, right, left_name, right_name, least, prepared, top=top)
    rank = F.row_number().over(Window.partitionBy("left_name").orderBy(F.desc("score"), "right_name"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= top).select("left_name", "right_name", "score", "rank")


def contained_best(left: DataFrame, right: DataFrame, left_name: str, right_name: str, least_length: int = 4) -> DataFrame:
    """For each distinct left name the longest right name found in it: exact ones score 100 at any length, others, of ``least_length`` or more, the share of the length."""
    b = right.select(F.lower(F.col(right_name)).alias("key"), F.col(right_name).alias("right_name")).where("key <> ''").groupBy("key").agg(F.min("right_name").alias("right_name"))
    a = left.select(F.col(left_name).alias("left_name")).where("left_name IS NOT NULL").distinct().withColumn("a", F.lower("left_name"))
    hits = occurrences(a, b.where(F.length("key") >= least_length), "a", "key").select(F.col("text").alias("a"), F.col("name").alias("key")).distinct()
    short = a.select("a", F.col("a").alias("key")).where(F.length("a") < least_length).distinct()
    found = a.join(hits.unionByName(short), "a").join(b, "key")
    score = F.when(F.col("key") == F.col("a"), F.lit(100.0)).otherwise(F.length("key") / F.length("a") * 100)
    return first_rows(found.withColumn("score", score), ["left_name"], F.desc("score"), F.asc("key")).select("left_name", "right_name", "score")


def respellings(key: Column) -> list[Column]:
    """Other spellings of a name, in the order in which they are tried."""
    swap = lambda c, old, new="": F.replace(c, F.lit(old), F.lit(new))
    return [swap(key, "-", " "), swap(key, " ", "-"), swap(key, "_", " "), swap(key, " "), swap(swap(key, "("), ")"), swap(swap(key, "["), "]")]


def respelled_best(left: DataFrame, right: DataFrame, left_name: str, right_name: str, pos: str, least_length: int = 4) -> DataFrame:
    """left_name, right_name and method of each distinct left name found in an index: exact, else respelled, else partial.

    The first respelling that the index has counts; partial is the first entry
    by ``pos`` that holds the name or is held by it, both of ``least_length``
    or more. Cases and outer blanks don't count.
    """
    key = lambda c: F.lower(F.trim(F.col(c)))
    first = F.min(F.struct(F.col("pos"), F.col("right_name"))).alias("first")
    b = right.select(key(right_name).alias("key"), F.col(right_name).alias("right_name"), F.col(pos).alias("pos")).where("key <> ''").groupBy("key").agg(first)
    a = left.select(F.col(left_name).alias("left_name")).where("left_name IS NOT NULL").distinct().withColumn("a", key("left_name")).where("a <> ''")
    spelled = a.select("left_name", F.posexplode(F.array(F.col("a"), *respellings(F.col("a")))).alias("tier", "key")).join(b, "key")
    whole = first_rows(spelled, ["left_name"], F.asc("tier")).select("left_name", F.col("first.right_name").alias("right_name"), F.when(F.col("tier") == 0, "exact").otherwise("respelled").alias("method"))
    rest = a.join(whole, "left_name", "left_anti").where(F.length("a") >= least_length)
    long = b.where(F.length("key") >= least_length)
    inside = lambda texts, text, names, name: occurrences(texts, names, text, name).select("text", "name").distinct()
    held = rest.join(inside(rest, "a", long, "key"), F.col("a") == F.col("text")).select("left_name", F.col("name").alias("key")).join(long, "key").select("left_name", "first")
    holding = inside(long, "key", rest, "a").join(long, F.col("text") == F.col("key")).groupBy("name").agg(F.min("first").alias("first"))
    holding = rest.join(holding, F.col("a") == F.col("name")).select("left_name", "first")
    partial = held.unionByName(holding).groupBy("left_name").agg(F.min("first").alias("first"))
    return whole.unionByName(partial.select("left_name", F.col("first.right_name").alias("right_name"), F.lit("partial").alias("method")))


def medium_components(edges: DataFrame, direct: bool = True, part_of: str = "biolink:has_part") -> DataFrame:
    """medium_id and component: what a medium holds through its solutions and, with ``direct``, itself. edges: subject, predicate, object."""
    parts = edges.where(F.col("predicate") == part_of).select("subject", "object")
    medium, solution = F.col("subject").startswith("medium:"), F.col("object").startswith("solution:")
    first = parts.where(medium & solution).select(F.col("subject").alias("medium_id"), F.col("object").alias("solution"))
    second = parts.where(F.col("subject").startswith("solution:")).select(F.col("subject").alias("solution"), F.col("object").alias("component"))
    hops = first.join(second, "solution").select("medium_id", "component")
    return (hops.unionByName(parts.where(medium & ~solution).select(F.col("subject").alias("medium_id"), F.col("object").alias("component"))) if direct else hops).distinct()


def matched_in_medium(names: DataFrame, components: DataFrame, nodes: DataFrame, name: str, medium: str, normaliser: Callable[[Column], Column]) -> DataFrame:
    """names with medium_match: the component of the row's own medium with that name, synonym or normalised key; ties by tier, then id.

    Ids are numbered in their order and compared by tier and number, so rows
    that match are grouped by hashing; a least text would have them all sorted.
    """
    from .tables import numbered

    placed = numbered(nodes.select("id", "name", "synonym").where("id IS NOT NULL"), [F.asc("id")], "place")
    keyed = lambda tier, key: F.struct(F.lit(tier).alias("tier"), key.alias("key"))
    others = synonyms(F.col("synonym"))
    dictionary = placed.select("id", "place", F.explode(F.concat(F.array(keyed(1, F.col("name")), keyed(2, normaliser(F.col("name")))), F.transform(others, lambda s: keyed(3, s)), F.transform(others, lambda s: keyed(4, normaliser(s))))).alias("p"))
    dictionary = dictionary.select("id", (F.col("p.tier") * F.lit(TIER) + F.col("place")).alias("rank"), "p.key")
    known = components.join(dictionary, components["component"] == dictionary["id"]).select("medium_id", "rank", "key")
    asked = names.select(F.col(medium).alias("medium_id"), F.col(name).alias("_name")).distinct()
    probes = asked.select("medium_id", "_name", F.explode(F.array_distinct(F.array("_name", normaliser(F.col("_name"))))).alias("key"))
    least = probes.join(known, ["medium_id", "key"]).groupBy(F.col("medium_id").alias("_medium"), "_name").agg((F.min("rank") % F.lit(TIER)).alias("place"))
    best = least.join(placed.select("place", F.col("id").alias("medium_match")), "place").drop("place")
    return names.join(best, names[medium].eqNullSafe(best["_medium"]) & names[name].eqNullSafe(best["_name"]), "left").drop("_medium", "_name")


def fuzzy_tier(names: DataFrame, candidates: DataFrame, name: str, normaliser: Callable[[Column], Column], least: int = 85, shared: list[str] | None = None) -> DataFrame:
    """name, the ``shared`` columns, id and score of the candidate (id, name, pos) most like each distinct name, as it is or normalised; of equal scores the first by pos.

    With ``shared`` only candidates of equal columns count, such as those of
    the row's own medium.
    """
    shared = shared or []
    ways = [scored_pairs(names, candidates.withColumnRenamed("name", "candidate"), name, "candidate", least, way, shared) for way in (lambda c: c, normaliser)]
    best = ways[0].unionByName(ways[1]).groupBy("left_name", "right_name", *shared).agg(F.max("score").alias("score"))
    found = best.join(candidates.withColumnRenamed("name", "right_name"), ["right_name", *shared])
    return first_rows(found, ["left_name", *shared], F.desc("score"), F.asc("pos"), F.asc("id")).select(F.col("left_name").alias(name), *shared, "id", "score")


def full_cascade(names: DataFrame, nodes: DataFrame, name: str, normaliser: Callable[[Column], Column], least: int = 85) -> DataFrame:
    """exact_cascade(), and for what it leaves the most similar name of a node (match_tier 4) of a ratio of at least ``least``."""
    exact = exact_cascade(names, nodes, name, normaliser)
    like = fuzzy_tier(exact.where("mapped IS NULL").select(name), nodes.select("id", "name", "pos"), name, normaliser, least).select(F.col(name).alias("_left"), F.col("id").alias("_like"))
    joined = exact.join(like, exact[name] == like["_left"], "left")
    return joined.withColumn("match_tier", F.when(F.col("mapped").isNull() & F.col("_like").isNotNull(), 4).otherwise(F.col("match_tier"))).withColumn("mapped", F.coalesce("mapped", "_like")).drop("_left", "_like")


def similar_in_medium(names: DataFrame, components: DataFrame, nodes: DataFrame, name: str, medium: str, normaliser: Callable[[Column], Column], least: int = 85) -> DataFrame:
    """matched_in_medium(), and for what it leaves the component of the row's own medium with the most similar name or synonym."""
    exact = matched_in_medium(names, components, nodes, name, medium, normaliser)
    spelled = nodes.select("id", "pos", F.explode(F.concat(F.array("name"), F.coalesce(synonyms(F.col("synonym")), F.array().cast("array<string>")))).alias("name")).where("name IS NOT NULL")
    known = components.join(spelled, components["component"] == spelled["id"]).select(F.col("medium_id").alias(medium), "id", "name", "pos").dropDuplicates([medium, "name"])
    like = fuzzy_tier(exact.where("medium_match IS NULL").select(name, medium), known, name, normaliser, least, [medium]).select(F.col(name).alias("_left"), F.col(medium).alias("_medium"), F.col("id").alias("_like"))
    joined = exact.join(like, (exact[name] == like["_left"]) & (exact[medium] == like["_medium"]), "left")
    return joined.withColumn("medium_match", F.coalesce("medium_match", "_like")).drop("_left", "_medium", "_like")


def preferred(df: DataFrame, by_medium: str = "medium_match", by_name: str = "string_match") -> DataFrame:
    """mapped and mapping_method: the match within the medium, else that by name."""
    method = F.when(F.col(by_medium).isNotNull(), "medium").when(F.col(by_name).isNotNull(), "string").otherwise("none")
    return df.withColumn("mapped", F.coalesce(by_medium, by_name)).withColumn("mapping_method", method)


def updated(df: DataFrame, changes: DataFrame, key: str, target: str, only: Column) -> DataFrame:
    """df with ``target`` set from changes (key, value) in the rows that ``only`` is true of; of repeated keys the smallest value counts."""
    new = changes.groupBy("key").agg(F.min("value").alias("_value")).withColumnRenamed("key", "_key")
    joined = df.join(new, df[key] == new["_key"], "left")
    return joined.withColumn(target, F.when(F.coalesce(only, F.lit(False)) & F.col("_value").isNotNull(), F.col("_value")).otherwise(F.col(target))).drop("_key", "_value")
