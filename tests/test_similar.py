"""Pairs of similar names against all pairs, and how few pairs are looked at."""

import difflib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from brothlake.operators import letter_counts, matching, similar

BASE = ["sodium chloride", "Magnesium sulfate", "glucose", "aaaa", "aab", "été 2", "a", "zz top", "potassium dihydrogen phosphate", "日本 \U0001f600 agar"]


def typo(rng, x):
    return "".join(rng.choice([c, c, c, c, "", c + rng.choice("aeéx7 Z")]) for c in x)


def frame(spark, xs, c):
    return spark.createDataFrame([(x,) for x in [*xs, None, ""]], f"{c} string")


def subsequence(a, b):
    """The length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def score(a, b):
    return round(100 * difflib.SequenceMatcher(None, a, b).ratio())


@pytest.mark.parametrize("least", [60, 70, 85, 95, 100])
def test_equals_all_pairs(spark, least):
    """Names that differ by a few letters, repeated letters, capitals and letters of other scripts."""
    rng = random.Random(least)
    left, right = ([typo(rng, rng.choice(BASE)) for _ in range(60)] for _ in range(2))
    got = sorted((r.left_name, r.right_name, r.score) for r in similar.scored_pairs(frame(spark, left, "l"), frame(spark, right, "r"), "l", "r", least, lambda c: c).collect())
    assert got == sorted({(a, b, score(a, b)) for a in left if a for b in right if b and score(a, b) >= least})


@pytest.mark.parametrize("most_pairs", [1, 30, 1_000])
def test_split_keys_lose_and_repeat_nothing(spark, most_pairs):
    """Many names of the same letters: keys grow to their longest and are dealt in blocks."""
    rng = random.Random(most_pairs)
    words = ["".join(rng.sample("chlorates", 9)) for _ in range(40)] + ["ab", "ba", "abc", "b"] + [typo(rng, "chlorates") for _ in range(20)]
    left, right = words[::2] + ["ab"], words[1::2] + ["ab"]
    got = sorted((r.left_name, r.right_name, r.score) for r in similar.scored_pairs(frame(spark, left, "l"), frame(spark, right, "r"), "l", "r", 75, F.lower, most_pairs=most_pairs).collect())
    assert got == sorted({(a, b, score(a, b)) for a in left if a for b in right if b and score(a, b) >= 75})


def test_shared_columns(spark):
    left = spark.createDataFrame([("glucose", 1), ("glucosa", 2), ("glucose", None)], "l string, medium int")
    right = spark.createDataFrame([("glucose", 1), ("glucose", 2), ("fructose", 1), ("glucose", None)], "r string, medium int")
    got = sorted((r.left_name, r.right_name, r.medium, r.score) for r in similar.scored_pairs(left, right, "l", "r", 80, shared=["medium"]).collect())
    assert got == [("glucosa", "glucose", 2, 86), ("glucose", "glucose", 1, 100)]


def test_empty_tables(spark):
    none = frame(spark, [], "l")
    assert similar.scored_pairs(none, frame(spark, ["a"], "r"), "l", "r", 85).count() == 0
    assert matching.fuzzy_best(frame(spark, ["a"], "l"), frame(spark, [], "r"), "l", "r").count() == 0


def test_few_candidates(spark):
    """Of 20,000 names of spread letters under a twentieth of all pairs are looked at, and no task gets more pairs than it may."""
    rng = random.Random(9)
    letters = "".join(c * w for c, w in zip(similar.COMMON[:26], range(27, 1, -1)))
    names = ["".join(rng.choice(letters) for _ in range(rng.randrange(8, 26))) for _ in range(10_000)]
    names += [typo(rng, x) for x in names]
    side = lambda xs: spark.createDataFrame(list(enumerate(xs)), "id long, name string").withColumn("letters", similar.numbered_letters(F.col("name")))
    near = similar.candidates(side(names[:10_000]).cache(), side(names[10_000:]).cache(), 85)
    pairs = near.count()
    like = near.where("a = b").count()
    assert pairs < 0.05 * 10_000 * 10_000
    assert like >= sum(score(a, b) >= 85 for a, b in zip(names, names[10_000:]))


def test_words_of_documents(spark):
    from brothlake.plans.catalog import queries

    folder = "/root/testdata/sf0.001"
    words = [sorted(set(re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").lower())), key=lambda w: (-len(w), w)) for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()]
    asked, known = {w[0] for w in words if w}, {x for w in words for x in w[1:4]}
    best = [(a, *p) for a in asked for p in sorted(((score(a, k), k) for k in known if score(a, k) >= 85), key=lambda p: (-p[0], p[1]))[:3]]
    got = [(r.left_name, r.score, r.right_name) for r in queries()["fuzzy_words"](spark, folder).collect()]
    assert sorted(got) == sorted(best)


def test_signatures_part_no_similar_names(spark):
    """Bits differ in no more places than the unshared letters allow, and tell unlike names of the same few letters apart."""
    rng = random.Random(7)
    words = [x for x in (typo(rng, rng.choice(BASE)) for _ in range(80)) if x] + ["tionchen", "chention", "ab", "a"]
    told = spark.createDataFrame([(x,) for x in dict.fromkeys(words)], "w string").withColumn("l", similar.numbered_letters(F.col("w"))).select("w", "l", similar.signatures(F.col("w"), F.col("l")).alias("s")).collect()
    apart = lambda a, b, *xs: sum(((a.s[x] ^ b.s[x]) & (2**64 - 1)).bit_count() for x in xs)
    for a in told:
        for b in told:
            matched = sum(m.size for m in difflib.SequenceMatcher(None, a.w, b.w).get_matching_blocks())
            assert apart(a, b, "one", "two") <= len(a.w) + len(b.w) - 2 * len(set(a.l) & set(b.l))
            assert apart(a, b, "three", "four") <= 3 * (len(a.w) + len(b.w) - 2 * matched)


def test_work_is_dealt_by_names_and_pairs(spark, monkeypatch):
    """Names and keys of few bytes are still many tasks where the work on them is long, and nothing is lost."""
    monkeypatch.setattr(similar, "TASK_PAIRS", 10)
    rng = random.Random(3)
    words = ["".join(rng.sample("chlorates", 9)) for _ in range(40)]
    found = similar.scored_pairs(frame(spark, words[::2], "l"), frame(spark, words[1::2], "r"), "l", "r", 75, F.lower)
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().sparkPlan().toString()
    got = sorted((r.left_name, r.right_name, r.score) for r in found.collect())
    assert got == sorted({(a, b, score(a, b)) for a in words[::2] for b in words[1::2] if score(a, b) >= 75})


def test_lengths_keys_and_blocks_give_all_pairs(spark, monkeypatch):
    """Names meet by their lengths up to WORD letters and by keys beyond, in blocks of few pairs; wherever the border is, all pairs are found once."""
    rng = random.Random(11)
    left, right = ([typo(rng, rng.choice([*BASE, "x" * 64, "ab" * 40])) for _ in range(40)] for _ in range(2))
    all_pairs = sorted({(a, b, score(a, b)) for a in left if a for b in right if b and score(a, b) >= 75})
    for word, pairs in ((12, 9), (64, 100)):
        monkeypatch.setattr(similar, "WORD", word)
        found = similar.scored_pairs(frame(spark, left, "l"), frame(spark, right, "r"), "l", "r", 75, lambda c: c, block_pairs=pairs)
        assert sorted((r.left_name, r.right_name, r.score) for r in found.collect()) == all_pairs


@pytest.mark.parametrize("leaf", [1, 40, 10**9])
def test_ranges_of_counts_part_no_pairs(monkeypatch, leaf):
    """Splitting by counts and telling by bits keep all pairs that share enough, also with more letters than are counted by themselves."""
    rng = random.Random(leaf)
    for letters in ("abcd", "".join(map(chr, range(97, 97 + 200)))):
        monkeypatch.setattr(letter_counts, "LEAF", leaf)
        monkeypatch.setattr(letter_counts, "CHUNK", 50)
        monkeypatch.setattr(letter_counts, "STEP", 7)
        base = ["".join(rng.choices(letters, k=12)) for _ in range(8)]
        cut = lambda n: sorted({"".join(x[i] for i in sorted(rng.sample(range(12), n))) for x in base for _ in range(12)})
        a, b = (np.array(cut(n), object) for n in (10, 11))
        pairs = [tuple(map(int, p)) for p in zip(*map(np.concatenate, zip(*letter_counts.sharing(*letter_counts.numbered(a, b), 9))))]
        assert sorted(pairs) == [(i, j, subsequence(x, y)) for i, x in enumerate(a) for j, y in enumerate(b) if subsequence(x, y) >= 9]


def test_many_names_of_few_syllables(monkeypatch):
    """Names that share most of their letters: few pairs are looked at letter by letter."""
    rng = random.Random(5)
    syllables = ["th", "er", "tion", "ing", "and", "he", "re", "on", "an", "ble", "st", "ou", "qu", "eux", "ment", "ge"]
    names = {"".join(rng.choices(syllables, k=rng.randrange(4, 7))) for _ in range(20_000)}
    a, b = (np.array(sorted(x for x in names if len(x) == n), object) for n in (12, 13))
    looked, shared = [], letter_counts.shared
    monkeypatch.setattr(letter_counts, "shared", lambda x, y, least: looked.append(len(x)) or shared(x, y, least))
    assert sum(len(i) for i, *_ in letter_counts.sharing(*letter_counts.numbered(a, b), similar.least_shared_of(12, 13, 85))) > 0
    assert sum(looked) < 0.03 * len(a) * len(b)


def test_words_of_few_syllables_are_not_joined_as_rows(spark):
    """The pairs of words of few syllables are looked at in blocks: no join makes rows of them, only of those that are alike."""
    rng = random.Random(6)
    words = ["".join(rng.choices(["th", "er", "tion", "ing", "and", "he"], k=5)) for _ in range(60)]
    plan = similar.scored_pairs(frame(spark, words[:30], "l"), frame(spark, words[30:], "r"), "l", "r", 85)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" not in plan and "FlatMapGroupsInPandas" in plan


def test_best_are_the_best_of_all(spark, monkeypatch):
    """Pairs that others are better than are left out, and the best stay the same, with ties and capitals."""
    rng = random.Random(13)
    left, right = ([typo(rng, rng.choice(["chlorates", "Chlorides", "sulfates", "x" * 70])) for _ in range(n)] for n in (50, 90))
    right += [x.upper() for x in right[:30]]
    best = sorted((a, *p) for a in {*left} if a for p in sorted(((score(a.lower(), k.lower()), k) for k in {*right} if k and score(a.lower(), k.lower()) >= 70), key=lambda p: (-p[0], p[1]))[:3])
    monkeypatch.setattr(letter_counts, "CHUNK", 40)
    got = matching.fuzzy_best(frame(spark, left, "l"), frame(spark, right, "r"), "l", "r", 70, 3).collect()
    assert sorted((r.left_name, r.score, r.right_name) for r in got) == best


def test_best_scores_so_far():
    best = np.array([[90, 80], [0, 0], [70, 0]], np.int32)
    got = letter_counts.raised(best, np.array([2, 0, 1, 0, 2, 2]), np.array([60, 85, 75, 95, 99, 71]))
    assert got.tolist() == [[95, 90], [75, 0], [99, 71]]


def test_matched_letters_are_those_of_difflib():
    """Words of few letters and of many, with stretches of equal length at several places."""
    rng = random.Random(17)
    for letters, n, m in (("ab", 9, 11), ("abc", 64, 60), ("etaoins", 13, 13), ("x", 5, 3), ("aé日\U0001f600", 12, 10)):
        a, b = (np.array(["".join(rng.choices(letters, k=k)) for _ in range(300)], object) for k in (n, m))
        got = letter_counts.matched(*letter_counts.numbered(a, b))
        assert got.tolist() == [sum(x.size for x in difflib.SequenceMatcher(None, x, y).get_matching_blocks()) for x, y in zip(a, b)]
