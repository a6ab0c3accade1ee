"""Lines of texts routed by section: every order of sections, blanks, and texts of very many lines."""

import itertools
import time

import pytest
from pyspark.sql import functions as F

from brothlake.functions import sections
from brothlake.operators import mining, routing

RULES = [(lambda x: x.startswith("a"), "A"), (lambda x: x.startswith("b"), "B")]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "k long, text string")


def applied(spark, texts, of):
    return [r.x for r in frame(spark, texts).select("k", of(F.col("text")).alias("x")).orderBy("k").collect()]


def test_states_equal_a_loop(spark):
    texts = ["\n".join(x) for n in range(5) for x in itertools.product(["a1", "b1", "c", ""], repeat=n)]
    got = applied(spark, texts, lambda t: sections.stated(sections.text_lines(t), RULES, "start"))
    for text, rows in zip(texts, got):
        state, want = "start", []
        for line in text.split("\n"):
            begins = line[:1] in ("a", "b")
            state = line[0].upper() if begins else state
            want.append((line, state, begins))
        assert [tuple(r) for r in rows] == want


def mined(texts, spark, **options):
    return [[tuple(r) for r in x] for x in applied(spark, texts, lambda t: mining.all_ingredients(t, **options))]


def test_ways_of_mining(spark):
    texts = [
        None, "", " \t\n\r\n",
        "Ingredients\nPeptone\nNaCl 5 g/L\n1. Dissolve\nKCl",
        "1. Dissolve\nPeptone\nComposition:\nAgar\nautoclave it\nBiotin\nmedium\nTris\n",
        "Take Yeast extract 5 g/L and Sodium chloride 2.5 mg/L, NaCl 3 mM",
        "Solution B: Sodium chloride and Magnesium sulfate. Rest",
        "a 12 g b", "Fructose syrup 3 g", "123 g", "x" * 50 + " 5",
    ]
    got = mined(texts, spark)
    assert got[0] == got[1] == got[2] == [] == got[9] == got[10] == got[7]
    assert got[3] == [("NaCl", 5.0, "g/L", "inline"), ("Peptone", 0.0, "unknown", "compound_list")]
    assert got[4] == [("Agar", 0.0, "unknown", "compound_list"), ("Tris", 0.0, "unknown", "compound_list")]
    assert got[5] == [("Yeast extract", 5.0, "g/L", "inline"), ("Sodium chloride", 2.5, "mg/L", "inline"), ("NaCl", 3.0, "mM", "inline")]
    assert got[6] == [("Sodium chloride", 0.0, "unknown", "solution"), ("Magnesium sulfate", 0.0, "unknown", "solution")]
    assert got[8] == [("Fructose syrup", 3.0, "g", "inline")]
    published = mined(texts, spark, parity=True)
    assert ("NaCl 5 g/L", 0.0, "unknown", "compound_list") in published[3]
    assert [r[0] for r in published[6]] == ["Sodium", "Magnesium", "Sodium chloride and Magnesium sulfate"]


def test_repeated_names_keep_the_first_with_an_amount(spark):
    assert mined(["Medium\nAgar\nPeptone\nagar\nAgar 5 g\nAGAR 7 g"], spark)[0] == [("Agar", 5.0, "g", "inline"), ("Peptone", 0.0, "unknown", "compound_list")]


@pytest.mark.parametrize("order", list(itertools.permutations(["table", "closed", "procedure"])))
def test_routes_in_every_order(spark, order):
    parts = {"table": ["NaCl", "5", "g"], "closed": ["Final pH 7", "6", "ml"], "procedure": ["Note: x", "KCl 2 mM"]}
    lines = [x for part in order for x in parts[part]]
    row = applied(spark, ["\n".join(lines)], routing.routed)[0]
    before = lines[: lines.index("Note: x")]
    wanted = parts["table"] if "NaCl" in before else []
    assert row.ingredients == wanted
    left = list(lines)
    for x in wanted:
        left.remove(x)
    assert row.instructions == left


def test_routing_of_blanks(spark):
    rows = applied(spark, [None, "", "\n \n", "page 1\n© x"], routing.routed)
    assert all(r.ingredients == [] and r.instructions == [] for r in rows)
    assert applied(spark, [None, "5\nmg"], routing.routed_ingredients) == [[], []]
    assert applied(spark, [None, "a\n\nb   c"], routing.instructions) == ["", "a b c"]


def test_very_many_lines(spark):
    """Time grows with the lines: 24,000, and lines of 4,000 amounts, take seconds."""
    n = 4_000
    texts = ["\n".join(f"Salt{i} chloride\nIngredients\nNaCl {i}.5 g/L\nFinal pH 7\n{i}\nmg" for i in range(n)), "5 g Agar " * n, "Medium\n" * n, "solution " * n, "1 " * n + "A1" * n]
    began = time.perf_counter()
    assert len(mined(texts[:1], spark)[0]) >= n
    assert len(applied(spark, texts, routing.routed)) == 5
    assert len(mined(texts[1:], spark)) == 4
    assert time.perf_counter() - began < 60
