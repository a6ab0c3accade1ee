import random

import pytest

EXTRA = "node string, size string, anchor string, token string, component_id string, shard string, taken string, h string, digest string, first string"


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text, source): plain texts, copies, near copies, shared passages, and odd cases."""
    rng = random.Random(7)
    passage, base = sentence(rng, 70), sentence(rng, 200)
    words = base.split()
    rows = [(i, sentence(rng, rng.randrange(40, 160)), f"s{i % 3}") for i in range(20)]
    rows += [(20 + i, base, "s0") for i in range(3)]
    rows += [(30 + i, " ".join([*words[: 60 * i + 9], f"new{i}", *words[60 * i + 10 :]]), "s1") for i in range(3)]
    rows += [(40 + i, f"{sentence(rng, 30)}\n{passage}\t{sentence(rng, 25)}", "s2") for i in range(4)]
    rows += [(50, None, "s0"), (51, "", "s1"), (52, " \t\n ", None), (53, "one", None), (54, "one two", None), (None, sentence(rng, 90), "s0"), (None, None, None)]
    rows += [(60, sentence(rng, 30_000, 5000), "s1"), (61, "x" * 20_000, "s1"), (62, "For " * 300, "s2"), (63, "été   naïve <|endoftext|> \U0001f600   Aİ", "s2")]
    return rows + [rows[0], rows[0], (1, "another text for a repeated id " + sentence(rng, 60), "s1")]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as documents with further columns whose names operators use themselves."""
    rows = [(i, t, "en", s, len(t or ""), *["x"] * 10) for i, t, s in texts]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}").repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")
