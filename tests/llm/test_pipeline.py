import hashlib
from collections import Counter

import duckdb
import pandas as pd
import public_tokenizers
import pytest

import corpus_pipeline
from brothlake.llm import mixing, registry, toxicity

from .test_dedup import grouped, kept_words, words_of
from .test_filters import naive_score


@pytest.fixture(scope="module")
def folder(tmp_path_factory, spark, texts):
    path = tmp_path_factory.mktemp("sf")
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(path / "documents.parquet"))
    labels = pd.DataFrame({"doc_id": [0, 2, 3, 4, 5, 6], "quality": 1, "toxic": [0, 0, 1, 0, 0, 0]})
    spark.createDataFrame(labels).write.parquet(str(path / "labels.parquet"))
    return path


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(str(folder / "documents.parquet"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(folder)).cache()
        assert docs.columns == columns, name
        assert docs.count() > 0, name


def test_run_and_names(spark, folder):
    out = corpus_pipeline.run(spark, str(folder))
    assert out.count() > 0 and {"doc_id", "n_tokens", "ids"} <= set(out.columns)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "substring_dedup", "source_mixing", "bpe_encoding"]
    assert {int(q[2:].split("_")[0]) for q in registry.QUERIES} == set(range(1, 14))


def test_empty_input(spark, folder, tmp_path):
    spark.read.parquet(str(folder / "documents.parquet")).where("false").write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(str(folder / "labels.parquet")).where("false").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_equal_brute_force(spark, tmp_path, texts):
    """Every stage's rows, each from what the one before has kept, against plain Python, the mix's SQL and the tokenizers library."""
    from tokenizers import Tokenizer

    rows = list({i: (i, t, "en", s, len(t or "")) for i, t, s in texts if i is not None and len(t or "") < 25_000}.values())
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 2)) for i in range(20)], "doc_id long, quality int, toxic int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs, stages = spark.read.parquet(str(tmp_path / "documents.parquet")), dict(corpus_pipeline.STAGES)
    step = lambda name, df: stages[name](spark, df, str(tmp_path)).cache()
    plain = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)

    clean = step("toxicity", docs)
    net = toxicity.fitted(docs, labels)
    scores = {i: naive_score(net, t) for i, t, *_ in rows}
    kept = {r.doc_id for r in clean.collect()}
    assert all((scores[i] < 0.7) == (i in kept) for i in scores if abs(scores[i] - 0.7) > 1e-3)

    single = step("ngram_jaccard_join", clean)
    own = [(r.doc_id, r.text) for r in clean.collect()]
    firsts = {root for _, _, root in grouped(own, 5, 80)}
    assert plain(single) == sorted(((i, t) for i, t in own if i in firsts), key=str)

    cut = step("substring_dedup", single)
    digest = lambda t: hashlib.sha256(" ".join(words_of(t)).encode()).hexdigest()
    assert sorted((r.doc_id or -1, digest(r.text)) for r in cut.collect()) == sorted((i, sha) for i, _, _, sha in kept_words([(r.doc_id, r.text) for r in single.collect()]))
    assert all(r.n_chars == len(r.text or "") for r in cut.where("text IS NOT NULL").collect())

    mixed = step("source_mixing", cut)
    documents = cut.select("doc_id", "text", "source").toPandas()  # noqa: F841  read by DuckDB
    want = Counter({i: taken // size for i, size, _, _, taken in duckdb.sql(mixing.ORACLE).fetchall() if taken})
    assert Counter(r.doc_id for r in mixed.collect()) == want

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    tokens = step("bpe_encoding", mixed)
    text_of = {r.doc_id: r.text for r in mixed.collect()}
    assert tokens.count() == mixed.count()
    assert all(list(r.ids) == library.encode(text_of[r.doc_id] or "", add_special_tokens=False).ids for r in tokens.collect())
