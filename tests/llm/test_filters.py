import html
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from brothlake.llm import langid, quality, toxicity
from brothlake.llm import words as W


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base(text):
    words, text = words_of(text), text or ""
    grams = Counter(zip(words, words[1:], words[2:]))
    twice = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if words_of(x)]
    failed = len(words) < 50 or 100 * len(twice) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(twice), failed


def test_quality_equals_brute_force(docs, texts):
    rows = quality.judged(docs).collect()
    got = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    assert got == sorted((i or -1, *base(t)) for i, t, _ in texts)
    assert not any(r.kept and r.base_failed for r in rows)


def test_cascade_order_changes_nothing(docs):
    names = list(quality.RULES)
    one, two = (sorted((r.doc_id or -1, r.kept) for r in quality.judged(docs, order).collect()) for order in (names, names[::-1]))
    assert one == two
    assert quality.cascade_order({"dear": (1.0, 0.5), "cheap": (0.001, 0.1), "idle": (0.001, 0.0)}) == ["cheap", "dear", "idle"]


def test_rules(spark):
    long = " ".join(f"word{i}" for i in range(60))
    cases = {"fine": long, "symbols": long + " ###" * 10, "letters": " ".join(str(1000 + i) for i in range(80)), "lines": "\n".join(["a b", *[f"l{i} x y" for i in range(20)], *["same line here"] * 15]), "bullets": "\n".join(f"- item{i} text{i} more{i}" for i in range(30)), "dots": "\n".join(f"item{i} text{i} more{i}..." for i in range(30)), "pairs": " ".join(f"word{i} again and{i}" if i % 3 else f"x{i} lengthy repetition" for i in range(60)), "breaks": "\n" + long + "\n\n"}
    df = spark.createDataFrame(list(enumerate(cases.values())), "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in quality.judged(df, list(quality.RULES)).collect()}
    assert [kept[i] for i in range(8)] == [True, False, False, False, False, False, False, True]
    documents = df.toPandas()  # noqa: F841  read by DuckDB
    assert {r[0]: r[-1] for r in duckdb.sql(quality.ORACLE).fetchall()} == kept


def test_filters_on_empty_tables(spark, no_docs):
    assert quality.judged(no_docs).count() == 0
    assert toxicity.scored(no_docs, toxicity.Network()).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert langid.identified(pages, no_docs).count() == 0


def test_gradients_are_those_of_the_loss():
    net = toxicity.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    block = next(W.blocks(pa.array(["the cat sat on the mat", "you fool " * 30, "a b c"])))
    words = toxicity.word_inputs(block)
    doc, first, size = toxicity.window_rows(block.bounds)
    label = (doc == 1).astype(np.float32)

    def loss():
        x = net.inputs(words)
        logit = net.run([x @ net.p[f"in{d}"] + net.p[f"b{d}"] for d in (0, 1)], words.index, first, size).astype(np.float64)
        return np.mean(np.logaddexp(0, logit) - label * logit)

    for k, g in net.gradients(words, first, size, label).items():
        at = (words.ids[0], 1) if k == "word" else (words.codes[0], 1) if k == "gram" else (0,) * g.ndim
        kept = net.p[k][at]
        net.p[k][at] = kept + 1e-2
        up = loss()
        net.p[k][at] = kept - 1e-2
        down = loss()
        net.p[k][at] = kept
        assert g[at] == pytest.approx((up - down) / 2e-2, rel=0.02, abs=2e-5)


def test_windows_cover_every_word():
    bounds = np.array([0, 0, 5, 37, 200, 232])
    doc, first, size = toxicity.window_rows(bounds)
    covered = set()
    for d, f, s in zip(doc, first, size):
        assert bounds[d] <= f and f + s <= bounds[d + 1] and s <= toxicity.WINDOW
        covered |= set(range(f, f + s))
    assert covered == set(range(232))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(900):
        words = [f"t{rng.integers(600)}" for _ in range(rng.integers(20, 120))]
        toxic = int(i % 4 == 0)
        for _ in range(3 * toxic):
            words[rng.integers(len(words))] = f"grobul{'abcdefgh'[rng.integers(8)]}"
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, toxic int")


def test_toxicity_on_held_out_documents(spark, labelled, docs, texts):
    some, labels = labelled
    net = toxicity.fitted(some, labels)
    truth = {r.doc_id: r.toxic for r in labels.where("toxic IS NOT NULL").collect()}
    rows = toxicity.scored(some, net).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out]
    assert sum(p == t for p, t in held) / len(held) > 0.97
    odd = toxicity.scored(docs, net).collect()
    assert len(odd) == len(texts) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.clean_documents(docs, net).columns == docs.columns
    same = [r.score for r in odd if r.doc_id in (50, 51, 52)]
    assert len(set(same)) == 1


def test_training_ignores_held_out_labels(labelled):
    some, labels = labelled
    text, _ = toxicity.training_sample(some, labels)
    held = {r.text for r in some.where(toxicity.held_out(some.doc_id)).collect()}
    assert not held & set(text.to_pylist())
    small, y = toxicity.training_sample(some, labels, most=(20, 10))
    assert (len(small), int(y.sum())) == (30, 10)


def test_language_fusion(spark):
    parts = {"en": ["the", "and", "thing", "with"], "de": ["und", "der", "nicht", "schön"], "fr": ["est", "les", "être", "où"]}
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(parts[x], 30)), x) for i, x in enumerate(list(parts) * 20)]
    known = spark.createDataFrame([*rows, (99, None, "en"), (98, "text", None)], "doc_id long, text string, lang string")
    pages = [(i, f"http://h{x}.example.{x}/p", f'<html lang="{x}"><script>der und</script><p>{" ".join(rng.choice(parts[x], 20))}</p>') for i, x in enumerate(list(parts) * 5)]
    pages += [(50, "http://hde.example.de/q", "<p>zz</p>"), (51, None, None), (None, "bad url", "<html lang=fr>"), pages[0]]
    got = langid.identified(spark.createDataFrame(pages, "page_id long, url string, html string"), known).collect()
    assert len(got) == len(pages)
    assert all(r.lang == list(parts)[r.page_id % 3] for r in got if r.page_id is not None and r.page_id < 15)
    assert {r.page_id: r.lang for r in got}[50] == "de"
    assert all(0 < r.probability <= 1 for r in got)


def naive_score(net, text):
    """One document, window by window and step by step, in double precision."""
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    sig = lambda x: 1 / (1 + np.exp(-x))
    words = words_of(text)
    if not words:
        return sig(p["out_b"][0])

    def hashed(data):
        return W.span_hashes(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)]))[0]

    def vector(word):
        data = bytes(b for b in word.encode().lower() if 97 <= b <= 122 or b >= 128)
        with np.errstate(over="ignore"):
            codes = [int(W.mixed(hashed(data[i : i + n]) + np.uint64(n * (i == 0)))) % toxicity.BUCKETS for n in toxicity.GRAMS for i in range(len(data) - n + 1)]
        gram = sum((p["gram"][c] for c in codes), np.zeros(toxicity.DIM)) / np.sqrt(max(1, len(codes)))
        return np.concatenate([p["word"][int(hashed(data)) % toxicity.BUCKETS], gram])

    vectors, best, at, h = [vector(w) for w in words], -np.inf, 0, toxicity.HIDDEN
    while True:
        window = vectors[at : at + toxicity.WINDOW]
        states = np.zeros((len(window), 2 * h))
        for d in (0, 1):
            now = np.zeros(h)
            for t in range(len(window)) if d == 0 else reversed(range(len(window))):
                x, back = window[t] @ p[f"in{d}"] + p[f"b{d}"], now @ p[f"u{d}"]
                z, r = sig(x[:h] + back[:h]), sig(x[h : 2 * h] + back[h : 2 * h])
                now = z * now + (1 - z) * np.tanh(x[2 * h :] + r * back[2 * h :])
                states[t, d * h : (d + 1) * h] = now
        weight = np.exp(np.tanh(states @ p["attend"] + p["attend_b"]) @ p["query"])
        best = max(best, (weight / weight.sum()) @ states @ p["out"] + p["out_b"][0])
        if at + toxicity.WINDOW >= len(words):
            return sig(best)
        at += toxicity.STRIDE


def test_scores_equal_brute_force(spark, docs, texts):
    net = toxicity.Network(seed=4)
    want = {(i, t): naive_score(net, t) for i, t, *_ in texts if len(t or "") < 25_000}
    rows = toxicity.scored(docs, net).join(docs.select("doc_id", "text").distinct(), "doc_id").collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add(round(r.score, 4))
    for (i, _), score in want.items():
        if i is not None:
            assert any(abs(score - x) < 2e-3 for x in by_id[i])


def naive_language(pages, langs, model):
    """The posterior of each page in plain Python over the fitted trigram table."""
    k, seen = len(langs), []
    for page_id, url, text in pages:
        ll = model @ langid.trigram_counts(langid.visible_text(text or "")) * langid.TEMPER
        ll = ll - ll.max()
        said = re.search(r"""(?i)<html\b[^>]*?\slang\s*=\s*["']?([A-Za-z]{2,3})""", text or "")
        host = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
        host = host[1].lower() if host else ""
        domain, suffix = re.search(r"[^.]+\.[^.]+\.?$", host), re.search(r"\.([a-z]+)\.?$", host)
        seen.append((page_id, ll, said[1].lower() if said else "", host, domain[0] if domain else "", suffix[1] if suffix else "", int(np.argmax(ll))))
    totals = np.bincount([x[-1] for x in seen], minlength=k).astype(float)
    tally = lambda place, value: np.bincount([x[-1] for x in seen if x[place] == value], minlength=k)
    smooth = lambda own, parent: (own + langid.PARENT_WEIGHT * parent) / (own.sum() + langid.PARENT_WEIGHT)
    likely = lambda place, value: (tally(place, value) + langid.VALUE_ALPHA) / (totals + langid.VALUE_ALPHA * (len({x[place] for x in seen}) + 1))
    base, out = (totals + 1) / (totals.sum() + k), []
    for page_id, ll, said, host, domain, suffix, _ in seen:
        log_p = ll + np.log(smooth(tally(3, host), smooth(tally(4, domain), base))) + np.log(likely(2, said)) + np.log(likely(5, suffix))
        p = np.exp(log_p - log_p.max())
        out.append((str(page_id), langs[int(np.argmax(log_p))], round(1 / p.sum(), 6)))
    return sorted(out)


def test_language_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    parts = {"en": ["the", "and", "thing", "with"], "de": ["und", "der", "nicht", "schön"], "fr": ["est", "les", "être", "où"]}
    known = spark.createDataFrame([(i, " ".join(rng.choice(parts[x], 12)), x) for i, x in enumerate(list(parts) * 8)], "doc_id long, text string, lang string")
    pages = [(i, f"https://u@h{i % 4}.{'ab'[i % 2]}.{rng.choice(['de', 'fr', 'com'])}:80/p", f'<html lang="{rng.choice(list(parts))}"><p>{" ".join(rng.choice(parts[x], rng.integers(0, 4)))} &eacute;</p>') for i, x in enumerate(list(parts) * 15)]
    pages += [(100, None, None), (None, "nothing", ""), pages[3], (101, "http://localhost/", "<p>zz</p>")]
    got = langid.identified(spark.createDataFrame(pages, "page_id long, url string, html string"), known).collect()
    assert sorted((str(r.page_id), r.lang, round(r.probability, 6)) for r in got) == naive_language(pages, *langid.text_model(known))


def test_visible_text():
    """As one pattern finds it on pages whose scripts, styles and comments end, and on those where they don't."""
    pattern = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
    rng = random.Random(4)
    parts = ["<script>", "</script >", "<STYLE a='>'>", "</style>", "<!--", "-->", "<p>", "<", ">", "text ", "&amp;", "<scripts>", "</script", "\n", "<style"]
    for _ in range(3_000):
        page = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert langid.visible_text(page) == html.unescape(pattern.sub(" ", page)), page


def test_malformed_pages_take_linear_time(spark, docs):
    pages = [(i, "http://a.example/x", part * (5_000_000 // len(part)), "x") for i, part in enumerate(("<script>", "<!--", "<", "<style >", "<html ", "<html lang ", "a < b "))]
    began = time.perf_counter()
    for _, _, page, _ in pages:
        langid.visible_text(page)
    assert time.perf_counter() - began < 14
    small = [(i, u, h[:200_000], x) for i, u, h, x in pages]
    began = time.perf_counter()
    assert langid.identified(spark.createDataFrame(small, "page_id long, url string, html string, lang string"), docs).count() == len(pages)
    assert time.perf_counter() - began < 60
