import random
import zlib

import numpy as np
import pytest

from corridor.llm import ftrl, langid, quality
from corridor.llm.queries import op8_quality, op9_langid
from tests.conftest import SF_SMALL

LEARN = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_ftrl_learns_and_l1_zeroes():
    rng = np.random.default_rng(0)
    examples = []
    for _ in range(400):
        y = int(rng.integers(0, 3))
        at = np.unique(np.append(rng.integers(10, 60, 6), y))
        examples.append((at, np.ones(len(at)), y))
    w = ftrl.fit(examples, ftrl.Ftrl(60, 3, alpha=0.5, l1=1.0), 3)
    assert np.mean([np.argmax(x @ w[a]) == y for a, x, y in examples]) > 0.97
    assert (w[10:] == 0).mean() > 0.3


def test_quality_held_out_accuracy(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{LEARN}/labels.parquet").collect()}
    got = op8_quality(spark, LEARN).collect()
    assert len(got) == spark.read.parquet(f"{LEARN}/documents.parquet").count()
    for r in got:
        assert r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    test = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in test]) >= 0.95


def test_language_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{LEARN}/documents.parquet").collect()}
    got = op9_langid(spark, LEARN).collect()
    assert len(got) == len(truth)
    test = [r for r in got if held(r.doc_id)]
    assert all(r.held_out for r in test) and np.mean([r.lang_pred == truth[r.doc_id] for r in test]) >= 0.98


def test_quality_ignores_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rows = [(r.doc_id, 1 - r.quality if held(r.doc_id) else r.quality) for r in labels.collect()]
    flipped = spark.createDataFrame(rows, "doc_id long, quality int")
    assert np.array_equal(quality.train(docs, labels), quality.train(docs, flipped))


DOCS = "doc_id long, text string, lang string, score string, label string"


def texts(n=120):
    rng = random.Random(1)
    a, b = ["the", "house", "water", "and"], ["das", "haus", "wässer", "und"]
    return [(i, " ".join(rng.choices(a if i % 2 else b, k=12)), "en" if i % 2 else "de", "x", "y") for i in range(n)]


def test_language_edges(spark):
    df = spark.createDataFrame(texts(), DOCS)
    model = langid.train(df)
    odd = [(None, None, None, None, None), (1, "", "en", None, None), (2, "123 !!", "en", None, None), (3, "THE house", None, None, None),
           (3, "THE house", None, None, None), (4, "und das haus " * 40_000, "xx", None, None)]
    got = langid.digest_columns(langid.identify(spark.createDataFrame(odd, DOCS), model)).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got) == [
        (0, "und"), (1, "und"), (2, "und"), (3, "en"), (3, "en"), (4, "de")]
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    empty = df.limit(0)
    nothing = langid.train(empty)
    assert nothing.langs == [] and nothing.predict("some text") == ("und", 0.0)
    assert langid.identify(empty, nothing).count() == 0
    assert langid.train(spark.createDataFrame([(1, "a", None, None, None)], DOCS)).langs == []


def test_long_text_scores_like_its_parts():
    model = langid.LanguageModel(["a", "b"], np.random.default_rng(0).normal(size=(langid.DIMS, 2)).astype(np.float32))
    codes = langid.cleaned("some words and more words " * 60_000)
    at = np.concatenate([h for h in langid.hashed(codes)])
    assert len(at) == 3 * len(codes) - 3
    whole = model.table[at].sum(axis=0, dtype=np.float64) * langid.SCALE / len(at) + model.table[-1]
    assert model.logits(codes) == pytest.approx(whole, rel=1e-6)


def test_temperature_calibrates():
    rng = np.random.default_rng(2)
    y = rng.integers(0, 3, 3000)
    logits = rng.normal(size=(3000, 3))
    logits[np.arange(3000), y] += 1.0
    t = langid._temperature(logits * 6, y)
    assert 4 < t < 9
    assert langid._temperature(np.empty((0, 2)), np.empty(0, int)) == 1.0


def test_quality_edges(spark):
    schema = "doc_id long, text string, score string"
    docs = spark.createDataFrame([(None, None, "a"), (1, "", "b"), (1, "", None), (2, "word " * 100_000, None)], schema)
    none = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id long, quality int")
    w = quality.train(docs, none)
    got = quality.predict(docs, w).collect()
    assert len(got) == 4 and all(r.score == 0.5 and r.predicted == 1 for r in got)
    assert quality.predict(docs.limit(0), w).count() == 0
    assert [r.held_out for r in got if r.doc_id is None] == [False]


def test_identifiers_and_sources_are_no_inputs(spark):
    df = spark.createDataFrame(texts(), DOCS)
    model = langid.train(df)
    other = df.selectExpr("doc_id + 5000 as doc_id", "text", "'zz' as lang")
    score = lambda d: sorted((r.lang_pred, r.score) for r in langid.identify(d, model).collect())
    assert score(df) == score(other)


def test_language_of_many(spark):
    """Six hundred languages, none left out; the weights stay within their bound."""
    rng = random.Random(4)
    rows, n = [], 0
    letters = [chr(c) for c in range(0x3400, 0xD7A3) if chr(c).isalpha()]
    for k in range(600):
        parts = letters[40 * k:40 * k + 40]
        for _ in range(14):
            rows.append((n, " ".join("".join(rng.choices(parts, k=4)) for _ in range(12)), f"l{k:03d}"))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert len(model.langs) == 600 and model.table.size <= langid.CELLS
    got = langid.identify(docs, model).collect()
    truth = {r[0]: r[2] for r in rows}
    test = [r for r in got if held(r.doc_id)]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in test]) >= 0.9


def test_bytes_learned_from_are_bounded(spark, monkeypatch):
    docs = spark.createDataFrame([(i, r[1] + f" {i} " * 50, *r[2:]) for i, r in enumerate(texts())], DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, quality int")
    seen = []
    real = ftrl.fit
    monkeypatch.setattr(ftrl, "fit", lambda examples, *a, **kw: seen.append(len(examples)) or real(examples, *a, **kw))
    quality.train(docs, labels)
    monkeypatch.setattr(quality, "MAX_BYTES", 20_000)
    quality.train(docs, labels)
    langid.train(docs, max_bytes=20_000)
    assert 0 < seen[1] < seen[0] and 0 < seen[2] < 60
