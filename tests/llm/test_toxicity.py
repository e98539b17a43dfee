import random
import zlib

import numpy as np

from corridor.llm import toxicity
from corridor.llm.queries import op13_toxicity
from tests.conftest import SF_SMALL

BAD = ["stupid", "worthless", "disgusting", "pathetic"]


def plain(rng, n):
    return ["".join(rng.choice(["ti", "on", "er", "ha", "ble", "ing", "th"]) for _ in range(rng.randrange(1, 4))) for _ in range(n)]


def text(rng, toxic, n=120):
    words = plain(rng, n)
    for _ in range(max(2, n // 40) if toxic else 0):
        words[rng.randrange(n)] = rng.choice(BAD)
    return " ".join(words)


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    labels = np.array([int(rng.random() < 0.3) for _ in range(n)])
    return [text(rng, y) for y in labels], labels


def misspelt(rng, w):
    i = rng.randrange(2, len(w) - 1)
    return rng.choice([w[:i] + w[i] + w[i:], w[:i] + w[i + 1:], w[:i] + "x" + w[i + 1:]])


def test_learns_and_knows_misspellings():
    texts, labels = corpus()
    scorer = toxicity.Scorer(toxicity.fit(texts, labels))
    rng = random.Random(2)
    fresh, truth = corpus(200, 3)
    assert np.mean([(scorer(t)[0] >= 0.5) == y for t, y in zip(fresh, truth)]) >= 0.97
    wrong = [" ".join(plain(rng, 40) + [misspelt(rng, rng.choice(BAD)) for _ in range(2)] + plain(rng, 40)) for _ in range(60)]
    assert np.mean([scorer(t)[0] >= 0.5 for t in wrong]) >= 0.6
    # A few words weigh the same in a long text, and the window shows where they are.
    p, first, end = scorer(" ".join(plain(rng, 20_000) + ["you", "stupid", "worthless", "pathetic"] + plain(rng, 20_000)))
    assert p >= 0.5 and first <= 20_003 and end > 20_001


def test_subwords_by_hand():
    words = ["ab".encode(), "é".encode(), b"x" * 5000]
    at, count = toxicity.subwords(words)
    for w, n in zip(words, count):
        size = len(w) + 2
        assert n == 1 + sum(max(0, size - k + 1) for k in range(toxicity.SHORTEST, toxicity.LONGEST + 1))
    alone = [toxicity.subwords([w])[0].tolist() for w in words]
    assert sum(alone, []) == at.tolist() and at.max() < toxicity.BUCKETS


def test_windows_cover_every_word():
    for n in range(0, 60):
        first, end = toxicity.window_bounds(n)
        assert {i for a, b in zip(first, end) for i in range(a, b)} == set(range(n))
        assert all(b - a == min(n, toxicity.WINDOW) for a, b in zip(first, end))


def test_score_equals_a_plain_second_version():
    texts, labels = corpus(60)
    model = toxicity.fit(texts, labels, epochs=3)
    scorer = toxicity.Scorer(model)
    for t in texts[:20]:
        values = [float(np.mean(model.weights[toxicity.subwords([w])[0]], dtype=float)) for w in toxicity.words_of(t)]
        k = min(toxicity.WINDOW, len(values))
        starts = sorted({*range(0, len(values) - k, toxicity.WINDOW // 2), len(values) - k})
        logit = max(sum(values[i:i + k]) / k for i in starts) + model.bias
        assert abs(scorer(t)[0] - 1 / (1 + np.exp(-logit))) < 1e-9


def test_query_shape_and_held_out_labels(spark):
    got = {r.doc_id: r for r in op13_toxicity(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert len(got) == docs.count()
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()
    flipped = spark.createDataFrame([(r.doc_id, 1 - r.toxic if got[r.doc_id].held_out else r.toxic) for r in labels if r.doc_id in got],
                                    "doc_id long, toxic int")
    again = {r.doc_id: r.score for r in toxicity.predict(docs, toxicity.train(docs, flipped)).collect()}
    assert all(again[k] == r.score for k, r in got.items())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    test = [r for r in op13_toxicity(spark, sf).collect() if r.held_out and r.doc_id in truth]
    assert len(test) > 500 and np.mean([r.predicted == truth[r.doc_id] for r in test]) >= 0.93
    clean = [r.predicted for r in test if truth[r.doc_id] == 0]
    assert np.mean(clean) <= 0.02


def test_edges(spark):
    docs = "doc_id long, text string, label string, score string, at string"
    rows = [(i, t, "x", "x", "x") for i, t in enumerate(corpus(40)[0])]
    rows += [(None, "stupid", "x", "x", "x"), (90, None, "x", "x", "x"), (91, "", "x", "x", "x"), (92, " !? ", "x", "x", "x"),
             (93, "y" * 300_000, "x", "x", "x"), (94, "word " * 200_000, "x", "x", "x"), (95, "a", "x", "x", "x"), (95, "a", "x", "x", "x")]
    frame = spark.createDataFrame(rows, docs)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (90, 1), (94, 0), (1, None), (2, 7)], "doc_id long, toxic int")
    got = toxicity.predict(frame, toxicity.train(frame, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[90].score == by[91].score == by[92].score and by[None].held_out is False
    none = toxicity.train(frame, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.predict(frame, none).collect()} == {0.5}
    assert toxicity.predict(frame.limit(0), none).count() == 0
    one = toxicity.train(frame, spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, toxic int"))
    assert min(r.score for r in toxicity.predict(frame, one).collect() if r.doc_id in range(40)) > 0.5
