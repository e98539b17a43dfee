"""Scores of the classifiers against plain Python, one word and one character at a time."""

import math
import re
from collections import Counter

import pytest

from corridor.llm import langid, quality, shingles
from corridor.llm.queries import op8_quality, op9_langid
from corridor.llm.storage import table
from tests.conftest import SF_SMALL

M64, M32 = 2**64 - 1, 2**32 - 1


def mix(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & M64
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & M64
    return x ^ (x >> 31)


def word_hash(token):
    total = sum(int(shingles._CHAR[b]) * int(shingles._POWER[i % shingles._SPAN]) for i, b in enumerate(token))
    return mix((total + len(token)) & M64)


def gram_hash(words):
    return mix((len(words) + sum(w * int(shingles._STEP[i]) for i, w in enumerate(words))) & M64)


def quality_score(text, weights):
    """The dot product of the features, spelled out, with the model's weights."""
    half = quality.DIMS // 2
    tokens = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0d]+", (text or "").encode())
    total = float(weights[-1])
    if tokens:
        def shape(b):
            return 1 if 65 <= b <= 90 else 2 if 97 <= b <= 122 else 3 if 48 <= b <= 57 else 4 if b >= 128 else b
        words = [word_hash(bytes(b + 32 if 65 <= b <= 90 else b for b in t)) for t in tokens]
        shapes = [mix(shape(t[0]) * 512 + shape(t[-1]) * 2 + int(i > 0 and words[i] == words[i - 1])) for i, t in enumerate(tokens)]
        for group, longest in ((words, 2), (shapes, 3)):
            counts = Counter(gram_hash(group[i:i + n]) % (half - 1) for n in range(1, longest + 1) for i in range(len(group) - n + 1))
            size = math.sqrt(sum(math.log1p(c) ** 2 for c in counts.values()))
            total += sum(math.log1p(c) / size * float(weights[at + (longest - 2) * half]) for at, c in counts.items())
    return 1 / (1 + math.exp(-total))


def language(text, model):
    """Language and probability by a loop over the n-grams of the letters."""
    out = " "
    for c in (text or "").lower():
        if c.isalpha():
            out += c
        elif out[-1] != " ":
            out += " "
    out = out if out[-1] == " " else out + " "
    if not out.strip():
        return "und", 0.0, 0.0
    sums, grams, known = [0.0] * len(model.langs), 0, 0
    for n in langid.ORDERS:
        for i in range(len(out) - n + 1):
            h = n * 0x9E3779B1 & M32
            for c in out[i:i + n]:
                h = (h ^ ord(c)) * 0x85EBCA6B & M32
                h ^= h >> 15
            row = model.table[h % (len(model.table) - 1)]
            sums = [a + float(b) for a, b in zip(sums, row)]
            grams += 1
            known += any(row != 0)
    logits = [(a * langid.SCALE / grams + float(b)) / model.temperature for a, b in zip(sums, model.table[-1])]
    e = [math.exp(x - max(logits)) for x in logits]
    best = max(range(len(e)), key=e.__getitem__)
    return model.langs[best], e[best] / sum(e), known / grams


@pytest.fixture(scope="module")
def docs(spark):
    frame = table(spark, SF_SMALL, "documents")
    return frame, [r for r in frame.collect() if len(r.text or "") < 4000]


def test_quality_scores(spark, docs):
    weights = quality.train(docs[0], table(spark, SF_SMALL, "labels"))
    got = {r.doc_id: r for r in op8_quality(spark, SF_SMALL).collect()}
    odd = ["", None, "!!", "a", "A a a-b", "É\U0001F600 x", "\x01 \x7f"]
    extra = quality.score(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string"), weights).collect()
    for r in docs[1]:
        assert got[r.doc_id].score == pytest.approx(quality_score(r.text, weights), abs=1e-5)
    for r in extra:
        assert r.score == pytest.approx(quality_score(odd[r.doc_id], weights), abs=1e-5)
    assert len(docs[1]) > 100 and weights.any()


def test_languages(spark, docs):
    model = langid.train(docs[0])
    got = {r.doc_id: r for r in op9_langid(spark, SF_SMALL).collect()}
    for r in docs[1]:
        lang, p, _ = language(r.text, model)
        assert got[r.doc_id].lang_pred == lang and got[r.doc_id].score == pytest.approx(p, abs=1e-5)
    for t in ("", None, "123", "a", "Ǆ x", "ß-É\U0001F600İ", "Съешь ещё"):
        lang, p, known = language(t, model)
        assert model.judge(t) == (lang, pytest.approx(p, abs=1e-5), pytest.approx(known))
