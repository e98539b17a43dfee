import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from corridor.llm import ntt, runs
from corridor.llm.queries import op11_runs
from tests.conftest import SF_SMALL


def brute(words):
    """All runs by comparing the words with themselves shifted by every period."""
    out, seen = set(), set()
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q) and (i, j - i + q) not in seen:
                seen.add((i, j - i + q))
                out.add((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def told(doc_id, text):
    """The contract's words of a row."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def random_words(rng):
    n, k, out = rng.randrange(0, rng.choice([20, 60, 240])), rng.choice([1, 2, 2, 3, 5]), []
    while len(out) < n:
        unit = [rng.randrange(k) for _ in range(rng.randrange(1, 14))]
        if rng.random() < 0.3:
            unit = unit * rng.randrange(2, 6) + [9]
        out += unit * rng.randrange(1, 9)
        if rng.random() < 0.5:
            out.append(rng.randrange(k))
    return out[:n]


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(1500):
        words = random_words(rng)
        assert [tuple(r) for r in runs.find_runs(np.array(words, np.int64)).tolist()] == brute(words), words


def test_long_periods_and_structured_words():
    rng = np.random.default_rng(1)
    unit = rng.integers(0, 1000, 1500)
    words = np.concatenate([rng.integers(0, 1000, 700), np.tile(unit, 5)[:7001], rng.integers(0, 1000, 300)])
    found = [r for r in runs.find_runs(words).tolist() if r[2] == 1500]
    assert len(found) == 1 and found[0][0] <= 700 and sum(found[0][:2]) >= 7701     # chance may lengthen it
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert [tuple(r) for r in runs.find_runs(np.array(b * 4, np.int64)).tolist()] == brute(b * 4)
    power = np.concatenate([np.zeros(300, np.int64), [1]] * 6)
    assert [tuple(r) for r in runs.find_runs(power).tolist()] == brute(power.tolist())


@pytest.mark.parametrize("size", [1, 2, 8, 64, 2048])
def test_occurrences_equal_direct_comparison(size):
    rng = np.random.default_rng(size)
    blocks = rng.integers(0, 2 if size < 10 else 2**25, (size, 3))
    windows = rng.integers(0, 2 if size < 10 else 2**25, (2 * size, 3))
    windows[size // 2:size // 2 + size, 0] = blocks[:, 0]
    want = np.array([[np.array_equal(windows[d:d + size, c], blocks[:, c]) for c in range(3)] for d in range(size)])
    assert np.array_equal(ntt.occurrences(blocks, windows), want) and want[size // 2, 0]


def test_transform_round_trip():
    x = np.random.default_rng(0).integers(0, 2**30, (64, 5)).astype(np.uint64)
    for prime, generator in ntt.PRIMES:
        assert np.array_equal(ntt.backward(ntt.forward(x % np.uint64(prime), prime, generator), prime, generator),
                              x % np.uint64(prime))
    assert len(ntt.primes_above(2**30)) == 1 and len(ntt.primes_above(2**50)) == 2
    with pytest.raises(OverflowError):
        ntt.primes_above(2**200)


DOCS = "doc_id long, text string, runs string, collapsed long"


def test_edges(spark):
    long_text = " ".join(["ab"] * 50_000)
    rows = [(1, None, "x", 1), (2, "", "x", 1), (3, " \t\n ", "x", 1), (None, "a b a b a b a b", "x", 1),
            (5, "z z z z z z", "x", 1), (5, "z z z z z z", "x", 1), (6, "z z z z z", "x", 1), (7, long_text, "x", 1),
            (8, "x" * 200_000, "x", 1), (9, "é é é é é é é é é é é é", "x", 1)]
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed)
                  for r in runs.periodic_runs(spark.createDataFrame(rows, DOCS)).collect()))
    assert got == [(0, 8, [(0, 8, 2)], "a b"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (5, 6, [(0, 6, 1)], "z"),
                   (5, 6, [(0, 6, 1)], "z"), (6, 5, [], "z z z z z"), (7, 50_000, [(0, 50_000, 1)], "ab"),
                   (8, 1, [], "x" * 200_000), (9, 6, [(0, 6, 1)], "é é")]
    empty = runs.digest_columns(runs.periodic_runs(spark.createDataFrame([], DOCS)))
    assert empty.count() == 0 and empty.columns[:2] == ["doc_id", "n_runs"]


def test_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in op11_runs(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        words = told(d.doc_id, d.text)
        if len(words) > 3000:
            continue
        found, r = brute(words), got[d.doc_id]
        some += bool(found)
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        assert r.n_runs == len(found)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, found).encode()).hexdigest()
    assert some > 10
