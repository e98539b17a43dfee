import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corridor.llm import ngram_join as J


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def plain_set(text, n=4):
    w = words_of(text)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, percent=85):
    sets = [plain_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                group[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), d), d)
    return sorted((d, len(s), low[root(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def corpus(seed, groups=8, near=12):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocab, k=70)
    rows = []
    for _ in range(groups):
        base = rng.choices(vocab, k=rng.randrange(3, 150))
        for _ in range(rng.randrange(1, near)):
            w = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 3, 5))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            if rng.random() < 0.3:
                at = rng.randrange(len(w) + 1)
                w[at:at] = passage
            rows.append(" ".join(x.upper() if rng.random() < 0.1 else x for x in w))
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


def got(spark, rows, schema="doc_id long, text string", **kw):
    df = J.link_components(spark.createDataFrame(rows, schema), **kw)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


@pytest.mark.parametrize("seed, shard_tokens", [(1, 200_000), (2, 300), (3, 60)])
def test_components_equal_brute_force(spark, seed, shard_tokens):
    """Small shards force the passes between shards."""
    rows = corpus(seed)
    assert got(spark, rows, shard_tokens=shard_tokens) == brute(rows)


def test_chain_between_shards(spark):
    """A drifting chain: neighbours link, ends do not, whatever shard they fall in."""
    w = [f"t{i}" for i in range(260)]
    rows = [(i, " ".join(w[4 * i:4 * i + 100])) for i in range(40)]
    assert got(spark, rows, shard_tokens=150) == brute(rows)


def test_edges(spark):
    long = " ".join(f"x{i % 5000}y{i}" for i in range(40_000))
    rows = [(5, None), (6, ""), (7, " \t\n"), (8, "one two"), (9, "ONE\vtwo"), (10, "one two three"), (11, long), (12, long),
            (12, long), (13, "naïve Éa b c d"), (14, "naïve Éa b c d"), (15, "naïve éa b c d")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_null_ids_and_clashing_columns(spark):
    rows = [(None, "a b c d e", 1, "x"), (3, "a b c d e", 2, "y"), (4, "q r s t u", 3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, set_key long, component_id string")
    out = {(r.doc_id, r.component_id) for r in J.link_components(df).collect()}
    assert out == {(None, 3), (3, 3), (4, 4)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 24), min_size=1, max_size=20), min_size=2, max_size=14, unique=True),
       st.sampled_from([60, 85]))
def test_trie_links_connect_what_brute_force_connects(sets, percent):
    ordered = [sorted(s) for s in sets]
    linked = {(i, j) for i in range(len(sets)) for j in range(len(sets)) if i != j
              and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])}
    trie = J.Trie(ordered)
    for i in range(len(sets)):
        assert set(trie.links(i, percent, [False] * len(sets))) == {j for a, j in linked if a == i}
    found = J.trie_links(ordered, list(range(len(sets))), percent)
    assert all(p in linked for p in found)

    def roots(pairs):
        g = list(range(len(sets)))
        for _ in g:
            for a, b in pairs:
                g[a] = g[b] = min(g[a], g[b])
        return g
    assert roots(found) == roots(linked)


def test_low_prefix_guarantee():
    """Linked sets share enough of their first shingles for the first filter."""
    rng = np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(2, 200))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        drop = int(len(a) * rng.uniform(0, 0.15))
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, int(rng.integers(0, 4)), dtype=np.uint64)]))
        k = len(np.intersect1d(a, b))
        if not len(b) or 100 * k < 85 * (len(a) + len(b) - k):
            continue
        low = lambda s: s[:len(s) - J.need(len(s), 85) + max(1, int(J.EXTRA * len(s)))]
        for s in (a, b):
            assert len(np.intersect1d(low(a), low(b))) >= max(1, int(J.EXTRA * 0.85 * len(s)))


def brute_links(rows, percent=85):
    sets = {}
    for d, t in rows:
        if s := frozenset(plain_set(t)):
            sets.setdefault(s, []).append(d)
    keys = list(sets)
    return {frozenset((min(sets[a]), min(sets[b]))) for i, a in enumerate(keys) for b in keys[:i]
            if 100 * len(a & b) >= percent * len(a | b)}


@pytest.mark.parametrize("seed, shard_tokens", [(1, 200_000), (4, 250)])
def test_every_link_is_listed(spark, seed, shard_tokens):
    rows = corpus(seed) + [(1, None), (2, "")]
    rows += [(9000 + i, t) for i, (_, t) in enumerate(rows[:5])]
    links, members = J.class_links(spark.createDataFrame(rows, "doc_id long, text string"), shard_tokens=shard_tokens)
    held = {}
    for r in members.collect():
        held.setdefault(r.set_key, []).append(r.doc_id)
    assert sorted(d for k, ds in held.items() if k is not None for d in ds) == sorted(d for d, t in rows if plain_set(t))
    found = [(min(held[r.a]), min(held[r.b])) for r in links.collect()]
    assert len(found) == len(set(found)) and {frozenset(p) for p in found} == brute_links(rows) != set()


def test_bands_keep_linked_sizes_together(spark, monkeypatch):
    """Sets of one cluster and all sizes: every two sizes within the threshold meet, far ones do not."""
    rows = [(1, n, n) for n in range(1, 400)]
    out = J._banded(spark.createDataFrame(rows, "center long, member long, n long"), 85, 100).collect()
    at = {}
    for r in out:
        at.setdefault(r.member, set()).add(r.center)
    assert all(len(c) == 2 for c in at.values())
    for a in range(1, 400):
        for b in range(a, 400):
            if 100 * a >= 85 * b:
                assert at[a] & at[b], (a, b)
            if 100 * 100 * a < 84 * 84 * b:
                assert not at[a] & at[b]
    assert J._banded(spark.createDataFrame(rows, "center long, member long, n long"), 85, 10**9).count() == 399


def test_lean_bands_leave_out_nested_units(spark):
    """Where a band has no neighbour its sets are in one unit; linked sizes still meet, and no unit lies within another."""
    rows = [(1, n, n) for n in (1, 2, 3, 5, 40, 41, 200, 230, 260, 300, 1000, 1001)] + [(2, n, 700 + n % 20) for n in range(50)]
    out = J._banded(spark.createDataFrame(rows, "center long, member long, n long"), 85, 100, lean=True).collect()
    units = {}
    for r in out:
        units.setdefault(r.center, set()).add((r.member, r.n))
    assert {x for u in units.values() for x in u} == {(m, n) for _, m, n in rows}
    found = list(units.values())
    assert not any(a <= b for i, a in enumerate(found) for j, b in enumerate(found) if i != j)
    for c in (1, 2):
        for _, a, x in (r for r in rows if r[0] == c):
            for _, b, y in (r for r in rows if r[0] == c):
                assert min(x, y) * 100 < 85 * max(x, y) or any({(a, x), (b, y)} <= u for u in found)


def test_components_stop_at_stars(spark, monkeypatch):
    """Links that are stars already take no step; chains, circles and repeated links still give the smallest node."""
    from corridor.llm import components as C
    steps = []
    write = C.materialise
    monkeypatch.setattr(C, "materialise", lambda df, label, *a: (steps.append(label), write(df, label, *a))[1])

    def parts(links):
        df = spark.createDataFrame(links, "a long, b long")
        return {r.node: r.component for r in C.connected_components(df).collect()}
    assert parts([(5, 1), (1, 6), (7, 1), (9, 8), (9, 8), (3, 3)]) == {1: 1, 5: 1, 6: 1, 7: 1, 8: 8, 9: 8}
    assert parts([]) == {}
    assert steps == ["links", "links"]
    assert parts([(i, i + 1) for i in range(20)] + [(30, 31), (31, 32), (32, 30), (32, 40)]) == {
        **{i: 0 for i in range(21)}, **{i: 30 for i in (30, 31, 32, 40)}}
