import hashlib
import random
import re

import pyarrow as pa
import pytest

from corridor.llm import decontaminate as D


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            wins.setdefault(tuple(w[k:k + 10]), set()).add(None if i is None else str(i))
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for size in {len(x) for x in wins}:
            for k in range(len(w) - size + 1):
                g = tuple(w[k:k + size])
                if g in wins:
                    hit |= set(range(k, k + size))
                    found |= wins[g] - {None}
        listed = ",".join(sorted(found))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def case(seed):
    rng = random.Random(seed)
    vocab = ["a", "B", "cc", "Dd", "é", "ß1", "7", "x_y", "日本"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice((1, 4, 9, 10, 11, 25, 0))))) for i in range(12)] + [(3, "a B"), (99, None)]
    docs = []
    for d in range(60):
        parts = rng.choices(vocab, k=rng.randrange(60))
        if rng.random() < 0.5:
            parts[len(parts) // 2:len(parts) // 2] = (rng.choice(items)[1] or "").split()
        docs.append((d, rng.choice([" ", ", ", "\n--", "\x00"]).join(parts)))
    return docs + [(1000, None), (1001, ""), (1002, "?!"), (1, docs[1][1]), (1, docs[1][1])], items


def run(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return D.find_contamination(d, b, **kw)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs, items = case(seed)
    items = [x for x in items if not x[1] or len(x[1].split()) != 1]
    got = sorted((tuple(r) for r in D.digest_columns(run(spark, docs, items)).collect()), key=str)
    assert got == brute(docs, items)


def test_shards_of_documents_in_another_order_each_time(spark):
    """Rows that come in a new order at every evaluation keep their number over all shards."""
    docs, items = case(4)

    def shuffled(batches):
        rows = pa.Table.from_batches(list(batches))
        yield from rows.take(random.SystemRandom().sample(range(len(rows)), len(rows))).combine_chunks().to_batches()

    d = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).mapInArrow(shuffled, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in D.digest_columns(D.find_contamination(d, b, shard_bytes=400)).collect()), key=str)
    assert got == brute(docs, items)


def test_shards_equal_one_automaton(spark):
    docs, items = case(3)
    one, many = (sorted(map(str, run(spark, docs, items, shard_bytes=n).collect())) for n in (1 << 20, 400))
    assert one == many
    got = sorted((tuple(r) for r in D.digest_columns(run(spark, docs, items, shard_bytes=400)).collect()), key=str)
    assert got == brute(docs, items)


def test_spans_point_into_the_original(spark):
    item = "One two THREE four five six seven eight nine ten eleven"
    text = f"été … {item.replace(' ', ', ')} rest"
    r = run(spark, [(1, text)], [(4, item)]).first()
    assert [text[s.start:s.end] for s in r.spans] == [item.replace(" ", ", ")]
    assert r["items"] == ["4"] and r.n_hit == 11


def test_edges(spark):
    docs = [(1, "a b c"), (None, "a b")]
    assert {r.n_hit for r in run(spark, docs, []).collect()} == {0}
    assert run(spark, [], [(1, "a b")]).count() == 0
    r = {x.doc_id: x for x in run(spark, docs, [(None, "a b"), (2, "")]).collect()}
    assert r[1].n_hit == 2 and r[1].n_items == 0 and r[None].n_hit == 2
    long = run(spark, [(1, "w " * 200_000 + "a b")], [(5, "a b")]).first()
    assert (long.n_words, long.n_hit, long.n_items) == (200_002, 2, 1)
    wide = spark.createDataFrame([(1, "a b", 9, "s")], "doc_id long, text string, n_hit int, spans string")
    assert D.find_contamination(wide, spark.createDataFrame([(5, "a b")], "item_id long, text string")).first().n_hit == 2
