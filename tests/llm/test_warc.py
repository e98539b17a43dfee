import hashlib
import heapq
import random

from corridor.llm import warc

SCHEMA = "page_id long, url string, html string"


def brute(rows):
    first = {}
    for p, _, h in rows:
        h = h or ""
        if p is not None and len(h.encode()) >= 100:
            first[h] = min(first.get(h, p), p)
    out = []
    for p, _, h in rows:
        h = h or ""
        to = first.get(h)
        copies = sum((x or "") == h for _, _, x in rows)
        again = to is not None and copies > 1 and p != to
        out.append((p, len(h.encode()), hashlib.sha256(h.encode()).hexdigest(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


def read(spark, rows):
    df = warc.round_trip(spark.createDataFrame(rows, SCHEMA).repartition(3))
    return df.collect()


def digest(rows):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


def pages(n=60, seed=1):
    rng = random.Random(seed)
    bodies = ["<p>é\r\n\r\nWARC/1.1\r\n" + "x" * 200, "short", "y" * 99, "y" * 100, "", None, "é" * 50, "z" * 70_000]
    return [(i, rng.choice([f"https://a.example/{rng.randrange(5)}?q=%20 x", "http://B.example.org:8080/p#f", None, "not a url"]),
             rng.choice(bodies) if rng.random() < 0.6 else f"<html>{i}</html>" * 20) for i in rng.sample(range(1000), n)]


def test_round_trip_equals_brute_force(spark):
    rows = pages()
    assert digest(read(spark, rows)) == brute(rows)


def test_histories_are_in_global_order(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_ROWS", 10)
    got = sorted(read(spark, pages(80, 2)), key=lambda r: (r.range_no, r.place))
    keys = [(r.url_key, r.captured) for r in got]
    assert keys == sorted(keys) and len(got) == 80 and len({r.range_no for r in got}) > 2


def test_loser_tree_merges():
    rng = random.Random(9)
    for k in (0, 1, 2, 3, 7, 16, 33):
        runs = [sorted(rng.choices(range(50), k=rng.randrange(20))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == list(heapq.merge(*runs))


def test_nulls_and_repeated_rows(spark):
    body = "b" * 150
    rows = [(None, None, None), (None, "u", body), (7, "u", body), (7, "u", body), (9, "v", body), (None, "n", "c" * 120), (None, "n", "c" * 120)]
    assert digest(read(spark, rows)) == brute(rows)
    assert read(spark, []) == []


def test_offsets_address_records(spark, tmp_path):
    rows = pages(30, 4)
    path = f"file://{tmp_path}/archives"
    got = warc.round_trip(spark.createDataFrame(rows, SCHEMA), path).collect()
    for r in got:
        raw = (tmp_path / "archives" / r.archive).read_bytes()[r.offset:r.offset + r.length]
        (headers, at, size, _), = warc.parse_archive(raw)
        assert at == 0 and size == len(raw) and headers["warc-type"] == r.record_type


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "u", "h", "d", 5)], SCHEMA + ", digest string, bytes int")
    assert warc.round_trip(df).first().payload_bytes == 1


def test_url_key():
    assert warc.url_key("https://www.A.example:8080/x/y?q=1#f") == "example,a,www:8080)/x/y?q=1"
    assert warc.url_key("http://a.example") == "example,a)/" and warc.url_key("nothing") == "nothing"
