import os
import hashlib
import random
import sys

import pytest
from tokenizers import Tokenizer

from corridor.llm import bpe
from corridor.llm.queries import tokenizer_path

PATH = tokenizer_path()


def encoded(texts, encoder=None):
    encoder = encoder or bpe.Encoder(bpe.load(PATH), list)
    return [[i for word in words for i in word] for words in encoder.encode(texts)]


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def want(lib, texts):
    out = []
    for t in texts:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        out.append((len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return out


def test_encoder_equals_library_on_random_texts(lib):
    rng = random.Random(11)
    pieces = ["hello", "WORLD's", " ", "\n\t", "don't", "'s", "aaaaaaaa", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "ß", "ÉCOLE",
              "ΑΣ", "é", "İ", "½", "12", " ", "‍", "\U0001F600", "日本", "!!!***", "\x1c", "\x85", "$$$&&&", "ﬁ", "́"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(1, 15))) for _ in range(1500)]
    got = encoded(texts)
    assert got == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_splitter_equals_library_on_code_points(lib):
    """Every 7th code point that this Python's Unicode knows, between letters and before a mark."""
    import unicodedata
    points = [c for c in range(1, sys.maxunicode + 1, 7) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    texts = [f"a{chr(c)}b1{chr(c)}." for c in points]
    got = encoded(texts)
    bad = [hex(c) for c, x, t in zip(points, got, texts) if x != lib.encode(t, add_special_tokens=False).ids]
    assert bad == []


def test_merge_order_on_repeats(lib):
    texts = ["a" * n for n in range(1, 40)] + ["ab" * 30, "aab" * 20, "in" * 50 + "g", "q" * 3000, "the" * 2000]
    assert encoded(texts) == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_cache_stays_bounded(lib, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    e = bpe.Encoder(bpe.load(PATH), list)
    rng = random.Random(2)
    for _ in range(20):
        texts = [" ".join("".join(rng.choices("abcdef", k=6)) for _ in range(40)) for _ in range(3)]
        assert encoded(texts, e) == [lib.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(e.young) <= 200 and len(e.old) <= 200


def test_query_columns_and_edges(spark, lib):
    texts = [None, "", "   ", "same", "same", "long word " * 30_000, "x" * 50_000]
    df = spark.createDataFrame([(i if i else None, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r.doc_id: r[1:] for r in bpe.encode_decode_digest(df, PATH).collect()}
    assert [got[i if i else None] for i in range(len(texts))] == want(lib, texts)
    ids = {r.doc_id: r.ids for r in bpe.encode(df, PATH).collect()}
    assert ids[3] == lib.encode("same", add_special_tokens=False).ids and ids[None] == []
    assert bpe.encode_decode_digest(df.limit(0), PATH).count() == 0
    assert bpe.encode(df.limit(0), PATH).count() == 0


def test_whole_table_equals_library(spark, lib):
    from corridor.llm.queries import op4_bpe
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: tuple(r[1:]) for r in op4_bpe(spark, SF_SMALL).collect()}
    assert [got[d.doc_id] for d in docs] == want(lib, [d.text for d in docs])


def test_vocabulary_without_order_is_refused(tmp_path):
    import json
    bad = {"added_tokens": [], "model": {"vocab": {"a": 0, "b": 1, "ab": 2, "abb": 3}, "merges": [["ab", "b"], ["a", "b"]]}}
    p = tmp_path / "t.json"
    p.write_text(json.dumps(bad))
    with pytest.raises(ValueError):
        bpe.Vocabulary(str(p))


def test_only_the_driver_reads_the_file(spark, tmp_path):
    """The tasks run after the file is gone."""
    import shutil
    path = str(tmp_path / "tokenizer.json")
    shutil.copy(PATH, path)
    bpe._LOADED.pop(path, None)
    df = spark.createDataFrame([(1, "a small text"), (2, None)], "doc_id long, text string")
    lazy = bpe.encode(df, path)
    os.remove(path)
    assert {r.doc_id: r.ids for r in lazy.collect()} == {1: encoded(["a small text"])[0], 2: []}
