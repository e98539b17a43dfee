"""Benchmark decontamination with one Aho-Corasick automaton over the items' word windows.

A text becomes its words (A-Z lowered; ASCII other than letters and digits
separates) joined by single spaces. The automaton holds every window of ten
consecutive item words, and a shorter item as one window, each between spaces.
One scan over a document's normalised text finds all occurrences; word numbers
map them back to spans of the original text.

Defined results: a null or empty text has no words and no hits; an item without
words has no window; items repeated under one id count once; a window of an
item with a null id marks words but is not listed; repeated documents give one
row each; empty tables give no rows or no hits.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor.llm.storage import materialise

WINDOW = 10
SHARD_BYTES = 8 << 20      # window text held by one automaton; more items mean more scans, not a larger automaton

_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 32
               for c in range(256))

FOUND = ("doc_id {id}, n_words long, n_hit long, n_items long, items array<string>, "
         "spans array<struct<start:int,end:int>>")


def windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct windows of all items with the ids of the items that hold them: (window, items)."""
    slim = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, cuts = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = (t or "").encode().translate(_TABLE).split()
                for k in range(max(1, len(w) - size + 1) if w else 0):
                    ids.append(i)
                    cuts.append(b" ".join(w[k:k + size]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(cuts, pa.binary())],
                                             ["item_id", "window"])

    cuts = slim.mapInArrow(cut, "item_id string, window binary")
    return cuts.groupBy("window").agg(F.collect_set("item_id").alias("items"))


class Matcher:
    """The automaton over (window, items) rows."""

    def __init__(self, rows: list[tuple[bytes, list[str]]]):
        self.items = [tuple(items) for _, items in rows]
        self.words = [w.count(b" ") + 1 for w, _ in rows]
        self.auto = ahocorasick.Automaton()
        for k, (w, _) in enumerate(rows):
            self.auto.add_word(" " + w.decode("latin-1") + " ", k)
        if rows:
            self.auto.make_automaton()

    def scan(self, raw: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Word count, hit word ranges [first, last) merged and in order, items found."""
        words = raw.translate(_TABLE).split()
        if not words or not self.items:
            return len(words), [], set()
        # One byte per character keeps the automaton's alphabet at 256.
        norm = " " + b" ".join(words).decode("latin-1") + " "
        found = list(self.auto.iter(norm))
        if not found:
            return len(words), [], set()
        spaces = np.flatnonzero(np.frombuffer(norm.encode("latin-1"), np.uint8) == 32)
        last = np.searchsorted(spaces, [end for end, _ in found])       # the match ends before word number `last`
        first = last - np.array([self.words[k] for _, k in found])
        order = np.argsort(first, kind="stable")
        ranges: list[tuple[int, int]] = []
        for a, z in zip(first[order].tolist(), last[order].tolist()):
            if ranges and a < ranges[-1][1]:
                ranges[-1] = (ranges[-1][0], max(z, ranges[-1][1]))
            else:
                ranges.append((a, z))
        return len(words), ranges, {i for k in {k for _, k in found} for i in self.items[k]}


def original_spans(raw: bytes, ranges: list[tuple[int, int]]) -> list[dict]:
    """Word ranges as code-point spans of the original text."""
    b = np.frombuffer(raw.translate(_TABLE), np.uint8) != 32
    edge = np.diff(np.concatenate(([0], b.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    return [{"start": int(points[starts[a]]), "end": int(points[ends[z - 1]])} for a, z in ranges]


_BUILT: dict[str, Matcher] = {}


def _matcher(name: str, rows: list[tuple[bytes, list[str]]]) -> Matcher:
    """The worker's automaton of that name, built at its first task and kept until another is asked for."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Matcher(rows)
    return _BUILT[name]


def _scan(docs: DataFrame, rows: list[tuple[bytes, list[str]]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    name = uuid.uuid4().hex
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(name, shared.value)
        for b in batches:
            n_words, n_hit, items, spans = [], [], [], []
            for x in b.column(1).cast(pa.binary()):
                raw = x.as_py() or b""
                n, ranges, found = matcher.scan(raw)
                n_words.append(n)
                n_hit.append(sum(z - a for a, z in ranges))
                items.append(sorted(found))
                spans.append(original_spans(raw, ranges) if ranges else [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(list(map(len, items)), pa.int64()), pa.array(items, pa.list_(pa.string())),
                 pa.array(spans, span)], ["doc_id", "n_words", "n_hit", "n_items", "items", "spans"])

    return docs.mapInArrow(run, FOUND.format(id=docs.schema["doc_id"].dataType.simpleString()))


def find_contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items (sorted as strings) and spans (code points).

    The windows' size is measured first. While it stays within ``shard_bytes``
    one automaton goes to the executors; a larger benchmark is cut by window hash
    into automata of at most about that size and documents are scanned once for each, the
    hit words of a document being united afterwards.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    wins = windows(benchmark)
    size = wins.agg(F.sum(F.octet_length("window") + F.size("items") * 16)).first()[0] or 0
    shards = -(-size // shard_bytes)
    load = lambda df: [(bytes(r.window), list(r["items"])) for r in df.collect()]
    if shards <= 1:
        return _scan(slim, load(wins))
    wins = materialise(wins, "windows")
    # Rows get a number of their own, so that repeated ids stay apart while shards are united. They are written out
    # once: numbers drawn again in another row order would join hits to other rows.
    keyed = materialise(slim.select(F.struct(F.monotonically_increasing_id().alias("n"), "doc_id").alias("doc_id"), "text"),
                        "numbered")
    part = F.pmod(F.xxhash64("window"), F.lit(shards))
    found = None
    for k in range(shards):
        one = _scan(keyed, load(wins.where(part == k)))
        found = one if found is None else found.unionByName(one)
    g = found.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("all_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return _unite(slim, keyed, g)


def _unite(slim: DataFrame, keyed: DataFrame, g: DataFrame) -> DataFrame:
    """Merge overlapping spans of several shards and count their words in the text again."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    rows = keyed.join(g, "doc_id").select("doc_id", "text", "n_words", "items", "all_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hits, merged = [], []
            for text, found in zip(b.column(1).to_pylist(), b.column(4).to_pylist()):
                out: list[dict] = []
                for s in found:
                    if out and s["start"] < out[-1]["end"]:
                        out[-1]["end"] = max(s["end"], out[-1]["end"])
                    else:
                        out.append(dict(s))
                hits.append(sum(len((text[s["start"]:s["end"]]).encode().translate(_TABLE).split()) for s in out))
                merged.append(out)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).field("doc_id"), b.column(2), pa.array(hits, pa.int64()),
                 pa.array([len(x) for x in b.column(3)], pa.int64()), b.column(3), pa.array(merged, span)],
                ["doc_id", "n_words", "n_hit", "n_items", "items", "spans"])

    return rows.mapInArrow(run, FOUND.format(id=slim.schema["doc_id"].dataType.simpleString()))


def digest_columns(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
