"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL.

Tokens are runs of letters and digits and runs of punctuation, lower-cased in
ASCII. Features are hashed into a fixed number of coordinates: the 1- and
2-grams of the tokens, and the 1- to 3-grams of their shapes (case of the first
and last letter, punctuation, whether the token repeats the one before). Logarithms
of counts are scaled to unit length in both groups. Training takes a bounded sample
of labelled rows (``max_rows``) whose id may be learned from; a score is a
sparse dot product with the broadcast weights, whose size is fixed.

Defined results: a null or empty text has the bias alone and still gets a
score; null labels and labels other than 0 and 1 are not learned from; a
document labelled twice is learned from twice; without any label the score is
0.5; repeated rows give one row each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corridor.llm import ftrl
from corridor.llm.shingles import mix, ngrams, word_hashes
from corridor.llm.storage import learnable, materialise

DIMS = 1 << 18             # the last coordinate is the bias
MAX_ROWS = 8_000           # labelled rows learned from, about
MAX_BYTES = 96 << 20       # of their features; the rows that exceed it, in order of a hash, are left out
_BUCKETS = 1_000_003

_SPACES = bytes(32 if c == 32 or 9 <= c <= 13 else c for c in range(256))
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_KINDS = np.array([1 if c >= 128 or chr(c).isalnum() else 2 for c in range(256)], np.uint8)


# Shape of a byte: upper case, lower case, digit, other letters, or the punctuation itself.
_SHAPES = np.array([1 if 65 <= c <= 90 else 2 if 97 <= c <= 122 else 3 if 48 <= c <= 57 else 4 if c >= 128 else c
                    for c in range(256)], np.uint64)
_HALF = DIMS // 2


def _unit(group: tuple[np.ndarray, int]) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of the n-grams up to a length; words take the lower half, shapes the upper one."""
    words, longest = group
    grams = np.concatenate([ngrams(words, n) for n in range(1, longest + 1) if n <= len(words)])
    at, counts = np.unique(grams % np.uint64(_HALF - 1), return_counts=True)
    x = np.log1p(counts)
    return at + np.uint64((longest - 2) * _HALF), x / np.sqrt((x * x).sum())


def features(raw: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct coordinates and values of a UTF-8 text; the bias is always there."""
    edges: list[np.ndarray] = []
    tokens = word_hashes((raw or b"").translate(_SPACES), _KINDS, _LOWER, edges)
    if not len(tokens):
        return np.array([DIMS - 1]), np.ones(1)
    ends = _SHAPES[np.concatenate(edges)]
    again = np.concatenate(([False], tokens[1:] == tokens[:-1]))
    shapes = mix(ends[:, 0] * np.uint64(512) + ends[:, 1] * np.uint64(2) + again.astype(np.uint64))
    at, x = zip(*(_unit(group) for group in ((tokens, 2), (shapes, 3))))
    return np.concatenate([*at, [DIMS - 1]]).astype(np.int64), np.concatenate([*x, [1.0]])


def _featured(rows: DataFrame) -> DataFrame:
    """(at, x, label) as packed arrays of the (text, label) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, x = [], []
            for raw in b.column(0).cast(pa.binary()):
                a, v = features(raw.as_py())
                at.append(a.astype(np.int32).tobytes())
                x.append(v.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.binary()), pa.array(x, pa.binary()), b.column(1)],
                                             ["at", "x", "label"])

    return rows.mapInArrow(run, "at binary, x binary, label int")


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          max_rows: int = MAX_ROWS, epochs: int = 3) -> np.ndarray:
    """Weights learned from about ``max_rows`` labelled rows, chosen by a hash of the id."""
    marked = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.coalesce(learnable(F.col("id")), F.lit(False)))
    n = marked.count()
    if n == 0:
        return np.zeros(DIMS)
    share = min(1.0, max_rows / n)
    picked = marked.where(F.pmod(F.xxhash64("id"), F.lit(_BUCKETS)) < int(share * _BUCKETS) + 1).limit(2 * max_rows)
    # The picked labels are at most 2 * max_rows rows, so they may be broadcast.
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(picked), "id")
    got = materialise(_featured(rows.select("text", "label")), "quality-sample")
    # A few thousand rows: one task adds up their bytes.
    upto = F.sum(F.octet_length("at") + F.octet_length("x")).over(
        Window.orderBy(F.xxhash64("at", "x")).rowsBetween(Window.unboundedPreceding, 0))
    got = got.select("*", upto.alias("upto")).where(F.col("upto") <= MAX_BYTES).collect()
    examples = sorted(((bytes(r["at"]), bytes(r["x"]), r["label"]) for r in got))
    model = ftrl.Ftrl(DIMS, 1, alpha=0.5, l1=0.002, l2=0.0)
    return ftrl.fit([(np.frombuffer(a, np.int32), np.frombuffer(x, np.float32).astype(float), y)
                     for a, x, y in examples], model, epochs)[:, 0]


def score(docs: DataFrame, weights: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.empty(len(b))
            for i, raw in enumerate(b.column(1).cast(pa.binary())):
                at, x = features(raw.as_py())
                out[i] = x @ shared.value[at]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-np.clip(out, -35, 35))))],
                                             ["doc_id", "score"])

    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, score double")


def predict(docs: DataFrame, weights: np.ndarray, **columns: str) -> DataFrame:
    """doc_id, held_out, score, predicted; an id that is null is not held out."""
    s = score(docs, weights, **columns)
    return s.select("doc_id", F.coalesce(~learnable(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"))
