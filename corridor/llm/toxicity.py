"""Toxicity: averaged subword-bag embeddings under a linear softmax, trained jointly in numpy.

A word is a run of letters, digits and bytes over 127 of the lower-cased text. Its
vector is the mean of the embeddings of its subwords: the word itself and its
character n-grams (SHORTEST to LONGEST bytes, with marks at both ends), each hashed to
one of BUCKETS rows. Misspelt and inflected words that were never seen share most of their
n-grams with words that were. A window is WINDOW words in a row, a bag whose vectors are averaged; windows
begin every WINDOW / 2 words, and the last ends with the text. The linear softmax gives the window's
probability of class 1, and a text scores as its highest window, so that a few words count the same in
a short and in a very long text.

Embeddings and softmax are trained together on a bounded sample of labelled texts. In every epoch
each text's highest window is found with the model so far, and the label is learned from it, in batches with
a random share DROPPED of the subwords left out and a step size per row that shrinks with its gradients.

For scoring, the model folds to one number per bucket, a table of fixed size that is broadcast; each word's number is
computed once per task (and anew after CACHE distinct words).

Defined results: a null or empty text, or one without words, scores as an empty bag, by the softmax's bias
alone; null labels and labels other than 0 and 1 are not learned from; a text labelled twice is learned
from twice; without any label the score is 0.5; without texts of both classes it is the known class's;
repeated rows give one row each; an id that is null is not held out;
an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor.llm.shingles import mix
from corridor.llm.storage import materialise

BUCKETS = 1 << 18
DIMS = 8
SHORTEST, LONGEST = 2, 5
WINDOW = 6
MAX_ROWS = 6_000            # labelled texts learned from, at most
MAX_BYTES = 32 << 20        # of all of them together
MAX_TEXT = 1 << 20          # longer texts are not learned from (they are scored whole)
CACHE = 1 << 18
DROPPED = 0.7               # share of subwords left out of a training bag, so that the others must carry the word
_SHARES = 1_000_003
_AT_ONCE = 1 << 14         # words hashed together

_WORD_BYTES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_rng = np.random.default_rng(13)
_POWERS = _rng.integers(1, 2**62, 1 << 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(_WORD_BYTES).split()


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of the words, in order, and how many each word has (at least one)."""
    raw = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64) + np.uint64(1)
    sizes = np.array([len(w) + 2 for w in words])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    room = np.repeat(ends, sizes) - np.arange(len(raw))     # bytes up to the word's end, from each byte
    offset = (np.arange(len(raw)) - np.repeat(starts, sizes)) & (len(_POWERS) - 1)
    whole = np.add.reduceat(raw * _POWERS[offset], starts) + sizes.astype(np.uint64)
    grams, rolling = [], np.zeros(len(raw), np.uint64)
    for n in range(1, min(LONGEST, len(raw)) + 1):
        rolling[:len(raw) - n + 1] += raw[n - 1:] * _POWERS[n]
        if n >= SHORTEST:
            at = np.flatnonzero(room >= n)
            grams.append((at, mix(rolling[at] + np.uint64(n))))
    word_at = np.repeat(np.arange(len(words)), sizes)
    owner = np.concatenate([np.arange(len(words)), *(word_at[at] for at, _ in grams)])
    code = np.concatenate([mix(whole), *(g for _, g in grams)]) % np.uint64(BUCKETS)
    order = np.argsort(owner, kind="stable")
    return code[order].astype(np.int64), np.bincount(owner, minlength=len(words))


def window_bounds(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of every window of a text of ``n`` words."""
    if n <= WINDOW:
        return np.zeros(min(n, 1), np.int64), np.full(min(n, 1), n, np.int64)
    first = np.arange(0, n - WINDOW, WINDOW // 2)
    first = np.append(first, n - WINDOW)
    return first, first + WINDOW


@dataclass
class Vocabulary:
    """Distinct words numbered by first appearance, with their subwords."""

    numbers: defaultdict = field(default_factory=defaultdict)

    def __post_init__(self):
        self.numbers.default_factory = self.numbers.__len__

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))

    def since(self, n: int) -> list[bytes]:
        out = []
        for w in reversed(self.numbers):
            if len(out) == len(self.numbers) - n:
                break
            out.append(w)
        return out[::-1]


@dataclass
class Model:
    """What scoring needs: the difference of the two classes' logits per bucket, and its bias."""

    weights: np.ndarray
    bias: float

    def word_values(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.empty(0)
        at, count = subwords(words)
        return np.add.reduceat(self.weights[at].astype(float), np.cumsum(count) - count) / count


def highest(values: np.ndarray) -> tuple[float, int, int]:
    """Mean of the best window of a text's word values, and where it begins and ends; (0, 0, 0) without words."""
    if not len(values):
        return 0.0, 0, 0
    first, end = window_bounds(len(values))
    sums = np.append(0.0, np.cumsum(values))
    means = (sums[end] - sums[first]) / (end - first)
    best = int(means.argmax())
    return float(means[best]), int(first[best]), int(end[best])


def fit(texts: list[str], labels: np.ndarray, epochs: int = 20, batch: int = 64, rate: float = 1.0,
        decay: float = 1e-3, seed: int = 13) -> Model:
    """Train embeddings and softmax together; the texts' order does not matter to the windows chosen."""
    rng = np.random.default_rng(seed)
    vocabulary = Vocabulary()
    docs = [vocabulary.ids(words_of(t)).astype(np.int32) for t in texts]
    words = list(vocabulary.numbers)
    parts = [subwords(words[i:i + _AT_ONCE]) for i in range(0, len(words), _AT_ONCE)] or [(np.empty(0, int),) * 2]
    flat, count = (np.concatenate(x) for x in zip(*((a.astype(np.int32), n) for a, n in parts)))
    del parts, words
    start = np.cumsum(count) - count
    embed = rng.uniform(-1 / DIMS, 1 / DIMS, (BUCKETS, DIMS)).astype(np.float32)
    soft, bias = rng.normal(0, 0.1, (DIMS, 2)), np.zeros(2)
    grown, grown_soft, grown_bias = np.full(BUCKETS, 1e-6), np.full((DIMS, 2), 1e-6), np.full(2, 1e-6)
    for epoch in range(epochs):
        logit = embed @ (soft[:, 1] - soft[:, 0]).astype(np.float32)
        values = np.add.reduceat(logit[flat].astype(float), start) / count if len(flat) else np.empty(0)
        order = rng.permutation(len(docs))
        for i in range(0, len(order), batch):
            some, bags = order[i:i + batch], []
            for k in some:
                if epoch == 0:      # nothing is known yet: any window
                    first, end = window_bounds(len(docs[k]))
                    j = int(rng.integers(len(first))) if len(first) else 0
                    bags.append(docs[k][first[j]:end[j]] if len(first) else docs[k])
                else:
                    _, a, b = highest(values[docs[k]])
                    bags.append(docs[k][a:b])
            size = np.array([len(b) for b in bags])
            word = np.concatenate(bags)
            of = np.repeat(np.arange(len(bags)), size)
            n = count[word]
            at = flat[np.repeat(start[word] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            share = np.repeat(1.0 / (n * size[of]), n)
            bag = np.repeat(of, n)
            kept = rng.random(len(at)) >= DROPPED
            at, share, bag = at[kept], share[kept] / (1 - DROPPED), bag[kept]
            rows, place = np.unique(at, return_inverse=True)
            # mean[bag] = sum of share * embed[row]: the bags' share of every row, dense over the batch's rows
            mixing = np.bincount(bag * len(rows) + place, share, len(bags) * len(rows)).reshape(len(bags), len(rows))
            mean = mixing @ embed[rows]
            scores = mean @ soft + bias
            p = np.exp(scores - scores.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(bags)), labels[some]] -= 1
            # Gradients of the summed loss; a row's step shrinks with the size of its own gradients.
            by_row = mixing.T @ p @ soft.T + decay * embed[rows] / len(bags)
            by_soft, by_bias = mean.T @ p, p.sum(axis=0)
            grown[rows] += (by_row * by_row).mean(axis=1)
            embed[rows] -= (rate * by_row / np.sqrt(grown[rows])[:, None]).astype(np.float32)
            grown_soft += by_soft * by_soft
            soft -= rate * 0.2 * by_soft / np.sqrt(grown_soft)
            grown_bias += by_bias * by_bias
            bias -= rate * 0.2 * by_bias / np.sqrt(grown_bias)
    return Model((embed @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def learnable(doc_id: Column) -> Column:
    """Rows whose labels may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return F.crc32(doc_id.cast("string")) % 5 != 0


def sample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
           max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> list[tuple[str | None, int]]:
    """(text, label) of at most ``max_rows`` labelled rows and ``max_bytes``, the first by a hash of id and text."""
    marked = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.coalesce(learnable(F.col("id")), F.lit(False)))
    n = marked.count()
    if n == 0:
        return []
    # Twice the rows wanted, as some may have no text or a long one; a bounded number of small rows to broadcast.
    share = int(min(1.0, 2 * max_rows / n) * _SHARES) + 1
    picked = marked.where(F.pmod(F.xxhash64("id"), F.lit(_SHARES)) < share).limit(4 * max_rows)
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(picked), "id")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = materialise(rows.where(size <= MAX_TEXT).select("text", "label", size.alias("size"), F.xxhash64("id", "text").alias("at")),
                       "toxic-sample")
    first = rows.groupBy("at").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).orderBy("at").limit(max_rows)
    upto, total, count = None, 0, 0
    for r in first.collect():
        total, count = total + r.size, count + r.n
        if total > max_bytes or count > max_rows:
            break
        upto = r["at"]
    if upto is None:
        return []
    got = rows.where(F.col("at") <= upto).select("text", "label").collect()
    return sorted(((r.text, r.label) for r in got), key=lambda x: (x[0] or "", x[1]))


def train(docs: DataFrame, labels: DataFrame, **columns) -> Model:
    """The model learned from :func:`sample`; without labels every score is 0.5."""
    rows = sample(docs, labels, **columns)
    if not rows:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    return fit([t for t, _ in rows], np.array([y for _, y in rows]))


class Scorer:
    """Scores texts, keeping the values of words already seen."""

    def __init__(self, model: Model):
        self.model = model
        self.vocabulary, self.values = Vocabulary(), np.empty(0)

    def __call__(self, text: str | None) -> tuple[float, int, int]:
        """Probability of class 1, and the first word and end of the highest window."""
        if len(self.values) > CACHE:
            self.vocabulary, self.values = Vocabulary(), np.empty(0)
        ids = self.vocabulary.ids(words_of(text))
        new = self.vocabulary.since(len(self.values))
        parts = [self.model.word_values(new[i:i + _AT_ONCE]) for i in range(0, len(new), _AT_ONCE)]
        self.values = np.concatenate([self.values, *parts]) if parts else self.values
        logit, first, end = highest(self.values[ids])
        return float(1 / (1 + np.exp(-np.clip(logit + self.model.bias, -35, 35)))), first, end


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, first, end) of every whole text: the score is that of the words from ``first`` to ``end``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            found = [scorer(t.as_py()) for t in b.column(1)]
            p, first, end = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(p, pa.float64()), pa.array(first, pa.int64()), pa.array(end, pa.int64())],
                ["doc_id", "score", "first", "end"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, score double, first bigint, end bigint")


def predict(docs: DataFrame, model: Model, **columns: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    s = score(docs, model, **columns)
    return s.select("doc_id", F.coalesce(~learnable(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"))
