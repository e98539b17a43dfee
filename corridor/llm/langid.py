"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

A text is lower-cased, everything but letters becomes a single space, and its
1- to 3-grams of code points are hashed into a fixed number of coordinates. The
value of a coordinate is its share of all n-grams of the text (TF) times its
inverse document frequency in the fitted sample (IDF). Weights come from
FTRL with an elastic net; a temperature fitted on a part of the sample that was
not trained on calibrates the probabilities.

The fit takes documents of every language, chosen by a hash of id and text: at most about
``max_per_lang`` of each, and with many languages fewer, so that all together stay near
``max_rows`` rows (but MIN_PER_LANG of each) and ``max_bytes`` of features. The hash is as wide as CELLS weights over all
languages allow, at most DIMS, so the table that is broadcast and the state of the fit have a fixed size.

Next to the language a prediction tells which share of the text's n-grams the model has a
weight for. It does not depend on the number of languages, as a probability does: text of a language or
script that was not learned has a low share whatever its best probability.

Defined results: a null text or one without letters is ``und`` with score 0,
and so is every text if nothing could be learned; null languages are not
learned from; repeated rows give one row each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corridor.llm import ftrl
from corridor.llm.storage import learnable, materialise

DIMS = 1 << 17             # coordinates at most; the last one is the bias
CELLS = 1 << 24            # weights over all languages at most
ORDERS = (1, 2, 3)
SCALE = 20.0               # term shares are small; this only sets the unit of the weights
MAX_PER_LANG, MIN_PER_LANG, MAX_ROWS = 1_000, 10, 20_000
MAX_BYTES = 96 << 20       # of the features of all rows learned from
MAX_TEXT = 1 << 20         # longer texts are not learned from (they are predicted whole)
CHUNK = 1 << 19            # code points hashed at a time
UNKNOWN = "und"
_BUCKETS = 1_000_003

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    """Which code points are letters, one flag each."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def cleaned(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text with one space around and between words; empty without letters."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[codes]
    if not letter.any():
        return np.empty(0, np.uint32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]                     # the first separator after a word stays, as the space
    out = np.where(letter, codes, 32)[keep]
    return np.concatenate(([32], out, [] if out[-1] == 32 else [32])).astype(np.uint32)


def width(langs: int) -> int:
    """Coordinates for so many languages."""
    return max(1 << 10, min(DIMS, 1 << (CELLS // max(1, langs)).bit_length() - 1))


def hashed(codes: np.ndarray, dims: int = DIMS) -> Iterator[np.ndarray]:
    """Coordinates of all n-grams, in arrays of bounded size."""
    c = codes.astype(np.uint32)
    for at in range(0, len(c), CHUNK):
        for n in ORDERS:
            part = c[at:at + CHUNK + n - 1]
            if len(part) < n:
                continue
            h = np.full(len(part) - n + 1, np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF))
            for i in range(n):
                h = (h ^ part[i:len(part) - n + 1 + i]) * np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(15)
            yield (h % np.uint32(dims - 1)).astype(np.int64)


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray          # coordinates x languages: weight times IDF; last row is the bias
    temperature: float = 1.0

    def __post_init__(self):
        self.weighted = (self.table != 0).any(axis=1)

    def logits(self, codes: np.ndarray) -> np.ndarray:
        return self._evidence(codes)[0]

    def _evidence(self, codes: np.ndarray) -> tuple[np.ndarray, float]:
        """Logits, and the share of the n-grams that have a weight."""
        total, n, known = np.zeros(len(self.langs)), 0, 0
        for h in hashed(codes, len(self.table)):
            total += self.table.take(h, axis=0).sum(axis=0, dtype=np.float64)
            n += len(h)
            known += np.count_nonzero(self.weighted.take(h))
        return total * SCALE / n + self.table[-1], known / n

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and probability."""
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """Language, probability and known share of n-grams."""
        codes = cleaned(text)
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0, 0.0
        logits, known = self._evidence(codes)
        p = ftrl.softmax(logits[None] / self.temperature)[0]
        return self.langs[int(p.argmax())], float(p.max()), known


def _counts(rows: DataFrame, dims: int) -> DataFrame:
    """(at, share, lang): packed coordinates and their share of the text's n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, x = [], []
            for t in b.column(0):
                parts = list(hashed(cleaned(t.as_py()), dims))
                a, n = np.unique(np.concatenate(parts) if parts else np.empty(0, np.int64), return_counts=True)
                at.append(a.astype(np.int32).tobytes())
                x.append((n / max(1, n.sum())).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.binary()), pa.array(x, pa.binary()), b.column(1)],
                                             ["at", "share", "lang"])

    return rows.mapInArrow(run, "at binary, share binary, lang string")


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by a shrinking search over its logarithm."""
    if not len(y):
        return 1.0
    loss = lambda t: -np.log(ftrl.softmax(logits / np.exp(t))[np.arange(len(y)), y] + 1e-12).mean()
    lo, hi = np.log(0.05), np.log(20.0)
    for _ in range(60):
        a, b = lo + (hi - lo) * 0.382, lo + (hi - lo) * 0.618
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          max_per_lang: int = MAX_PER_LANG, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, epochs: int = 3) -> LanguageModel:
    """Fit on documents whose id may be learned from."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & (F.octet_length("text") <= MAX_TEXT) & F.coalesce(learnable(F.col("id")), F.lit(False)))
    # One row per language comes to the driver, as in the model itself.
    per = rows.groupBy("lang").count().collect()
    if not per:
        return LanguageModel([], np.zeros((DIMS, 0), np.float32))
    each = max(MIN_PER_LANG, min(max_per_lang, max_rows // len(per)))
    part = docs.sparkSession.createDataFrame(
        [(r["lang"], int(min(1.0, each / r["count"]) * _BUCKETS) + 1) for r in per], "lang string, part long")
    dims = width(len(per))
    # Copies of one text fall together here, so ids are hashed with it.
    picked = rows.join(F.broadcast(part), "lang").where(F.pmod(F.xxhash64("id", "text"), F.lit(_BUCKETS)) < F.col("part"))
    got = materialise(_counts(picked.select("text", "lang"), dims), "langid-sample")
    # The rows are few; of a language whose texts are very long only the first by hash fit its share of the bytes.
    upto = F.sum(F.octet_length("at") + F.octet_length("share")).over(
        Window.partitionBy("lang").orderBy(F.xxhash64("at", "share")).rowsBetween(Window.unboundedPreceding, 0))
    fitting = got.select("*", upto.alias("upto")).where(F.col("upto") <= max(1, max_bytes // len(per)))
    data = sorted((bytes(r["at"]), bytes(r["share"]), r["lang"]) for r in fitting.collect() if len(r["at"]))
    langs = sorted({x for _, _, x in data})
    number = {x: i for i, x in enumerate(langs)}
    data = [(np.frombuffer(a, np.int32), np.frombuffer(s, np.float32), number[x]) for a, s, x in data]
    seen = np.zeros(dims)
    for a, _, _ in data:
        seen[a] += 1
    idf = np.log((1 + len(data)) / (1 + seen)) + 1
    examples = [(np.append(a, np.int32(dims - 1)), np.append(s * idf[a] * SCALE, 1.0).astype(np.float32), y)
                for a, s, y in data]
    held = examples[::5]
    weights = ftrl.fit([e for i, e in enumerate(examples) if i % 5],
                       ftrl.Ftrl(dims, len(langs), alpha=1.0, l1=0.001, l2=0.01), epochs)
    logits = np.array([x @ weights[a] for a, x, _ in held]).reshape(len(held), len(langs))
    table = (weights * np.append(idf[:-1], 1.0)[:, None]).astype(np.float32)
    return LanguageModel(langs, table, _temperature(logits, np.array([y for _, _, y in held], int)))


def with_language(docs: DataFrame, model: LanguageModel, text: str = "text", name: str = "language") -> DataFrame:
    """``docs`` with a column ``name``: struct of lang_pred, score and known (replacing a column of that name).

    Only the text goes to Python; all other columns stay in Spark.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double,known:double>")
    def found(texts: pa.Array) -> pa.Array:
        rows = [shared.value.judge(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([x for x, _, _ in rows], pa.string()),
                                           pa.array([s for _, s, _ in rows], pa.float64()),
                                           pa.array([k for _, _, k in rows], pa.float64())], ["lang_pred", "score", "known"])

    return docs.withColumn(name, found(F.col(f"`{text}`")))


def identify(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred and score."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return with_language(slim, model).select("doc_id", "language.lang_pred", "language.score")


def digest_columns(found: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; an id that is null is not held out."""
    return found.select("doc_id", F.coalesce(~learnable(F.col("doc_id")), F.lit(False)).alias("held_out"),
                        "lang_pred", "score")
