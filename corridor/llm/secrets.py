"""Secret scan: fixed patterns plus two character Markov models compared by log-likelihood ratio.

Base kinds (``assign``, ``access``, ``hex``) are leftmost non-overlapping
matches of the fixed patterns below, each filtered by its length rule. A
fourth kind, ``markov``, covers token runs that no base span touches and that
the random-string model explains better than the identifier model.

Defined results: a null or empty text has no spans; repeated rows give one row
each; an empty table gives an empty result; a null id is carried through.
Spans are code-point offsets, end exclusive, ordered by start, then kind.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns and their length rules.
ASSIGN = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 12, 18, 16
KINDS = ("assign", "access", "hex", "markov")

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
# A maximal run that is long enough is the same as a match that passes the length rule.
_ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{ACCESS_MIN - 4},}}")
_HEX = re.compile(rf"[0-9a-f]{{{HEX_MIN},}}")

SPAN_TYPE = "array<struct<start:int,kind_no:int,end:int,kind:string>>"
ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
             "abcdefghijklmnopqrstuvwxyz0123456789",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")


@dataclass
class RandomnessModel:
    """Per-transition log-likelihood ratio (random over identifier) and the decision threshold."""

    ratio: np.ndarray          # 128 x 128, row = previous character, row 0 = start
    threshold: float           # mean ratio per character above which a run is random
    min_chars: int

    def score(self, run: str) -> float:
        codes = np.frombuffer(run.encode("ascii"), np.uint8)
        return float(self.ratio[np.concatenate(([0], codes[:-1])), codes].mean())


def _transitions(samples: list[str], smooth: float = 0.5) -> np.ndarray:
    counts = np.full((128, 128), smooth)
    for s in samples:
        codes = np.frombuffer(s.encode("ascii"), np.uint8)
        np.add.at(counts, (np.concatenate(([0], codes[:-1])), codes), 1)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def random_strings(n: int, seed: int = 7) -> list[str]:
    """Labelled positives: ``n`` random strings over the alphabets that keys are usually drawn from."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        alphabet = np.array(list(ALPHABETS[i % len(ALPHABETS)]))
        out.append("".join(rng.choice(alphabet, int(rng.integers(16, 65)))))
    return out


def identifiers(words: list[str], n: int, seed: int = 11) -> list[str]:
    """Labelled negatives: the given words alone and joined the way programmers join them."""
    if not words:
        words = ["value", "index", "name"]
    rng = np.random.default_rng(seed)
    out = [v for w in words for v in (w, w.upper())]
    for i in range(n):
        parts = [words[j] for j in rng.integers(0, len(words), int(rng.integers(2, 5)))]
        style = i % 5
        if style == 0:
            out.append("_".join(parts).lower())
        elif style == 1:
            out.append("-".join(parts).lower())
        elif style == 2:
            out.append("".join(p.capitalize() for p in parts) + str(rng.integers(0, 100)))
        elif style == 3:
            out.append("/".join(parts))
        else:
            out.append("_".join(parts).upper())
    return out


def fit_model(positives: list[str], negatives: list[str], min_chars: int = 16,
              false_positive_rate: float = 0.0005) -> RandomnessModel:
    """Fit both models on four fifths of the samples; set the threshold on the rest."""
    fit = lambda xs: [x for i, x in enumerate(xs) if i % 5]
    ratio = _transitions(fit(positives)) - _transitions(fit(negatives))
    model = RandomnessModel(ratio, 0.0, min_chars)
    held = sorted(model.score(x) for x in negatives[::5] if len(x) >= min_chars)
    if held:
        model.threshold = max(0.0, held[min(len(held) - 1, int(len(held) * (1 - false_positive_rate)))]) + 0.1
    return model


def train(docs: DataFrame, text: str = "text", max_docs: int = 2_000, max_words: int = 20_000,
          n_random: int = 6_000) -> RandomnessModel:
    """Train from labelled samples: generated random strings against words of the corpus.

    The words come from about ``max_docs`` documents chosen by a hash, and at
    most ``max_words`` distinct ones are kept; both are fixed bounds.
    """
    n = docs.count()
    if n == 0:
        return fit_model(random_strings(n_random), identifiers([], n_random))
    share = min(1.0, max_docs / n)
    rows = (docs.where(F.pmod(F.xxhash64(F.col(text)), F.lit(1_000_003)) < int(share * 1_000_003) + 1)
            .select(F.explode(F.expr(f"regexp_extract_all(`{text}`, '[A-Za-z]{{3,40}}', 0)")).alias("w"))
            .groupBy("w").count()
            .orderBy(F.xxhash64("w"), "w").limit(max_words).select("w").collect())
    words = sorted(r.w for r in rows)
    return fit_model(random_strings(n_random), identifiers(words, n_random))


def scan_text(text: str, model: RandomnessModel, candidate: re.Pattern) -> list[tuple[int, int, int, str]]:
    """All spans of one text as (start, kind number, end, kind), in order."""
    base = []
    low = text.lower() if ":" in text or "=" in text else ""
    if any(k in low for k in _KEYWORDS):
        base += [(m.start(), 0, m.end(), KINDS[0]) for m in _ASSIGN.finditer(text)
                 if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end(), KINDS[1]) for m in _ACCESS.finditer(text)]
    base += [(m.start(), 2, m.end(), KINDS[2]) for m in _HEX.finditer(text)]
    # Both lists are walked once: candidates come in order and do not overlap one another.
    taken = sorted((s, e) for s, _, e, _ in base)
    extra, at, reach = [], 0, 0
    for m in candidate.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            reach = max(reach, taken[at][1])
            at += 1
        if reach <= m.start() and model.score(m.group()) > model.threshold:
            extra.append((m.start(), 3, m.end(), KINDS[3]))
    return sorted(base + extra)


def find_secrets(docs: DataFrame, model: RandomnessModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id and ``spans``, an array of (start, kind_no, end, kind)."""
    candidate = rf"[A-Za-z0-9+/_=-]{{{model.min_chars},}}"
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out_type = pa.list_(pa.struct([("start", pa.int32()), ("kind_no", pa.int32()), ("end", pa.int32()),
                                   ("kind", pa.string())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(candidate)
        for b in batches:
            spans = [[dict(zip(("start", "kind_no", "end", "kind"), s)) for s in scan_text(t, model, pattern)]
                     if t else [] for t in (x.as_py() for x in b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, out_type)], ["doc_id", "spans"])

    return slim.mapInArrow(scan, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, spans {SPAN_TYPE}")


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts, base digest and the span list as text, derived from ``spans``."""
    listed = lambda a: F.array_join(F.transform(
        a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind_no"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(F.filter("spans", lambda s: s["kind_no"] < 3)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), count(3).alias("n_markov"))
