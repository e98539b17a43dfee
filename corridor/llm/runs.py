"""Periodic runs of words: block convolution at dyadic scales, then exact extension.

A run is a maximal stretch of consecutive words with smallest period q whose length
is at least ``max(6, 4 q)``. At the scale B (1, 2, 4, ...) the words are cut into
blocks of B. A run with B <= q < 2 B holds at least two whole blocks in a row that occur
again q words on, so each block is searched for in the window of 2 B words that
begins B after it: the sum of squared differences at every distance comes from an
exact integer number-theoretic transform and is 0 just where the block occurs.
Neighbouring blocks with one distance make a seed, which is extended word by word
by less than a block on both sides.

Two exact rules spare work. A block can occur again within 2 B words only if each of
its words does, so other blocks are not transformed. A window inside a run that a
smaller scale found yields only multiples of that run's period, so it is skipped.
The texts of a group (GROUP words, or one text that is longer) are searched as one
sequence with a separator of its own after each text.

Defined results: a null or empty text, or one of white space, has no words, no runs and an
empty collapsed text; repeated rows give one row each; a null id is carried through;
an empty table gives an empty result; only the two named columns are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor.llm.ntt import occurrences

GROUP = 1 << 18            # words searched together
_CELLS = 1 << 18           # window words transformed together
RUN_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"
_ARROW_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _gaps(ids: np.ndarray) -> np.ndarray:
    """Distance from each word to its next occurrence."""
    gap = np.full(len(ids), np.iinfo(np.int64).max)
    order = np.argsort(ids, kind="stable")
    again = ids[order[1:]] == ids[order[:-1]]
    gap[order[:-1][again]] = (order[1:] - order[:-1])[again]
    return gap


def _owners(n_blocks: int, size: int, runs: np.ndarray) -> np.ndarray:
    """For each block b the known run that holds the 2 * size words from it, or -1.

    Periods found so far are below ``size``, so by the periodicity lemma there is at most one.
    """
    owner = np.full(n_blocks, -1)
    first = -(-runs[:, 0] // size)
    count = np.maximum((runs[:, 0] + runs[:, 1] - 2 * size) // size - first + 1, 0)
    at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
    owner[at] = np.repeat(np.arange(len(runs)), count)
    return owner


def _seeds(padded: np.ndarray, blocks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) of all occurrences of the blocks at distances from ``size`` to ``2 size - 1``."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    step = max(1, _CELLS // (2 * size))
    for i in range(0, len(blocks), step):
        some = blocks[i:i + step]
        words = padded[np.arange(3 * size)[:, None] + some * size]
        words = np.unique(words, return_inverse=True)[1].reshape(3 * size, -1)
        d, column = np.nonzero(occurrences(words[:size], words[size:]))
        found.append((some[column], d + size))
    block, distance = zip(*found)
    return np.concatenate(block), np.concatenate(distance)


def _equal(padded: np.ndarray, n: int, at: np.ndarray, distance: np.ndarray, size: int, step: int) -> np.ndarray:
    """How many of the ``size`` words from ``at`` on, in direction ``step``, equal the word ``distance`` later."""
    out = np.empty(len(at), np.int64)
    rows = max(1, _CELLS // size)
    for i in range(0, len(at), rows):
        p = at[i:i + rows, None] + step * np.arange(size)
        q = p + distance[i:i + rows, None]
        same = (p >= 0) & (q < n)
        same &= padded[np.clip(p, 0, n)] == padded[np.clip(q, 0, n)]
        out[i:i + rows] = np.where(same.all(axis=1), size, same.argmin(axis=1))
    return out


def find_runs(ids: np.ndarray, longest: int | None = None) -> np.ndarray:
    """All runs of a sequence of word numbers, as rows (start, length, period) by start, then period.

    ``longest`` bounds the length of a run where separators cut the sequence.
    """
    n = len(ids)
    longest = n if longest is None else longest
    runs = np.empty((0, 3), np.int64)
    gap, size = _gaps(ids), 1
    padded = np.concatenate([ids, np.full(max(longest, 8), ids.min(initial=0) - 1)])
    while 4 * size <= longest and n // size > 1:
        if size > 1:
            pairs = len(gap) // 2 * 2
            gap = np.maximum(gap[0:pairs:2], gap[1:pairs:2])
        recurs = gap < 2 * size
        beside = np.zeros(len(gap), bool)
        beside[1:] |= recurs[:-1]
        beside[:-1] |= recurs[1:]
        owner = _owners(len(gap), size, runs)
        blocks = np.flatnonzero(recurs & beside)
        ends = np.append(runs[:, 0] + runs[:, 1], -1)       # owner -1: no run
        blocks = blocks[ends[owner[blocks]] < (blocks + 3) * size]
        block, distance = _seeds(padded, blocks, size)
        periods = np.append(runs[:, 2], 1)
        known = (block * size + distance + size <= ends[owner[block]]) & (distance % periods[owner[block]] == 0)
        block, distance = block[~known], distance[~known]
        order = np.lexsort((block, distance))
        block, distance = block[order], distance[order]
        new = np.ones(len(block), bool)
        new[1:] = (np.diff(distance) != 0) | (np.diff(block) != 1)
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(block)))
        block, distance = block[first], distance[first]
        # Fewer than a block is added on either side; a run repeats at least 3 q words, and 5 if q = 1.
        long = count * size + 2 * (size - 1) >= np.maximum(3 * distance, 6 - distance)
        block, distance, count = block[long], distance[long], count[long]
        left = _equal(padded, n, block * size - 1, distance, size, -1)
        right = _equal(padded, n, (block + count) * size, distance, size, 1)
        length = count * size + left + right + distance
        # A neighbour that matches whole but is no seed lies in a known run, and so does this stretch.
        keep = (left < size) & (right < size) & (length >= np.maximum(6, 4 * distance))
        fresh = np.stack([block * size - left, length, distance], axis=1)[keep]
        runs = np.concatenate([runs, fresh])
        size *= 2
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _groups(texts: Iterator[bytes]) -> Iterator[list[list[bytes]]]:
    group, total = [], 0
    for raw in texts:
        words = raw.split()             # bytes split at the six ASCII spaces, 0x20 and 0x09 to 0x0D
        if group and total + len(words) > GROUP:
            yield group
            group, total = [], 0
        group.append(words)
        total += len(words)
    if group:
        yield group


def _solve(group: list[list[bytes]]) -> Iterator[tuple[list[dict], bytes]]:
    """Runs and collapsed text of each list of words."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    lengths = np.array([len(words) for words in group])
    ids = np.empty(lengths.sum() + len(group), np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    for k, (at, words) in enumerate(zip(starts, group)):
        ids[at:at + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        ids[at + len(words)] = -1 - k
    runs = find_runs(ids, int(lengths.max(initial=0)))
    dropped = np.zeros(len(ids) + 1, np.int64)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
    dropped = np.cumsum(dropped) > 0
    cuts = np.searchsorted(runs[:, 0], np.append(starts, len(ids)))
    for k, (at, words) in enumerate(zip(starts, group)):
        own = runs[cuts[k]:cuts[k + 1]]
        if not len(own):
            yield [], b" ".join(words)
            continue
        kept = np.flatnonzero(~dropped[at:at + len(words)])
        yield ([{"start": int(s - at), "length": int(n), "period": int(q)} for s, n, q in own],
               b" ".join([words[i] for i in kept]))


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every whole text.

    ``runs`` holds (start, length, period) in words, by start, then period; ``collapsed`` are the
    words, joined by one space, without those that any run holds after its first period.
    """
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = (raw.as_py() or b"" for raw in b.column(1).cast(pa.binary()))
            at = 0
            for group in _groups(texts):
                found, collapsed = zip(*_solve(group))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(group)), pa.array([len(w) for w in group], pa.int64()),
                     pa.array(found, _ARROW_RUNS), pa.array(collapsed, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])
                at += len(group)

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, n_words bigint, runs {RUN_TYPE}, collapsed string")


def repeat_tail(doc_id: Column, text: Column) -> Column:
    """The text, where crc32 of the id is divisible by 10 with its words from a on repeated with period p.

    With n words and g the tenth of the crc32, a = g % n and p = 1 + (n - a) div (3 + g % 8).
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"))

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        at = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.array_join(F.transform(at, lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    held = F.transform(F.array(words), repeated)[0]
    some = text.rlike(r"[^\x20\x09-\x0D]")
    return F.when((h % 10 == 0) & some, held).otherwise(text)


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts, the run of greatest exponent (ties: smallest start, then period) and digests."""
    best = F.aggregate("runs", F.expr("CAST(NULL AS struct<start:bigint,length:bigint,period:bigint>)"),
                       lambda b, r: F.when(b.isNull() | (r.length * b.period > b.length * r.period), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
