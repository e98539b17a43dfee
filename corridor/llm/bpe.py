"""BPE encoding and decoding with batched numpy merge rounds.

The distinct new words of a batch are laid out as one flat array of symbols. In
every round each word's lowest-rank adjacent pair is found by binary search
over the sorted pair keys, all its occurrences in that word are merged from left
to right, and words without a mergeable pair leave the array. A round of
"all occurrences" equals merging one at a time because no merge makes a token
that an earlier-ranked merge uses; :class:`Vocabulary` checks that.

Reads a tokenizer file of the kind "NFC, white space collapsed, lower case;
split by pattern; byte-level symbols with an end-of-word suffix". Added tokens
inside a text are recognised as such, as the public library does by default.

Defined results: a null or empty text has no tokens; repeated rows give one row
each; an empty table gives an empty result; texts are encoded whole. Code
points that Unicode assigned after version 15.1 count as neither letter nor number.
"""

from __future__ import annotations

import hashlib
import json
import sys
import unicodedata
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The split pattern of the tokenizer file, with {L} and {N} for its letter and number classes.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^\s{L}{N}]+"
CACHE_WORDS = 150_000      # words in each of the two generations of the cache, per Python worker
CACHE_WORD_CHARS = 64      # longer words are encoded again each time they occur
NO_PAIR = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable, else from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(printable) else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Pair table of a tokenizer file as sorted numpy arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids = dict(model["vocab"])
        self.suffix = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*ids.values(), *self.added.values()]))
        for token, i in [*ids.items(), *self.added.items()]:
            self.tokens[i] = token
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.size = len(self.tokens)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        first_made = np.full(self.size, -1, np.int64)
        first_made[made[::-1]] = np.arange(len(made))[::-1]
        rank = np.arange(len(made))
        if (first_made[left] >= rank).any() or (first_made[right] >= rank).any() or len(np.unique(made)) < len(made):
            raise ValueError("a merge uses a token that a later merge makes")
        symbols = byte_symbols()
        self.inner = np.array([ids[s] for s in symbols], np.int64)
        self.final = np.array([ids[s + self.suffix] for s in symbols], np.int64)

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Token ids of each word (non-empty strings), by merge rounds over one flat array."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        lengths = np.array([len(r) for r in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.inner[flat]
        ends = np.cumsum(lengths)
        sym[ends - 1] = self.final[flat[ends - 1]]
        word = np.repeat(np.arange(len(words)), lengths)
        out: list[np.ndarray] = [None] * len(words)
        while len(sym):
            rank, made = self._pairs(sym, word)
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            best = np.minimum.reduceat(rank, starts)
            spans = np.diff(np.append(starts, len(sym)))
            done = best == NO_PAIR
            if done.any():
                for k in np.flatnonzero(done):
                    out[word[starts[k]]] = sym[starts[k]:starts[k] + spans[k]]
                keep = np.repeat(~done, spans)
                sym, word, rank, made = sym[keep], word[keep], rank[keep], made[keep]
                best, spans = best[~done], spans[~done]
                if not len(sym):
                    break
            hit = rank == np.repeat(best, spans)
            # In a run of overlapping occurrences (a a a) every second one merges, from the left.
            at = np.flatnonzero(hit)
            fresh = np.concatenate(([True], np.diff(at) > 1))
            run_start = at[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
            at = at[(at - run_start) % 2 == 0]
            sym[at] = made[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, word = sym[keep], word[keep]
        return out

    def _pairs(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of the pair that starts at each position; NO_PAIR where none does."""
        rank = np.full(len(sym), NO_PAIR)
        made = np.zeros(len(sym), np.int64)
        if len(sym) > 1:
            key = sym[:-1] * self.size + sym[1:]
            inside = np.flatnonzero(word[1:] == word[:-1])
            # Equal pairs are frequent; sorted, they are searched for together and near each other.
            key, back = np.unique(key[inside], return_inverse=True)
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[at] == key
            rank[inside] = np.where(ok, self.ranks[at], NO_PAIR)[back]
            made[inside] = np.where(ok, self.made[at], 0)[back]
        return rank, made


class Splitter:
    """Normalises a text and splits it into words and added tokens."""

    def __init__(self, added: list[str]):
        self.added = added
        longest_first = "|".join(map(regex.escape, sorted(added, key=len, reverse=True)))
        self.added_pattern = regex.compile(f"({longest_first})")
        self.common = regex.compile(SPLIT.format(L=r"\p{L}", N=r"\p{N}"))
        self.exact = None

    def words(self, text: str) -> list[str]:
        text = text if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        return self._pattern(text).findall(text)

    def _pattern(self, text: str) -> regex.Pattern:
        try:
            text.encode("latin-1")
            return self.common
        except UnicodeEncodeError:
            pass
        if self.exact is None:
            late = {"L": [], "N": []}
            for kind, found in late.items():
                one = regex.compile(rf"\p{{{kind}}}")
                found += [c for c in range(0x300, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cn"
                          and one.match(chr(c))]
            without = {k: rf"\p{{{k}}}--[{_ranges(v)}]" if v else rf"\p{{{k}}}" for k, v in late.items()}
            newer = _ranges(sorted(late["L"] + late["N"]))
            other = rf"[[^\s\p{{L}}\p{{N}}]||[{newer}]]+" if newer else r"[^\s\p{L}\p{N}]+"
            self.exact = regex.compile(
                rf"'s|'t|'re|'ve|'m|'ll|'d|[{without['L']}]+|[{without['N']}]|{other}", regex.V1)
        return self.exact

    def pieces(self, text: str) -> Iterator[tuple[bool, list[str]]]:
        """(is an added token, words) in order."""
        if not any(a in text for a in self.added):
            yield False, self.words(text)
            return
        for k, part in enumerate(self.added_pattern.split(text)):
            if part:
                yield (True, [part]) if k % 2 else (False, self.words(part))


def _ranges(codes: list[int]) -> str:
    out: list[list[int]] = []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


class Encoder:
    """Encodes texts word by word, with a bounded cache of words already merged.

    ``render`` turns the ids of a word into what the caller joins for a whole text.
    """

    def __init__(self, vocab: Vocabulary, render: Callable[[list[int]], Any]):
        self.vocab, self.render = vocab, render
        self.split = Splitter(list(vocab.added))
        self.added = {a: render([i]) for a, i in vocab.added.items()}
        self.young: dict[str, Any] = {}
        self.old: dict[str, Any] = {}

    def encode(self, texts: list[str]) -> Iterator[list[Any]]:
        """The rendered words of each text, in order."""
        parts = [list(self.split.pieces(t)) for t in texts]
        known = self.lookup({w for p in parts for added, ws in p if not added for w in ws})
        for p in parts:
            yield [x for added, ws in p for x in ([self.added[ws[0]]] if added else map(known.__getitem__, ws))]

    def lookup(self, words: set[str]) -> dict[str, Any]:
        """Every given word rendered; new ones are merged together in one flat array.

        A full generation becomes the old one; its words return when they occur again.
        """
        if len(self.young) > CACHE_WORDS:
            self.young, self.old = {}, self.young
        known, new = {}, []
        for w in words:
            x = self.young.get(w)
            if x is None:
                x = self.old.get(w)
                if x is None:
                    new.append(w)
                    continue
                self.young[w] = x
            known[w] = x
        if new:
            fresh = dict(zip(new, (self.render(x.tolist()) for x in self.vocab.encode_words(new))))
            known.update(fresh)
            self.young.update((w, x) for w, x in fresh.items() if len(w) <= CACHE_WORD_CHARS)
        return known


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<i4").tobytes()


def decode(vocab: Vocabulary, ids: list[int]) -> str:
    """The tokens joined by a space, as the tokenizer file (which names no decoder) decodes; added tokens stay."""
    return " ".join([vocab.tokens[i] for i in ids])


_LOADED: dict[str, Vocabulary] = {}


def load(path: str) -> Vocabulary:
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def _groups(column: pa.Array, chars: int = 1 << 21) -> Iterator[list[str]]:
    """The texts of a column, null as empty, in lists of about ``chars`` characters."""
    held, size = [], 0
    for x in column:
        held.append(x.as_py() or "")
        size += len(held[-1])
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and ``ids``, the whole text's token ids.

    Only the driver reads the file at ``path``; the parsed vocabulary is broadcast (some MB, by its size).
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, packed)
        for b in batches:
            at = 0
            for texts in _groups(b.column(1)):
                ids = [b"".join(words) for words in encoder.encode(texts)]
                offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))).astype(np.int32)
                flat = np.frombuffer(b"".join(ids), "<i4")
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    ["doc_id", "ids"])
                at += len(texts)

    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def encode_decode_digest(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: token count and SHA-256 of its ids and of the text decoded from them.

    Both strings are joined by spaces over tokens, so they are joined from the words' own.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = (f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, n_tokens long, "
              "ids_sha256 string, decoded_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        encoder = Encoder(vocab, lambda ids: (len(ids), " ".join(map(str, ids)), decode(vocab, ids)))
        sha = lambda words: hashlib.sha256(" ".join(words).encode("utf-8", "surrogatepass")).hexdigest()
        for b in batches:
            n, of_ids, of_text = [], [], []
            for texts in _groups(b.column(1)):
                for words in encoder.encode(texts):
                    n.append(sum([w[0] for w in words]))
                    of_ids.append(sha([w[1] for w in words]))
                    of_text.append(sha([w[2] for w in words]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()),
                                              pa.array(of_text, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return slim.mapInArrow(run, schema)
