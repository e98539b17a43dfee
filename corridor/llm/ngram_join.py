"""N-gram Jaccard join by prefix trees, with components of the links.

Documents become sets of 64-bit shingle hashes; equal sets are one class. The
join of the classes goes:

1. *Who can link at all.* In hash order, linked sets share at least ``l`` of
   their first ``n - need + l`` shingles. One count per shingle tells which
   of them occur in two classes; a class with too few shared ones is out.
2. *Global order.* The rest get an order of shingles by frequency, rare
   first, from a counter array of fixed size; any shared order is exact, a
   noisier count only costs time.
3. *Clusters.* Two linked sets share a shingle among the first ``n - need + 1``
   of either. The classes that share such a shingle go to the cluster of
   their smallest member, so a class travels once per cluster and not per shingle.
4. *Trie join.* A cluster that is too large for one trie is cut into bands of set
   sizes first: sets link only if their sizes are close, so each band goes with
   the next one. What is still too large is cut into shards of bounded size. In each one the
   ordered sets are stored in a trie; a set walks it, shares the overlap counted
   along common paths, and leaves subtrees whose remaining length cannot reach
   the threshold. Sets already known to be connected are not compared again.
5. *Between shards.* Only sets outside the component of their cluster's smallest
   member can still gain a link; they visit the other shards of the cluster. What
   they find links components, which are then joined.

``link_components`` stops comparing sets once they are known to be connected. ``class_links``
lists every link between different sets over the same clusters and bands.

Defined results: null, empty or word-less texts have an empty set and link
with nothing; repeated rows are equal sets and share a component; a component
is named by its smallest non-null id; an empty table gives an empty result.
Shingles and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor.llm.components import connected_components
from corridor.llm.shingles import mix, ngrams, word_hashes
from corridor.llm.storage import discard, materialise, scratch_path, small_side

EXTRA = 0.05               # share of a set by which the first filter's prefix is longer
COUNTERS = 1 << 22         # counters behind the global order: the broadcast is this many bytes times two
SHARD_TOKENS = 200_000     # shingles of the sets that meet in one trie
_PARTS = 512               # first-level groups when tasks' counters are added up

# A-Z lowered; space, tab, line feed, vertical tab, form feed and carriage return separate words.
_TABLE = bytes(32 if c == 32 or 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_set(raw: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a UTF-8 text."""
    return np.unique(ngrams(word_hashes(raw.translate(_TABLE)), words)) if raw else np.empty(0, np.uint64)


def set_key(s: np.ndarray) -> int:
    """One 64-bit name for a set, the same for equal sets."""
    if not len(s):
        return 0
    both = mix(np.array([s.sum(dtype=np.uint64), np.bitwise_xor.reduce(s)]) + np.uint64(len(s)))
    return int(mix(both[:1] ^ (both[1:] << np.uint64(1))).view(np.int64)[0])


def need(n, percent: int):
    """Shingles that a partner shares at least with a set of n: the union has n or more."""
    return -(-percent * n // 100)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _tokens(x: pa.ListScalar) -> np.ndarray:
    return x.values.to_numpy(zero_copy_only=False).view(np.uint64)


def _raw(column: pa.Array) -> Iterator[bytes | None]:
    return (x.as_py() for x in column.cast(pa.binary()))


def _sampled(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, set_key, n, low): ``low`` holds the first shingles in hash order, once per class and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[int] = set()
        for b in batches:
            keys, sizes, low = [], [], []
            for raw in _raw(b.column(1)):
                s = shingle_set(raw, words)
                n, key = len(s), set_key(s)
                keys.append(key)
                sizes.append(n)
                low.append(s[:0] if key in told else s[:n - need(n, percent) + max(1, int(EXTRA * n))])
                told.add(key)
                if len(told) > 1_000_000:
                    told.clear()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()),
                                              _lists(low)], ["doc_id", "set_key", "n", "low"])

    return docs.mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, set_key long, n long, low array<long>")


def _linkable(base: DataFrame, percent: int) -> DataFrame:
    """(set_key, n) of classes that share enough low shingles with other classes.

    A shingle that very many classes hold is pre-aggregated in the first step, and
    the join of the second can split it.
    """
    posts = base.select("set_key", F.explode("low").alias("token"))
    shared = materialise(posts.groupBy("token").agg(F.min("set_key").alias("x"), F.max("set_key").alias("y"))
                         .where("x <> y").select("token"), "shared")
    least = F.greatest(F.lit(1), F.floor(F.lit(EXTRA * percent / 100) * F.col("n")))
    counts = posts.join(shared, "token").groupBy("set_key").agg(F.count("*").alias("shared"))
    return (counts.join(base.groupBy("set_key").agg(F.first("n").alias("n")), "set_key")
            .where(F.col("shared") >= least).select("set_key", "n"))


def _whole_sets(docs: DataFrame, base: DataFrame, chosen: DataFrame, words: int) -> DataFrame:
    """(set_key, tokens) of the chosen classes, read again from one document of each.

    Rows repeated under one id give their class once per task.
    """
    n = chosen.count()
    reps = (base.join(small_side(chosen.select("set_key"), n), "set_key")
            .groupBy("set_key").agg(F.min("doc_id").alias("rep")))
    wanted = materialise(reps.select("rep").distinct(), "reps")
    texts = docs.join(small_side(wanted, n), F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[int] = set()
        for b in batches:
            sets = {}
            for raw in _raw(b.column(0)):
                s = shingle_set(raw, words)
                if (key := set_key(s)) not in told:
                    sets[key] = s
                    told.add(key)
            if len(told) > 1_000_000:
                told.clear()
            yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.int64()), _lists(list(sets.values()))],
                                             ["set_key", "tokens"])

    sets = texts.mapInArrow(run, "set_key long, tokens array<long>")
    return sets.join(small_side(chosen.select("set_key"), n), "set_key", "left_semi")


def _counters(sets: DataFrame) -> np.ndarray:
    """How often each hash slot occurs over all given sets: COUNTERS small integers."""
    block = 1 << 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.uint32)
        for b in batches:
            flat = b.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(flat), 1 << 20):
                np.add.at(total, (flat[at:at + (1 << 20)] & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
        if total.any():
            blocks = np.minimum(total, 65535).astype(np.uint16).reshape(-1, block)
            part = TaskContext.get().partitionId() % _PARTS
            yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array([part] * len(blocks), pa.int32()),
                                              pa.array([x.tobytes() for x in blocks], pa.binary())], ["block", "part", "counts"])

    def add(key: tuple, parts: pa.Table) -> pa.Table:
        total = np.zeros(block, np.uint32)
        for x in parts.column("counts"):
            total += np.frombuffer(x.as_py(), np.uint16)
        out = np.minimum(total, 65535).astype(np.uint16)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([out.tobytes()], pa.binary())})

    # In two levels, so that a group holds the blocks of a share of the tasks, or _PARTS sums.
    told = "block int, counts binary"
    rows = (sets.select("tokens").mapInArrow(run, "block int, part int, counts binary")
            .groupBy("block", "part").applyInArrow(add, told).groupBy("block").applyInArrow(add, told).collect())
    out = np.zeros(COUNTERS, np.uint16)
    for r in rows:
        out[r.block * block:(r.block + 1) * block] = np.frombuffer(r.counts, np.uint16)
    return out


def ordered(tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A set in global order (count of its slot, then hash) with the counts."""
    c = counts[(tokens & np.uint64(len(counts) - 1)).astype(np.int64)]
    at = np.lexsort((tokens, c))
    return tokens[at], c[at]


def _clusters(sets: DataFrame, chosen: DataFrame, counts, percent: int) -> DataFrame:
    """(center, member, n): classes that share a prefix shingle, under their smallest member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prefixes = []
            for x in b.column(1):
                s = _tokens(x)
                prefixes.append(ordered(s, counts.value)[0][:len(s) - need(len(s), percent) + 1])
            yield pa.RecordBatch.from_arrays([b.column(0), _lists(prefixes)], ["set_key", "prefix"])

    posts = (sets.mapInArrow(run, "set_key long, prefix array<long>")
             .select("set_key", F.explode("prefix").alias("token")))
    centers = materialise(posts.groupBy("token").agg(F.min("set_key").alias("center"), F.max("set_key").alias("last"))
                          .where("center <> last").select("token", "center"), "centers")
    pairs = (posts.join(centers, "token")
             .select("center", F.col("set_key").alias("member")).distinct())
    return pairs.join(chosen.withColumnRenamed("set_key", "member"), "member").select("center", "member", "n")


class _Node:
    __slots__ = ("seg", "kids", "low", "high", "alive", "up", "ends")

    def __init__(self, seg: list[int], up: "_Node | None"):
        self.seg, self.up, self.kids, self.ends = seg, up, [], -1
        self.low = self.high = self.alive = 0


class Trie:
    """Path-compressed trie over ordered sets of ranks, with sizes and live counts per subtree."""

    def __init__(self, sets: list[list[int]]):
        self.sets = sets
        self.leaf: list[_Node] = [None] * len(sets)
        order = sorted(range(len(sets)), key=sets.__getitem__)
        self.root = _Node([], None)
        todo = [(self.root, 0, len(order), 0)]      # node, its range of sets in order, depth
        nodes = []
        while todo:
            node, lo, hi, depth = todo.pop()
            nodes.append(node)
            if lo < hi and len(sets[order[lo]]) == depth:
                node.ends = order[lo]
                self.leaf[order[lo]] = node
                lo += 1
            while lo < hi:
                first = sets[order[lo]]
                to = lo + 1
                while to < hi and sets[order[to]][depth] == first[depth]:
                    to += 1
                last, end = sets[order[to - 1]], depth + 1
                while end < len(first) and end < len(last) and first[end] == last[end]:
                    end += 1
                kid = _Node(first[depth:end], node)
                node.kids.append(kid)
                todo.append((kid, lo, to, end))
                lo = to
        for node in reversed(nodes):
            sizes = [len(sets[node.ends])] if node.ends >= 0 else []
            node.low = min(sizes + [k.low for k in node.kids], default=0)
            node.high = max(sizes + [k.high for k in node.kids], default=0)
            node.alive = len(sizes) + sum(k.alive for k in node.kids)

    def remove(self, i: int) -> None:
        node = self.leaf[i]
        while node is not None:
            node.alive -= 1
            node = node.up

    def links(self, i: int, percent: int, gone: list[bool]) -> list[int]:
        """Live sets whose Jaccard similarity with set i is at least ``percent`` / 100."""
        x = self.sets[i]
        n, own = len(x), frozenset(x)
        p, q = percent, 100 + percent
        found = []
        todo = [(self.root, 0, 0)]                  # node, overlap and misses above it
        while todo:
            node, hits, misses = todo.pop()
            if not node.alive or 100 * node.high < p * n or 100 * n < p * node.low:
                continue
            seg = node.seg
            dead = False
            for at in range(0, len(seg), 64):
                part = seg[at:at + 64]
                k = len(own.intersection(part))
                hits += k
                misses += len(part) - k
                # Sets below have at most `high` shingles and lack `misses` of them in x already.
                if 100 * node.high < p * n + q * misses:
                    dead = True
                    break
            if dead:
                continue
            if node.ends >= 0 and not gone[node.ends] and node.ends != i:
                if 100 * hits >= p * (n + len(self.sets[node.ends]) - hits):
                    found.append(node.ends)
            todo += [(k, hits, misses) for k in node.kids if k.alive]
        return found


def trie_links(sets: list[list[int]], groups: list[int], percent: int) -> list[tuple[int, int]]:
    """Links that connect the sets of different groups as far as the similarity does.

    Breadth first: a set looks for links among the sets not reached yet, which
    leave the trie as they are reached. Sets of one group count as connected.
    """
    trie = Trie(sets)
    members: dict[int, list[int]] = {}
    for i, g in enumerate(groups):
        members.setdefault(g, []).append(i)
    gone = [False] * len(sets)
    out = []

    def reach(i: int, queue: list[int]) -> None:
        for j in members[groups[i]]:
            gone[j] = True
            trie.remove(j)
            queue.append(j)

    for start in range(len(sets)):
        if gone[start]:
            continue
        queue: list[int] = []
        reach(start, queue)
        while queue and trie.root.alive:
            i = queue.pop()
            for j in trie.links(i, percent, gone):
                if not gone[j]:
                    out.append((i, j))
                    reach(j, queue)
    return out


def _join_units(units: DataFrame, sets: DataFrame, counts, percent: int, every: bool = False) -> DataFrame:
    """Links (a, b) between the groups of a unit, as far as components need or ``every`` one; ``units`` has center, shard, other, member and group_id."""

    def run(unit: pa.Table) -> pa.Table:
        members = {k: (g, _tokens(x)) for k, g, x in zip(unit.column("member").to_pylist(),
                                                         unit.column("group_id").to_pylist(), unit.column("tokens"))}
        keys, groups, tokens = list(members), [g for g, _ in members.values()], [t for _, t in members.values()]
        a, z = [], []
        if len(keys) > 1:
            distinct, rank = np.unique(np.concatenate(tokens), return_inverse=True)
            by_order = np.empty(len(distinct), np.int64)
            at, _ = ordered(distinct, counts.value)
            by_order[np.searchsorted(distinct, at)] = np.arange(len(distinct))
            cuts = np.cumsum([len(t) for t in tokens])[:-1]
            sets_ = [np.sort(x).tolist() for x in np.split(by_order[rank], cuts)]
            for i, j in all_links(sets_, percent) if every else trie_links(sets_, groups, percent):
                a.append(groups[i])
                z.append(groups[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(z, pa.int64())})

    units = materialise(units, "units")
    full = small_side(units, units.count()).join(sets.select(F.col("set_key").alias("member"), "tokens"), "member")
    return full.groupBy("center", "shard", "other").applyInArrow(run, "a long, b long")


def _banded(clusters: DataFrame, percent: int, shard_tokens: int, lean: bool = False) -> DataFrame:
    """(center, member, n): clusters over ``shard_tokens`` cut into bands of set sizes, each with the next band.

    Sizes of linked sets differ by a factor of at most 100 / ``percent``, the width of a band
    (a little more, for rounding), so linked sets lie in one band or in two next to each other. ``lean``
    leaves out pairs of bands that lie within another one because one of the two is empty.
    """
    large = materialise(clusters.groupBy("center").agg(F.sum("n").alias("size")).where(F.col("size") > shard_tokens)
                        .select(F.col("center").alias("c")), "large-clusters")
    n = large.count()
    if not n:
        return clusters
    few = small_side(large, n)
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent) * 1.0001))
    rows = clusters.join(few, F.col("center") == F.col("c"), "left_semi").withColumn("band", band)
    units = F.array(F.col("band") - 1, F.col("band"))
    if lean:
        # One row per large cluster with its bands, of which there are as many as the logarithm of its sizes.
        filled = materialise(rows.select(F.col("center").alias("c"), "band").distinct().groupBy("c").agg(
            F.collect_list("band").alias("bands")), "filled")
        rows = rows.join(small_side(filled, n), F.col("center") == F.col("c"))
        below, above = (F.array_contains("bands", F.col("band") + at) for at in (-1, 1))
        units = F.array_compact(F.array(F.when(below, F.col("band") - 1), F.when(above | ~below, F.col("band"))))
    cut = (rows
           .select("center", "member", "n", F.explode(units).alias("band"))
           .select(F.xxhash64("center", "band").alias("center"), "member", "n"))
    return materialise(clusters.join(few, F.col("center") == F.col("c"), "left_anti").unionByName(cut).distinct(), "bands")


def _salt(n: Column) -> Column:
    return F.pmod(F.xxhash64("member", F.lit(17)), n)


def _spread(clusters: DataFrame, shard_tokens: int) -> tuple[DataFrame, int]:
    """Clusters with their number of ``shards`` and each member's ``shard``, and how many have more than one."""
    sizes = materialise(clusters.groupBy("center").agg(F.ceil(F.sum("n") / shard_tokens).alias("cut"))
                        .where("cut > 1").withColumnRenamed("center", "c"), "sizes")
    n = sizes.count()
    # Only clusters of several shards are joined: a counted few, so a hot cluster is not shuffled by its key.
    spread = clusters.join(small_side(sizes, n), F.col("center") == F.col("c"), "left").select(
        "center", "member", "n", F.coalesce("cut", F.lit(1)).alias("shards"))
    return spread.withColumn("shard", _salt(F.col("shards"))), n


def _prepared(docs: DataFrame, base: DataFrame, chosen: DataFrame, words: int, percent: int, shard_tokens: int):
    """The sets that can link, the broadcast counters, and the clusters in bands."""
    sets = materialise(_whole_sets(docs, base, chosen, words), "sets")
    counts = docs.sparkSession.sparkContext.broadcast(_counters(sets))
    clusters = materialise(_clusters(sets, chosen, counts, percent), "clusters")
    return sets, counts, _banded(clusters, percent, shard_tokens, lean=True)


def _connected(docs: DataFrame, base: DataFrame, chosen: DataFrame, words: int, percent: int, shard_tokens: int) -> DataFrame:
    """(node, component) of the classes with links, for all components."""
    sets, counts, clusters = _prepared(docs, base, chosen, words, percent, shard_tokens)
    spread, n_large = _spread(clusters, shard_tokens)
    first = spread.select("center", "shard", F.lit(0).cast("long").alias("other"), "member",
                          F.col("member").alias("group_id"))
    comps = connected_components(_join_units(first, sets, counts, percent))
    if not n_large:
        return comps
    comps = materialise(comps, "components")
    large = spread.where("shards > 1")
    root = F.coalesce(F.col("component"), F.col("member"))
    placed = large.join(comps, F.col("member") == F.col("node"), "left").select(
        "center", "member", "n", "shards", "shard", root.alias("group_id"))
    placed = materialise(placed, "placed")
    # One row per cluster of several shards: the same counted few as in _spread.
    main = placed.groupBy(F.col("center").alias("c")).agg(F.min_by("group_id", "member").alias("main"))
    apart = placed.join(small_side(main, n_large), F.col("center") == F.col("c")).where("group_id <> main").drop("c")
    n_apart = materialise(apart.groupBy(F.col("center").alias("c")).agg(F.ceil(F.sum("n") / shard_tokens).alias("others")), "apart")
    few = small_side(n_apart, n_large)
    apart = apart.join(few, F.col("center") == F.col("c")).drop("c")
    stay = (placed.join(few, F.col("center") == F.col("c"))
            .select("center", "shard", F.explode(F.expr("sequence(0, others - 1)")).alias("other"), "member", "group_id"))
    visit = apart.select("center", F.explode(F.expr("sequence(0, shards - 1)")).alias("shard"),
                         _salt(F.col("others")).alias("other"), "member", "group_id")
    # Links between shards connect whole components, so only these are joined once more.
    joined = connected_components(_join_units(stay.unionByName(visit).distinct(), sets, counts, percent))
    joined = joined.select(F.col("node").alias("was"), F.col("component").alias("now"))
    nodes = comps.unionByName(joined.select(F.col("was").alias("node"), F.col("was").alias("component"))).distinct()
    return nodes.join(joined, F.col("component") == F.col("was"), "left").select(
        "node", F.coalesce("now", "component").alias("component"))


def all_links(sets: list[list[int]], percent: int) -> list[tuple[int, int]]:
    """Every pair of the sets whose similarity reaches the threshold, by walking the trie with each set."""
    trie, gone = Trie(sets), [False] * len(sets)
    return [(i, j) for i in range(len(sets)) for j in trie.links(i, percent, gone) if i < j]


def class_links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, percent: int = 85,
                shard_tokens: int = SHARD_TOKENS) -> tuple[DataFrame, DataFrame]:
    """(links, members): every link (a, b), a < b, between different sets, and (doc_id, set_key, n_shingles) per document.

    Equal sets are one class and link with each other; they are not listed as pairs. Clusters of several shards
    meet shard by shard. The links of a class with all its partners can be many: the result is as
    large as the true links between different sets, never as their copies.
    """
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    base, chosen = _classes(slim, words, percent)
    some = base.where("n > 0")
    sets, counts, clusters = _prepared(slim, some, chosen, words, percent, shard_tokens)
    spread, _ = _spread(clusters, shard_tokens)
    # Units (shard, other) with shard <= other: each member visits the units of its shard.
    units = spread.select("center", "member", "shards", "shard", F.explode(F.expr("sequence(0L, shards - 1)")).alias("with")).select(
        "center", F.least("shard", "with").alias("shard"), F.greatest("shard", "with").alias("other"), "member",
        F.col("member").alias("group_id")).distinct()
    found = _join_units(units, sets, counts, percent, every=True)
    links = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return links, base.select("doc_id", F.when(F.col("n") > 0, F.col("set_key")).alias("set_key"), F.col("n").alias("n_shingles"))


def _classes(slim: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, set_key, n) of every document, and (set_key, n) of the classes that can link with another."""
    low = scratch_path(slim.sparkSession, "low")
    sampled = materialise(_sampled(slim, words, percent), "low", low)
    base = materialise(sampled.drop("low"), "classes")
    chosen = materialise(_linkable(sampled.where("n > 0"), percent), "linkable")
    discard(slim.sparkSession, low)
    return base, chosen


def link_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, percent: int = 85,
                    shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id.

    Documents link when 100 * intersection >= ``percent`` * union of their
    sets of ``words``-word shingles; the component is named by its smallest id.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    base, chosen = _classes(slim, words, percent)
    some = base.where("n > 0")
    comps = _connected(slim, some, chosen, words, percent, shard_tokens)
    classes = some.groupBy("set_key").agg(F.min("doc_id").alias("first_id"))
    named = classes.join(comps, F.col("set_key") == F.col("node"), "left").select(
        "set_key", "first_id", F.coalesce("component", "set_key").alias("root"))
    roots = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    names = named.join(roots, "root").select(F.col("set_key").alias("key"), "component_id")
    return base.join(names, (F.col("set_key") == F.col("key")) & (F.col("n") > 0), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
