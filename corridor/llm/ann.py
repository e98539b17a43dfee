"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree grows with the table. Its top is fitted on a bounded sample; where a leaf of
the top holds more rows than that, a subtree is fitted on rows of that leaf, each
in a task of its own. Leaves aim at LEAF_ROWS rows, until the centres take TREE_BYTES, the bound
of what is broadcast. Every row is then assigned to a leaf.

A query walks the tree best bin first: a priority queue of branches by the
distance to their centre. How many leaves it visits is calibrated: for QUERIES
rows the exact neighbours among all rows are found, and the visits widen until the target
recall is reached; where the leaves visited hold fewer rows than asked for, it
goes on. Neighbouring leaves lie together in bins, so that a query is sent once
per bin with the leaves it visits there. Their rows are compared exactly, in blocks of bounded
size, with distances from the original vectors in double precision.

Defined results: vectors that are null, zero, of another length than most,
or hold null or non-finite components take no part, nor do rows with a null
id; rows repeated under one id are candidates each; a query's candidates leave out all
rows of its own id; ties go to the smaller id; fewer candidates than asked for
are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corridor.llm.storage import materialise

SAMPLE_ROWS = 20_000       # rows that the top, or one subtree, is fitted on, about
LEAF_ROWS = 8              # rows aimed at per leaf
BIN_ROWS = 2_048           # rows aimed at per bin of neighbouring leaves
TREE_BYTES = 64 << 20      # of all leaves' centres; more rows make larger leaves, not a larger tree
QUERIES = 300              # rows whose exact neighbours calibrate the visits
TARGET_RECALL = 0.965
BRANCH = 8
BLOCK_ROWS, BLOCK_QUERIES = 4_096, 1_024


@dataclass
class KMeansTree:
    """Nodes in breadth order: ``kids[i]`` are child numbers (none for a leaf), ``centers[i]`` theirs."""

    centers: list[np.ndarray] = field(default_factory=list)
    kids: list[list[int]] = field(default_factory=list)
    leaf_no: list[int] = field(default_factory=list)
    leaves: int = 0
    visits: int = 1
    leaf_rows: int = 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row, by the nearest centre at every level."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if not self.kids[node]:
                out[rows] = self.leaf_no[node]
                continue
            near = _nearest(x[rows], self.centers[node])
            todo += [(kid, rows[near == k]) for k, kid in enumerate(self.kids[node])]
        return out

    def bins(self, leaf_rows: int) -> np.ndarray:
        """For every leaf its bin: the leaves below the largest node of about BIN_ROWS rows."""
        below = np.array([int(not k) for k in self.kids])
        for node in range(len(self.kids) - 1, -1, -1):          # kids come after their parent
            below[node] += sum(below[k] for k in self.kids[node])
        out, todo = np.zeros(self.leaves, np.int64), [(0, -1)]
        while todo:
            node, held = todo.pop()
            if held < 0 and (not self.kids[node] or below[node] * leaf_rows <= BIN_ROWS):
                held = node
            if not self.kids[node]:
                out[self.leaf_no[node]] = held
            todo += [(k, held) for k in self.kids[node]]
        return out

    def graft(self, subtrees: dict[int, "KMeansTree"]) -> "KMeansTree":
        """The tree with a subtree in place of some of its leaves."""
        out = KMeansTree()
        todo = [(self, 0, None)]
        while todo:
            tree, node, up = todo.pop()
            if not tree.kids[node] and tree is self and self.leaf_no[node] in subtrees:
                tree, node = subtrees[self.leaf_no[node]], 0
            at = len(out.kids)
            out.centers.append(tree.centers[node])
            out.kids.append([])
            out.leaf_no.append(-1)
            if up is not None:
                out.kids[up[0]][up[1]] = at
            if not tree.kids[node]:
                out.leaf_no[at] = out.leaves
                out.leaves += 1
            out.kids[at] = [-1] * len(tree.kids[node])
            todo += [(tree, kid, (at, k)) for k, kid in enumerate(tree.kids[node])]
        return out

    def best_bins(self, q: np.ndarray, visits: int, least: int = 0, rows: np.ndarray | None = None,
                  own: dict[int, int] | None = None) -> list[int]:
        """The first ``visits`` leaves that the priority queue reaches, and more until they hold ``least`` rows.

        ``rows`` counts the rows of each leaf, ``own`` those among them that are no candidates.
        """
        out: list[int] = []
        reached = 0
        for leaf in self.in_order(q):
            if len(out) >= visits and reached >= least:
                break
            out.append(leaf)
            if least:
                reached += int(rows[leaf]) - own.get(leaf, 0)
        return out

    def in_order(self, q: np.ndarray) -> Iterator[int]:
        """All leaves in the order in which the priority queue reaches them."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.kids[node]:
                yield self.leaf_no[node]
                continue
            # The squared distance less that of the query to the origin, which all branches share.
            for near, kid in zip((self.squares[node] - 2 * (self.centers[node] @ q)).tolist(), self.kids[node]):
                heapq.heappush(queue, (near, kid))

    @cached_property
    def squares(self) -> list[np.ndarray]:
        return [(c * c).sum(axis=1) for c in self.centers]


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers ** 2).sum(axis=1) - 2 * x @ centers.T).argmin(axis=1)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    centers = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centers)
        for c in range(k):
            own = x[near == c]
            if len(own):
                centers[c] = own.mean(axis=0)
    return centers, _nearest(x, centers)


def fit_tree(x: np.ndarray, leaf_rows: int, seed: int = 3) -> KMeansTree:
    """Split until a node has at most ``leaf_rows`` sample rows or cannot be split."""
    rng = np.random.default_rng(seed)
    tree = KMeansTree()

    def add() -> int:
        tree.centers.append(np.empty((0, x.shape[1])))
        tree.kids.append([])
        tree.leaf_no.append(-1)
        return len(tree.kids) - 1

    todo = [(add(), x)]
    while todo:
        node, rows = todo.pop()
        parts = []
        if len(rows) > leaf_rows:
            k = min(BRANCH, max(2, -(-len(rows) // leaf_rows)))
            centers, near = _kmeans(rows, k, rng)
            parts = [(centers[c], rows[near == c]) for c in range(k) if (near == c).any()]
        if len(parts) < 2:
            tree.leaf_no[node] = tree.leaves
            tree.leaves += 1
            continue
        tree.centers[node] = np.array([c for c, _ in parts])
        for _, own in parts:
            kid = add()
            tree.kids[node].append(kid)
            todo.append((kid, own))
    return tree


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): rows that take part, as arrays of double."""
    v = F.col("v")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    fine = (F.col("vec_id").isNotNull() & v.isNotNull()
            & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
            & F.exists(v, lambda c: c != 0))
    rows = rows.where(F.coalesce(fine, F.lit(False)))
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (dims["d"] if dims else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _picked(rows: DataFrame, wanted: int, n: int, salt: int = 0) -> DataFrame:
    """About ``wanted`` of ``n`` rows, by a hash of the id."""
    return rows if wanted >= n else rows.where(
        F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(1_000_003)) < int(wanted / n * 1_000_003) + 1)


def _subtrees(rows: DataFrame, top: KMeansTree, sample_rows: int, leaf_rows: int) -> dict[int, KMeansTree]:
    """A subtree for every leaf of the top that holds more than ``leaf_rows`` rows, fitted on about ``sample_rows`` of them."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(top)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = shared.value.assign(_matrix(b.column(1))) if len(b) else []
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int64())], ["vec_id", "v", "top"])

    placed = materialise(rows.mapInArrow(assign, "vec_id long, v array<double>, top long"), "top")
    held = placed.groupBy("top").count().collect()                 # a row per leaf of the top: some thousands at most
    large = [(r["top"], r["count"], int(min(1.0, sample_rows / r["count"]) * 1_000_003) + 1) for r in held if r["count"] > leaf_rows]
    if not large:
        return {}
    shares = F.broadcast(spark.createDataFrame(large, "top long, held long, share long"))
    some = placed.join(shares, "top").where(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(1_000_003)) < F.col("share"))

    def grow(key: tuple, group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("vec_id").to_numpy(), kind="stable")
        x = _matrix(group.column("v"))[order]
        least = max(1, int(leaf_rows * len(x) / group.column("held")[0].as_py()))
        return pa.table({"top": pa.array([key[0].as_py()], pa.int64()), "tree": pa.array([pickle.dumps(fit_tree(x, least))])})

    grown = some.select("top", "held", "vec_id", "v").groupBy("top").applyInArrow(grow, "top long, tree binary")
    return {r["top"]: pickle.loads(r["tree"]) for r in grown.collect()}


def _exact(rows: DataFrame, asked: np.ndarray, ids: np.ndarray, tree: KMeansTree, k: int) -> DataFrame:
    """(query, leaf): the leaves of the ``k`` exact nearest rows of each of the asked vectors, among all rows."""
    shared = rows.sparkSession.sparkContext.broadcast((asked, ids, tree))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, own, tree = shared.value
        for b in batches:
            for at in range(0, len(b), BLOCK_ROWS):
                part = b.slice(at, BLOCK_ROWS)
                x, names = _matrix(part.column(1)), part.column(0).to_numpy()
                d = (q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1) - 2 * q @ x.T
                d[own[:, None] == names] = np.inf
                few = min(k, len(x))
                near = np.argpartition(d, few - 1, axis=1)[:, :few]
                leaf = tree.assign(x[near.ravel()]).reshape(near.shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(len(q)), few)), pa.array(np.take_along_axis(d, near, 1).ravel()),
                     pa.array(names[near.ravel()]), pa.array(leaf.ravel())], ["query", "d", "vec_id", "leaf"])

    found = rows.mapInArrow(run, "query long, d double, vec_id long, leaf long").where(F.col("d") < float("inf"))
    best = Window.partitionBy("query").orderBy("d", "vec_id")
    return found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).select("query", "leaf")


def calibrate(rows: DataFrame, tree: KMeansTree, k: int, target: float, n: int, queries: int = QUERIES) -> int:
    """Leaf visits at which about ``queries`` rows find ``target`` of their ``k`` nearest among all rows."""
    held = _picked(rows, queries, n, 2).orderBy("vec_id").limit(2 * queries).collect() or [rows.first()]
    x, ids = np.array([r.v for r in held]), np.array([r.vec_id for r in held])
    shared = rows.sparkSession.sparkContext.broadcast((x, tree))
    truth = _exact(rows, x, ids, tree, k).groupBy("query").agg(F.collect_list("leaf").alias("leaves"))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, tree = shared.value
        for b in batches:
            out = []
            for i, leaves in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                left = set(leaves)
                for place, leaf in enumerate(tree.in_order(q[i]), 1):
                    if leaf in left:
                        left.remove(leaf)
                        out += [place] * leaves.count(leaf)
                        if not left:
                            break
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["visits"])

    needed = np.sort([r.visits for r in truth.repartition(32).mapInArrow(visits, "visits long").collect()])
    return int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)]) if len(needed) else tree.leaves


def fit(rows: DataFrame, k: int = 10, target_recall: float = TARGET_RECALL, sample_rows: int = SAMPLE_ROWS,
        leaf_rows: int = LEAF_ROWS) -> KMeansTree:
    """Fit the tree and calibrate its visits; rows are sampled by a hash of the id."""
    n = rows.count()
    if n == 0:
        return KMeansTree()
    x = np.array([r.v for r in _picked(rows, sample_rows, n).orderBy("vec_id").limit(2 * sample_rows).collect()])
    if not len(x):
        x = np.array([rows.first().v])
    leaf_rows = max(leaf_rows, -(-n * x.shape[1] * 8 // TREE_BYTES))
    if n <= sample_rows:
        tree = fit_tree(x, leaf_rows)
    else:
        top = fit_tree(x, max(8, int(sample_rows / 2 * len(x) / n)))
        tree = top.graft(_subtrees(rows, top, sample_rows, leaf_rows))
    tree.leaf_rows = leaf_rows
    tree.visits = calibrate(rows, tree, k, target_recall, n)
    return tree


def build_index(rows: DataFrame, tree: KMeansTree) -> DataFrame:
    """Every row with its bin and leaf, written to the shared folder."""
    shared = rows.sparkSession.sparkContext.broadcast((tree, tree.bins(tree.leaf_rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, bins = shared.value
        for b in batches:
            leaf = tree.assign(_matrix(b.column(1))) if len(b) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bins[leaf]), pa.array(leaf, pa.int64())],
                                             ["vec_id", "v", "bin", "leaf"])

    return materialise(rows.mapInArrow(run, "vec_id long, v array<double>, bin long, leaf long"), "index")


def _visits(queries: DataFrame, index: DataFrame, tree: KMeansTree, k: int) -> DataFrame:
    """(query_no, query_id, q, bin, leaves): each query with the leaves it visits, by bin.

    Leaves of few rows are not enough after the calibrated visits: a query goes on until
    ``k`` rows of other ids are reached or no leaf is left.
    """
    held = index.groupBy("leaf").count().collect()          # at most as many rows as the tree has leaves
    rows = np.zeros(tree.leaves, np.int64)
    for r in held:
        rows[r["leaf"]] = r["count"]
    asking = queries.select(F.col("query_id").alias("vec_id")).distinct()
    own = index.select("vec_id", "leaf").join(asking, "vec_id", "left_semi").groupBy("vec_id", "leaf").agg(
        F.count("*").alias("n")).groupBy(F.col("vec_id").alias("query_id")).agg(F.collect_list(F.struct("leaf", "n")).alias("own"))
    shared = queries.sparkSession.sparkContext.broadcast((tree, rows, tree.bins(tree.leaf_rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, rows, bins = shared.value
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                again, places, visited = [], [], []
                for i, (q, mine) in enumerate(zip(_matrix(part.column(2)), part.column(3).to_pylist())):
                    leaves = np.array(tree.best_bins(q, tree.visits, k, rows, {x["leaf"]: x["n"] for x in mine or ()}))
                    for place in np.unique(bins[leaves]):
                        again.append(i)
                        places.append(place)
                        visited.append(np.sort(leaves[bins[leaves] == place]))
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(pa.array(again, pa.int64())) for c in part.columns[:3]), pa.array(places, pa.int64()),
                     pa.array(visited, pa.list_(pa.int64()))], ["query_no", "query_id", "q", "bin", "leaves"])

    # A walk of the tree takes far longer than its few bytes tell: the queries are dealt to all tasks, not joined to few.
    tasks = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (queries.join(own, "query_id", "left").select("query_no", "query_id", "q", "own").repartition(tasks, "query_no")
            .mapInArrow(run, "query_no long, query_id long, q array<double>, bin long, leaves array<long>"))


def nearest_in_block(ids: np.ndarray, x: np.ndarray, own: int, q: np.ndarray, k: int) -> list[tuple[float, int]]:
    """The k nearest (distance, id) of a block, ties to the smaller id; rows of the query's own id are left out."""
    keep = ids != own
    ids, x = ids[keep], x[keep]
    if not len(ids):
        return []
    d = np.sqrt(((x - q) ** 2).sum(axis=1))
    if len(d) > k:
        near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
        ids, d = ids[near], d[near]
    first = np.lexsort((ids, d))[:k]
    return list(zip(d[first].tolist(), ids[first].tolist()))


def search(index: DataFrame, queries: DataFrame, tree: KMeansTree, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found; ``queries`` has vec_id and v.

    A bin with many rows or visits is cut into blocks on both sides, so
    no task holds more than one block of each.
    """
    q = queries.dropDuplicates().select(F.xxhash64("vec_id", "v").alias("query_no"),
                                        F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    visits = materialise(_visits(q, index, tree, k), "visits")
    cuts = lambda df, n, name: df.groupBy("bin").agg(F.ceil(F.count("*") / n).alias(name))
    sizes = cuts(index, BLOCK_ROWS, "row_blocks").join(cuts(visits, BLOCK_QUERIES, "query_blocks"), "bin")
    every = lambda name: F.explode(F.expr(f"sequence(0, {name} - 1)"))
    mine = lambda col, name: F.pmod(F.xxhash64(col), F.col(name))
    rows = index.join(sizes, "bin").select(
        "bin", mine("vec_id", "row_blocks").alias("row_block"), every("query_blocks").alias("query_block"), "leaf", "vec_id", "v")
    asked = visits.join(sizes, "bin").select(
        "bin", every("row_blocks").alias("row_block"), mine("query_no", "query_blocks").alias("query_block"),
        "query_no", "query_id", "q", "leaves")

    def compare(block: pa.Table, asking: pa.Table) -> pa.Table:
        out = ([], [], [], [])
        if len(block) and len(asking):
            leaf = block.column("leaf").to_numpy()
            order = np.argsort(leaf, kind="stable")
            leaf, ids, x = leaf[order], block.column("vec_id").to_numpy()[order], _matrix(block.column("v"))[order]
            for no, own, vec, leaves in zip(asking.column("query_no").to_pylist(), asking.column("query_id").to_pylist(),
                                            _matrix(asking.column("q")), asking.column("leaves")):
                seen = leaves.values.to_numpy()
                from_, to = np.searchsorted(leaf, seen), np.searchsorted(leaf, seen, "right")
                at = np.repeat(to - np.cumsum(to - from_), to - from_) + np.arange((to - from_).sum())
                for score, vec_id in nearest_in_block(ids[at], x[at], own, vec, k):
                    for column, value in zip(out, (no, own, vec_id, score)):
                        column.append(value)
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                        names=["query_no", "query_id", "vec_id", "score"])

    key = ["bin", "row_block", "query_block"]
    found = (rows.groupBy(*key).cogroup(asked.groupBy(*key))
             .applyInArrow(compare, "query_no long, query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id", "query_no").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def nearest_neighbours(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding",
                       k: int = 10, target_recall: float = TARGET_RECALL) -> DataFrame:
    """Fit, index every row and search for the rows that ``is_query`` (a condition on vec_id) picks."""
    rows = usable(vectors, vec_id, embedding)
    tree = fit(rows, k, target_recall)
    if not tree.kids:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(build_index(rows, tree), rows.where(is_query), tree, k)
