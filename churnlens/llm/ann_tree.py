"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted in the driver on a bounded sample (``SAMPLE`` vectors of
smallest id hash): every node splits by k-means into at most ``BRANCH``
children until ``LEAF`` sample vectors are left.  Every row of the table is
then indexed: it descends to the leaf of the nearest centroids.

A query walks the tree best bin first: a priority queue holds the unopened
nodes by the inner product with their centroid, and opens the best one until
enough leaves are visited.  How many are enough is calibrated: for
``CALIBRATION`` queries the exact neighbours among all rows are found by brute
force, and the number of visits doubles, and is then narrowed, until the
visited leaves hold ``TARGET`` of them.

Rows and routed queries meet per leaf in blocks of bounded size: a leaf with a
third of all rows is cut into blocks by id hash, and so are its queries, so no
task holds more than ``BLOCK`` vectors and ``BLOCK`` queries of one leaf.
Every block returns its best ``k`` per query, found with a matrix product and
scored again on the original vectors in double precision, always in the same
order of summation, so that equal vectors tie exactly.

Defined cases: vectors that are null, zero, or hold null or non-finite
components take no part, neither do rows with a null id or with another length
than the most frequent one (ties: the longer).  A query never meets rows of
its own id; rows that repeat an id are candidates each, and as queries share
one ranking.  With at most ``k`` candidates all leaves are visited and all are
returned.  Equal scores go by vec_id.  An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from churnlens.llm.common import bounded_batches, bounded_sample, stored

SAMPLE = 20_000
BRANCH = 16
LEAF = 100
CALIBRATION = 128
TARGET = 0.97
BLOCK = 4096
K = 20
SEED = 5


@dataclass
class Tree:
    """Nodes as lists: centroid, children (empty: leaf), leaf number."""

    centroids: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def add(self, centroid: np.ndarray) -> int:
        self.centroids.append(centroid)
        self.children.append([])
        self.leaf.append(-1)
        return len(self.leaf) - 1


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """Cluster number of each row."""
    centers = x[rng.choice(len(x), k, replace=False)]
    at = np.zeros(len(x), int)
    for _ in range(rounds):
        d = (centers**2).sum(1) - 2 * x @ centers.T
        now = d.argmin(1)
        if (now == at).all():
            break
        at = now
        for c in range(k):
            if (at == c).any():
                centers[c] = x[at == c].mean(0)
    return at


def fit_tree(sample: np.ndarray) -> Tree:
    tree, rng = Tree(), np.random.default_rng(SEED)

    def grow(node: int, x: np.ndarray) -> None:
        parts = []
        if len(x) > LEAF:
            at = _kmeans(x, min(BRANCH, -(-len(x) // LEAF) + 1), rng)
            parts = [x[at == c] for c in np.unique(at)]
        if len(parts) < 2:  # small, or all alike
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
            return
        for p in parts:
            child = tree.add(p.mean(0))
            tree.children[node].append(child)
            grow(child, p)

    grow(tree.add(sample.mean(0)), sample)
    return tree


def descend(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Leaf of each row: the nearest child at every level."""
    out = np.empty(len(x), np.int32)
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        kids = tree.children[node]
        if not kids:
            out[rows] = tree.leaf[node]
            continue
        c = np.stack([tree.centroids[k] for k in kids])
        at = ((c**2).sum(1) - 2 * x[rows] @ c.T).argmin(1)
        todo += [(k, rows[at == j]) for j, k in enumerate(kids) if (at == j).any()]
    return out


def best_bins(tree: Tree, q: np.ndarray, visits: int) -> list[int]:
    """The first ``visits`` leaves of a best-bin-first walk."""
    queue, found = [(0.0, 0)], []
    while queue and len(found) < visits:
        _, node = heapq.heappop(queue)
        kids = tree.children[node]
        if not kids:
            found.append(tree.leaf[node])
        for k in kids:
            heapq.heappush(queue, (-float(q @ tree.centroids[k]), k))
    return found


def _matrix(column: pa.Array) -> np.ndarray:
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)


def top(q_ids: np.ndarray, q: np.ndarray, v_ids: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, vec_id, score) of the best k per query, own id left out, ties to the smaller id."""
    qs, vs, ss = [], [], []
    for a in range(0, len(q), 512):
        s = q[a : a + 512] @ v.T
        s[q_ids[a : a + 512, None] == v_ids[None, :]] = -np.inf
        if s.shape[1] > k:
            edge = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
        else:
            edge = np.full(len(s), -np.inf)
        # the product may differ in the last bits from the exact score: keep near ties
        slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(edge), edge, 0.0)))
        r, c = np.nonzero((s >= (edge - slack)[:, None]) & (s > -np.inf))
        exact = np.empty(len(r))
        for b in range(0, len(r), 65536):
            exact[b : b + 65536] = (q[a + r[b : b + 65536]] * v[c[b : b + 65536]]).sum(axis=1)
        order = np.lexsort((v_ids[c], -exact, r))
        r, c, exact = r[order], c[order], exact[order]
        first = np.searchsorted(r, r)
        keep = np.arange(len(r)) - first < k
        qs.append(q_ids[a + r[keep]])
        vs.append(v_ids[c[keep]])
        ss.append(exact[keep])
    cat = lambda xs, kind: np.concatenate(xs) if xs else np.empty(0, kind)
    return cat(qs, np.int64), cat(vs, np.int64), cat(ss, np.float64)


_FOUND = "query_id bigint, vec_id bigint, score double"


def _found(q_ids, q, v_ids, v, k) -> dict[str, pa.Array]:
    a, b, s = top(q_ids, q, v_ids, v, k)
    return {"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(s, pa.float64())}


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def valid_vectors(table: DataFrame) -> DataFrame:
    """vec_id, embedding (array<double>) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = table.where("vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0").where(fine)
    sizes = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    n = sizes[0]["n"] if sizes else 0
    return rows.where(F.size("embedding") == n).select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("embedding"))


def _exact(queries: tuple[np.ndarray, np.ndarray], rows: DataFrame, k: int) -> DataFrame:
    """Brute force for a bounded set of queries over all rows, block by block."""
    q_ids, q = queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                yield pa.RecordBatch.from_pydict(_found(q_ids, q, b["vec_id"].to_numpy(), _matrix(b["embedding"]), k))

    return _best(rows.mapInArrow(run, _FOUND), k)


def calibrate(tree: Tree, queries: tuple[np.ndarray, np.ndarray], truth: list[tuple[int, int]], target: float) -> int:
    """Leaf visits that hold ``target`` of the (query position, leaf of a true neighbour) pairs; doubling, then halving the gap."""
    order = [{leaf: i for i, leaf in enumerate(best_bins(tree, q, tree.leaves))} for q in queries[1]]
    at = np.array([order[i][leaf] for i, leaf in truth])
    recall = lambda n: (at < n).mean() if len(at) else 1.0
    high = 1
    while high < tree.leaves and recall(high) < target:
        high = min(2 * high, tree.leaves)
    low = high // 2
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if recall(mid) >= target else (mid, high)
    return high


def nearest(table: DataFrame, is_query: str, k: int = K, target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for every row that satisfies ``is_query``."""
    spark = table.sparkSession
    bounded_batches(spark, BLOCK)
    rows = valid_vectors(table)
    first = bounded_sample(rows, "vec_id", SAMPLE).toArrow()
    if first.num_rows == 0:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    tree = fit_tree(_matrix(first["embedding"]))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                yield pa.RecordBatch.from_arrays([pa.array(descend(tree, _matrix(b["embedding"]))), b["vec_id"], b["embedding"]], names=["leaf", "vec_id", "embedding"])

    indexed = stored(rows.mapInArrow(index, "leaf int, vec_id bigint, embedding array<double>"), "ann-index")
    queries = indexed.where(is_query)
    probe = bounded_sample(queries, "vec_id", CALIBRATION, SEED).select("vec_id", "embedding").toArrow()
    probe = (probe["vec_id"].to_numpy(), _matrix(probe["embedding"]))
    # the leaves of the true neighbours: CALIBRATION x k rows
    exact = _exact(probe, indexed, k).join(indexed.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").collect() if len(probe[0]) else []
    place = {int(v): i for i, v in enumerate(probe[0])}
    visits = calibrate(tree, probe, [(place[r["query_id"]], r["leaf"]) for r in exact], target)
    sizes = {r["leaf"]: r["count"] for r in indexed.groupBy("leaf").count().collect()}  # a row per leaf
    if sum(sizes.values()) <= k + 1:
        visits = tree.leaves

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = _matrix(b["embedding"]) if len(b) else []
            pairs = [(i, leaf) for i, x in enumerate(q) for leaf in best_bins(tree, x, visits)]
            at = pa.array([i for i, _ in pairs], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([x for _, x in pairs], pa.int32()), b["vec_id"].take(at), b["embedding"].take(at)], names=["leaf", "query_id", "query"])

    # a query row that is repeated asks once
    routed = stored(queries.select("vec_id", "embedding").dropDuplicates().mapInArrow(route, "leaf int, query_id bigint, query array<double>"), "ann-routed")
    asked = {r["leaf"]: r["count"] for r in routed.groupBy("leaf").count().collect()}
    blocks = [(x, -(-n // BLOCK), -(-asked[x] // BLOCK)) for x, n in sizes.items() if x in asked]
    if not blocks:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    cut = F.broadcast(spark.createDataFrame(blocks, "leaf int, nv int, nq int"))  # a row per leaf
    salt = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    right = indexed.join(cut, "leaf").select("leaf", salt("vec_id", "nv").alias("vb"), every("nq").alias("qb"), "vec_id", "embedding")
    left = routed.join(cut, "leaf").select("leaf", every("nv").alias("vb"), salt("query_id", "nq").alias("qb"), "query_id", "query")

    def meet(key, q: pa.Table, v: pa.Table) -> pa.Table:
        if not (q.num_rows and v.num_rows):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return pa.table(_found(q["query_id"].to_numpy(), _matrix(q["query"]), v["vec_id"].to_numpy(), _matrix(v["embedding"]), k))

    keys = ["leaf", "vb", "qb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, _FOUND)
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
