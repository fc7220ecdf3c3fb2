"""Approximate nearest neighbours: hierarchical k-means tree, best bin first, calibrated visits.

The tree is fitted on at most ``sample`` vectors (smallest seeded hash of vec_id: the documented
bound); every vector is then indexed under a leaf by a map.  A query walks the tree with a
priority queue of branches by closeness and lists leaves in that order.  How many it visits is
calibrated on the sample: visits widen until the queries of a calibration set reach
``recall``, and for each query further until its leaves hold enough rows.  The tree has a
bounded number of leaves, so what goes to the tasks (centres, leaf sizes) is bounded as well.
Every vector length with more than ``LEAF`` sampled vectors has a tree of its own; queries of a
rarer length meet all rows of that length, in blocks, so their result is exact.

Equal rows become one before anything is counted, and the k best are cut over ids, not rows.
Queries and rows meet on (leaf, block): leaves are cut into blocks of about ``BLOCK`` rows, and
the queries of a leaf likewise, so a leaf that holds a third of all vectors (one common vector)
is many small groups.  A group sends on at most k rows per query, ties resolved by vec_id on
exact scores.  Scores are cosines of the original vectors in double precision.

Defined cases: vectors null, empty, zero or with null or non-finite components take no part, nor do
rows without vec_id; a cosine needs two vectors of one length, so a query is held against the rows
of its length; a vec_id that repeats counts once, with its best score, and is no candidate of its own query; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE, BRANCH, LEAF, RECALL, BLOCK, SEED = 20_000, 8, 48, 0.97, 4096, 11


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(-1, keepdims=True))


class Tree:
    """Centres of a hierarchical k-means tree over unit vectors."""

    def __init__(self, x: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = SEED):
        self.rng, self.nodes, self.leaves, self.dim = np.random.default_rng(seed), [], 0, x.shape[1]
        self.root = self._grow(x, branch, leaf, 0)
        del self.rng

    def _grow(self, x: np.ndarray, branch: int, leaf: int, depth: int) -> int:
        """Index of a node: (centres, children) or (None, leaf number)."""
        me = len(self.nodes)
        self.nodes.append(None)
        distinct = np.unique(x, axis=0) if depth < 12 and len(x) > leaf else x[:0]
        if len(distinct) >= branch:
            centres = unit(distinct[self.rng.choice(len(distinct), branch, replace=False)])
            for _ in range(8):
                near = (x @ centres.T).argmax(1)
                sums = np.stack([x[near == b].sum(0) if (near == b).any() else centres[b] for b in range(branch)])
                norms = np.sqrt((sums * sums).sum(1, keepdims=True))
                centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
            near = (x @ centres.T).argmax(1)
            used = [b for b in range(branch) if (near == b).any()]
            if len(used) > 1:
                self.nodes[me] = (centres[used], [self._grow(x[near == b], branch, leaf, depth + 1) for b in used])
                return me
        self.nodes[me] = (None, self.leaves)
        self.leaves += 1
        return me

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf numbers of unit vectors: the nearest centre at every level."""
        out = np.zeros(len(x), np.int32)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            centres, below = self.nodes[node]
            if centres is None:
                out[rows] = below
            elif len(rows):
                near = np.einsum("ij,kj->ik", x[rows], centres).argmax(1)
                todo += [(child, rows[near == b]) for b, child in enumerate(below)]
        return out

    def visit(self, q: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        queue, tick = [(0.0, 0, self.root)], 0
        while queue:
            _, _, node = heapq.heappop(queue)
            centres, below = self.nodes[node]
            if centres is None:
                yield below
                continue
            for close, child in zip((centres @ q).tolist(), below):
                tick += 1
                heapq.heappush(queue, (-close, tick, child))


def calibrate(tree: Tree, x: np.ndarray, ids: np.ndarray, k: int, recall: float = RECALL, queries: int = 300) -> int:
    """Leaf visits at which the k nearest ids of the sample's first vectors are found at ``recall``."""
    leaf = tree.leaf_of(x)
    need = []
    for i in range(min(queries, len(x))):
        top: dict[int, int] = {}
        for t in np.argsort(-(x @ x[i]), kind="stable"):
            if ids[t] != ids[i]:
                top.setdefault(ids[t], t)
                if len(top) == k:
                    break
        place = {v: n for n, v in enumerate(tree.visit(x[i]), 1)}
        need += [place[leaf[t]] for t in top.values()]
    return int(np.quantile(need, recall, method="higher")) if need else 1


def by_length(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All numbers of a list column, and where each row's begin and how many they are."""
    size = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    return vectors.flatten().to_numpy(zero_copy_only=False), np.cumsum(size) - size, size


def of_length(numbers: np.ndarray, begin: np.ndarray, size: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a length, and their vectors as a matrix."""
    rows = np.flatnonzero(size == dim)
    return rows, numbers[begin[rows][:, None] + np.arange(dim)]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, e): doubles, without null, zero or non-finite vectors."""
    e = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("e"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & finite & F.exists("e", lambda x: x != 0))


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each vec_id divisible by ``every``."""
    rows = usable(vectors).dropDuplicates()
    got = rows.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id", "e").limit(sample).toArrow()  # 8 bytes a number, bounded
    ids, held = got.column("vec_id").to_numpy(), by_length(got.column("e").combine_chunks())
    trees, first, visits, leaves = {}, {}, {}, 0
    for dim, n in zip(*np.unique(held[2], return_counts=True)):
        if n > LEAF:
            some, x = of_length(*held, dim)
            tree = Tree(unit(x))
            trees[int(dim)], first[int(dim)], visits[int(dim)] = tree, leaves, calibrate(tree, unit(x), ids[some], k)
            leaves += tree.leaves

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            numbers, begin, size = by_length(b.column(1))
            leaf = -size.astype(np.int32)  # of a length without a tree
            for dim in np.unique(size).tolist():
                if dim in trees:
                    some, x = of_length(numbers, begin, size, dim)
                    leaf[some] = first[dim] + trees[dim].leaf_of(unit(x))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(leaf), pa.array([numbers[p:p + n].tobytes() for p, n in zip(begin, size)], pa.binary())],
                                             names=["vec_id", "leaf", "e"])

    placed = rows.mapInArrow(assign, "vec_id long, leaf int, e binary").checkpoint(eager=True)
    held = {r.leaf: r["count"] for r in placed.where("leaf >= 0").groupBy("leaf").count().collect()}  # one row per leaf
    sizes = [held.get(i, 0) for i in range(leaves)]
    # an id with several vectors counts in the first of its leaves only: no id is seen twice
    own = placed.groupBy("vec_id").agg(F.min("leaf").alias("leaf")).where("leaf >= 0").groupBy("leaf").count()
    ids_in = {r.leaf: r["count"] for r in own.collect()}

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for q, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                dim, seen = len(data) // 8, 0
                if dim not in trees:
                    out.append((q, -dim, data))
                    continue
                for n, here in enumerate(trees[dim].visit(unit(np.frombuffer(data)))):
                    if n >= visits[dim] and seen > k:  # k ids besides the query's
                        break
                    leaf = first[dim] + here
                    if sizes[leaf]:
                        seen += ids_in.get(leaf, 0)
                        out.append((q, leaf, data))
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], kind) for c, kind in enumerate((pa.int64(), pa.int32(), pa.binary()))],
                                             names=["query_id", "leaf", "qe"])

    asked = (placed.where(F.col("vec_id") % every == 0).select("vec_id", "e").dropDuplicates()
             .mapInArrow(ask, "query_id long, leaf int, qe binary").checkpoint(eager=True))
    asks = {r.leaf: r["count"] for r in asked.where("leaf >= 0").groupBy("leaf").count().collect()}  # one row per leaf

    def in_tree(table: DataFrame) -> DataFrame:
        if not leaves:
            return table.where("false").withColumns({"blocks": F.lit(1), "rounds": F.lit(1)})
        of = lambda some: F.element_at(F.array(*[F.lit(-(-max(1, n) // BLOCK)) for n in some]), F.col("leaf") + 1)
        return table.where("leaf >= 0").withColumns({"blocks": of(sizes), "rounds": of([asks.get(i, 0) for i in range(leaves)])})

    # lengths without a tree: their numbers of blocks stay in a table, there may be many
    parts = lambda n: F.greatest(F.lit(1), F.ceil(n / BLOCK)).cast("int")
    rare = placed.where("leaf < 0").groupBy("leaf").agg(
        parts(F.count(F.lit(1))).alias("blocks"), parts(F.count_if(F.col("vec_id") % every == 0)).alias("rounds"))
    some_rare = placed.where("leaf < 0").limit(1).count() > 0

    def sized(table: DataFrame) -> DataFrame:
        return in_tree(table).unionByName(table.where("leaf < 0").join(rare, "leaf")) if some_rare else in_tree(table)

    def each(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def one(key, n):
        return F.pmod(F.xxhash64(key), F.col(n)).cast("int")

    left = sized(asked).select("query_id", "leaf", "qe", one("query_id", "rounds").alias("j"), each("blocks").alias("i"))
    right = sized(placed).select("vec_id", "leaf", "e", one("vec_id", "blocks").alias("i"), each("rounds").alias("j"))

    def meet(queries: pd.DataFrame, rows_: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        if len(queries) and len(rows_):
            rows_ = rows_.sort_values("vec_id", kind="stable")
            a = np.frombuffer(b"".join(rows_["e"]), np.float64).reshape(len(rows_), -1)
            ids, norms = rows_["vec_id"].to_numpy(), np.sqrt((a * a).sum(1))
            ua = a / norms[:, None]
            firsts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            for s in range(0, len(queries), 256):
                part = queries.iloc[s:s + 256]
                q = np.frombuffer(b"".join(part["qe"]), np.float64).reshape(len(part), -1)
                nq = np.sqrt((q * q).sum(1))
                close = (q / nq[:, None]) @ ua.T
                for m, query in enumerate(part["query_id"]):
                    c = np.where(ids == query, -np.inf, close[m])
                    best_of = np.maximum.reduceat(c, firsts)  # one score per vec_id
                    edge = np.partition(best_of, -k)[-k] if len(best_of) > k else -np.inf
                    near = np.flatnonzero((c >= edge - 1e-9) & (c > -np.inf))
                    exact = (a[near] * q[m]).sum(1) / (norms[near] * nq[m])
                    best = np.lexsort((ids[near], -exact))
                    some: dict[int, float] = {}
                    for t in best:
                        some.setdefault(int(ids[near[t]]), float(exact[t]))
                        if len(some) == k:
                            break
                    out += [(query, v, sc) for v, sc in some.items()]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    met = left.groupBy("leaf", "i", "j").cogroup(right.groupBy("leaf", "i", "j")).applyInPandas(meet, "query_id long, vec_id long, score double")
    once = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
