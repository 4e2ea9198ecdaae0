"""Approximate nearest neighbours by a forest of random-projection trees
(operator 8).

Trees are grown on a bounded sample of distinct vectors: a node splits at the
median of its vectors along the difference of two random ones, until LEAF
remain.  Every row is then filed under its leaf of each tree.  A query walks all
trees through one shared priority queue, most promising branch first (the least
margin on its path), until the leaves it has reached hold SEARCH vectors by the
sample's reckoning.  Where queries and vectors meet in a leaf, exact inner
products rank them, each leaf sends its best, and the best of all leaves are
the answer.

Nearness is the inner product in double precision; vectors are lengthened by one
component that gives all of them the largest norm, so that walking by angle
finds large products.  Rows with equal vectors are one candidate with all its
ids: of those only the k + 1 smallest ids can appear in an answer, which is
exact, not a cap.  A leaf of any size is dealt out in blocks of BLOCK vectors, and
its queries in blocks of BLOCK too; every two blocks meet.

Null vectors, zero vectors and vectors with null or non-finite components, and
rows with a null id, take no part.  Vectors of different lengths have no product:
each length is a table of its own.  Repeated rows are candidates each.  An empty
table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.common import ready, stored

K = 20
SAMPLE = 20_000
TREES, LEAF, SEARCH = 12, 256, 20_000
BLOCK, ASKED = 4_096, 512   # vectors, and queries at a time, that meet in one product
SEED = 20


class Forest:
    """Trees as arrays: ``normal[node]``, ``offset[node]``, ``child[node]`` (two
    nodes, or -1 and a leaf's size)."""

    def __init__(self, vectors: np.ndarray, trees: int, leaf: int, seed: int):
        self.trees, rng = [], np.random.default_rng(seed)
        for _ in range(trees):
            normals, offsets, children = [], [], []

            def grow(rows: np.ndarray) -> int:
                node = len(normals)   # noqa: B023
                normals.append(None)   # noqa: B023
                offsets.append(0.0)   # noqa: B023
                children.append((-1, len(rows)))   # noqa: B023
                if len(rows) > leaf:
                    a, b = vectors[rng.choice(rows, 2, replace=False)]
                    n = (a - b) / (np.linalg.norm(a - b) or 1)
                    side = vectors[rows] @ n
                    cut = float(np.median(side))
                    left = side <= cut
                    if left.all() or not left.any():
                        left = side < cut
                    if left.any() and not left.all():
                        normals[node], offsets[node] = n, cut   # noqa: B023
                        children[node] = (grow(rows[left]), grow(rows[~left]))   # noqa: B023
                return node

            grow(np.arange(len(vectors)))
            dim = vectors.shape[1]
            self.trees.append((np.array([np.zeros(dim) if n is None else n for n in normals]), np.array(offsets),
                               np.array(children, dtype=np.int64)))

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """vectors x trees: the leaf node of each vector."""
        out = np.zeros((len(vectors), len(self.trees)), dtype=np.int64)
        for t, (normals, offsets, children) in enumerate(self.trees):
            at = np.zeros(len(vectors), dtype=np.int64)
            while len(going := np.flatnonzero(children[at, 0] >= 0)):
                n = at[going]
                right = np.einsum("ij,ij->i", vectors[going], normals[n]) > offsets[n]
                at[going] = children[n, right.astype(int)]
            out[:, t] = at
        return out

    def probe(self, query: np.ndarray, search: int) -> list[tuple[int, int]]:
        """(tree, leaf) pairs that one query reads, by the shared queue."""
        margins = [normals @ query - offsets for normals, offsets, _ in self.trees]
        queue = [(-np.inf, t, 0) for t in range(len(self.trees))]
        heapq.heapify(queue)
        found, held = [], 0
        while queue and held < search:
            worst, tree, node = heapq.heappop(queue)
            first, second = self.trees[tree][2][node]
            if first < 0:
                found.append((tree, int(node)))
                held += int(second)
            else:
                m = margins[tree][node]
                near, far = (second, first) if m > 0 else (first, second)
                heapq.heappush(queue, (worst, tree, int(near)))
                heapq.heappush(queue, (max(worst, abs(m)), tree, int(far)))
        return found


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ok & F.exists("v", lambda x: x != 0)))


def lengthened(v: np.ndarray, most: float) -> np.ndarray:
    return np.hstack([v, np.sqrt(np.maximum(most - np.einsum("ij,ij->i", v, v), 0))[:, None]])


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products, summed component by component: equal pairs give equal
    numbers wherever they meet (a matrix product promises no order)."""
    out = np.zeros((len(queries), len(vectors)))
    for q, v in zip(queries.T, np.ascontiguousarray(vectors.T), strict=True):
        out += q[:, None] * v
    return out


def search(rows: DataFrame, is_query: str = "vec_id % 20 = 0", k: int = K, trees: int = TREES, leaf: int = LEAF,
           search: int = SEARCH, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its ``k`` nearest
    other rows found."""
    spark = rows.sparkSession
    ready(spark)
    part = usable(rows)
    kind = "<f4" if dict(rows.dtypes)["embedding"] == "array<float>" else "<f8"   # as stored, so nothing is lost on the way
    lengths = part.groupBy(F.size("v").alias("w")).agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("most"))
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for r in lengths.orderBy("w").toLocalIterator():   # nearly always one length
        out = out.unionByName(_search(part.where(F.size("v") == r["w"]), kind, r["w"], r["most"] * (1 + 1e-12), is_query, k, trees, leaf, search, sample, seed))
    return out


def _search(part: DataFrame, kind: str, width: int, most: float, is_query: str, k: int, trees: int, leaf: int, search: int, sample: int,
            seed: int) -> DataFrame:
    """The answers among vectors (vec_id, v) of one length; ``most`` is the largest squared norm."""
    spark = part.sparkSession
    # One row per distinct vector with its k + 1 smallest ids; the limit acts before the shuffle, so no group grows.
    first = part.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    distinct = stored(first.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
                      .withColumn("class", F.element_at("ids", 1)), "vectors")
    chosen = distinct.orderBy(F.xxhash64("class"), "class").limit(sample).select("v").collect()
    forest = Forest(lengthened(np.array([r["v"] for r in chosen], dtype=float), most), trees, leaf, seed)
    shared = spark.sparkContext.broadcast(forest)   # at most trees x sample / leaf nodes

    def file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = np.stack(b["v"].to_numpy()) if len(b) else np.empty((0, width))
            at = shared.value.leaves(lengthened(v, most))
            n = at.shape[1]
            yield pd.DataFrame({"tree": np.tile(np.arange(n), len(b)), "leaf": at.ravel(), "class": np.repeat(b["class"].to_numpy(), n),
                                "v": [x for y in v for x in [y.astype(kind).tobytes()] * n]})

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = np.stack(b["v"].to_numpy()) if len(b) else np.empty((0, width))
            q = np.hstack([v, np.zeros((len(v), 1))])   # a query points; only candidates are lengthened
            hits = [(t, leaf, c, x.astype(kind).tobytes()) for c, x, y in zip(b["class"], v, q, strict=True)
                    for t, leaf in shared.value.probe(y, search)]
            yield pd.DataFrame(hits, columns=["tree", "leaf", "class", "v"])

    place = "tree int, leaf long, class long, v binary"
    filed = distinct.select("class", "v").mapInPandas(file, place)
    queries = part.where(F.expr(is_query)).select("vec_id", "v")
    asked = stored(queries.groupBy("v").agg(F.min("vec_id").alias("class")), "asked")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))   # few rows, but much work for each
    probes = stored(asked.select("class", "v").repartition(tasks, "class").mapInPandas(probe, place), "probes")

    sizes = stored(filed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")), "leaf-sizes")   # a row per leaf
    wanted = probes.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("q"))
    parts_of = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    blocks = F.broadcast(sizes.join(wanted, ["tree", "leaf"]).select("tree", "leaf", parts_of("n").alias("blocks"), parts_of("q").alias("turns")))
    own = lambda n: F.pmod(F.xxhash64("class"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    blocked = filed.join(blocks, ["tree", "leaf"]).withColumn("block", own("blocks")).withColumn("turn", every("turns")).drop("blocks", "turns")
    asking = probes.join(blocks, ["tree", "leaf"]).withColumn("turn", own("turns")).withColumn("block", every("blocks")).drop("blocks", "turns")

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            left = left.sort_values("class")   # a stable sort by score then leaves ties to the smaller id
            ids, asked = left["class"].to_numpy(), right["class"].to_numpy()
            c, q = (np.frombuffer(b"".join(x["v"]), dtype=kind).astype(float).reshape(len(x), -1) for x in (left, right))
            for at in range(0, len(q), ASKED):
                s = products(q[at:at + ASKED], c)
                best = np.argsort(-s, axis=1, kind="stable")[:, :k + 1]   # one of them may be the query's own
                out.append(pd.DataFrame({"asked": np.repeat(asked[at:at + ASKED], best.shape[1]), "class": ids[best].ravel(),
                                         "score": np.take_along_axis(s, best, axis=1).ravel()}))
        return pd.concat(out) if out else pd.DataFrame({"asked": [], "class": [], "score": []})

    keys = ["tree", "leaf", "block", "turn"]
    met = blocked.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInPandas(meet, "asked long, class long, score double")
    # Best classes of each asked vector, then their ids, then the answers of every query with that vector.
    by_score = [F.col("score").desc(), F.col("class")]
    top = (met.groupBy("asked", "class").agg(F.max("score").alias("score"))
           .withColumn("r", F.row_number().over(Window.partitionBy("asked").orderBy(*by_score))).where(F.col("r") <= k + 1))
    best = (top.join(distinct.select("class", "ids"), "class")
            .select("asked", F.explode("ids").alias("vec_id"), "score")
            .withColumn("r", F.row_number().over(Window.partitionBy("asked").orderBy(F.col("score").desc(), "vec_id")))
            .where(F.col("r") <= k + 1))
    whole = stored(best.groupBy("asked").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("best")), "best")
    asks = queries.join(asked.select("v", F.col("class").alias("asked")), "v").select(F.col("vec_id").alias("query_id"), "asked")
    answer = (asks.join(whole, "asked")
              .select("query_id", F.filter("best", lambda b: b["vec_id"] != F.col("query_id")).alias("best"))
              .select("query_id", F.posexplode(F.slice("best", 1, k)).alias("p", "b"))
              .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), "b.vec_id", "b.score"))
    return answer
