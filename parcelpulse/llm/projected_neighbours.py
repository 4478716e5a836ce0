"""Nearest neighbours by inner product: stable projections, kd-trees, chi-square stopping.

Vectors get one more component, so that all have the greatest norm and a larger inner product is
a smaller distance. Eight Gaussian projections of these are indexed by kd-trees, one per shard
of all rows. A query takes leaves in order of their projected distance and verifies all their
vectors with exact inner products. For a point at distance d the squared projected distance
over d^2 is chi-square with eight degrees of freedom; a query stops when points beyond the next
leaf would be among its nearest with probability ``MISS`` at most.

Queries meet every shard, in blocks. Of equal vectors only those enter a shard that can be in an
answer: the ``k`` + 1 smallest vec_id, as one may be the query's own, and ``k`` rows of each. This
changes no answer.

Vectors that are null, empty, zero or hold null or non-finite components take no part, rows
without vec_id neither. Vectors of another length than the query's are no candidates. Rows with the
query's own vec_id are left out. Ties go to the smaller vec_id. Rows that share a vec_id are one query,
with the smallest of their vectors (by components in order, a shorter one that begins alike first).
"""

from __future__ import annotations

from math import exp, factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelpulse.llm.common import stash

PROJECTIONS = 8  # even: the distribution function is a finite sum then
LEAF = 128
SHARD_ROWS = 16_384
BLOCK_QUERIES = 1_024
STEP = 4  # leaves verified at first, then twice as many each time
MISS = 0.05

RESULT = "query_id bigint, vec_id bigint, score double"


def valid_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id``, ``embedding`` of rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    fine = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    ) & F.exists("embedding", lambda x: x != 0)
    return (
        rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("embedding"))
        .where("vec_id is not null and embedding is not null")
        .where(fine)
    )


def chi_square_below(x: np.ndarray, degrees: int = PROJECTIONS) -> np.ndarray:
    """Distribution function for even degrees of freedom."""
    half = np.asarray(x) / 2
    return 1 - np.exp(-half) * sum(half**k / factorial(k) for k in range(degrees // 2))


def stop_ratio(miss: float) -> float:
    """Squared projected over squared distance that a chi-square exceeds with ``miss``."""
    low, high = 0.0, 200.0
    while high - low > 1e-9:
        mid = (low + high) / 2
        tail = exp(-mid / 2) * sum((mid / 2) ** k / factorial(k) for k in range(PROJECTIONS // 2))
        low, high = (mid, high) if tail > miss else (low, mid)
    return high


class Tree:
    """A kd-tree's leaves: boxes around some points each, by median cuts of the widest side."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        edges, todo = [], [(0, len(points))]
        while todo:
            a, b = todo.pop()
            if b - a <= LEAF:
                edges.append((a, b))
                continue
            part = points[self.order[a:b]]
            side = int(np.argmax(np.ptp(part, axis=0)))
            middle = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(part[:, side], middle)]
            todo += [(a, a + middle), (a + middle, b)]
        edges.sort()
        self.starts = np.array([a for a, _ in edges])
        self.ends = np.array([b for _, b in edges])
        ordered = points[self.order]
        self.low = np.minimum.reduceat(ordered, self.starts)
        self.high = np.maximum.reduceat(ordered, self.starts)

    def distances(self, point: np.ndarray) -> np.ndarray:
        """Squared distances from a point to the boxes."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        return (gap * gap).sum(axis=1)


def search(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, top: float, k: int, miss: float
) -> pd.DataFrame:
    """Nearest ``k`` of one shard for each query; ``top`` is the greatest squared norm of all."""
    dims = vectors.shape[1]
    lift = np.random.default_rng(dims).standard_normal((dims + 1, PROJECTIONS))
    extra = np.sqrt(np.maximum(top - (vectors * vectors).sum(axis=1), 0))
    tree = Tree(np.column_stack([vectors, extra]) @ lift)
    vectors, ids = vectors[tree.order], ids[tree.order]
    points = queries @ lift[:dims]
    norms = (queries * queries).sum(axis=1)
    ratio = stop_ratio(miss)
    starts, ends, every_row = tree.starts.tolist(), tree.ends.tolist(), np.arange(len(ids))
    out = []
    for query_id, query, point, norm in zip(query_ids, queries, points, norms, strict=True):
        near = tree.distances(point)
        leaves = np.argsort(near, kind="stable")
        slack = 1e-9 * np.sqrt(norm * top)
        best_rows, best = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, STEP
        while at < len(leaves):
            if len(best) >= k:
                # The lifted query has no last component: distance^2 = norm + top - 2 * product.
                kth = np.partition(best, len(best) - k)[len(best) - k]
                # Equal vectors may be in several leaves at distance 0; none of these is passed over.
                if near[leaves[at]] > ratio * (norm + top - 2 * kth + slack):
                    break
            spans = [(starts[leaf], ends[leaf]) for leaf in leaves[at : at + step]]
            best = np.concatenate([best, *(vectors[a:b] @ query for a, b in spans)])
            best_rows = np.concatenate([best_rows, *(every_row[a:b] for a, b in spans)])
            other = ids[best_rows] != query_id
            best, best_rows = best[other], best_rows[other]
            if len(best) > 2 * k:
                # All that may tie with the k-th stay; products of equal vectors differ by rounding.
                keep = best >= np.partition(best, len(best) - k)[len(best) - k] - slack
                best, best_rows = best[keep], best_rows[keep]
            at, step = at + step, 2 * step
        # Sums in one order, whatever the leaf a vector is in: equal vectors score alike.
        best = (vectors[best_rows] * query).sum(axis=1)
        keep = np.lexsort((ids[best_rows], -best))[:k]
        best, best_ids = best[keep], ids[best_rows[keep]]
        out.append(pd.DataFrame({"query_id": query_id, "vec_id": best_ids, "score": best}))
    return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("query_id", "vec_id", "score")})


def nearest(
    rows: DataFrame, every: int = 20, k: int = 20, miss: float = MISS
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: nearest rows of ids divisible by ``every``."""
    vectors = stash(valid_vectors(rows).withColumn("dims", F.size("embedding")), "vectors")
    norm = F.aggregate("embedding", F.lit(0.0), lambda sum_, x: sum_ + x * x)
    sizes = stash(
        vectors.groupBy("dims").agg(F.count("*").alias("n"), F.max(norm).alias("top")), "sizes"
    )
    counted = vectors.join(F.broadcast(sizes), "dims")  # a row per length of vectors
    shards = F.ceil(F.col("n") / SHARD_ROWS).cast("int")
    blocks = F.ceil(F.col("n") / every / BLOCK_QUERIES).cast("int")
    # Of equal vectors an answer holds k at most, and all rows of the query's id are left out.
    copies = Window.partitionBy("embedding", "vec_id").orderBy("dims")
    equal = Window.partitionBy("embedding").orderBy("vec_id")
    candidates = (
        counted.withColumn("copy", F.row_number().over(copies))
        .where(F.col("copy") <= k)
        .withColumn("place", F.dense_rank().over(equal))
        .where(F.col("place") <= k + 1)
        .withColumn("shard", F.pmod(F.xxhash64("vec_id"), shards).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("dims", "shard", "block", "top", "vec_id", "embedding")
    )
    queries = (
        vectors.where(F.col("vec_id") % every == 0)
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
        .withColumn("dims", F.size("embedding"))
        .join(F.broadcast(sizes), "dims")
        .withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), blocks).cast("int"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), shards - 1)))
        .select(*(F.col(c).alias(f"query_{c}") for c in ("dims", "shard", "block", "vec_id", "embedding")))
    )

    def meet(some: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        some = some.sort_values("vec_id")
        asked = asked.sort_values("query_vec_id")
        return search(
            some["vec_id"].to_numpy(),
            np.stack(some["embedding"].to_numpy()),
            asked["query_vec_id"].to_numpy(),
            np.stack(asked["query_embedding"].to_numpy()),
            float(some["top"].iloc[0]),
            k,
            miss,
        )

    keys = ["dims", "shard", "block"]
    found = candidates.groupBy(keys).cogroup(queries.groupBy([f"query_{c}" for c in keys])).applyInPandas(meet, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
