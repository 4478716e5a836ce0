"""Connected components by hooking and pointer jumping on distributed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.llm.common import stash

# A round of few edges over many partitions would write as many tiny files.
EDGES_PER_FILE, LEAST_FILES = 2_000, 8


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node``, ``component``: the smallest node reachable over ``edges`` (``a``, ``b``).

    Nodes without an edge are not listed. Each round turns every edge into links to the
    smallest neighbour (large-star, then small-star); the number of edges never grows, a
    node with very many neighbours is a partial aggregation, and rounds grow with the
    logarithm of the longest path. Each round is a table in the shared folder.
    """
    now = stash(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    state = _state(now)
    for _ in range(max_rounds):
        files = max(state[0] // EDGES_PER_FILE, LEAST_FILES)
        now = stash(_small_star(_large_star(now)).coalesce(files), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """Tells edges apart that differ; a round that changes nothing is the last."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b") % 65_521)).first())


def extend(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` (``node``, ``component``) after some more ``links`` (``a``, ``b``).

    Only the components themselves are joined, so the work follows the new links.
    """

    def inside(side: str) -> DataFrame:
        return groups.select(F.col("node").alias(side), F.col("component").alias(f"part_{side}"))

    joined = (
        links.join(inside("a"), "a", "left")
        .join(inside("b"), "b", "left")
        .select(F.coalesce("part_a", "a").alias("a"), F.coalesce("part_b", "b").alias("b"))
    )
    moved = components(joined)
    renamed = groups.join(
        moved.select(F.col("node").alias("component"), F.col("component").alias("into")), "component", "left"
    ).select("node", F.coalesce("into", "component").alias("component"))
    return stash(renamed.unionByName(moved.join(groups.select("node"), "node", "left_anti")), "groups")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    return (
        joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .where("a <> b")
        .distinct()
    )
