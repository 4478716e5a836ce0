"""Mixing sources to target weights by the cube method.

Sources share all words by weight; a target stops at three times its source's size and the rest
is shared again. A source's rate is target / size: each of its documents is taken floor(rate)
times, and once more with the rest as inclusion probability. Which ones is decided by balanced
sampling: the vector of probabilities moves through the null space of the balancing
constraints (numbers of words and of documents) until it meets 0 or 1 almost everywhere.

Documents go to blocks by hash within their source, some thousand each, so a source of any size
is handled in parallel. A block leaves two undecided documents, and three of spread sizes are
held back; what is left goes to the blocks of the next level. The last block of a source lands: from
large to small, each document is rounded so that the error in words stays least.

Every choice follows from hashes, so reruns agree. Rows with equal id, source and text are one
unit and get one decision. A null text has no word; null sources are one source, the last.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelpulse.llm.common import WORD, stash, whole_text

WEIGHTS = (5.0, 2.0, 1.0)  # repeating, sources by code point
MOST = 3  # times
BLOCK = 2_000  # units
HELD = 3  # units that a block holds back
POOL = 64  # units that the last block lands with
EDGE = 1e-9


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source_no``, ``target`` beside the columns of ``sizes`` (``source``, ``source_size``).

    The level is where the sums of min(most * size, level * weight) and of sizes are equal; it
    follows from running sums over the sources, those that are full first.
    """
    ordered = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("source_no", F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("source_no", (F.row_number().over(ordered) - 1).cast("bigint")).withColumn("w", weight)
    full = (F.lit(most) * F.col("source_size")).cast("double")
    by_fill = Window.orderBy(full / F.col("w"), "source_no")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum(full).over(before), F.lit(0.0))) / (
        F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    )
    rows = rows.withColumn("level", level).withColumn(
        "level",
        F.min(
            F.when(full >= F.col("level") * F.col("w"), F.struct(full / F.col("w"), "source_no", "level"))
        ).over(whole)["level"],
    )
    return rows.withColumn("target", F.least(full, F.col("level") * F.col("w"))).drop("level", "w")


def flight(sizes: np.ndarray, probs: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move ``probs`` to 0 or 1 with sums of ``probs`` and ``sizes * probs`` kept.

    Three units span one direction that keeps both sums; a step goes along it to the nearest
    face, one way or the other with the chances that keep the mean. At most two stay undecided.
    """
    p, s = probs.tolist(), sizes.tolist()
    waiting = [k for k in range(len(p) - 1, -1, -1) if EDGE < p[k] < 1 - EDGE]
    draws = rng.random(len(waiting) + 3).tolist()
    live = [waiting.pop() for _ in range(min(3, len(waiting)))]
    while len(live) == 3:
        a, b, c = live
        u = (s[b] - s[c], s[c] - s[a], s[a] - s[b])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = min((1 - p[k]) / x if x > 0 else -p[k] / x for k, x in zip(live, u, strict=True) if x)
        down = min(p[k] / x if x > 0 else (p[k] - 1) / x for k, x in zip(live, u, strict=True) if x)
        step = up if draws.pop() * (up + down) < down else -down
        for k, x in zip(live, u, strict=True):
            p[k] += step * x
        still = []
        for k in live:
            if p[k] <= EDGE:
                p[k] = 0.0
            elif p[k] >= 1 - EDGE:
                p[k] = 1.0
            else:
                still.append(k)
        live = still
        while len(live) < 3 and waiting:
            live.append(waiting.pop())
    return np.array(p)


def land(sizes: np.ndarray, probs: np.ndarray) -> np.ndarray:
    """Round what is undecided, large units first, keeping the error in words least.

    Then turn single units, or two of them, as long as that lessens the error.
    """
    out, error = np.round(probs), 0.0
    open_ = np.flatnonzero((probs > EDGE) & (probs < 1 - EDGE))
    for k in open_[np.lexsort((open_, -sizes[open_]))]:
        up, down = error + sizes[k] * (1 - probs[k]), error - sizes[k] * probs[k]
        out[k], error = (1.0, up) if abs(up) < abs(down) else (0.0, down)
    for _ in range(len(open_)):
        turn = np.append(sizes[open_] * (1 - 2 * out[open_]), 0.0)  # the last turns nothing
        after = np.abs(error + turn[:, None] + turn[None, :])
        np.fill_diagonal(after, np.inf)
        if not len(open_) or after.min() >= abs(error) - EDGE:
            break
        for k in np.unravel_index(np.argmin(after), after.shape):
            if k < len(open_):
                error += turn[k]
                out[open_[k]] = 1 - out[open_[k]]
    return out


def spread(n: int, k: int) -> np.ndarray:
    """Up to ``k`` of ``n`` ranks: the first quarter are the lowest, the others evenly spaced."""
    low = np.arange(min(n, -(-k // 4)))
    return np.unique(np.append(low, np.linspace(0, n - 1, k - len(low)).astype(int))) if n else low


def _decide(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["key", "doc_id", "text_hash"], kind="stable")
    first = group.iloc[0]
    rng = np.random.default_rng([int(first.source_no), int(first.block), int(first.depth)])
    sizes = group["unit_size"].to_numpy(float)
    probs = group["prob"].to_numpy(float).copy()
    open_ = np.flatnonzero((probs > EDGE) & (probs < 1 - EDGE))
    last = int(first.blocks) == 1
    by_size = open_[np.lexsort((open_, sizes[open_]))]
    by_size = by_size[sizes[by_size] > 0]
    pool = min(POOL, max(POOL // 4, len(by_size) // 4)) if last else HELD
    aside = by_size[spread(len(by_size), pool)]
    fly = np.setdiff1d(open_, aside)
    probs[fly] = flight(sizes[fly], probs[fly], rng)
    if last:
        probs = land(sizes, probs)
    return group.assign(prob=probs)


def copies(docs: DataFrame) -> DataFrame:
    """Units with ``taken_copies``: doc_id, source, text_hash, size, n_rows, source_size, target."""
    text = whole_text()
    units = stash(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.xxhash64(text).alias("text_hash"),
            words(text).alias("size"),
        )
        .groupBy("doc_id", "source", "text_hash", "size")
        .agg(F.count("*").alias("n_rows")),
        "units",
    )
    sizes = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n_rows")).alias("source_size"), F.count("*").alias("n_units")
    )
    sources = stash(targets(sizes), "sources")
    rate = F.when(
        F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(MOST)))
    ).otherwise(0.0)
    rows = (
        units.join(sources, units["source"].eqNullSafe(sources["source"]))
        .drop(sources["source"])
        .withColumn("rate", rate)
        .withColumn("times", F.floor(F.col("rate") + EDGE))
        .withColumn("prob", F.greatest(F.col("rate") - F.col("times"), F.lit(0.0)))
        .withColumn("unit_size", F.col("size") * F.col("n_rows"))
        .withColumn("n", F.col("n_units"))
    )
    most = sources.agg(F.max("n_units")).first()[0] or 0
    done, depth = [], 0
    while True:
        rows = (
            rows.withColumn("blocks", F.ceil(F.col("n") / BLOCK))
            .withColumn("depth", F.lit(depth))
            .withColumn("key", F.xxhash64("doc_id", "text_hash", F.lit(depth)))
            .withColumn("block", F.pmod("key", "blocks"))
        )
        decided = stash(
            rows.groupBy("source_no", "block").applyInPandas(_decide, rows.schema), "decided"
        )
        if most <= BLOCK:
            done.append(decided)
            break
        settled = (F.col("prob") <= EDGE) | (F.col("prob") >= 1 - EDGE)
        done.append(decided.where(settled))
        # Each block hands on two undecided units and those held back.
        rows = decided.where(~settled).withColumn("n", F.col("blocks") * (HELD + 2))
        most = -(-most // BLOCK) * (HELD + 2)
        depth += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(
        "doc_id",
        "source",
        "text_hash",
        "size",
        "n_rows",
        "source_size",
        "target",
        (F.col("times") + F.round("prob")).cast("bigint").alias("taken_copies"),
    )


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` for each row of ``docs``."""
    return (
        copies(docs)
        .withColumn("copy", F.explode(F.expr("sequence(1, n_rows)")))
        .select(
            "doc_id", "size", "source_size", "target", (F.col("size") * F.col("taken_copies")).alias("taken")
        )
    )


def take(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, as often as the mix takes them."""
    chosen = copies(docs).where("taken_copies > 0").select(
        F.col("doc_id").alias("_id"),
        F.col("source").alias("_source"),
        F.col("text_hash").alias("_hash"),
        "taken_copies",
    )
    names = docs.columns
    rows = docs.select(F.struct(*names).alias("_row"))
    return (
        rows.withColumn("_key", F.xxhash64(whole_text(F.col("_row.text"))))
        .join(
            chosen,
            (F.col("_key") == F.col("_hash"))
            & F.col("_row.doc_id").cast("bigint").eqNullSafe(F.col("_id"))
            & F.col("_row.source").cast("string").eqNullSafe(F.col("_source")),
        )
        .select("_row", F.explode(F.expr("sequence(1, taken_copies)")))
        .select("_row.*")
    )
