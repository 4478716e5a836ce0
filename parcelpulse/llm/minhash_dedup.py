"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian verification.

A document's set holds its distinct shingles of five words (lower-cased A-Z, ASCII white
space parts words; fewer words are one shingle). Two documents are linked when their sets
have a Jaccard similarity of at least 3/4; the result names the component of each row.

1. Equal sets are one class from the start, however many copies there are.
2. Each class has 256 minima; 32 bands of four make the buckets. A linked pair shares none
   with probability (1 - 0.75^4)^32, about 5e-6 at the very threshold.
3. Members of a bucket are compared with its first member. What is connected by that needs no
   further look. Then each component in a bucket is compared with what is nearest to it, and in
   the end all members of components that are still different.
4. A pair's signatures are compared batch by batch. It is dropped as soon as the posterior
   probability of a similarity of 3/4 (uniform prior) falls below ``miss``. Survivors are
   confirmed on the full sets of words.

Rows are documents: repeated ids are separate rows, and component_id is the smallest id
reachable. A null or empty text has no shingle and is linked with nothing. A null id counts as
greater than all; a component of null ids has a null component_id, and its rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.llm.common import (
    forget,
    hash_shingles,
    hash_words,
    map_arrow,
    mix64,
    pieces,
    release,
    shingle_set,
    small_batches,
    stash,
    text_bytes,
)
from parcelpulse.llm.graph import components, extend

HASHES, BANDS, ROWS, BATCH = 256, 32, 4, 32
SHARE = (3, 4)  # intersection / union at least
MISS = 1e-6
PIECE_BYTES = 400_000
CHUNK = 4_096  # members of a bucket that meet at once
CHUNK_HASHES = 2_000_000  # shingles of their sets, about

_SEEDS = mix64(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_XOR, _MULTIPLY = _SEEDS[:HASHES], _SEEDS[HASHES:] | np.uint64(1)

SETS = "doc_id bigint, text string, row bigint, n_shingles bigint, print binary, signature binary"


@lru_cache(maxsize=64)
def least_matches(seen: int, miss: float, share: float = SHARE[0] / SHARE[1]) -> int:
    """Fewest equal minima among ``seen`` at which P(similarity >= share) is ``miss`` or more."""
    total = 0.0
    for m in range(seen + 1):
        total += comb(seen + 1, m) * share**m * (1 - share) ** (seen + 1 - m)
        if total >= miss:
            return m
    return seen


def survivors(
    signatures: np.ndarray, x: np.ndarray, y: np.ndarray, miss: float
) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs (x, y) of rows pass all batches of the sequential test, and their matches."""
    alive = np.arange(len(x))
    matches = np.zeros(len(x), np.int64)
    for seen in range(BATCH, HASHES + 1, BATCH):
        part = np.ascontiguousarray(signatures[:, seen - BATCH : seen])
        matches = matches + (part[x[alive]] == part[y[alive]]).sum(axis=1)
        passed = matches >= least_matches(seen, miss)
        alive, matches = alive[passed], matches[passed]
    return alive, matches


def _sets(batch: pa.RecordBatch):
    texts = batch.column("text").cast(pa.string()).fill_null("")
    for first, last in pieces(texts, PIECE_BYTES):
        part = batch.slice(first, last - first)
        flat, offsets = text_bytes(texts.slice(first, last - first))
        values, at = hash_shingles(*hash_words(flat, offsets))
        n = last - first
        for begin, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            values[begin:end].sort()
        counts = np.diff(at)
        some = np.flatnonzero(counts)
        new = np.ones(len(values), bool)
        new[1:] = values[1:] != values[:-1]
        new[at[:-1][some]] = True
        sizes = np.zeros(n, np.int64)
        prints = np.zeros((n, 2), np.uint64)
        minima = np.zeros((n, HASHES), np.uint64)
        if len(some):
            starts = at[:-1][some]
            sizes[some] = np.add.reduceat(new.astype(np.int64), starts)
            for k, salt in enumerate((0x51AB, 0xC0DE)):
                mixed = np.where(new, mix64(values ^ np.uint64(salt)), np.uint64(0))
                prints[some, k] = np.add.reduceat(mixed, starts)
            for k in range(HASHES):
                minima[some, k] = np.minimum.reduceat((values ^ _XOR[k]) * _MULTIPLY[k], starts)
        signature = (minima >> np.uint64(40)).astype("<u2")
        empty = counts == 0
        content = "whole" if "whole" in part.schema.names else "text"
        yield pa.table(
            {
                "doc_id": part.column("doc_id"),
                content: part.column(content),
                "row": part.column("row"),
                "n_shingles": sizes,
                "print": pa.array([None if e else p.tobytes() for e, p in zip(empty, prints)], pa.binary()),
                "signature": pa.array([s.tobytes() for s in signature], pa.binary()),
            }
        )


def _bands(batch: pa.RecordBatch):
    """A row per band of each signature."""
    signature = _signatures(batch.column("signature"))
    keys = np.ascontiguousarray(signature[:, : BANDS * ROWS]).view("<u8")
    keys = mix64(keys ^ (np.arange(BANDS, dtype=np.uint64) << np.uint64(32)) * _MULTIPLY[0])
    yield pa.record_batch(
        {
            "band": np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows),
            "key": keys.ravel().view(np.int64),
            "node": np.repeat(batch.column("row").to_numpy(), BANDS),
            "n_shingles": np.repeat(batch.column("n_shingles").to_numpy(), BANDS),
        }
    )


def shingle_sets(docs: DataFrame, whole: bool = False) -> DataFrame:
    """One row per document with its set's size, print and minima.

    With ``whole`` all columns of ``docs`` stand in a struct, in place of the text.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
        *([F.struct(*docs.columns).alias("whole")] if whole else []),
    )
    schema = SETS
    if whole:
        kept = rows.schema["whole"].dataType.simpleString()
        schema = SETS.replace("text string", f"whole {kept}")
    return map_arrow(rows, _sets, schema)


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, HASHES)


def _test(miss: float):
    def work(batch: pa.RecordBatch):
        both = np.concatenate([_signatures(batch.column(f"signature_{side}")) for side in "ab"])
        x = np.arange(batch.num_rows)
        yield batch.select(["a", "b"]).take(pa.array(survivors(both, x, x + batch.num_rows, miss)[0]))

    return work


def _confirm(batch: pa.RecordBatch):
    known: dict[int, set] = {}
    keep = []
    columns = [batch.column(name) for name in ("a", "b", "text_a", "text_b")]
    for k in range(batch.num_rows):
        a, b, text_a, text_b = (column[k].as_py() for column in columns)
        if len(known) > 64:
            known.clear()
        for node, text in ((a, text_a), (b, text_b)):
            if node not in known:
                known[node] = shingle_set(text)
        both = len(known[a] & known[b])
        union = len(known[a]) + len(known[b]) - both
        if SHARE[1] * both >= SHARE[0] * union:
            keep.append(k)
    yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))


def _with(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    for side in "ab":
        pairs = pairs.join(
            sets.select(F.col("row").alias(side), F.col(column).alias(f"{column}_{side}")), side
        )
    return pairs


def verify(pairs: DataFrame, sets: DataFrame, miss: float = MISS) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    tested = map_arrow(_with(pairs, sets, "signature"), _test(miss), "a bigint, b bigint")
    return confirm(stash(tested, "candidates"), sets)


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets of shingles, made from the whole texts, are similar enough."""
    return map_arrow(_with(pairs, sets, "text"), _confirm, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, miss: float = MISS) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``: one row per row of ``docs``."""
    sets = stash(shingle_sets(docs), "sets")
    found = components_of(sets, miss)
    return (
        sets.select("doc_id", "n_shingles", "print")
        .join(found, "print", "left")
        .withColumn(
            "component_id", F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", "kept")
    )


def one_of_each(docs: DataFrame, miss: float = MISS) -> DataFrame:
    """The rows of ``docs``, with all columns, that stay: one of each component.

    It is the row of smallest id, and of rows with that id the first. Rows without words stay.
    """
    names = docs.columns
    with small_batches(docs.sparkSession):
        sets = stash(shingle_sets(docs, whole=True), "sets").withColumn("text", F.col("whole.text"))
    found = components_of(sets, miss)
    named = sets.join(found, "print", "left")
    first = (
        named.where("print is not null")
        .groupBy("component")
        .agg(F.min(F.when(F.col("doc_id").eqNullSafe(F.col("component_id")), F.col("row"))).alias("row"))
    )
    stay = first.select("row").unionByName(sets.where("print is null").select("row"))
    return sets.join(stay, "row", "left_semi").select("whole.*").select(*names)


def components_of(sets: DataFrame, miss: float = MISS) -> DataFrame:
    """``print``, ``component``, ``component_id`` of each distinct set."""
    classes = stash(
        sets.where("print is not null")
        .groupBy("print")
        .agg(F.min("row").alias("node"), F.min("doc_id").alias("least")),
        "classes",
    )
    firsts = sets.select("row", "n_shingles", "signature").join(
        classes.select(F.col("node").alias("row")), "row", "left_semi"
    )

    bands = map_arrow(firsts, _bands, "band int, key bigint, node bigint, n_shingles bigint")
    shared = bands.groupBy("key").agg(F.min("node").alias("lead"), F.count("*").alias("n"))
    members = stash(bands.join(shared.where("n > 1").drop("n"), "key"), "members")
    star = stash(
        members.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct(),
        "pairs",
    )
    release(star.sparkSession)
    links = verify(star, sets, miss)
    with small_batches(star.sparkSession):  # pairs hold both texts
        links = stash(links, "links")
    groups = stash(components(links), "groups")

    done = star
    for every in (False, True):
        release(star.sparkSession)
        pairs = stash(_across(members, groups, sets, miss, every).join(done, ["a", "b"], "left_anti"), "pairs")
        with small_batches(star.sparkSession):
            more = stash(confirm(pairs, sets), "links")
        if not more.isEmpty():
            groups = extend(groups, more)
        done = done.unionByName(pairs)

    release(star.sparkSession)
    named = classes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return named.join(least, "component").select("print", "component", "component_id")


def _across(members: DataFrame, groups: DataFrame, sets: DataFrame, miss: float, every: bool) -> DataFrame:
    """Pairs of one bucket and different components that pass the sequential test.

    For each component in a bucket that with most equal minima, which joins most of what
    belongs together; or ``every`` one whose sets of hashes confirm it, as far as it joins
    components in the bucket that earlier ones did not. A pair is made in the first bucket that it shares. A
    large bucket is cut in chunks by hash, so that a chunk has about ``CHUNK`` members and
    ``CHUNK_HASHES`` shingles, and chunks meet two by two, each in its own group.
    """
    named = members.join(groups, "node", "left").select(
        "key", "band", "node", "n_shingles", F.coalesce("component", "node").alias("part")
    )
    mixed = named.groupBy("key").agg(
        F.min("part").alias("low"),
        F.max("part").alias("high"),
        F.greatest(F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("n_shingles") / CHUNK_HASHES)).alias("chunks"),
    )
    rows = (
        named.join(mixed.where("low < high").select("key", "chunks"), "key")
        .withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
        .withColumn("first", F.least("chunk", "other"))
        .withColumn("second", F.greatest("chunk", "other"))
        .drop("chunks", "other")
    )
    signed = rows.join(sets.select(F.col("row").alias("node"), "signature"), "node")
    if not every:
        return _meeting(signed, miss, "best")
    # Sets of hashes only go where some pair passes the test.
    alive = stash(_meeting(signed, miss, "groups"), "groups")
    rows = rows.join(alive, ["key", "first", "second"], "left_semi")
    nodes = rows.select(F.col("node").alias("row")).distinct()
    whole = sets.select("row", "text", "signature").join(nodes, "row")
    schema = "node bigint, signature binary, hashes binary"
    return _meeting(rows.join(stash(map_arrow(whole, _hashes, schema), "hashes"), "node"), miss, "links")


def _meeting(rows: DataFrame, miss: float, mode: str) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "key bigint, first bigint, second bigint" if mode == "groups" else "a bigint, b bigint"
    return (
        rows.repartition(parts, "key", "first", "second")
        .sortWithinPartitions("key", "first", "second", "part", "node")
        .mapInArrow(_meet(miss, mode), schema)
    )


def _meet(miss: float, mode: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        held = None  # rows of the last group: more of them may follow
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                rows = pa.Table.from_batches([batch.slice(at, CHUNK)])
                if held is not None:
                    rows = pa.concat_tables([held, rows])
                edges = _group_edges(rows)
                for a, b in zip(edges[:-2].tolist(), edges[1:-1].tolist(), strict=True):
                    yield from cross_pairs(rows.slice(a, b - a), miss, mode)
                held = rows.slice(int(edges[-2]))
        if held is not None:
            yield from cross_pairs(held, miss, mode)

    return run


def _hashes(batch: pa.RecordBatch):
    flat, offsets = text_bytes(batch.column("text"))
    values, at = hash_shingles(*hash_words(flat, offsets))
    sets = [np.unique(values[a:b]).tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    yield pa.record_batch(
        {"node": batch.column("row"), "signature": batch.column("signature"), "hashes": pa.array(sets, pa.binary())}
    )


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets of hashes are similar enough."""
    x, y = (a, b) if len(a) <= len(b) else (b, a)
    place = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[place] == x).sum())
    return SHARE[1] * both >= SHARE[0] * (len(x) + len(y) - both)


class _Parts:
    """Components of a group's members; joined ones take the name of one of them."""

    def __init__(self, part: np.ndarray):
        self.now = part.copy()

    def join(self, i: int, j: int) -> None:
        self.now[self.now == self.now[j]] = self.now[i]


def _group_edges(rows: pa.Table) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for name in ("key", "first", "second"):
        values = rows[name].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), rows.num_rows)


def cross_pairs(rows: pa.Table, miss: float, mode: str) -> Iterator[pa.RecordBatch]:
    """Pairs of different components in one group that pass the test, or the group if there are.

    Members are compared in blocks. Of a block's pairs only those are kept that the mode needs, and
    pairs of components that earlier ones have joined are not made: at most one pair per
    member of the group is held.
    """
    node, part, size, chunk = (rows[c].to_numpy() for c in ("node", "part", "n_shingles", "chunk"))
    signatures = _signatures(rows["signature"])
    hashes = rows["hashes"].combine_chunks() if mode == "links" else None
    band = rows["band"][0].as_py()
    apart = rows["first"][0].as_py() != rows["second"][0].as_py()
    parts = _Parts(part)
    found = np.zeros((0, 3), np.int64)

    def hash_set(k: int) -> np.ndarray:
        return np.frombuffer(hashes[k].as_buffer(), np.uint64)

    for at in range(0, len(node), 64):
        x = np.arange(at, min(at + 64, len(node)))[:, None]
        y = np.arange(at, len(node))[None, :]
        fit = (parts.now[x] != parts.now[y]) & (x < y)
        fit &= (SHARE[1] * size[x] >= SHARE[0] * size[y]) & (SHARE[1] * size[y] >= SHARE[0] * size[x])
        if apart:
            fit &= chunk[x] != chunk[y]
        i, j = np.nonzero(fit)
        i, j = i + at, j + at
        for earlier in range(band):
            if not len(i):
                break
            same = signatures[:, earlier * ROWS : (earlier + 1) * ROWS]
            there = (same[i] == same[j]).all(axis=1)
            i, j = i[~there], j[~there]
        alive, matches = survivors(signatures, i, j, miss)
        if not len(alive):
            continue
        if mode == "groups":
            yield from rows.select(["key", "first", "second"]).slice(0, 1).to_batches()
            return
        new = np.column_stack([i[alive], j[alive], matches])
        new = new[np.argsort(-new[:, 2], kind="stable")]
        if mode == "links":  # the likeliest first: they join most
            kept = []
            for a, b, _ in new.tolist():
                if parts.now[a] != parts.now[b] and _similar(hash_set(a), hash_set(b)):
                    parts.join(a, b)
                    kept.append((a, b, 0))
            found = np.concatenate([found, np.array(kept, np.int64).reshape(-1, 3)])
        else:  # for each component the pair with most equal minima
            found = np.concatenate([found, new])
            found = found[np.argsort(-found[:, 2], kind="stable")]
            _, of_x = np.unique(part[found[:, 0]], return_index=True)
            _, of_y = np.unique(part[found[:, 1]], return_index=True)
            found = found[np.union1d(of_x, of_y)]
    if len(found):
        a, b = node[found[:, 0]], node[found[:, 1]]
        yield pa.record_batch({"a": np.minimum(a, b), "b": np.maximum(a, b)})
