"""Prefix trie of rebuilt conversations, by composable fingerprints of turn sequences.

A rebuilt conversation is the head of its base conversation and its own turns from some place on. It is
never made: sequences are known by fingerprints that form a monoid. A sequence x0, x1, ... of
turn hashes has the sum of x_t * B^t (two odd bases, arithmetic modulo 2^64) and its length; "first A,
then B'" has the sum A + B^len(A) * B'. So the fingerprint of each prefix of a rebuilt
conversation follows from prefix sums of the stored conversations alone: that of the base's head, plus
the difference of two own prefix sums moved by the difference of lengths.

1. Turns are sorted by (conv_id, turn, role, hash of the text) in ranges, so a conversation of any length is dealt
   over many tasks; each task makes its own prefix sums. Conversations that cross from one task to the next, at
   most one per task, get the sums of the tasks before added; these few rows come to the driver.
2. Every rebuilt prefix is a row (conversation, depth, fingerprint, parent's fingerprint, turn reference).
   Rows group to nodes; the group's least conversation names the node.
3. Equality is verified: all members of a node must have the same parent node and the same turn, and turns that
   share a hash must be the same stored role and text. If a check fails, the whole trie is made anew with other hashes.
4. Nothing walks the tree. The conversation that names a node also names its own deeper nodes, so a
   conversation x names those from some depth r(x) on, and over the members x of a node of depth d
   children are counted where r(x) <= d + 1 <= length, leaves where x names a leaf, and the saved tokens are the
   characters of x's turns d .. r(x) - 1.

Turns are ordered by turn, null first; of one turn by role, then the hash of the text (rows equal in all of these are
alike); repeated rows are turns of their own. Null roles and texts are empty. Rows without a ``conv_id`` belong to no
conversation and are left out. An empty table has no node. Bases are ``c - c % 100`` with Spark's remainder.
Columns other than the four are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpulse.llm.common import lookup, map_arrow, stash

BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))  # odd, so powers have inverses
HEAD = 5  # turns of the longest head
GROUP = 100  # conversations that share a base
MARK = b","

PREFIXES = (
    "part int, conv_id bigint, place bigint, x1 bigint, x2 bigint, "
    "s1 bigint, s2 bigint, chars bigint, before bigint"
)
MEMBERS = (
    "conv_id bigint, depth bigint, f1 bigint, f2 bigint, p1 bigint, p2 bigint, x1 bigint, x2 bigint, "
    "before bigint, chars bigint, more boolean"
)


def head_length(conv_id: Column) -> Column:
    """How many turns of its base a conversation starts with."""
    return F.crc32(conv_id.cast("string").cast("binary")) % (HEAD + 1)


def _power(base: np.uint64, exponents: np.ndarray) -> np.ndarray:
    """Powers modulo 2^64 by squaring."""
    out, square, left = np.ones(len(exponents), np.uint64), np.uint64(base), exponents.copy()
    with np.errstate(over="ignore"):
        while left.any():
            out = np.where(left & 1, out * square, out)
            left >>= 1
            square = square * square
    return out


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def _turns(conversations: DataFrame, seed: int) -> DataFrame:
    """Turns with two hashes of role and text; the texts stay where they are stored."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        F.xxhash64(F.lit(seed), role, text).alias("x1"),
        F.xxhash64(F.lit(seed + 1), text, role).alias("x2"),
        F.xxhash64(text).alias("tie"),
        F.length(text).cast("bigint").alias("chars"),
    )


def _prefix_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted turns: place in the conversation and sums of all turns before it, within this task."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    conv, place, sums, chars_before = None, 0, [np.uint64(0)] * 2, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ids = batch.column("conv_id").to_numpy()
        begins = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        sizes = np.diff(np.append(begins, n))
        places = np.arange(n) - np.repeat(begins, sizes)
        first = int(sizes[0]) if ids[0] == conv else 0  # turns that continue the last batch's conversation
        places[:first] += place
        columns = {}
        for k, base in enumerate(BASES):
            x = batch.column(f"x{k + 1}").to_numpy().view(np.uint64)
            with np.errstate(over="ignore"):
                total = np.cumsum(x * _power(base, places), dtype=np.uint64)
                earlier = np.append(np.uint64(0), total[:-1])
                own = earlier - np.repeat(earlier[begins], sizes)
                own[:first] += sums[k]
                sums[k] = own[-1] + x[-1] * _power(base, places[-1:])[0]
            columns[f"s{k + 1}"] = own.view(np.int64)
        chars = batch.column("chars").to_numpy()
        earlier = np.cumsum(chars) - chars
        before = earlier - np.repeat(earlier[begins], sizes)
        before[:first] += chars_before
        conv, place, chars_before = ids[-1], int(places[-1]) + 1, int(before[-1] + chars[-1])
        yield pa.record_batch(
            {
                "part": pa.array(np.full(n, part, np.int32)),
                "conv_id": batch.column("conv_id"),
                "place": places,
                "x1": batch.column("x1"),
                "x2": batch.column("x2"),
                "s1": columns["s1"],
                "s2": columns["s2"],
                "chars": chars,
                "before": before,
            }
        )


def _carried(held: DataFrame) -> DataFrame:
    """For each task that goes on with a conversation: the turns, sums and characters before it."""
    spans = held.groupBy("conv_id").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    last = F.max(F.struct("place", "s1", "s2", "x1", "x2", "before", "chars")).alias("last")
    rows = (
        held.join(F.broadcast(spans.select("conv_id")), "conv_id", "left_semi")  # at most a row per task
        .groupBy("conv_id", "part")
        .agg(last)
        .orderBy("conv_id", "part")
        .collect()
    )
    out, conv = [], None
    for r in rows:
        if r["conv_id"] != conv:
            conv, turns, sums, chars = r["conv_id"], 0, [0, 0], 0
        out.append((conv, r["part"], turns, *(_signed(s) for s in sums), chars))
        last = r["last"]
        for k, base in enumerate(map(int, BASES)):
            own = last[f"s{k + 1}"] + last[f"x{k + 1}"] * pow(base, last["place"], 1 << 64)
            sums[k] = (sums[k] + pow(base, turns, 1 << 64) * own) % (1 << 64)
        turns, chars = turns + last["place"] + 1, chars + last["before"] + last["chars"]
    schema = "conv_id bigint, part int, turns bigint, c1 bigint, c2 bigint, c_chars bigint"
    return held.sparkSession.createDataFrame(out, schema)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _shifted(batch: pa.RecordBatch):
    """Places and sums in the whole conversation: what earlier tasks hold, then the own sums, moved."""
    turns = batch.column("turns").fill_null(0).to_numpy()
    sums = {}
    for k, base in enumerate(BASES):
        own = batch.column(f"s{k + 1}").to_numpy().view(np.uint64)
        before = batch.column(f"c{k + 1}").fill_null(0).to_numpy().view(np.uint64)
        with np.errstate(over="ignore"):
            sums[f"s{k + 1}"] = (before + _power(base, turns) * own).view(np.int64)
    yield pa.record_batch(
        {
            "conv_id": batch.column("conv_id"),
            "place": batch.column("place").to_numpy() + turns,
            "x1": batch.column("x1"),
            "x2": batch.column("x2"),
            **sums,
            "chars": batch.column("chars"),
            "before": batch.column("before").to_numpy() + batch.column("c_chars").fill_null(0).to_numpy(),
        }
    )


def stored_prefixes(conversations: DataFrame, seed: int) -> DataFrame:
    """A row per stored turn: place, hashes, and the sums of the turns before it."""
    keys = ["conv_id", "turn", "role", "tie"]
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = stash(
        _turns(conversations, seed)
        .repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(_prefix_sums, PREFIXES),
        "turns",
    )
    joined = held.join(F.broadcast(_carried(held)), ["conv_id", "part"], "left")  # at most a row per task
    return stash(map_arrow(joined, _shifted, PREFIXES.removeprefix("part int, ")), "prefixes")


def _plans(prefixes: DataFrame) -> DataFrame:
    """A row per conversation: how it is rebuilt, and the head of its base as stored sums."""
    start = F.struct("place", "s1", "s2", "before", "x1", "x2", "chars")
    stored = prefixes.groupBy("conv_id").agg(
        F.count("*").alias("turns"),
        # Sums before each of the first HEAD + 1 turns: at most that many per conversation.
        F.sort_array(F.collect_list(F.when(F.col("place") <= HEAD, start))).alias("starts"),
    )
    plans = stored.withColumn("h", head_length(F.col("conv_id"))).withColumn(
        "base_id", F.col("conv_id") - F.col("conv_id") % GROUP
    )
    bases = stored.select(
        F.col("conv_id").alias("base_id"),
        F.col("turns").alias("base_turns"),
        F.col("starts").alias("head"),
    ).where(F.col("base_id") % GROUP == 0)
    return (
        plans.join(bases, "base_id", "left")
        .withColumn("taken", F.least("h", F.coalesce("base_turns", F.lit(0))))
        .withColumn("kept", F.greatest(F.col("turns") - F.col("h"), F.lit(0)))
        .select(
            "conv_id",
            "turns",
            "h",
            "taken",
            "kept",
            (F.col("taken") + F.col("kept")).alias("length"),
            F.slice(F.coalesce("head", F.array().cast(stored.schema["starts"].dataType)), 1, HEAD + 1).alias("head"),
            # Own sums before the first kept turn.
            F.get("starts", F.col("h").cast("int")).alias("own"),
        )
    )


def _members(batch: pa.RecordBatch):
    """Fingerprints of rebuilt prefixes, from own sums and those of the head alone."""

    def numbers(name: str) -> np.ndarray:
        return batch.column(name).fill_null(0).to_numpy()

    shift = numbers("h") - numbers("taken")  # turns by which the own ones move to the front
    place = numbers("place")
    out = {}
    for k, base in enumerate(BASES, 1):
        own, x, head, start = (numbers(f"{c}{k}").view(np.uint64) for c in ("s", "x", "head_s", "own_s"))
        with np.errstate(over="ignore"):
            move = _power(_inverse(base), shift)
            parent = head + move * (own - start)
            out[f"p{k}"] = parent.view(np.int64)
            out[f"f{k}"] = (parent + move * _power(base, place) * x).view(np.int64)
    depth = place - shift + 1
    yield pa.record_batch(
        {
            "conv_id": batch.column("conv_id"),
            "depth": depth,
            "f1": out["f1"],
            "f2": out["f2"],
            "p1": out["p1"],
            "p2": out["p2"],
            "x1": batch.column("x1"),
            "x2": batch.column("x2"),
            "before": numbers("head_chars") + numbers("before") - numbers("own_chars"),
            "chars": batch.column("chars"),
            "more": depth < numbers("length"),
        }
    )


def _head_members(batch: pa.RecordBatch):
    """Fingerprints of a base's head: its stored prefix sums as they are."""
    out = {}
    place = batch.column("place").to_numpy()
    for k, base in enumerate(BASES, 1):
        own, x = (batch.column(f"{c}{k}").to_numpy().view(np.uint64) for c in ("s", "x"))
        with np.errstate(over="ignore"):
            out[f"f{k}"] = (own + _power(base, place) * x).view(np.int64)
    yield pa.record_batch(
        {
            "conv_id": batch.column("conv_id"),
            "depth": place + 1,
            **out,
            "p1": batch.column("s1"),
            "p2": batch.column("s2"),
            "x1": batch.column("x1"),
            "x2": batch.column("x2"),
            "before": batch.column("before"),
            "chars": batch.column("chars"),
            "more": place + 1 < batch.column("length").to_numpy(),
        }
    )


def rebuilt_prefixes(prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A row per prefix of each rebuilt conversation, the empty one included, and one per conversation."""
    plans = stash(_plans(prefixes), "rebuilt")
    heads = plans.select("conv_id", "length", F.explode(F.expr("slice(head, 1, cast(taken as int))")).alias("turn")).select(
        "conv_id", "length", "turn.*"
    )
    heads = stash(map_arrow(heads, _head_members, MEMBERS), "heads")
    # Fingerprint and characters of each whole head.
    closes = heads.join(plans.select("conv_id", F.col("taken").alias("depth")), ["conv_id", "depth"]).select(
        "conv_id",
        F.col("f1").alias("head_s1"),
        F.col("f2").alias("head_s2"),
        (F.col("before") + F.col("chars")).alias("head_chars"),
    )
    info = stash(
        plans.where("turns > h")
        .join(closes, "conv_id", "left")
        .select(
            "conv_id",
            "turns",
            "h",
            "taken",
            "length",
            "head_s1",
            "head_s2",
            "head_chars",
            F.col("own.s1").alias("own_s1"),
            F.col("own.s2").alias("own_s2"),
            F.col("own.before").alias("own_chars"),
        ),
        "plans",
    )
    own = lookup(prefixes, info, ["conv_id"], "turns", "inner").where("place >= h")
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    roots = plans.select(
        "conv_id",
        *(zero.alias(c) for c in ("depth", "f1", "f2")),
        *(none.alias(c) for c in ("p1", "p2", "x1", "x2")),
        *(zero.alias(c) for c in ("before", "chars")),
        (F.col("length") > 0).alias("more"),
    )
    rows = map_arrow(own, _members, MEMBERS).unionByName(heads).unionByName(roots)
    return stash(rows, "members"), plans


NODE = ["depth", "f1", "f2"]


def _nodes(members: DataFrame) -> tuple[DataFrame, bool]:
    """Nodes, and whether all members of each have the same parent and the same turn."""
    same = ("p1", "p2", "x1", "x2")
    grouped = stash(
        members.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.max("more").alias("inner"),
            F.min("before").alias("before"),
            *(F.min(c).alias(c) for c in same),
            *(F.max(c).alias(f"most_{c}") for c in same),
        ),
        "nodes",
    )
    differs = " or ".join(f"{c} <> most_{c}" for c in same)
    return grouped.drop(*(f"most_{c}" for c in same)), grouped.where(differs).isEmpty()


def _same_turns(conversations: DataFrame, seed: int) -> bool:
    """Whether turns that share a hash are the same role and text, compared as stored."""
    turns = _turns(conversations, seed)
    shared = stash(turns.groupBy("x1", "x2").count().where("count > 1"), "shared-turns")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    stored = conversations.where("conv_id is not null").select(
        F.xxhash64(F.lit(seed), role, text).alias("x1"),
        F.xxhash64(F.lit(seed + 1), text, role).alias("x2"),
        role.alias("role"),
        text.alias("text"),
    )
    distinct = lookup(stored, shared, ["x1", "x2"], "count", "inner").distinct()
    return distinct.groupBy("x1", "x2").count().where("count > 1").isEmpty()


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conversation) rows to pieces of decimal ids, one per node and batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id").to_pylist()
        keys = np.stack([batch.column(c).to_numpy() for c in NODE])
        begins = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))).tolist()
        spans = list(zip(begins, begins[1:] + [len(ids)], strict=True))
        yield pa.record_batch(
            {
                **{c: keys[k][begins] for k, c in enumerate(NODE)},
                "first": pa.array([ids[a] for a, _ in spans], pa.int64()),
                "listed": pa.array([MARK.join(b"%d" % i for i in ids[a:b]) for a, b in spans], pa.binary()),
            }
        )


def _list_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the pieces of each node in order; only the hash state is held."""
    now, state = None, None

    def done() -> pa.RecordBatch:
        return pa.record_batch(
            {**{c: [v] for c, v in zip(NODE, now, strict=True)}, "ends_sha256": [state.hexdigest()]}
        )

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in (*NODE, "listed"))
        for *key, listed in zip(*columns, strict=True):
            if key != now:
                if now is not None:
                    yield done()
                now, state = key, hashlib.sha256()
            else:
                state.update(MARK)
            state.update(listed)
    if now is not None:
        yield done()


def _ends(members: DataFrame) -> DataFrame:
    """Per node the hash of the ids of the conversations that end there."""
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = "depth bigint, f1 bigint, f2 bigint"
    pieces = (
        members.where("not more")
        .select(*NODE, "conv_id")
        .repartitionByRange(parts, *NODE, "conv_id")
        .sortWithinPartitions(*NODE, "conv_id")
        .mapInArrow(_lists, f"{key}, first bigint, listed binary")
    )
    return (
        pieces.repartition(*NODE)
        .sortWithinPartitions(*NODE, "first")
        .mapInArrow(_list_hashes, f"{key}, ends_sha256 string")
    )


def _assembled(members: DataFrame, nodes: DataFrame, plans: DataFrame) -> DataFrame:
    """Node rows: sums over the members of each node, the parent's name, the ends' hash."""
    total = members.where("not more").select("conv_id", (F.col("before") + F.col("chars")).alias("all_chars"))
    owned = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("names_from"),
        F.min("before").alias("names_chars"),
        F.max((~F.col("inner")).cast("bigint")).alias("leaf"),
    )
    named = stash(
        plans.select("conv_id", "length")
        .join(total, "conv_id")
        .join(owned, "conv_id", "left")
        .select(
            "conv_id",
            F.coalesce("names_from", F.col("length") + 1).alias("names_from"),
            F.coalesce("names_chars", "all_chars").alias("names_chars"),
            F.coalesce("leaf", F.lit(0)).alias("leaf"),
            F.col("length").alias("weight"),
        ),
        "named",
    )
    sums = stash(
        lookup(members.select("conv_id", *NODE, "before", "more"), named, ["conv_id"], "weight", "inner")
        .groupBy(*NODE)
        .agg(
            F.count(F.when(F.col("more") & (F.col("names_from") <= F.col("depth") + 1), 1)).alias("n_children"),
            F.sum("leaf").cast("bigint").alias("n_leaves"),
            F.sum(F.greatest(F.col("names_chars") - F.col("before"), F.lit(0))).cast("bigint").alias("saved_tokens"),
        ),
        "sums",
    )
    full = stash(nodes.join(sums, NODE), "full")
    parents = full.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"),
        F.col("f1").alias("p1"),
        F.col("f2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
        F.col("n_children").alias("weight"),
    )
    below = lookup(full.where("depth > 0"), parents, ["depth", "p1", "p2"], "weight", "inner")
    roots = full.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    nothing = hashlib.sha256().hexdigest()
    return (
        below.unionByName(roots)
        .join(_ends(members), NODE, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """A row per node: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``."""
    for seed in range(0, 20, 2):
        prefixes = stored_prefixes(conversations, seed)
        members, plans = rebuilt_prefixes(prefixes)
        nodes, equal = _nodes(members)
        if equal and _same_turns(conversations, seed):
            break
    else:
        raise RuntimeError("unlike turns kept sharing hashes")
    return _assembled(members, nodes, plans)
