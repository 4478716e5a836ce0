"""Repeated byte strings: range-partitioned suffixes, sorted by multikey quicksort.

A text's bytes are removed where a string of ``length`` bytes covers them that also starts
earlier: in a smaller doc_id, or in the same document further left. Strings are judged on the
input, so overlaps count, and matches never cross documents.

A suffix per byte would be hundreds of times the input. Of the strings of ``length`` bytes that
start in a text, neighbours that share the same anchor (the k-gram of smallest hash in them)
form a run; equal strings have equal anchors at equal places, so only runs with equal leading
tokens (the anchor's) can hold equal strings.

1. Each run becomes a row: leading token, content hash, place. A sample's quantiles of the
   leading tokens are the splitters that send runs to buckets; a bucket is sorted. A token that
   fills several buckets is dealt over them by content. Of equal runs the first keeps its bytes,
   whatever the number of the others.
2. Runs with the same leading token but different contents are read again. All the strings in
   them are suffixes that are sorted locally by multikey quicksort on tokens of eight bytes; the
   first of equal ones is kept. Neighbours in a bucket are compared across batches.
   A token with more than ``TOKEN_RUNS`` such runs is no group for one task: its strings are
   dealt by a 128-bit hash of all their bytes, of which the first of each is kept before and
   after the shuffle.
3. Strings that were first anywhere are gathered per document; all others are removed.

Rows with equal id and text count as one document and get one result. Rows with equal id and
different text are ordered by the hash of the text. A null text is empty; a null id comes last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.llm.common import map_arrow, mix64, pieces, release, stash, text_bytes, whole_text

GRAM = 20  # bytes of an anchor
SAMPLE_ROWS = 2_000  # documents whose anchors give the splitters
BUCKETS_PER_PARTITION = 8
CHUNK = 1 << 20  # starts handled at once
TOKEN_RUNS = 1_000  # unlike runs of one leading token that are compared in one piece
PIECE = 1 << 16  # rows sent on at once
TOKEN_BITS = 52  # leading bits of a token that a double holds, as quantiles are doubles
LAST_ID = 2**63 - 1

RUNS = "bucket int, token bigint, content bigint, id bigint, tie bigint, place bigint"
STRINGS = "token bigint, more bigint, id bigint, tie bigint, place bigint, bytes binary"
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def gram_hashes(flat: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all ``size``-byte strings, by doubling."""
    with np.errstate(over="ignore"):
        step = flat.astype(np.uint64) + np.uint64(1)
        scale = np.uint64(0x9E3779B97F4A7C15)
        width, done, out = 1, 0, None
        while size:
            if size & 1:
                if out is None:
                    out = step
                else:
                    n = min(len(out), len(step) - done)
                    out = out[: max(n, 0)] * scale + step[done : done + max(n, 0)]
                done += width
            size >>= 1
            if size:
                step = step[:-width] * scale + step[width:] if len(step) > width else step[:0]
                width, scale = 2 * width, scale * scale
        return mix64(out)


def runs_of(flat: np.ndarray, ends: np.ndarray, length: int, base: int):
    """First start, last start, anchor of all runs, and the anchors' hashes.

    ``ends`` has for each byte where its text ends; ``base`` starts are handled.
    """
    grams = gram_hashes(flat, GRAM)
    window = length - GRAM + 1
    low = np.uint64((1 << 24) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= window and len(least) > width:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = window - width
    if rest and len(least) > rest:
        least = np.minimum(least[:-rest], least[rest:])
    starts = np.arange(min(base, max(len(flat) - length + 1, 0)))
    starts = starts[starts + length <= ends[: len(starts)]]
    anchors = (least[starts] & low).astype(np.int64)
    if not len(starts):
        return starts, starts, anchors, grams[:0]
    new = np.ones(len(starts), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return starts[first], starts[last], anchors[first], grams[anchors[first]]


def buckets_of(tokens: np.ndarray, contents: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """A token between splitters has a bucket; one that is several splitters has as many."""
    lead = tokens >> (64 - TOKEN_BITS)
    bucket = np.searchsorted(splitters, lead)
    several = np.searchsorted(splitters, lead, side="right") - bucket
    return (bucket + contents % np.maximum(several, 1)).astype(np.int32)


def _runs(length: int, splitters: np.ndarray):
    def work(batch: pa.RecordBatch):
        texts = batch.column("text")
        for first, last in pieces(texts, CHUNK):
            flat, offsets = text_bytes(texts.slice(first, last - first))
            sizes = np.diff(offsets)
            ends = np.repeat(offsets[1:], sizes)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            ids = batch.column("id").slice(first, last - first).to_numpy()
            ties = batch.column("tie").slice(first, last - first).to_numpy()
            for at in range(0, len(flat), CHUNK):
                part = flat[at : at + CHUNK + length - 1]
                a, b, q, token = runs_of(part, ends[at : at + len(part)] - at, length, CHUNK)
                if not len(a):
                    continue
                data = memoryview(part)
                content = np.fromiter(
                    (
                        xxhash.xxh3_64_intdigest(data[x:y])
                        for x, y in zip(a.tolist(), (b + length).tolist(), strict=True)
                    ),
                    np.uint64,
                    len(a),
                )
                content = mix64(content ^ (q - a).astype(np.uint64)).view(np.int64)
                token = token.view(np.int64)
                doc = owner[a + at]
                start = a + at - offsets[doc]
                place = (start << 14) | ((q - a) << 7) | (b - a)
                order = np.lexsort((place, ties[doc], ids[doc], content, token))
                same = np.zeros(len(a), bool)
                same[1:] = (token[order][1:] == token[order][:-1]) & (
                    content[order][1:] == content[order][:-1]
                )
                pick = order[~same]  # pre-aggregated: of equal runs the first
                yield pa.record_batch(
                    {
                        "bucket": buckets_of(token[pick], content[pick], splitters),
                        "token": token[pick],
                        "content": content[pick],
                        "id": ids[doc[pick]],
                        "tie": ties[doc[pick]],
                        "place": place[pick],
                    }
                )

    return work


def _sample_tokens(length: int):
    def work(batch: pa.RecordBatch):
        for out in _runs(length, np.zeros(0, np.int64))(batch):
            yield out.select(["token"])

    return work


def splitters(docs: DataFrame, length: int, buckets: int) -> np.ndarray:
    """Quantiles of the leading tokens in a bounded sample; they only balance the buckets.

    A token that fills several buckets is there several times.
    """
    total = docs.count()
    if not total:
        return np.zeros(0, np.int64)
    sample = docs.sample(min(1.0, SAMPLE_ROWS / total), seed=7)
    tokens = map_arrow(sample, _sample_tokens(length), "token bigint").select(
        F.shiftright("token", 64 - TOKEN_BITS).alias("lead")
    )
    cuts = tokens.approxQuantile("lead", [k / buckets for k in range(1, buckets)], 0.5 / buckets)
    return np.sort(np.array(cuts, np.float64).astype(np.int64))


def _firsts(splitters: np.ndarray):
    """Of sorted runs the first of each content, and whether its token has other contents.

    The last first is held back until the next batch shows what follows it. Other contents of a
    token that has several buckets may be in another task, so it always counts as shared.
    """
    dealt = splitters[1:][splitters[1:] == splitters[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows]).combine_chunks()
            token, content = rows["token"].to_numpy(), rows["content"].to_numpy()
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (content[1:] != content[:-1])
            at = np.flatnonzero(new)
            shared = np.isin(token[at] >> (64 - TOKEN_BITS), dealt)
            equal = token[at][1:] == token[at][:-1]
            shared[1:] |= equal
            shared[:-1] |= equal
            if held is not None and held_shared:
                shared[0] = True
            yield from _marked(rows.take(pa.array(at[:-1])), shared[:-1]).to_batches()
            held, held_shared = rows.slice(int(at[-1]), 1), bool(shared[-1])
        if held is not None:
            yield from _marked(held, np.array([held_shared])).to_batches()

    return run


def _marked(rows: pa.Table, shared: np.ndarray) -> pa.Table:
    """Only shared tokens are needed again; the others would not compress."""
    token = pa.array(rows["token"].to_numpy(), mask=~shared)
    out = rows.select(["id", "tie", "place"]).add_column(0, "token", token)
    return out.append_column("shared", pa.array(shared))


def multikey_order(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort rows of tokens column by column, refining only runs that are equal so far.

    Returns the order, and for each place in it the number of its run of equal rows.
    """
    n = len(tokens)
    order = np.arange(n)
    run = np.zeros(n, np.int64)
    open_ = np.arange(n)  # places whose run has more than one row
    for column in tokens.T:
        if not len(open_):
            break
        rows = order[open_]
        by = np.lexsort((column[rows], run[open_]))
        order[open_] = rows[by]
        value = column[order[open_]]
        groups = run[open_]
        new = np.ones(len(open_), bool)
        new[1:] = (value[1:] != value[:-1]) | (groups[1:] != groups[:-1])
        run[open_] = open_[new][np.cumsum(new) - 1]  # a run is named by its first place
        sizes = np.bincount(np.cumsum(new) - 1)
        open_ = open_[np.repeat(sizes > 1, sizes)]
    return order, run


def first_strings(rows: pa.Table, length: int) -> pa.Table:
    """Which strings in the runs are the first of their content, as ranges of starts."""
    flat, offsets = _flat(rows["bytes"])
    place = rows["place"].to_numpy()
    start, lead, extra = place >> 14, (place >> 7) & 127, place & 127
    token, ids, ties = (rows[c].to_numpy() for c in ("token", "id", "tie"))
    out = []
    windows = np.zeros(len(place) + 1, np.int64)
    np.cumsum(extra + 1, out=windows[1:])
    # Whole tokens at a time: strings are only equal under one token.
    edges = np.append(np.flatnonzero(np.append(True, token[1:] != token[:-1])), len(token))
    k = 0
    while k < len(edges) - 1:
        m = int(np.searchsorted(windows[edges], windows[edges[k]] + 100_000, side="right")) - 1
        m = min(max(m, k + 1), len(edges) - 1)
        a, b = int(edges[k]), int(edges[m])
        k = m
        block = np.repeat(np.arange(a, b), (extra + 1)[a:b])
        shift = np.arange(len(block)) - (windows[block] - windows[a])
        text = flat[(offsets[block] + shift)[:, None] + np.arange(length)]
        wide = np.zeros((len(block), -(-length // 8) * 8 + 16), np.uint8)
        wide[:, 16 : 16 + length] = text
        keys = wide.view(">u8").astype(np.uint64)
        keys[:, 0] = token[block].view(np.uint64)
        keys[:, 1] = (lead[block] - shift).astype(np.uint64)
        order, run = multikey_order(keys)
        rank = np.lexsort((start[block] + shift, ties[block], ids[block]))
        place_of = np.empty(len(block), np.int64)
        place_of[rank] = np.arange(len(block))
        best = np.full(len(block), len(block), np.int64)
        np.minimum.at(best, run, place_of[order])
        first = np.zeros(len(block), bool)
        first[order] = place_of[order] == best[run]
        yes = np.flatnonzero(first)
        if not len(yes):
            continue
        cut = np.ones(len(yes), bool)
        cut[1:] = (block[yes][1:] != block[yes][:-1]) | (yes[1:] != yes[:-1] + 1)
        begin = yes[np.flatnonzero(cut)]
        end = yes[np.append(np.flatnonzero(cut)[1:], len(yes)) - 1]
        who = block[begin]
        out.append(
            pa.table(
                {
                    "id": ids[who],
                    "tie": ties[who],
                    "place": ((start[who] + shift[begin]) << 14) | (end - begin),
                }
            )
        )
    empty = {"id": pa.array([], pa.int64()), "tie": pa.array([], pa.int64()), "place": pa.array([], pa.int64())}
    return pa.concat_tables(out) if out else pa.table(empty)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    values = column.to_pylist()
    offsets = np.zeros(len(values) + 1, np.int64)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    return np.frombuffer(b"".join(values), np.uint8), offsets


def _compare(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last token: more of them may follow
        last = None  # hash of the last string
        for batch in batches:
            n_runs = batch.column("more").null_count
            if n_runs:
                rows = pa.Table.from_batches([batch.slice(0, n_runs)])
                if held is not None:
                    rows = pa.concat_tables([held, rows])
                token = rows["token"].to_numpy()
                edge = int(np.searchsorted(token, token[-1]))
                if edge:
                    yield from first_strings(rows.slice(0, edge), length).to_batches()
                held = rows.slice(edge)
            if n_runs < batch.num_rows:
                strings = batch.slice(n_runs)
                key = np.column_stack([strings.column(c).to_numpy() for c in ("token", "more")])
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]).any(axis=1)
                new[0] = last is None or (key[0] != last).any()
                last = key[-1]
                yield strings.filter(pa.array(new)).select(["id", "tie", "place"])
        if held is not None:
            yield from first_strings(held, length).to_batches()

    return run


def _run_rows(rows: list[tuple]) -> pa.RecordBatch:
    token, ids, ties, place, data = zip(*rows, strict=True)
    columns = [token, [None] * len(rows), ids, ties, place]
    arrays = [pa.array(c, pa.int64()) for c in columns] + [pa.array(data, pa.binary())]
    return pa.record_batch(arrays, ["token", "more", "id", "tie", "place", "bytes"])


def _string_rows(firsts: dict[bytes, tuple[int, int, int]]) -> pa.RecordBatch:
    token, more = np.frombuffer(b"".join(firsts), ">i8").astype(np.int64).reshape(-1, 2).T
    ids, ties, place = zip(*firsts.values(), strict=True)
    arrays = [pa.array(c, pa.int64()) for c in (token.copy(), more.copy(), ids, ties, place)]
    arrays.append(pa.nulls(len(firsts), pa.binary()))
    return pa.record_batch(arrays, ["token", "more", "id", "tie", "place", "bytes"])


def _contents(length: int):
    def work(batch: pa.RecordBatch):
        rows, firsts = [], {}
        for k in range(batch.num_rows):
            text = (batch.column("text")[k].as_py() or "").encode("utf-8", "surrogatepass")
            id_, tie = batch.column("id")[k].as_py(), batch.column("tie")[k].as_py()
            for run in batch.column("runs")[k].as_py():
                start, extra = run["place"] >> 14, run["place"] & 127
                if not run["busy"]:
                    rows.append((run["token"], id_, tie, run["place"], text[start : start + extra + length]))
                    if len(rows) >= PIECE:
                        yield _run_rows(rows)
                        rows = []
                    continue
                for at in range(start, start + extra + 1):
                    key = xxhash.xxh3_128_digest(text[at : at + length])
                    found = (id_, tie, at << 14)
                    if firsts.setdefault(key, found) > found:
                        firsts[key] = found
                if len(firsts) >= PIECE:
                    yield _string_rows(firsts)
                    firsts = {}
        if rows:
            yield _run_rows(rows)
        if firsts:
            yield _string_rows(firsts)

    return work


def unlike_strings(shared: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """Bytes of the runs of shared tokens; of tokens with too many runs, hashes of the strings.

    A string has its hash in ``token`` and ``more``; a run has its token and no ``more``.
    """
    busy = stash(
        shared.groupBy("token").count().where(F.col("count") > TOKEN_RUNS).select("token", F.lit(True).alias("busy")),
        "busy",
    )
    run = F.struct("token", "place", F.coalesce("busy", F.lit(False)).alias("busy"))
    wanted = shared.join(busy, "token", "left").groupBy("id", "tie").agg(F.collect_list(run).alias("runs"))
    return map_arrow(wanted.join(texts.select("id", "tie", "text"), ["id", "tie"]), _contents(length), STRINGS)


def removed_bytes(n: int, places: np.ndarray, length: int) -> np.ndarray:
    """Which of ``n`` bytes go, given the ranges of starts whose strings stay."""
    if n < length:
        return np.zeros(n, bool)
    marks = np.zeros(n - length + 2, np.int64)
    np.add.at(marks, places >> 14, 1)
    np.add.at(marks, (places >> 14) + (places & 127) + 1, -1)
    gone = np.flatnonzero(np.cumsum(marks[:-1]) == 0)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, gone, 1)
    np.add.at(cover, gone + length, -1)
    return np.cumsum(cover[:-1]) > 0


def _result(length: int):
    def work(batch: pa.RecordBatch):
        out = []
        for k in range(batch.num_rows):
            data = (batch.column("text")[k].as_py() or "").encode("utf-8", "surrogatepass")
            places = np.array(batch.column("places")[k].as_py() or [], np.int64)
            gone = removed_bytes(len(data), places, length)
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if gone.any() else data
            spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
            out.append((len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
        names = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
        columns = dict(zip(names, zip(*out, strict=True), strict=True))
        yield pa.record_batch({"doc_id": batch.column("doc_id")} | {c: pa.array(v) for c, v in columns.items()})

    return work


def remove_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` for each row.

    ``length`` is from 24 to 127.
    """
    if not GRAM + 4 <= length <= 127:
        raise ValueError("length must be between 24 and 127")
    spark = docs.sparkSession
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("id"),
        whole_text().alias("text"),
    )
    # Ties need a second key only where an id is not unique.
    repeated = not docs.groupBy("id").count().where("count > 1").limit(1).isEmpty()
    docs = docs.withColumn("tie", F.xxhash64("text") if repeated else F.lit(0).cast("bigint"))
    texts = docs.dropDuplicates(["id", "tie"]) if repeated else docs
    long = docs.where(F.octet_length("text") >= length)

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = splitters(long, length, BUCKETS_PER_PARTITION * partitions)
    runs = (
        map_arrow(long, _runs(length, cuts), RUNS)
        .repartition(partitions, "bucket")
        .sortWithinPartitions("token", "content", "id", "tie", "place")
    )
    firsts = stash(
        runs.mapInArrow(_firsts(cuts), "token bigint, id bigint, tie bigint, place bigint, shared boolean"), "firsts"
    )
    del runs
    release(spark)

    contents = unlike_strings(firsts.where("shared"), texts, length)
    unlike = stash(
        contents.repartition(partitions, "token")
        .sortWithinPartitions(F.col("more").isNotNull(), "token", "more", "id", "tie", "place")
        .mapInArrow(_compare(length), "id bigint, tie bigint, place bigint"),
        "firsts",
    )
    del contents
    release(spark)

    stay = (
        firsts.where("not shared")
        .select("id", "tie", "place")
        .unionByName(unlike)
        .groupBy("id", "tie")
        .agg(F.collect_list("place").alias("places"))
    )
    return map_arrow(
        docs.join(stay, ["id", "tie"], "left").select("doc_id", "text", "places"), _result(length), RESULT
    )
