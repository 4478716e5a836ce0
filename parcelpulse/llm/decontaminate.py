"""Benchmark decontamination: BM25 over test items, block-max WAND, overlap check.

Test items are cut into segments of at most ``SEGMENT`` words, and a segment's BM25 weights are
divided by their sum: the score of a passage is the share of the segment that it holds. Every
passage of every document (twice ``SEGMENT`` words, half of them shared with the next) queries
the index and retrieves all segments scoring ``LEAST_SCORE`` or more.

Postings stand in order of segment, in blocks with their greatest weight. A passage is looked
at only if its rare terms, with all common ones granted, can reach the score for some segment;
then it runs block-max WAND, which skips blocks that cannot reach it.

A retrieved item is verified on full words: of its shingles of five words the document holds
``LEAST_OVERLAP``, and half of those in each of question and answer (the item's first and second
half). The table tells no question from the answer, and the first share implies the second, so it is
whole overlap that decides. Items of fewer than five words match nothing.

The index is made by aggregations and comes in blocks of items with about ``BLOCK_BYTES`` of text, each
of which is broadcast and meets all documents; no other bound is set on items, and an item, which a block
holds once, may be longer than that. With several blocks
the documents are held once, and a block's findings are held before the next block is built, so
that one block is in memory at a time. A null or empty text
holds nothing. Rows are documents: ids may repeat or be null; test items of equal id are named once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.llm.common import map_arrow, release, stash, whole_text, word_list

SEGMENT = 64  # words
K1, B = 1.2, 0.75
LEAST_SCORE = 0.6
LEAST_OVERLAP = 0.75
BLOCK_BYTES = 8_000_000  # of text per broadcast index, which takes some tens of megabytes
POSTING_BLOCK = 16
END = 1 << 60


def worded(items: DataFrame) -> DataFrame:
    """``item``, ``item_id``, ``words`` of the items that have enough of them."""
    words = F.filter(
        F.split(
            F.translate(whole_text(), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
            r"[\x20\x09-\x0D]+",
        ),
        lambda w: w != "",
    )
    return items.select(
        F.monotonically_increasing_id().alias("item"),
        F.col("item_id").cast("bigint").alias("item_id"),
        words.alias("words"),
    ).where(F.size("words") >= 5)


def segments(items: DataFrame) -> DataFrame:
    """``item``, ``segment``, ``terms``: the words of worded items in segments."""
    cut = F.expr(
        f"transform(sequence(0, int((size(words) - 1) div {SEGMENT})),"
        f" k -> slice(words, k * {SEGMENT} + 1, {SEGMENT}))"
    )
    return items.select("item", F.explode(cut).alias("terms")).withColumn(
        "segment", F.monotonically_increasing_id()
    )


def postings(parts: DataFrame) -> DataFrame:
    """``segment``, ``term``, ``weight``: BM25 weights, summing to one per segment."""
    total = parts.agg(F.count("*").alias("n"), F.avg(F.size("terms")).alias("mean"))
    terms = parts.select("segment", F.size("terms").alias("length"), F.explode("terms").alias("term"))
    tf = terms.groupBy("segment", "term", "length").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    weighted = (
        tf.join(df, "term")
        .join(F.broadcast(total))  # one row
        .withColumn(
            "weight",
            F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
            * F.expr(f"tf * {K1 + 1} / (tf + {K1} * (1 - {B} + {B} * length / mean))"),
        )
    )
    sums = weighted.groupBy("segment").agg(F.sum("weight").alias("sum"))
    return weighted.join(sums, "segment").select(
        "segment", "term", (F.col("weight") / F.col("sum")).alias("weight")
    )


@dataclass
class Index:
    """Postings of one block of segments, by term, and what verification needs of the items."""

    terms: dict = field(default_factory=dict)  # term: (segments, weights, greatest of blocks, of all)
    owner: dict = field(default_factory=dict)  # segment: item
    item_ids: dict = field(default_factory=dict)
    words: dict = field(default_factory=dict)
    common: np.ndarray = None  # per segment, the weight of terms that are not rare
    rare: dict = field(default_factory=dict)  # term: (segments, weights)
    rare_number: dict = field(default_factory=dict)  # place of a rare term in the arrays below
    rare_ends: np.ndarray = None
    rare_segments: np.ndarray = None
    rare_weights: np.ndarray = None


def build_index(rows: list, owners: list, items: list) -> Index:
    """``rows`` are (segment, term, weight), ``owners`` (segment, item), ``items`` (item, item_id, words)."""
    index = Index()
    numbers = {}
    for segment, item in sorted(owners):
        numbers[segment] = len(numbers)
        index.owner[numbers[segment]] = item
    for item, item_id, words in items:
        index.item_ids[item] = item_id
        index.words[item] = [w.encode("utf-8", "surrogatepass") for w in words]
    by_term: dict[bytes, list] = {}
    for segment, term, weight in rows:
        by_term.setdefault(term.encode("utf-8", "surrogatepass"), []).append((numbers[segment], weight))
    for term, listed in by_term.items():
        listed.sort()
        weights = [w for _, w in listed]
        tops = [max(weights[k : k + POSTING_BLOCK]) for k in range(0, len(weights), POSTING_BLOCK)]
        index.terms[term] = ([s for s, _ in listed], weights, tops, max(weights))
    # Terms from the commonest on are common, as long as no segment reaches the score by them.
    index.common = np.zeros(len(numbers))
    for term in sorted(index.terms, key=lambda t: (-len(index.terms[t][0]), t)):
        at, weights = (np.array(x) for x in index.terms[term][:2])
        if len(at) > 1 and (index.common[at] + weights < 0.5 * LEAST_SCORE).all():
            index.common[at] += weights
        else:
            index.rare[term] = (at, weights)
    index.rare_number = {term: k for k, term in enumerate(index.rare)}
    index.rare_ends = np.cumsum([0, *(len(at) for at, _ in index.rare.values())])
    index.rare_segments = np.concatenate([np.zeros(0, np.int64), *(at for at, _ in index.rare.values())])
    index.rare_weights = np.concatenate([np.zeros(0), *(w for _, w in index.rare.values())])
    return index


def block_max_wand(index: Index, query: set[bytes], least: float) -> list[tuple[int, float]]:
    """All segments of which the query's terms hold a share of ``least`` or more, with it."""
    cursors = [[index.terms[t], 0] for t in query if t in index.terms]
    found = []

    def at(cursor) -> int:
        (segments_, *_), k = cursor
        return segments_[k] if k < len(segments_) else END

    while True:
        cursors.sort(key=at)
        bound, pivot = 0.0, -1
        for k, cursor in enumerate(cursors):
            if at(cursor) == END:
                break
            bound += cursor[0][3]
            if bound >= least - 1e-12:
                pivot = k
                break
        if pivot < 0:
            return found
        segment = at(cursors[pivot])
        while pivot + 1 < len(cursors) and at(cursors[pivot + 1]) == segment:
            pivot += 1
        # Greatest weights of the blocks that would hold the pivot, and where the nearest ends.
        block_bound, next_ = 0.0, END
        for cursor in cursors[: pivot + 1]:
            (segments_, _, tops, _), k = cursor
            block = k // POSTING_BLOCK
            while (block + 1) * POSTING_BLOCK <= len(segments_) and (
                segments_[(block + 1) * POSTING_BLOCK - 1] < segment
            ):
                block += 1
            if block < len(tops):
                block_bound += tops[block]
                last = min((block + 1) * POSTING_BLOCK, len(segments_)) - 1
                next_ = min(next_, segments_[last] + 1)
        if block_bound >= least - 1e-12:
            score = 0.0
            for cursor in cursors[: pivot + 1]:
                _seek(cursor, segment)
                if at(cursor) == segment:
                    score += cursor[0][1][cursor[1]]
                    cursor[1] += 1
            if score >= least - 1e-12:
                found.append((segment, score))
            continue
        if pivot + 1 < len(cursors):
            next_ = min(next_, at(cursors[pivot + 1]))
        next_ = max(next_, segment + 1)
        for cursor in cursors[: pivot + 1]:
            _seek(cursor, next_)


def _seek(cursor, segment: int) -> None:
    segments_, k = cursor[0][0], cursor[1]
    while k < len(segments_) and segments_[k] < segment:
        k += 1
    cursor[1] = k


def overlap(words: list[bytes], held: set[tuple]) -> tuple[float, float, float]:
    """Shares of an item's shingles, of its question's and of its answer's, that are held."""
    shingles = [tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))]
    there = [s in held for s in shingles]
    half = max(len(there) // 2, 1)
    share = lambda part: sum(part) / len(part) if part else 1.0
    return share(there), share(there[:half]), share(there[half:])


def passages(index: Index, words: list[bytes]) -> list[int]:
    """Starts of the passages whose rare terms, with all common ones granted, can reach the score."""
    get = index.rare_number.get
    terms = np.array([get(w, -1) for w in words], np.int64)
    at = np.flatnonzero(terms >= 0)
    if not len(at):
        return []
    # A word is in the passage that starts at its segment and in the one before; a term counts once.
    part = at // SEGMENT
    pairs = np.concatenate([part * len(index.rare) + terms[at], (part - 1) * len(index.rare) + terms[at]])
    pairs = np.unique(pairs[pairs >= 0])
    part, terms = pairs // len(index.rare), pairs % len(index.rare)
    sizes = index.rare_ends[terms + 1] - index.rare_ends[terms]
    rows = np.repeat(index.rare_ends[terms] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    cells, place = np.unique(
        np.repeat(part, sizes) * len(index.common) + index.rare_segments[rows], return_inverse=True
    )
    reach = np.bincount(place, index.rare_weights[rows])
    good = reach + index.common[cells % len(index.common)] >= LEAST_SCORE - 1e-9
    return (np.unique(cells[good] // len(index.common)) * SEGMENT).tolist()


def contained(index: Index, words: list[bytes]) -> dict[int, float]:
    """Items that the words of one document hold, with the share of their shingles."""
    items = set()
    for k in passages(index, words):
        for segment, _ in block_max_wand(index, set(words[k : k + 2 * SEGMENT]), LEAST_SCORE):
            items.add(index.owner[segment])
    out: dict[int, float] = {}
    if items:
        held = set(zip(*(words[k:] for k in range(5)), strict=False))
        for item in items:
            whole, question, answer = overlap(index.words[item], held)
            if whole >= LEAST_OVERLAP and min(question, answer) >= LEAST_OVERLAP - 0.25:
                item_id = index.item_ids[item]
                out[item_id] = max(whole, out.get(item_id, 0.0))
    return out


def _leaks(index: Index):
    """The rows that hold items of one index block."""

    def work(batch: pa.RecordBatch):
        rows, ids, best = [], [], []
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found = contained(index, word_list(text))
            if found:
                rows.append(row)
                ids.append(list(found))
                best.append(max(found.values()))
        yield pa.record_batch(
            {
                "row": pa.array(rows, pa.int64()),
                "item_ids": pa.array(ids, pa.list_(pa.int64())),
                "overlap": pa.array(best, pa.float64()),
            }
        )

    return work


def _leaks_of_one(index: Index):
    """Each row with the findings of the only index block."""

    def work(batch: pa.RecordBatch):
        found = [contained(index, word_list(t)) for t in batch.column("text").to_pylist()]
        ids = [sorted(f, key=lambda i: (i is None, i or 0)) for f in found]
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "item_ids": pa.array(ids, pa.list_(pa.int64())),
                "overlap": pa.array([max([0.0, *f.values()]) for f in found], pa.float64()),
            }
        )

    return work


def indexes(items: DataFrame) -> tuple[int, Iterator[Index]]:
    """The number of index blocks, and the blocks, each built when it is asked for."""
    whole = stash(worded(items), "items")
    parts = stash(segments(whole), "segments")
    weights = stash(postings(parts).join(parts.select("segment", "item"), "segment"), "postings")
    size = whole.agg(F.sum(F.octet_length(F.concat_ws(" ", "words")))).first()[0]
    blocks = -(-(size or 0) // BLOCK_BYTES)

    def build(block: int) -> Index:
        mine = F.pmod(F.xxhash64("item"), F.lit(blocks)) == block
        return build_index(
            [tuple(r) for r in weights.where(mine).select("segment", "term", "weight").collect()],
            [tuple(r) for r in parts.where(mine).select("segment", "item").collect()],
            [tuple(r) for r in whole.where(mine).select("item", "item_id", "words").collect()],
        )

    return blocks, map(build, range(blocks))


def findings(rows: DataFrame, blocks: Iterator[Index]) -> DataFrame:
    """``row``, ``item_ids``, ``overlap``: what each block finds in ``row`` and ``text``."""
    schema = "row bigint, item_ids array<bigint>, overlap double"
    found = []
    for index in blocks:
        found.append(stash(map_arrow(rows, _leaks(index), schema), "leaks"))
        del index  # before the next is built
        release(rows.sparkSession)
    return reduce(DataFrame.unionByName, found)


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id``, ``item_ids`` (ascending), ``overlap`` (the greatest), ``contaminated``.

    One row per row of ``docs``.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    nothing = F.expr("cast(array() AS array<bigint>)")
    n, blocks = indexes(items)
    if n == 0:
        out = rows.select("doc_id", nothing.alias("item_ids"), F.lit(0.0).alias("overlap"))
    elif n == 1:
        out = map_arrow(rows, _leaks_of_one(next(blocks)), "doc_id bigint, item_ids array<bigint>, overlap double")
    else:
        held = stash(rows.withColumn("row", F.monotonically_increasing_id()), "documents")
        found = (
            findings(held.select("row", "text"), blocks)
            .groupBy("row")
            .agg(
                F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
                F.max("overlap").alias("overlap"),
            )
        )
        out = held.select("doc_id", "row").join(found, "row", "left").select(
            "doc_id",
            F.coalesce("item_ids", nothing).alias("item_ids"),
            F.coalesce("overlap", F.lit(0.0)).alias("overlap"),
        )
    return out.select("doc_id", "item_ids", "overlap", (F.size("item_ids") > 0).alias("contaminated"))


def remove_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no test item."""

    def clean(index: Index):
        def work(batch: pa.RecordBatch):
            texts = batch.column("text").to_pylist()
            yield batch.filter(pa.array([not contained(index, word_list(t)) for t in texts], pa.bool_()))

        return work

    n, blocks = indexes(items)
    if n == 0:
        return docs
    if n == 1:
        return map_arrow(docs, clean(next(blocks)), docs.schema)
    held = stash(
        docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "documents"
    )
    found = findings(held.select("row", F.col("doc.text").alias("text")), blocks)
    return held.join(found, "row", "left_anti").select("doc.*")
