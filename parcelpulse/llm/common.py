"""Helpers that several of the operators share."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelpulse.session import hold

BATCH_ROWS = 512  # rows that a Python step holds as objects
HOT_KEYS = 1_000  # keys of a lookup that are broadcast
# ASCII white space is what separates words.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str | Column = "text") -> Column:
    """The text; a null one counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def stash(df: DataFrame, name: str) -> DataFrame:
    """Compute once into the shared folder, so that later steps survive lost executors."""
    return hold(df, name)


def lookup(left: DataFrame, right: DataFrame, keys: list[str], weight: str, how: str = "left") -> DataFrame:
    """Join ``right``, unique by ``keys``, to a ``left`` in which some keys may be very frequent.

    ``weight`` is a column of ``right``: about how many rows of ``left`` have the key. The
    ``HOT_KEYS`` heaviest keys are broadcast, so their rows are not shuffled; the join by
    shuffle that serves all others has no key with more than 1 / ``HOT_KEYS`` of the rows.
    """
    heavy = right.orderBy(F.desc(weight), *keys).limit(HOT_KEYS)
    marked = left.join(F.broadcast(heavy.select(*keys, F.lit(True).alias("_heavy"))), keys, "left")
    here = marked.where("_heavy").drop("_heavy").join(F.broadcast(heavy.drop(weight)), keys)
    rest = marked.where("_heavy is null").drop("_heavy").join(right.drop(weight), keys, how)
    return here.unionByName(rest)


def map_arrow(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch | pa.Table]],
    schema: str,
) -> DataFrame:
    """``mapInArrow`` for a function of one batch; it gets ``BATCH_ROWS`` rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                for out in work(batch.slice(at, BATCH_ROWS)):
                    yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return df.mapInArrow(run, schema)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Actions inside hand ``BATCH_ROWS`` rows at once to Python: 10,000 texts are held twice, there and in the JVM."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def pieces(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column of about ``limit`` bytes; one long text stands alone."""
    sizes = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1]
    first = 0
    while first < len(column):
        last = int(np.searchsorted(sizes, sizes[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last
        first = last


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and the offsets of the texts in them."""
    column = column.cast(pa.string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A full-avalanche permutation of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so powers have inverses
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def hash_words(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all lower-cased words, and the offsets of the texts among them.

    Words are told apart by sums of byte times power over the whole array, so the cost is a
    few passes over the bytes whatever the number of words.
    """
    n = len(flat)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_IS_SPACE[flat]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < n]
    begins[cuts] = inside[cuts]  # a word ends with its text
    starts = np.flatnonzero(begins)
    value = np.where(inside, _LOWER[flat].astype(np.uint64) + np.uint64(1), np.uint64(0))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(value * _powers(_BASE, n), out=sums[1:])
    # Between the start of a word and that of the next there is only the word and white space.
    ends = np.append(starts[1:], n) if len(starts) else starts
    words = (sums[ends] - sums[starts]) * _powers(_INVERSE, n)[starts]
    return mix64(words), np.searchsorted(starts, offsets).astype(np.int64)


def hash_shingles(
    words: np.ndarray, offsets: np.ndarray, size: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each text and their offsets; a short text is one shingle."""
    counts = np.diff(offsets)
    shingles = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out_offsets = np.zeros(len(offsets), np.int64)
    np.cumsum(shingles, out=out_offsets[1:])
    total = int(out_offsets[-1])
    if not total:
        return np.zeros(0, np.uint64), out_offsets
    owner = np.repeat(np.arange(len(counts)), shingles)
    first = offsets[:-1][owner] + np.arange(total) - out_offsets[:-1][owner]
    end = np.minimum(first + size, offsets[1:][owner])
    padded = np.append(words, np.zeros(size, np.uint64))
    out = np.zeros(total, np.uint64)
    for k in range(size):
        there = first + k < end
        out = mix64(out * _BASE + np.where(there, padded[first + k], np.uint64(k + 1)))
    return out, out_offsets


def word_list(text: str | None) -> list[bytes]:
    """Lower-cased words of one text (A-Z only are lowered, ASCII white space parts)."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str | None, size: int = 5) -> set[tuple[bytes, ...]]:
    """The text's set of word shingles; a shorter text is one shingle, an empty one none."""
    words = word_list(text)
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return set(zip(*(words[k:] for k in range(size)), strict=False))


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps whose results are in the shared folder."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def process_store() -> dict:
    """A dictionary that lives as long as the Python worker, over tasks."""
    return sys.modules.setdefault("_worker_store", types.ModuleType("_worker_store")).__dict__


def forget() -> None:
    """Let go what another step has kept in this Python worker, which Spark uses again."""
    store = process_store()
    kept = [name for name in store if not name.startswith("__")]
    for name in kept:
        del store[name]
    if kept:
        pa.default_memory_pool().release_unused()
