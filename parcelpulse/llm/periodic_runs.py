"""Periodic runs of words, by an online sparse dynamic program over diagonals.

Word i equals the word q before it: that is a match on the diagonal of lag q. Words are read from
left to right. For each word, its earlier occurrences lengthen the matches of their lags; a lag
that a word does not lengthen has ended, and if its match of m words makes a stretch of m + q
words with m + q >= max(12, 2 q), the run is emitted at once.

What keeps the program sparse, and loses no run:

- A run of period q has at least max(6, q) matches in a row. Lags are therefore taken in levels of
  doubling size, and an earlier occurrence counts on a level only when that level's number of words
  before it are the same too (6 words for lags below 8, 8 below 16, 16 below 32, ...). Such
  stretches have exact ranks, made by pairing the ranks of halves; levels end when no
  stretch repeats. Only words with a repeated stretch are visited at all.
- Two places inside one run of a period p that is at most half a level's length lie a multiple of p
  apart, and that diagonal ends with the run of period p: it has the smaller period and is
  skipped. So a text of one word, or of one phrase again and again, costs a few steps per word.

Texts are rows; a text lies in one task and needs memory in proportion to its own length. Nothing
is shuffled. Null and empty texts have no words and no runs; a null ``doc_id`` is carried through and
its text is not altered by the repeating rule; repeated rows are judged each by itself. The longest
run is the one of greatest length, then smallest start, then smallest period. Columns other than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.llm.common import map_arrow, whole_text

LEAST = 12  # words of a run
FIRST = 6  # matches that a run has at least: LEAST / 2
PAIRS = 1 << 18  # pairs of equal stretches that are listed at a time

SCHEMA = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def repeated(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words after the contract's rule: one text in ten repeats a stretch of itself to its end."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    phrase = words[a : a + p]
    return (words[:a] + phrase * ((n - a) // p + 1))[:n]


def numbered(words: list[bytes]) -> np.ndarray:
    """A number per word; equal words have equal ones."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def _paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ranks of the joined stretches; equal pairs have equal ranks."""
    return np.unique(left * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1]


def _repeats(ranks: np.ndarray) -> np.ndarray:
    return np.bincount(ranks)[ranks] > 1


def _levels(ids: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """First lag, end of lags, stretch length and ranks of the stretches by their first word."""
    two = _paired(ids[:-1], ids[1:])
    four = _paired(two[:-2], two[2:])
    yield 1, 8, FIRST, _paired(four[:-2], two[4:])
    ranks, size = four, 4
    while len(ranks) > size:
        ranks, size = _paired(ranks[:-size], ranks[size:]), 2 * size
        yield size, 2 * size, size, ranks


def _inside(found: list[tuple[int, int, int]], size: int, n: int) -> np.ndarray:
    """For the first word of each stretch the start of the short-period run that holds it, else -1."""
    starts = np.full(n, -1, np.int64)
    for start, length, period in found:
        if 2 * period <= size <= length:
            starts[start : start + length - size + 1] = start
    return starts


def _matches(ranks: np.ndarray, low: int, high: int, run_starts: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """Places in order, each with the lags below ``high`` at which its stretch stood before."""
    n = len(ranks)
    order = np.argsort(ranks, kind="stable")
    keys = ranks[order] * np.int64(n) + order  # ascending: by rank, then place
    places = np.flatnonzero(_repeats(ranks))
    # Earlier places of the stretch that are near enough and outside the own run.
    last = places - low
    inside = run_starts[places]
    last = np.where(inside >= 0, np.minimum(last, inside - 1), last)
    first = np.maximum(places - high + 1, 0)
    base = ranks[places] * np.int64(n)
    begin = np.searchsorted(keys, base + first)
    end = np.where(last >= first, np.searchsorted(keys, base + last, side="right"), begin)
    some = end > begin
    places, begin, sizes = places[some], begin[some], (end - begin)[some]
    sums = np.cumsum(sizes)
    at = 0
    while at < len(places):
        stop = max(int(np.searchsorted(sums, (sums[at - 1] if at else 0) + PAIRS, side="right")), at + 1)
        n_each = sizes[at:stop]
        edges = np.cumsum(n_each)
        rows = np.repeat(begin[at:stop] - (edges - n_each), n_each) + np.arange(edges[-1])
        lags = (np.repeat(places[at:stop], n_each) - order[rows]).tolist()
        lower = 0
        for place, upper in zip(places[at:stop].tolist(), edges.tolist(), strict=True):
            yield place, lags[lower:upper]
            lower = upper
        at = stop


def _primitive(ids: np.ndarray, start: int, length: int, period: int) -> bool:
    """Whether no shorter period fits; one that did would divide the period."""
    stretch = ids[start : start + length]
    left, prime = period, 2
    while left > 1:
        if prime * prime > left:
            prime = left
        if left % prime == 0:
            shorter = period // prime
            if np.array_equal(stretch[shorter:], stretch[:-shorter]):
                return False
            while left % prime == 0:
                left //= prime
        prime += 1
    return True


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs as (start, length, period), by start, then period."""
    n = len(ids)
    found: list[tuple[int, int, int]] = []
    if n < LEAST:
        return found
    for low, high, size, ranks in _levels(ids):
        if low > n // 2 or not _repeats(ranks).any():
            break
        emitted: list[tuple[int, int, int]] = []

        def end(lag: int, matched: int, after: int, emitted=emitted) -> None:
            """The match of a lag ended before word ``after``."""
            length = matched + lag
            if length >= max(LEAST, 2 * lag) and _primitive(ids, after - length, length, lag):
                emitted.append((after - length, length, lag))

        active: dict[int, int] = {}  # lag: words matched up to the word before
        before = -1
        for place, lags in _matches(ranks, low, high, _inside(found, size, len(ranks))):
            word = place + size - 1  # the stretch's last word is the one just read
            if word != before + 1:
                for lag, matched in active.items():
                    end(lag, matched, before + 1)
                active = {}
            now = {lag: active.pop(lag, size - 1) + 1 for lag in lags}
            for lag, matched in active.items():
                end(lag, matched, word)
            active, before = now, word
        for lag, matched in active.items():
            end(lag, matched, before + 1)
        found += emitted
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without what runs repeat."""
    if not found:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    dropped = np.cumsum(change)[:-1].tolist()
    return [word for word, drop in zip(words, dropped, strict=True) if not drop]


def _may_repeat(parts: list[np.ndarray]) -> np.ndarray:
    """For each text of a batch whether FIRST words in a row may stand in it twice.

    Stretches of all texts are compared at once by a hash; texts that pass are judged exactly.
    """
    sizes = np.array([len(p) for p in parts], np.int64)
    owner = np.repeat(np.arange(len(parts)), sizes)
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    out = np.zeros(len(parts), bool)
    if len(ids) < LEAST:
        return out
    value = owner[: len(ids) - FIRST + 1].astype(np.uint64)
    for k in range(FIRST):
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        value += ids[k : len(ids) - FIRST + 1 + k].astype(np.uint64)
    whole = owner[: len(value)] == owner[FIRST - 1 :]
    value, owner = value[whole], owner[: len(value)][whole]
    order = np.argsort(value)
    again = value[order][1:] == value[order][:-1]
    out[owner[order[1:][again]]] = True
    return out


def _digest(batch: pa.RecordBatch):
    doc_ids = batch.column("doc_id").to_pylist()
    texts = [
        repeated(text.encode("utf-8", "surrogatepass").split(), doc_id)
        for doc_id, text in zip(doc_ids, batch.column("text").to_pylist(), strict=True)
    ]
    parts = [numbered(words) for words in texts]
    rows = []
    for doc_id, words, ids, may in zip(doc_ids, texts, parts, _may_repeat(parts).tolist(), strict=True):
        found = find_runs(ids) if may else []
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        start, length, period = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        rows.append(
            (
                doc_id,
                len(found),
                start,
                length,
                period,
                1000 * length // period if found else None,
                hashlib.sha256(listed.encode()).hexdigest(),
                hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest(),
            )
        )
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    types = [pa.int64()] * 6 + [pa.string()] * 2
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    yield pa.record_batch({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)})


def _runs(batch: pa.RecordBatch):
    rows = []
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
        words = text.encode("utf-8", "surrogatepass").split()
        rows += [
            (doc_id, s, n, q, b" ".join(words[s : s + q]).decode("utf-8", "surrogatepass"))
            for s, n, q in find_runs(numbered(words))
        ]
    names, types = ["doc_id", "start", "length", "period", "phrase"], [pa.int64()] * 4 + [pa.string()]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    yield pa.record_batch({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)})


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """A row per run of the texts as they are: ``doc_id``, ``start``, ``length``, ``period``, ``phrase``."""
    schema = "doc_id bigint, start bigint, length bigint, period bigint, phrase string"
    return map_arrow(_texts(docs), _runs, schema)


def collapse_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with each text cut to the words that no run repeats, a blank between them.

    Texts without a run stay as they are, null ones too.
    """
    from pyspark.sql.types import StringType

    if not isinstance(docs.schema["text"].dataType, StringType):
        docs = docs.withColumn("text", F.col("text").cast("string"))

    def work(batch: pa.RecordBatch):
        out = []
        for text in batch.column("text").to_pylist():
            words = (text or "").encode("utf-8", "surrogatepass").split()
            found = find_runs(numbered(words))
            kept = b" ".join(collapsed(words, found)).decode("utf-8", "surrogatepass")
            out.append(kept if found else text)
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    return map_arrow(docs, work, docs.schema)


def run_digests(docs: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest one, and digests of all runs and of the kept words.

    Texts first undergo the contract's repeating rule (``repeated``).
    """
    return map_arrow(_texts(docs), _digest, SCHEMA)
