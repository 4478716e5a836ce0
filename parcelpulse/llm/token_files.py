"""Token ids in Simple-8b blocks: encode, write in document order, read back.

A 64-bit word holds a selector in its top four bits and 1 to 120 ids of equal width below.
Selector 0 is the escape: the next word holds one id of more than 60 bits. A document starts
with a word of its own and fills its words, so nothing is padded; a block lists the ids,
token counts and word counts of its documents, from which all offsets follow, so one block is
decoded by a few vector operations, and one document without the others.

Files are Parquet with a row per block, in ascending order of doc_id: parts of the id range
are written by one task each, whatever their number. Places of documents in the whole stream
come from the sums of the parts before. Null ids come first; rows with one id are ordered by
the hash of their text. A null text is empty and has the end id only.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelpulse.llm.common import map_arrow, pieces, process_store, small_batches, text_bytes, whole_text
from parcelpulse.session import new_folder

# Ids per word and bits of each, by selector; selector 0 escapes.
COUNTS = (1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)

# The narrowest width for an id: number of limits up to it, or looked up for small ids.
_CLASS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 64], np.int8)
_LIMITS = np.array([1 << int(w) for w in _CLASS[:-1]], np.uint64)
_SMALL = _CLASS[np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), side="right")]

BLOCK_TOKENS = 1 << 16
BATCH_TEXTS = 256  # that are packed at once
BATCH_BYTES = 2 << 20  # of texts that are cut and looked up at once
CACHED_WORDS = 300_000  # twice: recent ones and those before
KEPT_CHARS = 64  # of a piece other than letters that is kept
STRUNG = 64  # new words that are encoded in one call
BLOCKS = (
    "part int, block int, start bigint, n_tokens bigint, doc_ids array<bigint>, "
    "token_counts array<bigint>, word_counts array<bigint>, words binary"
)

_WORD = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")

_NO_TEXT = b"\xff"  # does not occur in UTF-8

# Kinds of bytes. Of those of no kind nothing is known, so there is no cut beside them.
_BLANK, _BREAK, _LETTER, _DIGIT, _MARK, _QUOTE, _BEYOND = range(1, 8)


def _kinds() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[33:127] = _MARK
    for chars, kind in ((r" ", _BLANK), ("\t\n\r", _BREAK), ("0123456789", _DIGIT), ("'", _QUOTE)):
        kinds[list(chars.encode())] = kind
    kinds[65:91] = kinds[97:123] = _LETTER
    kinds[128:] = _BEYOND
    return kinds


def _borders() -> np.ndarray:
    """By the kinds before and after: whether the tokenizer always starts a word there."""
    seen, space = (_LETTER, _DIGIT, _MARK, _QUOTE, _BEYOND), (_BLANK, _BREAK)
    table = np.zeros((8, 8), bool)
    for before in seen:
        table[before, space] = True
    for before, after in ((_LETTER, (_DIGIT, _MARK, _QUOTE)), (_DIGIT, (_LETTER, _MARK, _QUOTE))):
        table[before, after] = True
    table[_MARK, (_LETTER, _DIGIT)] = True
    table[_QUOTE, _DIGIT] = True  # before letters it may be a word with them, as in "don't"
    return table.ravel()


# As tables for bytes.translate, the fastest lookup of bytes.
_KINDS = _kinds().tobytes()
_BORDERS = _borders().tobytes().ljust(256, b"\0")
# Letters of two bytes, the first of them 0xC3, by the second: all but the signs of times and division.
_SECOND = np.isin(np.arange(256), [b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)])
# White space beyond ASCII, by its bytes.
_WHITE = [c.encode() for c in "\x85\xa0\u1680\u180e\u2028\u2029\u202f\u205f\u3000"]
_WHITE += [chr(c).encode() for c in range(0x2000, 0x200C)]


def cuts(data: np.ndarray, offsets: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Places in ``data``, the bytes of texts, that the tokenizer never joins the sides of.

    A byte-level tokenizer starts a word wherever letters, digits and marks change, and before
    white space; the last of several white-space characters goes with what follows, and is a word
    of its own unless it is a blank. The bounds of texts are cuts, and the only ones of ``whole`` texts.
    """
    kinds = np.frombuffer(bytearray(data.tobytes().translate(_KINDS)), np.uint8)
    if kinds.max(initial=0) == _BEYOND:
        padded = np.append(data, np.zeros(2, np.uint8))
        at = np.flatnonzero(data == 0xC3)
        at = at[_SECOND[padded[at + 1]]]
        kinds[at] = kinds[at + 1] = _LETTER
        for lead in sorted({w[0] for w in _WHITE}):
            at = np.flatnonzero(data == lead)
            for white in _WHITE if len(at) else ():
                if white[0] == lead:
                    hit = at[(padded[at + 1] == white[1]) & (padded[at + len(white) - 1] == white[-1])]
                    for k in range(len(white)):
                        kinds[hit + k] = 0
    filled = np.diff(offsets) > 0
    starts, ends = offsets[:-1][filled], offsets[1:][filled] - 1
    before = np.append(np.uint8(0), kinds[:-1])
    after = np.append(kinds[1:], np.uint8(0))
    before[starts] = after[ends] = 0
    followed = after >= _LETTER
    cut = np.frombuffer(bytearray((before * np.uint8(8) + kinds).tobytes().translate(_BORDERS)), bool)
    # Kinds from 1 to _BREAK are white space; 0 less 1 is 255.
    cut |= (kinds - np.uint8(1) < _BREAK) & (before - np.uint8(1) < _BREAK) & followed
    cut[starts] = True
    cut[np.flatnonzero(cut & (kinds == _BREAK) & followed) + 1] = True
    for k in np.flatnonzero(whole):
        cut[offsets[k] + 1 : offsets[k + 1]] = False
    return np.flatnonzero(cut)


class Encoder:
    """Whole texts to ids, by pieces that the tokenizer never joins, each encoded once.

    Many texts are cut and their distinct pieces found at once; these are looked up, and those
    not met before are encoded. It equals encoding whole texts.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenize = self.tokenizer.model.tokenize
        # Their places are found before all others, so texts that hold one are not cut.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.others: dict[str, bytes] = {}
        # Bytes that print as themselves keep their character; others follow from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.chars = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        between = self.chars[_NO_TEXT[0]]
        merged = any(between in token and token != between for token in self.tokenizer.get_vocab())
        self.between = None if merged else self.tokenizer.token_to_id(between)

    def _word(self, word: str) -> bytes:
        """Ids of letters, maybe after a blank."""
        if word.isascii():
            shown = word.replace(" ", self.chars[32])
        else:
            shown = word.encode().decode("latin-1").translate(self.chars)
        return array("I", [t.id for t in self.tokenize(shown)]).tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of each word. Many are strung together by a byte that is never merged: a call for each string."""
        if len(words) < STRUNG or self.between is None:
            return [self._word(w) for w in words]
        out = []
        for at in range(0, len(words), STRUNG):
            string = _NO_TEXT.join([w.encode() for w in words[at : at + STRUNG]])
            shown = string.decode("latin-1").translate(self.chars)
            ids = np.array([t.id for t in self.tokenize(shown)], "<u4")
            data, edges = ids.tobytes(), np.flatnonzero(ids == self.between) * 4
            ends = [*edges.tolist(), len(data)]
            out += [data[a:b] for a, b in zip([0, *(edges + 4).tolist()], ends, strict=True)]
        return out

    def _keep(self, piece: str, ids: bytes) -> None:
        if len(self.recent) >= CACHED_WORDS:  # words not met for long are forgotten
            self.older, self.recent = self.recent, {}
        self.recent[piece] = ids

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of each of some distinct pieces."""
        out = [*map(self.recent.get, pieces)]
        words = []
        for k in [k for k, ids in enumerate(out) if ids is None]:
            piece = pieces[k]
            out[k] = ids = self.older.get(piece)
            if ids is not None:
                self._keep(piece, ids)
            elif _WORD.fullmatch(piece):
                words.append(k)
            else:
                out[k] = self._other(piece)
        for k, ids in zip(words, self._words([pieces[k] for k in words]), strict=True):
            out[k] = ids
            self._keep(pieces[k], ids)
        return out

    def _other(self, piece: str) -> bytes:
        """Ids of what is not letters; long pieces are hardly met again and not kept."""
        ids = self.others.get(piece)
        if ids is None:
            ids = array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
            if len(piece) <= KEPT_CHARS:
                if len(self.others) >= CACHED_WORDS // 4:
                    self.others.clear()
                self.others[piece] = ids
        return ids

    def encode_texts(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, ``end`` after each, and how many each has."""
        data, offsets = text_bytes(texts)
        whole = np.zeros(len(texts), bool)
        for content in self.added:
            whole |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        starts = cuts(data, offsets, whole)
        parts = pa.StringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(data)
        ).dictionary_encode()
        known = self._ids(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        # After the pieces of each text comes its end.
        last = np.searchsorted(starts, offsets[1:])
        order = np.insert(parts.indices.to_numpy(), last, len(known))
        ids = pa.array([*known, end], pa.large_binary()).take(pa.array(order))
        edges = np.frombuffer(ids.buffers()[1], np.int64)[: len(order) + 1] // 4
        counts = np.diff(edges[np.append(0, last + np.arange(1, len(last) + 1))])
        return np.frombuffer(ids.buffers()[2] or b"", "<u4", int(edges[-1])), counts

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit integers."""
        return self.encode_texts(pa.array([text], pa.string()))[0].tobytes()


def pack(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all documents in a row, and how many each has; greedy from the left."""
    ids = ids.astype(np.uint64)
    n = len(ids)
    ends = np.cumsum(counts)
    # Ids up to the end of the document; more than fit a word are alike.
    left = np.minimum(np.repeat(ends, counts) - np.arange(n), max(COUNTS)).astype(np.int8)
    width = _CLASS[np.searchsorted(_LIMITS, ids, side="right")] if ids.max(initial=0) >> 16 else _SMALL[ids]
    selector = np.where(width > 60, 0, 15).astype(np.int8)
    widest, span = width, 1
    for s in range(14, 0, -1):
        count = COUNTS[s]
        while span < count:  # widest of the next ``span`` ids
            step = min(span, count - span)
            widest = np.maximum(widest[: len(widest) - step], widest[step:]) if len(widest) > step else widest[:0]
            span += step
        fits = (widest <= WIDTHS[s]) & (left[: len(widest)] >= count)
        if not fits.any():
            break  # more ids of fewer bits do not fit either
        np.copyto(selector[: len(fits)], s, where=fits)
    jumps = np.array(COUNTS, np.int64)[selector].tolist()
    heads, at = [], 0
    while at < n:
        heads.append(at)
        at += jumps[at]
    heads = np.array(heads, np.int64)
    chosen = selector[heads]
    sizes = 1 + (chosen == 0)
    place = np.zeros(len(heads) + 1, np.int64)
    np.cumsum(sizes, out=place[1:])
    words = np.zeros(int(place[-1]), np.uint64)
    for s in np.unique(chosen):
        at = np.flatnonzero(chosen == s)
        if s == 0:
            words[place[at] + 1] = ids[heads[at]]
            continue
        word = np.full(len(at), np.uint64(s) << np.uint64(60))
        for k in range(COUNTS[s] if WIDTHS[s] else 0):
            word |= ids[heads[at] + k] << np.uint64(k * WIDTHS[s])
        words[place[at]] = word
    first = np.searchsorted(heads, np.append(0, ends))
    return words, np.diff(place[first])


def unpack(words: np.ndarray) -> np.ndarray:
    """All ids of a block."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array(COUNTS, np.int64)[selector]
    if (selector == 0).any():  # an escape's second word is no word of its own
        heads, raw = [], False
        for s in selector.tolist():
            heads.append(not raw)
            raw = not raw and s == 0
        counts[~np.array(heads)] = 0
        selector[~np.array(heads)] = -1
    place = np.cumsum(counts) - counts
    ids = np.zeros(int(counts.sum()), np.uint64)
    for s in np.unique(selector[selector >= 0]):
        at = np.flatnonzero(selector == s)
        if s == 0:
            ids[place[at]] = words[at + 1]
            continue
        mask = np.uint64((1 << WIDTHS[s]) - 1)
        for k in range(COUNTS[s] if WIDTHS[s] else 0):
            ids[place[at] + k] = (words[at] >> np.uint64(k * WIDTHS[s])) & mask
    return ids


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``BATCH_BYTES`` of texts: fewer distinct pieces are looked up again."""
    held, size = [], 0

    def whole() -> Iterator[pa.RecordBatch]:
        texts = pa.Table.from_batches(held).combine_chunks().to_batches()
        held.clear()
        for batch in texts:
            for first, last in pieces(batch.column("text"), BATCH_BYTES):
                yield batch.slice(first, last - first)

    for batch in batches:
        held.append(batch.set_column(batch.schema.get_field_index("text"), "text", batch.column("text").cast(pa.string())))
        size += batch.nbytes
        if size >= BATCH_BYTES:
            yield from whole()
            size = 0
    if held:
        yield from whole()


def _encode(definition: str, end_id: int, cuts: np.ndarray):
    end = np.array([end_id], "<u4").tobytes()

    def packed(batch: pa.RecordBatch, encoder: Encoder) -> Iterator[pa.RecordBatch]:
        ids, counts = encoder.encode_texts(batch.column("text"), end)
        places = np.append(0, np.cumsum(counts))
        for at in range(0, batch.num_rows, BATCH_TEXTS):
            part, n = batch.slice(at, BATCH_TEXTS), counts[at : at + BATCH_TEXTS]
            words, sizes = pack(ids[places[at] : places[at + len(n)]], n)
            data = words.astype("<u8").tobytes()
            edges = np.append(0, np.cumsum(sizes)) * 8
            doc_ids = part.column("doc_id")
            known = doc_ids.fill_null(-(2**63)).to_numpy()
            yield pa.record_batch(
                {
                    "part": np.searchsorted(cuts, known, side="right").astype(np.int32),
                    "doc_id": doc_ids,
                    "tie": part.column("tie"),
                    "n_tokens": n,
                    "words": pa.array(
                        [data[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)],
                        pa.binary(),
                    ),
                }
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = process_store()
        if store.get("definition") != definition:
            pa.default_memory_pool().release_unused()  # what other steps left in this worker
            store.update(definition=definition, encoder=Encoder(definition))
        for batch in _gathered(batches):
            yield from packed(batch, store["encoder"])

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted documents of whole parts to blocks of some ten thousand ids."""
    part, block, start, held, tokens = None, 0, 0, [], 0

    def flush() -> pa.RecordBatch:
        ids, counts, words = zip(*held, strict=True)
        return pa.record_batch(
            {
                "part": pa.array([part], pa.int32()),
                "block": pa.array([block], pa.int32()),
                "start": [start],
                "n_tokens": [tokens],
                "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                "token_counts": pa.array([counts], pa.list_(pa.int64())),
                "word_counts": pa.array([[len(w) // 8 for w in words]], pa.list_(pa.int64())),
                "words": pa.array([b"".join(words)], pa.binary()),
            }
        )

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("part", "doc_id", "n_tokens", "words"))
        for p, doc_id, n, words in zip(*columns, strict=True):
            if held and (p != part or tokens + n > BLOCK_TOKENS):
                yield flush()
                start, block = (start + tokens, block + 1) if p == part else (0, 0)
                held, tokens = [], 0
            elif p != part:
                start, block = 0, 0
            part = p
            held.append((doc_id, n, words))
            tokens += n
    if held:
        yield flush()


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2) -> None:
    """Encode ``text`` with the tokenizer file and write the blocks to the folder ``path``."""
    spark = docs.sparkSession
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        whole_text().alias("text"),
        F.xxhash64(whole_text()).alias("tie"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Quantiles of the ids alone; sampling the encoded rows would encode all texts twice.
    cuts = docs.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.2 / parts)
    cuts = np.unique(np.array(cuts, np.float64).astype(np.int64))
    coded = docs.mapInArrow(
        _encode(Path(tokenizer).read_text(encoding="utf-8"), end_id, cuts),
        "part int, doc_id bigint, tie bigint, n_tokens bigint, words binary",
    )
    ordered = coded.repartition(parts, "part").sortWithinPartitions("part", "doc_id", "tie")
    with small_batches(spark):
        ordered.mapInArrow(_blocks, BLOCKS).write.parquet(path)


def _read(batch: pa.RecordBatch):
    for k in range(batch.num_rows):
        ids, counts, words, base, start = (
            batch.column(c)[k] for c in ("doc_ids", "token_counts", "words", "base", "start")
        )
        counts = np.array(counts.as_py(), np.int64)
        tokens = unpack(np.frombuffer(words.as_py(), "<u8")).astype("<u4")
        if len(tokens) != counts.sum():
            raise ValueError("a block is damaged: its counts and its words differ")
        offsets = np.zeros(len(counts) + 1, np.int32)
        np.cumsum(counts, out=offsets[1:])
        yield pa.record_batch(
            {
                "doc_id": ids.values,
                "start": base.as_py() + start.as_py() + offsets[:-1].astype(np.int64),
                "n_tokens": counts,
                "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens.astype(np.int64))),
            }
        )


def _digest(batch: pa.RecordBatch):
    for out in _read(batch):
        ids = out.column("ids")
        data = ids.values.to_numpy().astype("<u4").tobytes()
        edges = (ids.offsets.to_numpy().astype(np.int64) * 4).tolist()
        sums = [zlib.crc32(data[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        yield pa.record_batch(
            {c: out.column(c) for c in ("doc_id", "start", "n_tokens")}
            | {"ids_crc32": pa.array(sums, pa.int64())}
        )


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with the number of ids in all parts before; there is a row per part to add up."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return blocks.join(F.broadcast(bases), "part")  # a row per part that was written


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids`` from the files in ``path``."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids array<bigint>"
    return map_arrow(_placed(spark, path), _read, schema)


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` from the files in ``path``."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return map_arrow(_placed(spark, path), _digest, schema)


def encoded(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` to a new folder beside the checkpoints and return the files' digest."""
    path = new_folder(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer, path, end_id)
    return token_digest(docs.sparkSession, path)
