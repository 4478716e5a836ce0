"""Leaving out rows that no join partner waits for, before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a sieve, whatever the number of keys: 8 MB are broadcast at most. With more keys it
# lets more rows through; the join behind it decides.
SIEVE_BITS = 1 << 26
# Bits of one row of it, and of one of its words.
ROW_BITS, WORD_BITS = 1 << 13, 1 << 6

_INTEGERS = ("tinyint", "smallint", "int", "bigint")
_OTHERS = ("string", "date")


def _hashable(rows: DataFrame, keys: DataFrame, columns: list[str]) -> list[str]:
    """The columns whose equal values have equal hashes on both sides."""
    left, right = dict(rows.dtypes), dict(keys.dtypes)
    return [
        c
        for c in columns
        if (left[c] in _INTEGERS and right[c] in _INTEGERS) or (left[c] == right[c] and left[c] in _OTHERS)
    ]


def _slot(df: DataFrame, columns: list[str]) -> Column:
    types = dict(df.dtypes)
    values = [F.col(c).cast("long") if types[c] in _INTEGERS else F.col(c) for c in columns]
    return F.pmod(F.xxhash64(*values), F.lit(SIEVE_BITS))


def _place(df: DataFrame, slot: Column, *kept: str) -> DataFrame:
    """``kept`` with the row, word and bit of the sieve that the slot is."""
    return df.select(*kept, slot.alias("_slot")).select(
        *kept,
        F.expr(f"_slot div {ROW_BITS}").alias("_row"),
        F.expr(f"cast(_slot % {ROW_BITS} div {WORD_BITS} AS int)").alias("_word"),
        F.expr(f"cast(_slot % {WORD_BITS} AS int)").alias("_bit"),
    )


def sift(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` without most of those whose ``columns`` do not occur in ``keys``.

    No row that has a partner is lost, so a join of the result gives what a join of ``rows``
    does. A hash of each key sets one bit of a table of fixed size, which is broadcast.
    """
    shared = _hashable(rows, keys, columns)
    if not shared:
        return rows
    words = (
        _place(keys, _slot(keys, shared))
        .groupBy("_row", "_word")
        .agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_mask"))
    )
    found = F.map_from_entries(F.collect_list(F.struct("_word", "_mask")))
    table = words.groupBy("_row").agg(found.alias("_found")).select(
        "_row",
        F.expr(
            f"transform(sequence(0, {ROW_BITS // WORD_BITS - 1}), i -> coalesce(_found[i], 0L))"
        ).alias("_masks"),
    )
    placed = _place(rows, _slot(rows, shared), *rows.columns)
    return (
        placed.join(F.broadcast(table), "_row")
        .where("bit_get(_masks[_word], _bit) = 1")
        .select(*rows.columns)
    )
