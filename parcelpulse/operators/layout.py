"""Space-filling keys: how tables are laid out by place, and which part of them a run reads.

A key interleaves the bits of two cell numbers, so near cells have near keys, and all cells of
a larger square share the leading bits. Tables sorted by it are skipped by ranges of keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cells on a side of the blocks that pixels are stored, chosen and shuffled by.
BLOCK_CELLS = 256
# Blocks on a side of a tile, the folder that pixels are stored in: two to this power.
TILE_BITS = 6
# Bits of one block number in a key; numbers are shifted to be positive.
AXIS_BITS = 22
# Ranges of keys that a scan is given at most. More would only cut finer.
MAX_RANGES = 512

# Shifts and masks that spread the bits of a number to every second place.
SPREAD = (
    (16, 0x0000FFFF0000FFFF),
    (8, 0x00FF00FF00FF00FF),
    (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333),
    (1, 0x5555555555555555),
)


def add_interleaved(df: DataFrame, y: str, x: str, key: str, prefix: str | None = None) -> DataFrame:
    """Add ``key``: the bits of both numbers in turn, after those of the prefix.

    The numbers lie between -2^(AXIS_BITS-1) and 2^(AXIS_BITS-1) - 1; a missing one gives -1.
    Each doubling of the gaps is a projection of its own, so that expressions stay short. The key is
    never missing, or else a join would push a test for that, written out in full, before them.
    """
    kept = [c for c in df.columns if c != key]
    low = 1 << (AXIS_BITS - 1)
    df = df.select(
        *kept,
        *((F.col(c).cast("long") + F.lit(low).cast("long")).alias(f"_bits_{n}") for n, c in (("y", y), ("x", x))),
    )
    for shift, mask in SPREAD:
        spread = (F.expr(f"(_bits_{n} | shiftleft(_bits_{n}, {shift})) & {mask}L").alias(f"_bits_{n}") for n in "yx")
        df = df.select(*kept, *spread)
    head = f"shiftleft(cast({prefix} AS bigint), {2 * AXIS_BITS}) | " if prefix else ""
    return df.select(*kept, F.expr(f"coalesce({head}shiftleft(_bits_y, 1) | _bits_x, -1L)").alias(key))


def block(cell: Column) -> Column:
    return F.floor(cell / BLOCK_CELLS)


def add_block(pixels: DataFrame) -> DataFrame:
    """Add ``block_y`` and ``block_x`` of the pixel's cell."""
    return pixels.withColumns({"block_y": block(F.col("y")), "block_x": block(F.col("x"))})


def add_block_key(blocks: DataFrame) -> DataFrame:
    """Add ``block_key`` of block_y and block_x; the zone, when there is one, comes first."""
    epsg = "epsg" if "epsg" in blocks.columns else None
    return add_interleaved(blocks, "block_y", "block_x", "block_key", epsg)


def tile_of(key: Column) -> Column:
    return F.shiftright(key, 2 * TILE_BITS)


def key_ranges(keys: DataFrame, column: str, bits: int, limit: int = MAX_RANGES) -> list[tuple[int, int]]:
    """At most ``limit`` closed ranges that hold all keys of ``column``.

    Keys are cut to a prefix of which there are no more than ``limit``, by four bits at a time.
    Only the prefixes come to the driver. ``bits`` is the length of the keys.
    """
    for cut in range(0, bits + 4, 4):
        prefix = F.shiftright(column, cut).alias("prefix")
        rows = keys.where(F.col(column).isNotNull()).select(prefix).distinct().limit(limit + 1).collect()
        if len(rows) <= limit:
            break
    found = sorted(r["prefix"] for r in rows)
    out: list[tuple[int, int]] = []
    for p in found:
        low, high = p << cut, ((p + 1) << cut) - 1
        if out and out[-1][1] + 1 == low:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def in_ranges(column: Column, ranges: list[tuple[int, int]]) -> Column:
    """Whether a value is in one of the ranges; as comparisons that reach a Parquet scan."""

    def either(some: list[tuple[int, int]]) -> Column:
        if len(some) == 1:
            low, high = some[0]
            return column.between(F.lit(low), F.lit(high))
        half = len(some) // 2  # a balanced tree: long chains are deep plans
        return either(some[:half]) | either(some[half:])

    return either(ranges) if ranges else F.lit(False)


# --- cells of boxes in degrees -----------------------------------------------------

# Sides of the squares that boxes are filed by, in degrees: each twice the one before.
LEVELS = tuple(0.5 * 2**k for k in range(11))


def level_of(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """The first level whose squares are no smaller than the box."""
    extent = F.greatest(maxx - minx, maxy - miny)
    level = F.lit(len(LEVELS) - 1)
    for k in range(len(LEVELS) - 2, -1, -1):
        level = F.when(extent <= LEVELS[k], F.lit(k)).otherwise(level)
    return level


def _side(level: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, LEVELS)), (level + 1).cast("int"))


def add_cell(boxes: DataFrame) -> DataFrame:
    """Add ``cell``: the square of the box's level that holds its lower left corner.

    The box reaches the next square at most, so ``cells_near`` finds it without the box being
    listed in several cells.
    """
    bounds = [F.col(c) for c in ("minx", "miny", "maxx", "maxy")]
    placed = (
        boxes.withColumn("_level", level_of(*bounds))
        .withColumn("_side", _side(F.col("_level")))
        .withColumns({"_j": F.floor(bounds[1] / F.col("_side")), "_i": F.floor(bounds[0] / F.col("_side"))})
    )
    return add_interleaved(placed, "_j", "_i", "cell", "_level").drop("_level", "_side", "_j", "_i")


def cells_near(boxes: DataFrame, levels=range(len(LEVELS))) -> DataFrame:
    """``boxes`` with ``cell``: a row per cell in which boxes that overlap it can be filed.

    Adds ``inner``: whether all boxes filed there overlap this one, whatever their own bounds.
    """

    def span(low: str, high: str) -> Column:
        first = F.floor(F.col(low) / F.col("side")) - 1
        return F.explode(F.sequence(first, F.floor(F.col(high) / F.col("side"))))

    def inside(k: str, low: str, high: str) -> Column:
        corner = F.col(k) * F.col("side")
        return (corner >= F.col(low)) & (corner + F.col("side") <= F.col(high))

    placed = (
        boxes.withColumn("level", F.explode(F.array(*map(F.lit, levels))))
        .withColumn("side", _side(F.col("level")))
        .withColumn("i", span("minx", "maxx"))
        .withColumn("j", span("miny", "maxy"))
        .withColumn("inner", inside("i", "minx", "maxx") & inside("j", "miny", "maxy"))
    )
    return add_interleaved(placed, "j", "i", "cell", "level").drop("level", "side", "i", "j")


def on_squares(df: DataFrame, level: Column) -> DataFrame:
    """A row per square of the level (a column, or an array of them) that the box covers."""

    def span(low: str, high: str) -> Column:
        return F.explode(
            F.sequence(F.floor(F.col(low) / F.col("side")), F.floor(F.col(high) / F.col("side")))
        )

    return (
        df.withColumn("level", level)
        .withColumn("side", _side(F.col("level")))
        .withColumn("cx", span("minx", "maxx"))
        .withColumn("cy", span("miny", "maxy"))
    )
