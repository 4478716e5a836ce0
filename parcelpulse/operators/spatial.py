"""Parcel batches, parcel-scene matching, parcel cells and grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpulse.functions import geometry, utm
from parcelpulse.functions.geometry import BOUNDS
from parcelpulse.operators import layout
from parcelpulse.operators.catalogue import boxes_overlap, with_cell
from parcelpulse.operators.sieve import sift
from parcelpulse.schema import Grid
from parcelpulse.session import hold

# Rows of one square that a task takes; a fuller square is dealt over more tasks.
ROWS_PER_TASK = 4_096
# Parcels, or scenes, of one list that meet lists of the other kind.
LISTED = 128
# Slots that the lists of scenes of a footprint and month are dealt over.
DEALT = 4

BATCH = ["source_file", "date_range", "batch_id"]
# Identifies a row of parcel_days; all but the parcel are columns of an item, too.
DAY_KEYS = ["parcel_key", "footprint_id", "solar_day", "utc_day"]


def drop_invalid_parcels(parcels: DataFrame) -> DataFrame:
    return parcels.where(geometry.is_polygon("rings"))


def with_bounds(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Add minx, miny, maxx, maxy; a table that has those of its rings keeps them."""
    if rings == "rings" and set(BOUNDS) <= set(df.columns):
        return df
    return df.withColumns(geometry.bounds(rings))


# --- batches -----------------------------------------------------------------------


def with_batch(parcels: DataFrame, size_deg: float) -> DataFrame:
    return parcels.withColumn("batch_id", geometry.batch_key("rings", size_deg))


def batch_bounds(batched: DataFrame) -> DataFrame:
    """Total bounds and parcel count per batch."""
    return (
        with_bounds(batched)
        .groupBy(*BATCH)
        .agg(
            F.min("minx").alias("minx"),
            F.min("miny").alias("miny"),
            F.max("maxx").alias("maxx"),
            F.max("maxy").alias("maxy"),
            F.count("*").alias("n_parcels"),
        )
    )


def batch_epsg(bounds: DataFrame) -> DataFrame:
    return bounds.withColumn("epsg", utm.utm_epsg(*[F.col(c) for c in BOUNDS]))


def in_batch_utm(parcels: DataFrame, size_deg: float) -> DataFrame:
    """Add epsg (one per batch) and rings_utm in metres."""
    batched = with_batch(parcels, size_deg)
    zones = batch_epsg(batch_bounds(batched)).select(*BATCH, "epsg")
    joined = batched.drop("epsg").join(zones, BATCH)
    return joined.withColumn("rings_utm", utm.project_rings("rings", "epsg"))


# --- parcels and scenes ------------------------------------------------------------


def _first_shared_square() -> Column:
    """True in exactly one of the squares that two overlapping boxes share."""

    def first(axis: str) -> Column:
        corner = F.greatest(F.col(f"p.min{axis}"), F.col(f"s.min{axis}"))
        return F.col(f"p.c{axis}") == F.floor(corner / F.col("p.side"))

    return first("x") & first("y")


def scenes_in_boxes(scenes: DataFrame, boxes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, item_id) for every scene whose bounds overlap the box; touching counts.

    A scene is filed in one cell, so scenes are neither repeated nor counted. The boxes'
    cells are held: while they are few, Catalyst broadcasts them and no scene is shuffled.
    """
    near = hold(layout.cells_near(boxes.select(*keys, *BOUNDS)), "boxes")
    filed = with_cell(scenes.where(F.col("rings").isNotNull())).select("item_id", "cell", *BOUNDS)
    return (
        near.alias("p")
        .join(filed.alias("s"), "cell")
        .where(F.col("inner") | boxes_overlap("p", "s"))
        .select(*keys, "item_id")
    )


def count_in_boxes(scenes: DataFrame, boxes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_items): how many scenes overlap the box, without listing them.

    A cell whose scenes all overlap adds its sum; elsewhere scenes of equal bounds, such as
    those of one tile and orbit, are judged once and add their number.
    """
    near = hold(layout.cells_near(boxes.select(*keys, *BOUNDS)), "boxes")
    alike = hold(
        with_cell(scenes.where(F.col("rings").isNotNull()))
        .groupBy("cell", *BOUNDS)
        .agg(F.count("*").alias("n")),
        "scene-counts",
    )
    sums = alike.groupBy("cell").agg(F.sum("n").alias("n"))
    whole = near.where("inner").join(sums, "cell").select(*keys, "n")
    partly = (
        near.where("NOT inner")
        .alias("p")
        .join(alike.alias("s"), "cell")
        .where(boxes_overlap("p", "s"))
        .select(*keys, "n")
    )
    return whole.unionByName(partly).groupBy(*keys).agg(F.sum("n").alias("n_items"))


def scenes_near(scenes: DataFrame, parcels: DataFrame) -> DataFrame:
    """Scenes that may overlap a parcel, by the cells they are filed in.

    The cells near the parcels are held: a semi-join, by broadcast while they are few, keeps
    the scenes. A scene table that stores its ``cell`` is also read by ranges of it only.
    """
    side = layout.LEVELS[0]

    def snapped(column: str, up: int) -> Column:
        return ((F.floor(F.col(column) / side) + up) * side).alias(column)

    # Parcels in the same squares ask for the same cells.
    boxes = with_bounds(parcels).select(
        *(snapped(c, 0) for c in BOUNDS[:2]), *(snapped(c, 1) for c in BOUNDS[2:])
    )
    cells = hold(layout.cells_near(boxes.distinct()).select("cell").distinct(), "cells")
    if "cell" in scenes.columns:
        ranges = layout.key_ranges(cells, "cell", 2 * layout.AXIS_BITS + 4)
        scenes = scenes.where(layout.in_ranges(F.col("cell"), ranges))
    return with_cell(scenes).join(cells, "cell", "left_semi").select(*scenes.columns)


def distinct_footprints(scenes: DataFrame) -> DataFrame:
    """(rings, footprint_id) per distinct footprint.

    Scenes of one tile and orbit repeat their footprint, so the geometry tests run once
    per distinct footprint, not once per scene.
    """
    return scenes.groupBy("rings").agg(F.min("item_id").alias("footprint_id"))


SQUARE = ["level", "cx", "cy"]


def _footprints(footprints: DataFrame) -> DataFrame:
    return with_bounds(footprints.where(geometry.is_polygon("rings"))).withColumn(
        "own_level", layout.level_of(*map(F.col, BOUNDS))
    )


def _levels(own: DataFrame) -> Column:
    """The levels that occur, eleven at most, a row for each."""
    levels = sorted(r["own_level"] for r in own.select("own_level").distinct().collect())
    return F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))


def _slots(parcels: DataFrame, levels: Column) -> DataFrame:
    """Squares with parcels, and how many slots their counted number needs."""
    placed = layout.on_squares(with_bounds(parcels).select(*BOUNDS), levels)
    return placed.groupBy(*SQUARE).agg(F.ceil(F.count("*") / ROWS_PER_TASK).alias("slots"))


def _in_slots(own: DataFrame, slots: DataFrame) -> DataFrame:
    placed = layout.on_squares(own, F.col("own_level"))
    numbers = F.sequence(F.lit(0).cast("bigint"), F.col("slots") - 1)
    return placed.join(slots, SQUARE).withColumn("slot", F.explode(numbers)).drop("slots")


def footprints_in_slots(parcels: DataFrame, footprints: DataFrame) -> DataFrame:
    """A row per footprint, square of its own size, and slot of the parcels there."""
    own = _footprints(footprints)
    return _in_slots(own, _slots(parcels, _levels(own)))


def match_footprints(parcels: DataFrame, footprints: DataFrame) -> DataFrame:
    """(parcel_key, start, end, footprint_id) for footprints that intersect the parcel.

    An equi-join on squares. A footprint lies on squares of its own size, four at most however
    large it is; a parcel on those of each size that occurs. A square has as many slots as its
    counted parcels need: they are dealt over them, and its footprints go to each.
    """
    shape = {
        "edges": F.expr(geometry.edges("rings")),
        "starts": F.expr(geometry.ring_starts("rings")),
    }
    own = _footprints(footprints)
    levels = _levels(own)
    slots = hold(_slots(parcels, levels), "squares")
    left = layout.on_squares(
        with_bounds(parcels)
        .withColumns(shape)
        .select("parcel_key", "start", "end", "edges", "starts", *BOUNDS),
        levels,
    )
    left = left.join(slots, SQUARE).withColumn("slot", F.pmod(F.xxhash64("parcel_key"), "slots"))
    right = _in_slots(
        own.withColumns(shape).select("footprint_id", "edges", "starts", "own_level", *BOUNDS), slots
    )
    touch = geometry.intersects("p.edges", "p.starts", "s.edges", "s.starts")
    return (
        left.alias("p")
        .join(right.alias("s"), [*SQUARE, "slot"])
        .where(boxes_overlap("p", "s") & _first_shared_square())
        .where(touch)
        .select("parcel_key", "start", "end", "footprint_id")
    )


def by_month(matches: DataFrame) -> DataFrame:
    """One row per match and month of its date range.

    With the month in the join key, scenes outside the range never meet the parcel and a
    footprint that holds a large share of the scenes is spread over its months.
    """
    months = F.sequence(
        F.trunc("start", "month"), F.trunc("end", "month"), F.expr("interval 1 month")
    )
    return matches.where(F.col("start") <= F.col("end")).withColumn(
        "month", F.explode(months)
    )


def _in_range(matches: DataFrame, scenes: DataFrame, dealt: tuple[str, ...] = ()) -> DataFrame:
    dated = scenes.withColumn("month", F.trunc("utc_day", "month"))
    ranged, keys = by_month(matches), ["footprint_id", "month", *dealt]
    if dealt:
        tasks = int(matches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranged, dated = ranged.repartition(tasks, *keys), dated.repartition(tasks, *keys)
    # Merged: held matches are small as a file, but not with a row for each month.
    return ranged.hint("merge").join(dated, keys).where(
        F.col("utc_day").between(F.col("start"), F.col("end"))
    )


def _listed(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows of equal keys as lists of about ``LISTED``, dealt by a hash of the other columns."""
    rest = [c for c in rows.columns if c not in keys]
    lists = rows.groupBy(*keys).agg(F.ceil(F.count("*") / LISTED).alias("lists"))
    return (
        rows.join(lists, keys)
        .groupBy(*keys, F.pmod(F.xxhash64(*rest), "lists").alias("list"))
        .agg(F.collect_list(F.struct(*rest)).alias(name))
    )


def join_parcel_scene(matches: DataFrame, items: DataFrame) -> DataFrame:
    """Every (parcel, item) whose polygons intersect within the parcel's date range.

    Parcels of one footprint and range meet scenes of one footprint and day list by list, and
    pairs are listed last. The scenes of a list then follow each other once per parcel, so
    that the result, which is much larger than its input, compresses well where it is written.
    Lists are few bytes, by which AQE would give them to a handful of tasks: their number is
    fixed, and lists of scenes are dealt over slots, to each of which the parcels go.
    """
    slots = F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1)).cast("array<bigint>"))
    parcels = _listed(matches, ["footprint_id", "start", "end"], "parcels").withColumn("slot", slots)
    slot = F.pmod(F.xxhash64("utc_day", "list"), F.lit(DEALT))
    scenes = _listed(items, ["footprint_id", "utc_day"], "scenes").withColumn("slot", slot)
    near = _in_range(parcels.drop("list"), scenes.drop("list"), ("slot",)).select(
        "start", "end", "utc_day", "scenes", F.inline("parcels")
    )
    every = near.drop("scenes").columns
    return near.select(*every, F.inline("scenes"))


def parcel_days(matches: DataFrame, items: DataFrame) -> DataFrame:
    """The dates on which a parcel has items, without listing the items.

    One row per (parcel_key, solar_day, utc_day, footprint_id) with the number of items,
    and datetime, item_id, scale and offset of the first. Items are reduced to footprint
    days before they meet the parcels.
    """
    first = F.min(F.struct("datetime", "item_id", "scale", "offset"))
    footprint_days = (
        items.groupBy("footprint_id", "solar_day", "utc_day")
        .agg(F.count("*").alias("n_items"), first.alias("first"))
        .select("footprint_id", "solar_day", "utc_day", "n_items", "first.*")
    )
    return _in_range(matches, footprint_days).drop("month", "start", "end")


# --- parcels and cells -------------------------------------------------------------


def _rows_to_cells(rows: DataFrame, keys: list[str], carried: list[str]) -> DataFrame:
    """One row per cell from one row per grid row and its x_first and x_last.

    The rows are shuffled first: a very large parcel is filled by many tasks.
    """
    spread = rows.select(*keys, "y", "x_first", "x_last", *carried).repartition(*keys, "y")
    return spread.withColumn("x", F.explode(F.sequence("x_first", "x_last")))


def parcel_cells(
    parcels: DataFrame, grid: Grid, rings: str = "rings", carried: tuple[str, ...] = ()
) -> DataFrame:
    """(parcel_key[, epsg], y, x, carried) of the cells whose centre lies in the polygon.

    Scan conversion: the edges that cross a row of cells are found once per row, so a
    cell only counts crossings to its right. The clip is then an equi-join, and the polygon
    test runs once per cell instead of once per pixel and date.
    """
    keys = ["parcel_key"] + (["epsg"] if rings == "rings_utm" else [])
    res = grid.resolution
    rows = (
        with_bounds(parcels, rings)
        .withColumn("edges", F.expr(geometry.edges(rings)))
        .select(
            *keys,
            *carried,
            "edges",
            F.explode(
                F.sequence(F.floor(F.col("miny") / res) - 1, F.floor(F.col("maxy") / res) + 1)
            ).alias("y"),
        )
        .withColumn("crossings", F.expr(geometry.row_crossings("edges", grid.centre("y"))))
        .where(F.size("crossings") > 0)
        .withColumns(
            {
                "x_first": F.floor(F.array_min("crossings") / res) - 1,
                "x_last": F.floor(F.array_max("crossings") / res) + 1,
            }
        )
    )
    cells = _rows_to_cells(rows, keys, ["crossings", *carried])
    return cells.where(geometry.right_of("crossings", grid.centre("x"))).select(
        *keys, "y", "x", *carried
    )


def warped_cells(parcels: DataFrame, grid: Grid) -> DataFrame:
    """(parcel_key, epsg, src_y, src_x, y, x): where each cell of a parcel is stored.

    The parcel's grid lies in its own zone (``epsg`` and ``rings_utm``). In every zone that its
    scenes may be stored in (``zones``), a cell takes the stored cell that its centre falls in:
    back to longitude and latitude, and on to that zone. In its own zone it is the same cell.
    """
    res = grid.resolution
    cells = parcel_cells(parcels, grid, "rings_utm", ("zones",)).withColumn(
        "zone", F.explode("zones")
    )
    away = cells.where("zone <> epsg")
    placed = utm.add_unprojected(away, grid.centre("x"), grid.centre("y"), "epsg", "lon", "lat")
    moved = utm.add_projected(placed, "lon", "lat", "zone", "easting", "northing")
    names = ("parcel_key", F.col("zone").alias("epsg"))
    same = cells.where("zone = epsg")
    stored = [F.floor(F.col(c) / res) for c in ("northing", "easting")]
    # A generated row: join conditions on it are not pushed, written out in full, before the steps.
    moved = moved.select(*names, "y", "x", F.inline(F.array(F.struct(*stored))).alias("src_y", "src_x"))
    return same.select(*names, "y", "x", F.col("y").alias("src_y"), F.col("x").alias("src_x")).unionByName(moved)


def footprint_zones(items: DataFrame, footprints: DataFrame) -> DataFrame:
    """(footprint_id, zone): the zones in which scenes of a footprint are stored.

    Items say so by their ``epsg``. Of those that do not, every zone near the footprint counts.
    """
    near = with_bounds(footprints.where(geometry.is_polygon("rings"))).select(
        "footprint_id", F.explode(utm.zones_near(*map(F.col, BOUNDS))).alias("zone")
    )
    if "epsg" not in items.columns:
        return near
    known = items.where("epsg IS NOT NULL").select("footprint_id", F.col("epsg").cast("int").alias("zone"))
    silent = items.where("epsg IS NULL").select("footprint_id").distinct()
    return known.unionByName(near.join(silent, "footprint_id", "left_semi")).distinct()


def with_zones(parcels: DataFrame, matches: DataFrame, zones: DataFrame) -> DataFrame:
    """Add ``zones``: the parcel's own one and those that its footprints are stored in."""
    stored = (
        matches.select("parcel_key", "footprint_id")
        .distinct()
        .join(zones, "footprint_id")
        .groupBy("parcel_key")
        .agg(F.collect_set("zone").alias("found"))
    )
    own = F.array("epsg")
    return (
        parcels.join(stored, "parcel_key", "left")
        .withColumn("zones", F.array_union(own, F.coalesce("found", own)))
        .drop("found")
    )


def window_cells(parcels: DataFrame, grid: Grid, pad: float = 0.0) -> DataFrame:
    """(parcel_key, y, x) of the cells whose centre lies in the padded bounds."""
    res = grid.resolution
    box = with_bounds(parcels).select(
        "parcel_key",
        *[(F.col(c) - pad).alias(c) for c in BOUNDS[:2]],
        *[(F.col(c) + pad).alias(c) for c in BOUNDS[2:]],
    )
    rows = box.select(
        "*",
        (F.floor(F.col("minx") / res) - 1).alias("x_first"),
        (F.floor(F.col("maxx") / res) + 1).alias("x_last"),
        F.explode(
            F.sequence(F.floor(F.col("miny") / res) - 1, F.floor(F.col("maxy") / res) + 1)
        ).alias("y"),
    ).where(f"{grid.centre('y')} BETWEEN miny AND maxy")
    cells = _rows_to_cells(rows, ["parcel_key"], ["minx", "maxx"])
    return cells.where(f"{grid.centre('x')} BETWEEN minx AND maxx").select(
        "parcel_key", "y", "x"
    )


def cell_keys(pixels: DataFrame, cells: DataFrame) -> list[str]:
    """Columns the two frames share that identify a cell (of a parcel, of a zone).

    Cells that name footprints take the pixels of their scenes only.
    """
    return [
        c for c in ("parcel_key", "epsg", "footprint_id", "y", "x")
        if c in pixels.columns and c in cells.columns
    ]


def grid_boxes(parcels: DataFrame, rings: str = "rings") -> DataFrame:
    """([epsg,] minx, miny, maxx, maxy): a row per parcel, or per parcel and zone.

    The bounds are those of the ring in each zone, wider by a thousandth of their size:
    straight edges of one zone are slightly curved in another.
    """
    if rings != "rings_utm":
        return with_bounds(parcels, rings).select(*BOUNDS)
    projected = parcels.select("rings", F.explode("zones").alias("epsg")).select(
        "epsg", utm.project_rings("rings", "epsg").alias("rings_utm")
    )
    wide = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")) / 1000
    return with_bounds(projected, "rings_utm").select(
        "epsg",
        *((F.col(c) - wide).alias(c) for c in BOUNDS[:2]),
        *((F.col(c) + wide).alias(c) for c in BOUNDS[2:]),
    )


def total_extent(parcels: DataFrame, rings: str = "rings") -> tuple:
    """minx, miny, maxx, maxy over all parcels and zones: one row."""
    box = grid_boxes(parcels, rings)
    return tuple(box.agg(F.min("minx"), F.min("miny"), F.max("maxx"), F.max("maxy")).first())


def parcel_blocks(parcels: DataFrame, grid: Grid, rings: str = "rings") -> DataFrame:
    """Distinct ([epsg,] block_y, block_x, block_key) that the parcels reach, a cell wider."""
    box = grid_boxes(parcels, rings)
    zone = [c for c in ("epsg",) if c in box.columns]

    def span(low: str, high: str) -> Column:
        first, last = (F.floor(F.col(c) / grid.resolution) for c in (low, high))
        return F.explode(F.sequence(layout.block(first - 1), layout.block(last + 1)))

    placed = box.withColumn("block_x", span("minx", "maxx")).withColumn("block_y", span("miny", "maxy"))
    return layout.add_block_key(placed.select(*zone, "block_y", "block_x").distinct())


def in_blocks(pixels: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pixels in one of the blocks. A held block table is broadcast while it is small."""
    placed = layout.add_block(pixels)
    keys = [c for c in ("epsg", "block_y", "block_x") if c in blocks.columns]
    return placed.join(blocks.select(*keys), keys, "left_semi").select(*pixels.columns)


def clip_pixels(pixels: DataFrame, cells: DataFrame) -> DataFrame:
    """Pixels whose centre lies in a parcel, with that parcel's key.

    Of warped cells, y and x are then those of the parcel's grid, src_y and src_x the stored
    ones; a stored cell may serve several.
    """
    if "src_y" not in cells.columns:
        return pixels.join(cells, cell_keys(pixels, cells))
    stored = pixels.withColumnsRenamed({"y": "src_y", "x": "src_x"})
    keys = [c for c in cell_keys(pixels, cells) if c not in ("y", "x")]
    return stored.join(cells, [*keys, "src_y", "src_x"])


def cells_of_days(cells: DataFrame, days: DataFrame) -> DataFrame:
    """Add ``footprint_id``: a row per cell and footprint that the parcel has a day with.

    Merged: Catalyst sizes cells by the parcels' files, however many a parcel has, and once
    it has planned a broadcast it keeps it whatever size it measures.
    """
    reached = days.select("parcel_key", "footprint_id").distinct()
    return cells.hint("merge").join(reached, "parcel_key")


def pixels_of_items(
    pixels: DataFrame, items: DataFrame, cells: DataFrame
) -> DataFrame:
    """Pixels with their item's columns, without most of those that lie in none of the cells.

    Most pixels find no parcel, and they have many bands. Sieves look at their keys before the
    join with the items, and before that with the cells once the footprint is known.
    """
    stored = cells
    if "src_y" in cells.columns:
        stored = cells.drop("y", "x").withColumnsRenamed({"src_y": "y", "src_x": "x"})
    placed = sift(sift(pixels, items, ["item_id"]), stored, cell_keys(pixels, stored))
    of_items = placed.join(items, "item_id")
    return sift(of_items, stored, cell_keys(of_items, stored))


def window_pixels(
    pixels: DataFrame,
    parcels: DataFrame,
    items: DataFrame,
    days: DataFrame,
    grid: Grid,
    pad: float = 0.0,
) -> DataFrame:
    """Pixels of a parcel's items within its padded bounds (the raster read window).

    The items of a parcel are told by its footprint days, so parcel-item pairs, of which
    there can be more than pixels, are not listed.
    """
    cells = cells_of_days(window_cells(parcels, grid, pad), days)
    of_items = pixels_of_items(pixels, items.select("item_id", *DAY_KEYS[1:]), cells)
    near = clip_pixels(of_items, cells)
    return near.join(days.hint("merge"), DAY_KEYS, "left_semi").drop(*DAY_KEYS[1:])


def resample_nearest(
    fine: DataFrame, coarse: DataFrame, fine_grid: Grid, coarse_grid: Grid, bands: list[str]
) -> DataFrame:
    """Bring bands of a coarser grid to the cells of the fine one.

    Each fine cell takes the coarse cell that its centre falls in; without one the band
    is missing.
    """
    same = [
        c for c in ("parcel_key", "epsg", "item_id")
        if c in fine.columns and c in coarse.columns
    ]

    def coarse_cell(axis):
        stored = f"src_{axis}" if f"src_{axis}" in fine.columns else axis
        return F.floor(F.expr(fine_grid.centre(stored)) / coarse_grid.resolution)

    placed = fine.withColumns({"y_c": coarse_cell("y"), "x_c": coarse_cell("x")})
    source = coarse.select(
        *same, F.col("y").alias("y_c"), F.col("x").alias("x_c"), *bands
    )
    return placed.join(source, [*same, "y_c", "x_c"], "left").drop("y_c", "x_c")
