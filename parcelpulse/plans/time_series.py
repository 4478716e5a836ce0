"""The flagship plan: index time series per parcel."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.functions import geometry
from parcelpulse.functions.indices import add_indices, computable, mask_clear
from parcelpulse.operators import catalogue, clarity, faults, layout, mosaic, series, spatial
from parcelpulse.operators.sieve import sift
from parcelpulse.operators.spatial import DAY_KEYS
from parcelpulse.params import Params
from parcelpulse.schema import CLASS_BAND, Grid, bands_for
from parcelpulse.session import hold

ITEM_COLUMNS = ["item_id", "footprint_id", "solar_day", "utc_day", "item_seq"]
FOUND_COLUMNS = [
    "item_id", "datetime", "utc_day", "solar_day", "scale", "offset", "rings"
]
IDENTITY = [
    "item_id", "parcel_key", "epsg", "y", "x", "px_seq", "acq_day", "tile", "block_key"
]


def with_range(parcels: DataFrame, start=None, end=None) -> DataFrame:
    """Give every parcel row the run's dates, unless it has dates of its own."""
    if start is None and end is None:
        return parcels
    return parcels.withColumns(
        {"start": F.lit(start).cast("date"), "end": F.lit(end).cast("date")}
    )


@dataclass
class Search:
    """What the catalogue and the geometry say, before any pixel is read.

    The tables are held: several steps read them, and they are small beside the pixels.
    Holding the parcels also fixes their row keys.
    """

    parcels: DataFrame
    items: DataFrame  # one row per scene that some parcel needs
    days: DataFrame  # one row per parcel, footprint and day with items
    rings: str  # column that the pixel grid's cells are cut with
    faulty: DataFrame  # parcels that take no part, and why
    held: dict = field(default_factory=dict)

    @property
    def utm(self) -> bool:
        return self.rings == "rings_utm"

    def blocks(self, grid: Grid) -> DataFrame:
        """The blocks of the grid that parcels reach; both passes read the same table."""
        if grid not in self.held:
            reached = spatial.parcel_blocks(self.parcels, grid, self.rings)
            self.held[grid] = hold(reached, "blocks")
        return self.held[grid]

    def ranges(self, grid: Grid) -> list[tuple[int, int]]:
        """Ranges of keys that hold those blocks."""
        if (grid, "ranges") not in self.held:
            bits = 2 * layout.AXIS_BITS + 16
            self.held[grid, "ranges"] = layout.key_ranges(self.blocks(grid), "block_key", bits)
        return self.held[grid, "ranges"]

    def extent(self) -> tuple:
        """minx, miny, maxx, maxy of the parcels, over all zones: one row."""
        if "extent" not in self.held:
            self.held["extent"] = spatial.total_extent(self.parcels, self.rings)
        return self.held["extent"]

    def cells(self, grid: Grid) -> DataFrame:
        """The cells of each parcel; with zones, also where they are stored."""
        if self.utm:
            return spatial.warped_cells(self.parcels, grid)
        return spatial.parcel_cells(self.parcels, grid, self.rings)


def find_items(scenes: DataFrame, params: Params, start=None, end=None, parcels=None):
    """(items, footprints) of the catalogue search, near the parcels if they are given."""
    found = catalogue.search(scenes, params.collection, params.max_cloud, start, end)
    if parcels is not None:
        found = spatial.scenes_near(found, parcels)
    zone = [c for c in ("epsg",) if c in scenes.columns]
    held = hold(catalogue.with_days(found).select(*FOUND_COLUMNS, *zone), "found")
    # Held: while they are few, Catalyst broadcasts them and no scene is shuffled.
    footprints = hold(spatial.distinct_footprints(held), "footprints")
    return held.join(footprints, "rings").drop("rings"), footprints


def needed_items(items: DataFrame, days: DataFrame) -> DataFrame:
    """The scenes that some parcel needs on the given days.

    Pixels of all other scenes fall out at the first join, before anything is shuffled.
    """
    keys = ["footprint_id", "solar_day", "utc_day"]
    return items.join(days.select(*keys).distinct(), keys, "left_semi")


def run_dates(parcels: DataFrame) -> tuple:
    """First and last date over all parcels: one row."""
    return tuple(parcels.agg(F.min("start"), F.max("end")).first())


def search(
    parcels: DataFrame, scenes: DataFrame, params: Params, start=None, end=None, utm=False
) -> Search:
    judged = with_range(parcels, start, end).withColumn("reason", faults.row_fault())
    rows = hold(judged.withColumns(geometry.bounds("rings")), "parcels")
    parcels = rows.where("reason IS NULL").drop("reason")
    items, footprints = find_items(scenes, params, *run_dates(parcels), parcels)
    matches = spatial.match_footprints(parcels, footprints)
    if utm:
        matches = hold(matches, "matches")
        zones = spatial.footprint_zones(items, footprints)
        own = spatial.in_batch_utm(parcels, params.batch_size_deg)
        parcels = hold(spatial.with_zones(own, matches, zones), "zoned-parcels")
    days = hold(spatial.parcel_days(matches, items), "days")
    items = hold(catalogue.with_item_seq(needed_items(items, days)), "items")
    rings = "rings_utm" if utm else "rings"
    return Search(parcels, items, days, rings, faults.faulty(rows))


def prune_pixels(
    pixels: DataFrame, found: Search, days: DataFrame, grid: Grid
) -> DataFrame:
    """Restrict the pixels to the parcels' blocks and to the given days.

    A table that stores its block key is read by ranges of it: they skip tiles, files and row
    groups between the parcels. Of other tables the parcels' extent is read. The days are at
    most the calendar days of the run. Pixels of blocks without a parcel fall out before
    the first shuffle.
    """
    if found.utm and "epsg" not in pixels.columns:
        raise ValueError("with utm the pixels name the zone they are stored in, as epsg")
    if "block_key" in pixels.columns and found.utm == ("epsg" in pixels.columns):
        ranges = found.ranges(grid)
        if "tile" in pixels.columns:
            bits = 2 * layout.TILE_BITS
            tiles = [(low >> bits, high >> bits) for low, high in ranges]
            pixels = pixels.where(layout.in_ranges(F.col("tile"), tiles))
        pixels = pixels.where(layout.in_ranges(F.col("block_key"), ranges))
    elif None not in found.extent():
        left, low, right, high = (math.floor(v / grid.resolution) for v in found.extent())
        pixels = pixels.where(
            F.col("x").between(left - 1, right + 1) & F.col("y").between(low - 1, high + 1)
        )
    if "acq_day" in pixels.columns:
        dates = [row["utc_day"] for row in days.select("utc_day").distinct().collect()]
        pixels = pixels.where(F.col("acq_day").isin(dates))
    return spatial.in_blocks(pixels, found.blocks(grid)).drop("tile", "block_key")


def matched_pixels(
    pixels: DataFrame,
    cells: DataFrame,
    items: DataFrame,
    days: DataFrame,
    few: bool = False,
    scaled: DataFrame | None = None,
) -> DataFrame:
    """Pixels of the items, inside a parcel, on one of that parcel's days.

    All three are equi-joins on keys that no single parcel, scene or day dominates, except
    the first, which Catalyst broadcasts while the held scene table is below the threshold.
    Sieves leave out most pixels that the first two would drop, and a cell meets the pixels
    of its parcel's footprints only. With ``few`` days, of those that have items, one more
    goes before the last. The last two are merged: cells and the days of all parcels, which
    compress well, would be broadcast by the size of their files. ``scaled`` are the days with
    columns that the pixels take from them.
    """
    reached = spatial.cells_of_days(cells, days)
    of_items = spatial.pixels_of_items(pixels, items, reached)
    clipped = spatial.clip_pixels(of_items, reached.hint("merge"))
    if few:
        clipped = sift(clipped, days, DAY_KEYS)
    last = days if scaled is None else scaled
    return clipped.join(last.hint("merge"), DAY_KEYS)


def sample_columns(pixels: DataFrame, bands: list[str]) -> DataFrame:
    """Only the identity columns present and the bands asked for."""
    return pixels.select(*[c for c in IDENTITY if c in pixels.columns], *bands)


def class_mosaic(pixels: DataFrame, found: Search, grid: Grid) -> DataFrame:
    """Class band per parcel, solar day and cell inside the polygon."""
    px = matched_pixels(
        sample_columns(prune_pixels(pixels, found, found.days, grid), [CLASS_BAND]),
        found.cells(grid),
        found.items.select(*ITEM_COLUMNS),
        found.days.select(*DAY_KEYS),
    )
    return mosaic.solar_day_mosaic(px, [CLASS_BAND])


def usable_parcel_days(
    pixels: DataFrame,
    found: Search,
    params: Params,
    grid: Grid,
    classes: DataFrame | None = None,
    class_grid: Grid | None = None,
) -> DataFrame:
    """(parcel_key, solar_day, clear_ratio) of the days that pass the clear-sky test.

    Reads the class table on its own grid when there is one, else the pixels' class band.
    """
    source = pixels if classes is None else classes
    ratios = clarity.clear_ratio(class_mosaic(source, found, class_grid or grid))
    return clarity.usable_days(ratios, params.min_clear)


def spectral_cube(
    pixels: DataFrame,
    found: Search,
    days: DataFrame,
    grid: Grid,
    bands: list[str],
    per_item_scale: bool = False,
    classes: DataFrame | None = None,
    class_grid: Grid | None = None,
) -> DataFrame:
    """Scaled bands and raw class per parcel, solar day and cell, on the given days.

    The scale is that of the parcel's first item on those days, or each item's own. It
    rides on the small day or item table, so the pixels need no join for it. The class of a
    coarser table is looked up for the matched pixels only.
    """
    items = needed_items(found.items, days)
    wanted, scaled = days.select(*DAY_KEYS), None
    scene_columns = ITEM_COLUMNS
    if per_item_scale:
        scene_columns = [*ITEM_COLUMNS, "scale", "offset"]
    else:
        scaled = wanted.hint("merge").join(mosaic.first_item_scale(days), "parcel_key")
    own = [CLASS_BAND] if classes is None else []
    px = matched_pixels(
        sample_columns(prune_pixels(pixels, found, days, grid), [*bands, *own]),
        found.cells(grid),
        items.select(*scene_columns),
        wanted,
        few=True,
        scaled=scaled,
    )
    if classes is not None:
        coarse = sample_columns(prune_pixels(classes, found, days, class_grid), [CLASS_BAND])
        coarse = sift(coarse, items, ["item_id"])
        px = spatial.resample_nearest(px, coarse, grid, class_grid, [CLASS_BAND])
    return mosaic.reflectance_mosaic(px, bands, [CLASS_BAND])


def masked_cube(
    pixels: DataFrame,
    found: Search,
    usable: DataFrame,
    params: Params,
    grid: Grid,
    classes: DataFrame | None = None,
    class_grid: Grid | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(cube, days): masked bands and indices per cell on the usable days, and those days.

    This is the second of two passes over the pixels: the first, narrow one over the class
    band has found the days worth reading, and only their pixels take part here. The days
    are held, since the join, the scale and the time stamps all need them.
    """
    bands = bands_for(params.indices)
    days = hold(
        clarity.keep_usable(found.days, usable, params.utc_day_match), "usable-days"
    )
    cube = spectral_cube(
        pixels, found, days, grid, bands, params.per_item_scale, classes, class_grid
    )
    masked = add_indices(mask_clear(cube, bands), params.indices)
    indices = computable(masked, params.indices)
    return series.assemble_cube(masked, bands, indices, mosaic.CELL_DAY), days


def finish_series(
    cube: DataFrame, days: DataFrame, parcels: DataFrame, params: Params
) -> DataFrame:
    """Means per parcel and date with time stamp and provenance, empty dates dropped."""
    bands = bands_for(params.indices)
    indices = [c for c in cube.columns if c in params.indices]
    means = series.spatial_mean(cube, bands + indices)
    kept = series.drop_all_null(means, params.indices)
    return series.stamp(kept, days, parcels).select(
        "time", *bands, *indices, *series.PROVENANCE, "parcel_key", "solar_day"
    )


def parcel_time_series(
    parcels: DataFrame,
    scenes: DataFrame,
    pixels: DataFrame,
    indices: list[str],
    *,
    collection: str,
    grid: Grid,
    start=None,
    end=None,
    classes: DataFrame | None = None,
    class_grid: Grid | None = None,
    utm: bool = False,
    **options,
) -> DataFrame:
    """Mean of every band and index per parcel and date.

    Runs the search and the clear-sky pass, and returns the spectral pass as a lazy plan.
    Without start and end the parcels' own date columns apply. ``classes`` is an optional
    class table on a coarser grid. With ``utm`` the grid is in metres in the UTM zone of
    the parcel's batch; pixels carry the ``epsg`` they are stored in, and those of other zones
    are brought to that grid by nearest cell. Further options are those of Params.
    """
    params = Params(indices=indices, collection=collection, **options)
    found = search(parcels, scenes, params, start, end, utm)
    usable = usable_parcel_days(pixels, found, params, grid, classes, class_grid)
    cube, days = masked_cube(pixels, found, usable, params, grid, classes, class_grid)
    return finish_series(cube, days, found.parcels, params)
