"""One registered query per operator, over the whole derived tables.

Every callable takes (spark, sf_dir). Means and indices are rounded to nine decimals, far
inside double precision, so that the order of float sums does not show.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpulse.checks import fixtures as fx
from parcelpulse.functions import dates, geometry
from parcelpulse.functions import indices as ix
from parcelpulse.operators import catalogue, clarity, mosaic, series, spatial
from parcelpulse.params import Params
from parcelpulse.plans import rejected as rejected_plan
from parcelpulse.plans import run as run_plan
from parcelpulse.plans import time_series as ts
from parcelpulse.schema import INDICES, SPECTRAL_BANDS, bands_for
from parcelpulse.session import hold, new_folder
from parcelpulse.sources import parcels as parcel_source
from parcelpulse.sources import pixels as pixel_source
from parcelpulse.sources import results
from parcelpulse.sources import scenes as scene_source

ALL = list(INDICES)
SAMPLE = ["parcel_key", "item_id", "y", "x", "px_seq"]
PARAMS = Params(indices=ALL, collection=fx.COLLECTION)
BATCH_DEG = 2.0


def rounded(df: DataFrame, columns, places: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def day(column) -> Column:
    return F.col(column).cast("string")


def stamp(column) -> Column:
    return F.col(column).cast("string")


def found_items(spark, sf, start=fx.START, end=fx.END) -> DataFrame:
    """Searched scenes with days and order, before any geometry."""
    found = catalogue.search(fx.scenes(spark, sf), fx.COLLECTION, start=start, end=end)
    return catalogue.with_item_seq(
        catalogue.with_days(found).select(
            "item_id", "datetime", "utc_day", "solar_day", "scale", "offset"
        )
    )


def full_search(spark, sf, start=fx.START, end=fx.END, params=PARAMS) -> ts.Search:
    return ts.search(fx.parcels(spark, sf), fx.scenes(spark, sf), params, start, end)


def matched_footprints(spark, sf, parcels=None):
    """(matches, items with footprint_id) of the parcel-scene join."""
    parcels = fx.parcels(spark, sf) if parcels is None else parcels
    ranged = ts.with_range(parcels, fx.START, fx.END)
    items, footprints = ts.find_items(fx.scenes(spark, sf), PARAMS, fx.START, fx.END)
    return spatial.match_footprints(ranged, footprints), items


def clipped(spark, sf, bands, items) -> DataFrame:
    px = ts.sample_columns(fx.pixels(spark, sf), bands).join(items, "item_id")
    return spatial.clip_pixels(px, spatial.parcel_cells(fx.parcels(spark, sf), fx.GRID))


def clear_ratios(spark, sf) -> DataFrame:
    items = found_items(spark, sf).select("item_id", "solar_day", "item_seq")
    px = clipped(spark, sf, ["scl"], items)
    return clarity.clear_ratio(mosaic.solar_day_mosaic(px, ["scl"]))


def show_series(df: DataFrame, indices) -> DataFrame:
    """Comparable form of a time series."""
    numbers = [c for c in df.columns if c in SPECTRAL_BANDS or c in indices]
    return rounded(df, numbers).select(
        stamp("time").alias("time"), *numbers, *series.PROVENANCE
    )


def flagship(spark, sf, indices=None, parcels=None, **options) -> DataFrame:
    return ts.parcel_time_series(
        fx.parcels(spark, sf) if parcels is None else parcels,
        fx.scenes(spark, sf),
        fx.pixels(spark, sf),
        indices or ALL,
        collection=fx.COLLECTION,
        grid=fx.GRID,
        start=fx.START,
        end=fx.END,
        **options,
    )


# --- sources and sinks -------------------------------------------------------------

FOLDERS = [
    "1996-01-01_1996-12-31",
    "1997-01-01_1998-12-31",
    "_1996-01-01_1996-12-31",
    "extra_1996-01-01_1996-12-31",
    "north_south",
    "1999-01-01_1999-06-30",
]


def write_parcel_folders(parcels: DataFrame, root: str, folder: Column, names) -> None:
    """Lay parcel files out as root/<date range>/<source file>."""
    rows = parcels.select(
        folder.alias("folder"),
        "source_file",
        F.col("parcel_id").alias("ID_PARCEL"),
        F.lit(None).cast("int").alias("epsg"),
        "rings",
    )
    for name in names:
        for source in ("a.parquet", "b.parquet"):
            rows.where((F.col("folder") == name) & (F.col("source_file") == source)).select(
                "ID_PARCEL", "epsg", "rings"
            ).write.parquet(f"{root}/{name}/{source}")


def parcel_folders(spark, sf) -> str:
    root = new_folder(spark, "input")
    key = F.col("parcel_key") % len(FOLDERS)
    folder = F.element_at(F.array(*map(F.lit, FOLDERS)), (key + 1).cast("int"))
    write_parcel_folders(fx.parcels(spark, sf), root, folder, FOLDERS)
    return root


def scan_date_folders(spark, sf):
    raw = parcel_source.scan_date_folders(spark, parcel_folders(spark, sf))
    return raw.select(
        F.col("ID_PARCEL").alias("parcel_id"),
        "source_file",
        "date_range",
        day("start").alias("start_day"),
        day("end").alias("end_day"),
    )


def scan_parcels(spark, sf):
    read = parcel_source.read_parcels(spark, parcel_folders(spark, sf))
    return rounded(
        spatial.with_bounds(read).select(
            "parcel_id",
            "source_file",
            "date_range",
            F.col("epsg").cast("long").alias("epsg"),
            F.size(F.flatten("rings")).cast("long").alias("n_vertices"),
            *geometry.BOUNDS,
        ),
        geometry.BOUNDS,
    )


def scan_parcels_any_id(spark, sf):
    """Files of one run whose ids are long, int and text."""
    root = new_folder(spark, "input")
    parcels = fx.parcels(spark, sf)
    for k, (start, end) in enumerate(fx.RANGES):
        rows = parcels.where(F.col("parcel_key") % 3 == k)
        for source, id_type in (("a.parquet", ("long", "int", "string")[k]), ("b.parquet", "string")):
            rows.where(F.col("source_file") == source).select(
                F.col("parcel_id").cast(id_type).alias("ID_PARCEL"), "rings"
            ).write.parquet(f"{root}/{start}_{end}/{source}")
    read = parcel_source.read_parcels(spark, root)
    return read.select("parcel_id", "source_file", "date_range")


def scan_scenes(spark, sf):
    """Items go out as STAC JSON lines and come back as the flat scene table."""
    path = new_folder(spark, "catalogue")
    scenes = fx.scenes(spark, sf)
    coordinates = F.transform(
        "rings", lambda ring: F.transform(ring, lambda v: F.array(v["x"], v["y"]))
    )
    when = F.concat(F.translate(stamp("datetime"), " ", "T"), F.lit("Z"))
    cloud = F.struct(when.alias("datetime"), F.col("cloud_cover").alias("eo:cloud_cover"))
    scenes.select(
        F.to_json(
            F.struct(
                F.col("item_id").cast("string").alias("id"),
                "collection",
                F.when(
                    F.col("rings").isNotNull(),
                    F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates")),
                ).alias("geometry"),
                cloud.alias("properties"),
                F.from_json(
                    "assets",
                    "struct<red:struct<`raster:bands`:"
                    "array<struct<scale:double,offset:double>>>>",
                ).alias("assets"),
            )
        )
    ).write.text(path)
    read = scene_source.read_scenes(spark, path, "json")
    box = geometry.bounds("rings")
    return read.select(
        "item_id",
        "collection",
        stamp("datetime").alias("acquired"),
        F.round(box["minx"], 6).alias("minx"),
        F.round(box["maxy"], 6).alias("maxy"),
        "cloud_cover",
        "scale",
        "offset",
    )


def scan_pixels(spark, sf):
    path = new_folder(spark, "pixels")
    days = fx.scenes(spark, sf).select("item_id", F.to_date("datetime").alias("acq_day"))
    pixel_source.write_pixels(fx.pixels(spark, sf).join(days, "item_id"), path)
    read = pixel_source.read_pixels(spark, path, bands_for(["NBR"]))
    return read.withColumn("acq_day", day("acq_day")).drop("tile", "block_key")


def write_time_series(spark, sf):
    path = new_folder(spark, "series")
    results.write_series(flagship(spark, sf), path)
    return show_series(results.read_series(spark, path), ALL)


def scan_time_series(spark, sf):
    path = new_folder(spark, "series")
    results.write_series(flagship(spark, sf, ["NDVI", "NDWI"]), path)
    read = results.read_series(spark, path)
    return rounded(
        read.groupBy("parcel_id").agg(
            F.count("*").alias("n_points"),
            F.min("NDVI").alias("min_ndvi"),
            F.max("NDWI").alias("max_ndwi"),
        ),
        ["min_ndvi", "max_ndwi"],
    )


def stamped_cube(spark, sf, params):
    found = full_search(spark, sf, params=params)
    days_ok = usable(spark, sf, found, params)
    cube, days = ts.masked_cube(fx.pixels(spark, sf), found, days_ok, params, fx.GRID)
    return series.stamp(cube, days, found.parcels)


def write_pixel_cube(spark, sf):
    path = new_folder(spark, "cube")
    params = Params(indices=["NDVI", "NBR"], collection=fx.COLLECTION)
    results.write_cube(stamped_cube(spark, sf, params), path)
    bands = bands_for(params.indices)
    read = results.read_cube(spark, path)
    return rounded(read, bands + params.indices).select(
        stamp("time").alias("time"),
        "parcel_key",
        "y",
        "x",
        *bands,
        *params.indices,
        *series.PROVENANCE,
    )


def cloudy_rejects(spark, sf) -> DataFrame:
    """The rejected parcels' cube where every third parcel is under clouds."""
    return rejected_plan.rejected_cube(
        fx.parcels(spark, sf),
        fx.scenes(spark, sf),
        fx.cloudy_pixels(spark, sf),
        collection=fx.COLLECTION,
        grid=fx.GRID,
        start=fx.START,
        end=fx.END,
    )


def write_rejected_cube(spark, sf):
    path = new_folder(spark, "rejected")
    cube = cloudy_rejects(spark, sf)
    results.write_cube(cube, path, by_parcel=True)
    # With its schema the many folders are listed once, not twice.
    return rounded(results.read_cube(spark, path, schema=cube.schema), ["red", "nir"]).select(
        stamp("time").alias("time"),
        "parcel_key",
        "y",
        "x",
        "red",
        "nir",
        F.col("scl").cast("long").alias("scl"),
        *series.PROVENANCE,
    )


def scan_cube(spark, sf):
    path = new_folder(spark, "cube")
    results.write_cube(cloudy_rejects(spark, sf), path)
    read = results.read_cube(spark, path)
    return read.groupBy("date_range", "parcel_id").agg(
        F.count_distinct("time").alias("n_dates"), F.count("*").alias("n_cells")
    )


# --- filters -----------------------------------------------------------------------


def filter_collection(spark, sf):
    kept = catalogue.filter_collection(fx.scenes(spark, sf), fx.COLLECTION)
    return kept.select("item_id", "collection")


def filter_bbox(spark, sf):
    """Scenes whose bounds overlap each batch's total bounds."""
    boxes = spatial.batch_bounds(spatial.with_batch(fx.parcels(spark, sf), BATCH_DEG))
    return spatial.scenes_in_boxes(fx.scenes(spark, sf), boxes, spatial.BATCH)


def filter_date_range(spark, sf):
    kept = catalogue.filter_date_range(fx.scenes(spark, sf), fx.START, fx.END)
    return kept.select("item_id", stamp("datetime").alias("acquired"))


def filter_cloud_cover(spark, sf):
    return catalogue.filter_cloud_cover(fx.scenes(spark, sf)).select("item_id", "cloud_cover")


def filter_valid_items(spark, sf):
    kept = catalogue.filter_valid_items(fx.scenes(spark, sf))
    return kept.select("item_id", stamp("datetime").alias("acquired"))


def mask_clear(spark, sf):
    masked = ix.mask_clear(fx.pixels(spark, sf), SPECTRAL_BANDS)
    return masked.select(*SAMPLE, *[F.col(b).cast("double").alias(b) for b in SPECTRAL_BANDS])


def mask_nodata(spark, sf):
    share = ix.clear_share()
    return (
        fx.pixels(spark, sf)
        .groupBy("parcel_key", "y", "x")
        .agg(F.count(share).alias("n_valid"), F.sum(share).cast("long").alias("n_clear"))
    )


def raw_item_means(spark, sf, indices) -> DataFrame:
    """Masked means per parcel and item, also where no pixel is clear."""
    bands = bands_for(indices)
    px = ix.mask_clear(fx.pixels(spark, sf), bands)
    return series.spatial_mean(
        ix.add_indices(px, indices), indices, ["parcel_key", "item_id"]
    )


def drop_all_null(spark, sf):
    pair = ["NDVI", "NBR"]
    kept = series.drop_all_null(raw_item_means(spark, sf, pair), pair)
    return rounded(kept, pair)


# --- projections -------------------------------------------------------------------


def scaled_pixels(spark, sf, bands) -> DataFrame:
    scales = fx.scenes(spark, sf).select("item_id", "scale", "offset")
    px = ts.sample_columns(fx.pixels(spark, sf), [*bands, "scl"])
    return ix.scale_bands(px.join(scales, "item_id"), bands)


def scale_bands(spark, sf):
    df = scaled_pixels(spark, sf, list(SPECTRAL_BANDS))
    return rounded(df, SPECTRAL_BANDS).drop("scale", "offset")


def bands_for_indices(spark, sf):
    """What a request for NDBI and NDRE2 loads."""
    bands = bands_for(["NDRE2", "NDBI"])
    return ts.sample_columns(fx.pixels(spark, sf), [*bands, "scl"])


def stamp_provenance(spark, sf):
    per_parcel = fx.pixels(spark, sf).groupBy("parcel_key").agg(F.count("*").alias("n"))
    return series.stamp_provenance(per_parcel, fx.parcels(spark, sf))


def project_indices(spark, sf):
    """All indices requested of a table without swir16 and rededge3."""
    px = fx.pixels(spark, sf).drop("swir16", "rededge3")
    full = ix.add_indices(px, ALL)
    found = ix.computable(px, ALL)
    return rounded(full, found).select(*SAMPLE, *found)


def assemble_cube(spark, sf):
    wanted = ["SAVI", "NDRE1"]
    bands = bands_for(wanted)
    px = ts.sample_columns(fx.pixels(spark, sf), [*bands, "scl"])
    full = ix.add_indices(px, wanted)
    return rounded(series.assemble_cube(full, bands, wanted, SAMPLE), wanted)


def project_series(spark, sf):
    lines = series.project_series(flagship(spark, sf, ["NDVI"]))
    return rounded(lines, ["NDVI"]).withColumn("time", stamp("time"))


# --- scalar functions --------------------------------------------------------------


def index_query(name):
    def query(spark, sf):
        index = INDICES[name]
        px = scaled_pixels(spark, sf, list(index.bands))
        return rounded(ix.add_indices(px, [name]), [name]).select(*SAMPLE, name)

    return query


def ranged_parcels(spark, sf) -> DataFrame:
    """First and last shipping day per supplier as a date range."""
    return (
        fx.table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("parcel_key"))
        .agg(
            F.min("l_shipdate").cast("date").alias("start"),
            F.max("l_shipdate").cast("date").alias("end"),
        )
    )


def split_date_range(spark, sf):
    return dates.split_date_range(ranged_parcels(spark, sf)).select(
        "parcel_key",
        "chunk_idx",
        day("chunk_start").alias("chunk_start"),
        day("chunk_end").alias("chunk_end"),
    )


def batch_key(spark, sf):
    return fx.parcels(spark, sf).select(
        "parcel_key",
        geometry.batch_key("rings", 0.5).alias("half_degree"),
        geometry.batch_key("rings", BATCH_DEG).alias("two_degrees"),
    )


def ring_centroid(spark, sf):
    centre = F.expr(geometry.centroid("rings"))
    return fx.parcels(spark, sf).select(
        "parcel_key",
        F.round(centre["x"], 9).alias("cx"),
        F.round(centre["y"], 9).alias("cy"),
    )


def ring_bounds(spark, sf):
    return spatial.with_bounds(fx.parcels(spark, sf)).select("parcel_key", *geometry.BOUNDS)


def utm_zone(spark, sf):
    bounds = spatial.batch_bounds(spatial.with_batch(fx.parcels(spark, sf), BATCH_DEG))
    return spatial.batch_epsg(bounds).select(
        *spatial.BATCH, F.col("epsg").cast("long").alias("epsg")
    )


def project_utm(spark, sf):
    projected = spatial.in_batch_utm(fx.parcels(spark, sf), BATCH_DEG)
    return projected.select(
        "parcel_key",
        F.col("epsg").cast("long").alias("epsg"),
        F.explode("rings_utm").alias("ring"),
    ).select("parcel_key", "epsg", F.posexplode("ring").alias("seq", "v")).select(
        "parcel_key",
        "epsg",
        F.col("seq").cast("long").alias("seq"),
        F.round("v.x", 4).alias("easting"),
        F.round("v.y", 4).alias("northing"),
    )


def utc_day(spark, sf):
    return fx.scenes(spark, sf).select(
        "item_id", dates.utc_day(F.col("datetime")).alias("day")
    )


def solar_day(spark, sf):
    kept = catalogue.filter_valid_items(fx.scenes(spark, sf))
    return catalogue.with_days(kept).select("item_id", day("solar_day").alias("solar_day"))


def item_scale(spark, sf):
    scale, offset = catalogue.item_scale(F.col("assets"))
    return fx.scenes(spark, sf).select(
        "item_id", scale.alias("scale"), offset.alias("offset")
    )


def format_date_range(spark, sf):
    return ranged_parcels(spark, sf).select(
        "parcel_key",
        dates.format_date_range(F.col("start"), F.col("end")).alias("date_range"),
    )


# --- joins -------------------------------------------------------------------------


def join_parcel_scene(spark, sf):
    matches, items = matched_footprints(spark, sf)
    scenes = items.select("footprint_id", "utc_day", "item_id")
    return spatial.join_parcel_scene(matches, scenes).select("parcel_key", "item_id")


def join_parcel_pixel(spark, sf):
    """Shared-grid pixels of a parcel's items within its padded bounds."""
    matches, items = matched_footprints(spark, sf)
    days = spatial.parcel_days(matches, items)
    px = fx.pixels(spark, sf).select("item_id", "y", "x", "px_seq", "scl")
    return spatial.window_pixels(
        px, fx.parcels(spark, sf), items, days, fx.GRID, pad=fx.GRID.resolution / 4
    )


def clip_pixels(spark, sf):
    px = fx.pixels(spark, sf).select("item_id", "y", "x", "px_seq", "red", "scl")
    return spatial.clip_pixels(px, spatial.parcel_cells(fx.parcels(spark, sf), fx.GRID))


def usable(spark, sf, found, params=PARAMS):
    return ts.usable_parcel_days(fx.pixels(spark, sf), found, params, fx.GRID)


def semi_join_usable_days(spark, sf):
    """Per parcel and usable day: the number of items kept."""
    found = full_search(spark, sf)
    kept = clarity.keep_usable(found.days, usable(spark, sf, found))
    return (
        kept.groupBy("parcel_key", "solar_day")
        .agg(F.sum("n_items").alias("n_items"))
        .withColumn("solar_day", day("solar_day"))
    )


def semi_join_utc_days(spark, sf):
    """The same with items matched by UTC day."""
    found = full_search(spark, sf)
    kept = clarity.keep_usable(found.days, usable(spark, sf, found), utc_day_match=True)
    return (
        kept.groupBy("parcel_key", "utc_day")
        .agg(F.sum("n_items").alias("n_items"))
        .withColumn("utc_day", day("utc_day"))
    )


def anti_join_no_scene(spark, sf):
    parcels = fx.far_parcels(spark, sf)
    matches, items = matched_footprints(spark, sf, parcels)
    days = spatial.parcel_days(matches, items)
    return clarity.without_scene(parcels, days).select(
        "parcel_key", *series.PROVENANCE
    )


def anti_join_rejected(spark, sf):
    found = full_search(spark, sf)
    days_ok = ts.usable_parcel_days(fx.cloudy_pixels(spark, sf), found, PARAMS, fx.GRID)
    out = clarity.rejected(found.parcels, found.days, days_ok)
    return out.select("parcel_key", *series.PROVENANCE)


def join_item_scale(spark, sf):
    """Every pixel scaled by its parcel's first item."""
    matches, items = matched_footprints(spark, sf)
    scales = mosaic.first_item_scale(spatial.parcel_days(matches, items))
    px = ts.sample_columns(fx.pixels(spark, sf), ["red", "nir", "scl"])
    return rounded(
        ix.scale_bands(px.join(scales, "parcel_key"), ["red", "nir"]), ["red", "nir"]
    ).drop("scale", "offset")


def resample_nearest(spark, sf):
    fine = fx.pixels(spark, sf).select(*SAMPLE)
    coarse = fx.coarse_classes(spark, sf)
    return spatial.resample_nearest(fine, coarse, fx.GRID, fx.COARSE_GRID, ["scl"])


# --- aggregations ------------------------------------------------------------------


def clear_ratio(spark, sf):
    ratios = rounded(clear_ratios(spark, sf), ["clear_ratio"])
    return ratios.withColumn("solar_day", day("solar_day"))


def usable_days(spark, sf):
    kept = clarity.usable_days(clear_ratios(spark, sf))
    return rounded(kept, ["clear_ratio"]).withColumn("solar_day", day("solar_day"))


def spatial_mean(spark, sf):
    """Means of raw bands and indices per parcel and item, over clear pixels."""
    px = ix.add_indices(ix.mask_clear(fx.pixels(spark, sf), SPECTRAL_BANDS), ALL)
    columns = [*SPECTRAL_BANDS, *ALL]
    return rounded(series.spatial_mean(px, columns, ["parcel_key", "item_id"]), columns)


def batch_bounds(spark, sf):
    batched = spatial.with_batch(fx.parcels(spark, sf), BATCH_DEG)
    return spatial.batch_bounds(batched).drop("n_parcels")


def batch_group(spark, sf):
    """Parcels per batch, and batches per file."""
    batched = spatial.with_batch(fx.parcels(spark, sf), BATCH_DEG)
    sizes = spatial.batch_bounds(batched).select(*spatial.BATCH, "n_parcels")
    per_file = sizes.groupBy("source_file", "date_range").agg(
        F.count("*").alias("n_batches")
    )
    return sizes.join(per_file, ["source_file", "date_range"])


def clear_summary(spark, sf):
    found = full_search(spark, sf)
    ratios = clarity.clear_ratio(ts.class_mosaic(fx.pixels(spark, sf), found, fx.GRID))
    return rounded(
        clarity.clear_summary(ratios, found.days), ["max_ratio", "mean_usable_ratio"]
    )


def solar_day_mosaic(spark, sf):
    items = found_items(spark, sf).select("item_id", "solar_day", "item_seq")
    px = fx.pixels(spark, sf).join(items, "item_id")
    merged = mosaic.solar_day_mosaic(px, [*SPECTRAL_BANDS, "scl"])
    return merged.withColumn("solar_day", day("solar_day"))


def first_item_scale(spark, sf):
    matches, items = matched_footprints(spark, sf)
    return mosaic.first_item_scale(spatial.parcel_days(matches, items))


def run_counters(spark, sf):
    """Counters of a run in which the parcels of suppliers in debt have no polygon."""
    debt = fx.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("parcel_key"), (F.col("s_acctbal") < 0).alias("debt")
    )
    parcels = (
        fx.parcels(spark, sf)
        .join(debt, "parcel_key")
        .withColumn("rings", F.when(~F.col("debt"), F.col("rings")))
        .drop("debt")
    )
    batched = spatial.with_batch(parcels, BATCH_DEG)
    boxes = spatial.batch_bounds(spatial.drop_invalid_parcels(batched))
    items = spatial.count_in_boxes(
        catalogue.search(fx.scenes(spark, sf), fx.COLLECTION, start=fx.START, end=fx.END),
        boxes,
        spatial.BATCH,
    )
    points = flagship(spark, sf, ["NDVI"], parcels=parcels)
    return series.run_counters(batched, items, points)


# --- set operations ----------------------------------------------------------------


def union_chunks(spark, sf):
    chunks = catalogue.union_chunks(fx.scenes(spark, sf), fx.START, fx.END)
    return chunks.select("item_id", "chunk_idx")


def concat_results(spark, sf):
    """A series with NDVI and one with NBR, stacked by column name."""
    frames = [
        raw_item_means(spark, sf, [name]).withColumn("part", F.lit(name))
        for name in ("NDVI", "NBR")
    ]
    return rounded(series.concat_results(frames), ["NDVI", "NBR"])


# --- whole runs --------------------------------------------------------------------


def parcel_time_series(spark, sf):
    return show_series(flagship(spark, sf), ALL)


def time_series_per_item_scale(spark, sf):
    return show_series(flagship(spark, sf, ["NDVI"], per_item_scale=True), ["NDVI"])


def time_series_shared_grid(spark, sf):
    """Pixels that name no parcel: their place on the grid decides."""
    df = ts.parcel_time_series(
        fx.parcels(spark, sf),
        fx.scenes(spark, sf),
        fx.pixels(spark, sf).drop("parcel_key"),
        ["NDVI"],
        collection=fx.COLLECTION,
        grid=fx.GRID,
        start=fx.START,
        end=fx.END,
    )
    return show_series(df, ["NDVI"])


def time_series_coarse_class(spark, sf):
    """The class band comes from a table of twice the cell size."""
    df = ts.parcel_time_series(
        fx.parcels(spark, sf),
        fx.scenes(spark, sf),
        fx.pixels(spark, sf).drop("scl"),
        ["NDVI"],
        collection=fx.COLLECTION,
        grid=fx.GRID,
        start=fx.START,
        end=fx.END,
        classes=fx.coarse_classes(spark, sf),
        class_grid=fx.COARSE_GRID,
    )
    return show_series(df, ["NDVI"])


def run_folders(spark, sf):
    """Folders with dates of their own, from parcel files to the written series."""
    root, out = new_folder(spark, "input"), new_folder(spark, "output")
    parcels = fx.parcels(spark, sf)
    names = ["_".join(r) for r in fx.RANGES]
    write_parcel_folders(parcels, root, F.col("date_range"), names)
    # Files do not carry row keys, so the pixels come without one and match by place.
    run_plan.run_folders(
        spark,
        root,
        fx.scenes(spark, sf),
        fx.pixels(spark, sf).drop("parcel_key"),
        run_plan.RunPaths(f"{out}/mean", f"{out}/raw"),
        Params(indices=["NDVI", "NDBI"], collection=fx.COLLECTION, save_cube=True),
        fx.GRID,
    )
    return show_series(results.read_series(spark, f"{out}/mean"), ["NDVI", "NDBI"])


def time_series_zone_border(spark, sf):
    """Pixels stored in several zones, each scene's in one, on the grids of their batches' zones."""
    df = ts.parcel_time_series(
        fx.parcels(spark, sf),
        fx.utm_scenes(spark, sf),
        fx.utm_pixels(spark, sf),
        ["NDVI"],
        collection=fx.COLLECTION,
        grid=fx.UTM_GRID,
        start=fx.START,
        end=fx.END,
        utm=True,
        batch_size_deg=BATCH_DEG,
    )
    return show_series(df, ["NDVI"])


def run_failures(spark, sf):
    """Every parcel of a run with damaged, far and cloudy ones: its points, or why it has none."""
    out = new_folder(spark, "output")
    parcels = hold(fx.damaged_parcels(spark, sf), "input")
    paths = run_plan.RunPaths(f"{out}/mean", failed=f"{out}/failed")
    run_plan.run_parcels(
        parcels,
        fx.scenes(spark, sf),
        fx.cloudy_pixels(spark, sf),
        paths,
        Params(indices=["NDVI"], collection=fx.COLLECTION),
        fx.GRID,
    )
    failed = spark.read.parquet(paths.failed)
    points = results.read_series(spark, paths.series).groupBy("parcel_key").agg(
        F.count("*").alias("n_points")
    )
    return (
        parcels.select("parcel_key")
        .join(failed.select("parcel_key", *series.PROVENANCE, "reason"), "parcel_key", "left")
        .join(points, "parcel_key", "left")
    )


def rejected_ndvi(spark, sf):
    shown = rejected_plan.rejected_ndvi(cloudy_rejects(spark, sf))
    return rounded(shown, ["NDVI"]).withColumn("scl", F.col("scl").cast("long"))


QUERIES = {
    f.__name__: f
    for f in (
        parcel_time_series,
        run_folders,
        run_failures,
        rejected_ndvi,
        time_series_per_item_scale,
        time_series_shared_grid,
        time_series_coarse_class,
        time_series_zone_border,
        scan_date_folders,
        scan_parcels,
        scan_parcels_any_id,
        scan_scenes,
        scan_pixels,
        write_time_series,
        write_pixel_cube,
        write_rejected_cube,
        scan_time_series,
        scan_cube,
        filter_collection,
        filter_bbox,
        filter_date_range,
        filter_cloud_cover,
        filter_valid_items,
        mask_clear,
        mask_nodata,
        drop_all_null,
        scale_bands,
        bands_for_indices,
        stamp_provenance,
        project_indices,
        assemble_cube,
        project_series,
        split_date_range,
        batch_key,
        ring_centroid,
        ring_bounds,
        utm_zone,
        project_utm,
        utc_day,
        solar_day,
        item_scale,
        format_date_range,
        join_parcel_scene,
        join_parcel_pixel,
        clip_pixels,
        semi_join_usable_days,
        semi_join_utc_days,
        anti_join_no_scene,
        anti_join_rejected,
        join_item_scale,
        resample_nearest,
        clear_ratio,
        usable_days,
        spatial_mean,
        batch_bounds,
        batch_group,
        clear_summary,
        solar_day_mosaic,
        first_item_scale,
        run_counters,
        union_chunks,
        concat_results,
    )
} | {name.lower(): index_query(name) for name in ALL}
