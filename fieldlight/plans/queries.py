"""The library's operators as queries over the driver's tables. Floats are rounded to six digits, as in the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlight.functions import metadata as M
from fieldlight.operators import raster, scenes, summary
from fieldlight.plans import pipelines
from fieldlight.sources import derived, staging, tables

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
CELL = 8
WINDOW = (3, 2, 9, 11)
DAYS = ("1996-02-01", "1996-03-15")


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _r(c: str | Column, name: str | None = None) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), 6).alias(name or c)


def _default_work(spark: SparkSession, d: str) -> DataFrame:
    """The window of fraction 0.12 on every raster."""
    g = derived.grid(spark, d).where("band = 'red'").select("raster_id", "width", "height", F.lit(0.12).alias("fraction"))
    return raster.windows(g).select("raster_id", "window")


def _search(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return derived.search(spark, d)


@query
def catalog_scan(spark, d):
    it = derived.items(spark, d)
    return it.select("scene_id", "collection", "tile", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("seen"), "properties", "assets", "raster_id")


@query
def catalog_search(spark, d):
    """Through files: written as a catalogue, read with the filters on collection and days."""
    path = staging.scratch(spark, "catalogue")
    tables.write_catalog(derived.items(spark, d), path)
    return tables.search_catalog(spark, path, *DAYS).select("scene_id", "collection", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("seen"), "raster_id")


def _dump(versions: DataFrame, batch: int) -> str:
    """A dump of item texts, a line each, some of them cut off; packed lightly, in files that tasks share evenly."""
    path, rows = staging.scratch(versions.sparkSession, "dump"), versions.where(F.col("batch") == batch)
    whole = tables.dump_items(rows.where("not broken"))
    cut_off = rows.where("broken").select(F.concat(F.lit('{"type":"Feature","id":"'), "scene_id", F.lit('","properties":{')).alias("value"))
    whole.unionByName(cut_off).write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", 100_000).text(path)
    return path


@query
def catalog_merge(spark, d):
    """Through files: two dumps of items are merged into one catalogue, which keeps each scene's newest version."""
    path = staging.scratch(spark, "catalogue")
    with staging.scope(spark):
        versions = derived.item_versions(spark, d)
        first = _dump(versions, 0)
        tables.merge_catalog(tables.read_items(spark, first), path)
        with staging.scope(spark):
            tables.merge_catalog(tables.read_items(spark, _dump(versions, 1)), path)
        tables.merge_catalog(tables.read_items(spark, first), path)  # a batch that comes again changes nothing
    it = scenes.resolved(tables.read_catalog(spark, path))
    seen = lambda c, name: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(name)
    return it.select("scene_id", "collection", "tile", seen("datetime", "seen"), seen("updated", "changed"), _r(M.cloud_cover(F.col("properties")), "cloud_cover"), F.col("projection.epsg").alias("epsg"), "red_href", F.size("bbox").alias("n_box"), "raster_id")


@query
def catalog_corrupt(spark, d):
    """Through files: the lines of a dump that are no items."""
    return tables.read_items(spark, _dump(derived.item_versions(spark, d), 1)).where("corrupt is not null").select("corrupt")


@query
def block_files(spark, d):
    """Through files: blocks stored along a space-filling curve, of which a window's row groups are read."""
    path = staging.scratch(spark, "blocks")
    tables.write_blocks(derived.blocks(spark, d), path, cell=8)
    return _window_pixels(tables.read_window(tables.read_blocks(spark, path), *WINDOW))


@query
def block_file_crops(spark, d):
    """Through files: each raster's own window, of stored blocks that are cut into different tiles."""
    path, blocks = staging.scratch(spark, "blocks"), derived.tiled_blocks(spark, d)
    tables.write_blocks(blocks, path, cell=4)
    work = _block_work(blocks).where("raster_id % 3 < 2")
    near = tables.read_windows(tables.read_blocks(spark, path), work).drop("window").distinct()
    return raster.crop_blocks(near, work).select("raster_id", "row", "col", _r("red"), _r("nir"))


@query
def band_window_read(spark, d):
    return _window_pixels(tables.read_window(derived.blocks(spark, d), *WINDOW))


def _window_pixels(near: DataFrame) -> DataFrame:
    flat = near.select("raster_id", "band", "row0", "col0", "w", F.posexplode("values").alias("pos", "value"))
    flat = flat.select("raster_id", "band", (F.col("row0") + F.expr("pos div w")).alias("row"), (F.col("col0") + F.expr("pos % w")).alias("col"), _r("value"))
    r, c, h, w = WINDOW
    return flat.where(F.col("row").between(r, r + h - 1) & F.col("col").between(c, c + w - 1))


@query
def ndvi_raster(spark, d):
    values = raster.labelled(raster.ndvi(raster.crop(derived.pixels(spark, d), _default_work(spark, d))))
    return values.select("label", "row", "col", _r("ndvi"))


@query
def raster_files(spark, d):
    """Through files: the picked scenes' rasters, written by tile and month in several steps and read back."""
    path = staging.scratch(spark, "rasters")
    values = staging.cut(_rasters(spark, d), "values")
    odd = F.right("label", F.lit(1)) % 2 == 1
    # Scenes of one folder come apart, later months leave earlier ones alone, and what comes again changes nothing.
    for part in (odd & (F.col("month") < "1996"), ~odd, odd & (F.col("month") >= "1996"), odd):
        tables.write_raster(values.where(part), path)
    return tables.read_raster(spark, path).select("label", "tile", "month", "row", "col", _r("ndvi"))


def _rasters(spark: SparkSession, d: str) -> DataFrame:
    return pipelines.rasters(*_search(spark, d), derived.grid(spark, d), derived.pixels(spark, d))


@query
def summary_files(spark, d):
    """Through files: summaries of the picked scenes' windows, written in two overlapping steps and read back."""
    path = staging.scratch(spark, "summaries")
    rows = staging.cut(pipelines.summaries(*_search(spark, d), derived.grid(spark, d), derived.pixels(spark, d)), "summaries")
    for part in (F.col("month") < "1996-07", F.col("month") > "1996-02"):
        tables.write_summary(rows.where(part), path, tables.SUMMARY_KEYS, ("month",))
    s = tables.read_summary(spark, path)
    return s.select("scene_id", "month", "col_off", "row_off", "width", "height", "n_pixels", "n_valid", *[_r(c) for c in ("low", "p10", "p50", "p90", "high", "mean")])


@query
def percentile_sketches(spark, d):
    """Percentiles of each tile and month from mergeable sketches of its scenes: whether their ranks among all values are as near as promised
    (three times the error of 99 % confidence)."""
    values = staging.cut(_rasters(spark, d).where("ndvi is not null"), "values")
    group = ["tile", "month"]
    merged = summary.merged_sketches(summary.sketches(values, [*group, "label"]), group)
    found = summary.sketched_percentiles(merged, group)
    names = [summary.name(p) for p in summary.PERCENTILES]
    placed = values.select(*group, "ndvi").join(found, group)
    counts = [F.count_if(F.col("ndvi") < F.col(c)).alias(f"{c}_under") for c in names] + [F.count_if(F.col("ndvi") <= F.col(c)).alias(f"{c}_upto") for c in names]
    ranks = placed.groupBy(*group, "n_valid").agg(*counts)
    most = 3 * summary.rank_error()
    near = [((F.col(f"{c}_under") / F.col("n_valid") - most <= p) & (F.col(f"{c}_upto") / F.col("n_valid") + most >= p)).alias(c) for c, p in zip(names, summary.PERCENTILES, strict=True)]
    return ranks.select(*group, "n_valid", *near)


@query
def ndvi_summary(spark, d):
    s = summary.full_summary(raster.ndvi(derived.pixels(spark, d)))
    return s.select("raster_id", "n_pixels", "n_valid", *[_r(c) for c in ("low", "p10", "p50", "p90", "high", "mean")])


@query
def validate_dates(spark, d):
    req = derived.requests(spark, d)
    return req.select("request_id", F.date_format(M.day(F.col("start_date")), "yyyyMMdd").alias("start_day"), F.date_format(M.day(F.col("end_date")), "yyyyMMdd").alias("end_day"))


@query
def validate_requests(spark, d):
    return scenes.checked(derived.requests(spark, d)).select("request_id", "error")


@query
def filter_collection(spark, d):
    return scenes.in_collections(derived.items(spark, d)).select("scene_id", "collection")


@query
def filter_dates(spark, d):
    day = lambda s: F.lit(s).cast("date")
    return derived.items(spark, d).where(scenes.in_days(F.col("datetime"), *map(day, DAYS))).select("scene_id")


@query
def filter_tile(spark, d):
    return derived.items(spark, d).where(M.like_tile(F.col("scene_id"), F.lit("17stj"))).select("scene_id", "tile")


@query
def cloud_cover(spark, d):
    return derived.items(spark, d).select("scene_id", _r(M.cloud_cover(F.col("properties")), "cloud_cover"))


@query
def filter_cloud(spark, d):
    it = derived.items(spark, d).withColumn("cloud_cover", M.cloud_cover(F.col("properties")))
    return it.where(scenes.under_cap(F.col("cloud_cover"), F.lit(10.0))).select("scene_id", _r("cloud_cover"))


@query
def valid_pixels(spark, d):
    s = summary.summary(raster.ndvi(derived.pixels(spark, d)))
    return s.select("raster_id", "n_valid", F.when(F.col("n_valid") == 0, "no_valid_pixels").otherwise("ok").alias("status"))


@query
def request_candidates(spark, d):
    return scenes.found_candidates(*_search(spark, d), cloud_cover=_r("cloud_cover")).select("request_id", "scene_id", "cloud_cover")


@query
def requests_unmatched(spark, d):
    req, it = _search(spark, d)
    n = scenes.counts(req, it)
    valid = scenes.checked(req).where("error is null").select("request_id")
    missing = n.join(valid, "request_id", "left_semi").where("n_candidates = 0")
    return missing.select("request_id", F.when(F.col("n_items") == 0, "no_items").otherwise("no_candidates").alias("status"))


@query
def pair_bands(spark, d):
    px = raster.explode_blocks(raster.pair_blocks(derived.blocks(spark, d)))
    return px.select("raster_id", "row", "col", _r("red"), _r("nir"))


@query
def pair_tilings(spark, d):
    px = raster.explode_blocks(raster.pair_blocks(derived.tiled_blocks(spark, d)))
    return px.select("raster_id", "row", "col", _r("red"), _r("nir"))


@query
def grid_mismatch(spark, d):
    return raster.mismatched_grids(derived.grid(spark, d)).select("raster_id", "red_width", "nir_width", "red_height", "nir_height")


@query
def crop_pixels(spark, d):
    return raster.crop(derived.pixels(spark, d), _default_work(spark, d)).select("raster_id", "row", "col", "red", "nir")


def _block_work(blocks: DataFrame) -> DataFrame:
    frame = blocks.select("raster_id").distinct().select("raster_id", F.lit(16).alias("width"), F.lit(16).alias("height"), F.lit(0.3).alias("fraction"))
    return raster.windows(frame).select("raster_id", "window")


@query
def crop_blocks(spark, d):
    blocks = derived.blocks(spark, d)
    return raster.crop_blocks(blocks, _block_work(blocks)).select("raster_id", "row", "col", _r("red"), _r("nir"))


@query
def crop_tilings(spark, d):
    blocks = derived.tiled_blocks(spark, d)
    return raster.crop_blocks(blocks, _block_work(blocks)).select("raster_id", "row", "col", _r("red"), _r("nir"))


@query
def candidate_counts(spark, d):
    return scenes.counts(*_search(spark, d))


@query
def ndvi_percentiles(spark, d):
    p = summary.percentiles(raster.ndvi(derived.pixels(spark, d)))
    return p.select("raster_id", *[_r(c) for c in ("p10", "p50", "p90")])


@query
def ndvi_percentiles_scaled(spark, d):
    p = summary.scaled_percentiles(raster.ndvi(derived.pixels(spark, d)))
    return p.select("raster_id", *[_r(c) for c in ("p10", "p50", "p90")])


@query
def select_scene(spark, d):
    return scenes.select_scenes(*_search(spark, d)).select("request_id", "scene_id", _r("cloud_cover"), "reason")


@query
def capped_candidates(spark, d):
    return scenes.capped(*_search(spark, d), 3).select("request_id", "scene_id", "place")


@query
def earliest_candidates(spark, d):
    """The cap over all requests together."""
    return scenes.first_found(*_search(spark, d), 50).select("request_id", "scene_id", _r("cloud_cover"))


@query
def band_pair(spark, d):
    it = scenes.resolved(derived.items(spark, d))
    keys = F.array_join(F.array_sort(F.map_keys(M.asset_map(F.col("assets")))), ",")
    return it.select("scene_id", F.col("bands.red_key").alias("red_key"), F.col("bands.nir_key").alias("nir_key"), F.when(F.col("bands").isNull(), keys).alias("detail"))


@query
def item_epsg(spark, d):
    return scenes.resolved(derived.items(spark, d)).select("scene_id", F.col("projection.epsg").alias("epsg"), F.col("projection.found").alias("found"))


@query
def https_hrefs(spark, d):
    it = derived.items(spark, d)
    return it.select("scene_id", F.explode(M.https_hrefs(M.asset_map(F.col("assets")))).alias("asset", "href"))


@query
def band_hrefs(spark, d):
    return scenes.resolved(derived.items(spark, d)).select("scene_id", "red_href", "nir_href")


@query
def bbox_crop(spark, d):
    box = derived.items(spark, d).select("scene_id", M.crop_box(F.col("bbox"), F.lit(0.12)).alias("b"))
    return box.select("scene_id", *[_r(f"b.{c}", c) for c in ("west", "south", "east", "north")])


@query
def center_window(spark, d):
    return raster.windows(derived.frames(spark, d)).select("frame_id", F.col("window.col_off").alias("col_off"), F.col("window.row_off").alias("row_off"), F.col("window.width").alias("out_width"), F.col("window.height").alias("out_height"))


@query
def ndvi_pixels(spark, d):
    return raster.ndvi(derived.pixels(spark, d)).select("raster_id", "row", "col", _r("ndvi"))


@query
def ndvi_blocks(spark, d):
    b = raster.ndvi_blocks(raster.pair_blocks(derived.blocks(spark, d)))
    flat = b.select("raster_id", "row0", "col0", "w", F.posexplode("ndvi").alias("pos", "ndvi"))
    return flat.select("raster_id", (F.col("row0") + F.expr("pos div w")).alias("row"), (F.col("col0") + F.expr("pos % w")).alias("col"), _r("ndvi"))


@query
def ndvi_clip(spark, d):
    px = raster.explode_blocks(raster.pair_blocks(derived.blocks(spark, d)))
    both = raster.ndvi(px, clip=False).withColumnRenamed("ndvi", "raw")
    s = raster.ndvi(both).groupBy("raster_id").agg(F.count_if(F.abs("raw") > 1).alias("n_clipped"), F.count("ndvi").alias("n_valid"), F.min("ndvi").alias("low"), F.max("ndvi").alias("high"))
    return s.select("raster_id", "n_clipped", "n_valid", _r("low"), _r("high"))


@query
def ndvi_map(spark, d):
    return raster.map_cells(raster.ndvi(derived.pixels(spark, d)), CELL)


@query
def request_status(spark, d):
    return pipelines.status(*_search(spark, d), derived.grid(spark, d), derived.pixels(spark, d))


@query
def scene_manifest(spark, d):
    m = pipelines.manifest(*_search(spark, d))
    return m.select(
        "request_id", "scene_id", "raster_id", F.col("bands.red_key").alias("red_key"), F.col("bands.nir_key").alias("nir_key"), F.col("projection.epsg").alias("epsg"), "red_href", "nir_href",
        _r("box.west", "west"), _r("box.south", "south"), _r("box.east", "east"), _r("box.north", "north"), "scene_error",
    )


@query
def ndvi_report(spark, d):
    r = pipelines.report(*_search(spark, d), derived.grid(spark, d), derived.pixels(spark, d))
    return r.select("request_id", "raster_id", "n_pixels", "n_valid", *[_r(c) for c in ("low", "p10", "p50", "p90", "high", "mean")])
