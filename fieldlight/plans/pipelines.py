"""Whole pipelines: picked scenes, their manifest, cropped NDVI summaries, one status per request."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlight.functions.metadata import crop_box
from fieldlight.operators import raster, scenes, summary
from fieldlight.sources.staging import cut

STATUSES = ("bad_date", "bad_crop", "bad_cloud_cap", "no_items", "no_candidates", "no_bands", "bad_epsg", "no_epsg", "no_href", "grid_mismatch", "no_valid_pixels", "ok")


def manifest(requests: DataFrame, items: DataFrame) -> DataFrame:
    """The picked scene of each request with bands, projection, links and crop box, and its error if any."""
    chosen = scenes.resolved(scenes.described(scenes.select_scenes(requests, items), items))
    return chosen.withColumns({"box": crop_box(F.col("bbox"), F.col("crop_fraction")), "scene_error": scenes.scene_error()})


def work(chosen: DataFrame, grid: DataFrame) -> DataFrame:
    """request_id, raster_id, scene_id, tile, datetime, window of manifest rows without an error, on rasters whose bands agree."""
    ready = chosen.where("scene_error is null").select("request_id", "raster_id", "scene_id", "tile", "datetime", F.col("crop_fraction").alias("fraction"))
    agree = raster.matched_grids(grid)
    return raster.windows(ready.join(agree, "raster_id")).select("request_id", "raster_id", "scene_id", "tile", "datetime", "window")


def window_values(todo: DataFrame, pixels: DataFrame) -> DataFrame:
    """NDVI of each distinct crop: requests for the same window of a raster share the work."""
    crops = todo.select("raster_id", "window").distinct()
    return raster.ndvi(raster.crop(pixels, crops)).withColumn("crop", F.struct("raster_id", "window"))


def rasters(requests: DataFrame, items: DataFrame, grid: DataFrame, pixels: DataFrame) -> DataFrame:
    """label (named from the scene's id), tile, month, row, col, ndvi: the rasters of the picked scenes, a pixel once; what
    sources.tables.write_raster stores. A raster's windows are centred, so the largest holds all others."""
    place = ["scene_id", "raster_id", "tile", F.date_format("datetime", "yyyy-MM").alias("month")]
    todo = work(manifest(requests, items), grid).groupBy(*place).agg(F.max_by("window", F.col("window.width").cast("long") * F.col("window.height")).alias("window"))
    values = raster.ndvi(raster.crop(pixels, todo)).select("scene_id", "tile", "month", "row", "col", "ndvi")
    return raster.labelled(values, "scene_id").drop("scene_id")


def summaries(requests: DataFrame, items: DataFrame, grid: DataFrame, pixels: DataFrame) -> DataFrame:
    """What sources.tables.write_summary stores: a row per picked scene and window that has valid pixels."""
    todo = cut(work(manifest(requests, items), grid).select("scene_id", "raster_id", F.date_format("datetime", "yyyy-MM").alias("month"), "window").distinct(), "work")
    values = cut(window_values(todo, pixels).select("crop", "ndvi"), "values")
    stats = summary.full_summary(values, "crop").where("n_valid > 0")
    return todo.withColumn("crop", F.struct("raster_id", "window")).join(stats, "crop").select("scene_id", "window.*", *(c for c in stats.columns if c != "crop"), "month")


def report(requests: DataFrame, items: DataFrame, grid: DataFrame, pixels: DataFrame) -> DataFrame:
    """One row per request whose scene has valid pixels in its window: counts, extremes, mean, percentiles."""
    todo = cut(work(manifest(requests, items), grid).select("request_id", "raster_id", "window"), "work")
    # The cropped values are read by every statistic; pixels outside the windows are read once.
    values = cut(window_values(todo, pixels).select("crop", "ndvi"), "values")
    stats = summary.full_summary(values, "crop").where("n_valid > 0")
    return todo.withColumn("crop", F.struct("raster_id", "window")).join(stats, "crop").drop("crop", "window")


def status(requests: DataFrame, items: DataFrame, grid: DataFrame, pixels: DataFrame) -> DataFrame:
    """request_id and the first check that fails, in the order a single run would meet them. The search is tallied once, and all that is known
    of its requests is one narrow table, a row each; it meets the requests in one aggregation by request_id."""
    tallied = scenes.picked(scenes.tallied(requests, items))
    chosen = scenes.resolved(scenes.described(tallied, items, "left")).withColumn("scene_error", F.when(F.col("scene_id").isNotNull(), scenes.scene_error()))
    framed = raster.windows(chosen.join(raster.matched_grids(grid), "raster_id", "left").withColumn("fraction", F.col("crop_fraction")))
    crop = F.when(F.col("scene_error").isNull() & F.col("width").isNotNull(), F.struct("raster_id", "window")).alias("crop")
    known = cut(framed.select("request_id", "n_items", "n_candidates", "scene_error", crop), "known")
    # Only whether there are valid pixels is needed, of distinct crops.
    todo = known.where("crop is not null").select("crop.*")
    valid = window_values(todo, pixels).where("ndvi is not null").select("crop").distinct()
    filled = known.join(valid.withColumn("filled", F.lit(True)), "crop", "left").withColumn("aligned", F.col("crop").isNotNull()).drop("crop")
    rows = scenes.checked(requests).select("request_id", "error").unionByName(filled, allowMissingColumns=True)
    out = rows.groupBy("request_id").agg(*[F.max(c).alias(c) for c in ("error", "n_items", "n_candidates", "scene_error", "aligned", "filled")])
    steps = [
        F.col("error"), F.when(F.coalesce("n_items", F.lit(0)) == 0, "no_items"), F.when(F.col("n_candidates") == 0, "no_candidates"), F.col("scene_error"),
        F.when(~F.col("aligned"), "grid_mismatch"), F.when(F.col("filled").isNull(), "no_valid_pixels"), F.lit("ok"),
    ]
    return out.select("request_id", F.coalesce(*steps).alias("status"))
