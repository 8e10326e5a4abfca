"""Band rasters: pairing, grid checks, windows and crops, NDVI, map cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlight.functions.indices import block_difference, centre_window, color_index, normalized_difference


def pair_pixels(pixels: DataFrame) -> DataFrame:
    """pixels: raster_id, band, row, col, value. One row per place with red and nir, in one pass: a grouped
    aggregation instead of a join of two scans."""
    of = lambda b: F.max(F.when(F.col("band") == b, F.col("value"))).alias(b)
    return pixels.groupBy("raster_id", "row", "col").agg(of("red"), of("nir")).where("red is not null and nir is not null")


def sliced(values: Column, w: Column, top: Column, left: Column, height: Column, width: Column) -> Column:
    """The part of a block's values (rows of w) that begins at row top and column left, of height rows of width; whole blocks as they are."""
    rows = F.transform(F.sequence(F.lit(0), height - 1), lambda i: F.slice(values, (top + i) * w + left + 1, width))
    return F.when((width == w) & (top == 0) & (height * w == F.size(values)), values).otherwise(F.flatten(rows))


def _over(low: Column, size: Column, other: Column, length: Column) -> Column:
    return (low < other + length) & (low + size > other)


def pair_blocks(blocks: DataFrame, on: tuple[str, ...] = ("raster_id",), side: int | None = None) -> DataFrame:
    """blocks: `on`, band, row0, col0, h, w, values. Where a red and a NIR block overlap, a block of both: red, nir. The bands may be cut
    into any tiles. Blocks meet in the cells of a coarse grid, an equi-join; cells have the side of the largest block (unless one is
    named), so that a block lies in four at most, in one where tiles are cut alike, and a pair counts in the cell of its first pixel. Pixels that
    only one band covers have no pair."""
    cell = F.lit(side) if side else blocks.agg(F.max(F.greatest("h", "w")).cast("int")).scalar()
    cells = lambda low, n: F.explode(F.sequence(F.floor(low / cell), F.floor((low + n - 1) / cell)))
    placed = blocks.select(*on, "band", F.struct("row0", "col0", "h", "w", "values").alias("b"), cells(F.col("row0"), F.col("h")).alias("_r")).select("*", cells(F.col("b.col0"), F.col("b.w")).alias("_c"))
    of = lambda band: placed.where(F.col("band") == band).drop("band").withColumnRenamed("b", band)
    r, n = (lambda c: F.col(f"red.{c}")), (lambda c: F.col(f"nir.{c}"))
    met = of("red").join(of("nir"), [*on, "_r", "_c"]).where(_over(r("row0"), r("h"), n("row0"), n("h")) & _over(r("col0"), r("w"), n("col0"), n("w")))
    top, left = F.greatest(r("row0"), n("row0")), F.greatest(r("col0"), n("col0"))
    met = met.where((F.floor(top / cell) == F.col("_r")) & (F.floor(left / cell) == F.col("_c")))
    height, width = F.least(r("row0") + r("h"), n("row0") + n("h")) - top, F.least(r("col0") + r("w"), n("col0") + n("w")) - left
    part = lambda c: sliced(c("values"), c("w"), top - c("row0"), left - c("col0"), height, width)
    return met.select(*on, top.alias("row0"), left.alias("col0"), height.alias("h"), width.alias("w"), part(r).alias("_red"), part(n).alias("_nir")).withColumnsRenamed({"_red": "red", "_nir": "nir"})


def explode_blocks(pairs: DataFrame, on: tuple[str, ...] = ("raster_id",)) -> DataFrame:
    """Pixel rows of paired blocks: `on`, row, col, red, nir."""
    both = F.posexplode(F.arrays_zip("red", "nir")).alias("pos", "v")
    flat = pairs.select(*on, "row0", "col0", "w", both)
    return flat.select(*on, (F.col("row0") + F.expr("pos div w")).cast("int").alias("row"), (F.col("col0") + F.expr("pos % w")).cast("int").alias("col"), F.col("v.red").alias("red"), F.col("v.nir").alias("nir"))


def grids(grid: DataFrame) -> DataFrame:
    """grid: raster_id, band, width, height. A row per raster with both bands' sides."""
    of = lambda b, c: F.max(F.when(F.col("band") == b, F.col(c)))
    return grid.groupBy("raster_id").agg(*[of(b, c).alias(f"{b}_{c}") for b in ("red", "nir") for c in ("width", "height")])


_ALIKE = "red_width = nir_width and red_height = nir_height"


def mismatched_grids(grid: DataFrame) -> DataFrame:
    """Rasters whose bands differ in width or height; a band that the grid lacks differs from any."""
    return grids(grid).where(f"not coalesce({_ALIKE}, false)")


def matched_grids(grid: DataFrame) -> DataFrame:
    """raster_id, width, height of all other rasters."""
    return grids(grid).where(_ALIKE).select("raster_id", F.col("red_width").alias("width"), F.col("red_height").alias("height"))


def windows(frames: DataFrame) -> DataFrame:
    """frames with width, height and fraction; adds window (col_off, row_off, width, height)."""
    return frames.withColumn("window", centre_window(F.col("width"), F.col("height"), F.col("fraction")))


def crop(pixels: DataFrame, work: DataFrame, on: str = "raster_id") -> DataFrame:
    """Pixels inside the window of their raster. work has a row per crop, so it is small beside the pixels;
    Spark broadcasts it by its size."""
    win = F.col("window")
    inside = (F.col("row") >= win["row_off"]) & (F.col("row") < win["row_off"] + win["height"]) & (F.col("col") >= win["col_off"]) & (F.col("col") < win["col_off"] + win["width"])
    return pixels.join(work, on).where(inside)


def cropped_blocks(blocks: DataFrame, work: DataFrame, on: str = "raster_id") -> DataFrame:
    """`on`, window, band, row0, col0, h, w, values: the parts of unpaired blocks that lie in a window of their raster. Blocks beside all
    windows go, and rows and columns beside the window are sliced off, before anything is shuffled to be paired."""
    win, b = F.col("window"), F.col
    near = blocks.join(work.select(on, "window").distinct(), on).where(_over(b("row0"), b("h"), win["row_off"], win["height"]) & _over(b("col0"), b("w"), win["col_off"], win["width"]))
    top, left = F.greatest("row0", win["row_off"]), F.greatest("col0", win["col_off"])
    height, width = F.least(b("row0") + b("h"), win["row_off"] + win["height"]) - top, F.least(b("col0") + b("w"), win["col_off"] + win["width"]) - left
    part = sliced(b("values"), b("w"), top - b("row0"), left - b("col0"), height, width)
    # Names inside the slices' lambda would mean the new columns if these had their names at once.
    new = {"_row0": top, "_col0": left, "_h": height, "_w": width, "_values": part}
    return near.select(on, "window", "band", *(c.alias(k) for k, c in new.items())).withColumnsRenamed({k: k[1:] for k in new})


def crop_blocks(blocks: DataFrame, work: DataFrame, on: str = "raster_id") -> DataFrame:
    """Pixels of both bands inside the window, from unpaired blocks: `on`, window, row, col, red, nir. No other pixel gets a row."""
    keys = (on, "window")
    return explode_blocks(pair_blocks(cropped_blocks(blocks, work, on), keys), keys)


def ndvi(pixels: DataFrame, clip: bool = True) -> DataFrame:
    return pixels.withColumn("ndvi", normalized_difference(F.col("nir"), F.col("red"), clip))


def ndvi_blocks(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("ndvi", block_difference(F.col("nir"), F.col("red")))


def labelled(values: DataFrame, on: str = "raster_id") -> DataFrame:
    return values.withColumn("label", F.concat(F.lit("ndvi_"), F.col(on).cast("string")))


def map_cells(values: DataFrame, cell: int, on: str = "raster_id") -> DataFrame:
    """A coarser grid: mean of the valid pixels of each cell, its colour index; combined before the shuffle."""
    place = [F.expr(f"row div {cell}").cast("int").alias("map_row"), F.expr(f"col div {cell}").cast("int").alias("map_col")]
    cells = values.groupBy(on, *place).agg(F.round(F.avg(F.col("ndvi").cast("double")), 6).alias("mean"))
    return cells.withColumn("color", color_index(F.col("mean")))
