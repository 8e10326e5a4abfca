"""Summaries of NDVI values per scene, with exact percentiles for scenes of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PERCENTILES = (0.1, 0.5, 0.9)
BINS = 2000


def summary(values: DataFrame, by: str = "raster_id") -> DataFrame:
    """n_pixels, n_valid, low, high, mean; percentiles come from scaled_percentiles()."""
    v = F.col("ndvi").cast("double")
    return values.groupBy(by).agg(F.count("*").alias("n_pixels"), F.count(v).alias("n_valid"), F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean"))


def percentiles(values: DataFrame, by: str = "raster_id", points: tuple[float, ...] = PERCENTILES) -> DataFrame:
    """Interpolated percentiles by Spark's own aggregate, which holds a scene's distinct values in memory."""
    p = values.where("ndvi is not null").groupBy(by).agg(F.percentile(F.col("ndvi").cast("double"), F.array(*map(F.lit, points))).alias("p"))
    return p.select(by, *[F.get("p", F.lit(i)).alias(name(x)) for i, x in enumerate(points)])


def name(point: float) -> str:
    return f"p{round(point * 100)}"


def binned(values: DataFrame, by: str) -> DataFrame:
    """by, v, bin of the index' fixed range; holes have no bin."""
    v = F.col("ndvi").cast("double")
    return values.select(by, v.alias("v"), F.when(v.isNotNull(), F.least(F.lit(BINS - 1), F.floor((v + 1) / 2 * BINS))).cast("int").alias("bin"))


def histogram(values: DataFrame, by: str) -> DataFrame:
    """Counts, extremes and sums by bin, BINS + 1 rows a scene at most; one pass serves summary and percentiles."""
    return binned(values, by).groupBy(by, "bin").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.sum("v").alias("sum"))


def ranked_values(values: DataFrame, counts: DataFrame, by: str, points: tuple[float, ...]) -> DataFrame:
    """by, and a column per point. The histogram tells in which bins the wanted ranks lie (two for a rank between two
    values), and only those bins' values are counted and ranked. A value that fills a bin is one row with a count."""
    counts = counts.where("bin is not null")
    run = Window.partitionBy(by).orderBy("bin")
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = counts.select(by, "bin", "n", (F.sum("n").over(run) - F.col("n")).alias("before"), F.sum("n").over(whole).alias("total"))
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), getattr(F, side)((F.col("total") - 1) * F.lit(p)).alias("rank"), ((F.col("total") - 1) * F.lit(p) - F.floor((F.col("total") - 1) * F.lit(p))).alias("part")) for i, p in enumerate(points) for side in ("floor", "ceil")])
    inside = F.filter(ranks, lambda r: (r["rank"] >= F.col("before")) & (r["rank"] < F.col("before") + F.col("n")))
    wanted = ranked.select(by, "bin", "before", inside.alias("ranks")).where(F.size("ranks") > 0)
    own = binned(values, by).join(wanted, [by, "bin"]).groupBy(by, "bin", "before", "ranks", "v").agg(F.count("*").alias("n"))
    placed = own.withColumn("from", F.col("before") + F.sum("n").over(Window.partitionBy(by, "bin").orderBy("v")) - F.col("n"))
    hit = placed.select(by, "v", F.explode(F.filter("ranks", lambda r: (r["rank"] >= F.col("from")) & (r["rank"] < F.col("from") + F.col("n")))).alias("r")).select(by, "v", "r.*")
    side = lambda i, s: F.max(F.when((F.col("i") == i) & (F.col("side") == s), F.col("v")))
    part = lambda i: F.max(F.when(F.col("i") == i, F.col("part")))
    return hit.groupBy(by).agg(*[(side(i, "floor") + (side(i, "ceil") - side(i, "floor")) * part(i)).alias(name(p)) for i, p in enumerate(points)])


def scaled_percentiles(values: DataFrame, by: str = "raster_id", points: tuple[float, ...] = PERCENTILES) -> DataFrame:
    """The same numbers as percentiles(), without a large state."""
    return ranked_values(values, histogram(values, by), by, points)


#: Size of a sketch, 8 to 65,535: the error of a rank is about 2.3 / k ** 0.9 with 99 % confidence.
SKETCH = 400


def rank_error(k: int = SKETCH) -> float:
    """By which a sketched percentile's rank is off at most, as a part of all values, with 99 % confidence."""
    return 2.296 / k**0.9021


def sketches(values: DataFrame, by: list[str], k: int = SKETCH) -> DataFrame:
    """by, sketch: a mergeable summary of each group's valid values, of a few kB however many there are."""
    return values.where("ndvi is not null").groupBy(*by).agg(F.kll_sketch_agg_float("ndvi", k).alias("sketch"))


def merged_sketches(parts: DataFrame, by: list[str], k: int = SKETCH) -> DataFrame:
    """Sketches of coarser groups from those of finer ones; no value is read again."""
    return parts.groupBy(*by).agg(F.kll_merge_agg_float("sketch", k).alias("sketch"))


def sketched_percentiles(parts: DataFrame, by: list[str], points: tuple[float, ...] = PERCENTILES) -> DataFrame:
    """by, n_valid and a column per point: values whose ranks are within rank_error() of the point, without interpolation."""
    at = lambda p: F.kll_sketch_get_quantile_float("sketch", F.lit(p)).alias(name(p))
    return parts.select(*by, F.kll_sketch_get_n_float("sketch").alias("n_valid"), *map(at, points))


def full_summary(values: DataFrame, by: str = "raster_id") -> DataFrame:
    """What summary() and scaled_percentiles() give together. The histogram is folded for the first and ranked for the
    second; Spark computes it once."""
    counts = histogram(values, by)
    whole = counts.groupBy(by).agg(
        F.sum("n").alias("n_pixels"), F.coalesce(F.sum(F.when(F.col("bin").isNotNull(), F.col("n"))), F.lit(0)).alias("n_valid"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("sum").alias("sum"),
    )
    whole = whole.withColumn("mean", F.col("sum") / F.nullif("n_valid", F.lit(0))).drop("sum")
    return whole.join(ranked_values(values, counts, by, PERCENTILES), by, "left")
