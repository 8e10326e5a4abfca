"""Scenes, requests, rasters and grids in the shapes of the library's inputs, derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlight.sources.staging import cut


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(key: Column, n: int, cases: dict[tuple[int, ...], Column], other: Column) -> Column:
    out = None
    for values, then in cases.items():
        test = (key % n).isin(*values)
        out = F.when(test, then) if out is None else out.when(test, then)
    return out.otherwise(other)


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with its customer's nation."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    rows = orders.join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), orders["o_custkey"] == F.col("c_custkey"))
    return rows.select("o_orderkey", "o_orderdate", "c_nationkey")


def _written(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(_placed(spark, sf_dir).sortWithinPartitions("o_orderdate", "c_nationkey", "o_orderkey"), "placed")


def search(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """requests() and items(), which both read one join of orders and customers. It is written, three numbers a row, so that a search that
    reads the catalogue several times shuffles the orders once; sorted, so that what is written and what is shuffled of it is small."""
    placed = _written(spark, sf_dir)
    return _requests(spark, sf_dir, placed), _items(spark, sf_dir, placed)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scene catalogue: an order is a scene, its customer's nation the tile."""
    return _items(spark, sf_dir, _placed(spark, sf_dir))


def _items(spark: SparkSession, sf_dir: str, rows: DataFrame, **also: Column) -> DataFrame:
    """items() of these orders; also: more columns, made of theirs."""
    rasters = table(spark, sf_dir, "supplier").agg(F.count("*")).scalar()
    k, n, d = F.col("o_orderkey"), F.col("c_nationkey"), F.col("o_orderdate")
    tile = F.concat((n + 10).cast("string"), F.lit("STJ"))
    scene = F.concat(
        F.when(k % 50 == 0, "S1").otherwise("S2"), F.when(k % 2 == 0, "A").otherwise("B"), F.lit("_MSIL2A_"), F.date_format(d, "yyyyMMdd"), F.lit("T110000_R137_T"),
        F.when(k % 53 == 0, F.lower(tile)).otherwise(tile), F.lit("_"), F.lpad(k.cast("string"), 10, "0"),
    )
    q = k * 37 % 10001
    cc = F.concat(F.expr("(o_orderkey * 37 % 10001) div 100").cast("string"), F.lit("."), F.lpad((q % 100).cast("string"), 2, "0"))
    z = (n + 32610).cast("string")
    cloud = _pick(
        k, 10, {(0,): F.lit(None).cast("string"), (1, 2): F.concat(F.lit('"cloudCover":'), cc), (3,): F.concat(F.lit('"eo:cloud_cover":'), cc, F.lit(',"cloudCover":1.5')), (4,): F.concat(F.lit('"eo:cloud_cover":"'), cc, F.lit('"'))},
        F.concat(F.lit('"eo:cloud_cover":'), cc),
    )
    proj = _pick(
        k, 6, {(0,): F.concat(F.lit('"proj:epsg":'), z), (1,): F.concat(F.lit('"proj:code":"EPSG:'), z, F.lit('"')), (2,): F.concat(F.lit('"proj:code":"epsg:'), z, F.lit('"')), (3,): F.lit(None).cast("string"), (4,): F.lit('"proj:code":"IAU_2015:30100"')},
        F.concat(F.lit('"proj:epsg":"'), z, F.lit('"')),
    )
    alternate = _pick(k, 7, {(5,): F.lit(',"alternate":{"https":{"href":"https://example.org/'), (6,): F.lit(',"alternate":{"https":{"href":"')}, F.lit(""))

    def asset(key: str, band: str) -> Column:
        other = F.when(k % 7 == 5, F.concat(alternate, scene, F.lit(f'/{key}.jp2"}}}}'))).when(k % 7 == 6, F.concat(alternate, F.lit('"}}'))).otherwise("")
        own = F.when(k % 6 == 3, F.concat(F.lit(',"proj:epsg":'), z)).otherwise("") if band == "nir" else F.when(k % 6 == 5, F.concat(F.lit(',"proj:code":"EPSG:'), z, F.lit('"'))).otherwise("")
        return F.concat(F.lit(f'"{key}":{{"href":"s3://example-scenes/'), scene, F.lit(f'/{key}.jp2"'), other, own, F.lit("}"))

    pairs = {p: F.concat_ws(",", asset(p[0], "red"), asset(p[1], "nir")) for p in (("B04", "B08"), ("red", "nir"), ("B04_10m", "B08_10m"), ("B04", "nir"))}
    first, second, third, half = pairs.values()
    assets = _pick(k, 7, {(0, 5): first, (1, 6): second, (2,): third, (3,): F.concat_ws(",", first, second, third)}, half)
    x = n.cast("double")
    bbox = F.when(k % 13 == 0, None).when(k % 11 == 0, F.array(x, x + 1, F.lit(0.0), x + 1.5, x + 2, F.lit(100.0))).otherwise(F.array(x, x + 1, x + 1.5, x + 2))
    wrap = lambda c: F.concat(F.lit("{"), c, F.lit("}"))
    return rows.select(
        scene.alias("scene_id"), F.when(k % 20 == 0, "sentinel-2-l1c").otherwise("sentinel-2-l2a").alias("collection"), tile.alias("tile"), (d + F.expr("interval 11 hours")).alias("datetime"),
        wrap(F.concat_ws(",", cloud, proj)).alias("properties"), wrap(assets).alias("assets"), bbox.alias("bbox"), (k % rasters).alias("raster_id"),
        *[c.alias(name) for name, c in also.items()],
    )


def item_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """items() as a catalogue changes: `batch` (0 or 1), and `broken`, which the last versions of some scenes are. Every fourth scene has an
    earlier version too, which comes in the other batch."""
    k, placed = F.col("o_orderkey"), _written(spark, sf_dir)
    last = _items(spark, sf_dir, placed, updated=F.col("o_orderdate") + F.expr("interval 59 hours"), batch=k % 2, broken=k % 17 == 0)
    first = _items(spark, sf_dir, placed.where(k % 4 == 0), updated=F.col("o_orderdate") + F.expr("interval 35 hours"), batch=1 - k % 2, broken=F.lit(False))
    return last.unionByName(first.withColumn("properties", F.lit('{"cloudCover":77}')))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse rasters of 64 by 64: raster_id, row, col, red, nir."""
    lines = table(spark, sf_dir, "lineitem")
    dark = ((F.col("l_discount") == 0) & (F.col("l_tax") == 0)) | (F.col("l_suppkey") % 10 == 7)
    red = F.when(dark, 0).otherwise(F.floor("l_quantity") * 100)
    nir = F.when(dark, 0).otherwise(F.floor("l_extendedprice") % 10000)
    place = [F.col("l_suppkey").alias("raster_id"), (F.col("l_orderkey") % 64).cast("int").alias("row"), (F.col("l_partkey") % 64).cast("int").alias("col")]
    return lines.groupBy(*place).agg(F.max(red).cast("int").alias("red"), F.max(nir).cast("int").alias("nir"))


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Band blocks of 8 by 8, four to a raster: raster_id, band, row0, col0, h, w, values."""
    v = table(spark, sf_dir, "embeddings")
    part = F.expr("vec_id div 2 % 4")
    return v.select(
        F.expr("vec_id div 8").alias("raster_id"), F.when(F.col("vec_id") % 2 == 0, "red").otherwise("nir").alias("band"), (F.expr("vec_id div 4 % 2") * 8).cast("int").alias("row0"), (part % 2 * 8).cast("int").alias("col0"),
        F.lit(8).alias("h"), F.lit(8).alias("w"), F.col("embedding").alias("values"),
    )


def tiled_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """blocks() with the NIR band of every third raster cut into four bands of 4 by 16 instead."""
    part = F.expr("vec_id div 2 % 4").cast("int")
    other = (F.col("vec_id") % 2 == 1) & (F.expr("vec_id div 8") % 3 == 1)
    v = table(spark, sf_dir, "embeddings")
    return v.select(
        F.expr("vec_id div 8").alias("raster_id"), F.when(F.col("vec_id") % 2 == 0, "red").otherwise("nir").alias("band"), F.when(other, part * 4).otherwise((F.expr("vec_id div 4 % 2") * 8).cast("int")).alias("row0"),
        F.when(other, 0).otherwise(part % 2 * 8).alias("col0"), F.when(other, 4).otherwise(8).alias("h"), F.when(other, 16).otherwise(8).alias("w"), F.col("embedding").alias("values"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per customer, for its nation's tile and one of 80 months. Some name a tile by a wildcard or by its first
    four characters, for which the id pattern stands as well."""
    return _requests(spark, sf_dir, _placed(spark, sf_dir))


def _requests(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    ident, n = F.col("c_custkey"), F.col("c_nationkey")
    m = (ident % 80).cast("int")
    own = F.concat((n + 10).cast("string"), F.lit("STJ"))
    month = F.date_format(F.add_months(F.lit("1995-01-01").cast("date"), m), "yyyy-MM")
    wild = F.concat(F.substring(own, 1, 1), F.lit("_"), F.substring(own, 3, 3))
    tile = F.when(n == 24, "99ZZZ").when(ident % 41 == 0, F.substring(own, 1, 4)).when(ident % 43 == 0, wild).when(ident % 4 == 0, F.lower(own)).otherwise(own)
    base = table(spark, sf_dir, "customer").select(
        ident.alias("request_id"), tile.alias("tile"), F.concat(month, F.lit("-01")).alias("start_date"),
        F.when(ident % 101 == 0, "bad").otherwise(F.concat(month, F.lit("-28"))).alias("end_date"), F.when(ident % 89 == 0, 0.0).when(ident % 5 == 0, 0.5).otherwise(0.12).alias("crop_fraction"),
        F.when(ident % 97 == 0, 150.0).when(ident % 7 == 0, None).otherwise(10.0).alias("max_cloud_cover"), own.alias("_tile"), month.alias("_month"),
    )
    best = _items(spark, sf_dir, rows).groupBy(F.col("tile").alias("_tile"), F.date_format("datetime", "yyyy-MM").alias("_month")).agg(F.max("scene_id").alias("_last"))
    preferred = F.when(F.col("request_id") % 3 == 0, F.col("_last")).when(F.col("request_id") % 3 == 1, "none")
    return base.join(best, ["_tile", "_month"], "left").withColumn("preferred_scene_id", preferred).drop("_tile", "_month", "_last")


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raster_id, band, width, height."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("raster_id"), F.explode(F.array(F.lit("red"), F.lit("nir"))).alias("band"))
    return s.withColumns({"width": F.when((F.col("band") == "nir") & (F.col("raster_id") % 9 == 4), 32).otherwise(64), "height": F.lit(64)})


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """frame_id, width, height, fraction of many sizes."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(k.alias("frame_id"), (k * 397 % 11000 + 1).cast("int").alias("width"), (k * 211 % 11000 + 1).cast("int").alias("height"), ((F.col("p_size") - 5) / 80).alias("fraction"))
