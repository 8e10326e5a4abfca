"""Edge cases that the tables do not show."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlight.functions import indices, metadata as M
from fieldlight.operators import scenes


def column(spark, values, kind, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v")).alias("x")).collect()]


def test_days(spark):
    got = column(spark, ["2025-07-01", "2025-7-1", "2025-02-30", "20250701", " 2025-07-01", "2025-07-01 ", "0001-01-01", None], "string", lambda c: M.day(c).cast("string"))
    assert got == ["2025-07-01", "2025-07-01", None, None, None, None, "0001-01-01", None]


def test_cloud_cover(spark):
    texts = ['{"eo:cloud_cover":5,"cloudCover":9}', '{"eo:cloud_cover":"5.5"}', '{"eo:cloud_cover":null,"cloudCover":9}', '{"eo:cloud_cover":"abc"}', "{}", "no json", None]
    assert column(spark, texts, "string", M.cloud_cover) == [5.0, 5.5, 9.0, 100.0, 100.0, 100.0, 100.0]


@pytest.mark.parametrize(
    ("properties", "red", "want"),
    [
        ('{"proj:epsg":32630}', "{}", (True, 32630)), ('{"proj:epsg":32630.0}', "{}", (False, None)), ('{"proj:epsg":"32630"}', "{}", (False, None)), ('{"proj:epsg":true}', "{}", (False, None)),
        ('{"proj:epsg":null}', '{"proj:epsg":7}', (True, 7)), ('{"proj:code":"EPSG:"}', '{"proj:epsg":7}', (True, None)), ('{"proj:code":"epsg:9"}', "{}", (True, 9)), ('{"proj:code":"EPSG:abc"}', "{}", (True, None)),
        ('{"proj:code":"EPSG:32630:1"}', "{}", (True, None)), ('{"proj:code":"IAU:1"}', '{"proj:code":"EPSG:8"}', (True, 8)), ("{}", "{}", (False, None)),
    ],
)
def test_epsg(spark, properties, red, want):
    assets = f'{{"B04":{red},"B08":{{}}}}'
    df = spark.createDataFrame([(properties, assets)], "properties string, assets string").withColumn("a", M.asset_map(F.col("assets")))
    row = df.select(M.epsg(F.col("properties"), F.col("a"), M.band_pair(F.col("a"))).alias("e")).first().e
    assert (row.found, row.epsg) == want


def test_band_pairs(spark):
    texts = ['{"B04":{},"B08":{}}', '{"red":{},"nir":{},"B04_10m":{},"B08_10m":{}}', '{"B04":{},"nir":{}}', '{"B04_10m":{},"B08_10m":{},"B04":{}}', "{}", None]
    got = column(spark, texts, "string", lambda c: M.band_pair(M.asset_map(c)))
    assert [g and (g.red_key, g.nir_key) for g in got] == [("B04", "B08"), ("red", "nir"), None, ("B04_10m", "B08_10m"), None, None]


def test_links(spark):
    texts = ['{"href":"s3://a","alternate":{"https":{"href":"https://a"}}}', '{"href":"s3://a","alternate":5}', '{"href":"s3://a","alternate":{"https":3}}', '{"href":"s3://a","alternate":{"https":{"href":""}}}', '{"href":""}', '{"href":7}', "{}"]
    got = column(spark, texts, "string", lambda c: M.https_href(F.try_parse_json(c)))
    assert got == ["https://a", "s3://a", "s3://a", "s3://a", None, None, None]


def test_request_errors(spark):
    rows = [("2025-01-01", "2025-01-02", 0.5, None, None), ("x", "2025-01-02", 0.0, 200.0, "bad_date"), ("2025-01-01", "2025-01-02", 0.0, 200.0, "bad_crop"), ("2025-01-01", "2025-01-02", 0.51, 0.0, "bad_crop"), ("2025-01-01", "2025-01-02", 0.12, 101.0, "bad_cloud_cap"), ("2025-01-02", "2025-01-01", 0.12, 0.0, None)]
    df = spark.createDataFrame(rows, "s string, e string, c double, m double, want string")
    assert all(r.got == r.want for r in df.withColumn("got", M.request_error(F.col("s"), F.col("e"), F.col("c"), F.col("m"))).collect())


def test_ndvi_is_numpys(spark):
    rng = np.random.default_rng(1)
    red, nir = rng.integers(0, 10_000, 5000), rng.integers(0, 10_000, 5000)
    red[:9], nir[:9] = 0, 0
    df = spark.createDataFrame([(i, float(r), float(n)) for i, (r, n) in enumerate(zip(red, nir))], "i int, red double, nir double")
    got = [r[0] for r in df.orderBy("i").select(indices.normalized_difference(F.col("nir"), F.col("red"))).collect()]
    with np.errstate(all="ignore"):
        r, n = red.astype(np.float32), nir.astype(np.float32)
        want = np.clip((n - r) / (n + r), -1, 1)
    assert all((g is None) == bool(np.isnan(w)) and (g is None or np.float32(g) == w) for g, w in zip(got, want))


def test_ndvi_edges(spark):
    inf, nan = math.inf, math.nan
    rows = [(0.0, 0.0, None), (1.0, -1.0, None), (-3.0, 1.0, -1.0), (3.0, -1.0, -1.0), (-1.0, 3.0, 1.0), (nan, 1.0, None), (inf, 1.0, None), (None, 1.0, None), (1.0, 3.0, 0.5)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, red float, nir float, want float")
    out = df.orderBy("i").select(indices.normalized_difference(F.col("nir"), F.col("red")).alias("got"), indices.normalized_difference(F.col("red"), F.col("nir")).alias("swapped"), "want").collect()
    assert [r.got for r in out] == [r.want for r in out]
    assert all(r.swapped == (None if r.got is None else -r.got) for r in out)


def test_windows(spark):
    def want(w, h, f):
        if f <= 0 or f > 0.5:
            return 0, 0, w, h
        ow, oh = min(w, max(1, round(w * (2 * f)))), min(h, max(1, round(h * (2 * f))))
        return (w - ow) // 2, (h - oh) // 2, ow, oh

    rng = np.random.default_rng(2)
    cases = [(1, 1, 0.12), (3, 5, 0.25), (10, 10, 0.125), (10980, 10980, 0.12), (7, 7, 0.0), (7, 7, 0.51), (7, 7, 0.5)]
    cases += [(int(a), int(b), float(c)) for a, b, c in zip(rng.integers(1, 11_000, 2000), rng.integers(1, 11_000, 2000), rng.uniform(-0.05, 0.55, 2000))]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, w int, h int, f double")
    got = [tuple(r[0]) for r in df.orderBy("i").select(indices.centre_window(F.col("w"), F.col("h"), F.col("f"))).collect()]
    assert got == [want(*c) for c in cases]


def test_colours(spark):
    assert column(spark, [-1.0, 0.0, 1.0, None, 0.999], "double", indices.color_index) == [0, 128, 255, None, 255]


def test_like_needs_no_underscores(spark):
    items = spark.createDataFrame([("S2AxT30STJy", "sentinel-2-l2a", "30STJ", "{}", "{}", None, 1)], "scene_id string, collection string, tile string, properties string, assets string, bbox array<double>, raster_id long")
    items = items.withColumn("datetime", F.lit("2025-07-31 23:00:00").cast("timestamp_ntz"))
    req = spark.createDataFrame([(1, "30stj", "2025-07-01", "2025-07-31", 0.12, None, None)], "request_id long, tile string, start_date string, end_date string, crop_fraction double, max_cloud_cover double, preferred_scene_id string")
    assert [r.scene_id for r in scenes.found_items(req, items).collect()] == ["S2AxT30STJy"]
    assert [r.reason for r in scenes.pick(scenes.found_items(req, items)).collect()] == ["lowest_cloud"]


def test_any_tile_that_the_pattern_finds(spark):
    kind = "scene_id string, collection string, tile string, properties string, assets string, bbox array<double>, raster_id long"
    ids = ["S2A_T30STJ_x", "S2A_T31STJ_x", "S2B_TTTTTT_x", "S2A_T30ST_x", "S2A_T30STJK_x", "S1A_T30STJ_x", "S2A_T30%TJ_x"]
    items = spark.createDataFrame([(i, "sentinel-2-l2a", "", "{}", "{}", None, 1) for i in ids], kind).withColumn("datetime", F.lit("2025-07-31 23:00:00").cast("timestamp_ntz"))
    tiles = ["30STJ", "30st", "30_TJ", "3_STJ", "30STJK", "STJ", "TTTTT", "_____", "30%TJ", "", "30", None]
    rows = [(k, t, "2025-07-01" if k % 2 else "1995-01-01", "2025-07-31", 0.12, None, None) for k, t in enumerate(tiles)]
    req = spark.createDataFrame(rows, "request_id long, tile string, start_date string, end_date string, crop_fraction double, max_cloud_cover double, preferred_scene_id string")
    got = {(r.request_id, r.scene_id) for r in scenes.found_items(req, items).collect()}
    pattern = lambda t: "S2.*.T" + "".join("." if c == "_" else ".*" if c == "%" else c for c in t.upper()) + "..*"
    assert got == {(k, i) for k, t in enumerate(tiles) if t is not None for i in ids if re.fullmatch(pattern(t), i)}
    assert scenes.found_items(req, items).count() == len(got)


def test_described_counts_a_scene_once(spark):
    kind = "scene_id string, collection string, tile string, properties string, assets string, bbox array<double>, raster_id long"
    items = spark.createDataFrame([("S2A_T30STJ_x", "sentinel-2-l2a", "30STJ", "{}", "{}", None, k) for k in (2, 1)], kind).withColumn("datetime", F.lit("2025-07-31 23:00:00").cast("timestamp_ntz"))
    req = spark.createDataFrame([(1, "30STJ", "2025-07-01", "2025-08-31", 0.12, None, "")], "request_id long, tile string, start_date string, end_date string, crop_fraction double, max_cloud_cover double, preferred_scene_id string")
    out = scenes.described(scenes.pick(scenes.found_items(req, items)), items).collect()
    assert [(r.scene_id, r.raster_id, r.reason) for r in out] == [("S2A_T30STJ_x", 1, "lowest_cloud")]
