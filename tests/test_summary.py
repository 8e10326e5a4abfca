"""Exact percentiles at scale, block crops, writers."""

import numpy as np
from pyspark.sql import functions as F

from fieldlight.operators import raster, summary
from fieldlight.sources import tables


def test_scaled_percentiles(spark):
    rng = np.random.default_rng(3)
    rows = [(1, float(v)) for v in rng.uniform(-1, 1, 3000)] + [(2, 0.25)] * 500 + [(3, 0.5)] + [(4, -1.0), (4, 1.0)] + [(5, None)] + [(6, float(v)) for v in np.round(rng.normal(0, 0.2, 999), 2).clip(-1, 1)]
    df = spark.createDataFrame(rows, "raster_id long, ndvi double")
    a = {r.raster_id: r for r in summary.percentiles(df).collect()}
    b = {r.raster_id: r for r in summary.scaled_percentiles(df.repartition(7)).collect()}
    assert a.keys() == b.keys() == {1, 2, 3, 4, 6}
    for k in a:
        assert np.allclose([a[k].p10, a[k].p50, a[k].p90], [b[k].p10, b[k].p50, b[k].p90], atol=1e-12)


def test_blocks_and_pixels_agree(spark):
    rng = np.random.default_rng(4)
    red, nir = rng.integers(0, 100, (20, 23)), rng.integers(0, 100, (20, 23))
    rows = []
    for band, a in (("red", red), ("nir", nir)):
        for r0 in range(0, 20, 8):
            for c0 in range(0, 23, 8):
                part = a[r0 : r0 + 8, c0 : c0 + 8]
                rows.append((1, band, r0, c0, *part.shape, [float(v) for v in part.ravel()]))
    blocks = spark.createDataFrame(rows, "raster_id long, band string, row0 int, col0 int, h int, w int, values array<float>")
    pairs = raster.pair_blocks(blocks)
    work = spark.createDataFrame([(1, (5, 3, 11, 9))], "raster_id long, window struct<col_off:int,row_off:int,width:int,height:int>")
    got = {(r.row, r.col): (r.red, r.nir) for r in raster.crop_blocks(blocks, work).collect()}
    assert got == {(r, c): (float(red[r, c]), float(nir[r, c])) for r in range(3, 12) for c in range(5, 16)}
    flat = {(r.row, r.col): r.ndvi for r in raster.ndvi(raster.explode_blocks(pairs)).collect()}
    block = raster.ndvi_blocks(pairs).select("row0", "col0", "w", F.posexplode("ndvi").alias("p", "v")).collect()
    assert {(r.row0 + r.p // r.w, r.col0 + r.p % r.w): r.v for r in block} == flat


def test_other_tilings_pair_by_pixel(spark):
    kind = "raster_id long, band string, row0 int, col0 int, h int, w int, values array<float>"
    whole = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, "red", 0, 0, 2, 2, whole), (1, "nir", 0, 0, 1, 2, [5.0, 6.0]), (1, "nir", 1, 0, 1, 2, [7.0, 8.0]), (2, "red", 0, 0, 2, 2, whole), (3, "red", 0, 0, 2, 2, whole), (3, "nir", 1, 1, 2, 2, [9.0, 0.0, 0.0, 0.0])]
    got = sorted(tuple(r) for r in raster.explode_blocks(raster.pair_blocks(spark.createDataFrame(rows, kind))).collect())
    assert got == [(1, 0, 0, 1.0, 5.0), (1, 0, 1, 2.0, 6.0), (1, 1, 0, 3.0, 7.0), (1, 1, 1, 4.0, 8.0), (3, 1, 1, 4.0, 9.0)]


def test_full_summary_is_both(spark):
    rng = np.random.default_rng(5)
    rows = [(k, None if v < -0.9 else float(v)) for k in (1, 2) for v in rng.uniform(-1, 1, 700)] + [(3, None)]
    df = spark.createDataFrame(rows, "raster_id long, ndvi double")
    want = {r.raster_id: r.asDict() for r in summary.summary(df).join(summary.scaled_percentiles(df), "raster_id", "left").collect()}
    got = {r.raster_id: r.asDict() for r in summary.full_summary(df).collect()}
    assert got.keys() == want.keys()
    for k in got:
        assert all(got[k][c] is None if v is None else np.isclose(got[k][c], v, atol=1e-12) for c, v in want[k].items())


def test_writers(spark, tmp_path):
    values = raster.labelled(spark.createDataFrame([(1, 0, 0, 0.5), (1, 0, 1, None), (2, 3, 4, -0.5)], "raster_id long, row int, col int, ndvi float"))
    placed = values.select("label", F.lit("30STJ").alias("tile"), F.lit("2025-07").alias("month"), "row", "col", "ndvi")
    tables.write_raster(placed, str(tmp_path / "r"))
    assert (tmp_path / "r" / "tile=30STJ" / "month=2025-07").is_dir()
    back = tables.read_raster(spark, str(tmp_path / "r"))
    assert sorted((r.label, r.row, r.col, r.ndvi) for r in back.collect() if r.ndvi is not None) == [("ndvi_1", 0, 0, 0.5), ("ndvi_2", 3, 4, -0.5)]
    assert back.count() == 3
    tables.write_summary(summary.summary(values), str(tmp_path / "s"))
    assert {r.raster_id: r.n_valid for r in spark.read.parquet(str(tmp_path / "s")).collect()} == {1: 1, 2: 1}


def test_catalog_filters_reach_the_files(spark, sf_dir, tmp_path, capsys):
    from fieldlight.sources import derived

    tables.write_catalog(derived.items(spark, sf_dir), str(tmp_path / "c"))
    tables.search_catalog(spark, str(tmp_path / "c"), "1996-02-01", "1996-03-15").select("scene_id").explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(x for x in plan.splitlines() if "PushedFilters" in x)
    assert all(f in pushed for f in ("EqualTo(collection,sentinel-2-l2a)", "GreaterThanOrEqual(datetime,1996-02-01T00:00)", "LessThan(datetime,1996-03-16T00:00)"))
    assert "assets" not in next(x for x in plan.splitlines() if "ReadSchema" in x)


def test_catalog_schema(spark, tmp_path):
    row = '{"scene_id":"a","collection":"c","tile":"t","datetime":"2025-07-01T00:00:00","properties":"{}","assets":"{}","bbox":[1,2,3,4],"raster_id":5,"more":1}'
    (tmp_path / "x.json").write_text(row)
    got = tables.read_catalog(spark, str(tmp_path), "json").first()
    assert (got.scene_id, got.raster_id, got.bbox) == ("a", 5, [1.0, 2.0, 3.0, 4.0])


def test_grid_check(spark):
    grid = spark.createDataFrame([(1, "red", 4, 4), (1, "nir", 4, 4), (2, "red", 4, 4), (2, "nir", 4, 5), (3, "red", 4, 4), (3, "nir", 5, 4), (4, "red", 4, 4)], "raster_id long, band string, width int, height int")
    assert sorted(r.raster_id for r in raster.mismatched_grids(grid).collect()) == [2, 3, 4]
    assert [tuple(r) for r in raster.matched_grids(grid).collect()] == [(1, 4, 4)]
