"""Stored tables: item dumps and catalogues, rasters and summaries that grow, blocks whose row groups are skipped; search plans."""

import datetime as dt
import glob
import os
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fieldlight.operators import raster, scenes, summary
from fieldlight.sources import staging, tables

ITEM = (
    '{"type":"Feature","id":"S2A_MSIL2A_20250731T110651_R137_T30STJ_20250731T163616","collection":"sentinel-2-l2a","bbox":[-5.1,36.9,-3.9,37.9],'
    '"properties":{"datetime":"2025-07-31T11:06:51.024Z","eo:cloud_cover":1.5,"proj:code":"EPSG:32630","updated":"2025-08-01T00:00:00Z"},'
    '"assets":{"B04_10m":{"href":"s3://a/r.jp2","alternate":{"https":{"href":"https://a/r.jp2"}}},"B08_10m":{"href":"s3://a/n.jp2"}}}'
)
ID = "S2A_MSIL2A_20250731T110651_R137_T30STJ_20250731T163616"


def parsed(spark, *texts):
    return tables.parse_items(spark.createDataFrame([(t,) for t in texts], "value string")).collect()


def test_an_item_as_a_search_returns_it(spark):
    df = tables.parse_items(spark.createDataFrame([(ITEM,)], "value string"))
    (r,) = scenes.resolved(df).collect()
    assert (r.scene_id, r.collection, r.tile, r.month, r.corrupt) == (ID, "sentinel-2-l2a", "30STJ", "2025-07", None)
    assert r.datetime == dt.datetime(2025, 7, 31, 11, 6, 51, 24000) and r.updated == dt.datetime(2025, 8, 1)
    assert (r.red_href, r.nir_href, r.projection.epsg, r.bbox) == ("https://a/r.jp2", "s3://a/n.jp2", 32630, [-5.1, 36.9, -3.9, 37.9])


def test_time_does_not_depend_on_the_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        (r,) = parsed(spark, ITEM)
        assert r.datetime == dt.datetime(2025, 7, 31, 11, 6, 51, 24000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_pages_broken_lines_and_odd_types(spark):
    page = f'{{"type":"FeatureCollection","features":[{ITEM},{ITEM.replace(ID, "other")}]}}'
    assert [r.scene_id for r in parsed(spark, page)] == [ID, "other"]
    assert parsed(spark, '{"features":[]}') == []
    bad = [ITEM[:-5], "no json", '{"id":7,"properties":{"datetime":"2025-01-01T00:00:00Z"}}', '{"id":"x","properties":{"datetime":"soon"}}', "[]", "null", '{"id":"","properties":{"datetime":"2025-01-01T00:00:00Z"}}']
    assert [(r.scene_id, r.corrupt) for r in parsed(spark, *bad)] == [(None, t) for t in bad]
    (r,) = parsed(spark, '{"id":"x","properties":{"datetime":null,"start_datetime":"2025-01-01T00:00:00Z"},"bbox":"none"}')
    assert (r.scene_id, r.bbox, r.assets, r.tile, r.month) == ("x", None, None, None, "2025-01")


def test_dump_and_read_again(spark, tmp_path):
    rows = tables.parse_items(spark.createDataFrame([(ITEM,)], "value string")).withColumn("raster_id", F.lit(5).cast("long"))
    tables.dump_items(rows).write.text(str(tmp_path / "d"))
    (a,), (b,) = rows.drop("properties").collect(), tables.read_items(spark, str(tmp_path / "d")).drop("properties").collect()
    assert a.asDict() == b.asDict()


def catalog(spark, rows):
    """rows: (id, day, day of change, text)."""
    out = [(i, "c", None, dt.datetime.fromisoformat(day), text, "{}", None, None, None if ch is None else dt.datetime.fromisoformat(ch), day[:7]) for i, day, ch, text in rows]
    return spark.createDataFrame(out, tables.CATALOG)


def content(spark, path):
    return sorted((r.scene_id, str(r.datetime.date()), r.properties, r.month) for r in tables.read_catalog(spark, path).collect())


def test_merge_keeps_the_newest_and_other_months(spark, tmp_path):
    path = str(tmp_path / "c")
    tables.merge_catalog(catalog(spark, [("a", "2024-01-05", "2024-02-01", "a1"), ("b", "2024-02-05", None, "b1"), ("c", "2024-03-01", "2024-03-02", "c1")]), path)
    untouched = sorted(glob.glob(f"{path}/month=2024-03/*"))
    # A newer a, an older one, b with a time of change at last, and an equal row again.
    for _ in range(2):
        tables.merge_catalog(catalog(spark, [("a", "2024-01-06", "2024-02-02", "a2"), ("a", "2024-01-07", "2024-01-31", "a0"), ("b", "2024-02-05", "2024-01-01", "b2"), ("d", "2024-01-09", None, "d1")]), path)
        assert content(spark, path) == [("a", "2024-01-06", "a2", "2024-01"), ("b", "2024-02-05", "b2", "2024-02"), ("c", "2024-03-01", "c1", "2024-03"), ("d", "2024-01-09", "d1", "2024-01")]
    assert sorted(glob.glob(f"{path}/month=2024-03/*")) == untouched
    # A scene that moves to another month leaves its folder, which is gone with it.
    tables.merge_catalog(catalog(spark, [("c", "2024-01-31", "2024-06-01", "c2")]), path)
    assert ("c", "2024-01-31", "c2", "2024-01") in content(spark, path) and len(content(spark, path)) == 4
    assert glob.glob(f"{path}/month=2024-03") == []


def test_merge_in_rounds(spark, tmp_path, monkeypatch):
    """Months are merged some at a time, and scenes that change their months between rounds are neither lost nor there twice."""
    assert tables.rounds({"b": 3, None: 1, "a": 2, "c": 9, "d": 0, "e": 1}, 4) == [[None, "a"], ["b"], ["c"], ["d", "e"]]
    rng, path, known, most = random.Random(7), str(tmp_path / "c"), {}, 12
    written, replace = [], tables.replace_folders
    monkeypatch.setattr(tables, "replace_folders", lambda rows, *a: written.append({r.month: r["count"] for r in rows.groupBy("month").count().collect()}) or replace(rows, *a))
    for batch in range(3):
        rows = [(f"s{rng.randrange(30)}", f"2024-{rng.randrange(1, 7):02}-{rng.randrange(1, 3):02}", rng.choice([None, "2024-07-01", "2024-07-02"]), f"{batch}.{k % 3}") for k in range(40)]
        tables.merge_catalog(catalog(spark, rows), path, most)
        for i, day, changed, text in rows:
            known[i] = max(known.get(i, ("", "", "")), (changed or "", day, text))
        assert content(spark, path) == sorted((i, day, text, day[:7]) for i, (_, day, text) in known.items())
    assert len(written) >= 9 and all(sum(w.values()) <= most or len(w) == 1 for w in written)


def pixels(spark, rows):
    return spark.createDataFrame(rows, "label string, tile string, month string, row int, col int, ndvi float")


def test_a_month_leaves_others_alone(spark, tmp_path):
    path = str(tmp_path / "r")
    january, february = [("a", "T1", "1995-01", 0, i, 0.5) for i in range(3)], [("b", "T1", "1995-02", 0, i, 0.25) for i in range(3)]
    read = lambda: sorted((r.label, r.tile, r.month, r.row, r.col, r.ndvi) for r in tables.read_raster(spark, path).collect())
    tables.write_raster(pixels(spark, january), path)
    kept = sorted(glob.glob(f"{path}/tile=T1/month=1995-01/*"))
    tables.write_raster(pixels(spark, february), path)
    assert read() == january + february and sorted(glob.glob(f"{path}/tile=T1/month=1995-01/*")) == kept
    # A rerun changes nothing; another scene of the month leaves the first alone; a scene that has shrunk loses its old pixels.
    tables.write_raster(pixels(spark, january), path)
    tables.write_raster(pixels(spark, [("c", "T1", "1995-01", 1, 1, -1.0)]), path)
    tables.write_raster(pixels(spark, february[:1]), path)
    assert read() == [*january, february[0], ("c", "T1", "1995-01", 1, 1, -1.0)]
    tables.write_raster(pixels(spark, []), path)
    assert len(read()) == 5


def test_summaries_by_scene_and_window(spark, tmp_path):
    path, names = str(tmp_path / "s"), [x.split()[0] for x in tables.SUMMARIES.split(", ")]
    row = lambda scene, width, low: (scene, 0, 0, width, 4, 9, 8, low, 0.1, 0.2, 0.3, 0.4, 0.2, "1995-01")
    for rows in ([row("a", 4, 0.0), row("a", 8, 0.0)], [row("a", 4, -1.0), row("b", 4, 0.0)], [row("b", 4, 0.0)]):
        tables.write_summary(spark.createDataFrame(rows, tables.SUMMARIES).select(*reversed(names)), path, tables.SUMMARY_KEYS, ("month",))
    assert sorted((r.scene_id, r.width, r.low) for r in tables.read_summary(spark, path).collect()) == [("a", 4, -1.0), ("a", 8, 0.0), ("b", 4, 0.0)]
    plain = str(tmp_path / "p")
    for part in ([(k, k) for k in range(50)], [(k, -k) for k in range(25, 75)]) * 2:
        tables.write_summary(spark.createDataFrame(part, "raster_id long, n_valid long"), plain)
    got = {r.raster_id: r.n_valid for r in tables.read_summary(spark, plain, "raster_id long, n_valid long").collect()}
    assert got == {k: k if k < 25 else -k for k in range(75)}
    with pytest.raises(ValueError, match="n_valid"):
        tables.write_summary(spark.createDataFrame([(1,)], "raster_id long"), plain)


def test_window_skips_row_groups(spark, tmp_path, capsys):
    """One raster of 64 x 64 blocks of 8 x 8: a window of 3 x 3 blocks reads a small part of the row groups, in any corner."""
    path, n = str(tmp_path / "b"), 64
    grid = spark.range(n * n).select(F.lit(1).cast("long").alias("raster_id"), F.lit("red").alias("band"), (F.expr("id div 64") * 8).cast("int").alias("row0"), (F.col("id") % 64 * 8).cast("int").alias("col0"), F.lit(8).alias("h"), F.lit(8).alias("w"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: (i + F.col("id")).cast("float")).alias("values"))
    tables.write_blocks(grid.orderBy(F.rand(1)), path, cell=8, group_bytes=16 << 10)
    groups = [g for f in glob.glob(f"{path}/*.parquet") for m in [pq.ParquetFile(f).metadata] for g in (m.row_group(i) for i in range(m.num_row_groups))]
    assert len(groups) >= 30
    at = {groups[0].column(i).path_in_schema: i for i in range(groups[0].num_columns)}
    bounds = lambda g, c: (g.column(at[c]).statistics.min, g.column(at[c]).statistics.max)
    for row, col in ((0, 0), (200, 300), (488, 488), (480, 8)):
        near = [g for g in groups if bounds(g, "row0")[0] < row + 24 and bounds(g, "col0")[0] < col + 24 and bounds(g, "row1")[1] > row and bounds(g, "col1")[1] > col]
        assert len(near) <= max(4, len(groups) // 5)
        window = tables.read_window(tables.read_blocks(spark, path), row, col, 24, 24)
        got = sorted((r.row0, r.col0) for r in window.collect())
        assert got == [(r, c) for r in range(0, 512, 8) for c in range(0, 512, 8) if r < row + 24 and r + 8 > row and c < col + 24 and c + 8 > col]
    window.explain("formatted")
    pushed = next(x for x in capsys.readouterr().out.splitlines() if "PushedFilters" in x)
    assert all(f in pushed for f in ("LessThan(row0,504)", "LessThan(col0,32)", "GreaterThan(row1,480)", "GreaterThan(col1,8)"))


def test_windows_of_many_rasters(spark, tmp_path, capsys):
    path = str(tmp_path / "b")
    rows = [(k, b, r, c, 4, 4, [float(k)] * 16) for k in range(30) for b in ("red", "nir") for r in (0, 4, 8) for c in (0, 4, 8)]
    tables.write_blocks(spark.createDataFrame(rows, BLOCK), path, cell=4)
    win = "raster_id long, window struct<col_off:int,row_off:int,width:int,height:int>"
    work = spark.createDataFrame([(3, (0, 0, 5, 4)), (3, (9, 9, 1, 1)), (7, (4, 4, 4, 4)), (99, (0, 0, 9, 9))], win)
    want = sorted([(3, 0, 0, 0), (3, 0, 4, 0), (3, 8, 8, 9), (7, 4, 4, 4)] * 2)
    for most in (1_000, 2):
        near = tables.read_windows(tables.read_blocks(spark, path), work, most)
        assert sorted((r.raster_id, r.row0, r.col0, r.window.col_off) for r in near.collect()) == want
        near.explain("formatted")
        assert ("In(raster_id" in capsys.readouterr().out) == (most == 1_000)
    assert tables.read_windows(tables.read_blocks(spark, path), work.limit(0)).collect() == []


def test_pages_in_files(spark, tmp_path):
    (tmp_path / "p.json").write_text(f'{{"type":"FeatureCollection",\n "features":[\n{ITEM},\n{ITEM.replace(ID, "other")}]\n}}')
    assert [r.scene_id for r in tables.read_items(spark, str(tmp_path), whole_files=True).collect()] == [ID, "other"]


def test_z_order(spark):
    z = lambda r, c: sum((r >> b & 1) << (2 * b + 1) | (c >> b & 1) << (2 * b) for b in range(20))
    places = [(0, 0), (1, 0), (0, 1), (5, 9), (1023, 77), (1 << 19, (1 << 20) - 1)]
    got = spark.createDataFrame(places, "r int, c int").select("r", "c", tables.z_order(F.col("r"), F.col("c")).alias("z")).collect()
    assert all(x.z == z(x.r, x.c) for x in got)


def test_scopes_remove_what_they_made(spark):
    here = lambda p: os.path.isdir(p.removeprefix("file://"))
    outer = staging.scratch(spark, "outer")
    spark.range(3).write.parquet(outer)
    with staging.scope(spark):
        first = staging.cut(spark.range(5), "first")
        with staging.scope(spark):
            inner = staging.scratch(spark, "inner")
            spark.range(3).write.parquet(inner)
        path = first.inputFiles()[0]
        assert not here(inner) and os.path.exists(path.removeprefix("file://")) and first.count() == 5
        staging.scratch(spark, "never written")
    assert not os.path.exists(path.removeprefix("file://")) and here(outer)
    with pytest.raises(ValueError), staging.scope(spark):
        lost = staging.scratch(spark, "lost")
        spark.range(1).write.parquet(lost)
        raise ValueError
    assert not here(lost)


# --- pairing and crops of any tiling


def tiling(rng, band, height, width, sides):
    """Blocks of random sides that cover a frame."""
    out, row = [], 0
    while row < height:
        h, col = min(rng.choice(sides), height - row), 0
        while col < width:
            w = min(rng.choice(sides), width - col)
            out.append((1, band, row, col, h, w, [float((row + i // w) * 1000 + col + i % w + (band == "nir") * 0.5) for i in range(h * w)]))
            col += w
        row += h
    return out


BLOCK = "raster_id long, band string, row0 int, col0 int, h int, w int, values array<float>"


@pytest.mark.parametrize("side", [None, 3, 50])
def test_any_tilings_pair(spark, side):
    rng = random.Random(3)
    df = spark.createDataFrame(tiling(rng, "red", 23, 31, [1, 4, 9]) + tiling(rng, "nir", 20, 40, [2, 7, 16]), BLOCK)
    pairs = raster.pair_blocks(df, side=side)
    got = sorted((r.row, r.col, r.red, r.nir) for r in raster.explode_blocks(pairs).collect())
    assert got == [(r, c, r * 1000.0 + c, r * 1000 + c + 0.5) for r in range(20) for c in range(31)]
    assert pairs.count() < 20 * 31 / 4
    alike = raster.pair_blocks(spark.createDataFrame([(1, b, r, c, 8, 8, [1.0] * 64) for b in ("red", "nir") for r in (0, 8) for c in (0, 8)], BLOCK))
    assert sorted((x.row0, x.col0, x.h, x.w) for x in alike.collect()) == [(0, 0, 8, 8), (0, 8, 8, 8), (8, 0, 8, 8), (8, 8, 8, 8)]
    assert raster.pair_blocks(df.where("band = 'red'")).collect() == [] and raster.pair_blocks(df.limit(0)).collect() == []


def test_crops_hold_the_window_alone(spark):
    rng = random.Random(4)
    df = spark.createDataFrame(tiling(rng, "red", 30, 30, [5, 8]) + tiling(rng, "nir", 30, 30, [3, 11]), BLOCK)
    win = "raster_id long, window struct<col_off:int,row_off:int,width:int,height:int>, request long"
    work = spark.createDataFrame([(1, (7, 4, 10, 13), 1), (1, (7, 4, 10, 13), 2), (1, (0, 0, 2, 1), 3), (2, (0, 0, 5, 5), 4)], win)
    parts = raster.cropped_blocks(df, work)
    assert parts.agg(F.sum(F.size("values"))).first()[0] == 2 * (130 + 2)
    got = sorted((r.window.col_off, r.row, r.col, r.red, r.nir) for r in raster.crop_blocks(df, work).collect())
    inside = [(0, 0, c) for c in range(2)] + [(7, r, c) for r in range(4, 17) for c in range(7, 17)]
    assert got == [(o, r, c, r * 1000.0 + c, r * 1000 + c + 0.5) for o, r, c in inside]


# --- search


def scene_rows(spark, ids, day="2024-05-05"):
    rows = [(i, "sentinel-2-l2a", None, dt.datetime.fromisoformat(day), '{"eo:cloud_cover":5}', "{}", None, 1) for i in ids]
    return spark.createDataFrame(rows, tables.ITEMS)


def asked(spark, tiles):
    rows = [(k, t, "2024-05-01", "2024-05-31", 0.12, None, None) for k, t in enumerate(tiles)]
    return spark.createDataFrame(rows, "request_id long, tile string, start_date string, end_date string, crop_fraction double, max_cloud_cover double, preferred_scene_id string")


def test_tiles_of_any_form(spark):
    ids = ["S2A_MSIL2A_20240505T110651_R137_T30STJ_20240505T163616", "S2B_x_T30STK_1", "S2B_x_t30stj_1", "S1A_x_T30STJ_1", "S2A_T31STJ", "S2A_T31STJ_", "S2_T9_T30STJ1", "S2AT30STJ", "S2AT30STJz", "S2A_TT30STJx", "S2A_T"]
    tiles = ["30STJ", "30stj", "3_STJ", "30ST", "30ST_", "_____", "3%J", "%", "", "_", "30STJ_2024", "30S%\\_1", "T30STJ", "99ZZZ", "1_____", "3__T", "30STJ\\_2", None]

    def like(pattern, text):
        out, i = "", 0
        while i < len(pattern):
            c = pattern[i]
            if c == "\\" and i + 1 < len(pattern):
                i += 1
                out += re.escape(pattern[i])
            else:
                out += {"%": ".*", "_": "."}.get(c, re.escape(c))
            i += 1
        return re.fullmatch(out, text, re.S) is not None

    got = sorted((r.request_id, r.scene_id) for r in scenes.found_items(asked(spark, tiles), scene_rows(spark, ids)).collect())
    assert got == sorted((k, i) for k, t in enumerate(tiles) if t is not None for i in ids if like(f"S2%_T{t.upper()}_%", i))


def test_plain_requests_key_each_scene_once(spark):
    ids = [f"S2A_x_T{10 + k % 20}STJ_{k}" for k in range(200)]
    found = scenes.found_items(asked(spark, ["10STJ", "11STJ"]), scene_rows(spark, ids))
    assert found.count() == 20
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_global_cap_takes_ordered(spark):
    ids = [f"S2A_x_T10STJ_{k}" for k in range(50)]
    found = scenes.found_items(asked(spark, ["10STJ"] * 3), scene_rows(spark, ids))
    first = scenes.first_items(found, 7)
    want = sorted((i, k) for i in ids for k in range(3))[:7]
    assert [(r.scene_id, r.request_id) for r in first.collect()] == want
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


# --- sketches


def test_merged_sketches_are_near(spark):
    rng = random.Random(5)
    values = [(s, float(min(1, max(-1, rng.gauss(0.3, 0.2))))) for s in range(20) for _ in range(rng.choice([1, 50, 3000]))] + [(0, None)]
    df = spark.createDataFrame(values, "scene int, ndvi float").repartition(7)
    parts = summary.sketches(df, ["scene"]).withColumn("month", F.lit("m"))
    (r,) = summary.sketched_percentiles(summary.merged_sketches(parts, ["month"]), ["month"]).collect()
    known = sorted(v for _, v in values if v is not None)
    assert r.n_valid == len(known)
    for name, p in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9)):
        rank = sum(v <= r[name] + 1e-7 for v in known) / len(known)
        assert abs(rank - p) <= 3 * summary.rank_error()
    assert max(len(x.sketch) for x in parts.collect()) < 20_000
    few = summary.sketched_percentiles(summary.sketches(spark.createDataFrame([(1, 0.5), (1, 0.25), (2, None)], "scene int, ndvi float"), ["scene"]), ["scene"]).collect()
    assert [(x.scene, x.n_valid, x.p10, x.p90) for x in few] == [(1, 2, 0.25, 0.5)]


def test_files_do_not_multiply_with_tasks(spark, tmp_path):
    """A task writes neighbouring folders: no more files than tasks and folders together."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    day = lambda k: dt.datetime(2024, 1, 1, 11) + dt.timedelta(days=k)
    rows = spark.createDataFrame([(f"S{k}", None, None, day(k), "{}", "{}", None, k, day(k), f"{day(k):%Y-%m}") for k in range(200)], tables.CATALOG)
    pixels = rows.select(F.col("scene_id").alias("label"), F.lit(0).alias("row"), F.lit(0).alias("col"), F.lit(0.5).cast("float").alias("ndvi"), F.lit("T1").alias("tile"), "month")
    try:
        for n, v in zip(names, ("8", "false"), strict=True):
            spark.conf.set(n, v)
        tables.merge_catalog(rows, f"{tmp_path}/catalogue")
        tables.write_raster(pixels, f"{tmp_path}/rasters")
    finally:
        for n, v in zip(names, before, strict=True):
            spark.conf.set(n, v)
    assert tables.read_catalog(spark, f"{tmp_path}/catalogue").count() == tables.read_raster(spark, f"{tmp_path}/rasters").count() == 200
    assert len(glob.glob(f"{tmp_path}/catalogue/month=*/*.parquet")) <= 8 + 7
    assert len(glob.glob(f"{tmp_path}/rasters/tile=*/month=*/*.parquet")) <= 8 + 7
