"""DuckDB twins of the queries, over the same tables."""

from __future__ import annotations


def _asset(key: str, band: str) -> str:
    own = """CASE WHEN k % 6 = 3 THEN ',"proj:epsg":' || z ELSE '' END""" if band == "nir" else """CASE WHEN k % 6 = 5 THEN ',"proj:code":"EPSG:' || z || '"' ELSE '' END"""
    alternate = f"""CASE WHEN k % 7 = 5 THEN ',"alternate":{{"https":{{"href":"https://example.org/' || scene_id || '/{key}.jp2"}}}}' WHEN k % 7 = 6 THEN ',"alternate":{{"https":{{"href":""}}}}' ELSE '' END"""
    return f"""('"{key}":{{"href":"s3://example-scenes/' || scene_id || '/{key}.jp2"' || {alternate} || {own} || '}}')"""


_P1, _P2, _P3, _P4 = (f"{_asset(r, 'red')} || ',' || {_asset(n, 'nir')}" for r, n in (("B04", "B08"), ("red", "nir"), ("B04_10m", "B08_10m"), ("B04", "nir")))

ITEMS = f"""
raw AS (SELECT o_orderkey AS k, c_nationkey AS n, o_orderdate AS d, (10 + c_nationkey)::VARCHAR || 'STJ' AS tile, (32610 + c_nationkey)::VARCHAR AS z,
    ((o_orderkey * 37 % 10001) // 100)::VARCHAR || '.' || lpad(((o_orderkey * 37 % 10001) % 100)::VARCHAR, 2, '0') AS cc
  FROM orders JOIN customer ON o_custkey = c_custkey),
named AS (SELECT *, CASE WHEN k % 50 = 0 THEN 'S1' ELSE 'S2' END || CASE WHEN k % 2 = 0 THEN 'A' ELSE 'B' END || '_MSIL2A_' || strftime(d, '%Y%m%d') || 'T110000_R137_T'
    || CASE WHEN k % 53 = 0 THEN lower(tile) ELSE tile END || '_' || lpad(k::VARCHAR, 10, '0') AS scene_id FROM raw),
items AS (SELECT scene_id, CASE WHEN k % 20 = 0 THEN 'sentinel-2-l1c' ELSE 'sentinel-2-l2a' END AS collection, tile, d + INTERVAL 11 HOUR AS ts,
    '{{' || concat_ws(',', CASE WHEN k % 10 = 0 THEN NULL WHEN k % 10 IN (1, 2) THEN '"cloudCover":' || cc WHEN k % 10 = 3 THEN '"eo:cloud_cover":' || cc || ',"cloudCover":1.5'
      WHEN k % 10 = 4 THEN '"eo:cloud_cover":"' || cc || '"' ELSE '"eo:cloud_cover":' || cc END,
      CASE k % 6 WHEN 0 THEN '"proj:epsg":' || z WHEN 1 THEN '"proj:code":"EPSG:' || z || '"' WHEN 2 THEN '"proj:code":"epsg:' || z || '"' WHEN 3 THEN NULL WHEN 4 THEN '"proj:code":"IAU_2015:30100"' ELSE '"proj:epsg":"' || z || '"' END) || '}}' AS properties,
    '{{' || CASE WHEN k % 7 IN (0, 5) THEN {_P1} WHEN k % 7 IN (1, 6) THEN {_P2} WHEN k % 7 = 2 THEN {_P3} WHEN k % 7 = 3 THEN {_P1} || ',' || {_P2} || ',' || {_P3} ELSE {_P4} END || '}}' AS assets,
    CASE WHEN k % 13 = 0 THEN NULL WHEN k % 11 = 0 THEN [n::DOUBLE, n + 1.0, 0.0, n + 1.5, n + 2.0, 100.0] ELSE [n::DOUBLE, n + 1.0, n + 1.5, n + 2.0] END AS bbox,
    k % (SELECT count(*) FROM supplier) AS raster_id FROM named)"""

CLOUD = """coalesce(try_cast(json_extract_string(properties, '$."eo:cloud_cover"') AS DOUBLE), try_cast(json_extract_string(properties, '$.cloudCover') AS DOUBLE), 100.0)"""

PIXELS = """
pixels AS (SELECT l_suppkey AS raster_id, (l_orderkey % 64)::INT AS "row", (l_partkey % 64)::INT AS col,
    max(CASE WHEN (l_discount = 0 AND l_tax = 0) OR l_suppkey % 10 = 7 THEN 0 ELSE floor(l_quantity) * 100 END)::INT AS red,
    max(CASE WHEN (l_discount = 0 AND l_tax = 0) OR l_suppkey % 10 = 7 THEN 0 ELSE floor(l_extendedprice) % 10000 END)::INT AS nir
  FROM lineitem GROUP BY 1, 2, 3)"""

_RATIO = "(nir::FLOAT - red::FLOAT) / (nir::FLOAT + red::FLOAT)"
_NDVI = f"CASE WHEN nir::FLOAT + red::FLOAT <> 0 THEN CASE WHEN isnan({_RATIO}) THEN NULL ELSE greatest(-1.0::FLOAT, least(1.0::FLOAT, {_RATIO})) END END"
NDVI = PIXELS + f""",
ndvi AS (SELECT *, ({_NDVI})::DOUBLE AS v FROM pixels)"""

BLOCKS = """
blocks AS (SELECT vec_id // 8 AS raster_id, CASE WHEN vec_id % 2 = 0 THEN 'red' ELSE 'nir' END AS band, (vec_id // 4 % 2 * 8)::INT AS row0, (vec_id // 2 % 4 % 2 * 8)::INT AS col0, embedding AS vals FROM embeddings),
cells AS (SELECT raster_id, band, row0 + i // 8 AS "row", col0 + i % 8 AS col, vals[i + 1] AS value FROM blocks, (SELECT unnest(range(64)) AS i)),
pairs AS (SELECT raster_id, "row", col, max(value) FILTER (band = 'red') AS red, max(value) FILTER (band = 'nir') AS nir FROM cells GROUP BY 1, 2, 3
  HAVING count(*) FILTER (band = 'red') > 0 AND count(*) FILTER (band = 'nir') > 0)"""

TILED = """
blocks AS (SELECT vec_id // 8 AS raster_id, vec_id // 2 % 4 AS part, vec_id % 2 = 1 AND vec_id // 8 % 3 = 1 AS other, CASE WHEN vec_id % 2 = 0 THEN 'red' ELSE 'nir' END AS band, embedding AS vals FROM embeddings),
cells AS (SELECT raster_id, band, (CASE WHEN other THEN part * 4 + i // 16 ELSE part // 2 * 8 + i // 8 END)::INT AS "row", (CASE WHEN other THEN i % 16 ELSE part % 2 * 8 + i % 8 END)::INT AS col, vals[i + 1] AS value FROM blocks, (SELECT unnest(range(64)) AS i)),
pairs AS (SELECT raster_id, "row", col, max(value) FILTER (band = 'red') AS red, max(value) FILTER (band = 'nir') AS nir FROM cells GROUP BY 1, 2, 3
  HAVING count(*) FILTER (band = 'red') > 0 AND count(*) FILTER (band = 'nir') > 0)"""

REQUESTS = """
months AS (SELECT c_custkey AS request_id, c_nationkey AS n, (10 + c_nationkey)::VARCHAR || 'STJ' AS own, strftime(DATE '1995-01-01' + to_months((c_custkey % 80)::INT), '%Y-%m') AS mon FROM customer),
last_of AS (SELECT tile, strftime(ts, '%Y-%m') AS mon, max(scene_id) AS last_id FROM items GROUP BY 1, 2),
requests AS (SELECT request_id, CASE WHEN n = 24 THEN '99ZZZ' WHEN request_id % 41 = 0 THEN left(own, 4) WHEN request_id % 43 = 0 THEN left(own, 1) || '_' || own[3:] WHEN request_id % 4 = 0 THEN lower(own) ELSE own END AS tile, months.mon || '-01' AS start_date,
    CASE WHEN request_id % 101 = 0 THEN 'bad' ELSE months.mon || '-28' END AS end_date, CASE WHEN request_id % 89 = 0 THEN 0.0 WHEN request_id % 5 = 0 THEN 0.5 ELSE 0.12 END::DOUBLE AS crop_fraction,
    CASE WHEN request_id % 97 = 0 THEN 150.0 WHEN request_id % 7 = 0 THEN NULL ELSE 10.0 END::DOUBLE AS cap,
    CASE WHEN request_id % 3 = 0 THEN last_id WHEN request_id % 3 = 1 THEN 'none' END AS preferred
  FROM months LEFT JOIN last_of ON own = last_of.tile AND months.mon = last_of.mon),
checked AS (SELECT *, try_strptime(start_date, '%Y-%m-%d') AS s, try_strptime(end_date, '%Y-%m-%d') AS e,
    CASE WHEN try_strptime(start_date, '%Y-%m-%d') IS NULL OR try_strptime(end_date, '%Y-%m-%d') IS NULL THEN 'bad_date' WHEN crop_fraction <= 0 OR crop_fraction > 0.5 THEN 'bad_crop' WHEN cap < 0 OR cap > 100 THEN 'bad_cloud_cap' END AS error FROM requests)"""

FOUND = f"""
found AS (SELECT request_id, cap, preferred, crop_fraction, i.*, {CLOUD} AS cloud FROM checked r JOIN items i
  ON i.scene_id LIKE 'S2%_T' || upper(r.tile) || '_%' AND i.ts >= s AND i.ts < e + INTERVAL 1 DAY WHERE error IS NULL AND collection = 'sentinel-2-l2a'),
cands AS (SELECT * FROM found WHERE cap IS NULL OR cloud <= cap),
counts AS (SELECT r.request_id, count(f.request_id) AS n_items, count(f.request_id) FILTER (f.cap IS NULL OR f.cloud <= f.cap) AS n_candidates FROM requests r LEFT JOIN found f USING (request_id) GROUP BY 1),
picked AS (SELECT *, CASE WHEN scene_id = preferred THEN 'preferred' WHEN coalesce(preferred, '') <> '' THEN 'fallback' ELSE 'lowest_cloud' END AS reason FROM cands
  QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY coalesce(scene_id = preferred, false) DESC, cloud, scene_id) = 1)"""


def _resolved(source: str) -> str:
    code = lambda o: f"""json_type({o}, '$."proj:epsg"') IN ('BIGINT', 'UBIGINT')"""
    named = lambda o: f"""upper(json_extract_string({o}, '$."proj:code"')) LIKE 'EPSG:%' AND json_type({o}, '$."proj:code"') = 'VARCHAR'"""
    cases = " ".join(f"""WHEN {code(o)} THEN try_cast(json_extract_string({o}, '$."proj:epsg"') AS INT) WHEN {named(o)} THEN try_cast(regexp_extract(json_extract_string({o}, '$."proj:code"'), '^[^:]*:(.*)$', 1) AS INT)""" for o in ("properties", "red_asset", "nir_asset"))
    any_of = " OR ".join(f"coalesce({code(o)}, false) OR coalesce({named(o)}, false)" for o in ("properties", "red_asset", "nir_asset"))
    href = lambda a: f"coalesce(nullif(json_extract_string({a}, '$.alternate.https.href'), ''), nullif(json_extract_string({a}, '$.href'), ''))"
    has = lambda k: f"list_contains(json_keys(assets), '{k}')"
    red = f"CASE WHEN {has('B04')} AND {has('B08')} THEN 'B04' WHEN {has('red')} AND {has('nir')} THEN 'red' WHEN {has('B04_10m')} AND {has('B08_10m')} THEN 'B04_10m' END"
    nir = f"CASE WHEN {has('B04')} AND {has('B08')} THEN 'B08' WHEN {has('red')} AND {has('nir')} THEN 'nir' WHEN {has('B04_10m')} AND {has('B08_10m')} THEN 'B08_10m' END"
    return f"""
keyed AS (SELECT *, {red} AS red_key, {nir} AS nir_key FROM {source}),
assets_of AS (SELECT *, json_extract(assets, '$."' || red_key || '"') AS red_asset, json_extract(assets, '$."' || nir_key || '"') AS nir_asset FROM keyed),
resolved AS (SELECT *, ({any_of}) AS found, CASE {cases} END AS epsg, {href('red_asset')} AS red_href, {href('nir_asset')} AS nir_href FROM assets_of),
judged AS (SELECT *, CASE WHEN red_key IS NULL THEN 'no_bands' WHEN found AND epsg IS NULL THEN 'bad_epsg' WHEN NOT found THEN 'no_epsg' WHEN red_href IS NULL OR nir_href IS NULL THEN 'no_href' END AS scene_error FROM resolved)"""


def _window(w: str, h: str, f: str) -> str:
    part = lambda n: f"CASE WHEN {f} > 0 AND {f} <= 0.5 THEN greatest(1, least(round_even({n} * (2 * {f}), 0)::INT, {n})) ELSE {n} END"
    return f"greatest(0, ({w} - ({part(w)})) // 2) AS col_off, greatest(0, ({h} - ({part(h)})) // 2) AS row_off, {part(w)} AS out_width, {part(h)} AS out_height"


_INSIDE = '"row" >= row_off AND "row" < row_off + out_height AND col >= col_off AND col < col_off + out_width'
_DEFAULT = f"wins AS (SELECT s_suppkey AS raster_id, {_window('64', '64', '0.12::DOUBLE')} FROM supplier)"
_ROUND = lambda *cs: ", ".join(f"round({c}::DOUBLE, 6) AS {c}" for c in cs)
_STATS = "count(*) AS n_pixels, count(v) AS n_valid, round(min(v), 6) AS low, round(quantile_cont(v, 0.1), 6) AS p10, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.9), 6) AS p90, round(max(v), 6) AS high, round(avg(v), 6) AS mean"
_BOX = lambda f: f"""CASE WHEN len(bbox) = 4 THEN round((bbox[1] + bbox[3]) / 2 - (bbox[3] - bbox[1]) * {f}, 6) END AS west, CASE WHEN len(bbox) = 4 THEN round((bbox[2] + bbox[4]) / 2 - (bbox[4] - bbox[2]) * {f}, 6) END AS south,
  CASE WHEN len(bbox) = 4 THEN round((bbox[1] + bbox[3]) / 2 + (bbox[3] - bbox[1]) * {f}, 6) END AS east, CASE WHEN len(bbox) = 4 THEN round((bbox[2] + bbox[4]) / 2 + (bbox[4] - bbox[2]) * {f}, 6) END AS north"""  # noqa: E731
_PERCENTILES = f"WITH {NDVI} SELECT raster_id, round(quantile_cont(v, 0.1), 6) AS p10, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.9), 6) AS p90 FROM ndvi WHERE v IS NOT NULL GROUP BY 1"
_WORK = f"""
grids AS (SELECT s_suppkey AS raster_id, 64 AS width, 64 AS height FROM supplier WHERE s_suppkey % 9 <> 4),
todo AS (SELECT request_id, raster_id, scene_id, tile, ts, {_window('width', 'height', 'crop_fraction')} FROM judged JOIN grids USING (raster_id) WHERE scene_error IS NULL)"""

ORACLE_SQL: dict[str, str] = {
    "catalog_scan": f"WITH {ITEMS} SELECT scene_id, collection, tile, strftime(ts, '%Y-%m-%d %H:%M:%S') AS seen, properties, assets, raster_id FROM items",
    "catalog_search": f"WITH {ITEMS} SELECT scene_id, collection, strftime(ts, '%Y-%m-%d %H:%M:%S') AS seen, raster_id FROM items WHERE ts >= DATE '1996-02-01' AND ts < DATE '1996-03-16' AND collection = 'sentinel-2-l2a'",
    "band_window_read": f"""WITH {BLOCKS} SELECT raster_id, band, "row", col, round(value::DOUBLE, 6) AS value FROM cells WHERE "row" BETWEEN 3 AND 11 AND col BETWEEN 2 AND 12""",
    "ndvi_raster": f"""WITH {NDVI}, {_DEFAULT} SELECT 'ndvi_' || raster_id AS label, "row", col, round(v, 6) AS ndvi FROM ndvi JOIN wins USING (raster_id) WHERE {_INSIDE}""",
    "raster_files": f"""WITH {ITEMS}, {REQUESTS}, {FOUND}, {NDVI}, {_resolved('picked')}, {_WORK}
SELECT DISTINCT 'ndvi_' || scene_id AS label, tile, strftime(ts, '%Y-%m') AS month, "row", col, round(v, 6) AS ndvi FROM todo JOIN ndvi USING (raster_id) WHERE {_INSIDE}""",
    "catalog_merge": f"""WITH {ITEMS}, keyed_items AS (SELECT *, right(scene_id, 10)::BIGINT AS k FROM items),
versions AS (SELECT * EXCLUDE (k), ts + INTERVAL 2 DAY AS changed FROM keyed_items WHERE k % 17 <> 0
  UNION ALL SELECT * EXCLUDE (k) REPLACE ('{{"cloudCover":77}}' AS properties), ts + INTERVAL 1 DAY FROM keyed_items WHERE k % 4 = 0),
newest AS (SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY scene_id ORDER BY changed DESC) = 1), {_resolved('newest')}
SELECT scene_id, collection, tile, strftime(ts, '%Y-%m-%d %H:%M:%S') AS seen, strftime(changed, '%Y-%m-%d %H:%M:%S') AS changed, round({CLOUD}, 6) AS cloud_cover, epsg, red_href, len(bbox)::INT AS n_box, raster_id FROM resolved""",
    "catalog_corrupt": f"""WITH {ITEMS} SELECT '{{"type":"Feature","id":"' || scene_id || '","properties":{{' AS corrupt FROM items WHERE right(scene_id, 10)::BIGINT % 17 = 0 AND right(scene_id, 10)::BIGINT % 2 = 1""",
    "block_files": f"""WITH {BLOCKS} SELECT raster_id, band, "row", col, round(value::DOUBLE, 6) AS value FROM cells WHERE "row" BETWEEN 3 AND 11 AND col BETWEEN 2 AND 12""",
    "summary_files": f"""WITH {ITEMS}, {REQUESTS}, {FOUND}, {NDVI}, {_resolved('picked')}, {_WORK},
wins AS (SELECT DISTINCT scene_id, raster_id, strftime(ts, '%Y-%m') AS month, col_off, row_off, out_width, out_height FROM todo)
SELECT scene_id, month, col_off::INT AS col_off, row_off::INT AS row_off, out_width AS width, out_height AS height, {_STATS} FROM wins JOIN ndvi USING (raster_id) WHERE {_INSIDE} GROUP BY ALL HAVING count(v) > 0""",
    "percentile_sketches": f"""WITH {ITEMS}, {REQUESTS}, {FOUND}, {NDVI}, {_resolved('picked')}, {_WORK},
one AS (SELECT DISTINCT scene_id, tile, strftime(ts, '%Y-%m') AS month, "row", col, v FROM todo JOIN ndvi USING (raster_id) WHERE {_INSIDE} AND v IS NOT NULL)
SELECT tile, month, count(*) AS n_valid, true AS p10, true AS p50, true AS p90 FROM one GROUP BY 1, 2""",
    "earliest_candidates": f"WITH {ITEMS}, {REQUESTS}, {FOUND} SELECT request_id, scene_id, round(cloud, 6) AS cloud_cover FROM cands ORDER BY ts, scene_id, request_id LIMIT 50",
    "ndvi_summary": f"WITH {NDVI} SELECT raster_id, {_STATS} FROM ndvi GROUP BY 1",
    "validate_dates": f"WITH {ITEMS}, {REQUESTS} SELECT request_id, strftime(s, '%Y%m%d') AS start_day, strftime(e, '%Y%m%d') AS end_day FROM checked",
    "validate_requests": f"WITH {ITEMS}, {REQUESTS} SELECT request_id, error FROM checked",
    "filter_collection": f"WITH {ITEMS} SELECT scene_id, collection FROM items WHERE collection = 'sentinel-2-l2a'",
    "filter_dates": f"WITH {ITEMS} SELECT scene_id FROM items WHERE ts >= DATE '1996-02-01' AND ts < DATE '1996-03-16'",
    "filter_tile": f"WITH {ITEMS} SELECT scene_id, tile FROM items WHERE scene_id LIKE 'S2%_T17STJ_%'",
    "cloud_cover": f"WITH {ITEMS} SELECT scene_id, round({CLOUD}, 6) AS cloud_cover FROM items",
    "filter_cloud": f"WITH {ITEMS} SELECT scene_id, round({CLOUD}, 6) AS cloud_cover FROM items WHERE {CLOUD} <= 10",
    "valid_pixels": f"WITH {NDVI} SELECT raster_id, count(v) AS n_valid, CASE WHEN count(v) = 0 THEN 'no_valid_pixels' ELSE 'ok' END AS status FROM ndvi GROUP BY 1",
    "request_candidates": f"WITH {ITEMS}, {REQUESTS}, {FOUND} SELECT request_id, scene_id, round(cloud, 6) AS cloud_cover FROM cands",
    "requests_unmatched": f"WITH {ITEMS}, {REQUESTS}, {FOUND} SELECT request_id, CASE WHEN n_items = 0 THEN 'no_items' ELSE 'no_candidates' END AS status FROM counts JOIN checked USING (request_id) WHERE error IS NULL AND n_candidates = 0",
    "pair_bands": f"""WITH {BLOCKS} SELECT raster_id, "row", col, {_ROUND("red", "nir")} FROM pairs""",
    "pair_tilings": f"""WITH {TILED} SELECT raster_id, "row", col, {_ROUND("red", "nir")} FROM pairs""",
    "grid_mismatch": "SELECT s_suppkey AS raster_id, 64 AS red_width, 32 AS nir_width, 64 AS red_height, 64 AS nir_height FROM supplier WHERE s_suppkey % 9 = 4",
    "crop_pixels": f"""WITH {PIXELS}, {_DEFAULT} SELECT raster_id, "row", col, red, nir FROM pixels JOIN wins USING (raster_id) WHERE {_INSIDE}""",
    "crop_blocks": f"""WITH {BLOCKS}, wins AS (SELECT {_window("16", "16", "0.3::DOUBLE")}) SELECT raster_id, "row", col, {_ROUND("red", "nir")} FROM pairs, wins WHERE {_INSIDE}""",
    "crop_tilings": f"""WITH {TILED}, wins AS (SELECT {_window("16", "16", "0.3::DOUBLE")}) SELECT raster_id, "row", col, {_ROUND("red", "nir")} FROM pairs, wins WHERE {_INSIDE}""",
    "block_file_crops": f"""WITH {TILED}, wins AS (SELECT {_window("16", "16", "0.3::DOUBLE")}) SELECT raster_id, "row", col, {_ROUND("red", "nir")} FROM pairs, wins WHERE {_INSIDE} AND raster_id % 3 < 2""",
    "candidate_counts": f"WITH {ITEMS}, {REQUESTS}, {FOUND} SELECT request_id, n_items, n_candidates FROM counts",
    "ndvi_percentiles": _PERCENTILES,
    "ndvi_percentiles_scaled": _PERCENTILES,
    "select_scene": f"WITH {ITEMS}, {REQUESTS}, {FOUND} SELECT request_id, scene_id, round(cloud, 6) AS cloud_cover, reason FROM picked",
    "capped_candidates": f"WITH {ITEMS}, {REQUESTS}, {FOUND} SELECT request_id, scene_id, row_number() OVER (PARTITION BY request_id ORDER BY ts, scene_id) AS place FROM cands QUALIFY place <= 3",
    "band_pair": f"WITH {ITEMS}, {_resolved('items')} SELECT scene_id, red_key, nir_key, CASE WHEN red_key IS NULL THEN array_to_string(list_sort(json_keys(assets)), ',') END AS detail FROM resolved",
    "item_epsg": f"WITH {ITEMS}, {_resolved('items')} SELECT scene_id, epsg, found FROM resolved",
    "https_hrefs": f"""WITH {ITEMS}, each AS (SELECT scene_id, assets, unnest(json_keys(assets)) AS asset FROM items), one AS (SELECT scene_id, asset, json_extract(assets, '$."' || asset || '"') AS a FROM each)
SELECT scene_id, asset, coalesce(nullif(json_extract_string(a, '$.alternate.https.href'), ''), nullif(json_extract_string(a, '$.href'), '')) AS href FROM one""",
    "band_hrefs": f"WITH {ITEMS}, {_resolved('items')} SELECT scene_id, red_href, nir_href FROM resolved",
    "bbox_crop": f"WITH {ITEMS} SELECT scene_id, {_BOX('0.12::DOUBLE')} FROM items",
    "center_window": f"WITH frames AS (SELECT p_partkey AS frame_id, (p_partkey * 397 % 11000 + 1)::INT AS w, (p_partkey * 211 % 11000 + 1)::INT AS h, (p_size - 5) / 80::DOUBLE AS f FROM part) SELECT frame_id, {_window('w', 'h', 'f')} FROM frames",
    "ndvi_pixels": f"""WITH {NDVI} SELECT raster_id, "row", col, round(v, 6) AS ndvi FROM ndvi""",
    "ndvi_blocks": f"""WITH {BLOCKS} SELECT raster_id, "row", col, round(({_NDVI})::DOUBLE, 6) AS ndvi FROM pairs""",
    "ndvi_clip": f"""WITH {BLOCKS}, r AS (SELECT raster_id, CASE WHEN nir + red <> 0 THEN {_RATIO} END AS raw FROM pairs)
SELECT raster_id, count(*) FILTER (abs(raw) > 1) AS n_clipped, count(raw) AS n_valid, round(min(greatest(-1, least(1, raw)))::DOUBLE, 6) AS low, round(max(greatest(-1, least(1, raw)))::DOUBLE, 6) AS high FROM r GROUP BY 1""",
    "ndvi_map": f"""WITH {NDVI}, c AS (SELECT raster_id, "row" // 8 AS map_row, col // 8 AS map_col, round(avg(v), 6) AS mean FROM ndvi GROUP BY 1, 2, 3)
SELECT *, CASE WHEN mean IS NOT NULL THEN least(255, floor((mean + 1) / 2 * 256))::INT END AS color FROM c""",
    "request_status": f"""WITH {ITEMS}, {REQUESTS}, {FOUND}, {NDVI}, {_resolved('picked')}, {_WORK},
filled AS (SELECT DISTINCT request_id FROM todo JOIN ndvi USING (raster_id) WHERE {_INSIDE} AND v IS NOT NULL)
SELECT c.request_id, coalesce(error, CASE WHEN n_items = 0 THEN 'no_items' WHEN n_candidates = 0 THEN 'no_candidates' END, scene_error,
  CASE WHEN c.request_id NOT IN (SELECT request_id FROM todo) THEN 'grid_mismatch' WHEN c.request_id NOT IN (SELECT request_id FROM filled) THEN 'no_valid_pixels' ELSE 'ok' END) AS status
FROM checked c JOIN counts USING (request_id) LEFT JOIN judged j USING (request_id)""",
    "scene_manifest": f"WITH {ITEMS}, {REQUESTS}, {FOUND}, {_resolved('picked')} SELECT request_id, scene_id, raster_id, red_key, nir_key, epsg, red_href, nir_href, {_BOX('crop_fraction')}, scene_error FROM judged",
    "ndvi_report": f"WITH {ITEMS}, {REQUESTS}, {FOUND}, {NDVI}, {_resolved('picked')}, {_WORK} SELECT request_id, raster_id, {_STATS} FROM todo JOIN ndvi USING (raster_id) WHERE {_INSIDE} GROUP BY 1, 2 HAVING count(v) > 0",
}
