"""Functions of scene metadata: validation, cloud cover, bands, projection codes, links, boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Asset keys of (red, NIR), in order of preference (fixed values).
BAND_PAIRS = (("B04", "B08"), ("red", "nir"), ("B04_10m", "B08_10m"))
DEFAULT_CLOUD = 100.0
#: Characters of a tile's name.
TILE_LENGTH = 5


def day(text: Column) -> Column:
    """The date of a text year-month-day, else NULL."""
    return F.try_to_timestamp(text, F.lit("yyyy-M-d")).cast("date")


def request_error(start: Column, end: Column, crop: Column, cap: Column) -> Column:
    """The first failing check of a request's values, or NULL."""
    return (
        F.when(day(start).isNull() | day(end).isNull(), "bad_date")
        .when(crop.isNull() | F.isnan(crop) | (crop <= 0) | (crop > 0.5), "bad_crop")
        .when(cap.isNotNull() & (F.isnan(cap) | (cap < 0) | (cap > 100)), "bad_cloud_cap")
    )


def cloud_cover(properties: Column) -> Column:
    """eo:cloud_cover, else cloudCover, else 100, as a number."""
    get = lambda path: F.get_json_object(properties, path).try_cast("double")
    return F.coalesce(get("$['eo:cloud_cover']"), get("$.cloudCover"), F.lit(DEFAULT_CLOUD))


def like_tile(scene_id: Column, tile: Column) -> Column:
    """The catalogue's id pattern, in which _ is any one character."""
    return F.like(scene_id, F.concat(F.lit("S2%_T"), F.upper(tile), F.lit("_%")))


def tile_head(tile: Column) -> Column:
    """The text of a tile before its first % or escape; _ may stand in it."""
    return F.regexp_extract(tile, r"^[^%\\]*", 0)


def tile_tails(scene_id: Column, most: Column) -> Column:
    """The texts, of `most` characters at most, that stand where the id pattern has the tile: behind a T, with one character at least
    between it and S2. The pattern is the same for every row as long as `most` is, so that it is compiled once."""
    pattern = F.concat(F.lit("(?s)(?=T(.{1,"), most.cast("string"), F.lit("}))"))
    found = F.regexp_extract_all(F.substring(scene_id, 4, 1 << 30), pattern, F.lit(1))
    return F.when(scene_id.startswith("S2"), found).otherwise(F.array().cast("array<string>"))


def tile_keys(tails: Column, lengths: Column) -> Column:
    """Structs (_length, _nth, _tile): for each of the lengths, so many first characters of those tile_tails() that have one more at least,
    which the id pattern wants behind a tile; equal ones once. For a tile of that length without wildcards, an equi-join on these keys is the
    pattern, which need not be tested again."""
    of = lambda n: F.array_distinct(F.transform(F.filter(tails, lambda t: F.length(t) > n), lambda t: F.substring(t, F.lit(1), n)))
    return F.flatten(F.transform(lengths, lambda n: F.transform(of(n), lambda t, nth: F.struct(n.alias("_length"), nth.alias("_nth"), t.alias("_tile")))))


def asset_map(assets: Column) -> Column:
    """JSON object to map of VARIANT, NULL if it is no object."""
    return F.from_json(assets, "map<string,variant>")


def band_pair(assets: Column) -> Column:
    """(red_key, nir_key) of the first complete pair of asset keys, or NULL; assets is a map."""
    out = None
    for red, nir in BAND_PAIRS:
        both = F.map_contains_key(assets, red) & F.map_contains_key(assets, nir)
        pair = F.struct(F.lit(red).alias("red_key"), F.lit(nir).alias("nir_key"))
        out = F.when(both, pair) if out is None else out.when(both, pair)
    return out


def _code(v: Column) -> tuple[Column, Column, Column, Column]:
    """Of an object: whether proj:epsg is an integer, that integer, whether proj:code names EPSG, its number."""
    epsg, code = F.try_variant_get(v, '$["proj:epsg"]', "variant"), F.try_variant_get(v, '$["proj:code"]', "variant")
    text = F.when(F.schema_of_variant(code) == "STRING", F.try_variant_get(code, "$", "string"))
    number = F.regexp_extract(text, "^[^:]*:([\\s\\S]*)$", 1).try_cast("int")
    named = F.coalesce(F.upper(text).startswith("EPSG:"), F.lit(False))
    return F.coalesce(F.schema_of_variant(epsg) == "BIGINT", F.lit(False)), F.try_variant_get(epsg, "$", "int"), named, number


def epsg(properties: Column, assets: Column, pair: Column) -> Column:
    """(found, epsg): the projection code by the first source that has one. found without a number is a broken code;
    not found at all is (false, NULL). Sources do not fall through once they match."""
    out = None
    red, nir = (F.try_element_at(assets, pair[k]) for k in ("red_key", "nir_key"))
    for source in (F.try_parse_json(properties), red, nir):
        whole, number, named, coded = _code(source)
        hit = lambda n: F.struct(F.lit(True).alias("found"), n.alias("epsg"))
        out = (out.when(whole, hit(number)) if out is not None else F.when(whole, hit(number))).when(named, hit(coded))
    return out.otherwise(F.struct(F.lit(False).alias("found"), F.lit(None).cast("int").alias("epsg")))


def _text(v: Column, path: str) -> Column:
    """A non-empty JSON string at the path, else NULL."""
    value = F.try_variant_get(v, path, "variant")
    return F.nullif(F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")), F.lit(""))


def https_href(asset: Column) -> Column:
    """The https alternate where it is a non-empty text, else the asset's own link."""
    return F.coalesce(_text(asset, "$.alternate.https.href"), _text(asset, "$.href"))


def https_hrefs(assets: Column) -> Column:
    """Map of asset key to link; assets without any have NULL."""
    return F.transform_values(assets, lambda _, a: https_href(a))


def crop_box(bbox: Column, fraction: Column) -> Column:
    """(west, south, east, north) around the centre, of `fraction` of each side in each direction; only for boxes
    of four numbers."""
    at = lambda i: F.get(bbox, F.lit(i))
    x, y, w, h = (at(0) + at(2)) / 2, (at(1) + at(3)) / 2, (at(2) - at(0)) * fraction, (at(3) - at(1)) * fraction
    return F.when(F.size(bbox) == 4, F.struct((x - w).alias("west"), (y - h).alias("south"), (x + w).alias("east"), (y + h).alias("north")))
