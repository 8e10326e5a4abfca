"""Readers and writers: scene catalogues, band blocks, NDVI rasters and summaries.

Tables that grow lie in folders (by month, or tile and month). upsert() rewrites the folders that its rows belong to and leaves all
others alone: new rows take the place of old ones of the same key, so that a rerun changes nothing."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlight.operators.scenes import COLLECTIONS, in_collections
from fieldlight.sources.staging import cleaned, cut, remove, scope

#: One row per scene; properties and assets stay JSON text until an operator asks for a field.
ITEMS = T.StructType(
    [
        T.StructField("scene_id", T.StringType()),
        T.StructField("collection", T.StringType()),
        T.StructField("tile", T.StringType()),
        T.StructField("datetime", T.TimestampNTZType()),
        T.StructField("properties", T.StringType()),
        T.StructField("assets", T.StringType()),
        T.StructField("bbox", T.ArrayType(T.DoubleType())),
        T.StructField("raster_id", T.LongType()),
    ]
)
#: The same as a stored catalogue has it: when the item was last changed, and the folder it lies in.
CATALOG = T.StructType([*ITEMS.fields, T.StructField("updated", T.TimestampNTZType()), T.StructField("month", T.StringType())])
RASTERS = "label string, row int, col int, ndvi float, tile string, month string"
SUMMARIES = "scene_id string, col_off int, row_off int, width int, height int, n_pixels long, n_valid long, low double, p10 double, p50 double, p90 double, high double, mean double, month string"
#: What tells summaries of picked scenes apart.
SUMMARY_KEYS = ("scene_id", "col_off", "row_off", "width", "height")
BUCKETS = 16
#: Rows of a catalogue that are merged at once, unless a month has more; of ids and times alone, twice as many.
MERGE_ROWS = 2_000_000
BLOCKS = "raster_id long, band string, row0 int, col0 int, row1 int, col1 int, h int, w int, values array<float>, z long"


def stored(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The table at path; one without rows if there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stored_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns of the table at path, none if there is none yet."""
    try:
        return spark.read.parquet(path).columns
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return []


def replace_folders(rows: DataFrame, path: str, folders: list[str]) -> None:
    """Writes the folders that rows belong to, whole, and no other."""
    with cleaned(rows.sparkSession):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*folders).parquet(path)


def upsert(rows: DataFrame, path: str, folders: list[str], keys: list[str], sort: list[str], split: Column | None = None) -> None:
    """rows are added to the table at path, in the place of those with the same keys (within a folder). sort: order of a file's rows; split:
    by which a folder's rows are dealt to files beside the keys' hash."""
    with scope(rows.sparkSession):
        rows = cut(rows, "new-rows")
        there = stored(rows.sparkSession, path, rows.schema)
        if lost := set(stored_columns(rows.sparkSession, path)) - set(rows.columns):
            raise ValueError(f"the stored table has columns that the new rows lack: {sorted(lost)}")
        # Only the touched folders are read: their names prune the scan as the join runs.
        touched = rows.select(*folders).distinct()
        rest = there.join(touched, folders, "left_semi").join(rows.select(*folders, *keys).distinct(), [*folders, *keys], "left_anti")
        # Written before the folders it is read from are replaced.
        merged = cut(rows.unionByName(rest), "merged")
        # By ranges, so that a task writes neighbouring folders, not a file in each of them.
        dealt = merged.repartitionByRange(*folders, *([F.col(keys[0])] if split is None else [split]))
        replace_folders(dealt.sortWithinPartitions(*folders, *sort), path, folders)


# --- scene catalogues


def _field(item: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(item, path, kind)


def _json(item: Column, path: str) -> Column:
    """What stands at the path as JSON text; an object's text is taken as it stands in the item, others are copied out of it first."""
    is_object = _field(item, path, "struct<_:variant>").isNotNull()
    return F.when(is_object, _field(item, path)).otherwise(F.to_json(_field(item, path, "variant")))


def parse_items(dump: DataFrame, text: str = "value") -> DataFrame:
    """CATALOG rows and `corrupt` from a column of JSON texts as a catalogue's search returns them: an item (a feature with id, properties,
    nested assets, bbox), or a page of items under `features`. Texts that are no such thing have no scene_id and stand in
    `corrupt`; an item without time takes its start's."""
    parsed = dump.select(F.col(text).alias("_text"), F.try_parse_json(text).alias("_page"))
    features = F.coalesce(_field(F.col("_page"), "$.features", "array<variant>"), F.array("_page"))
    each = parsed.select("_text", F.explode(features).alias("i"))
    i = F.col("i")
    scene = F.when(F.schema_of_variant(_field(i, "$.id", "variant")) == "STRING", F.nullif(_field(i, "$.id"), F.lit("")))
    # In UTC, whatever the session's time zone.
    utc = lambda t: F.convert_timezone(F.current_timezone(), F.lit("UTC"), t.cast("timestamp_ntz"))
    at = lambda *paths: utc(F.coalesce(*[F.try_to_timestamp(_field(i, p)) for p in paths]))
    time = at("$.properties.datetime", "$.properties.start_datetime")
    good = scene.isNotNull() & time.isNotNull()
    return each.select(
        F.when(good, scene).alias("scene_id"), _field(i, "$.collection").alias("collection"), F.upper(F.nullif(F.regexp_extract(scene, "_T([0-9]{2}[A-Za-z]{3})_", 1), F.lit(""))).alias("tile"), time.alias("datetime"),
        _json(i, "$.properties").alias("properties"), _json(i, "$.assets").alias("assets"), _field(i, "$.bbox", "array<double>").alias("bbox"),
        _field(i, "$.properties.raster_id", "bigint").alias("raster_id"), at("$.properties.updated", "$.properties.created").alias("updated"), F.date_format(time, "yyyy-MM").alias("month"), F.when(~good, F.col("_text")).alias("corrupt"),
    )


def read_items(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Items and broken texts of dumps with one JSON text a line, or a file, as saved pages of a search are; see parse_items(). Blank ones are
    skipped."""
    return parse_items(spark.read.text(path, wholetext=whole_files).where(F.trim("value") != ""))


def dump_items(items: DataFrame) -> DataFrame:
    """value: each scene (CATALOG columns, month apart) as the JSON text of an item, as read_items() reads it."""
    stamp = lambda c: F.concat(F.lit('"'), F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('"'))
    # What the properties hold already stays as it is.
    has = lambda name: F.coalesce(F.array_contains(F.json_object_keys("properties"), name), F.lit(False))
    fields = {"datetime": stamp("datetime"), "updated": stamp("updated"), "raster_id": F.col("raster_id").cast("string")}
    more = [F.when(~has(name), F.concat(F.lit(f'"{name}":'), value)) for name, value in fields.items()]
    own = F.nullif(F.expr("substring(properties, 2, length(properties) - 2)"), F.lit(""))
    properties = F.concat(F.lit("{"), F.concat_ws(",", own, *more), F.lit("}"))
    item = F.struct(F.lit("Feature").alias("type"), F.col("scene_id").alias("id"), "collection", "bbox", F.try_parse_json(properties).alias("properties"), F.try_parse_json("assets").alias("assets"))
    return items.select(F.to_json(item).alias("value"))


def superseded(rows: DataFrame, there: DataFrame, part: int = 0, parts: int = 1) -> DataFrame:
    """scene_id, month, datetime: where versions of a scene lie that has a newer one at another time, for the scenes of rows, of which `there` holds one version
    each. Versions are compared by their ids' hashes and times alone; only scenes that have several times, few if any, are looked at by id. part: of
    so many parts of the scenes, by hash, the one that is looked at."""
    key = F.xxhash64("scene_id").alias("_key")
    at = F.coalesce("datetime", F.lit("0001-01-01").cast("timestamp_ntz"))
    rows, there = (df.where(F.pmod(key, F.lit(parts)) == part) for df in (rows, there))
    times = rows.groupBy(key).agg(F.min(at).alias("_low"), F.max(at).alias("_high"))
    met = there.select(key, at.alias("_at")).join(times, "_key").where("_at < _low or _at > _high")
    several = times.where("_low < _high").select("_key").union(met.select("_key")).distinct()
    names = ["scene_id", "month", "datetime"]
    versions = cut(rows.unionByName(there).select(*names, "updated", key).join(several, "_key", "left_semi").drop("_key"), "versions")
    last = versions.groupBy("scene_id").agg(F.max(F.struct("updated", "datetime", "month")).alias("_last"))
    stays = F.col("datetime").eqNullSafe(F.col("_last.datetime")) & F.col("month").eqNullSafe(F.col("_last.month"))
    return versions.join(last, "scene_id").where(~stays).select(*names).distinct()


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """rows (scenes) but for those of a scene, month and time in gone."""
    g = gone.select(*[F.col(c).alias(f"_{c}") for c in gone.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in gone.columns]
    return rows.join(g, same, "left_anti")


def newest(rows: DataFrame) -> DataFrame:
    """by_days() of the version of each scene that was changed last; of equally new ones the greatest as text. Versions without a time of change come before
    all others. All versions of a scene have one time, so that they meet where the ranges of time put them."""
    place = ["month", "datetime", "scene_id"]
    order = [F.col(c).desc_nulls_last() for c in ("updated", "properties", "assets", "collection", "raster_id")]
    nth = F.row_number().over(Window.partitionBy(*place).orderBy(*order))
    return rows.repartitionByRange(*place).withColumn("_nth", nth).where("_nth = 1").drop("_nth").sortWithinPartitions(*place)


def by_days(rows: DataFrame) -> DataFrame:
    """A month's scenes in files by ranges of time, so that filters on days skip files and row groups. A task writes neighbouring months, so
    there are no more files than tasks and months together. rows are read twice, so they should be a table."""
    return rows.repartitionByRange("month", "datetime", "scene_id").sortWithinPartitions("month", "datetime", "scene_id")


def rounds(sizes: dict[str | None, int], most: int) -> list[list[str | None]]:
    """Neighbouring months of up to `most` rows together, or one month of more."""
    out: list[list[str | None]] = []
    for month in sorted(sizes, key=lambda m: m or ""):
        if not out or sum(sizes[m] for m in out[-1]) + sizes[month] > most:
            out.append([])
        out[-1].append(month)
    return out


def merge_catalog(items: DataFrame, path: str, most: int = MERGE_ROWS) -> None:
    """Adds items (CATALOG columns; the month is that of datetime) to the catalogue at path, of which it keeps the newest version of each scene. Of the old
    files only the folders are read whole that hold one of the new scenes at another time or are to hold one; the others stay as they are. Months
    are merged and replaced some at a time, up to `most` rows, so that what is shuffled at once does not grow with the catalogue. A merge
    that was cut off between two of them is mended by running it again."""
    spark = items.sparkSession
    with scope(spark), cleaned(spark):
        rows = cut(items.where("scene_id is not null").select(*CATALOG.fieldNames()), "new-items")
        there = stored(spark, path, CATALOG)
        # A scene whose time has changed moves, and leaves its old folder.
        parts = 1 + (rows.count() + there.count()) // (2 * most)
        gone = reduce(DataFrame.unionByName, [cut(superseded(rows, there, k, parts), "superseded") for k in range(parts)])
        lost = {r["month"] for r in gone.select("month").distinct().collect()}
        within = lambda df, months: df.where(F.col("month").isin([m for m in months if m is not None]) | (F.col("month").isNull() if None in months else F.lit(False)))
        sizes = dict.fromkeys(lost, 0) | {r["month"]: r["count"] for r in rows.groupBy("month").count().collect()}
        for r in within(there, sizes).groupBy("month").count().collect():
            sizes[r["month"]] += r["count"]
        left = {r["month"] for r in without(within(rows.unionByName(there), lost), gone).select("month").distinct().collect()} if lost else set()
        for months in rounds(sizes, most):
            both = within(rows, months).unionByName(within(there, months))
            # Tasks end before a folder is replaced, so it may be read as it is merged.
            replace_folders(newest(without(both, gone) if lost else both), path, ["month"])
        # A folder that has lost its last scene is not among the rows; there are few, if any.
        for month in lost - left:
            remove(spark, f"{path}/month={'__HIVE_DEFAULT_PARTITION__' if month is None else month}")


def read_catalog(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scene items with an explicit schema, so that filters reach the files."""
    return spark.read.schema(CATALOG).format(fmt).load(path)


def write_catalog(items: DataFrame, path: str) -> None:
    """A catalogue of these items alone, in folders by month, sorted by time within its files."""
    rows = items.select(*ITEMS.fieldNames(), F.lit(None).cast("timestamp_ntz").alias("updated"), F.date_format("datetime", "yyyy-MM").alias("month"))
    with scope(rows.sparkSession):
        by_days(cut(rows, "catalogue-rows")).write.mode("overwrite").partitionBy("month").parquet(path)


def search_catalog(spark: SparkSession, path: str, start: str, end: str, names: tuple[str, ...] = COLLECTIONS, fmt: str = "parquet") -> DataFrame:
    """Scenes of the collections between two days, the last one whole. The months prune folders; both filters are on plain columns and reach the
    files."""
    at = F.col("datetime")
    # The day's end is a constant of the column's own type, so that the comparison is pushed down.
    after = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
    rows = in_collections(read_catalog(spark, path, fmt), names)
    months = F.col("month").isNull() | F.col("month").between(start[:7], end[:7])  # plain files have no folders
    return rows.where(months & (at >= F.lit(start).cast("timestamp_ntz")) & (at < after))


# --- rasters and summaries


def write_raster(ndvi: DataFrame, path: str) -> None:
    """NDVI pixels (label, tile, month, row, col, ndvi) in folders by tile and month, not by scene, which would be too many. A scene's pixels
    lie together, large scenes are split by row bands. Scenes that are there already are replaced, all others stay."""
    upsert(ndvi.select("label", "row", "col", "ndvi", "tile", "month"), path, ["tile", "month"], ["label"], ["label", "row", "col"], F.xxhash64("label", F.floor(F.col("row") / 1024)))


def read_raster(spark: SparkSession, path: str) -> DataFrame:
    """What write_raster stored; filters on tile and month skip folders."""
    return spark.read.schema(RASTERS).parquet(path)


def write_summary(summary: DataFrame, path: str, keys: tuple[str, ...] = ("raster_id",), folders: tuple[str, ...] = ()) -> None:
    """Numbers, not text. A row whose keys are there already takes the old one's place, all others stay. Without folders, rows lie in BUCKETS
    folders by a hash of their keys."""
    if not folders:
        summary, folders = summary.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")), ("bucket",)
    upsert(summary, path, list(folders), list(keys), list(keys))


def read_summary(spark: SparkSession, path: str, schema: str = SUMMARIES) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


# --- band blocks


def z_order(row: Column, col: Column, bits: int = 20) -> Column:
    """Place on the Z-shaped curve through a grid: the bits of row and column by turns."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for c, shift in ((col, 2 * b), (row, 2 * b + 1)):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(c.cast("long"), b).bitwiseAND(F.lit(1)), shift))
    return out


def write_blocks(blocks: DataFrame, path: str, cell: int = 1, group_bytes: int = 8 << 20) -> None:
    """blocks: raster_id, band, row0, col0, h, w, values. A raster's blocks lie along the Z-shaped curve, both bands of a place together, in small row
    groups, so that a window's blocks are in few of them. cell: side of the curve's grid, at best the blocks' own."""
    place = z_order(F.expr(f"row0 div {cell}"), F.expr(f"col0 div {cell}"))
    rows = blocks.withColumns({"row1": F.col("row0") + F.col("h"), "col1": F.col("col0") + F.col("w"), "z": place, "values": F.col("values").cast("array<float>")})
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(BLOCKS)])
    with scope(rows.sparkSession):
        # Written out before it is sorted by range, which reads it twice.
        dealt = cut(rows, "blocks").repartitionByRange("raster_id", "z").sortWithinPartitions("raster_id", "z", "band")
        dealt.write.mode("overwrite").option("parquet.block.size", group_bytes).option("parquet.page.size", min(group_bytes, 64 << 10)).option("parquet.page.size.row.check.min", 10).parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def read_windows(blocks: DataFrame, work: DataFrame, most: int = 1_000) -> DataFrame:
    """Stored blocks that overlap a window of their raster, with the window. work: raster_id, window. Of up to `most` windows the rasters and the
    frame around them reach the files as plain predicates, so that row groups of other rasters and places are skipped; more
    windows meet the blocks in the join alone."""
    work = work.select("raster_id", "window").distinct()
    few = work.limit(most + 1).collect()
    if len(few) <= most:
        ends = [(w["window"]["row_off"], w["window"]["col_off"], w["window"]["row_off"] + w["window"]["height"], w["window"]["col_off"] + w["window"]["width"]) for w in few]
        top, left, bottom, right = (f(x) for f, x in zip((min, min, max, max), zip(*ends or [(0, 0, 0, 0)], strict=True), strict=True))
        blocks = read_window(blocks.where(F.col("raster_id").isin([w["raster_id"] for w in few])), top, left, bottom - top, right - left)
    win = F.col("window")
    over = (F.col("row0") < win["row_off"] + win["height"]) & (F.col("row1") > win["row_off"]) & (F.col("col0") < win["col_off"] + win["width"]) & (F.col("col1") > win["col_off"])
    return blocks.join(work, "raster_id").where(over)


def read_window(blocks: DataFrame, row_off: int, col_off: int, height: int, width: int) -> DataFrame:
    """Blocks that overlap a window. Stored blocks have their ends as columns, so all four predicates reach the files, where row groups beside the
    window are skipped."""
    if "row1" in blocks.columns:
        ends = (F.col("row1") > row_off) & (F.col("col1") > col_off)
    else:
        ends = (F.col("row0") + F.col("h") > row_off) & (F.col("col0") + F.col("w") > col_off)
    return blocks.where((F.col("row0") < row_off + height) & (F.col("col0") < col_off + width) & ends).withColumn("values", F.col("values").cast("array<float>"))
