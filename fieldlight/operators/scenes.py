"""Scene search and choice for many requests at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlight.functions import metadata as M
from fieldlight.sources.staging import cut

COLLECTIONS = ("sentinel-2-l2a",)


def in_collections(items: DataFrame, names: tuple[str, ...] = COLLECTIONS) -> DataFrame:
    return items.where(F.col("collection").isin(*names))


def in_days(at: Column, start: Column, end: Column) -> Column:
    """Both ends count, the last day whole."""
    return (at >= start) & (at < F.date_add(end, 1))


def under_cap(cloud: Column, cap: Column) -> Column:
    return cap.isNull() | (cloud <= cap)


def checked(requests: DataFrame) -> DataFrame:
    """requests with error, start_day and end_day."""
    error = M.request_error(F.col("start_date"), F.col("end_date"), F.col("crop_fraction"), F.col("max_cloud_cover"))
    return requests.withColumns({"error": error, "start_day": M.day(F.col("start_date")), "end_day": M.day(F.col("end_date"))})


#: What a request keeps on its way through the search, and what a scene keeps.
REQUEST_FIELDS = ("request_id", "crop_fraction", "max_cloud_cover", "preferred_scene_id")
SCENE_FIELDS = ("scene_id", "datetime", "cloud_cover")


def months(start: Column, end: Column) -> Column:
    """First days of the months from one day to another; none if they are reversed."""
    return F.when(start <= end, F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month")))


def searched(requests: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid requests (REQUEST_FIELDS, search) and what their distinct searches find (search, max_cloud_cover, SCENE_FIELDS). A search is a
    tile, days and a cap; requests that ask for the same share it, so a scene meets a search once, however many requests there are.

    An equi-join on (tile, month), the tile taken from the id, so a scene meets the searches of its tile and month; days are tested
    afterwards. What is taken from ids has the lengths that requests name, mostly five characters alone. A tile with a wildcard _ is
    first expanded against the dictionary of the catalogue's distinct tiles; one with % or an escape is looked up by the text before
    it and compared by the id pattern afterwards. So no key holds more than the scenes of a tile and month, unless a request asks for
    more. Requests are looked up in the months that the catalogue has, however long they are."""
    at = F.col("datetime")
    valid = cut(checked(requests).where("error is null").select(*REQUEST_FIELDS, F.upper("tile").alias("_pattern"), "start_day", "end_day"), "requests")
    alike = ["_pattern", "start_day", "end_day", "max_cloud_cover"]
    tile = F.col("_pattern")
    head = M.tile_head(tile)
    # Written, so that a search keeps its number.
    searches = valid.select(*alike).distinct().select(F.monotonically_increasing_id().alias("search"), *alike, head.alias("_head"), F.length(head).alias("_length"), (head == tile).alias("_exact"))
    searches = cut(searches, "searches")
    numbers = searches.select("search", *[F.col(c).alias(f"_{c}") for c in alike])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in alike]
    asking = valid.join(numbers, same).select(*REQUEST_FIELDS, "search")
    others = searches.where(F.col("_length") != M.TILE_LENGTH).agg(F.collect_set("_length")).scalar()
    lengths = F.array_append(others, F.lit(M.TILE_LENGTH))
    # The scenes as they are read several times: JSON and ids are parsed once. They are dealt evenly, for they meet the searches where they lie;
    # only what a search needs of them is shuffled, and the texts behind each T are taken afterwards.
    scenes = in_collections(items).select("scene_id", "datetime", M.cloud_cover(F.col("properties")).alias("cloud_cover"))
    scenes = scenes.repartition("scene_id", "datetime").withColumns({"_lengths": lengths, "_tails": M.tile_tails(F.col("scene_id"), F.array_max(lengths) + 1)})
    # The test refers to the texts a second time, so that they are not written out in their place, once a length.
    keys = F.when(F.size("_tails") > 0, M.tile_keys(F.col("_tails"), F.col("_lengths")))
    scenes = cut(scenes.select(*SCENE_FIELDS, F.trunc(at, "month").alias("_month"), keys.alias("_keys")), "scenes")
    span = scenes.agg(F.struct(F.min(at.cast("date")).alias("first"), F.max(at.cast("date")).alias("last"))).scalar()  # one row
    wanted = searches.withColumn("_month", F.explode(months(F.greatest("start_day", span["first"]), F.least("end_day", span["last"]))))
    keyed = scenes.select("*", F.inline("_keys"))
    wild = F.col("_head").contains("_")
    dictionary = scenes.select("_keys").distinct().select(F.inline("_keys")).select("_length", "_tile").distinct()
    meant = wanted.where(wild).select("_head", "_length").distinct().join(dictionary, "_length").where(F.like("_tile", F.col("_head"))).drop("_length")
    named = wanted.where(~wild).withColumn("_tile", F.col("_head")).unionByName(wanted.join(meant, "_head"))
    # Few rows, a search and tile each, but costly to find; by their size as a table Spark broadcasts them.
    named = cut(named.withColumns({"_before": F.substring_index("_head", "_", 1), "_behind": F.substring_index("_head", "_", -1)}), "named")
    met = keyed.join(named, ["_length", "_tile", "_month"]).where(in_days(at, F.col("start_day"), F.col("end_day")))
    # An id may hold several texts that a wildcard means; the scene counts by the first of them. A pattern of its own for a row is compiled
    # for that row, so the ends beside the wildcards are compared first.
    like = lambda t: F.startswith(t, F.col("_before")) & F.endswith(t, F.col("_behind")) & F.like(t, F.col("_head"))
    # Looking through a scene's texts is costly, so it is left out where nothing before this text begins or ends like the wildcard.
    place = F.position(F.concat(F.lit("T"), F.col("_tile")), "scene_id", F.lit(4))
    begins = F.position(F.concat(F.lit("T"), F.col("_before")), "scene_id", F.lit(4)) < place
    ends = F.position("_behind", "scene_id", F.lit(4)) <= place + F.col("_length") - F.length("_behind")
    earlier = begins & ends & F.exists("_keys", lambda k: (k["_length"] == F.col("_length")) & (k["_nth"] < F.col("_nth")) & like(k["_tile"]))
    once = (~wild | (F.col("_nth") == 0) | ~earlier) & (F.col("_exact") | M.like_tile(F.col("scene_id"), F.col("_pattern")))
    return asking, met.where(once).select("search", "max_cloud_cover", *SCENE_FIELDS)


def spread(asking: DataFrame, met: DataFrame) -> DataFrame:
    """Each request with the scenes of its search: REQUEST_FIELDS and SCENE_FIELDS."""
    return met.select("search", *SCENE_FIELDS).join(asking, "search").select(*REQUEST_FIELDS, *SCENE_FIELDS)


def found_items(requests: DataFrame, items: DataFrame) -> DataFrame:
    """Valid requests with their scenes of the collections, tile and days: REQUEST_FIELDS and SCENE_FIELDS only; the
    scene's wide columns are joined back where they are needed, see described(). A row per request and scene, whose number grows with the
    product of both; what is asked of the search alone is found without them by the functions below that take requests and items."""
    return spread(*searched(requests, items))


def found_candidates(requests: DataFrame, items: DataFrame, **shown: Column) -> DataFrame:
    """candidates() of found_items(); scenes over a search's cap meet no request. Columns named by `shown` replace the scenes' own; they are
    made once a search and scene, not once a pair."""
    asking, met = searched(requests, items)
    return spread(asking, candidates(met).withColumns(shown))


def described(found: DataFrame, items: DataFrame, how: str = "inner") -> DataFrame:
    """found, a row per request, with the scenes' other columns. A scene listed several times under one id and time counts once. The scenes
    that are picked are told first, often few of them by many requests, so that no other wide row is shuffled."""
    chosen = cut(found.select(F.col("scene_id").alias("_scene"), F.col("datetime").alias("_at")).where("_scene is not null").distinct(), "chosen")
    wide = in_collections(items).withColumnsRenamed({"scene_id": "_scene", "datetime": "_at"}).join(chosen, ["_scene", "_at"], "left_semi")
    one = Window.partitionBy("_scene", "_at").orderBy("raster_id", "collection")
    wide = wide.withColumn("_nth", F.row_number().over(one)).where("_nth = 1").drop("_nth")
    return found.join(wide, (F.col("scene_id") == F.col("_scene")) & (F.col("datetime") == F.col("_at")), how).drop("_scene", "_at")


def candidates(found: DataFrame) -> DataFrame:
    return found.where(under_cap(F.col("cloud_cover"), F.col("max_cloud_cover")))


def tally(found: DataFrame) -> DataFrame:
    """request_id, n_items, n_candidates and, as `best`, the scene to pick (NULL without candidates): one grouped aggregation over narrow
    rows, combined before the shuffle. The preferred scene comes first, else the one of least cloud cover (NaN last), else of least id."""
    inside = under_cap(F.col("cloud_cover"), F.col("max_cloud_cover"))
    preferred = F.coalesce(F.col("scene_id") == F.col("preferred_scene_id"), F.lit(False))
    order = F.struct((~preferred).alias("other"), "cloud_cover", "scene_id", "datetime", "crop_fraction", "max_cloud_cover", "preferred_scene_id")
    return found.groupBy("request_id").agg(F.count("*").alias("n_items"), F.count_if(inside).alias("n_candidates"), F.min(F.when(inside, order)).alias("best"))


def _search_counts(asking: DataFrame, met: DataFrame) -> DataFrame:
    """search, _named, n_items, n_candidates, low: what each search finds, the scenes that its requests prefer (_named) counted apart. Numbers
    alone, so that they are combined by hash before the shuffle and nothing is sorted."""
    wishes = asking.where("preferred_scene_id is not null").select(F.col("search").alias("_search"), F.col("preferred_scene_id").alias("_named")).distinct()
    inside = under_cap(F.col("cloud_cover"), F.col("max_cloud_cover"))
    marked = _marked(met, cut(wishes, "wishes"))
    return marked.groupBy("search", "_named").agg(F.count("*").alias("n_items"), F.count_if(inside).alias("n_candidates"), F.min(F.when(inside, F.col("cloud_cover"))).alias("low"))


def _marked(met: DataFrame, wishes: DataFrame) -> DataFrame:
    """met with _named: the scene's id where a request of the search prefers it."""
    return met.join(wishes, (F.col("search") == F.col("_search")) & (F.col("scene_id") == F.col("_named")), "left").drop("_search")


def tallied(requests: DataFrame, items: DataFrame) -> DataFrame:
    """tally() of found_items(), which is not made: each search is tallied once, the least cloud cover first and then, of the scenes
    that have it, the least one; its requests take the result over."""
    asking, met = searched(requests, items)
    n = cut(_search_counts(asking, met), "search-counts")
    names = n.where("_named is not null").select(F.col("search").alias("_search"), "_named")
    low = n.where("n_candidates > 0").select("search", F.col("_named").alias("_low_named"), F.col("low").alias("_low"))
    least = _marked(candidates(met), names).join(low, "search").where(F.col("_named").eqNullSafe(F.col("_low_named")) & (F.col("cloud_cover") == F.col("_low")))
    scene = F.min(F.struct("cloud_cover", "scene_id", "datetime"))
    least = cut(least.groupBy("search", "_named").agg(scene.alias("scene")), "search-best")
    whole = n.groupBy("search").agg(F.sum("n_items").alias("n_items"), F.sum("n_candidates").alias("n_candidates"))
    best = least.groupBy("search").agg(F.min("scene").alias("_any"))
    wish = least.where("_named is not null").select("search", F.col("_named").alias("preferred_scene_id"), F.col("scene").alias("_wish"))
    each = asking.join(whole, "search").join(best, "search", "left").join(wish, ["search", "preferred_scene_id"], "left")
    taken = F.coalesce("_wish", "_any")
    order = F.struct(F.col("_wish").isNull().alias("other"), *[taken[c].alias(c) for c in ("cloud_cover", "scene_id", "datetime")], "crop_fraction", "max_cloud_cover", "preferred_scene_id")
    out = each.groupBy("request_id").agg(F.sum("n_items").alias("n_items"), F.sum("n_candidates").alias("n_candidates"), F.min(F.when(taken.isNotNull(), order)).alias("best"))
    return cut(out, "tallied")


def counts(requests: DataFrame, items: DataFrame) -> DataFrame:
    """request_id, n_items, n_candidates, for every request."""
    asking, met = searched(requests, items)
    inside = under_cap(F.col("cloud_cover"), F.col("max_cloud_cover"))
    n = met.groupBy("search").agg(F.count("*").alias("n_items"), F.count_if(inside).alias("n_candidates"))
    n = asking.join(n, "search").groupBy("request_id").agg(F.sum("n_items").alias("n_items"), F.sum("n_candidates").alias("n_candidates"))
    return requests.select("request_id").join(n, "request_id", "left").na.fill(0, ["n_items", "n_candidates"])


def picked(tallied: DataFrame) -> DataFrame:
    """The columns of `best` and why it was picked, in its place."""
    # An empty preferred id is none.
    reason = F.when(~F.col("best.other"), "preferred").when(F.coalesce("best.preferred_scene_id", F.lit("")) != "", "fallback").otherwise("lowest_cloud")
    return tallied.select("*", "best.*", reason.alias("reason")).drop("other", "best")


def pick(found: DataFrame) -> DataFrame:
    """One row per request that has candidates."""
    return _with_best(tally(found))


def select_scenes(requests: DataFrame, items: DataFrame) -> DataFrame:
    """pick() of found_items(), by the tallies of the searches."""
    return _with_best(tallied(requests, items))


def _with_best(tallies: DataFrame) -> DataFrame:
    return picked(tallies.where("best is not null").drop("n_items", "n_candidates"))


def first_items(found: DataFrame, most: int = 500) -> DataFrame:
    """The earliest `most` candidates of all requests together: each partition keeps its own first ones, no row beyond them is sorted or
    shuffled."""
    return candidates(found).orderBy("datetime", "scene_id", "request_id").limit(most)


def first_found(requests: DataFrame, items: DataFrame, most: int = 500) -> DataFrame:
    """first_items() of found_items(). Each search and scene stands for a row of its least request at least, so that the first `most` rows
    belong to the first `most` of these pairs, and only those meet their requests."""
    asking, met = searched(requests, items)
    least = asking.groupBy("search").agg(F.min(F.struct("request_id")).alias("_least"))
    few = candidates(met).join(least, "search").orderBy("datetime", "scene_id", "_least").limit(most)
    return first_items(spread(asking, few), most)


def capped(requests: DataFrame, items: DataFrame, most: int = 500) -> DataFrame:
    """At most `most` scenes per request, the earliest first; each search is cut to them before its requests take them over."""
    asking, met = searched(requests, items)
    place = lambda by: F.row_number().over(Window.partitionBy(by).orderBy("datetime", "scene_id"))
    few = candidates(met).withColumn("_place", place("search")).where(F.col("_place") <= most)
    # Rows of one request_id are one request.
    return spread(asking, few).withColumn("place", place("request_id")).where(F.col("place") <= most)


def resolved(scenes: DataFrame) -> DataFrame:
    """Scenes with bands (red_key, nir_key), projection (found, epsg), red_href and nir_href."""
    parsed = scenes.withColumn("_assets", M.asset_map(F.col("assets")))
    parsed = parsed.withColumn("bands", M.band_pair(F.col("_assets")))
    links = {f"{b}_href": M.https_href(F.try_element_at(F.col("_assets"), F.col("bands")[f"{b}_key"])) for b in ("red", "nir")}
    return parsed.withColumns({"projection": M.epsg(F.col("properties"), F.col("_assets"), F.col("bands")), **links}).drop("_assets")


def scene_error() -> Column:
    """The first failing check of a resolved scene, or NULL."""
    return (
        F.when(F.col("bands").isNull(), "no_bands")
        .when(F.col("projection.found") & F.col("projection.epsg").isNull(), "bad_epsg")
        .when(~F.col("projection.found"), "no_epsg")
        .when(F.col("red_href").isNull() | F.col("nir_href").isNull(), "no_href")
    )
