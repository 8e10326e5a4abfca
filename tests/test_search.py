"""Requests that ask for the same search share it: what each function of requests and items gives is what the pairs of requests and scenes give."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldlight.operators import scenes
from fieldlight.plans.queries import queries
from fieldlight.sources import tables

REQUEST = "request_id long, tile string, start_date string, end_date string, crop_fraction double, max_cloud_cover double, preferred_scene_id string"


@pytest.fixture(scope="module")
def tables_of(spark):
    """Requests and scenes with ties on cloud cover, wildcards, a scene listed twice, requests of one id, and empty, missing and unmet wishes."""
    rng = random.Random(7)
    clouds = ['{"eo:cloud_cover":%d}' % c for c in (3, 3, 8, 20)] + ["{}", '{"eo:cloud_cover":"NaN"}']
    at = lambda: dt.datetime(2024, rng.choice([5, 6]), rng.randint(1, 28), 11)
    rows = [(f"S2A_x_T{rng.choice([10, 11, 21])}STJ_{k}", "sentinel-2-l2a", None, at(), rng.choice(clouds), "{}", None, k) for k in range(120)]
    rows += rows[:5]
    ids = [r[0] for r in rows]
    ask = lambda k: (k, rng.choice(["10STJ", "10stj", "1_STJ", "11ST", "%", "99ZZZ", None]), rng.choice(["2024-05-01", "2024-05-10", "bad"]), rng.choice(["2024-05-20", "2024-06-28"]), 0.12, rng.choice([5.0, 10.0, 0.0, None]), rng.choice([None, "", "none", *rng.sample(ids, 9)]))
    requests = [ask(k) for k in range(150)] + [ask(k) for k in range(5)]
    return spark.createDataFrame(requests, REQUEST), spark.createDataFrame(rows, tables.ITEMS)


def same(got, want):
    columns = sorted(want.columns)
    rows = lambda df: sorted(map(repr, df.select(columns).collect()))
    assert sorted(got.columns) == columns
    assert rows(got) == rows(want) and want.count() > 0


def test_tallies_of_searches_are_those_of_pairs(tables_of):
    requests, items = tables_of
    found = scenes.found_items(requests, items)
    same(scenes.tallied(requests, items), scenes.tally(found))
    same(scenes.select_scenes(requests, items), scenes.pick(found))
    assert {r.reason for r in scenes.pick(found).collect()} == {"preferred", "fallback", "lowest_cloud"}
    n = scenes.tally(found).drop("best")
    same(scenes.counts(requests, items), requests.select("request_id").join(n, "request_id", "left").na.fill(0))


@pytest.mark.parametrize("most", [1, 3, 7, 400])
def test_caps_of_searches_are_those_of_pairs(tables_of, most):
    requests, items = tables_of
    inside = scenes.candidates(scenes.found_items(requests, items))
    same(scenes.found_candidates(requests, items), inside)
    order = Window.partitionBy("request_id").orderBy("datetime", "scene_id")
    key = ["request_id", "scene_id", "datetime", "place"]
    want = inside.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    same(scenes.capped(requests, items, most).select(key), want.select(key))
    same(scenes.first_found(requests, items, most).select(key[:3]), scenes.first_items(inside, most).select(key[:3]))


def test_work_does_not_grow_with_requests_of_a_search(spark):
    """Ten times as many requests for the same searches meet the scenes no more often."""
    rows = [(f"S2A_x_T10STJ_{k}", "sentinel-2-l2a", None, dt.datetime(2024, 5, 1 + k % 28, 11), '{"eo:cloud_cover":%d}' % (k % 20), "{}", None, k) for k in range(200)]
    items = spark.createDataFrame(rows, tables.ITEMS)
    ask = lambda n: spark.createDataFrame([(k, "10STJ", "2024-05-01", "2024-05-28", 0.12, (10.0, None)[k % 2], "none") for k in range(n)], REQUEST)
    few, many = (scenes.searched(ask(n), items) for n in (4, 40))
    assert few[1].count() == many[1].count() == 2 * 200
    assert few[0].count() == 4 and many[0].count() == 40


def test_picked_scenes_alone_are_joined_wide(spark, capsys):
    """Of all other scenes no JSON is shuffled: they go before the scenes listed twice are sorted out."""
    rows = [(f"S2A_x_T10STJ_{k}", "sentinel-2-l2a", None, dt.datetime(2024, 5, 1, 11), '{"eo:cloud_cover":%d}' % k, "{}", None, k) for k in (5, 6, 7)]
    items = spark.createDataFrame([*rows, (*rows[0][:7], 1)], tables.ITEMS)
    requests = spark.createDataFrame([(k, "10STJ", "2024-05-01", "2024-05-28", 0.12, None, None) for k in range(9)], REQUEST)
    out = scenes.described(scenes.select_scenes(requests, items), items)
    assert sorted((r.request_id, r.scene_id, r.raster_id) for r in out.collect()) == [(k, "S2A_x_T10STJ_5", 1) for k in range(9)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window ") < plan.index("LeftSemi")


def test_texts_behind_a_t_are_taken_once(spark):
    """No regular expression stands between the stored scenes and their searches, but for patterns that need one; ids with several texts that
    a wildcard means count once, and lengths that requests name are all met."""
    ids = ["S2A_x_T10STJ_T11STJ_1", "S2A_x_T10STJ_T10STJ_2", "S2A_T10ST", "S2A_x_T10STJ", "S2T10STJ_4", "S1A_x_T10STJ_5", "S2A_xTT_TT10STJTT_6"]
    items = spark.createDataFrame([(i, "sentinel-2-l2a", None, dt.datetime(2024, 5, 2, 11), "{}", "{}", None, k) for k, i in enumerate(ids)], tables.ITEMS)
    tiles = ["10STJ", "1_STJ", "____J", "10ST", "1", "", "_", "T10STJ", "%STJ", "1%J", "11STJ", "10STJ_T11STJ"]
    requests = spark.createDataFrame([(k, t, "2024-05-01", "2024-05-28", 0.12, None, None) for k, t in enumerate(tiles)], REQUEST)
    asking, met = scenes.searched(requests, items)
    pattern = F.concat(F.lit("S2%_T"), F.col("asked"), F.lit("_%"))
    want = requests.select("request_id", F.col("tile").alias("asked")).join(items, F.like("scene_id", pattern)).select("request_id", "scene_id")
    same(scenes.spread(asking, met).select("request_id", "scene_id"), want)
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and "split" not in plan


def test_texts_behind_a_t_are_not_shuffled(spark, tables_of, monkeypatch):
    """The scenes are dealt out before the texts are taken from their ids, and they are taken by one expression."""
    plans, cut = {}, scenes.cut
    monkeypatch.setattr(scenes, "cut", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString()) and cut(df, name))
    scenes.searched(*tables_of)
    above, below = plans["scenes"].split("RepartitionByExpression", 1)
    assert above.count("regexp_extract_all") == 1 and "regexp" not in below and "get_json_object" in below


def test_a_pair_costs_no_expression(spark, tables_of, sf_dir):
    """What request_candidates shows of a scene is made before its requests take it over."""
    plan = queries()["request_candidates"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("round(")
    requests, items = tables_of
    name = F.concat(F.col("scene_id"), F.lit("!")).alias("scene_id")
    got = scenes.found_candidates(requests, items, scene_id=name)
    same(got, scenes.found_candidates(requests, items).withColumn("scene_id", name))


def test_wildcards_look_through_few_texts(spark):
    """Whatever ids and wildcards there are, each scene counts once where the id pattern holds; and a scene's texts are looked through only
    behind tests of places, which most wildcards fail."""
    rng = random.Random(8)
    some = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    ids = sorted({f"S2A{some('TTSJ1_', rng.randint(1, 3))}_T{some('TTSJ1_', rng.randint(0, 12))}" for _ in range(300)})
    items = spark.createDataFrame([(i, "sentinel-2-l2a", None, dt.datetime(2024, 5, 2, 11), "{}", "{}", None, k) for k, i in enumerate(ids)], tables.ITEMS)
    tiles = sorted({some("TSJ1__", rng.randint(1, 5)) for _ in range(150)})
    requests = spark.createDataFrame([(k, t, "2024-05-01", "2024-05-28", 0.12, None, None) for k, t in enumerate(tiles)], REQUEST)
    asking, met = scenes.searched(requests, items)
    pattern = F.concat(F.lit("S2%_T"), F.col("asked"), F.lit("_%"))
    want = requests.select("request_id", F.col("tile").alias("asked")).join(items, F.like("scene_id", pattern)).select("request_id", "scene_id")
    same(scenes.spread(asking, met).select("request_id", "scene_id"), want)
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("exists(_keys") == 1 and "position(" in plan.split("exists(_keys")[0]
