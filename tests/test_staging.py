"""What lies on disk between the steps: nothing that was shuffled for a table that is written, and one join of orders and customers a search."""

import os

import pytest
from pyspark.sql import functions as F

from fieldlight.plans.queries import queries
from fieldlight.sources import derived, staging, tables


def shuffled(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {blocks.apply(k).getName() for k in range(blocks.size()) if blocks.apply(k).getName().startswith("shuffle_")}


def test_cut_leaves_no_shuffle(spark):
    before, named = shuffled(spark), spark.conf.get(staging.CLEANUP, None)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    table = staging.cut(df, "t")
    assert not shuffled(spark) - before
    assert spark.conf.get(staging.CLEANUP, None) == named
    assert sorted(table.collect()) == sorted(df.collect()) and table.count() == 7


def test_cut_restores_the_setting_after_a_failure(spark):
    spark.conf.set(staging.CLEANUP, "false")
    try:
        with pytest.raises(Exception, match="no number"):
            staging.cut(spark.range(1).select(F.raise_error(F.lit("no number")).cast("string").alias("x")), "t")
        assert spark.conf.get(staging.CLEANUP) == "false"
    finally:
        spark.conf.unset(staging.CLEANUP)


def test_a_search_joins_orders_once(spark, sf_dir, monkeypatch):
    """The catalogue and the requests of a search read one written join, and are what each alone is."""
    made, cut = [], derived.cut
    monkeypatch.setattr(derived, "cut", lambda df, name: made.append(name) or cut(df, name))
    requests, items = derived.search(spark, sf_dir)
    assert made == ["placed"]
    for got, want in ((requests, derived.requests(spark, sf_dir)), (items, derived.items(spark, sf_dir))):
        assert got.schema == want.schema
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
        assert "o_custkey" in plan(want) and "o_custkey" not in plan(got)


def test_a_manifest_does_not_join_orders_again(spark, sf_dir):
    """The wide columns of picked scenes come from the join that their search has written."""
    plan = queries()["scene_manifest"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderkey" in plan and "o_custkey" not in plan


def test_a_merge_leaves_the_catalogue_alone(spark, sf_dir, monkeypatch):
    """Of a merge through files neither dumps nor what was shuffled is left, and a dump lies packed."""
    made, sizes, scratch, merge = [], [], staging.scratch, tables.merge_catalog
    monkeypatch.setattr(staging, "scratch", lambda spark, name: made.append(scratch(spark, name)) or made[-1])
    monkeypatch.setattr(tables, "merge_catalog", lambda items, path: sizes.append([os.path.getsize(f.removeprefix("file://")) for f in items.inputFiles()]) or merge(items, path))
    before = shuffled(spark)
    result = queries()["catalog_merge"](spark, sf_dir)
    assert not shuffled(spark) - before
    left = [os.path.basename(p) for p in made if os.path.isdir(p.removeprefix("file://"))]
    assert len(made) > 4 and [p.split("-")[0] for p in left] == ["catalogue"]
    assert len(sizes) == 3 and max(map(sum, sizes)) < 100 * result.count()
