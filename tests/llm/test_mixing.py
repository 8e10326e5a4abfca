import random

import numpy as np
import pytest
from llm.helpers import SCHEMA, empty, messy, rows
from pyspark.sql import functions as F

from fieldlight.llm import mixing


def water(sizes, weights, share, most):
    """Targets by plain iteration."""
    total, capped = share * sum(sizes), set()
    while True:
        left = total - sum(most * sizes[i] for i in capped)
        w = sum(weights[i] for i in range(len(sizes)) if i not in capped)
        level = left / w if w else 0
        over = {i for i in range(len(sizes)) if i not in capped and weights[i] * level > most * sizes[i]}
        if not over:
            return [most * s if i in capped else weights[i] * level for i, s in enumerate(sizes)]
        capped |= over


@pytest.mark.parametrize("seed", range(3))
def test_targets(spark, seed):
    rng = random.Random(seed)
    names = [f"s{i}" for i in range(9)] + ["é", None]
    sizes = [rng.choice([0, 3, 50, 1000, 10**6]) for _ in names]
    df = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    order = sorted(range(len(names)), key=lambda i: (names[i] is None, (names[i] or "").encode()))
    want = water([sizes[i] for i in order], [mixing.WEIGHTS[k % 3] for k in range(len(order))], mixing.SHARE, mixing.MOST_COPIES)
    for k, i in enumerate(order):
        assert got[names[i]] == pytest.approx(want[k])


def test_pivot_keeps_mass_and_expectation():
    rng = np.random.default_rng(0)
    mass, p = rng.integers(1, 100, 40).astype(float), rng.uniform(0, 1, 40)
    seen = np.zeros(40)
    for _ in range(4000):
        q, at = mixing.pivot(mass, p, rng.uniform(size=40))
        assert abs((q * mass).sum() - (p * mass).sum()) < 1e-6
        rest = [i for i in range(40) if 0 < q[i] < 1]
        assert rest in ([], [at])
        seen += q
    assert np.abs(seen / 4000 - p).max() < 0.04


def corpus(spark, n=6000):
    rng = random.Random(1)
    texts = [" ".join(["w"] * rng.randint(0, 60)) for _ in range(n)]
    return spark.createDataFrame(rows(texts, [rng.choice("aaaabc") for _ in range(n)]), SCHEMA)


def test_mix_meets_targets_and_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 64)
    monkeypatch.setattr(mixing, "FAN", 4)
    df = corpus(spark)
    out = mixing.mix(df.repartition(5)).collect()
    assert len(out) == 6000 and all(0 <= r.copies <= 2 for r in out)
    for s in "abc":
        part = [r for r in out if r.source == s]
        assert abs(sum(r.size * r.copies for r in part) - part[0].target) <= 60
    again = {r.doc_id: r.copies for r in mixing.mix(df.repartition(9)).collect()}
    assert again == {r.doc_id: r.copies for r in out}


def test_mixed_documents(spark):
    df = corpus(spark, 500)
    copies = {r.doc_id: r.copies for r in mixing.mix(df).collect()}
    got = {r.doc_id: r["count"] for r in mixing.mixed_documents(df).groupBy("doc_id").count().collect()}
    assert got == {d: c for d, c in copies.items() if c}


def test_rows_are_told_apart(spark):
    df = spark.createDataFrame([(None, None, "t")] * 500 + [(1, "a", "x"), (1, "a", "x"), (1, None, "x")], SCHEMA.split(", lang")[0].replace("text string", "source string, text string")).repartition(7)
    got = mixing.told_apart(df, "doc_id", "source", "text").groupBy("doc_id", "source", "text").agg(F.sort_array(F.collect_list("row")).alias("r")).collect()
    assert sorted(len(r.r) for r in got) == [1, 2, 500] and all(r.r == list(range(1, len(r.r) + 1)) for r in got)


def test_a_third_of_equal_rows(spark):
    df = spark.createDataFrame(rows(["w w w"] * 300 + [f"a {i}" for i in range(600)], ["a"] * 300 + ["b"] * 600), SCHEMA)
    df = df.withColumn("doc_id", F.when(F.col("source") == "b", F.col("doc_id")))
    out = mixing.mix(df.repartition(6)).collect()
    again = mixing.mix(df.repartition(3)).collect()
    total = lambda t: sum(r.copies for r in t if r.source == "a")
    assert len(out) == 900 and total(out) == total(again) and abs(3 * total(out) - out[0].target if out[0].source == "a" else 0) <= 3
    assert mixing.mixed_documents(df).where("source = 'a'").count() == total(out)


def test_messy(spark):
    df = messy(spark)
    out = mixing.mix(df).collect()
    assert len(out) == df.count() and {r.source for r in out} == {"a", "b", None}
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.copies for r in out)
    assert mixing.mix(empty(spark)).collect() == [] and mixing.mixed_documents(empty(spark)).collect() == []
    assert df.select(mixing.n_words(F.lit(" a\tb\x0bc d ")).alias("n")).first().n == 3
