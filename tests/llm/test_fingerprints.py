import hashlib
import random

import numpy as np
from llm.helpers import SCHEMA, empty, messy, rows
from pyspark.sql import functions as F

from fieldlight.llm import fingerprints as P


def shingles(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_likeness(spark):
    rng = random.Random(0)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(400)]
    pairs = [(base[: rng.randint(5, 400)], base[: rng.randint(5, 400)]) for _ in range(60)] + [(base, base), (base[:2], base[:2]), ([], []), ([], base)]
    df = spark.createDataFrame([(i, " ".join(a), " ".join(b)) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = [r[0] for r in df.orderBy("i").select(P.likeness(P.fingerprint(F.col("a")), P.fingerprint(F.col("b")))).collect()]
    want = [len(x & y) / len(x | y) if x | y else 1.0 for x, y in ((shingles(" ".join(a)), shingles(" ".join(b))) for a, b in pairs)]
    assert np.abs(np.array(got) - want).max() < 0.15 and abs(np.mean(np.array(got) - want)) < 0.02
    assert got[-4:] == [1.0, 1.0, 1.0, 0.0]


def test_bins_are_the_least_hashes(spark):
    text = " ".join(f"w{i}" for i in range(300))
    df = spark.createDataFrame([(text,)], "t string").select(P.shingles(F.col("t")).alias("h"))
    h, least = df.select("h", P.least_of_bins(F.col("h"))).first()
    want = [min([x for x in h if x >> 55 == b], default=(b << 55) | ((1 << 55) - 1)) for b in range(P.BINS)]
    assert len(h) == 296 and least == want


def edited(docs):
    """docs in order of id."""
    out = {}
    for k, (d, t) in enumerate(docs):
        nxt, n = docs[(k + 1) % len(docs)][1] or "", len(t or "")
        out[d] = (n, hashlib.sha256(((t or "")[: n - n // 2] + nxt[: n // 2]).encode()).hexdigest())
    return out


def run(spark, tmp_path, df):
    df.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    return P.op10_fingerprints(spark, str(tmp_path)).collect()


def test_edited_texts_over_many_buckets(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    docs = [(rng.randint(0, 10**9), "".join(rng.choices("ab é\n漢", k=rng.randint(0, 80)))) for _ in range(300)]
    docs = sorted(dict(docs).items())
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in docs], SCHEMA).repartition(7)
    for size in (7, 40, 2000):
        monkeypatch.setattr(P, "BUCKET", size)
        got = run(spark, tmp_path, df)
        assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == edited(docs) and len(got) == len(docs)


def test_messy(spark, tmp_path):
    df = messy(spark)
    got = run(spark, tmp_path, df)
    assert len(got) == df.count() and run(spark, tmp_path, empty(spark)) == []
    one = {}
    texts = {r.doc_id: r.text or "" for r in df.where("doc_id is not null").collect()}
    for r in got:
        if r.doc_id is not None:
            assert r.n_chars == len(texts[r.doc_id]) and one.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
            assert (r.fingerprint == "") == (not texts[r.doc_id].split())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    alone = run(spark, tmp_path, spark.createDataFrame(rows(["a b c d e f g"]), SCHEMA))
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_hot_ids_are_split(spark, tmp_path, monkeypatch):
    """A third of the rows without id, most of them equal, and one repeated id: as in one window over all rows."""
    rng = random.Random(5)
    text = lambda: " ".join(rng.choices("abcdefgh", k=rng.randint(0, 12)))
    docs = [(i, text()) for i in range(0, 900, 3)] + [(303, text()) for _ in range(150)] + [(None, text()) for _ in range(120)] + [(None, "so it goes on and on")] * 130 + [(450, "same old text")] * 100
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in docs], SCHEMA).repartition(5)
    tie = {t: h for t, h in spark.createDataFrame([(t,) for t in {t for _, t in docs}], "t string").select("t", F.xxhash64("t")).collect()}
    docs = sorted(docs, key=lambda r: (r[0] is None, r[0] or 0, tie[r[1]]))
    want = sorted((d is None, d or 0, len(t), edited([(0, t), (1, docs[(k + 1) % len(docs)][1])])[0][1]) for k, (d, t) in enumerate(docs))
    for size in (5, 20, 100):
        monkeypatch.setattr(P, "BUCKET", size)
        got = run(spark, tmp_path, df)
        assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars, r.edited_sha256) for r in got) == want
    df = spark.read.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(P, "BUCKET", 20)
    _, hot = P.buckets(df.select(F.coalesce("doc_id", F.lit(P._LAST)).alias("_order")))
    sizes = [r["count"] for r in P.with_next(df.select("doc_id", "text")).groupBy("_bucket").count().collect()]
    assert hot.keys() == {303, 450, P._LAST} and max(sizes) <= 110
