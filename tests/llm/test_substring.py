import random

import numpy as np
from llm.helpers import empty, messy, rows, split

from fieldlight.llm import substring
from fieldlight.llm.fmindex import FMIndex, WaveletMatrix


def brute(docs, window):
    """docs: (doc_id, text). Removed word places of each row."""
    top = 1 << 63
    first = {}
    for d, t in docs:
        w = split(t)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, top), top if d is None else d)
    out = []
    for d, t in docs:
        w = split(t)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (top if d is None else d):
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=repr)


def ours(df, **how):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.dedup(df, **how).collect()), key=repr)


def corpus(seed, n=60):
    rng = random.Random(seed)
    passages = [[f"p{rng.randint(0, 30)}" for _ in range(rng.randint(5, 90))] for _ in range(8)]
    texts = []
    for _ in range(n):
        w = []
        for _ in range(rng.randint(0, 6)):
            w += rng.choice(passages) if rng.random() < 0.6 else [f"r{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.2:
            w += ["same"] * 150
        texts.append(" ".join(w))
    return texts + texts[:5]


def test_against_brute_force(spark):
    for seed, window, anchor in ((1, 50, 8), (2, 12, 3), (3, 9, 8)):
        texts = corpus(seed)
        df = spark.createDataFrame(rows(texts), "doc_id long, text string, lang string, source string, n_chars long")
        assert ours(df, window=window, anchor=anchor, shard=50) == brute(list(enumerate(texts)), window)


def test_hot_anchors_are_exact(spark):
    rng = random.Random(5)
    passage = [f"h{i}" for i in range(60)]
    texts = [" ".join([f"a{rng.random()}"] * rng.randint(0, 30) + passage + [f"b{rng.random()}" for _ in range(20)]) for _ in range(40)]
    df = spark.createDataFrame(rows(texts), "doc_id long, text string, lang string, source string, n_chars long")
    want = brute(list(enumerate(texts)), 50)
    assert sum(r[2] for r in want) > 1000
    assert ours(df, hot=3) == want == ours(df)


def test_many_shards_in_a_task(spark, monkeypatch):
    monkeypatch.setattr(substring, "MOST_TASKS", 3)
    texts = corpus(8)
    df = spark.createDataFrame(rows(texts), "doc_id long, text string, lang string, source string, n_chars long")
    assert ours(df, shard=4) == brute(list(enumerate(texts)), 50) == ours(df, shard=4, hot=2)


def test_repeated_rows_give_each_interval_once(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    df = spark.createDataFrame([(1, passage)] + [(2, "x " + passage + " y")] * 50, "doc_id long, text string")
    out = substring.dedup(df).collect()
    assert [(r.n_removed, len(r.spans), r.kept) for r in out if r.doc_id == 2] == [(60, 1, "x y")] * 50


def test_messy(spark):
    df = messy(spark)
    assert ours(df) == brute([(r.doc_id, r.text) for r in df.collect()], 50)
    assert ours(empty(spark)) == []


def test_wavelet_matrix():
    rng = np.random.default_rng(0)
    for size in (1, 2, 5, 64):
        x = rng.integers(0, size, 300)
        m = WaveletMatrix(x, size)
        s, at = rng.integers(0, size, 200), rng.integers(0, 301, 200)
        assert m.rank(s, at).tolist() == [int((x[:a] == c).sum()) for c, a in zip(s, at)]


def test_matching_statistics():
    rng = np.random.default_rng(1)
    for _ in range(150):
        window, m, sigma = int(rng.integers(2, 9)), int(rng.integers(1, 8)), int(rng.integers(1, 5))
        texts = [rng.integers(0, sigma, rng.integers(0, 25)) for _ in range(m)]
        owners = rng.integers(0, 100, m)
        index = FMIndex(np.concatenate(texts).astype(np.int64), np.concatenate([[0], np.cumsum([len(t) for t in texts])]), owners, window)
        asked = [texts[int(rng.integers(m))] if rng.random() < 0.5 else rng.integers(-1, sigma + 1, rng.integers(0, 25)) for _ in range(6)]
        want = {}
        for i, q in enumerate(asked):
            for s in range(len(q) - window + 1):
                who = [owners[j] for j, t in enumerate(texts) for k in range(len(t) - window + 1) if (t[k : k + window] == q[s : s + window]).all()]
                if who:
                    want[i, s] = min(who)
        got = index.least_owners(np.concatenate(asked).astype(np.int64), np.concatenate([[0], np.cumsum([len(q) for q in asked])]))
        assert {(int(a), int(b)): int(c) for a, b, c in zip(*got)} == want
