import random
from itertools import combinations

import numpy as np
import pytest
from llm.helpers import SCHEMA, empty, messy, rows

from fieldlight.llm import jaccard, neardup


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))) if w else frozenset()


def brute(docs, percent):
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def corpus(seed, n=150, edits=5, longest=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    bases = [rng.choices(words, k=rng.randint(3, longest)) for _ in range(12)]
    out = []
    for _ in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.randint(0, edits)):
            p = rng.randrange(len(w))
            rng.choice([lambda: w.pop(p) if len(w) > 1 else None, lambda: w.insert(p, rng.choice(words)), lambda: w.__setitem__(p, rng.choice(words))])()  # noqa: B023
            p = 0
        out.append(" ".join(w).upper() if rng.random() < 0.1 else " ".join(w))
    return out


def got(df, threshold=0.9):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df, threshold).collect()}


@pytest.mark.parametrize(("seed", "threshold"), [(1, 0.9), (2, 0.8), (3, 0.6)])
def test_against_brute_force(spark, seed, threshold):
    texts = corpus(seed)
    assert got(spark.createDataFrame(rows(texts), SCHEMA), threshold) == brute(list(enumerate(texts)), round(100 * threshold))


@pytest.mark.parametrize(("block", "giant"), [(5, 10**6), (5, 8), (40, 10**6)])
def test_blocks_and_giant_groups_agree(spark, monkeypatch, block, giant):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "GIANT", giant)
    texts = corpus(4)
    assert got(spark.createDataFrame(rows(texts), SCHEMA)) == brute(list(enumerate(texts)), 90)


def test_messy_rows(spark):
    df = messy(spark)
    out = jaccard.join(df).collect()
    want = brute([(r.doc_id, r.text) for r in df.where("doc_id is not null").collect()], 90)
    assert len(out) == df.count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out if r.doc_id is not None} == want
    assert [r.component_id for r in out if r.doc_id is None] == [None, None]
    assert jaccard.join(empty(spark)).collect() == []


@pytest.mark.parametrize("threshold", [0.9, 0.8])
def test_linked_sets_share_a_key(threshold):
    """Random pairs at and just over the threshold, of all sizes; sets of few shingles too."""
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.choice([9, 10, 11, 19, 20, 40, 100, 400, 1200])) + int(rng.integers(0, 9))
        most = int((1 - threshold) / (1 + threshold) * 2 * n)
        gone, more = sorted(rng.integers(0, most + 1, 2).tolist())[0], int(rng.integers(0, most + 1))
        x = rng.integers(0, 1 << 63, n + more).astype(np.uint64)
        a, b = np.unique(x[:n]), np.unique(x[gone:])
        both = len(np.intersect1d(a, b))
        if both < threshold * (len(a) + len(b) - both) or len(a) == len(b) == both:
            continue
        at, keys = jaccard.keys_of(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), threshold)
        assert set(keys[at == 0].tolist()) & set(keys[at == 1].tolist()), (n, gone, more)


def test_shared_passages_make_no_keys():
    """Sets that share a third of their shingles: hardly any of these pairs is a candidate."""
    rng = np.random.default_rng(6)
    passage = rng.integers(0, 1 << 63, 100).astype(np.uint64)
    sets = [np.unique(np.concatenate([passage, rng.integers(0, 1 << 63, 200).astype(np.uint64)])) for _ in range(200)]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    _, keys = jaccard.keys_of(np.concatenate(sets), offsets, 0.9)
    assert len(keys) - len(np.unique(keys)) < 0.02 * len(keys)


def test_matrix_bounds_the_overlap_and_spares_comparisons():
    rng = np.random.default_rng(7)
    families = [rng.integers(0, 1 << 63, 200).astype(np.uint64) for _ in range(12)]
    common = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([common, f[rng.random(200) < 0.97]])) for f in families for _ in range(16)]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    sketch = neardup.signatures(np.concatenate(sets), offsets, jaccard.SKETCH)
    distinct, ranks = np.unique(np.concatenate(sets), return_inverse=True)
    m = jaccard.matrix(sketch, ranks, offsets)
    for i in (0, 50, 150):
        overlaps = m.overlaps(ranks[offsets[i] : offsets[i + 1]])
        for g in range(len(m.least)):
            members = [k for k in range(len(sets)) if m.group_of[k] == g]
            union = np.unique(np.concatenate([sets[k] for k in members]))
            assert overlaps[g] == len(np.intersect1d(union, sets[i])) and m.least[g] == min(len(sets[k]) for k in members)
    zero = np.zeros(len(sets), np.int64)
    pairs, _, compared = jaccard.join_unit(zero, np.arange(len(sets)), sketch, sets, 0.9)
    assert compared < len(sets) * (len(sets) - 1) / 2 / 4
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in zip(pairs[::2], pairs[1::2], strict=True):
        root[find(a)] = find(b)
    for a, b in combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[a], sets[b]))
        if both >= 0.9 * (len(sets[a]) + len(sets[b]) - both):
            assert find(a) == find(b)


def test_hot_group_of_copies_and_boilerplate(spark, monkeypatch):
    """Copies with some changed words, linked in chains or not at all, beside documents that are mostly one common passage."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = random.Random(9)
    base, texts = [f"w{i}" for i in range(200)], []
    for i in range(120):
        w = list(base[: rng.choice([200, 185])])
        for p in rng.sample(range(len(w)), rng.choice([1, 1, 2, 3, 6])):
            w[p] = f"x{rng.random()}"
        texts.append(" ".join(w))
    texts += [" ".join([*base[:40], *(f"y{rng.random()}" for _ in range(rng.randint(0, 40)))]) for _ in range(60)]
    want = brute(list(enumerate(texts)), 90)
    assert len({c for _, c in want.values()}) > 5
    assert got(spark.createDataFrame(rows(texts), SCHEMA)) == want
