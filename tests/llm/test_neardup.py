import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from llm.helpers import SCHEMA, empty, messy, rows

from fieldlight.llm import neardup
from fieldlight.llm.components import components


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


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


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    bases = [rng.choices(words, k=rng.randint(3, 150)) for _ in range(12)]
    out = []
    for _ in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(words)
        out.append(" ".join(w).upper() if rng.random() < 0.1 else " ".join(w))
    return out


@pytest.mark.parametrize(("seed", "threshold"), [(1, 0.85), (2, 0.8), (3, 0.5)])
def test_against_brute_force(spark, seed, threshold):
    texts = corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.classes(spark.createDataFrame(rows(texts), SCHEMA), threshold).collect()}
    assert got == brute(list(enumerate(texts)), round(100 * threshold))


@pytest.mark.parametrize(("block", "giant"), [(5, 10**6), (5, 8), (1, 10**6), (40, 10**6)])
def test_blocks_and_giant_groups_agree(spark, monkeypatch, block, giant):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "GIANT", giant)
    texts = corpus(4)
    df, want = spark.createDataFrame(rows(texts), SCHEMA), brute(list(enumerate(texts)), 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.classes(df).collect()} == want


def test_hot_group_of_linked_and_unlinked_copies(spark, monkeypatch):
    """Copies of one text with one to many changed words: one large bucket, whose members are linked in chains or not at all."""
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rng = random.Random(9)
    base, texts = [f"w{i}" for i in range(120)], []
    for i in range(150):
        w = list(base[: rng.choice([120, 100])])
        for p in rng.sample(range(len(w)), rng.choice([1, 1, 2, 3, 6])):
            w[p] = f"x{rng.random()}"
        texts.append(" ".join(w))
    df, want = spark.createDataFrame(rows(texts), SCHEMA), brute(list(enumerate(texts)), 85)
    assert len({c for _, c in want.values()}) > 5
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.classes(df).collect()} == want


def test_several_texts_of_one_id(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(n)) for k, n in (("a", 40), ("b", 60), ("c", 30)))
    texts = [(5, a), (5, b), (3, a), (7, b + " more"), (9, c), (5, None), (8, c), (8, a + " x"), (None, a), (11, "other words that are alone here")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts], SCHEMA)
    out = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in neardup.classes(df).collect()}
    assert {d: c for (d, _), (c, _) in out.items()} == {3: 3, 5: 3, 7: 3, 8: 3, 9: 3, 11: 11, None: None}
    assert len(out) == 10 and all(kept == (d in (3, 11, None)) for (d, _), (_, kept) in out.items())


def test_components(spark):
    rng = random.Random(0)
    for edges in ([(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 100)], [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(100)], []):
        root = {x: x for e in edges for x in e}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
        linked = {x for a, b in edges if a != b for x in (a, b)}
        got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {x: find(x) for x in linked}


def test_bands_and_bounds():
    for t in (0.5, 0.8, 0.85, 0.95):
        n, r = neardup.bands(t)
        assert n * r <= neardup.HASHES and (1 - t**r) ** n <= neardup.MISS_BANDS
    need = neardup.least_matches(0.85)
    assert (np.diff(need) > 0).all() and need[-1] < 0.85 * neardup.HASHES


def test_signatures_estimate_similarity():
    rng = random.Random(1)
    w = [f"w{rng.randint(0, 9999)}" for _ in range(800)]
    sets, offsets = neardup.shingle_sets(pa.array([" ".join(w), " ".join(w[:600] + w[700:])]))
    s = neardup.signatures(sets, offsets, 1024)
    a, b = shingles(" ".join(w)), shingles(" ".join(w[:600] + w[700:]))
    assert abs((s[0] == s[1]).mean() - len(a & b) / len(a | b)) < 0.05
