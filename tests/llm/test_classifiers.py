"""Quality and toxicity: held-out accuracy, and cases."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from llm.helpers import empty, messy
from pyspark.sql import functions as F

from fieldlight.llm import quality, toxicity
from fieldlight.llm.common import one_labelled

TABLES = "/root/testdata/sf0.01"


def area(score, y):
    """Share of pairs of a positive and a negative in order."""
    a, b = np.array(score)[np.array(y) == 1], np.array(score)[np.array(y) == 0]
    return ((a[:, None] > b).mean() + (a[:, None] == b).mean() / 2) if len(a) and len(b) else 1.0


@pytest.mark.parametrize(("query", "label", "least"), [(quality.op3_quality, "quality", 0.95), (toxicity.op8_toxicity, "toxic", 0.85)])
def test_held_out(spark, sf_dir, query, label, least):
    marks = {r.doc_id: r[label] for r in spark.read.parquet(f"{TABLES}/labels.parquet").collect()}
    out = query(spark, TABLES).collect()
    held = [(r.score, marks[r.doc_id]) for r in out if r.held_out and r.doc_id in marks]
    assert all(0 <= r.score <= 1 for r in out) and area(*zip(*held)) >= least


@pytest.mark.parametrize(("module", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_messy(spark, module, label):
    df = messy(spark)
    marks = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 0), (None, 1), (5, None), (999, 1)], f"doc_id long, {label} int")
    name = "quality_score" if module is quality else "toxicity"
    out = module.score(df, module.fit(df, marks)).collect()
    assert len(out) == df.count() and all(0 <= r[name] <= 1 for r in out) and "key" in out[0].asDict()
    assert len({r[name] for r in out if r.doc_id == 0}) == 1
    assert module.score(empty(spark), module.fit(empty(spark), marks)).collect() == []
    alone = module.score(df, module.fit(df, marks.where("doc_id < 0"))).collect()
    assert len({r[name] for r in alone}) == 1


def test_trees_walk_like_recursion():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    t = quality.grow(x, y, rounds=20, least=5)

    def one(row):
        total = t.base
        for f, c, leaf in zip(t.feature, t.threshold, t.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > c[node])
            total += leaf[node - len(f)]
        return total

    assert np.allclose(t.margins(x), [one(r) for r in x])
    assert ((t.scores(x) > 0.5) == y).mean() > 0.95


def plain_statistics(text):
    """What quality.statistics computes, one text at a time."""
    raw = (text or "").encode()
    words, n = raw.split(), max(1, len(raw.split()))
    share = lambda test: sum(map(test, words)) / n
    count = lambda chars: sum(c in chars for c in raw)
    symbols, upper, digits = b"#$%&*+/<=>@[\\]^_`{|}~", bytes(range(65, 91)), b"0123456789"
    lines = [x.split() for x in raw.split(b"\n")]
    lines = [tuple(x) for x in lines if x]
    mean = sum(map(len, words)) / n
    grams = {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
    out = {
        "bytes": len(raw), "words": len(words), "mean_word": mean, "sd_word": max(0, sum(len(w) ** 2 for w in words) / n - mean**2) ** 0.5, "lines": raw.count(b"\n") + bool(raw),
        "upper": count(upper), "digits": count(digits), "punctuation": count(b".,;:!?'\"()-"), "symbols": count(symbols), "pipes": count(b"|"), "exclamations": count(b"!"), "spaces": count(b" \t\n\r\x0b\x0c"),
        "non_ascii": count(bytes(range(192, 256))), "commas": count(b","), "stops": count(b".?!"), "distinct_words": len(set(words)) / n, "top_word": max([words.count(w) for w in words], default=0) / n,
        "same_as_before": sum(a == b for a, b in zip(words, words[1:])) / n, "short_words": share(lambda w: len(w) <= 2), "long_words": share(lambda w: len(w) >= 14), "words_with_symbol": share(lambda w: any(c in symbols for c in w)),
        "upper_words": share(lambda w: 2 * sum(c in upper for c in w) > len(w)), "words_ending_stop": share(lambda w: w[-1] in b".?!"), "digit_words": share(lambda w: any(c in digits for c in w)),
        "repeated_lines": 1 - len(set(lines)) / len(lines) if lines else 0,
    }
    out["mean_line"], out["words_per_stop"] = len(words) / max(1, out["lines"]), len(words) / max(1, out["stops"])
    for name in ("upper", "digits", "punctuation", "symbols", "pipes", "exclamations", "spaces", "non_ascii", "commas", "stops"):
        out[name] /= max(1, len(raw))
    out["distinct_trigrams"] = len(grams) / n
    return out


def test_statistics():
    rng = random.Random(0)
    pieces = ["A", "b.", "b!", "\n", "\n", "  ", "Ünï", "CODE_x", "42", "a,b|c", "12-34", "x" * 20, "THE", "the", "end?", "\t", "(see", "50%"]
    texts = [" ".join(rng.choices(pieces, k=rng.randint(1, 60))) for _ in range(60)] + ["", None, " \n ", "A b. b b!\nA b. b b!"]
    got = quality.statistics(pa.array(texts))
    for text, row in zip(texts, got):
        s = dict(zip(quality.STATISTICS, row))
        for name, value in plain_statistics(text).items():
            assert s[name] == pytest.approx(value), (name, text)
    assert set(plain_statistics("")) == set(quality.STATISTICS)
    assert np.allclose(got, np.array([quality.statistics(pa.array([t], pa.string()))[0] for t in texts]))


def plain_tree(x, y, bins, rate, least, penalty):
    """One split by trying every quantile edge of every column."""
    share = y.mean()
    base = math.log(share / (1 - share))
    p = 1 / (1 + math.exp(-base))
    g, h, best = p - y, np.full(len(y), p * (1 - p)), (1e-9, None)
    value = lambda rows: -rate * g[rows].sum() / (h[rows].sum() + penalty)
    for j in range(x.shape[1]):
        for edge in np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])):
            right = x[:, j] > edge
            if min(right.sum(), (~right).sum()) >= least:
                gain = sum(g[r].sum() ** 2 / (h[r].sum() + penalty) for r in (right, ~right)) - g.sum() ** 2 / (h.sum() + penalty)
                if gain > best[0] + 1e-12:
                    best = (gain, (j, edge))
    if best[1] is None:
        return base, None, value(np.ones(len(y), bool))
    right = x[:, best[1][0]] > best[1][1]
    return base, best[1], (value(~right), value(right))


def test_grow_against_plain_search():
    rng = np.random.default_rng(3)
    for _ in range(20):
        x, bins = rng.integers(0, 6, (60, 4)).astype(float), int(rng.integers(2, 9))
        y = (rng.uniform(size=60) < np.where(x[:, 1] > 2, 0.8, 0.2)).astype(float)
        base, split, leaves = plain_tree(x, y, bins, 0.15, 5, 1.0)
        t = quality.grow(x, y, rounds=1, depth=1, bins=bins, least=5)
        assert t.base == pytest.approx(base)
        if split is not None:
            assert (t.feature[0][0], t.threshold[0][0]) == (split[0], pytest.approx(split[1])) and np.allclose(t.leaf[0], leaves)


def test_sample_holds_a_row_per_id(spark):
    df = spark.createDataFrame([(1, f"text {i}") for i in range(300)] + [(i, "other text") for i in range(2, 9)], "doc_id long, text string").repartition(5)
    marks = spark.createDataFrame([(i, i % 2) for i in range(1, 9)] * 3, "doc_id long, quality int")
    assert one_labelled(df, marks, "quality", 20).count() == 8
    picked = {r.doc_id for r in marks.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(3).collect()}
    got = one_labelled(df, marks, "quality", 3).collect()
    assert len(got) == 3 and sorted(r.y for r in got) == sorted(i % 2 for i in picked)
    assert sorted(one_labelled(df, marks, "quality", 8).collect()) == sorted(one_labelled(df.repartition(2), marks, "quality", 8).collect())


def test_one_class(spark):
    df = spark.createDataFrame([(i, f"some words {i}") for i in range(20)] + [(None, None)], "doc_id long, text string")
    for value in (0, 1):
        marks = spark.createDataFrame([(i, value) for i in range(20)], "doc_id long, toxic int")
        assert {r.toxicity for r in toxicity.score(df, toxicity.fit(df, marks)).collect()} == {float(value)}


def test_odd_columns(spark):
    df = spark.createDataFrame([(1, "abc", (2,), 4, 5)], "doc_id long, text string, s struct<`a b`:int>, toxicity int, quality_score int")
    r = quality.score(toxicity.score(df, toxicity.Model(np.zeros(0, np.uint64), np.zeros(0), 0.0)), quality.Trees(0.0)).first()
    assert r.s["a b"] == 2 and r.toxicity == 0.0 and r.quality_score == 0.5


def plain_sentences(text):
    """Sentences of a text as lists of its words, all small."""
    out, word = [[]], ""
    for c in (text or "") + " ":
        low = c.lower()
        if "a" <= low <= "z" or ord(c) >= 128:
            word += low
            continue
        if word:
            out[-1].append(word)
            word = ""
        if c in ".!?\n":
            out.append([])
    return out


def test_features_and_noisy_or_against_plain_code():
    rng = random.Random(4)
    words = ["vile", "vileness", "calm", "kind", "Üble", "überall", "a", "to", "strasse", "wordwordword"]
    texts = [" ".join(rng.choice(words) + rng.choice(["", "", ".", "!", "\n", ","]) for _ in range(rng.randint(0, 30))) for _ in range(80)] + ["", None, "...", "vile"]
    known = {"vile": 2.0, "calm": -1.0, "übe": None, "üble": 1.5}
    listed = [(w, x) for w, x in known.items() if x is not None]
    keys = [(toxicity.features_of(toxicity.sentences_of(pa.array([w])))[0][0], x) for w, x in listed]
    stem = toxicity.features_of(toxicity.sentences_of(pa.array(["vilexx"])))[1][0]  # its first four bytes
    keys.append((stem, 0.7))
    order = sorted(keys)
    model = toxicity.Model(np.array([k for k, _ in order], np.uint64), np.array([x for _, x in order]), -2.0)
    s = toxicity.sentences_of(pa.array(texts))
    ids, p = toxicity.noisy_or(model.weights, model.bias, *model.hits(s))
    doc = np.searchsorted(s.first, ids, "right") - 1
    got = 1 - np.exp(np.bincount(doc, np.log1p(-p), len(texts)))
    for text, value in zip(texts, got):
        clean = 1.0
        for sentence in plain_sentences(text):
            found = {w for w in sentence if known.get(w) is not None} | {"stem" for w in sentence if w.startswith("vile") and len(w.encode()) > 4}
            if found:
                z = -2.0 + sum(0.7 if f == "stem" else known[f] for f in found)
                clean *= 1 - 1 / (1 + math.exp(-z))
        assert value == pytest.approx(1 - clean, abs=1e-9), text


def test_fit_weights_lowers_the_loss():
    """The gradient steps against numeric differences of the plain loss."""
    rng = np.random.default_rng(6)
    doc = np.sort(rng.integers(0, 12, 40))
    sentence, feature = np.repeat(np.arange(40), 2), rng.integers(0, 5, 80)
    y = (np.arange(12) % 3 == 0).astype(np.int64)

    def loss(w, bias):
        z = bias + np.bincount(sentence, w[feature], 40)
        clean = np.exp(np.bincount(doc, -np.log1p(np.exp(z)), 12))
        return -(np.where(y == 1, np.log(np.maximum(1 - clean, 1e-300)), np.log(np.maximum(clean, 1e-300)))).sum() + 0.05 * (w**2).sum()

    w, bias = toxicity.fit_weights(doc, sentence, feature, y, 5, steps=4000, rate=0.02)
    eps = 1e-4
    slopes = [(loss(w + eps * e, bias) - loss(w - eps * e, bias)) / (2 * eps) for e in np.eye(5)] + [(loss(w, bias + eps) - loss(w, bias - eps)) / (2 * eps)]
    assert np.abs(slopes).max() < 0.05 and loss(w, bias) < loss(np.ones(5), -2.0)


def test_noisy_or_locates_sentences(spark):
    rng = np.random.default_rng(0)
    calm = [f"word{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(400):
        sentences = [" ".join(rng.choice(calm, 8)) + "." for _ in range(6)]
        if i % 4 == 0:
            sentences[int(rng.integers(6))] = " ".join([*rng.choice(calm, 4), "Vile", *rng.choice(calm, 3)]) + "."
        rows.append((i, " ".join(sentences)))
        marks.append((i, int(i % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = toxicity.score(df, toxicity.fit(df, spark.createDataFrame(marks[:300], "doc_id long, toxic int"))).collect()
    for r in out:
        assert (r.toxicity >= 0.7) == (r.doc_id % 4 == 0)
        assert ["Vile" in s.sentence for s in r.toxic_sentences] == [True] * (r.doc_id % 4 == 0)
