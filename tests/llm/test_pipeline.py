import math
import os
import random
import shutil
import zlib

import corpus_pipeline as P
import numpy as np
import pyarrow as pa
import pytest
from llm.helpers import empty, messy
from llm.test_classifiers import plain_sentences
from llm.test_mixing import water
from llm.test_neardup import brute
from llm.test_secrets import base

from fieldlight.llm import mixing, packing, secrets, toxicity
from fieldlight.llm.common import held_out, labels

NAMES = ["toxicity", "near_duplicates", "secrets", "mixing", "packing"]
FIRST = 10**6


def planted():
    """Rows whose fate is known: a base secret; a text, a copy of it and a near copy; a text unlike it by over a fifth."""
    rng = random.Random(5)
    words = rng.sample([f"term{i}" for i in range(900)], 120)
    near, far = list(words), list(words)
    near[60] = "other"
    far[10:100:12] = ["other"] * 8
    texts = ["some calm words password = hunter2222 and more of them", *(" ".join(w) for w in (words, words, near, far))]
    return [(FIRST + i, t, "en", "src0", len(t)) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def larger(sf_dir):
    """The smallest tables have too few toxic documents to learn from."""
    return sf_dir.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def stages(spark, larger, tmp_path_factory):
    """The input and the output of each stage on these tables and the planted rows."""
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    more = spark.createDataFrame(planted(), "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.unionByName(more.select(*[more[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns]))
    assert [n for n, _ in P.STAGES] == NAMES
    folder, kept = tmp_path_factory.mktemp("stages"), {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, larger)
        assert name == "packing" or out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(folder / name))
        kept[name] = (docs, spark.read.parquet(str(folder / name)))
        docs = kept[name][1]
    return kept


def test_toxicity(spark, larger, stages):
    """The fitted weights through a plain noisy-or, sentence by sentence and word by word."""
    before, after = stages["toxicity"]
    marks = labels(spark, larger).select("doc_id", "toxic").where(~held_out("doc_id", toxicity.FOLDS, toxicity.FOLD))
    model = toxicity.fit(before, marks)
    weight = dict(zip(model.keys.tolist(), model.weights.tolist(), strict=True))
    known = {}

    def features(word):
        if word not in known:
            found = {int(k[0]) for k in toxicity.features_of(toxicity.sentences_of(pa.array([word])))}
            known[word] = {k for k in found if k in weight}
        return known[word]

    want = set()
    for r in before.collect():
        clean = 1.0
        for sentence in plain_sentences(r.text):
            hits = set().union(*map(features, sentence))
            if hits:
                clean /= 1 + math.exp(model.bias + sum(weight[k] for k in hits))
        assert abs(1 - clean - toxicity.THRESHOLD) > 1e-6
        if 1 - clean < toxicity.THRESHOLD:
            want.add(r.doc_id)
    assert {r.doc_id for r in after.collect()} == want and len(want) < before.count()


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    found = brute([(r.doc_id, r.text) for r in before.collect()], round(100 * P.SIMILARITY))
    kept = {r.doc_id for r in after.collect()}
    assert kept == {d for d, (_, component) in found.items() if d == component}
    assert kept >= {FIRST, FIRST + 1, FIRST + 4} and not kept & {FIRST + 2, FIRST + 3}


def test_secrets(stages):
    before, after = stages["secrets"]
    spans = {r.doc_id: (r.text, [tuple(s) for s in r.secret_spans]) for r in secrets.find_secrets(before).collect()}
    masked = {}
    for r in after.collect():
        text, found = spans[r.doc_id]
        assert [s for s in found if s[1] < 3] == base(text)
        out, at = "", 0
        for a, _, b in found:
            if a >= at:
                out += text[at:a] + secrets.MASK
            at = max(at, b)
        assert r.text == out + text[at:] and r.n_chars == len(r.text)
        masked[r.doc_id] = r.text
    assert masked.keys() == spans.keys() and masked[FIRST] == f"some calm words {secrets.MASK} and more of them"


def test_mixing(stages):
    """Words by source against targets by plain iteration, to the largest document of a source."""
    before, after = stages["mixing"]
    count = lambda text: len((text or "").encode().split())
    sizes, largest, taken, copies = {}, {}, {}, {}
    texts = {r.doc_id: r for r in before.collect()}
    for r in texts.values():
        sizes[r.source] = sizes.get(r.source, 0) + count(r.text)
        largest[r.source] = max(largest.get(r.source, 0), count(r.text))
    for r in after.collect():
        assert r == texts[r.doc_id]
        taken[r.source] = taken.get(r.source, 0) + count(r.text)
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = water([sizes[s] for s in order], [mixing.WEIGHTS[k % 3] for k in range(len(order))], mixing.SHARE, mixing.MOST_COPIES)
    for source, target in zip(order, want, strict=True):
        assert abs(taken.get(source, 0) - target) <= largest[source]
    assert max(copies.values()) <= 2


def test_packing(stages):
    """Ids by the tokenizer alone; pieces of all copies, sequences without gaps."""
    from tokenizers import Tokenizer

    before, after = stages["packing"]
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    copies, ids = {}, {}
    for r in before.collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        if r.doc_id not in ids:
            ids[r.doc_id] = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
    begun, length, filled = {}, {}, {}
    for r in after.collect():
        whole = ids[r.doc_id]
        assert r.doc_tokens == len(whole) and r.ids_crc32 == zlib.crc32(whole[r.start : r.start + r.length].tobytes())
        begun[r.doc_id] = begun.get(r.doc_id, 0) + (r.start == 0)
        length[r.doc_id] = length.get(r.doc_id, 0) + r.length
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert begun == copies and length == {d: n * len(ids[d]) for d, n in copies.items()}
    for sequence, parts in filled.items():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end == packing.WINDOW or sequence == len(filled) - 1
    assert sorted(filled) == list(range(len(filled)))


def test_messy_and_empty(spark, sf_dir, tmp_path):
    for name, df in (("messy", messy(spark)), ("empty", empty(spark))):
        d = str(tmp_path / name)
        os.makedirs(d)
        df.write.parquet(f"{d}/documents.parquet")
        shutil.copyfile(f"{sf_dir}/labels.parquet", f"{d}/labels.parquet")
        docs = spark.read.parquet(f"{d}/documents.parquet")
        for stage, f in P.STAGES[:-1]:
            after = f(spark, docs, d)
            assert after.columns == docs.columns
            after.write.parquet(f"{d}/{stage}")
            docs = spark.read.parquet(f"{d}/{stage}")
        got = P.run(spark, d)
        assert (got.count() == 0) == (name == "empty")
