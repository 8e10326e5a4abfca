"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only the bag is labelled. A sentence's score is logistic in
the features it holds (words and beginnings of words); a sentence without a known feature scores
0. Sentences combine by noisy-or, 1 - prod(1 - p), and the weights are fitted to the documents'
labels through it, so that blame settles on single sentences, which scoring then returns.

Features are chosen from counts over the sample's documents, in Spark: those that toxic documents
hold far more often than others. The fit uses a bounded sample of labelled rows, SAMPLE at most,
picked by a hash of the id; scoring is one pass without a shuffle.

Cases: a null or empty text has no sentence and scores as one without features; repeated rows
score alike; a null doc_id is scored; labels that are null, repeated (the larger counts) or of
unknown documents do no harm; of several texts of a labelled id one is learned from; with one class only, all score
that class's share: 0 without a toxic label, 1 without a clean one (0 without labels); an empty table gives no row; very
long texts are scored whole; columns named toxicity or toxic_sentences are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlight.llm.common import cut, documents, held_out, labels, one_labelled, slices, with_fields
from fieldlight.llm.words import U, _MASK, Words, mix, text_bytes

#: Labelled documents that the fit uses at most, and features it keeps at most.
SAMPLE, FEATURES = 20_000, 4096
#: A feature needs so many toxic documents, and so many times the share among others.
LEAST_DOCS, LEAST_LIFT = 4, 4.0
PREFIXES = (4, 5, 6, 7, 8)
THRESHOLD = 0.7
FOLDS, FOLD = 3, 1

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?\n")] = True


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the Latin-1 capitals of UTF-8 made small."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    if len(data) > 1:
        second = np.zeros(len(data), bool)
        second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[second] += 32
    return out


@dataclass
class Sentences:
    """bounds: n+1 byte offsets of all sentences; first: where each text's begin; of: each token's."""

    words: Words
    bounds: np.ndarray
    first: np.ndarray
    of: np.ndarray


def sentences_of(column: pa.Array) -> Sentences:
    """Tokens are runs of letters; a sentence ends after . ! ? or a line end, or with the text."""
    raw, offsets = text_bytes(column)
    data = lowered(raw)
    n = len(data)
    inside = np.zeros(n + 1, np.int8)
    inside[:-1] = _LETTER[data]
    before = np.zeros(n + 1, np.int8)
    before[1:] = inside[:-1]
    cut_at = offsets[(offsets > 0) & (offsets < n)]
    ends_at = before & (inside ^ 1)
    before[cut_at] = 0
    starts_at = inside & (before ^ 1)
    ends_at[cut_at] = inside[cut_at - 1]
    starts, ends = np.flatnonzero(starts_at), np.flatnonzero(ends_at)
    edge = np.zeros(n + 1, bool)
    edge[1:] = _STOP[data]
    edge[offsets] = True
    bounds = np.flatnonzero(edge)
    return Sentences(Words(data, starts, ends, np.searchsorted(starts, offsets)), bounds, np.searchsorted(bounds, offsets), np.searchsorted(bounds, starts, "right") - 1)


def features_of(s: Sentences) -> list[np.ndarray]:
    """Keys of each token: the whole word, and its first bytes where it is longer."""
    w = s.words
    n = len(w.data)
    at = np.zeros(n + 8, U)
    at[:n] = w.data
    for shift in (1, 2, 4):
        at[:-shift] |= at[shift:] << U(8 * shift)
    head, length = at[w.starts], w.ends - w.starts
    out = [w.hashes()]
    for k in PREFIXES:
        out.append(np.where(length > k, mix((head & _MASK[k]) + U(k)), U(0)))
    return out


@dataclass
class Model:
    """keys: sorted; weights: theirs; bias: of a sentence with features; least: what any document scores at least."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    least: float = 0.0

    def __post_init__(self) -> None:
        self.quick = np.zeros(1 << 20, bool)
        self.quick[(self.keys >> U(44)).astype(np.int64)] = True

    def hits(self, s: Sentences) -> tuple[np.ndarray, np.ndarray]:
        """(sentence, feature), each pair once, by sentence."""
        found = []
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        for keys in features_of(s):
            near = np.flatnonzero(self.quick[(keys >> U(44)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.keys, keys[near]), len(self.keys) - 1)
            good = self.keys[at] == keys[near]
            found.append(s.of[near[good]] * len(self.keys) + at[good])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.keys), pairs % len(self.keys)


def noisy_or(weights: np.ndarray, bias: float, sentence: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sentences that have features, ascending, and their scores."""
    ids, at = np.unique(sentence, return_inverse=True)
    z = bias + np.bincount(at, weights[feature], len(ids))
    return ids, 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit_weights(doc: np.ndarray, sentence: np.ndarray, feature: np.ndarray, y: np.ndarray, n_features: int, steps: int = 500, rate: float = 0.1, penalty: float = 0.1) -> tuple[np.ndarray, float]:
    """Gradient steps (Adam) on the documents' log-loss through the noisy-or. doc: of each sentence;
    sentence, feature: the hits; y: of each document. Documents without hits do not matter."""
    w, bias = np.full(n_features, 1.0), -2.0
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    n_docs, n_sentences = len(y), len(doc)
    for step in range(1, steps + 1):
        z = np.clip(bias + np.bincount(sentence, w[feature], n_sentences), -30, 30)
        p = 1 / (1 + np.exp(-z))
        log_clean = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), n_docs)
        clean = np.exp(log_clean)
        # d loss / d z of a sentence: p for a clean document, -p * clean / (1 - clean) for a toxic one
        share = np.where(y == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0)
        g = share[doc] * p
        grad = np.append(np.bincount(feature, g[sentence], n_features), g.sum()) / max(1, n_docs)
        grad[:-1] += penalty / max(1, n_docs) * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def fit(docs: DataFrame, marks: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> Model:
    """marks: doc_id, toxic, of the rows that may be learned from."""
    nothing = Model(np.zeros(0, U), np.zeros(0), -30.0)
    marked = cut(one_labelled(docs, marks, "toxic", sample), "marked")
    n, n_toxic = marked.agg(F.count("*"), F.sum("y")).first()
    if not n or not n_toxic:
        return nothing
    if n_toxic == n:
        return Model(np.zeros(0, U), np.zeros(0), -30.0, least=1.0)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            s = sentences_of(batch.column("text"))
            token_doc = np.repeat(np.arange(batch.num_rows), s.words.counts)
            y = batch.column("y").to_numpy()
            all_keys = np.concatenate(features_of(s))
            order = np.lexsort((np.tile(token_doc, 1 + len(PREFIXES)), all_keys))
            k, d = all_keys[order], np.tile(token_doc, 1 + len(PREFIXES))[order]
            once = np.ones(len(k), bool)
            once[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
            k, toxic = k[once], y[d[once]]
            starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
            if not len(starts):
                continue
            total = np.diff(np.append(starts, len(k)))
            positive = np.add.reduceat(toxic.astype(np.int64), starts)
            yield pa.RecordBatch.from_arrays([pa.array(k[starts].view(np.int64)), pa.array(positive), pa.array(total - positive)], names=["key", "toxic", "clean"])

    counts = marked.select("text", "y").mapInArrow(keys, "key long, toxic long, clean long").where("key <> 0")
    counts = counts.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") >= LEAST_DOCS)
    base = n_toxic / n
    lift = (F.col("toxic") + 0.5) / (F.col("clean") + 0.5) / (base / (1 - base))
    gain = F.col("toxic") * F.log(lift)
    best = counts.where(lift >= LEAST_LIFT).orderBy(gain.desc(), "key").limit(features).select("key").collect()  # `features` at most
    if not best:
        return nothing
    model = Model(np.sort(np.array([r[0] for r in best], np.int64).view(U)), np.zeros(len(best)), 0.0)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            s = sentences_of(batch.column("text"))
            sentence, feature = model.hits(s)
            doc = np.searchsorted(s.first, sentence, "right") - 1
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x)) for x in (sentence.astype(np.int64), feature.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column("y"), *lists], names=["y", "sentence", "feature"])

    got = marked.select("text", "y").mapInArrow(hits, "y int, sentence array<long>, feature array<int>").collect()  # `sample` rows, hits only
    y = np.array([r["y"] for r in got], np.int64)
    doc = np.repeat(np.arange(len(got)), [len(r["sentence"]) for r in got])
    raw = np.concatenate([np.array(r["sentence"], np.int64) for r in got])
    feature = np.concatenate([np.array(r["feature"], np.int64) for r in got])
    pairs, sentence = np.unique(np.stack([doc, raw]), axis=1, return_inverse=True)
    weights, bias = fit_weights(pairs[0], sentence.ravel(), feature, y, len(model.keys))
    return Model(model.keys, weights, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of docs, with toxicity (0 to 1) and toxic_sentences, an array of (sentence, score) of
    those that score over a half; columns of docs by these names are replaced."""
    docs = docs.drop("toxicity", "toxic_sentences")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            s = sentences_of(batch.column("text"))
            ids, p = noisy_or(model.weights, model.bias, *model.hits(s)) if len(model.keys) else (np.zeros(0, np.int64), np.zeros(0))
            doc = np.searchsorted(s.first, ids, "right") - 1
            total = np.maximum(model.least, 1 - np.exp(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), batch.num_rows)))
            raw, _ = text_bytes(batch.column("text"))
            shown: list[list] = [[] for _ in range(batch.num_rows)]
            for i in np.flatnonzero(p > 0.5):
                text = raw[s.bounds[ids[i]] : s.bounds[ids[i] + 1]].tobytes().decode("utf-8", "replace").strip()
                shown[doc[i]].append({"sentence": text, "score": float(p[i])})
            kind = pa.list_(pa.struct([("sentence", pa.string()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total, pa.float64()), pa.array(shown, kind)], names=[*batch.schema.names, "toxicity", "toxic_sentences"])

    return docs.mapInArrow(run, with_fields(docs, "toxicity double, toxic_sentences array<struct<sentence:string,score:double>>"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    marks = labels(spark, sf_dir).select("doc_id", "toxic").where(~held_out("doc_id", FOLDS, FOLD))
    scored = score(docs.select("doc_id", "text"), fit(docs, marks))
    return scored.select(
        "doc_id", held_out("doc_id", FOLDS, FOLD).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
        F.transform("toxic_sentences", lambda x: x["sentence"]).alias("offending"),
    )
