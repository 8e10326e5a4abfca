"""Quality: histogram gradient-boosted trees over document statistics.

Each text becomes one row of statistics (characters, words, lines, repetition) in a vectorised
pass without a shuffle. The trees are grown on quantile histograms of a bounded sample of labelled
rows, SAMPLE at most, picked by a hash of the id; statistics of that many rows fit the driver. The
fitted trees are complete binary trees in flat arrays (feature, threshold, leaf value), and scoring
walks all of a batch's rows down a tree level by level with numpy.

Cases: a null or empty text has all statistics 0 and gets a score like any other; repeated rows
score alike; a null doc_id is scored; null, repeated (the larger counts) or unknown labels do no
harm; of several texts of a labelled id one is learned from; with one class only, all score that class's share
(0.5 without labels); an empty table gives no row; very long texts count whole; a column named quality_score is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlight.llm.common import documents, held_out, labels, one_labelled, slices, with_fields
from fieldlight.llm.words import _GOLD, U, mix, ngrams, text_bytes, words_of

#: Labelled rows that the fit uses at most.
SAMPLE = 20_000
ROUNDS, DEPTH, BINS, RATE, LEAST_LEAF, PENALTY = 80, 4, 64, 0.15, 20, 1.0
THRESHOLD = 0.3
FOLDS, FOLD = 5, 0

STATISTICS = (
    "bytes", "words", "mean_word", "sd_word", "lines", "mean_line", "upper", "digits", "punctuation", "symbols", "pipes", "exclamations", "spaces", "non_ascii", "commas", "stops",
    "distinct_words", "distinct_trigrams", "top_word", "same_as_before", "short_words", "long_words", "words_with_symbol", "upper_words", "words_ending_stop", "repeated_lines", "words_per_stop", "digit_words",
)

_CLASS = {name: np.zeros(256, np.int8) for name in ("upper", "digits", "punctuation", "symbols", "pipes", "exclamations", "spaces", "non_ascii", "commas", "stops", "line")}
for _name, _chars in (("upper", range(65, 91)), ("digits", range(48, 58)), ("punctuation", b".,;:!?'\"()-"), ("symbols", b"#$%&*+/<=>@[\\]^_`{|}~"), ("pipes", b"|"), ("exclamations", b"!"), ("spaces", b" \t\n\r\x0b\x0c"), ("non_ascii", range(192, 256)), ("commas", b","), ("stops", b".?!"), ("line", b"\n")):
    _CLASS[_name][list(_chars)] = 1


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values between neighbouring offsets."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return np.diff(total[offsets]).astype(np.float64)


def _distinct(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each text, and the most common one's count."""
    n = len(first) - 1
    of = np.repeat(np.arange(n, dtype=np.int64), np.diff(first))
    tagged = np.sort(mix(keys + of.astype(U) * _GOLD) >> U(20) | of.astype(U) << U(44)) if n < 1 << 20 else None
    starts = np.flatnonzero(np.concatenate([[True], tagged[1:] != tagged[:-1]])) if len(tagged) else np.zeros(0, np.int64)
    size = np.diff(np.append(starts, len(tagged)))
    whose = (tagged[starts] >> U(44)).astype(np.int64) if len(tagged) else starts
    top = np.zeros(n, np.int64)
    np.maximum.at(top, whose, size)
    return np.bincount(whose, minlength=n).astype(np.float64), top.astype(np.float64)


def statistics(column: pa.Array) -> np.ndarray:
    """One row per text, in the order of STATISTICS."""
    data, offsets = text_bytes(column)
    w = words_of(column)
    n_bytes, n_words = np.diff(offsets).astype(np.float64), w.counts.astype(np.float64)
    per_byte, per_word = 1 / np.maximum(n_bytes, 1), 1 / np.maximum(n_words, 1)
    length = (w.ends - w.starts).astype(np.float64)
    out = {"bytes": n_bytes, "words": n_words, "mean_word": _sums(length, w.first) * per_word}
    out["sd_word"] = np.sqrt(np.maximum(0, _sums(length * length, w.first) * per_word - out["mean_word"] ** 2))
    out["lines"] = _sums(_CLASS["line"][data], offsets) + (n_bytes > 0)
    out["mean_line"] = n_words / np.maximum(out["lines"], 1)
    for name in ("upper", "digits", "punctuation", "symbols", "pipes", "exclamations", "spaces", "non_ascii", "commas"):
        out[name] = _sums(_CLASS[name][data], offsets) * per_byte
    stops = _sums(_CLASS["stops"][data], offsets)
    out["stops"], out["words_per_stop"] = stops * per_byte, n_words / np.maximum(stops, 1)
    h = w.hashes()
    distinct, top = _distinct(h, w.first)
    out["distinct_words"], out["top_word"] = distinct * per_word, top * per_word
    # Trigrams within a text only, so that a score does not depend on the text behind it.
    left = np.repeat(w.first[1:], w.counts)[: max(0, len(h) - 2)] - np.arange(max(0, len(h) - 2))
    grams = ngrams(h, 3)[left >= 3]
    out["distinct_trigrams"] = _distinct(grams, np.concatenate([[0], np.cumsum(np.maximum(w.counts - 2, 0))]))[0] * per_word
    same = np.zeros(len(h), np.int8)
    if len(h):
        same[1:] = h[1:] == h[:-1]
        same[w.first[:-1][w.first[:-1] < len(h)]] = 0
    out["same_as_before"] = _sums(same, w.first) * per_word
    out["short_words"], out["long_words"] = _sums((length <= 2).astype(np.int8), w.first) * per_word, _sums((length >= 14).astype(np.int8), w.first) * per_word

    def words_with(name: str) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(_CLASS[name][data], dtype=np.int64)])
        return total[w.ends] - total[w.starts]

    out["words_with_symbol"] = _sums((words_with("symbols") > 0).astype(np.int8), w.first) * per_word
    out["digit_words"] = _sums((words_with("digits") > 0).astype(np.int8), w.first) * per_word
    out["upper_words"] = _sums((words_with("upper") * 2 > length).astype(np.int8), w.first) * per_word
    out["words_ending_stop"] = _sums(_CLASS["stops"][data[w.ends - 1]] if len(data) else np.zeros(0, np.int8), w.first) * per_word
    # Lines: a hash of each line's words, from prefix sums of their hashes.
    line_of = np.concatenate([[0], np.cumsum(_CLASS["line"][data], dtype=np.int64)])[w.starts]
    new = np.ones(len(h), bool)
    if len(h):
        new[1:] = line_of[1:] != line_of[:-1]
        new[w.first[:-1][w.first[:-1] < len(h)]] = True
    at = np.flatnonzero(new)
    total = np.concatenate([np.zeros(1, U), np.cumsum(mix(h + _GOLD))])
    line = total[np.append(at, len(h))[1:]] - total[at] if len(at) else np.zeros(0, U)
    first_line = np.searchsorted(at, w.first)
    n_lines = np.diff(first_line).astype(np.float64)
    out["repeated_lines"] = 1 - _distinct(line, first_line)[0] / np.maximum(n_lines, 1)
    out["repeated_lines"][n_lines == 0] = 0
    return np.stack([out[name] for name in STATISTICS], axis=1)


@dataclass
class Trees:
    """rounds x (2**depth - 1) inner nodes in level order, rounds x 2**depth leaves."""

    base: float
    feature: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.int32))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    leaf: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def margins(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while node.size and node[0] < len(feature):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - len(feature)] if node.size else 0
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH, bins: int = BINS, rate: float = RATE, least: int = LEAST_LEAF, penalty: float = PENALTY) -> Trees:
    """Newton boosting of the log-loss on histograms of quantile bins."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = np.log(share / (1 - share))
    if not len(y) or y.min() == y.max():
        return Trees(base)
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], axis=1)
    margin, inner = np.full(n, base), 2**depth - 1
    features, thresholds, leaves = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, threshold = np.zeros(inner, np.int32), np.full(inner, np.inf)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * m + np.arange(m)) * bins + binned
            hist = [np.bincount(cell.ravel(), np.repeat(v, m), count * m * bins).reshape(count, m, bins) for v in (g, h, np.ones(n))]
            left = [np.cumsum(v, axis=2) for v in hist]
            right = [v[:, :, -1:] - v for v in left]
            gain = left[0] ** 2 / (left[1] + penalty) + right[0] ** 2 / (right[1] + penalty)
            whole = (left[0][:, :, -1:] + 0) ** 2 / (left[1][:, :, -1:] + penalty)
            gain = np.where((left[2] >= least) & (right[2] >= least), gain - whole, -np.inf)
            best = gain.reshape(count, -1).argmax(axis=1)
            for k in range(count):
                j, b = divmod(int(best[k]), bins)
                if gain[k, j, b] > 1e-9 and b < len(edges[j]):
                    feature[first + k], threshold[first + k] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        at = node - inner
        leaf = -rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + penalty)
        margin += leaf[at]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Trees(base, np.array(features), np.array(thresholds), np.array(leaves))


def fit(docs: DataFrame, marks: DataFrame, sample: int = SAMPLE) -> Trees:
    """marks: doc_id, quality, of the rows that may be learned from."""
    marked = one_labelled(docs, marks, "quality", sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            x = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], names=["y", "x"])

    # At most `sample` rows of statistics come back.
    got = marked.mapInArrow(run, "y int, x array<double>").toArrow()
    x = np.array(got.column("x").combine_chunks().flatten()).reshape(-1, len(STATISTICS))
    y = np.array(got.column("y"), np.float64)
    order = np.lexsort((y, *x.T))  # the fit doesn't depend on the order of arrival
    return grow(x[order], y[order])


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """All columns of docs, with quality_score; a column of docs by that name is replaced."""
    docs = docs.drop("quality_score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(trees.scores(statistics(batch.column("text"))))], names=[*batch.schema.names, "quality_score"])

    return docs.mapInArrow(run, with_fields(docs, "quality_score double"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    marks = labels(spark, sf_dir).select("doc_id", "quality").where(~held_out("doc_id", FOLDS, FOLD))
    scored = score(docs, fit(docs, marks))
    return scored.select("doc_id", held_out("doc_id", FOLDS, FOLD).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))
