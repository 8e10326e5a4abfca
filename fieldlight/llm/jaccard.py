"""N-gram Jaccard join with a token-group matrix. Exact: no link is lost and none is false.

1. Each text becomes its set of three-word shingles (64-bit hashes). Texts of equal sets are one node.
2. Sets that can be linked meet. Two sets of similarity T differ in at most D shingles, D by their size class. The shingles' space is cut
   by a hash into D + 1 parts and some spare ones, so a linked pair agrees on more parts than it has spares; each part's content is
   a key. A part holds about eight shingles at 0.9, so passages that many documents share make no key of their own. Parts of
   SPARSE shingles or fewer, which unrelated sets may share, are left out where a set has spares for all of them; in size classes
   without spares their keys are refined by the parts of a second cut. A set is also cut by the smaller size classes that hold
   partners of its. At lower thresholds parts get smaller and more: still exact, but with more keys and candidates.
3. Sets that share keys make candidate families, which come in units of bounded size (see neardup.py). In a unit
   similar documents, neighbours in the order of their MinHash sketch, are partitioned into groups of GROUP. The unit's
   token-group matrix holds each group's union of shingles, by shingle. A query's column sums bound its overlap with any member of a group:
   T times the larger of the query's size and the group's least size is needed. Only groups that reach it are
   opened: their members, as far as they are of other components, are compared on the full sets.
4. Components of the links are the classes.

Cost: as of neardup.py; the matrix spares most comparisons between documents of one family that are not linked. Near copies
of one text, however many, take linear work; it is quadratic, in blocks, where very many sets of one size class share keys without
being linked.

Cases: a null text, or one without words, has an empty set and is linked with nothing; with fewer words than a shingle, the whole
sequence is one shingle; repeated rows are alike. Rows of one doc_id with different texts are one document that is linked by
any of them. A null doc_id is returned with null component; an empty table gives no row; texts count whole; other
columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlight.llm.common import documents, slices
from fieldlight.llm.neardup import resolved, shared_with, shingle_sets, signatures
from fieldlight.llm.words import _GOLD, U, mix

WORDS, THRESHOLD = 3, 0.9
#: A size class ends at so many times the end of the one before.
GROWTH = 1.25
#: Shingles of a part that unrelated sets may share by chance; parts per spare part.
SPARSE, PER_SPARE = 2, 20
#: Members of a group of the matrix; MinHash values that order them.
GROUP, SKETCH = 16, 8
_EPS = 1e-9


@lru_cache(8)
def size_classes(threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(ends of the classes, most shingles that differ in a linked pair whose smaller set is of the class)."""
    ends, end = [1], 1.0
    while ends[-1] < 1 << 40:
        end = max(end * GROWTH, ends[-1] + 1)
        ends.append(int(end))
    ends = np.array(ends)
    return ends, np.floor((1 - threshold) / threshold * ends + 1e-6).astype(np.int64)


@dataclass
class Parts:
    """Parts of several sets, one after another: sums (of the shingles' hashes) and counts; the parts of set i are first[i] : first[i + 1]."""

    sums: np.ndarray
    counts: np.ndarray
    first: np.ndarray


def cut_sets(sets: np.ndarray, lengths: np.ndarray, parts: np.ndarray, salt: int) -> Parts:
    """Each set's shingles dealt into its number of parts by a hash."""
    first = np.concatenate([[0], np.cumsum(parts)])
    h = mix(sets + U(salt * int(_GOLD) & 0xFFFFFFFFFFFFFFFF))
    own = np.repeat(parts, lengths).astype(U)
    place = ((h >> U(32)) * own >> U(32)).astype(np.int64) + np.repeat(first[:-1], lengths)
    order = np.argsort(place, kind="stable")
    counts = np.bincount(place, minlength=first[-1])
    sums = np.zeros(first[-1], U)
    if len(order):
        full = np.flatnonzero(counts)
        sums[full] = np.add.reduceat(h[order], np.cumsum(counts[full]) - counts[full])
    return Parts(mix(sums + counts.astype(U)), counts, first)


def keys_of(sets: np.ndarray, offsets: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all sets' keys: sets that are linked and not equal share one."""
    n = np.diff(offsets)
    ends, differ = size_classes(threshold)
    top = np.searchsorted(ends, n)
    low = np.searchsorted(ends, np.maximum(np.ceil(threshold * n - 1e-6).astype(np.int64), 1))
    rows, keys = [np.zeros(0, np.int64)], [np.zeros(0, U)]
    for step in range(int((top - low).max(initial=-1)) + 1):
        at = np.flatnonzero((n > 0) & (top - step >= low) & (differ[np.maximum(top - step, 0)] > 0))
        if not len(at):
            continue
        kind, d, m = top[at] - step, differ[top[at] - step], n[at]
        ends_at = np.cumsum(m)
        own = sets[np.repeat(offsets[at] - (ends_at - m), m) + np.arange(m.sum())]
        spare = (d + 1) // PER_SPARE
        p = d + 1 + spare
        x = cut_sets(own, m, p, 1)
        of = np.repeat(np.arange(len(at)), p)
        key = mix(x.sums + mix((np.arange(len(of)) - x.first[of]).astype(U) + (kind[of].astype(U) << U(40))))
        sparse = x.counts <= SPARSE
        n_sparse = np.bincount(of[sparse], minlength=len(at))
        rows.append(at[of[~sparse]])
        keys.append(key[~sparse])
        # No set with more sparse parts than spares goes without their keys.
        kept = sparse & (n_sparse > spare)[of] & (spare > 0)[of]
        rows.append(at[of[kept]])
        keys.append(key[kept])
        odd = np.flatnonzero((n_sparse > spare) & (spare == 0))
        if len(odd):
            starts = ends_at - m
            again = cut_sets(np.concatenate([own[starts[i] : ends_at[i]] for i in odd]), m[odd], d[odd] + 1, 2)
            second = mix(again.sums + (np.arange(len(again.sums)) - np.repeat(again.first[:-1], d[odd] + 1)).astype(U) * _GOLD)
            for k, i in enumerate(odd):
                thin = key[x.first[i] : x.first[i + 1]][sparse[x.first[i] : x.first[i + 1]]]
                both = mix(thin[:, None] + second[None, again.first[k] : again.first[k + 1]]).ravel()
                rows.append(np.full(len(both), at[i]))
                keys.append(both)
    rows, keys = np.concatenate(rows), np.concatenate(keys)
    order = np.argsort(rows, kind="stable")
    return rows[order], keys[order]


def _described(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[pa.Array]]:
    """Sets, offsets, and the columns n, set_a, set_b."""
    sets, offsets = shingle_sets(batch.column("text"), WORDS)
    sums = []
    for salt in (U(0), _GOLD):
        total = np.concatenate([np.zeros(1, U), np.cumsum(mix(sets + salt))])
        sums.append(pa.array((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64)))
    return sets, offsets, [pa.array(np.diff(offsets), pa.int64()), *sums]


def describe(docs: DataFrame, threshold: float) -> DataFrame:
    """doc_id, n, set_a, set_b (128 bits that stand for the set), keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            sets, offsets, columns = _described(batch)
            rows, keys = keys_of(sets, offsets, threshold)
            first = np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(keys.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, lists], names=["doc_id", "n", "set_a", "set_b", "keys"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, set_a long, set_b long, keys array<long>")


def with_sets(candidates: DataFrame) -> DataFrame:
    """candidates: text, node, group, set_a, set_b. Returns node, group, n, sig (the sketch), shingles of the rows whose text has
    that set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            sets, offsets, (n, set_a, set_b) = _described(batch)
            sketch = signatures(sets, offsets, SKETCH)
            data = [sets[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            out = pa.RecordBatch.from_arrays([batch.column("node"), batch.column("group"), n, pa.array([x.tobytes() for x in sketch], pa.binary()), pa.array(data, pa.binary())], names=["node", "group", "n", "sig", "shingles"])
            yield out.filter(pc.and_(pc.equal(set_a, batch.column("set_a")), pc.equal(set_b, batch.column("set_b"))))

    return candidates.select("text", "node", "group", "set_a", "set_b").mapInArrow(run, "node long, group long, n long, sig binary, shingles binary")


@dataclass
class Matrix:
    """Token-group matrix of a unit, by token: the groups that hold token t are groups[first[t] : first[t + 1]]."""

    groups: np.ndarray
    first: np.ndarray
    group_of: np.ndarray
    least: np.ndarray

    def overlaps(self, tokens: np.ndarray) -> np.ndarray:
        """Of a set of tokens with each group's union."""
        n = self.first[tokens + 1] - self.first[tokens]
        ends = np.cumsum(n)
        at = np.repeat(self.first[tokens] - (ends - n), n) + np.arange(n.sum())
        return np.bincount(self.groups[at], minlength=len(self.least))


def matrix(sketch: np.ndarray, ranks: np.ndarray, bounds: np.ndarray) -> Matrix:
    """Groups of GROUP neighbours in the order of the sketch. Set k is ranks[bounds[k] : bounds[k + 1]]."""
    n = np.diff(bounds)
    group_of = np.empty(len(n), np.int64)
    group_of[np.lexsort(sketch.T[::-1])] = np.arange(len(n)) // GROUP
    count = int(group_of.max(initial=-1)) + 1
    held = np.unique(ranks * count + np.repeat(group_of, n))
    least = np.full(count, 1 << 62)
    np.minimum.at(least, group_of, n)
    tokens = int(ranks.max(initial=-1)) + 1
    return Matrix(held % count, np.searchsorted(held // count, np.arange(tokens + 1)), group_of, least)


def join_unit(side: np.ndarray, component: np.ndarray, sketch: np.ndarray, sets: list[np.ndarray], threshold: float, within: bool = True) -> tuple[list[int], int, int]:
    """Links of a spanning forest of the unit's pairs, as places (a, b, a, b, ...); members of the groups that were opened; pairs compared.
    Which pairs count is as in neardup.verify_unit()."""
    n = np.array([len(s) for s in sets])
    label = np.unique(component, return_inverse=True)[1]
    distinct, ranks = np.unique(np.concatenate(sets), return_inverse=True)
    bounds, seen = np.concatenate([[0], np.cumsum(n)]), np.zeros(len(distinct), bool)
    groups = matrix(sketch, ranks, bounds) if len(n) > GROUP else None
    out, opened, compared = [], 0, 0
    order = np.argsort(side, kind="stable")  # side 0 first
    first = int((side == 0).sum())
    for k in range(first):
        i = order[k]
        j = order[k + 1 if within else first :]
        small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        j = j[(small >= threshold * large - _EPS) & (label[j] != label[i]) & ((side[j] < 2) | (j > i))]
        if len(j) and groups is not None:
            # A linked member shares this much with the query, and so does the union of its group.
            enough = groups.overlaps(ranks[bounds[i] : bounds[i + 1]]) >= threshold * np.maximum(n[i], groups.least) - _EPS
            opened += int(enough.sum()) * GROUP
            j = j[enough[groups.group_of[j]]]
        if not len(j):
            continue
        compared += len(j)
        both = shared_with(i, j, ranks, bounds, seen)
        for x in j[both >= threshold * (n[i] + n[j] - both) - _EPS].tolist():
            if label[x] != label[i]:
                label[label == label[x]] = label[i]
                out += [int(i), x]
    return out, opened, compared


def join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, a row per row of docs."""
    return resolved(docs, describe(docs, threshold), with_sets, threshold, join_unit).drop("kept")


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(documents(spark, sf_dir))
