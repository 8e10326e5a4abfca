"""Alignment of two tokenizers over a corpus, with counts of the id pairs whose tokens end together.

1. First pass: each document is cut into segments, a run of spaces and what follows up to the next one, at whose ends both
   tokenizers end a token. A distinct segment is tokenised and aligned once for as long as it is kept. A task counts its pairs and hands
   them out by shard of the pair's hash.
2. Each shard's distinct pairs get a minimal perfect hash: bit levels in which a pair lies where it collides with no other, ranked by
   counts of the bits before.
3. Counts are dense vectors, indexed by that hash. The vectors of FAN tasks are summed at a time, in a tree, until there is one per
   shard. Beside them lie the keys, since a perfect hash says nothing of pairs it was not built for.
4. Second pass: documents are aligned again and look their pairs up; a slot counts only if its key is the pair. Up to MOST_SENT bytes
   of vectors are sent to all executors, a size that is read before; beyond it the documents' distinct pairs are joined with the table.

Distinct pairs are bounded by the product of the two vocabularies and grow far slower than the corpus; no task holds more than a
shard of them in steps 1 to 3.

Cases: a null or empty text has no tokens, nor has one whose tokens' bytes are not its own with a space before (as normalisation, or
the piece tokenizer's mark for space in a text, may cause): zeros and an empty groups_sha256; repeated rows count each; a null
doc_id is kept; texts count whole; an empty table gives no row; other columns, whatever their names, play no part.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlight.llm.common import cut, documents, slices
from fieldlight.llm.words import U, mix

#: Shards of the pairs; vectors that are summed at once.
SHARDS, FAN = 64, 16
#: Bytes of keys, counts and marks that are sent to every executor, and to the driver, at most.
MOST_SENT = 64 << 20
#: Segments, and characters of them, that a Python worker keeps; pairs that a task counts before it hands them out.
KEPT, CHARACTERS, COUNTED = 600_000, 10 << 20, 500_000
#: Slots per key of a bit level; levels; what is left then is kept in order.
LOAD, LEVELS = 2, 24
#: The piece tokenizer's mark for a space.
MARK = "▁"
_SEGMENT = re.compile(" +[^ ]*")
#: White space that could take the spaces behind it into its own token.
_JOINS = re.compile(r"[^\S ] {2}")
#: Segments that stay apart whatever stands beside them.
_PLAIN = re.compile(r" [^ ]*\S")
#: Byte-level vocabularies write the bytes without a printable Latin-1 character as U+0100 onwards.
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}
_LETTER_BYTES = {chr(_BYTE_LETTERS.get(b, b)): b for b in range(256)}
#: Texts by which loaded tokenizers are held against their use on segments.
_PROBES = ("It's 12 o'clock, isn't  it?", "  two   spaces\tand\nlines \n next", "naïve Café ½ ﬁ é 漢字 \U0001f600", "x y 　z 3.14 <|tag|> don't", "a ", " ", "\n\n b")


class Aligner:
    """Ids and alignment of texts under the tokenizers A (byte-level) and B (pieces). What is known of a segment has a place: ok (whether its tokens'
    bytes are its own), sizes (n_a, n_b, n_groups), links (those of place p are links[first[p] : first[p + 1]]; A's id << 32 | B's id) and, if they
    are asked for, its groups as text."""

    def __init__(self, path_a: str, path_b: str, with_groups: bool = True):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        known_a = {i: s.encode() if s in special else bytes(_LETTER_BYTES[c] for c in s) for s, i in self.a.get_vocab().items()}
        self.bytes_a = [known_a.get(i, b"") for i in range(max(known_a) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace(MARK, " ").encode() for p in pieces]
        self.length_a, self.length_b = (np.array([len(x) for x in t]) for t in (self.bytes_a, self.bytes_b))
        self.numbers = list(map(str, range(max(len(self.bytes_a), len(self.bytes_b)))))
        self.with_groups = with_groups
        self.fast_a = self._ranks(special, path_a)
        # Pieces that go on behind a mark would let B merge over segments.
        self.by_segment = not any(MARK in p.lstrip(MARK) for p in pieces) and self._agrees()
        self.known: dict[str, int] = {}
        self.forget()

    def _ranks(self, special: set[str], path: str):
        """The same vocabulary by ranks, many times as fast on long texts, if the ids are in order of the merges and both agree on the probes."""
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"].get("merges", [])]
        ids = [self.a.token_to_id(x + y) for x, y in merges]
        if ids != sorted(ids) or len(set(ids)) != len(ids) or "ByteLevel" not in json.dumps(spec.get("pre_tokenizer")):
            return None
        ranks = {_bytes_of(s): i for s, i in self.a.get_vocab().items() if s not in special}
        try:
            import public_tokenizers

            coder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        except ImportError:
            return None
        texts = [" " + t for t in _PROBES]
        return coder if all(coder.encode_ordinary(t) == ids for t, ids in zip(texts, self.ids_a(texts), strict=True)) else None

    def forget(self) -> None:
        self.known.clear()
        self.held = 0
        self.ok: list[bool] = []
        self.groups: list[str] = []
        self.sizes, self.links, self.first = np.zeros((0, 3), np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.stats, self.stats_of = np.zeros((0, 6), np.int64), ""

    def ids_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]

    def ids_b(self, texts: list[str]) -> list[list[int]]:
        """texts begin with the space that B adds."""
        out = self.b.encode([t[1:] for t in texts], num_threads=1)
        return [ids or [self.b.piece_to_id(MARK)] for ids in out]

    def _agrees(self) -> bool:
        for text in _PROBES:
            whole = " " + text
            parts = _SEGMENT.findall(whole)
            joined = lambda many: [i for ids in many for i in ids]
            if joined(self.ids_b(parts)) != self.ids_b([whole])[0] or (not _JOINS.search(whole) and joined(self.ids_a(parts)) != self.ids_a([whole])[0]):
                return False
        return True

    def _add(self, segments: list[str], ok: list[bool], a: np.ndarray, b: np.ndarray, bounds: np.ndarray) -> None:
        """segments lie one after another in bounds, bytes' ends that are tokens' ends in both; a, b: the ids of all of them. Those that are not ok
        have none and no bytes."""
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        near = np.searchsorted(ends_b, ends_a)
        met = np.flatnonzero(ends_b[np.minimum(near, len(b) - 1)] == ends_a) if len(b) else np.zeros(0, np.int64)
        cuts, to_a, to_b = ends_a[met], met + 1, near[met] + 1
        # No token is empty, so one pair of tokens ends at each cut.
        links = (a[to_a - 1] << 32) | b[to_b - 1]
        at = np.searchsorted(cuts, bounds, "right")
        each = lambda to: np.diff(np.concatenate([[0], to])[at], prepend=0)
        place = len(self.ok)
        self.known.update(zip(segments, range(place, place + len(segments)), strict=True))
        self.held += sum(map(len, segments))
        self.ok += ok
        self.sizes = np.concatenate([self.sizes, np.column_stack([each(to_a), each(to_b), np.diff(at, prepend=0)])])
        self.first = np.concatenate([self.first, self.first[-1] + at])
        self.links = np.concatenate([self.links, links])
        if self.with_groups:
            text_a, text_b = (list(map(self.numbers.__getitem__, x.tolist())) for x in (a, b))
            shown, i, j = [], 0, 0
            for k, m in zip(to_a.tolist(), to_b.tolist(), strict=True):
                shown.append(f"{text_a[i]}|{text_b[j]}" if k - i == m - j == 1 else f"{','.join(text_a[i:k])}|{','.join(text_b[j:m])}")
                i, j = k, m
            self.groups += [shown[i] if k - i == 1 else ";".join(shown[i:k]) for i, k in zip([0, *at[:-1].tolist()], at.tolist(), strict=True)]

    def _learn_apart(self, segments: list[str]) -> None:
        """Each by itself."""
        ok, ids_a, ids_b, bounds, end = [], [], [], [], 0
        for s, a, b in zip(segments, self.ids_a(segments), self.ids_b(segments), strict=True):
            own = s.encode()
            ok.append(b"".join(map(self.bytes_a.__getitem__, a)) == own == b"".join(map(self.bytes_b.__getitem__, b)))
            if ok[-1]:
                ids_a += a
                ids_b += b
                end += len(own)
            bounds.append(end)
        self._add(segments, ok, np.array(ids_a, np.int64), np.array(ids_b, np.int64), np.array(bounds, np.int64))

    def _learn_together(self, segments: list[str]) -> list[str]:
        """Segments of one space and no white space at their end, tokenised as one text, in which they stay apart. Returns those that are left."""
        chunks = [segments[i : i + 64] for i in range(0, len(segments), 64)]
        joined = ["".join(c) for c in chunks]
        good, ids_b, left = [], [], []
        for c, text, b in zip(chunks, joined, self.ids_b(joined), strict=True):
            if b"".join(map(self.bytes_b.__getitem__, b)) == text.encode():
                good += c
                ids_b += b
            else:
                left += c
        text = "".join(good)
        a, b = np.array(self.fast_a.encode_ordinary(text), np.int64), np.array(ids_b, np.int64)
        bounds = np.cumsum(np.fromiter(map(len, map(str.encode, good)), np.int64, len(good)))
        among = lambda ends: not len(bounds) or (len(ends) and (ends[np.minimum(np.searchsorted(ends, bounds), len(ends) - 1)] == bounds).all())
        apart = among(np.cumsum(self.length_a[a])) and among(np.cumsum(self.length_b[b]))
        if not apart or b"".join(map(self.bytes_a.__getitem__, a.tolist())) != text.encode():
            return segments
        self._add(good, [True] * len(good), a, b, bounds)
        return left

    def places(self, texts: list[str | None]) -> list[list[int]]:
        """Of each text the places of its segments; none for texts without tokens by rule. What was known may be forgotten before."""
        if len(self.known) > KEPT or self.held > CHARACTERS:
            self.forget()
        cuts = []
        for text in texts:
            if not text or MARK in text:
                cuts.append([])
            elif not self.by_segment or _JOINS.search(whole := " " + text):
                cuts.append([" " + text])
            else:
                cuts.append(_SEGMENT.findall(whole))
        new = list({s for c in cuts for s in c if s not in self.known})
        apart = new
        if self.by_segment and self.fast_a:
            plain, apart = [s for s in new if _PLAIN.fullmatch(s)], [s for s in new if not _PLAIN.fullmatch(s)]
            for at in range(0, len(plain), 8192):
                apart += self._learn_together(plain[at : at + 8192])
        for at in range(0, len(apart), 4096):
            self._learn_apart(apart[at : at + 4096])
        out = [list(map(self.known.__getitem__, c)) for c in cuts]
        return out if all(self.ok) else [own if all(map(self.ok.__getitem__, own)) else [] for own in out]


def _bytes_of(token: str) -> bytes:
    return bytes(_LETTER_BYTES[c] for c in token)


_aligners: dict[tuple, Aligner] = {}


def aligner(paths: tuple[str, str], with_groups: bool) -> Aligner:
    key = (*paths, with_groups)
    if key not in _aligners:
        _aligners.clear()  # one at a time
        _aligners[key] = Aligner(*key)
    return _aligners[key]


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def shard_of(pairs: np.ndarray) -> np.ndarray:
    return (mix(pairs.view(U)) >> U(40)).astype(np.int64) % SHARDS


def summed(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order and the sums of their counts."""
    distinct, which = np.unique(pairs, return_inverse=True)
    out = np.zeros(len(distinct), np.int64)
    np.add.at(out, which, counts)
    return distinct, out


def counted(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """part, shard, pairs, counts (int64 bytes): what a task has counted, by shard; some rows per task and shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part = aligner(paths, False), TaskContext.get().partitionId()
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def flush() -> pa.RecordBatch:
            shard = shard_of(pairs)
            order = np.argsort(shard, kind="stable")
            shards, first = np.unique(shard[order], return_index=True)
            split = lambda x: pa.array([y.tobytes() for y in np.split(x[order], first[1:])], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([part] * len(shards), pa.int64()), pa.array(shards), split(pairs), split(counts)], names=["part", "shard", "pairs", "counts"])

        for batch in slices(batches, "text"):
            times = Counter()
            for places in tool.places(batch.column(0).to_pylist()):
                times.update(places)
            weights = np.zeros(len(tool.ok), np.int64)
            weights[list(times)] = list(times.values())
            each = np.repeat(weights, np.diff(tool.first))
            pairs, counts = summed(np.concatenate([pairs, tool.links[each > 0]]), np.concatenate([counts, each[each > 0]]))
            if len(pairs) > COUNTED:
                yield flush()
                pairs, counts = pairs[:0], counts[:0]
        if len(pairs):
            yield flush()

    return docs.select("text").mapInArrow(run, "part long, shard long, pairs binary, counts binary")


class PerfectHash:
    """Minimal and perfect over the keys it is built from. bits: the levels' bits, one after another; first, size: of each level in words of
    64; rank: bits set before each word; rest: keys that no level has taken, in order."""

    def __init__(self, size: np.ndarray, bits: np.ndarray, rest: np.ndarray):
        self.size, self.bits, self.rest = size, bits, rest
        self.first = np.concatenate([[0], np.cumsum(size)])
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(bits).astype(np.int64))])

    @staticmethod
    def _at(keys: np.ndarray, level: int, words: int) -> tuple[np.ndarray, np.ndarray]:
        h = mix(mix(keys.view(U)) + U(level + 1)) >> U(8)
        slot = (h % U(words * 64)).astype(np.int64)
        return slot >> 6, U(1) << (slot & 63).astype(U)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """keys: distinct."""
        size, bits = [], []
        for level in range(LEVELS):
            if not len(keys):
                break
            words = max(1, -(-len(keys) * LOAD // 64))
            word, bit = cls._at(keys, level, words)
            slot = word * 64 + np.bitwise_count(bit - U(1)).astype(np.int64)
            alone = np.bincount(slot, minlength=words * 64)[slot] == 1
            own = np.zeros(words, U)
            np.bitwise_or.at(own, word[alone], bit[alone])
            size.append(words)
            bits.append(own)
            keys = keys[~alone]
        return cls(np.array(size, np.int64), np.concatenate([np.zeros(0, U), *bits]), np.sort(keys))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """0 to n - 1 for the keys it was built from; anything there, or -1, for others."""
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, words in enumerate(self.size.tolist()):
            word, bit = self._at(keys[open_], level, words)
            word += self.first[level]
            hit = (self.bits[word] & bit) != 0
            out[open_[hit]] = self.rank[word[hit]] + np.bitwise_count(self.bits[word[hit]] & (bit[hit] - U(1)))
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            found = self.rest[at] == keys[open_]
            out[open_[found]] = self.rank[-1] + at[found]
        return out

    def packed(self) -> tuple[bytes, bytes, bytes]:
        return self.size.tobytes(), self.bits.tobytes(), self.rest.tobytes()

    @classmethod
    def unpacked(cls, size: bytes, bits: bytes, rest: bytes) -> PerfectHash:
        return cls(np.frombuffer(size, np.int64), np.frombuffer(bits, U), np.frombuffer(rest, np.int64))


HASH = "shard long, n long, size binary, bits binary, rest binary, keys binary"


def _numbers(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64)


def distinct_pairs(partial: DataFrame) -> DataFrame:
    """shard, pairs: distinct ones, first of FAN tasks at a time, up a tree, so that no task meets all tasks' pairs."""

    def merge(key, table):
        return pa.table({"part": [key[1].as_py()], "shard": [key[0].as_py()], "pairs": pa.array([np.unique(_numbers(table.column("pairs"))).tobytes()], pa.binary())})

    parts = partial.agg(F.max("part")).first()[0] or 0
    rows = partial.select("part", "shard", "pairs")
    while True:
        rows = rows.withColumn("part", F.expr(f"part div {FAN}")).groupBy("shard", "part").applyInArrow(merge, "part long, shard long, pairs binary")
        parts //= FAN
        if not parts:
            return rows.select("shard", "pairs")


def hashes(pairs: DataFrame) -> DataFrame:
    """The perfect hash of each shard's pairs, with the keys by slot (see HASH)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(raw, np.int64)
                h = PerfectHash.build(own)
                keys = np.empty(len(own), np.int64)
                keys[h.slots(own)] = own
                data = [pa.array([x], pa.binary()) for x in (*h.packed(), keys.tobytes())]
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([len(own)], pa.int64()), *data], names=[x.split()[0] for x in HASH.split(", ")])

    return pairs.select("shard", "pairs").mapInArrow(run, HASH)


def vectors(partial: DataFrame, functions: DataFrame) -> DataFrame:
    """shard, counts: each shard's dense vector of counts, by slot. The hash is brought to each group of FAN tasks, whose counts it turns into one
    vector; from there on vectors are added."""
    parts = partial.agg(F.max("part")).first()[0] or 0
    schema = "node long, shard long, counts binary"

    def row(key, total: np.ndarray) -> pa.Table:
        return pa.table({"node": [key[1].as_py()], "shard": [key[0].as_py()], "counts": pa.array([total.tobytes()], pa.binary())})

    def dense(key, own, known):
        (h,) = known.to_pylist()
        find, total = PerfectHash.unpacked(h["size"], h["bits"], h["rest"]), np.zeros(h["n"], np.int64)
        np.add.at(total, find.slots(_numbers(own.column("pairs"))), _numbers(own.column("counts")))
        return row(key, total)

    def add(key, table):
        return row(key, np.sum([np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist()], axis=0))

    rows = partial.select("shard", F.expr(f"part div {FAN}").alias("node"), "pairs", "counts")
    # A table of its own, so that no column of it is one of rows' too.
    needed = cut(rows.select("shard", "node").distinct().join(functions, "shard"), "needed")
    summed_up = rows.groupBy("shard", "node").cogroup(needed.groupBy("shard", "node")).applyInArrow(dense, schema)
    parts //= FAN
    while parts:
        summed_up = summed_up.withColumn("node", F.expr(f"node div {FAN}")).groupBy("shard", "node").applyInArrow(add, schema)
        parts //= FAN
    return summed_up.select("shard", "counts")


def counts_table(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """HASH and counts (by slot), a row per shard."""
    partial = cut(counted(docs, paths), "counted")
    functions = cut(hashes(distinct_pairs(partial)), "hashes")
    return cut(functions.join(vectors(partial, functions), "shard"), "counts")


def pair_counts(table: DataFrame) -> DataFrame:
    """a, b, n, best (whether no other A id has more with this B id), a row per distinct pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys, counts = np.frombuffer(keys, np.int64), np.frombuffer(counts, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(counts)], names=["a", "b", "n"])

    rows = table.select("keys", "counts").mapInArrow(run, "a long, b long, n long")
    most = rows.groupBy("b").agg(F.max("n").alias("most"))
    return rows.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


DIGEST = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Lookup:
    """All shards' perfect hashes, keys and counts, as they are sent to the executors."""

    def __init__(self, rows: list[dict]):
        self.shards = {r["shard"]: (PerfectHash.unpacked(r["size"], r["bits"], r["rest"]), np.frombuffer(r["keys"], np.int64), np.frombuffer(r["counts"], np.int64)) for r in rows}
        keys, counts = (np.concatenate([np.zeros(0, np.int64), *(s[k] for s in self.shards.values())]) for k in (1, 2))
        self.b, which = np.unique(keys & 0xFFFFFFFF, return_inverse=True)
        self.most = np.zeros(len(self.b), np.int64)
        np.maximum.at(self.most, which, counts)

    def counts_of(self, pairs: np.ndarray) -> np.ndarray:
        """Counts of the pairs, 0 for those whose slot holds another key."""
        out, shard = np.zeros(len(pairs), np.int64), shard_of(pairs)
        for s in np.unique(shard).tolist():
            if s in self.shards:
                find, keys, counts = self.shards[s]
                at = np.flatnonzero(shard == s)
                slot = find.slots(pairs[at])
                good = (slot >= 0) & (keys[slot] == pairs[at])
                out[at[good]] = counts[slot[good]]
        return out

    def best(self, pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not len(self.b):
            return np.zeros(len(pairs), bool)
        at = np.minimum(np.searchsorted(self.b, pairs & 0xFFFFFFFF), len(self.b) - 1)
        return (self.b[at] == pairs & 0xFFFFFFFF) & (self.most[at] == counts) & (counts > 0)


def _sums(tool: Aligner, places: list[list[int]], by_place: np.ndarray) -> np.ndarray:
    """Sums of the rows of by_place over each text's places."""
    flat = array("q", chain.from_iterable(places))
    each = np.repeat(np.arange(len(places)), [len(p) for p in places])
    out = np.zeros((len(places), by_place.shape[1]), np.int64)
    at = np.frombuffer(flat, np.int64)
    for c in range(by_place.shape[1]):  # exact: sums of integers under 2 ** 53
        out[:, c] = np.bincount(each, weights=by_place[at, c], minlength=len(places)).astype(np.int64) if len(at) else 0
    return out


def _digest(tool: Aligner, places: list[int]) -> str:
    return hashlib.sha256(";".join(map(tool.groups.__getitem__, places)).encode()).hexdigest() if places else ""


def looked_up(docs: DataFrame, table: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """doc_id and DIGEST by the table sent to all executors."""
    sent = docs.sparkSession.sparkContext.broadcast([r.asDict() for r in table.collect()])  # MOST_SENT bytes at most
    kind, job = docs.schema["doc_id"].dataType.simpleString(), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, table = aligner(paths, True), Lookup(sent.value)
        for batch in slices(batches, "text"):
            places = tool.places(batch.column(1).to_pylist())
            if tool.stats_of != job:  # of other counts
                tool.stats, tool.stats_of = tool.stats[:0], job
            done = len(tool.stats)
            if len(tool.ok) > done:
                pairs, n = tool.links[tool.first[done] :], np.diff(tool.first[done:])
                counts = table.counts_of(pairs)
                each, best = np.repeat(np.arange(len(n)), n), table.best(pairs, counts)
                more = np.zeros((len(n), 6), np.int64)
                more[:, :3], more[:, 3] = tool.sizes[done:], n
                more[:, 4] = np.bincount(each[best], minlength=len(n))
                np.add.at(more[:, 5], each, counts)
                tool.stats = np.concatenate([tool.stats, more])
            sums = _sums(tool, places, tool.stats)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(sums[:, c]) for c in range(6)), pa.array([_digest(tool, p) for p in places], pa.string())], names=["doc_id", *(x.split()[0] for x in DIGEST.split(", "))])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {DIGEST}")


def joined(docs: DataFrame, table: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """The same for tables of any size: each document's distinct pairs meet their counts in a join."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(paths, True)
        part, row = TaskContext.get().partitionId() << 40, 0
        for batch in slices(batches, "text"):
            places = tool.places(batch.column(1).to_pylist())
            sums = _sums(tool, places, tool.sizes)
            pairs, times = [], []
            for own in places:
                of = Counter(own)
                links = [tool.links[tool.first[p] : tool.first[p + 1]] for p in of]
                x, n = summed(np.concatenate([np.zeros(0, np.int64), *links]), np.repeat(np.fromiter(of.values(), np.int64, len(of)), [len(y) for y in links]))
                pairs.append(x)
                times.append(n)
            first = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in pairs])]), pa.int32())
            flat, n = np.concatenate([np.zeros(0, np.int64), *pairs]), np.concatenate([np.zeros(0, np.int64), *times])
            lists = [pa.ListArray.from_arrays(first, pa.array(x)) for x in (flat >> 32, flat & 0xFFFFFFFF, n)]
            rows = pa.array(np.arange(row, row + batch.num_rows) + part)
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([rows, batch.column(0), *(pa.array(sums[:, c]) for c in range(3)), pa.array([_digest(tool, p) for p in places], pa.string()), *lists], names=["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "a", "b", "times"])

    schema = f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, a array<long>, b array<long>, times array<long>"
    aligned = cut(docs.select("doc_id", "text").mapInArrow(run, schema), "aligned")
    each = aligned.select("row", F.explode(F.arrays_zip("a", "b", "times")).alias("p")).select("row", "p.*")
    found = each.join(pair_counts(table), ["a", "b"])
    sums = found.groupBy("row").agg(F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    out = aligned.drop("a", "b", "times").join(sums, "row", "left").na.fill(0, ["n_links", "n_best", "count_sum"])
    return out.select("doc_id", *(x.split()[0] for x in DIGEST.split(", ")))


def align(docs: DataFrame, paths: tuple[str, str] | None = None, most_sent: int = MOST_SENT) -> DataFrame:
    """doc_id and DIGEST, a row per row of docs. paths: of a byte-level tokenizer (A) and a piece tokenizer (B)."""
    paths = paths or tokenizer_paths()
    table = counts_table(docs, paths)
    size = table.agg(F.sum(F.octet_length("keys") + F.octet_length("counts") + F.octet_length("bits") + F.octet_length("rest"))).first()[0] or 0
    return looked_up(docs, table, paths) if size <= most_sent else joined(docs, table, paths)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir))
