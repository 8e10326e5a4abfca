"""Packing: tokenise, concatenate all documents and cut the stream at fixed windows.

Two passes. The first tokenises every document once, numbers its tokens within the partition
and writes ids and counts to the shared folder; one row per partition holds the partition's
total. Prefix sums over those totals give each partition's global offset. The second pass adds
the offset and cuts: a document that crosses a window's end gives one piece per window, so a
boundary record is a piece that starts or ends at a multiple of the window.

Cases: a null or empty text gives the end id only; repeated rows (also of one doc_id) are packed
each; a null doc_id is kept; an empty table gives no piece. No order of documents is promised,
but the offsets are fixed once the first pass is written, so reruns of a task agree.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlight.llm.common import cut, documents, slices
from fieldlight.llm.words import words_of

WINDOW = 2048
END_ID = 1
#: Pieces of words whose ids a Python worker keeps, about 0.2 kB each.
CACHED = 400_000
#: Words of these characters are cut into the tokenizer's pieces here; it gets all others whole.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: Byte-level vocabularies write the bytes without a printable Latin-1 character as U+0100 onwards.
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}


#: Texts by which a loaded tokenizer is held against the shortcuts below.
_PROBES = ("It's 12 o'clock, isn't it?", "  two  spaces\tand\nlines ", "ÜBER naïve Café élan", "a_b-c/d.e 3.14 #tag @x", "漢字 \U0001f600 emoji", "THE end...", "don't we'll they're I've I'm he'd", "x" * 40, "<|tag|> ½ ﬁ e\u0301")


class _Ids:
    """Ids of words as little-endian uint32 bytes. White space only separates in the tokenizer these shortcuts are made for, and
    its pieces are coded each for itself, so the ids of a text are those of its words, and those of
    a word are those of its pieces. Each distinct word of a batch is put together once, and each piece
    is coded once for as long as it is kept. A tokenizer that gives other ids for the probes is used as it is, on whole
    texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pieces: dict[str, bytes] = {}
        self.by_words = self._agrees()

    def _agrees(self) -> bool:
        whole = self._whole(list(_PROBES))
        try:
            ids, n = self._by_words(pa.array(_PROBES))
        except Exception:  # a model that cannot code a piece alone  # noqa: BLE001
            return False
        cuts = np.cumsum(n)[:-1]
        return all(np.array_equal(a, b) for a, b in zip(np.split(ids, cuts), whole, strict=True))

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _code(self, piece: str) -> bytes:
        """Ids of one piece, its bytes written as the vocabulary writes them."""
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return array("I", [x.id for x in self.model.tokenize(piece)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if text.isascii() and text.isalpha():
            pieces = (text.lower(),)
        elif _PLAIN.fullmatch(text) and "<|" not in text:
            pieces = _PIECE.findall(text.lower())
        else:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        out = []
        for piece in pieces:
            ids = self.pieces.get(piece)
            if ids is None:
                ids = self.pieces[piece] = self._code(piece)
            out.append(ids)
        return out[0] if len(out) == 1 else b"".join(out)

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each text has."""
        if self.by_words:
            return self._by_words(texts)
        ids = self._whole([x.decode("utf-8", "replace") if isinstance(x, bytes) else x or "" for x in texts.to_pylist()])
        return np.concatenate([np.zeros(0, "<u4"), *ids]), np.array([len(x) for x in ids], np.int64)

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each distinct word is looked up once."""
        w = words_of(texts)
        _, where, which = np.unique(w.hashes(), return_index=True, return_inverse=True)
        if len(self.pieces) > CACHED:
            self.pieces = {}
        data = w.data.tobytes()
        coded = [self._word(data[a:b]) for a, b in zip(w.starts[where].tolist(), w.ends[where].tolist(), strict=True)]
        ids = np.frombuffer(b"".join(coded), "<u4")
        n = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        first = np.cumsum(n) - n
        each = n[which]
        after = np.concatenate([[0], np.cumsum(each)])
        picked = ids[np.repeat(first[which] - after[:-1], each) + np.arange(after[-1])]
        return picked, np.diff(after[w.first])


_ids: dict[str, _Ids] = {}


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, without end ids, and how many each text has."""
    if path not in _ids:
        _ids[path] = _Ids(path)
    return _ids[path].of(texts)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenize(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, part, part_start (ids before it in its partition), doc_tokens, ids (uint16 or
    uint32, see wide). Ids are kept as two bytes where all of a document's ids fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text"):
            all_ids, n = token_ids(batch.column(1), path)
            ends = np.cumsum(n)
            with_end = np.insert(all_ids, ends, np.uint32(END_ID))
            counts = n + 1
            coded = np.split(with_end, np.cumsum(counts)[:-1])
            wide = [bool(x.max() > 0xFFFF) for x in coded]
            ids = [(x if big else x.astype("<u2")).tobytes() for x, big in zip(coded, wide, strict=True)]
            starts = at + np.cumsum(counts) - counts
            at += int(counts.sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([part] * len(ids), pa.int64()), pa.array(starts), pa.array(counts), pa.array(wide), pa.array(ids, pa.binary())], names=["doc_id", "part", "part_start", "doc_tokens", "wide", "ids"])

    schema = "doc_id {}, part long, part_start long, doc_tokens long, wide boolean, ids binary".format(docs.schema["doc_id"].dataType.simpleString())
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (uint32 bytes), doc_tokens, sequence_id, offset."""
    tokens = cut(tokenize(docs, path or tokenizer_path()), "tokens")
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("total"))  # a row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # One row of two numbers per partition of the first pass: some MB for a million partitions.
    placed = tokens.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("part_start")).alias("at"), "doc_tokens", "wide", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {k: [] for k in ("row", "start", "length", "ids", "total", "sequence", "offset")}
            held = 0

            def flush() -> pa.RecordBatch:
                big = [pa.array(cols[k], pa.int64()) for k in ("start", "length", "total", "sequence", "offset")]
                ids = batch.column(0).take(pa.array(cols["row"], pa.int64()))
                return pa.RecordBatch.from_arrays([ids, big[0], big[1], pa.array(cols["ids"], pa.binary()), *big[2:]], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

            for i, (at, total, wide, ids) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(1, 5)), strict=True)):
                x = np.frombuffer(ids, "<u4" if wide else "<u2").astype("<u4")
                start = 0
                while start < total:
                    offset = (at + start) % window
                    n = min(window - offset, total - start)
                    for k, v in zip(cols, (i, start, n, x[start : start + n].tobytes(), total, (at + start) // window, offset), strict=True):
                        cols[k].append(v)
                    start += n
                    held += 4 * n + 80
                if held > 8 << 20:
                    yield flush()
                    cols, held = {k: [] for k in cols}, 0
            if cols["row"]:
                yield flush()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return placed.mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(documents(spark, sf_dir))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
