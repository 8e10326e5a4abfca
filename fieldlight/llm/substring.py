"""Substring dedup: compressed FM-indexes by shard find repeated windows of words.

A window is WINDOW consecutive words of one document; every word goes that a window covers which also
starts in a document of smaller id.

1. Anchors. In each window the ANCHOR-word gram of least hash is its anchor, so equal windows have
   equal anchors wherever they stand. Neighbouring windows with one anchor form a segment, some 20
   windows of 70 words; there is one segment for every 20 words of text. Anchors of a single document
   are dropped: their windows cannot repeat.
2. Segments. Equal segments are one from here on (by a 64-bit hash of their words, among those of one
   anchor, itself a 64-bit hash), with the least id that holds them. Each distinct segment is cut from that document's text.
3. Shards. Segments meet by anchor. A shard builds an FM-index over its segments (a wavelet matrix
   over the Burrows-Wheeler transform), and streams its segments through it by backward search, whose
   matching statistics, cut off at WINDOW, report every place from which WINDOW words occur again, with
   the least id of all occurrences. A shard holds SHARD segments on average, some 70 words each, so an index
   is built from a few MB; many shards share a task one after another, so tasks stay at MOST_TASKS.
4. Each document gathers the intervals of its segments whose least id is smaller than its own, and loses
   the words they cover.

Hot anchors: an anchor with more than HOT distinct segments (a passage that very many documents put in
different surroundings) would make one shard too large. Its segments are cut into their windows, each a segment of its own
with its hash as anchor, so that they spread over all shards. Windows of a single document are dropped as anchors are, and
equal ones are one, so little is left of a passage however many hold it; the indexes decide on them as on all others. That
costs a row per window before equal ones are one, so up to HOT segments, some 6 MB, an anchor stays in one shard.

The bits beside the wavelet matrix (starts, least ids) are plain arrays, so the index is compressed only in part.
Words are compared by 64-bit hashes. Cases: a null or empty text has no words; texts shorter than the
window stay whole; windows within one document, or in rows of equal doc_id, repeat nothing; a null
doc_id counts as the largest, 2**63 - 1; repeated rows get equal results; an empty table gives no row; columns other than
doc_id and text play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlight.llm.common import cut, documents, shards_for, slices
from fieldlight.llm.fmindex import FMIndex
from fieldlight.llm.words import _GOLD, _M1, U, Words, mix, ngrams, words_of

WINDOW, ANCHOR = 50, 8
#: Distinct segments of an anchor beyond which it is hot, and of a shard on average; tasks that shards are dealt to.
HOT, SHARD, MOST_TASKS = 10_000, 6_000, 20_000
_NO_ID = (1 << 63) - 1
#: The inverse of _M1 modulo 2**64.
_M1_INVERSE = U(pow(int(_M1), -1, 1 << 64))


def _powers(base: U, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def range_hashes(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of h[start:end] for each range, from prefix sums of a polynomial."""
    total = np.concatenate([np.zeros(1, U), np.cumsum(mix(h + _GOLD) * _powers(_M1, len(h)))])
    down = _powers(_M1_INVERSE, len(h) + 1)
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U))


def segments(w: Words, h: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window's start among all words, number of windows, anchor hash) of all segments."""
    none = np.zeros(0, np.int64)
    if len(h) < window:
        return none, none, none, np.zeros(0, U)
    g = ngrams(h, anchor)
    width = window - anchor + 1  # grams of a window
    least, have = g, 1
    while have * 2 <= width:
        least, have = np.minimum(least[: len(least) - have], least[have:]), have * 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    counts = w.counts
    of = np.repeat(np.arange(len(counts)), counts)[: len(least)]
    start = np.arange(len(least))
    valid = start + window <= w.first[1:][of]
    start, of, least = start[valid], of[valid], least[valid]
    if not len(start):
        return none, none, none, np.zeros(0, U)
    new = np.ones(len(start), bool)
    new[1:] = (least[1:] != least[:-1]) | (of[1:] != of[:-1])
    begin = np.flatnonzero(new)
    place = np.arange(len(start)) - np.repeat(begin, np.diff(np.append(begin, len(start))))
    begin = np.flatnonzero(new | (place % width == 0))  # long runs of one anchor (repeated words) in parts
    return of[begin], start[begin], np.diff(np.append(begin, len(start))), least[begin]


def anchors(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """key, seg, doc, tid, start, n: a row per segment; start counts the text's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            w = words_of(batch.column("text"))
            h = w.hashes()
            text, start, n, key = segments(w, h, window, anchor)
            seg = range_hashes(h, start, start + n + window - 1)
            local = (start - w.first[text]).astype(np.int32)
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(seg.view(np.int64)), batch.column("doc").take(rows), batch.column("tid").take(rows), pa.array(local), pa.array(n.astype(np.int32))], names=["key", "seg", "doc", "tid", "start", "n"])

    return docs.mapInArrow(run, "key long, seg long, doc long, tid long, start int, n int")


def cut_segments(docs: DataFrame, window: int) -> DataFrame:
    """docs: text, doc, wanted (array of key, seg, start, n). Returns key, seg, doc, words (64-bit hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            w = words_of(batch.column("text"))
            h = w.hashes()
            lists = batch.column("wanted")
            rows = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            flat = lists.flatten()
            key, seg, start, n = (np.array(flat.field(k)) for k in ("key", "seg", "start", "n"))
            begin = w.first[rows] + start
            words = [h[a:b].tobytes() for a, b in zip(begin.tolist(), (begin + n + window - 1).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(seg), batch.column("doc").take(pa.array(rows)), pa.array(words, pa.binary())], names=["key", "seg", "doc", "words"])

    return docs.mapInArrow(run, "key long, seg long, doc long, words binary")


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that come sorted by their shard, a table per shard."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if held and held[-1].column("shard")[0] != batch.column("shard")[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def searched(table: pa.Table, window: int) -> pa.RecordBatch:
    """key, seg, runs of one shard."""
    raw = table.column("words").to_pylist()
    bounds = np.concatenate([[0], np.cumsum([len(x) // 8 for x in raw])])
    symbols = np.unique(np.frombuffer(b"".join(raw), U), return_inverse=True)[1].astype(np.int64)
    index = FMIndex(symbols, bounds, np.array(table.column("doc")), window)
    text, offset, least = index.least_owners(symbols, bounds)
    order = np.lexsort((offset, text))
    text, offset, least = text[order], offset[order], least[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (least[1:] != least[:-1]) | (offset[1:] != offset[:-1] + 1)
    begin = np.flatnonzero(new)
    last = np.append(begin, len(text))[1:] - 1
    runs = pa.StructArray.from_arrays([pa.array(offset[begin].astype(np.int32)), pa.array(offset[last].astype(np.int32)), pa.array(least[begin])], names=["first", "last", "least"])
    cuts = np.searchsorted(text[begin], np.arange(len(raw) + 1)) if len(begin) else np.zeros(len(raw) + 1, np.int64)
    return pa.RecordBatch.from_arrays([table.column("key").combine_chunks(), table.column("seg").combine_chunks(), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), runs)], names=["key", "seg", "runs"])


def search_shards(cut_out: DataFrame, shards: int, window: int) -> DataFrame:
    """key, seg, runs: array of (first, last, least), windows of the segment from first to last, and the least id
    in whose text they occur. Each shard has an index of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_shard(batches):
            yield searched(table, window)

    tasks = min(shards, MOST_TASKS)
    dealt = cut_out.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")).repartitionById(tasks, (F.col("shard") % tasks).cast("int")).sortWithinPartitions("shard")
    return dealt.mapInArrow(run, "key long, seg long, runs array<struct<first:int,last:int,least:long>>")


def anchor_windows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """anchor, doc, tid, start, keys, segs: the rows of anchors() with two hashes of each of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            w = words_of(batch.column("text"))
            h = w.hashes()
            text, start, n, key = segments(w, h, window, anchor)
            begin = np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
            lists = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            hashes = [pa.ListArray.from_arrays(lists, pa.array(range_hashes(x, begin, begin + window).view(np.int64))) for x in (mix(h + _M1), h)]
            rows, local = pa.array(text), pa.array((start - w.first[text]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column("doc").take(rows), batch.column("tid").take(rows), local, *hashes], names=["anchor", "doc", "tid", "start", "keys", "segs"])

    return docs.mapInArrow(run, "anchor long, doc long, tid long, start int, keys array<long>, segs array<long>")


def hot_windows(docs: DataFrame, hot_keys: DataFrame, window: int, anchor: int) -> DataFrame:
    """The windows of hot anchors that two documents hold at least, as rows of segments of one window. Texts are read
    again, not shuffled: the hot anchors are few, so Spark broadcasts them by the size of their table."""
    hot = anchor_windows(docs, window, anchor).join(hot_keys.withColumnRenamed("key", "anchor"), "anchor", "left_semi")
    each = hot.select("doc", "tid", "start", F.posexplode(F.arrays_zip("keys", "segs")).alias("at", "h"))
    each = cut(each.select(F.col("h.keys").alias("key"), F.col("h.segs").alias("seg"), "doc", "tid", (F.col("start") + F.col("at")).alias("start"), F.lit(1).alias("n")), "hot-windows")
    again = each.groupBy("key", "seg").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("key", "seg")
    return each.join(cut(again, "hot-repeated"), ["key", "seg"])


def without(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text, gone (array of word ranges a, b). Returns doc_id, n_words, n_removed, kept, spans (merged)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            counts, removed, kept, spans = [], [], [], []
            for text, gone in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("gone").to_pylist(), strict=True):
                words = (text or b"").split()
                merged: list[list[int]] = []
                for a, b in sorted((x["a"], x["b"]) for x in gone or []):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                counts.append(len(words))
                removed.append(sum(b - a for a, b in merged))
                for a, b in reversed(merged):
                    del words[a:b]
                kept.append(b" ".join(words))
                spans.append([{"a": a, "b": b} for a, b in merged])
            kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(spans, kind)], names=["doc_id", "n_words", "n_removed", "kept", "spans"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, kept string, spans array<struct<a:int,b:int>>")


def dedup(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by a space), spans (word ranges removed)."""
    kind = docs.schema["doc_id"].dataType
    rows = docs.select("text", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"), F.xxhash64("text").alias("tid"))
    all_anchors = cut(anchors(rows, window, anchor), "anchors")
    # Anchors that stand in two documents at least; combined before the shuffle.
    repeated = all_anchors.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("key")
    repeated = cut(repeated, "repeated")  # as a table, so that Spark can split a hot anchor's partition in the join
    shared = cut(all_anchors.join(repeated, "key"), "shared")
    first = lambda t: t.groupBy("key", "seg").agg(F.min(F.struct("doc", "tid", "start", "n")).alias("r"))
    distinct = cut(first(shared), "distinct")
    hot_keys = cut(distinct.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > hot).select("key"), "hot")
    if not hot_keys.isEmpty():
        windows = cut(hot_windows(rows, hot_keys, window, anchor), "hot")
        shared = shared.join(hot_keys, "key", "left_anti").unionByName(windows)
        distinct = distinct.join(hot_keys, "key", "left_anti").unionByName(first(windows))
    reps = distinct.select("key", "seg", "r.*").groupBy("doc", "tid").agg(F.collect_list(F.struct("key", "seg", "start", "n")).alias("wanted"))  # bounded by the document
    # From here on one plan: the texts are shuffled by (doc, tid) once, for all joins with them.
    cut_out = cut_segments(rows.join(reps, ["doc", "tid"]).dropDuplicates(["doc", "tid"]).select("text", "doc", "wanted"), window)
    runs = search_shards(cut_out, shards_for(distinct.count(), shard), window)
    again = shared.join(runs, ["key", "seg"])
    covered: Column = F.transform(F.filter("runs", lambda x: x["least"] < F.col("doc")), lambda x: F.struct((F.col("start") + x["first"]).alias("a"), (F.col("start") + x["last"] + window).alias("b")))
    gone = again.select("doc", "tid", covered.alias("gone")).where(F.size("gone") > 0)
    # As a set, so that rows of one id and text, however many, give each interval once.
    per_doc = gone.groupBy("doc", "tid").agg(F.flatten(F.collect_set("gone")).alias("gone"))
    ids = F.when(F.col("doc") != _NO_ID, F.col("doc")).cast(kind).alias("doc_id")
    return without(rows.join(per_doc, ["doc", "tid"], "left").select(ids, "text", "gone"))


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup(documents(spark, sf_dir))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
