"""Merkle manifest of a dataset by time-forward processing.

A leaf is the hash of a row. The leaves of a source, in order of doc_id, are the lowest nodes of the source's tree, 16
neighbours to a parent; the sources' roots, in order of source, are the lowest nodes of one more tree. Nodes are labelled
so that children come before parents: by the last leaf a node can cover, then by its height.

1. Leaves are hashed by Spark's own functions, sorted by range and numbered within their tree: places within a
   partition, and prefix sums of the partitions' counts per tree.
2. Time-forward sweep. The external priority queue is Spark's sort by label within shards, aligned subtrees of HEIGHT
   levels: a task reads the digests of its shards in order of label. What falls due within a shard waits in
   a heap, which holds at most 16 digests a level: a node is taken from it once all its children have been read, is hashed
   and sends its digest on. What is due beyond the shard goes into the next sweep, which has 16 ** HEIGHT times fewer rows.
   A sweep keeps each node with its children.
3. Reversed sweep. The nodes come back in reversed order of label, after the proof suffix (the siblings' digests from a
   node up to the root) of their shard's top. A node hands each child the child's siblings and its own suffix; leaves
   turn theirs into their proof.

No task holds more than a shard's open nodes, whatever the size of a source; nothing goes through the driver but the
number of rows and of the largest tree's leaves, which tell how many partitions and sweeps there are.

Cases: nulls of the five columns are hashed as `-`; a null doc_id comes before all others, a null source is a source of its own
and comes first; rows of one doc_id are ordered by their digest, and rows alike in all five columns have proofs of their own
places; other columns, whatever their names, play no part; an empty table gives no row; texts count whole.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlight.llm.common import cut, documents, shards_for

ARITY = 16
#: Levels of a shard, and so 16 ** 3 = 4,096 of its lowest nodes; ten thousand million leaves take three sweeps.
HEIGHT = 3
#: Rows of a partition, about 0.2 kB each.
ROWS = 50_000
#: Columns that a leaf is the hash of, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows with these remainders of their id's crc32 are tampered with.
TAMPER_FOLDS, TAMPER_FOLD = 5, 0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(**values: Column) -> Column:
    """Hash of the fields: `-` for null, else the count of UTF-8 bytes, a colon and the value."""
    coded = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in (values[f] for f in FIELDS)]
    return F.sha2(F.concat(*coded).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """tree (the source as a text that sorts like it, null first), doc_id, digest, altered (digest of the tampered row, null where
    it is left alone)."""
    own = {f: F.col(f) for f in FIELDS}
    altered = leaf(**own | {"text": F.translate("text", _UPPER, _LOWER)})
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_FOLDS == TAMPER_FOLD
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    return docs.select(*FIELDS).select(tree.alias("tree"), "doc_id", leaf(**own).alias("digest"), F.when(hit, altered).alias("altered"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with pos (place in their tree by `order`, from 0 on) and n (rows of the tree). Sorted by range over all
    trees, so that a large tree takes many partitions; the last key tells equal rows apart for the same reason."""
    rows = cut(rows.withColumn("tie", F.monotonically_increasing_id()), "unordered")
    keys = ["tree", *order, "tie"]
    dealt = rows.repartitionByRange(shards_for(rows.count(), ROWS), *keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()  # the partition's number and, in the lower 33 bits, the row's place in it
    dealt = dealt.withColumns({"part": F.shiftright(place, 33), "at": place.bitwiseAND(F.lit((1 << 33) - 1))})
    ordered = cut(dealt.drop("tie"), "ordered")
    spans = ordered.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    # A row per tree and partition that it lies in.
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("rows").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = cut(spans.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("rows").over(tree).alias("n")), "spans")
    return ordered.join(spans, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def height_of(n: int, most: int) -> int:
    """Levels above n nodes in one shard."""
    levels = 0
    while n > 1 and levels < most:
        n, levels = -(-n // ARITY), levels + 1
    return levels


NODES = "tree string, shard long, last long, level int, n long, digest string, top boolean, docs array<{kind}>, digests array<string>, altered array<string>"


def forward(nodes: DataFrame, kind: str) -> DataFrame:
    """nodes: tree, pos, n, digest, doc_id, altered. All inner nodes of their shards with their children (see NODES); a node
    that is alone in its tree is one of level 0. last: the place, within the shard, of the last leaf a node can cover."""
    schema, height = NODES.format(kind=kind), HEIGHT
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue: list = []  # (last leaf, level, place among the siblings, digest, doc_id, altered) of what waits for its parent
        out: list = []
        shard, levels, size = None, 0, 0

        def advance(time: int) -> None:
            """Nodes all of whose leaves come before `time`."""
            while queue and queue[0][0] < time:
                last, level = queue[0][:2]
                children = []
                while queue and queue[0][:2] == (last, level):
                    children.append(heapq.heappop(queue))
                digest = sha("".join(c[3] for c in children)) if level else children[0][3]
                docs, altered = ([c[4] for c in children], [c[5] for c in children]) if level < 2 else (None, None)
                out.append((*shard, last, level, size, digest, level == levels, docs, [c[3] for c in children], altered))
                if level < levels:
                    send(last, level + 1, digest, None, None)

        def send(last: int, level: int, digest: str, doc, altered) -> None:
            """To the parent, which is of this level."""
            width = ARITY**level
            heapq.heappush(queue, ((last // width + 1) * width - 1, level, last, digest, doc, altered))

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
            out.clear()
            return batch

        types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), None, pa.list_(pa.string()), pa.list_(pa.string())]
        for batch in batches:
            types[7] = pa.list_(batch.schema.field("doc_id").type)
            for tree, part, place, n, digest, doc, altered in zip(*(batch.column(c).to_pylist() for c in ("tree", "shard", "place", "n", "digest", "doc_id", "altered")), strict=True):
                if (tree, part) != shard:
                    advance(1 << 62)
                    shard, size, levels = (tree, part), n, height_of(n, height)
                advance(place)
                send(place, min(1, levels), digest, doc, altered)
            if len(out) > 2_000:
                yield flush()
        advance(1 << 62)
        if out:
            yield flush()

    width = ARITY**height
    placed = nodes.select("tree", F.expr(f"pos div {width}").alias("shard"), (F.col("pos") % width).alias("place"), "n", "digest", "doc_id", "altered")
    return placed.repartition("tree", "shard").sortWithinPartitions("tree", "shard", "place").mapInArrow(run, schema)


def backward(nodes: DataFrame, suffixes: DataFrame, kind: str, proofs: bool) -> DataFrame:
    """nodes: what forward() gives; suffixes: tree, shard, lefts, rights (siblings' digests on both sides, level by level from
    the shard's top to the root), subroot, root. Returns the same of the nodes of the sweep before, or, for leaves, doc_id and their
    proof's results."""
    out_schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean" if proofs else "tree string, shard long, lefts array<string>, rights array<string>, subroot string, root string"
    names, below = [x.split()[0] for x in out_schema.split(", ")], ARITY**HEIGHT

    def proven(doc, digest: str, altered: str | None, suffix: tuple | None, subroot: str, root: str) -> tuple:
        parts, folded = [], altered or digest
        while suffix is not None:
            left, right, suffix = suffix
            parts += (left, right)
            folded = sha(left + folded + right) if left is not None else folded
        return doc, digest, subroot, root, sha("".join(p for p in parts if p)), folded, folded == root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue: list = []  # (-last leaf, -level, suffix); a suffix is (left, right, the parent's suffix)
        out: list = []
        shard, ends = None, ("", "")
        types: list = []
        for batch in batches:
            if not types:
                types = [batch.schema.field("docs").type.value_type, *[pa.string()] * 5, pa.bool_()] if proofs else [pa.string(), pa.int64(), *[pa.list_(pa.string())] * 2, pa.string(), pa.string()]
            columns = (batch.column(c).to_pylist() for c in ("tree", "shard", "last", "level", "docs", "digests", "altered", "lefts", "rights", "subroot", "root"))
            for tree, part, last, level, docs, digests, altered, lefts, rights, subroot, root in zip(*columns, strict=True):
                if lefts is not None:  # the suffix of the shard's top comes first
                    shard, ends, suffix = (tree, part), (subroot, root), None
                    for left, right in zip(reversed(lefts), reversed(rights), strict=True):
                        suffix = (left, right, suffix)
                    queue = [(-last, -level, suffix)]
                    continue
                suffix = heapq.heappop(queue)[2]
                width = ARITY ** (level - 1) if level else 1
                first = last + 1 - ARITY**level
                whole = "".join(digests)
                for i, digest in enumerate(digests):
                    # Alone in its tree, a node has no parent below the top.
                    own = (whole[: 64 * i], whole[64 * i + 64 :], suffix) if level else suffix
                    if level > 1:
                        heapq.heappush(queue, (-(first + (i + 1) * width - 1), 1 - level, own))
                    elif proofs:
                        out.append(proven(docs[i], digest, altered[i], own, *ends))
                    else:
                        way, lefts_, rights_ = own, [], []
                        while way is not None:
                            lefts_.append(way[0])
                            rights_.append(way[1])
                            way = way[2]
                        out.append((tree, part * below + first + i, lefts_, rights_, *ends))
            if len(out) > 2_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                out.clear()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    tops = nodes.where("top").select("tree", "shard", "last", "level").join(suffixes, ["tree", "shard"])
    rows = nodes.select("tree", "shard", "last", "level", "docs", "digests", "altered", F.lit(1).alias("turn")).unionByName(tops.withColumn("turn", F.lit(0)), allowMissingColumns=True)
    dealt = rows.repartition("tree", "shard").sortWithinPartitions("tree", "shard", F.desc("last"), F.desc("level"), "turn")
    return dealt.mapInArrow(run, out_schema)


def climb(nodes: DataFrame, kind: str) -> tuple[list[DataFrame], DataFrame]:
    """The sweeps over all trees of the numbered nodes, lowest first, and the trees' roots (tree, digest)."""
    sweeps, roots = [], None
    width = ARITY**HEIGHT
    while True:
        sweeps.append(cut(forward(nodes, kind if not sweeps else "long"), "sweep"))
        tops = sweeps[-1].where("top").select("tree", F.col("shard").alias("pos"), "n", "digest")
        done = tops.where(F.col("n") <= width).select("tree", "digest")
        roots = done if roots is None else roots.unionByName(done)
        more = tops.where(F.col("n") > width)
        if more.isEmpty():
            return sweeps, roots
        none = {"doc_id": F.lit(None).cast("long"), "altered": F.lit(None).cast("string")}
        nodes = more.withColumn("n", F.ceil(F.col("n") / width)).withColumns(none)


def descend(sweeps: list[DataFrame], tops: DataFrame, kind: str, proofs: bool) -> DataFrame:
    """tops: tree, lefts, rights, subroot, root of the trees' roots. What backward() gives for the lowest nodes."""
    suffixes = tops.withColumn("shard", F.lit(0).cast("long"))
    for k in range(len(sweeps) - 1, -1, -1):
        # Trees that ended in this sweep enter here, those that went on come with what the next sweep has given.
        ended = suffixes if k == len(sweeps) - 1 else tops.withColumn("shard", F.lit(0).cast("long")).join(suffixes.select("tree").distinct(), "tree", "left_anti").unionByName(suffixes)
        here = backward(sweeps[k], ended, kind if not k else "long", proofs and not k)
        if not k:
            return here
        suffixes = cut(here, "suffixes")
    raise AssertionError


def manifest(docs: DataFrame) -> DataFrame:
    """A row per row of docs: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    nodes = numbered(leaves(docs), ["doc_id", "digest"])
    sweeps, subroots = climb(nodes, kind)
    subroots = cut(subroots, "subroots")
    none = {"doc_id": F.lit(None).cast("long"), "altered": F.lit(None).cast("string")}
    # The sources' own tree: its lowest nodes are the subroots, in order of source.
    upper = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest").withColumns(none), ["source"])
    upper = cut(upper, "upper")
    above, root = climb(upper, "long")
    start = root.select("tree", F.col("digest").alias("root"), F.lit(None).cast("string").alias("subroot"), F.array().cast("array<string>").alias("lefts"), F.array().cast("array<string>").alias("rights"))
    reached = descend(above, start, "long", False).select(F.col("shard").alias("pos"), "lefts", "rights", "root")
    tops = cut(upper.select(F.col("source").alias("tree"), F.col("digest").alias("subroot"), "pos").join(reached, "pos").drop("pos"), "tops")
    return descend(sweeps, tops, kind, True)


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(documents(spark, sf_dir))
