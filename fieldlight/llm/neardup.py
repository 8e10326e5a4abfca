"""MinHash near-duplicates with sequential Bayesian verification.

1. Each text becomes its set of five-word shingles (64-bit hashes) in a vectorised pass, with HASHES
   MinHash values of it. Texts of equal sets are one node from here on, so thousands of exact copies are one row.
2. Bands of the signature make buckets. The bucket graph (each member with the bucket's least member)
   is closed into candidate groups.
3. Groups are verified in units of bounded size, in two rounds.
   - A small group is one unit. A larger one is dealt into blocks by size class (sets of similar texts are of the
     same class or of neighbouring ones); each block is a unit together with the first block of its class, the pilot, and
     each pilot with that of the class below. So near copies of one text, however many, are linked through pilots in
     linear work.
   - Only large groups go on. What the first round has linked with a group's largest component needs no more
     comparison with it; every other member is compared with all members of near classes that it is not yet
     linked with, block by block.
   - A group of more than GIANT members is taken bucket by bucket after its first round, which links one family of near
     copies whatever its size: of its buckets only those that hold several components go through both rounds.
   Within a unit a member at a time is compared with all that it is not yet connected with, signatures batch by batch:
   after each batch a pair is given up once the posterior probability of its similarity reaching the threshold is
   below MISS; survivors are verified exactly on their full sets. A unit returns the links of a spanning forest, so
   never more rows than members.
4. Components of the verified links are the classes.

Cost: a member is copied into its own unit and, if it is of a pilot, into its class' units; in the second round
members are copied once per block of unlinked ones. So the work grows with members x unlinked members of a
group; it is quadratic only where very many texts share buckets of one size class without being linked.

Chosen miss probabilities: banding misses a pair at the threshold with at most MISS_BANDS, pruning with
at most MISS a batch. Survivors are verified exactly, so no false link is made.

Cases: a null text, or one without words, has an empty set and is linked with nothing; with fewer words
than a shingle, the whole sequence is one shingle; repeated rows are alike. Rows of one doc_id with different texts
are one document with several sets: it is linked by any of them, and all its rows have one component. A null doc_id is
returned with null component and is kept, linked with nothing; an empty table gives no row; texts count whole; columns
other than doc_id and text play no part, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlight.llm.common import cut, documents, slices
from fieldlight.llm.components import components
from fieldlight.llm.words import _GOLD, U, mix, ngrams, words_of

WORDS, THRESHOLD, HASHES = 5, 0.85, 128
MISS_BANDS, MISS = 1e-6, 1e-4
#: Signature values compared in one batch.
BATCH = 16
#: Members, and shingles, of a block of the first round; so many times more of one of the second.
BLOCK, BLOCK_SHINGLES, MORE = 128, 200_000, 4
#: Members of a group beyond which it is taken bucket by bucket after the first round.
GIANT = 16_384
#: Blocks that a pilot is copied to in one step.
SPAN = 4_096


def bands(threshold: float, hashes: int = HASHES, miss: float = MISS_BANDS) -> tuple[int, int]:
    """(bands, rows): the longest rows whose bands miss a pair at the threshold with at most `miss`."""
    for rows in range(hashes, 0, -1):
        n = math.ceil(math.log(miss) / math.log1p(-(threshold**rows)))
        if n * rows <= hashes:
            return n, rows
    return hashes, 1


@lru_cache(8)
def least_matches(threshold: float, hashes: int = HASHES, batch: int = BATCH, miss: float = MISS) -> np.ndarray:
    """After batch, 2 * batch, ... compared values: the least number of agreements with which the posterior
    probability (uniform prior) of similarity >= threshold is not below `miss`."""
    grid = (np.arange(2000) + 0.5) / 2000
    out = []
    for n in range(batch, hashes + 1, batch):
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            mass = np.exp(log - log.max())
            if mass[grid >= threshold].sum() >= miss * mass.sum():
                out.append(m)
                break
    return np.array(out)


@lru_cache(2)
def _salts(hashes: int) -> np.ndarray:
    return mix(np.arange(1, hashes + 1, dtype=U) * _GOLD)


def shingle_sets(column: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one text after another, and the n+1 offsets."""
    w = words_of(column, lower=True)
    h, counts, texts = w.hashes(), w.counts, len(w.first) - 1
    grams = np.concatenate([ngrams(h, n), np.zeros(min(n - 1, len(h)), U)])
    of = np.repeat(np.arange(texts), counts)
    place = np.arange(len(h)) - w.first[:-1][of] if len(h) else np.zeros(0, np.int64)
    keep = place + n <= counts[of] if len(h) else np.zeros(0, bool)
    few = np.flatnonzero((counts > 0) & (counts < n))
    for i in few:  # all words as one shingle, told apart by their number
        a, b = w.first[i], w.first[i + 1]
        grams[a] = mix(ngrams(h[a:b], b - a) + U(b - a))[0]
        keep[a] = True
    grams, of = grams[keep], of[keep]
    order = np.lexsort((grams, of))
    grams, of = grams[order], of[order]
    if len(grams):
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])
        grams, of = grams[new], of[new]
    return grams, np.searchsorted(of, np.arange(texts + 1))


def signatures(sets: np.ndarray, offsets: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    """uint32 MinHash values, a row per set; empty sets get zeros."""
    full = np.flatnonzero(np.diff(offsets))
    out = np.zeros((len(offsets) - 1, hashes), np.uint32)
    if not len(full):
        return out
    salts = _salts(hashes)
    starts = offsets[:-1][full]
    step = 1 << 15  # sets in pieces that stay in the cache
    at = 0
    while at < len(full):
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + step)))
        a, b = starts[at], offsets[full[end - 1] + 1]
        x = sets[a:b]
        low, local = (x & U(0xFFFFFFFF)).astype(np.uint32), starts[at:end] - a
        for k in range(hashes):
            mult, add = np.uint32(int(salts[k]) & 0xFFFFFFFF | 1), np.uint32(int(salts[k]) >> 32)
            y = low * mult
            y ^= y >> np.uint32(15)
            y *= add | np.uint32(1)
            out[full[at:end], k] = np.minimum.reduceat(y, local)
        at = end
    return out


def _described(batch: pa.RecordBatch, hashes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[pa.Array]]:
    """Sets, offsets, signatures, and the columns n, set_a, set_b."""
    sets, offsets = shingle_sets(batch.column("text"))
    sums = []
    for salt in (U(0), _GOLD):
        total = np.concatenate([np.zeros(1, U), np.cumsum(mix(sets + salt))])
        sums.append(pa.array((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64)))
    return sets, offsets, signatures(sets, offsets, hashes), [pa.array(np.diff(offsets), pa.int64()), *sums]


def describe(docs: DataFrame, n_bands: int, rows: int, hashes: int = HASHES) -> DataFrame:
    """doc_id, n, set_a, set_b (128 bits that stand for the set), keys (of the signature's bands)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            _, _, sig, columns = _described(batch, hashes)
            key = np.zeros((len(sig), n_bands), U)
            for r in range(rows):
                key = mix(key + sig[:, r : n_bands * rows : rows].astype(U) + _GOLD)
            key = mix(key + np.arange(n_bands, dtype=U))
            keys = pa.ListArray.from_arrays(pa.array(np.arange(len(sig) + 1) * n_bands, pa.int32()), pa.array(key.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, keys], names=["doc_id", "n", "set_a", "set_b", "keys"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, set_a long, set_b long, keys array<long>")


def with_sets(candidates: DataFrame, hashes: int = HASHES) -> DataFrame:
    """candidates: text, node, group, set_a, set_b. Returns node, group, n, sig (uint32 bytes), shingles (uint64
    bytes) of the rows whose text has that set. Repeated rows give it again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            sets, offsets, sig, (n, set_a, set_b) = _described(batch, hashes)
            data = [sets[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            out = pa.RecordBatch.from_arrays([batch.column("node"), batch.column("group"), n, pa.array([x.tobytes() for x in sig], pa.binary()), pa.array(data, pa.binary())], names=["node", "group", "n", "sig", "shingles"])
            yield out.filter(pc.and_(pc.equal(set_a, batch.column("set_a")), pc.equal(set_b, batch.column("set_b"))))

    return candidates.select("text", "node", "group", "set_a", "set_b").mapInArrow(run, "node long, group long, n long, sig binary, shingles binary")


def in_classes(places: DataFrame, threshold: float) -> DataFrame:
    """places: group, node, n. Adds class: a pair at the threshold is of one class or of neighbouring ones, since its sizes
    differ by the threshold at most."""
    return places.withColumn("class", F.floor(F.log("n") / -math.log(threshold) + 1e-9).cast("int"))


def _blocks(counted: DataFrame, times: int = 1) -> DataFrame:
    """counted: m, total. blocks of `times` the usual size in their place."""
    return counted.withColumn("blocks", F.greatest(F.ceil(F.col("m") / (times * BLOCK)), F.ceil(F.col("total") / (times * BLOCK_SHINGLES))).cast("int")).drop("m", "total")


def sizes(places: DataFrame, *by: str) -> DataFrame:
    return places.groupBy(*by).agg(F.count("*").alias("m"), F.sum("n").alias("total"))


def dealt(places: DataFrame, blocks: DataFrame, salt: int) -> DataFrame:
    """places with blocks (of their group and class) and block, by a hash of the node."""
    return places.join(blocks, ["group", "class"]).withColumn("block", F.pmod(F.xxhash64("node", F.lit(salt)), "blocks").cast("int"))


def first_units(small: DataFrame, large: DataFrame, blocks: DataFrame) -> DataFrame:
    """unit (four numbers), side, node, component. Both have group, node, component. Pairs count within side 0 and across
    sides."""
    whole = small.select(F.struct("group", F.lit(-1).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("c")).alias("unit"), F.lit(0).alias("side"), "node", "component")
    rows = dealt(large, blocks, 1)
    unit = lambda c, b: F.struct("group", c.alias("a"), b.alias("b"), F.lit(0).alias("c")).alias("unit")
    own = rows.select(unit(F.col("class"), F.col("block")), F.lit(0).alias("side"), "node", "component")
    pilots = rows.where("block = 0").select("group", "class", "node", "component", "blocks")
    # A pilot goes to all blocks of its class; by two steps, so that no row holds an array of the size of a group.
    spans = pilots.withColumn("span", F.explode(F.sequence(F.lit(0), F.expr(f"blocks div {SPAN}"))))
    low, high = F.greatest(F.col("span") * SPAN, F.lit(1)), F.least(F.col("span") * SPAN + SPAN, F.col("blocks")) - 1
    others = spans.where(low <= high).withColumn("block", F.explode(F.sequence(low, high)))
    to = [others.select(unit(F.col("class"), F.col("block")), F.lit(1).alias("side"), "node", "component")]
    to += [pilots.select(unit(F.col("class") + 1, F.lit(0)), F.lit(1).alias("side"), "node", "component")]
    return whole.unionByName(own).unionByName(to[0]).unionByName(to[1])


def second_units(large: DataFrame) -> DataFrame:
    """large: group, class, node, n, component (as far as it is known). The same columns as first_units; pairs count
    across sides. Side 0: members outside their group's largest component; sides 1 and 2: all members of near classes,
    inside and outside it."""
    members = large.groupBy("group", "component").agg(F.count("*").alias("m"))
    giant = members.groupBy("group").agg(F.max_by("component", F.struct("m", "component")).alias("giant"))
    marked = large.join(giant, "group").withColumn("outside", F.col("component") != F.col("giant"))
    marked = cut(marked.drop("giant"), "marked")
    outside = marked.where("outside")
    of = lambda t: _blocks(sizes(t, "group", "class"), MORE)  # noqa: E731  a row per group and class
    all_blocks, out_blocks = cut(of(marked), "blocks"), cut(of(outside), "blocks")
    here = lambda t: t.select("group", F.col("class").alias("near"), F.col("blocks").alias("others"))
    near = F.abs(F.col("near") - F.col("class")) <= 1
    unit = lambda *k: F.struct("group", *(F.col(c).alias(a) for c, a in zip(k, "abc", strict=True)), F.col("d")).alias("unit")
    first = dealt(outside, out_blocks, 2).join(here(all_blocks), "group").where(near).withColumn("d", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    second = dealt(marked, all_blocks, 3).join(here(out_blocks), "group").where(near).withColumn("d", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    return first.select(unit("class", "block", "near"), F.lit(0).alias("side"), "node", "component").unionByName(
        second.select(F.struct("group", F.col("near").alias("a"), F.col("d").alias("b"), F.col("class").alias("c"), F.col("block").alias("d")).alias("unit"), F.when(F.col("outside"), 2).otherwise(1).alias("side"), "node", "component")
    )


def shared_with(i: int, others: np.ndarray, ranks: np.ndarray, bounds: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of set i with others. Set k is ranks[bounds[k] : bounds[k + 1]]; seen: False for every rank."""
    own = ranks[bounds[i] : bounds[i + 1]]
    seen[own] = True
    lengths = bounds[others + 1] - bounds[others]
    ends, out, at = np.cumsum(lengths), np.zeros(len(others), np.int64), 0
    while at < len(others):  # a bounded number of shingles at once, a set at least
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20), "right")))
        n = lengths[at:end]
        first = np.cumsum(n) - n
        places = np.repeat(bounds[others[at:end]] - first, n) + np.arange(n.sum())
        out[at:end] = np.add.reduceat(seen[ranks[places]].astype(np.int64), first)
        at = end
    seen[own] = False
    return out


def verify_unit(side: np.ndarray, component: np.ndarray, sig: np.ndarray, sets: list[np.ndarray], threshold: float, within: bool = True) -> tuple[list[int], int, int]:
    """Links of a spanning forest of the verified pairs, as places (a, b, a, b, ...); pairs whose signatures were compared;
    pairs verified. Pairs count between side 0 and the others, and within side 0 if `within`; not those of one component,
    as it is known by then: a member that is linked with many spares all comparisons among them.
    Those with side 2 stand in two units, so only the one counts whose first place is the lower."""
    n = np.array([len(s) for s in sets])
    need = least_matches(threshold, sig.shape[1])
    label = np.unique(component, return_inverse=True)[1]
    ranks, bounds, seen = None, np.concatenate([[0], np.cumsum(n)]), None
    out, compared, checked = [], 0, 0
    order = np.argsort(side, kind="stable")  # side 0 first
    first = int((side == 0).sum())
    for k in range(first):
        i = order[k]
        j = order[k + 1 if within else first :]
        small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        j = j[(small >= threshold * large - 1e-9) & (label[j] != label[i]) & ((side[j] < 2) | (j > i))]
        compared += len(j)
        m = np.zeros(len(j), np.int64)
        for b, least in enumerate(need):
            if not len(j):
                break
            part = slice(b * BATCH, (b + 1) * BATCH)
            m = m + (sig[j, part] == sig[i, part]).sum(axis=1)
            j, m = j[m >= least], m[m >= least]
        if not len(j):
            continue
        if ranks is None:
            distinct, ranks = np.unique(np.concatenate(sets), return_inverse=True)
            seen = np.zeros(len(distinct), bool)
        both = shared_with(i, j, ranks, bounds, seen)
        checked += len(j)
        for x in j[both >= threshold * (n[i] + n[j] - both) - 1e-9].tolist():
            if label[x] != label[i]:
                label[label == label[x]] = label[i]
                out += [int(i), x]
    return out, compared, checked


def verified(units: DataFrame, held: DataFrame, threshold: float, within: bool, verify: Callable = verify_unit) -> DataFrame:
    """Links (a, b) of all units, as `verify` finds them."""

    def run(table: pa.Table) -> pa.Table:
        # A node stands once on a side; on side 0 if it is on both, as the unit is then its own.
        side, node = np.array(table.column("side")), np.array(table.column("node"))
        order = np.lexsort((side, node))
        at = order[np.concatenate([[True], (node[order][1:] != node[order][:-1]) | (side[order][1:] != side[order][:-1])])]
        node, side, component = node[at], side[at], np.array(table.column("component"))[at]
        raw, packed = table.column("shingles").to_pylist(), table.column("sig").to_pylist()
        sig = np.frombuffer(b"".join(packed[i] for i in at), np.uint32).reshape(len(node), -1)
        pairs, _, _ = verify(side, component, sig, [np.frombuffer(raw[i], U) for i in at], threshold, within)
        return pa.table({"a": pa.array(node[pairs[::2]], pa.int64()), "b": pa.array(node[pairs[1::2]], pa.int64())})

    rows = units.join(held.select("node", "sig", "shingles"), "node").select("unit.*", "side", "node", "component", "sig", "shingles")
    return rows.groupBy(*units.schema["unit"].dataType.names).applyInArrow(run, "a long, b long")


def with_components(places: DataFrame, known: DataFrame | None) -> DataFrame:
    if known is None:
        return places.withColumn("component", F.col("node"))
    return places.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))


def first_round(places: DataFrame, held: DataFrame, threshold: float, verify: Callable = verify_unit) -> tuple[DataFrame, DataFrame | None]:
    """places: group, node, n, component. (links; the places of large groups with their class, if there are any)."""
    big = (F.col("m") > BLOCK) | (F.col("total") > BLOCK_SHINGLES)
    large_groups = cut(sizes(places, "group").where(big).select("group"), "large")
    if large_groups.isEmpty():
        whole = places.select(F.struct("group").alias("unit"), F.lit(0).alias("side"), "node", "component")
        return cut(verified(whole, held, threshold, True, verify), "verified"), None
    large = cut(in_classes(places.join(large_groups, "group"), threshold), "large-places")
    blocks = cut(_blocks(sizes(large, "group", "class")), "blocks")
    units = first_units(places.join(large_groups, "group", "left_anti"), large, blocks)
    return cut(verified(units, held, threshold, True, verify), "verified"), large.drop("component")


def linked(light: DataFrame, shared: DataFrame, held: DataFrame, threshold: float, verify: Callable = verify_unit) -> tuple[DataFrame, DataFrame | None]:
    """light: node, group, n; shared: node, key (of its buckets with others). (links a, b of all rounds; their components,
    if they are known)."""
    links, large = first_round(with_components(light, None), held, threshold, verify)
    if large is None:
        return links, None
    known = components(links)
    giants = cut(light.groupBy("group").agg(F.count("*").alias("m")).where(F.col("m") > GIANT).select("group"), "giants")
    if not giants.isEmpty():
        members = with_components(light.join(giants, "group", "left_semi").select("node", "n"), known)
        places = cut(shared.select("node", "key").distinct().join(members, "node").select("node", F.col("key").alias("group"), "n", "component"), "places")
        # A bucket of one component needs no more comparison.
        open_ones = cut(places.groupBy("group").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("group"), "open")
        large = large.join(giants, "group", "left_anti")
        if not open_ones.isEmpty():
            more, by_bucket = first_round(places.join(open_ones, "group", "left_semi"), held, threshold, verify)
            links = links.unionByName(more)
            large = large if by_bucket is None else large.unionByName(by_bucket)
            known = components(links)
    rest = cut(verified(second_units(with_components(large, known)), held, threshold, False, verify), "verified-rest")
    return (links, known) if rest.isEmpty() else (links.unionByName(rest), None)


def nodes_of(described: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(member: doc_id, node, a row per document and set; nodes: node, doc_id (one that has the set), set_a, set_b;
    links between the nodes of one document, if any has several). A set's node is the least doc_id whose largest set it
    is; a set that is nobody's largest has a number made of its hash."""
    key = ["n", "set_a", "set_b"]
    known = cut(described.where("n > 0 and doc_id is not null").select("doc_id", *key).distinct(), "known")
    largest = cut(known.groupBy("doc_id").agg(F.max(F.struct(*key)).alias("s")).select("doc_id", "s.*"), "largest")
    # Written tables on both sides of a join let Spark split the partition of a hot set or bucket.
    by_set = cut(largest.groupBy(*key).agg(F.min("doc_id").alias("node")), "by_set")
    member = cut(largest.join(by_set, key).select("doc_id", "node", "set_a", "set_b"), "members")
    nodes = member.where("doc_id = node").select("node", "doc_id", "set_a", "set_b")
    others = known.join(largest, ["doc_id", *key], "left_anti")
    if others.isEmpty():
        return member.select("doc_id", "node"), nodes, None
    others = cut(others.join(by_set, key, "left").withColumn("own", F.col("node").isNull()).withColumn("node", F.coalesce("node", F.xxhash64(*key))), "others")
    more = others.where("own").groupBy("node", "set_a", "set_b").agg(F.min("doc_id").alias("doc_id"))
    main = member.select("doc_id", F.col("node").alias("a"))
    within = others.select("doc_id", F.col("node").alias("b")).join(main, "doc_id").select("a", "b")
    return member.select("doc_id", "node"), nodes.unionByName(more), within


def classes(docs: DataFrame, threshold: float = THRESHOLD, hashes: int = HASHES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, a row per row of docs."""
    n_bands, rows = bands(threshold, hashes)
    return resolved(docs, describe(docs, n_bands, rows, hashes), lambda t: with_sets(t, hashes), threshold, verify_unit)


def resolved(docs: DataFrame, described: DataFrame, sets_of: Callable, threshold: float, verify: Callable) -> DataFrame:
    """The same for any description of docs (doc_id, n, set_a, set_b, keys) in which linked sets share a key; sets_of gives the
    candidates' sets as with_sets() does."""
    described = cut(described, "described")
    member, nodes, within = nodes_of(described)
    entries = described.join(nodes, ["doc_id", "set_a", "set_b"]).select(F.explode("keys").alias("key"), "node")
    entries = cut(entries, "entries")
    first = entries.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last").select("key", "first")
    first = cut(first, "first")
    shared = cut(entries.join(first, "key"), "buckets")
    groups = components(shared.select(F.col("first").alias("a"), F.col("node").alias("b"))).withColumnRenamed("component", "group")
    placed = groups.join(nodes, "node")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(placed, "doc_id")
    held = cut(sets_of(texts), "candidates")
    light = cut(held.select("node", "group", "n").distinct(), "light")
    links, found = linked(light, shared, held, threshold, verify)
    if within is not None:
        links, found = links.unionByName(within), None
    found = components(links) if found is None else found
    placed = member.join(found, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component"))
    if within is not None:  # a set's number need not be a doc_id then
        least = placed.groupBy("component").agg(F.min("doc_id").alias("least"))
        placed = placed.join(least, "component").select("doc_id", F.col("least").alias("component"))
    out = described.select("doc_id", F.col("n").alias("n_shingles")).join(placed.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id"), "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(documents(spark, sf_dir))
