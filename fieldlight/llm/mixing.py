"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies, target / source size. The
whole part is certain; the fractional part is rounded by pivots: two documents exchange word
mass (probability times size) until one's probability is 0 or 1, with chances that keep both
expectations. The mass of a source is thereby kept exactly, and only the last document of a
source is rounded alone, so a source misses its target by less than one document. Large documents
go first, so that the many small ones after them settle them, and a small one is mostly left.

The exchanges form a reduction tree. Leaves are groups of documents of one source by the hash of
their ids; each leaves at most one document open. The open ones meet in groups of FAN on the next
level, until one per source is left. A hot source is thus many leaves, no task sees more than
some thousand documents of one group, and each level is one shuffle of the open documents.

Cases: a null text has size 0; a null source is a source of its own, last; documents of size 0
and sources of size 0 get 0 words; repeated rows and repeated or null doc_ids are rounded each
for itself; an empty table gives no row; columns other than doc_id, text and source are carried along, whatever their
names. Rows alike in doc_id, source and text are told apart by a number within their group, counted by partition first, so
that no task holds such a group, however large. The draws are hashes of ids and seed, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlight.llm.common import WORD, cut, documents, with_fields

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2.0
#: Documents in a leaf, and open documents that meet on the next level.
LEAF, FAN = 2048, 64


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(df: DataFrame, column: str) -> DataFrame:
    """df with rank, from 0 by column (text by code point), nulls last: ranges are sorted apart, and
    a prefix sum over one count per range gives where each starts."""
    byte = F.col(column).cast("string").cast("binary")
    ranged = df.repartitionByRange(byte.isNull(), byte).withColumn("_part", F.spark_partition_id())
    ranged = cut(ranged, "ranges")
    counts = ranged.groupBy("_part").count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(F.col(column).cast("string").cast("binary").asc_nulls_last())) - 1
    return ranged.withColumn("_own", own).join(bases, "_part").withColumn("rank", F.col("_base") + F.col("_own")).drop("_part", "_base", "_own")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """sizes: source, source_size, a row per source. Adds target: weight times a level, at most
    `most` times the size; where that cap binds, the excess goes to the others by weight. Each round
    sends only three sums to the driver; sources never do."""
    weight = F.lit(weights[-1])
    for i, w in enumerate(weights[:-1]):
        weight = F.when(F.col("rank") % len(weights) == i, F.lit(w)).otherwise(weight)
    table = cut(numbered(sizes, "source").withColumn("weight", weight), "sources")
    cap = F.lit(most) * F.col("source_size")
    level, total = None, None
    while True:
        capped = F.lit(False) if level is None else F.col("weight") * level > cap
        row = table.agg(F.sum("source_size").alias("size"), F.sum(F.when(capped, cap)).alias("full"), F.sum(F.when(~capped, F.col("weight"))).alias("open"), F.count(F.when(capped, 1)).alias("n")).first()
        if total is None:
            total = share * (row["size"] or 0)
        if level is not None and row["n"] == n_capped or not row["open"]:
            break
        n_capped, level = row["n"], F.lit(max(0.0, total - (row["full"] or 0.0)) / row["open"])
    target = F.least(F.col("weight") * (level if level is not None else F.lit(0.0)), cap)
    return table.select("source", "source_size", target.alias("target"))


def _draws(key: np.ndarray, step: int) -> np.ndarray:
    """Uniform in (0, 1) from 64-bit keys."""
    x = key.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(step + 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53


def pivot(mass: np.ndarray, p: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, int]:
    """Pivotal rounding of probabilities p of items with the given masses. Returns p, 0 or 1 except for
    one item at most, and that item's place or -1. sum(mass * p) stays, up to rounding errors."""
    p, open_at = p.copy(), -1
    for i in range(len(p)):
        if p[i] <= 0.0 or p[i] >= 1.0:
            continue
        if open_at < 0:
            open_at = i
            continue
        j = open_at
        a, b = mass[i], mass[j]
        up = min((1 - p[i]) * a, p[j] * b)  # mass that may go from j to i
        down = min(p[i] * a, (1 - p[j]) * b)
        if u[i] * (up + down) < down:
            full, p[i], p[j] = up, p[i] + up / a, p[j] - up / b
        else:
            full, p[i], p[j] = down, p[i] - down / a, p[j] + down / b
        for k in (i, j):
            p[k] = 0.0 if p[k] < 1e-12 else 1.0 if p[k] > 1 - 1e-12 else p[k]
        open_at = j if 0.0 < p[j] < 1.0 else i if 0.0 < p[i] < 1.0 else -1
    return p, open_at


def told_apart(rows: DataFrame, *key: str) -> DataFrame:
    """rows with row, a number from 1 among the rows alike in the key columns (nulls are equal). Numbers run within each partition
    that the rows were written in, and start after the counts of the partitions before."""
    rows = cut(rows.withColumn("_part", F.spark_partition_id()), "rows")
    own = F.row_number().over(Window.partitionBy(*key, "_part").orderBy(F.lit(0)))
    counts = rows.groupBy(*key, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # A row per key and partition; only keys in several partitions have any that start later.
    later = counts.withColumn("_before", F.sum("_n").over(before)).where(F.col("_before").isNotNull())
    later = cut(later.select(F.struct(*key).alias("_key"), F.col("_part").alias("_p"), "_before"), "later")
    numbered_rows = rows.withColumn("_own", own)
    joined = numbered_rows.join(later, F.struct(*key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_p")), "left")
    return joined.withColumn("row", (F.col("_own") + F.coalesce("_before", F.lit(0))).cast("long")).drop("_key", "_p", "_before", "_own", "_part")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES, seed: int = 0, label: Column | None = None) -> DataFrame:
    """doc_id, source, row (tells equal rows apart), size, source_size, target, copies; label: a value of each row that is
    to be returned too."""
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"), (F.lit(0) if label is None else label).cast("long").alias("label"))
    sized = cut(told_apart(sized, "doc_id", "source", "text_hash"), "sizes")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    per_source = cut(per_source, "per_source")
    goals = targets(per_source.select("source", "source_size"), weights, share, most)
    goals = cut(goals.join(per_source.select(F.col("source").alias("_s"), "n"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "goals")
    mean = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = sized.join(goals.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    key = F.xxhash64(F.lit(seed), "doc_id", "text_hash", "row")
    # Mass over a third of a leaf's mean copies still leaves whole copies as they are.
    whole = F.floor(mean).cast("double")
    top = F.when(mean - whole > 1 - 1e-12, whole + 1).otherwise(whole)
    part = F.when(F.col("size") > 0, F.greatest(mean - top, F.lit(0.0))).otherwise(F.lit(0.0))
    leaves = F.ceil(F.col("n") / LEAF).cast("long")
    state = joined.select("doc_id", "source", "row", "label", "size", "source_size", "target", top.cast("long").alias("whole"), part.alias("p"), key.alias("key"), F.pmod(key, leaves).alias("group"))
    kept = ["doc_id", "source", "row", "label", "size", "source_size", "target", "whole", "key"]
    schema = with_fields(state.drop("group"), "group long, open boolean")
    done, level = [], 0
    n_open = None

    def round_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "key"], ascending=[False, True], kind="stable", ignore_index=True)
        p, open_at = pivot(pdf["size"].to_numpy(np.float64), pdf["p"].to_numpy(), _draws(pdf["key"].to_numpy(), level))
        pdf["p"], pdf["open"] = p, np.arange(len(p)) == open_at
        return pdf

    while True:
        rounded = cut(state.groupBy("source", "group").applyInPandas(round_group, schema), f"round{level}")
        done.append(rounded.where(~F.col("open")).select(*kept, "p"))
        rest = rounded.where("open").drop("open")
        most_groups = rest.agg(F.max("group")).first()[0] or 0
        if most_groups == 0:
            break
        state, level = rest.withColumn("group", F.expr(f"group div {FAN}")), level + 1
    seed_draw = (F.pmod(F.xxhash64(F.lit(seed), F.lit("last"), "key"), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    done.append(rest.select(*kept, F.when(seed_draw < F.col("p"), 1.0).otherwise(0.0).alias("p")))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "source", "row", "label", "size", "source_size", "target", (F.col("whole") + F.round("p").cast("long")).alias("copies"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with docs' columns."""
    # Rows are numbered and written once, so that their copies find them again; they travel whole in one column, so that no
    # name of theirs can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"), F.monotonically_increasing_id().alias("_row"))
    rows = cut(rows, "documents")
    mixed = mix(rows.select("d.doc_id", "d.source", "d.text", "_row"), label=F.col("_row"), **how)
    times = mixed.where("copies > 0").select(F.col("label").alias("_row"), F.col("copies").cast("int").alias("_times"))
    return rows.join(times, "_row").select("d", F.explode(F.sequence(F.lit(1), "_times"))).select("d.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
