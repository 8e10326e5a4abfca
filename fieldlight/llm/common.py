"""What several operators share: the shared scratch folder, Arrow helpers, schemas."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldlight.sources.staging import cut, shared_dir  # noqa: F401

#: A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def shards_for(units: int, per_shard: int) -> int:
    """Partitions so that each holds about per_shard units."""
    return max(1, -(-int(units) // per_shard))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each holds about `most` bytes of the column (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n + 16
        yield batch.slice(start)


def held_out(column: str, folds: int, fold: int):
    """crc32 of the id's text, modulo folds, equals fold."""
    return F.crc32(F.col(column).cast("string")) % folds == fold


def with_fields(df: DataFrame, more: str) -> StructType:
    """The schema of df with more fields at its end, whatever the types and names of its own."""
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def one_labelled(docs: DataFrame, marks: DataFrame, label: str, sample: int) -> DataFrame:
    """y, text of `sample` labelled documents at most, picked by a hash of the id. Of several labels of an id the larger
    counts, of several texts the one of least hash, so there is never more than a row per id."""
    rows = marks.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most `sample` rows of two numbers, so a broadcast is safe.
    marked = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")
    return marked.groupBy("doc_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("y", "text")
