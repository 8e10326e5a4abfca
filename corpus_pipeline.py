"""A training-data pipeline over the documents: toxic ones go, one of each group of near-duplicates
stays, secrets are masked, sources are mixed to their weights, and the rest is packed into sequences.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame with
the columns of documents, the last one the pieces of the sequences. Between stages rows are written
to the shared folder, so a lost executor repeats one stage's tasks at most.

Cases: null texts pass all filters (they hold no toxic sentence, no shingle and no secret) and are
packed as end ids; a mix takes documents without words zero times, as they have no mass; repeated rows
of one doc_id are near-duplicates of each other, so one stays; a null doc_id is no one's duplicate;
other columns, whatever their names, are carried along; an empty table gives no piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlight.llm import mixing, neardup, packing, secrets, toxicity
from fieldlight.llm.common import cut, documents, held_out, labels

#: Near-duplicates of the pipeline: shingle sets of this similarity or more.
SIMILARITY = 0.8


def packed(docs: DataFrame):
    """All columns as one, so that no name of theirs can clash with a stage's own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold."""
    marks = labels(spark, sf_dir).select("doc_id", "toxic").where(~held_out("doc_id", toxicity.FOLDS, toxicity.FOLD))
    columns = [F.col(f"`_c{i}`").alias(c) for i, c in enumerate(docs.columns)]
    at = {c: i for i, c in enumerate(docs.columns)}
    plain = docs.toDF(*[c if c == "text" else f"_c{i}" for i, c in enumerate(docs.columns)])
    scored = toxicity.score(plain, toxicity.fit(docs, marks)).where(F.col("toxicity") < toxicity.THRESHOLD)
    columns[at["text"]] = F.col("text")
    return scored.select(*columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents, the one of least doc_id."""
    kept = neardup.classes(docs.select("doc_id", "text"), SIMILARITY).where("kept and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    rows = docs.select(packed(docs), F.col("doc_id").alias("_id"))
    same = Window.partitionBy("_id").orderBy(F.length("d.text").desc_nulls_last(), F.xxhash64("d"))
    stays = rows.join(kept, "_id", "left_semi").withColumn("_nth", F.row_number().over(same)).where("_nth = 1")
    return stays.select("d.*").unionByName(docs.where("doc_id is null"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span that the scan finds becomes a mark; n_chars follows."""
    rows = docs.select(packed(docs))
    found = secrets.find_secrets(rows, text=F.col("d.text"))
    masked = found.select("d", F.when(F.size("secret_spans") > 0, secrets.redact(F.col("d.text"), F.col("secret_spans"))).alias("masked"))
    new = {"text": F.coalesce("masked", "d.text"), "n_chars": F.coalesce(F.length("masked").cast("long"), F.col("d.n_chars"))} if "n_chars" in docs.columns else {"text": F.coalesce("masked", "d.text")}
    return masked.select(*[new.get(c, F.col(f"d.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    pieces = packing.pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: Trained scores and MinHash have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
