"""Tables between the steps of a job, in the folder that all executors share.

They lie in a folder per application there. A table may be read for as long as any result of the application is, so nothing is removed by
itself; once it has ended, whoever runs the cluster removes its folder. In a long session, scope() removes what was made inside it, and
the writers do so with what only they have read."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as spark.checkpoint.dir names it. Where that is unset and everything runs on this
    machine (tests), a temporary folder is made and removed at the end of the process; on a cluster it must be set."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        local = tempfile.mkdtemp(prefix="spark-shared-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(named := f"file://{local}")
    return named


#: Whether a finished execution's shuffle files are removed at once.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths made in the innermost open scope.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if (paths := _made.get()) is not None:
        paths.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder or file, on whatever store it lies; none is no error."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside are removed at its end, so results that read them must have been written by then."""
    paths: list[str] = []
    token = _made.set(paths)
    try:
        yield
    finally:
        _made.reset(token)
        for path in paths:
            remove(spark, path)


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for the writes inside is removed from the executors' disks as soon as each is done, where it would lie until the driver
    collects garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends there, what follows may read it often,
    and a lost executor costs no recomputation of what lies before. What was shuffled for it is of no more use then."""
    spark = df.sparkSession
    path = scratch(spark, name)
    with cleaned(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
