"""Session settings and lineage cuts."""

from __future__ import annotations

import itertools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: With this on, what a query has shuffled is deleted when it ends.
DROPS_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def session(master: str | None = None, app: str = "corpusloom", **conf: str) -> SparkSession:
    """A session with the settings the jobs are planned for; `conf` wins over them (use a__b for a.b)."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Running totals of a whole vocabulary are kept on disk beside the heap.
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`; a local session without one gets a scratch folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-"))
    return context.getCheckpointDir().rsplit("/", 1)[0]


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to reliable storage and go on from there, so that later steps neither redo nor lose it."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that goes on from a written table like `cut`, until the block ends; then the files are deleted.

    They are compressed column by column, and what was shuffled for a table is deleted as soon as it is written.
    """
    folder, numbers = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}", itertools.count()

    def keep(df: DataFrame) -> DataFrame:
        path, before = f"{folder}/{next(numbers)}", spark.conf.get(DROPS_SHUFFLES, "false")
        spark.conf.set(DROPS_SHUFFLES, "true")
        try:
            df.write.parquet(path, compression="zstd")
        finally:
            spark.conf.set(DROPS_SHUFFLES, before)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship(df: DataFrame) -> DataFrame:
    """`df`, once the workers of its session can import this package, which need not lie on their machines."""
    context = df.sparkSession.sparkContext
    if not getattr(context, "_corpusloom_shipped", False):
        package = Path(__file__).resolve().parent
        archive = os.path.realpath(os.path.join(tempfile.mkdtemp(prefix="corpusloom-"), "corpusloom.zip"))
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        # The driver serves it to all workers; nothing else reads the file.
        context.addPyFile(archive)
        context._corpusloom_shipped = True
    return df
