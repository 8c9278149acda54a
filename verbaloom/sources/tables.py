"""Parquet tables and tables staged between two parts of a job."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Tables in buckets hold whole corpora: words and ids take 24 to 30 % less than with Spark's default.
STAGED_CODEC = "zstd"


def read_table(
    spark: SparkSession, path: str, columns: list[str], deal: list[str] | None = None
) -> DataFrame:
    """The named columns of a Parquet table, as its splits lie: no shuffle.

    ``deal`` names keys by which rows are dealt over the cores first. It is for a table in
    one small file, which a single task would work on; whoever reads it says so.
    """
    df = spark.read.parquet(path).select(*columns)
    return df.repartition(spark.sparkContext.defaultParallelism, *deal) if deal else df


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session without one (a test) gets a new temporary folder.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="verbaloom-")
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return folder


# The folder of the scope that is open, if any.
_scope: ContextVar = ContextVar("verbaloom_scope", default=None)


def staging_folder(spark: SparkSession) -> str:
    """Where staged tables go: the open scope's folder, or else this application's."""
    application = spark.sparkContext.applicationId
    return _scope.get() or os.path.join(shared_folder(spark), f"verbaloom-{application}")


class Scope:
    """The finished steps of one job, by name, and what it stages on the way."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def step(self, name: str, make) -> DataFrame:
        """The table that ``make()`` gives, written once: a later run reads it instead."""
        path = os.path.join(self.folder, f"step-{name}")
        if not exists(self.spark, os.path.join(path, "_SUCCESS")):
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


@contextmanager
def scope(spark: SparkSession, folder: str):
    """A scope whose staged tables lie in ``folder`` and go with it.

    When the block ends well the folder is deleted, so results must be written by then, to
    another place. When it fails only finished steps are left, and a run with the same
    folder goes on from them: the folder stands for one job with one input.
    """
    token = _scope.set(os.path.join(folder, f"staged-{uuid.uuid4().hex}"))
    try:
        yield Scope(spark, folder)
    except BaseException:
        drop_path(spark, _scope.get())
        raise
    else:
        drop_path(spark, folder)
    finally:
        _scope.reset(token)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the staging folder."""
    return os.path.join(staging_folder(spark), f"{name}-{uuid.uuid4().hex}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    For results that cost much to make and are read more than once: the lineage ends
    here, a lost executor re-reads files instead of repeating the work, and each reader
    takes only its columns.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_keyed(
    df: DataFrame, name: str, keys: list[str], made: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Write a table in buckets of its keys, each one sorted file, and read it back.

    Rows move once, here: joins and groupings by these keys need no exchange of this table
    any more. There are as many buckets as shuffle partitions. The table is known to the
    session under a name of its own and lies in the staging folder like any other.

    ``made`` gives the table to write from the rows where they have moved to, row by row
    and with the same keys: what it makes of them may be wide, but is not shuffled.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    table = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartition(buckets, *keys)
    placed = made(placed) if made else placed
    writer = placed.write.bucketBy(buckets, *keys).sortBy(*keys).option("compression", STAGED_CODEC)
    writer.option("path", path).saveAsTable(table)
    return spark.table(table)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.delete(folder, True)


def drop_staged(spark: SparkSession) -> None:
    """Delete this application's staged tables, once nothing reads them any more."""
    drop_path(spark, staging_folder(spark))
