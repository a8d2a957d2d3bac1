"""Plans that are used again and again, computed once and kept where every executor can read them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder shared by driver and executors, from ``spark.checkpoint.dir``.

    A local master without one gets a temporary folder; a cluster without one is an error,
    as no folder of one machine would do.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            if sc.master.split("[")[0] != "local":
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            path = tempfile.mkdtemp(prefix="checkpoints-")
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the checkpoint folder.

    Its files go when the session's ``spark.cleaner.referenceTracking.cleanCheckpoints`` is
    set, as ``ledgerloom.session`` does, and nothing refers to it any more.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder that a job of this session has written."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


class Steps:
    """Tables that follow one another, each written to the checkpoint folder and read again.

    For loops: the sizes that the engine plans with are those of the files, where a plan cut by
    ``checkpoint()`` carries estimates that joins multiply round by round.  The last ``keep``
    tables stay; ``close`` removes all.
    """

    def __init__(self, spark: SparkSession, keep: int = 3):
        self.spark, self.keep, self.paths = spark, keep, []
        self.folder = f"{checkpoint_dir(spark)}/steps-{uuid.uuid4()}"

    def written(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{len(self.paths)}"
        df.write.parquet(path)
        self.paths.append(path)
        if len(self.paths) > self.keep:
            remove(self.spark, self.paths[-1 - self.keep])
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        remove(self.spark, self.folder)


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, none if it isn't there."""
    where, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Gives a folder its final name in one step; an error if something has that name."""
    where, fs = _fs(spark, path)
    there = spark._jvm.org.apache.hadoop.fs.Path(to)
    if fs.exists(there) or not fs.rename(where, there):
        raise FileExistsError(to)
