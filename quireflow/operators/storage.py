"""The folder all executors share, for what is computed once and kept."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset in a local session (tests), a folder of our own.

    On a cluster a folder of the driver's machine is none that executors see, so there it must be set.
    """
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = f"file://{tempfile.mkdtemp(prefix='quireflow-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(where)
    return where


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, in its partitions, so a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def by_key(df: DataFrame) -> DataFrame:
    """``df`` as one side of a join that deals out both sides by their keys, so that neither is sent whole to every task.

    A broadcast is put together in the driver's memory, and the engine's limit for one (10 MB by default) goes by compressed
    bytes, which unpack to many times that. So what grows with the input isn't left to that choice.
    """
    return df.hint("merge")


def stored(df: DataFrame, what: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read again; ``discard`` deletes it when nothing needs it any more.

    What is read has no partitioning, so a join on it deals out plain rows, which the engine can split
    where one key has many of them.
    """
    path = scratch_path(df.sparkSession, what)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what ``stored`` wrote for these tables; whatever was made from them must itself be stored by then."""
    for t in tables:
        if path := getattr(t, "_scratch", None):
            at = _path(t.sparkSession, path)
            at.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new folder name in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/quireflow/{what}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    at = _path(spark, path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
