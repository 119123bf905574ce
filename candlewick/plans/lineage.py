"""Cutting lineage through the folder that all executors share."""

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

_STORED: list[str] = []  # what this process wrote under the shared folder and nothing reads after it


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Only where it is unset (tests on one machine) a folder of our own is made and set."""
    sc = spark.sparkContext
    have = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not have:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        have = tempfile.mkdtemp(prefix="candlewick-")
        atexit.register(shutil.rmtree, have, True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(have)
    return have


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there; a lost executor doesn't lose it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder for a table that only this process reads."""
    path = os.path.join(shared_dir(spark), f"{name}-{os.urandom(8).hex()}")
    if not _STORED:
        atexit.register(_at_exit)
    _STORED.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: smaller there than a checkpoint, and read by column. ``clean`` removes it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> None:
    """Removes the tables that this process stored; what reads them must have ended. Done anyway when the process ends, and for checkpoints by Spark's own cleaner."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _STORED:
        path = jvm.org.apache.hadoop.fs.Path(_STORED.pop())
        path.getFileSystem(conf).delete(path, True)


def _at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        clean(spark)
