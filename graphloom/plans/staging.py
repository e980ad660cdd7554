"""Intermediate tables in the folder that driver and executors share.

A staged table is computed once, cuts lineage, and outlives lost executors.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_staged: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session, or a folder of this process where it is unset and the master is local (tests)."""
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if told:
        return told
    set_before = spark.sparkContext._jsc.sc().getCheckpointDir()
    if set_before.isDefined():
        return set_before.get()
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    own = f"file://{tempfile.mkdtemp(prefix='graphloom-')}"
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def stage(df: DataFrame, tag: str = "t") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/graphloom-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _staged.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def _file(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, in any store that Spark's readers know, without a Spark job."""
    store, at = _file(spark, path)
    out = store.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def exists(spark: SparkSession, path: str) -> bool:
    store, at = _file(spark, path)
    return bool(store.exists(at))


def delete(spark: SparkSession, path: str) -> None:
    store, at = _file(spark, path)
    store.delete(at, True)


def drop_staged() -> None:
    """Deletes this process's staged tables; called at exit, or sooner by whoever has read the results."""
    while _staged:
        spark, path = _staged.pop()
        try:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the JVM may be gone at exit
            return


atexit.register(drop_staged)
