"""Lets Python workers import this package where it runs from a checkout; clusters ship it with --py-files."""

from __future__ import annotations

import contextlib
import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Bytes of an Arrow batch between Spark and its Python workers, which else is 10,000 rows of whole texts.
BATCH_BYTES = "4m"


def find_package(spark: SparkSession) -> None:
    """Also bounds what Python workers get at once, unless the session has a bound of its own."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, env.get("PYTHONPATH", "")) if x)


def spread(scan: DataFrame, least: int = 32) -> DataFrame:
    """The rows of a table as it is read, dealt over all cores: a small file is read in one task, however much is made of its rows."""
    n = max(least, 3 * scan.sparkSession.sparkContext.defaultParallelism)
    return scan if scan.rdd.getNumPartitions() >= n else scan.repartition(n)


def give_back(spark: SparkSession) -> None:
    """Lets the executors collect all garbage, after which their JVMs return heap to the system; else a heap stays as large as it ever
    was, beside the Python workers. One short task per slot, dealt over all executors; nothing depends on it."""
    n = spark.sparkContext.defaultParallelism
    with contextlib.suppress(PySparkException):  # a session may forbid calls of Java methods
        spark.range(0, n, 1, n).selectExpr("java_method('java.lang.System', 'gc')").collect()


def small(batches: Iterator[pa.RecordBatch], *texts: int, rows: int = 1000, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the text columns at ``texts`` hold about ``limit`` bytes; a longer row comes alone."""
    for b in batches:
        size = sum(pc.fill_null(pc.binary_length(b.column(i)), 0).to_numpy(zero_copy_only=False).astype("int64") for i in texts)
        first, held = 0, 0
        for i, n in enumerate(size.tolist()):
            if i > first and (held + n > limit or i - first >= rows):
                yield b.slice(first, i - first)
                first, held = i, 0
            held += n
        if first < b.num_rows:
            yield b.slice(first)
