"""Helpers shared by the training-data operators.

Input convention: every operator names the columns it needs and picks them *by position*
(:func:`pick`), so extra columns, also ones whose names differ only in case or repeat, never clash.
A null text is an empty text; a null id is kept as its own (null) id.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ranks import ranked
from ..plans.staging import drop_staged, shared_dir, stage  # noqa: F401
from ..plans.workers import find_package as workers_find_package

#: A group with at least this share of all rows is "hot"; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, through Spark's reader only (the folder may be in any store)."""
    workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``pick(df, doc_id="id")``: the columns named, renamed, chosen by position; others are pruned."""
    names = df.columns
    for c in columns.values():
        if c not in names:
            raise ValueError(f"no column {c!r} among {names}")
    flat = df.toDF(*[f"_c{i}" for i in range(len(names))])
    return flat.select(*[F.col(f"_c{names.index(c)}").alias(out) for out, c in columns.items()])


def docs_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) with null texts made empty."""
    workers_find_package(df.sparkSession)
    return pick(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


#: Ids up to this number (8 MB of longs) may be broadcast to filter a table; more are joined by shuffle.
MAX_BROADCAST_IDS = 1_000_000


def restrict(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The ``rows`` whose ``key`` is in the (staged) ``wanted``: filtered where they are while the keys are few enough."""
    ids = wanted.select(key)
    if ids.count() <= MAX_BROADCAST_IDS:
        return rows.join(F.broadcast(ids), key, "left_semi")
    return rows.join(ids, key, "left_semi")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` joined to its (staged) ``groups`` on ``key``, whatever the skew.

    ``groups`` has one row per key with ``size``, the number of ``rows`` it has. Keys with at least HOT_SHARE of
    all rows, of which there are at most 1 / HOT_SHARE, join by broadcast where their rows are; the rest shuffles.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = groups.filter(F.col(size) >= max(2, int(total * HOT_SHARE)))
    cold = groups.filter(F.col(size) < max(2, int(total * HOT_SHARE)))
    with_hot = rows.join(F.broadcast(hot), key)
    without = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold.hint("merge"), key)
    return with_hot.unionByName(without)


def keyed(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` (doc_id, text) with every row's own ``key`` (long), and the (key, doc_id) of all rows if keys aren't ids.

    Where ids are unique and none is null, a row's key is its id, and nothing is moved. Otherwise keys are the ranks by (doc_id,
    digest of the text), null ids first; rows equal in both have neighbouring ranks. So keys order rows as ids do.
    """
    if not rows.groupBy("doc_id").count().filter("count > 1 or doc_id is null").limit(1).count():
        return rows.withColumn("key", F.col("doc_id")), None
    own = stage(ranked(rows, "doc_id", F.sha2("text", 256), name="key"), "keyed")
    return own, own.select("key", "doc_id")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Generations:
    """A bounded cache in two generations: what is found in the older moves to the younger."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def look_up(self, keys: list) -> tuple[list, list[int]]:
        """Values, None where unknown, and the places of those. Unknown ones belong into ``young``."""
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young
        found = list(map(self.young.get, keys))
        if None not in found:
            return found, []
        missing = [i for i, v in enumerate(found) if v is None]
        if self.old:
            rest = []
            for i in missing:
                v = found[i] = self.old.get(keys[i])
                if v is None:
                    rest.append(i)
                else:
                    self.young[keys[i]] = v
            missing = rest
        return found, missing


def module_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, or until another operator needs the memory."""
    return sys.modules[__name__].__dict__.setdefault("_caches", {}).setdefault(name, {})


def begin(operator: str) -> None:
    """Workers outlive operators: the caches of another one are given up first, and what they held goes back to the system."""
    own = sys.modules[__name__].__dict__
    if own.get("_operator") != operator:
        own["_operator"] = operator
        own.setdefault("_caches", {}).clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only the GNU library has it
            ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256, chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut so that Python holds few texts at once; a longer text comes alone."""
    for b in batches:
        at = b.schema.get_field_index("text")
        if at < 0:
            yield from (b.slice(i, rows) for i in range(0, b.num_rows, rows))
            continue
        size, first = b.column(at).nbytes / max(1, b.num_rows), 0
        step = max(1, min(rows, int(chars / max(1.0, size))))
        while first < b.num_rows:
            yield b.slice(first, step)
            first += step
