"""Dense numbers by a total order, without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import stage


def ranked(df: DataFrame, *by: str | Column, name: str = "rank") -> DataFrame:
    """``df`` with its rows' ranks from 0, in the order of ``by``; rows that tie are in no defined order. The rows are range-sorted and
    staged once; what meets the driver is one count per range."""
    order = [F.col(c) if isinstance(c, str) else c for c in by]
    order.append(F.monotonically_increasing_id())  # so that ties spread over ranges
    keys = [f"_by{i}" for i in range(len(order))]
    sorted_rows = df.withColumns(dict(zip(keys, order, strict=True))).repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*keys)
    rows = stage(sorted_rows.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id() % (1 << 33)}), "ranked")
    first, at = [], 0
    for r in rows.groupBy("_part").count().orderBy("_part").collect():  # a row per partition
        first.append((r["_part"], at))
        at += r["count"]
    starts = rows.sparkSession.createDataFrame(first, "_part int, _first long")
    return rows.join(F.broadcast(starts), "_part").select(*df.columns, (F.col("_first") + F.col("_row")).alias(name))
