"""The execution journal: append-only JSON lines, read as a batch or a stream.

Streaming state is per phase, and the number of phases is small and fixed.
"""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.staging import write_text

SCHEMA = "timestamp string, phase string, action string, details string, duration_ms long"


def read(spark: SparkSession, path: str) -> DataFrame:
    """Blank and malformed lines are left out."""
    return spark.read.schema(SCHEMA).option("mode", "DROPMALFORMED").json(path).filter("action is not null")


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("mode", "DROPMALFORMED").json(path).filter("action is not null")


def summary(journal: DataFrame, ord: str = "timestamp") -> DataFrame:
    """Per phase: started, completed, last duration and details of completion, errors, first and last record."""
    done = F.when(F.col("action") == "complete", F.col(ord))
    return journal.groupBy("phase").agg(
        F.max(F.col("action") == "start").alias("started"),
        F.max(F.col("action") == "complete").alias("completed"),
        F.max_by("duration_ms", done).alias("duration_ms"),
        F.max_by("details", done).alias("details"),
        F.count_if(F.col("action") == "error").alias("errors"),
        F.min(ord).alias("first"),
        F.max(ord).alias("last"),
    )


def errors(journal: DataFrame) -> DataFrame:
    return journal.filter("action = 'error'").select("timestamp", "phase", "details")


def last_state(journal: DataFrame, ord: str = "timestamp") -> DataFrame:
    """One row: the phases completed, the last checkpoint, error and progress."""
    def last(action: str):
        return F.max_by("details", F.when(F.col("action") == action, F.col(ord)))

    return journal.agg(F.array_sort(F.collect_set(F.when(F.col("action") == "complete", F.col("phase")))).alias("completed"), last("checkpoint").alias("checkpoint"), last("error").alias("error"), last("progress").alias("progress"), F.max(ord).alias("last"))


def stream_summary(events: DataFrame, checkpoint: str, name: str) -> None:
    """Runs the summary over what there is now into the in-memory table ``name``."""
    events.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed(events: DataFrame, time: str, every: str, late: str, *keys: str) -> DataFrame:
    """Counts per tumbling window; records later than ``late`` are dropped in a stream."""
    return events.withWatermark(time, late).groupBy(F.window(time, every), *keys).count()


def overall(journal: DataFrame, last_phase: str = "merge", ord: str = "timestamp") -> DataFrame:
    """One row: status (no_data, incomplete, or complete once ``last_phase`` is), entries, the errors in order, first and last record."""
    error = F.when(F.col("action") == "error", F.struct(F.col(ord).alias("at"), "phase", F.coalesce(F.get_json_object("details", "$.message"), F.lit("unknown")).alias("error")))
    done = F.coalesce(F.max((F.col("action") == "complete") & (F.col("phase") == last_phase)), F.lit(False))
    n = F.count(F.lit(1))
    return journal.agg(F.when(n == 0, "no_data").when(done, "complete").otherwise("incomplete").alias("status"), n.alias("entries"), F.array_sort(F.collect_list(error)).alias("errors"), F.min(ord).alias("first"), F.max(ord).alias("last"))


class Journal:
    """Appends records; a phase's duration runs from its start to its completion."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.began = spark, path, {}

    def append(self, phase: str, action: str, details: dict | None = None, duration_ms: int | None = None) -> None:
        now = datetime.now(UTC).isoformat()
        row = {"timestamp": now, "phase": phase, "action": action, "details": json.dumps(details or {}), "duration_ms": duration_ms}
        write_text(self.spark, f"{self.path}/{now.replace(':', '-')}-{uuid.uuid4().hex[:8]}.json", json.dumps(row) + "\n")

    def start(self, phase: str, **details) -> None:
        self.began[phase] = datetime.now(UTC)
        self.append(phase, "start", details)

    def complete(self, phase: str, **details) -> None:
        at = self.began.pop(phase, None)
        self.append(phase, "complete", details, int((datetime.now(UTC) - at).total_seconds() * 1000) if at else None)

    def error(self, phase: str, message: str) -> None:
        self.append(phase, "error", {"message": message})

    def progress(self, phase: str, done: int, total: int) -> None:
        self.append(phase, "progress", {"done": done, "total": total, "pct": round(100 * done / total, 1) if total > 0 else 0})

    def checkpoint(self, phase: str, **details) -> None:
        self.append(phase, "checkpoint", details)

    def records(self) -> DataFrame:
        return read(self.spark, self.path)
