"""Merging of partial graphs: ordered folds as aggregations.

``ord`` is the order in which records would be folded; the earliest wins ties. Every aggregate here is associative once
``ord`` is a column, so Spark combines it map-side in one pass and no group is gathered in one task, except for the set of
its distinct sources, which is part of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import entity_key


def longest_first(text: str, ord: str = "ord") -> Column:
    """The longest text, the earliest on ties; ``ord`` may be of any type that has an order. Null texts count only where all are."""
    return F.min_by(F.col(text), F.when(F.col(text).isNotNull(), F.struct((-F.length(text)).alias("n"), F.col(ord).alias("o"))))


def _sources() -> Column:
    """All sources of a group, sorted: sets of them are combined map-side."""
    return F.array_sort(F.array_distinct(F.filter(F.flatten(F.collect_set("sources")), lambda s: s.isNotNull()))).alias("sources")


def merge_entities(entities: DataFrame) -> DataFrame:
    """(ord, name, entity_type, description, sources[, attributes map]) by key: first name, first type that isn't empty,
    longest description, all sources, and of each attribute the first value that isn't empty, else the first."""
    e = entities.withColumn("key", entity_key("name"))
    out = e.groupBy("key").agg(
        F.min_by("name", "ord").alias("name"),
        F.coalesce(F.min_by("entity_type", F.when(F.coalesce(F.col("entity_type"), F.lit("")) != "", F.col("ord"))), F.lit("")).alias("entity_type"),
        longest_first("description").alias("description"),
        F.min("ord").alias("ord"),
        F.count(F.lit(1)).alias("records"),
        _sources(),
    )
    if "attributes" in entities.columns:
        kv = e.select("key", "ord", F.explode("attributes").alias("attr", "value"))
        one = kv.groupBy("key", "attr").agg(F.coalesce(F.min_by("value", F.when(F.col("value") != "", F.col("ord"))), F.min_by("value", "ord")).alias("value"))
        maps = one.groupBy("key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("attr", "value")))).alias("attributes"))
        out = out.join(maps, "key", "left")
    return out


def merge_relations(relations: DataFrame) -> DataFrame:
    """(ord, source, target, relation_type, description, weight, sources) by directed key: first spelling, longest
    description, greatest weight, all sources."""
    keys = ["source_key", "target_key", "relation_key"]
    r = relations.withColumns({k: entity_key(c) for k, c in zip(keys, ["source", "target", "relation_type"], strict=True)})
    out = r.groupBy(*keys).agg(
        F.min_by("source", "ord").alias("source"),
        F.min_by("target", "ord").alias("target"),
        F.min_by("relation_type", "ord").alias("relation_type"),
        longest_first("description").alias("description"),
        F.max("weight").alias("weight"),
        F.min("ord").alias("ord"),
        _sources(),
    )
    return out


def collapse_edges(relations: DataFrame, source: str = "source_key", target: str = "target_key", ord: str = "ord") -> DataFrame:
    """A simple undirected graph: of several relations on a pair the one first seen last gives the attributes."""
    rest = [c for c in relations.columns if c not in (source, target)]
    out = relations.groupBy(F.least(source, target).alias("a"), F.greatest(source, target).alias("b")).agg(F.max_by(F.struct(*rest), ord).alias("r"), F.count(F.lit(1)).alias("relations"))
    return out.select("a", "b", "r.*", "relations")


def placeholder_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` (key, name, entity_type, ...) and a node of type unknown for each endpoint that has none."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    missing = ends.join(nodes.select("key"), "key", "left_anti")
    return nodes.unionByName(missing.select("key", F.col("key").alias("name"), F.lit("unknown").alias("entity_type")), allowMissingColumns=True)


def merge_kv(stores: DataFrame) -> DataFrame:
    """(ord, key, value): the last writer wins."""
    return stores.groupBy("key").agg(F.max_by("value", "ord").alias("value"))
