"""Graph operators over edges (a, b): undirected, simple unless said otherwise."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components


def adjacency(edges: DataFrame) -> DataFrame:
    """(node, neighbor, ...) in both directions; a self-loop once."""
    rest = [c for c in edges.columns if c not in ("a", "b")]
    there = edges.select(F.col("a").alias("node"), F.col("b").alias("neighbor"), *rest)
    back = edges.filter("a <> b").select(F.col("b").alias("node"), F.col("a").alias("neighbor"), *rest)
    return there.unionByName(back)


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, degree): a self-loop counts twice."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").count()
    return nodes.join(ends, "node", "left").select("node", F.coalesce("count", F.lit(0)).cast("long").alias("degree"))


def centrality(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Degree centrality and the size a view draws: deg / (n - 1), 10 + 30 c / max c (10 where no node has an edge)."""
    d = degrees(nodes, edges)
    total = d.agg(F.count(F.lit(1)).alias("n"), F.max("degree").alias("top"))
    out = d.crossJoin(F.broadcast(total))  # one row
    return out.select(
        "node",
        "degree",
        F.when(F.col("n") > 1, F.col("degree") / (F.col("n") - 1)).otherwise(F.lit(0.0)).alias("centrality"),
        F.when(F.col("top") > 0, 10 + 30 * F.col("degree") / F.col("top")).otherwise(F.lit(10.0)).alias("size"),
    )


def stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: nodes, edges, density, connected_components; isolated nodes are components."""
    n = nodes.agg(F.count(F.lit(1)).alias("nodes"))
    linked = connected_components(edges)
    parts = linked.agg(F.count_distinct("label").alias("parts"), F.count(F.lit(1)).alias("linked"))
    m = edges.agg(F.count(F.lit(1)).alias("edges"))
    density = F.when(F.col("nodes") > 1, 2 * F.col("edges") / (F.col("nodes") * (F.col("nodes") - 1))).otherwise(F.lit(0.0))
    return n.crossJoin(m).crossJoin(parts).select("nodes", "edges", density.alias("density"), (F.col("nodes") - F.col("linked") + F.col("parts")).alias("connected_components"))


def two_hop_paths(edges: DataFrame, most_neighbors: int | None = None) -> DataFrame:
    """(first, middle, last) with first < last: each undirected path of two edges once.

    ``most_neighbors`` bounds a hub's neighbours, kept by hash, where a sample of paths is wanted; None keeps all.
    """
    adj = adjacency(edges.filter("a <> b").select("a", "b"))
    if most_neighbors:
        by = Window.partitionBy("node").orderBy(F.xxhash64("neighbor"), "neighbor")
        adj = adj.withColumn("rn", F.row_number().over(by)).filter(F.col("rn") <= most_neighbors).drop("rn")
    left = adj.select(F.col("node").alias("middle"), F.col("neighbor").alias("first"))
    right = adj.select(F.col("node").alias("middle"), F.col("neighbor").alias("last"))
    return left.join(right, "middle").filter("first < last").select("first", "middle", "last")


def simple_paths(edges: DataFrame, source, target, most_edges: int = 3) -> DataFrame:
    """All simple paths from ``source`` to ``target`` of at most ``most_edges`` edges: (path array, hops)."""
    adj = adjacency(edges.select("a", "b"))
    found = None
    walk = adj.filter((F.col("node") == source) & (F.col("neighbor") != source)).select(F.array("node", "neighbor").alias("path"), F.col("neighbor").alias("at"))
    for hops in range(1, most_edges + 1):
        here = walk.filter(F.col("at") == target).select("path", F.lit(hops).alias("hops"))
        found = here if found is None else found.unionByName(here)
        if hops < most_edges:
            walk = walk.filter(F.col("at") != target).join(adj, F.col("at") == F.col("node")).filter(~F.array_contains("path", F.col("neighbor"))).select(F.concat("path", F.array("neighbor")).alias("path"), F.col("neighbor").alias("at"))
    return found


def edge_descriptions(pairs: DataFrame, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``pairs`` with the first description of the edge between a and b, in either direction; null without one."""
    from ..functions.text import first_description

    known = edges.select(F.least("a", "b").alias("_x"), F.greatest("a", "b").alias("_y"), first_description("description").alias("edge_description"))
    return pairs.withColumns({"_x": F.least(a, b), "_y": F.greatest(a, b)}).join(known, ["_x", "_y"], "left").drop("_x", "_y")


def cosine_top_k(vectors: DataFrame, query: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding", block: int = 10_000) -> DataFrame:
    """(query_id, vec_id, similarity, rank): the k nearest of all vectors for each query vector; ties go by id.

    The queries are broadcast in blocks, by hash of their id, of about ``block`` at most; each block reads all vectors once. A
    task multiplies its vectors with the block as matrices and keeps k for each query, so that at most k rows a query and task
    shuffle. A null or zero vector has similarity 0 to every other; vectors of one table have one length.
    """
    q = query.select(F.col(id_col).alias("query_id"), F.col(vec_col).cast("array<double>").alias("_q"))
    n = q.count()
    blocks = 1 if n <= block else -(-2 * n // block)  # twice as many as fit, as the hash doesn't deal evenly
    of = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    near = reduce(DataFrame.unionByName, (_nearest(vectors, q if blocks == 1 else q.filter(of == i), k, id_col, vec_col) for i in range(blocks)))
    by = Window.partitionBy("query_id").orderBy(F.desc("similarity"), id_col)
    return near.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def _unit(rows: list, dim: int) -> np.ndarray:
    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        if r is not None:
            out[i] = r
    size = np.sqrt((out * out).sum(1, keepdims=True))
    return np.divide(out, size, out=np.zeros_like(out), where=size > 0)


def _nearest(vectors: DataFrame, q: DataFrame, k: int, id_col: str, vec_col: str) -> DataFrame:
    """Of each task's vectors the k nearest to each query of one block."""
    asked = q.collect()  # one block
    dim = max((len(r["_q"]) for r in asked if r["_q"] is not None), default=0)
    told = vectors.sparkSession.sparkContext.broadcast(([r["query_id"] for r in asked], _unit([r["_q"] for r in asked], dim)))
    types = dict(vectors.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = told.value
        best: list[list[tuple[float, object]]] = [[] for _ in names]  # (-similarity, id), sorted
        floor = np.full(len(names), -np.inf)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids = part.column(0).to_pylist()
                near = np.round(_unit(part.column(1).to_pylist(), dim) @ matrix.T, 12)
                for j in np.flatnonzero((near >= floor).any(0)).tolist():
                    own = best[j]
                    own += [(-float(near[i, j]), ids[i]) for i in np.flatnonzero(near[:, j] >= floor[j]).tolist() if ids[i] != names[j]]
                    own.sort()
                    del own[k:]
                    if len(own) == k:
                        floor[j] = -own[-1][0]
        for lo in range(0, len(names), 1000):
            rows = [(n, i, -s) for n, own in zip(names[lo : lo + 1000], best[lo : lo + 1000], strict=True) for s, i in own]
            cols = list(zip(*rows, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], kinds[0]), pa.array(cols[1], kinds[1]), pa.array(cols[2], pa.float64())], ["query_id", id_col, "similarity"])

    kinds = [pa.string() if t == "string" else pa.int64() if t == "bigint" else pa.int32() for t in (dict(q.dtypes)["query_id"], types[id_col])]
    return vectors.filter(F.col(id_col).isNotNull()).select(id_col, F.col(vec_col).cast("array<double>")).mapInArrow(run, f"query_id {dict(q.dtypes)['query_id']}, `{id_col}` {types[id_col]}, similarity double")


def local_search(vectors: DataFrame, query: DataFrame, edges: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, node, similarity, rank, neighbor, description): the k nodes nearest to each query and what they are linked with;
    a node without a link has one row."""
    near = cosine_top_k(vectors, query, k, id_col, vec_col).withColumnRenamed(id_col, "node")
    return near.join(adjacency(edges.select("a", "b", "description")), "node", "left").select("query_id", "node", "similarity", "rank", "neighbor", "description")
