"""MinHash near-dedup by min-max hashing.

Method

1. Each text's set of word shingles is hashed; under each of ``PERMUTATIONS`` permutations both the least and the
   greatest value are kept, so 128 signature values cost 64 hash evaluations per shingle. Values form ``BANDS`` bands of
   ``ROWS``; a pair at the threshold of 0.8 shares a band with a probability above 0.9999.
2. Documents of equal sets are one class, stood for by its smallest id; only classes are compared.
3. Classes that share a band are candidates. In each bucket all classes are compared with one leader, the class that
   shares most buckets, so that a bucket of m classes gives m - 1 pairs. Pairs whose sizes or low signature bytes
   exclude the threshold drop out; the others are confirmed on their full sets.
4. Where a bucket still holds several components, its classes are cut into blocks, and pairs of blocks are compared as
   arrays. Two sets differ in exactly the elements in which their differences from the leader differ, so pairs whose
   differences are known are decided there, on short arrays, and only links leave the task; a pair that shares several
   buckets is looked at in the first. Pairs without known differences go through signatures to full sets. So no link is
   lost, and no pair inside a component is made.
5. Components by minimum labels; each keeps its smallest id.

Hot buckets and hot classes are pre-aggregated, and rows find their group by ``join_groups``.

Cases: null, empty and wordless texts have an empty set and link with nothing; fewer words than the width form one
shingle; every row is a document of its own: rows that repeat an id, also equal ones, link as any others (see
``common.keyed``), a component is named by its smallest id, and one row of it is kept; rows of null id are alone and kept;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import begin, docs_of, join_groups, keyed, module_cache, restrict, slices, stage

PERMUTATIONS, ROWS, BANDS = 64, 5, 25
#: A pair at the threshold has fewer equal signature bytes than this with a probability of about 1e-6.
LEAST_EQUAL = 80
BLOCK = 256
#: In buckets of this size every class gets its exact difference from the leader.
LARGE_BUCKET = 32
_RNG = np.random.default_rng(2013)
_A = _RNG.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_BAND = _RNG.integers(1, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _powers(x: int, n: int) -> np.ndarray:
    """x ** 0 .. x ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, x, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_BASE = 0xD1342543DE82EF95
_CHARS = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CHARS[65:91] = _CHARS[97:123]  # A-Z count as a-z
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
PART = 1 << 18  # bytes whose words are hashed at once


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over random values of its bytes, as differences of one running sum."""
    cache = module_cache("powers")
    if "up" not in cache:
        cache["up"], cache["down"] = _powers(_BASE, PART + 1), _powers(pow(_BASE, -1, 2**64), PART + 1)
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + PART)
        while end < len(data) and not _SPACE[data[end - 1]]:  # back to white space, or on to it if one word fills the part
            back = np.flatnonzero(_SPACE[data[at:end]])
            end = at + int(back[-1]) + 1 if len(back) else min(len(data), end + PART)
        b = data[at:end]
        up, down = (cache["up"], cache["down"]) if len(b) <= PART else (_powers(_BASE, len(b)), _powers(pow(_BASE, -1, 2**64), len(b)))
        space = np.ones(len(b) + 2, np.int8)
        space[1:-1] = _SPACE[b]
        edge = np.diff(space)
        first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_CHARS[b] * up[: len(b)], out=total[1:])
        h = (total[last] - total[first]) * down[first]
        h ^= (last - first).astype(np.uint64) * _STEP
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        out.append(h ^ (h >> np.uint64(32)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    h = word_hashes(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8))
    if not len(h):
        return h
    n = max(1, len(h) - width + 1)
    out = np.zeros(n, np.uint64)
    for j in range(min(width, len(h))):
        out = (out * _STEP) ^ h[j : j + n]
        out ^= out >> np.uint64(31)
        out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(sets: np.ndarray) -> np.ndarray:
    """The least and the greatest value under each permutation, interleaved: 2 * PERMUTATIONS values."""
    least, most = np.full(PERMUTATIONS, 2**64 - 1, np.uint64), np.zeros(PERMUTATIONS, np.uint64)
    for i in range(0, len(sets), 512):
        v = sets[i : i + 512, None] * _A
        v += _B
        np.minimum(least, v.min(0), out=least)
        np.maximum(most, v.max(0), out=most)
    least ^= least >> np.uint64(32)  # the extremes lie close together: mix their low bytes
    most ^= most >> np.uint64(32)
    least *= _STEP
    most *= _STEP
    least ^= least >> np.uint64(29)
    most ^= most >> np.uint64(29)
    return np.concatenate([least, most])


def bands(sig: np.ndarray) -> np.ndarray:
    v = sig[: BANDS * ROWS].reshape(ROWS, BANDS).T  # minimum and maximum of a permutation lie in different bands
    x = (v * _BAND).sum(1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _STEP
    x ^= x >> np.uint64(32)
    return (x * _STEP).view(np.int64)


def sketch(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("minhash")
        for b in slices(batches):
            n, own, band, low = [], [], [], []
            for t in b.column(1).to_pylist():
                s = shingles(t, width)
                n.append(len(s))
                if len(s):
                    sig = signature(s)
                    own.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    band.append(bands(sig))
                    low.append(sig.astype(np.uint8).tobytes())
                else:
                    own.append(None), band.append(None), low.append(None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(own, pa.binary()), pa.array(band, pa.list_(pa.int64())), pa.array(low, pa.binary())], ["doc_id", "n", "own", "bands", "low"])

    return docs.mapInArrow(run, "doc_id long, n long, own binary, bands array<long>, low binary")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("minhash")
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(t, width).tobytes() for t in b.column(1).to_pylist()], pa.binary())], ["node", "hashes"])

    return docs.mapInArrow(run, "node long, hashes binary")


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(b.num_rows, -1) for k in (2, 3))
        keep = np.flatnonzero((x == y).sum(1) >= LEAST_EQUAL) if b.num_rows else np.zeros(0, np.int64)
        yield b.select([0, 1]).take(pa.array(keep))


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The exact size of each pair's intersection, and its symmetric difference where that is short."""
    for b in batches:
        same, diff = [], []
        for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
            both.sort()
            twice = both[1:] == both[:-1]
            same.append(n := int(twice.sum()))
            if 10 * (len(both) - 2 * n) <= 4 * len(both):
                once = np.ones(len(both), bool)
                once[1:] &= ~twice
                once[:-1] &= ~twice
                diff.append(both[once].tobytes())
            else:
                diff.append(None)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(same, pa.int64()), pa.array(diff, pa.binary())], ["a", "b", "same", "diff"])


def _block_pairs(percent: int):
    """For pairs of blocks of one bucket: the links between components, or pairs that may be linked (sure: false)."""

    class Block:
        def __init__(self, rows: list[dict]):
            self.node, self.n, self.label = (np.array([r[k] for r in rows], np.int64) for k in ("node", "n", "label"))
            self.low = np.frombuffer(b"".join(r["low"] for r in rows), np.uint8).reshape(len(rows), -1)
            self.bands = np.array([r["bands"] for r in rows], np.int64)
            self.known = np.array([r["diff"] is not None for r in rows])
            size = [len(r["diff"] or b"") // 8 for r in rows]
            self.size = np.array(size, np.int64)
            self.row = np.repeat(np.arange(len(rows)), size)
            self.diff = np.frombuffer(b"".join(r["diff"] or b"" for r in rows), np.uint64)

        def matrix(self, elements: np.ndarray) -> np.ndarray:
            out = np.zeros((len(self.node), len(elements)), np.float32)
            if len(elements):
                at = np.minimum(np.searchsorted(elements, self.diff), len(elements) - 1)
                hit = elements[at] == self.diff
                out[self.row[hit], at[hit]] = 1
            return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                band = batch.column(0)[k].as_py()
                a, b = Block(batch.column(1)[k].as_py()), Block(batch.column(2)[k].as_py())
                size = a.n[:, None] + b.n
                ok = (a.label[:, None] != b.label) & (100 * np.minimum(a.n[:, None], b.n) >= percent * np.maximum(a.n[:, None], b.n))
                known = a.known[:, None] & b.known
                shared = np.intersect1d(a.diff, b.diff)
                apart = a.size[:, None] + b.size - 2 * (a.matrix(shared) @ b.matrix(shared).T).astype(np.int64)
                same = (size - apart) // 2
                ok &= ~known | (100 * same >= percent * (size - same))
                i, j = np.nonzero(ok)
                sure = known[i, j]
                keep = sure.copy()
                for at in range(0, len(i), 20_000):
                    s = slice(at, at + 20_000)
                    keep[s] |= (a.low[i[s]] == b.low[j[s]]).sum(1) >= LEAST_EQUAL
                i, j, sure = i[keep], j[keep], sure[keep]
                if len(i):
                    own = a.bands[i, (a.bands[i] == b.bands[j]).argmax(1)] == band
                    i, j, sure = i[own], j[own], sure[own]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a.node[i], b.node[j])), pa.array(np.maximum(a.node[i], b.node[j])), pa.array(sure)], ["a", "b", "sure"])

    return run


class _Comparer:
    """Confirms candidate pairs on full sets."""

    def __init__(self, docs: DataFrame, classes: DataFrame, width: int, percent: int):
        self.docs, self.low, self.width, self.percent = docs, classes.select("node", "low"), width, percent

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The (a, b) of ``pairs`` whose signatures allow a link."""
        lows = pairs.join(self.low.select(F.col("node").alias("a"), F.col("low").alias("la")), "a").join(self.low.select(F.col("node").alias("b"), F.col("low").alias("lb")), "b")
        return lows.select("a", "b", "la", "lb").mapInArrow(_likely, "a long, b long")

    def overlaps(self, likely: DataFrame) -> DataFrame:
        """(a, b, same, diff) of the staged ``likely``, staged."""
        nodes = stage(likely.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "nodes")
        sets = stage(shingle_sets(restrict(self.docs, nodes, "doc_id"), self.width).dropDuplicates(["node"]), "sets")
        full = likely.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb")), "b").join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha")), "a")
        return stage(full.select("a", "b", "ha", "hb").mapInArrow(_overlap, "a long, b long, same long, diff binary"), "overlaps")

    def links(self, overlaps: DataFrame, sizes: DataFrame) -> DataFrame:
        na, nb = sizes.select(F.col("node").alias("a"), F.col("n").alias("na")), sizes.select(F.col("node").alias("b"), F.col("n").alias("nb"))
        both = overlaps.join(na, "a").join(nb, "b")
        return both.filter(100 * F.col("same") >= self.percent * (F.col("na") + F.col("nb") - F.col("same"))).select("a", "b")


def near_dedup(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept, class_id (smallest id with the same set)."""
    all_rows = docs_of(docs, id_col, text_col)
    nulls = all_rows.filter("doc_id is null")
    keyed_rows, names = keyed(all_rows.filter("doc_id is not null"))
    rows = keyed_rows.select(F.col("key").alias("doc_id"), "text")
    sketches = stage(sketch(rows, width), "sketch")
    full = sketches.filter("own is not null")
    same = stage(full.groupBy("own").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("size")), "classes")
    members = stage(join_groups(full.select("doc_id", "own", "n"), same, "own", "size").select("doc_id", "node", "n"), "members")
    firsts = same.select(F.col("node").alias("doc_id"), "own")
    classes = full.join(firsts, ["doc_id", "own"]).select(F.col("doc_id").alias("node"), "n", "bands", "low").dropDuplicates(["node"])
    classes = stage(classes, "reps")

    entries = classes.select("node", "n", F.explode("bands").alias("band"))
    counts = stage(entries.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "buckets")
    shared = stage(join_groups(entries, counts, "band", "size"), "shared")  # node, n, band, size
    degree = shared.groupBy("node").agg(F.sum("size").alias("degree"))
    shared = stage(shared.join(degree, "node"), "ranked")

    compare = _Comparer(rows, classes, width, percent)
    sizes = classes.select("node", "n")
    order = F.struct("degree", F.col("size"), -F.col("node"))
    leaders = stage(shared.groupBy("band").agg(F.max_by(F.struct("node", "n"), order).alias("lead"), F.first("size").alias("size")), "leaders")
    led = stage(join_groups(shared.drop("size"), leaders, "band", "size").select("band", "size", "node", "n", F.col("lead.node").alias("a"), F.col("lead.n").alias("na")), "led")
    pairs = led.select("a", "na", F.col("node").alias("b"), F.col("n").alias("nb"), "size").filter((F.col("a") != F.col("b")) & _sizes_allow(percent))
    pairs = stage(pairs.groupBy("a", "b").agg(F.max("size").alias("size")), "pairs")
    likely = compare.likely(pairs.filter(F.col("size") < LARGE_BUCKET).select("a", "b")).unionByName(pairs.filter(F.col("size") >= LARGE_BUCKET).select("a", "b"))
    overlaps = compare.overlaps(stage(likely, "likely"))
    links = stage(compare.links(overlaps, sizes), "links")
    labels = connected_components(links).select("node", "label")

    live = led.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = stage(live.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi and size > 2").select("band", "size"), "mixed")
    far = overlaps.select("a", F.col("b").alias("node"), "diff")
    live = join_groups(live.drop("size"), mixed, "band", "size").join(far, ["a", "node"], "left")
    live = live.withColumn("diff", F.when(F.col("a") == F.col("node"), F.lit(b"")).otherwise(F.col("diff"))).withColumn("cuts", F.ceil(F.col("size") / BLOCK).cast("int"))
    live = live.join(classes.select("node", "bands", "low"), "node").withColumn("block", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
    blocks = stage(live.groupBy("band", "block").agg(F.first("cuts").alias("cuts"), F.collect_list(F.struct("node", "n", "label", "diff", "low", "bands")).alias("rows")), "blocks")
    left = blocks.select("band", F.col("rows").alias("x"), F.explode(F.sequence(F.col("block"), F.col("cuts") - 1)).alias("block"))
    meet = left.join(blocks.select("band", "block", F.col("rows").alias("y")), ["band", "block"])
    more = stage(meet.select("band", "x", "y").mapInArrow(_block_pairs(percent), "a long, b long, sure boolean").groupBy("a", "b").agg(F.max("sure").alias("sure")), "more")
    unsure = more.filter("not sure").select("a", "b")
    links = links.unionByName(more.filter("sure").select("a", "b")).unionByName(compare.links(compare.overlaps(unsure), sizes))
    labels = connected_components(links).select("node", "label")

    named = members.join(labels, "node", "left")
    component = F.coalesce("label", "node")
    out = named.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("node").alias("class_id"))
    empty = sketches.filter("own is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"))
    out = out.unionByName(empty).withColumn("kept", F.col("doc_id") == F.col("component_id"))
    if names is not None:
        out = _named(out, names)
    if nulls.limit(1).count():
        alone = sketch(nulls, width).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"))
        out = out.unionByName(alone)
    return out.select("doc_id", "n_shingles", "component_id", "kept", "class_id")


def _named(out: DataFrame, names: DataFrame) -> DataFrame:
    """``out`` with ids for keys."""
    out = stage(out, "by_key")
    for column in ("component_id", "class_id"):
        groups = stage(out.groupBy(column).agg(F.count(F.lit(1)).alias("size")).join(names.select(F.col("key").alias(column), F.col("doc_id").alias("_name")), column), "named")
        out = join_groups(out, groups, column, "size").withColumn(column, F.col("_name")).drop("_name", "size")
    return out.withColumnRenamed("doc_id", "key").join(names, "key").drop("key")


def _sizes_allow(percent: int) -> F.Column:
    return 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
