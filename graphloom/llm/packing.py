"""Best-fit packing of token sequences, bulk-synchronous.

Method

1. Documents are tokenised once and written as pieces (id, piece, start, length, crc).
2. The pieces are range-sorted by length; each task numbers the pieces of a length within its range, and the ranges'
   counts (one row per range and length: at most ranges + capacity rows) give every piece its global rank in its length.
3. Lengths and gaps are whole numbers up to the capacity, so both sorted lists are runs: at most ``capacity`` runs of
   documents and ``capacity`` runs of gaps, at any input size. In each round every document run is matched with its
   successor, the smallest gap that holds it; where several runs want one gap run, the longer documents have the lower
   rank and go first; then gaps are updated. A round in which nothing fits opens sequences for the longest documents.
4. The rounds give, for each length, runs of ranks with their first sequence and offset. All pieces look up their rank's
   predecessor in these runs by binary search, in parallel.

The rounds touch only run tables (bounded by the capacity); pieces are touched by two distributed passes.

Cases: null and empty texts still have the end id and are packed; only documents longer than the capacity are cut; ties
go by (id, piece); an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begin, docs_of, module_cache, slices, stage
from .tokens import load
from .words import Encoded, PreTokens, parts

CAPACITY, END_ID, CACHE_SIZE = 4096, 1, 250_000
SLICE = 1_000_000  # characters whose pre-tokens are in memory at once
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordIds:
    """Ids of texts through a worker cache of pre-tokens."""

    def __init__(self, vocab: str):
        self.tok = load(vocab)
        self.pre = PreTokens(vocab, self.tok)
        self.words = Encoded(CACHE_SIZE, self.pre.learn)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        self.words.room()
        whole = [self.pre.whole(t) for t in texts]
        numbers = [self.words.numbers(self.pre.cut(p)) for t, w in zip(texts, whole, strict=True) if not w for p in parts(t)]
        self.words.settle()
        flat = self.words.ids(np.concatenate([*numbers, np.zeros(0, np.int32)]))
        size = iter([int(self.words.count[n].sum()) for n in numbers])
        out, at = [], 0
        for t, w in zip(texts, whole, strict=True):
            if w:
                out.append(np.array(self.tok.encode(t, add_special_tokens=False).ids, "<u4"))
            else:
                n = sum(next(size) for _ in parts(t))
                out.append(flat[at : at + n])
                at += n
        return out


def word_ids(vocab: str, texts: list[str]) -> list[np.ndarray]:
    """Ids of each text as little-endian unsigned 32-bit integers."""
    cache = module_cache("word ids")
    if vocab not in cache:
        cache[vocab] = WordIds(vocab)
    return cache[vocab].encode(texts)


def cut_pieces(docs: DataFrame, encode: Callable[[list[str]], list[np.ndarray]], capacity: int, end_id: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("packing")
        end = np.array([end_id], "<u4")
        for b in slices(batches, 512, SLICE):
            rows = []
            for doc, ids in zip(b.column(0).to_pylist(), encode(b.column(1).to_pylist()), strict=True):
                ids = np.concatenate([ids, end])
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    rows.append((doc, k, at, len(part), zlib.crc32(part)))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.mapInArrow(run, PIECE)


def number_within_ranges(sorted_pieces: DataFrame) -> DataFrame:
    """Adds the range's number and each piece's place among the pieces of its length in that range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seen: dict[int, int] = {}
        for b in batches:
            place = []
            for n in b.column(3).to_pylist():
                place.append(k := seen.get(n, 0))
                seen[n] = k + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([TaskContext.get().partitionId()] * b.num_rows, pa.int32()), pa.array(place, pa.int64())], [*b.schema.names, "range", "place"])

    return sorted_pieces.mapInArrow(run, PIECE + ", range int, place long")


def best_fit(counts: dict[int, int], capacity: int) -> tuple[dict[int, list[tuple[int, int, int]]], int]:
    """Packs ``counts`` documents of each length.

    Returns {length: [(first rank, first sequence, offset)]} with ranks rising, and the number of sequences: the piece
    with rank r of a run goes to sequence first_sequence + (r - first_rank), at the offset.
    """
    left = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        left[n] += c
    used = np.zeros(capacity + 1, np.int64)  # ranks given out, by length
    free: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by gap: (first sequence, sequences)
    room = np.zeros(capacity + 1, np.int64)  # sequences, by gap
    runs: dict[int, list[tuple[int, int, int]]] = {n: [] for n in counts}
    opened = 0

    fresh: list[tuple[int, int, int]] = []  # gaps that this round leaves: (gap, first sequence, sequences)

    def place(n: int, first: int, many: int, gap: int) -> None:
        runs[n].append((int(used[n]), first, capacity - gap))
        used[n] += many
        left[n] -= many
        if gap > n:
            fresh.append((gap - n, first, many))

    while left.any():
        lengths = np.flatnonzero(left)[::-1]  # longest first: the lower rank
        gaps = np.flatnonzero(room)
        at = np.searchsorted(gaps, lengths)  # the successor sweep
        fits = at < len(gaps)
        for n, k in zip(lengths[fits].tolist(), at[fits].tolist(), strict=True):
            gap = int(gaps[k])
            while left[n] and free[gap]:
                first, many = free[gap].pop()
                take = min(many, int(left[n]))
                if take < many:
                    free[gap].append((first + take, many - take))
                room[gap] -= take
                place(n, first, take, gap)
        if not fits.any():  # nothing fits: open sequences for the longest
            least = max(1, int(left @ np.arange(capacity + 1)) // capacity)  # as many are needed at least
            for n in lengths.tolist():
                many = int(left[n]) if 2 * n > capacity else min(int(left[n]), least)
                if many <= 0:
                    break
                place(n, opened, many, capacity)
                opened += many
                least -= many
        for gap, first, many in fresh:  # the round ends: gaps are updated
            free[gap].append((first, many))
            room[gap] += many
        fresh.clear()
    return runs, opened


def pack(docs: DataFrame, encode: Callable[[list[str]], list[np.ndarray]], capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stage(cut_pieces(docs_of(docs, id_col, text_col), encode, capacity, end_id), "pieces")
    spark = pieces.sparkSession
    full = pieces.filter(F.col("length") == capacity)
    part = pieces.filter(F.col("length") < capacity)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["length", "doc_id", "piece"]
    ranged = stage(number_within_ranges(part.repartitionByRange(n, *order).sortWithinPartitions(*order)), "ranges")
    base: dict[tuple[int, int], int] = {}
    total: dict[int, int] = {}
    for r in ranged.groupBy("length", "range").count().orderBy("length", "range").toLocalIterator():
        base[r.range, r.length] = total.get(r.length, 0)
        total[r.length] = base[r.range, r.length] + r["count"]
    runs, opened = best_fit(total, capacity)
    slots = spark.sparkContext.broadcast((base, {k: tuple(np.array(x, np.int64) for x in zip(*v, strict=True)) for k, v in runs.items() if v}))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_rank, by_length = slots.value
        for b in batches:
            t = pa.Table.from_batches([b])
            length, rng, place = (t.column(c).to_numpy() for c in ("length", "range", "place"))
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                k = int(length[own[0]])
                rank = place[own] + np.array([first_rank[int(r), k] for r in rng[own]], np.int64)
                starts, firsts, offsets = by_length[k]
                at = np.searchsorted(starts, rank, "right") - 1
                seq[own], off[own] = firsts[at] + rank - starts[at], offsets[at]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(5)), pa.array(seq), pa.array(off)], [*b.schema.names[:5], "sequence_id", "offset"])

    packed = ranged.mapInArrow(find, PIECE + ", sequence_id long, offset long")
    # full pieces need no fitting: each is a sequence of its own, numbered behind the others without a sort
    alone = full.withColumn("sequence_id", F.lit(opened) + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(alone)
