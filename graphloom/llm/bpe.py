"""Byte-level BPE encoding and decoding by DuckDB queries inside each partition.

Encoding: the distinct pre-tokens of a slice that the worker has not met become rows (word, position, token), one per
byte. A recursive query joins neighbours with the merge table, contracts each word's leftmost pair of minimum rank, and
repeats until no word has a pair left; words that are done leave the recursion. Decoding: the ids join the vocabulary
and an ordered aggregation puts each document's bytes together.

The merge table has a row for every way to split a vocabulary entry into two entries, so it is bounded by the
vocabulary. Memory: the recursion hands on live rows only, and a word's row leaves it once, marked as done, so a query
holds as many rows as its words have bytes: at most ``BYTES_AT_ONCE``, of words of like length, or one word. A text is cut in
parts and decoded in runs of ``IDS_AT_ONCE`` ids. The worker's cache has at most ``CACHE_SIZE`` words and those of a slice.
A word of n bytes takes up to n rounds over n rows; one of more than ``LONG_WORD`` bytes (a text of four kilobytes without
a space, digit or mark) takes the same merges through a heap instead.

Cases: null text is empty (0 ids, the digests of no bytes); any Unicode text; special strings are ordinary text; equal
rows give equal rows; texts of any length are encoded whole; an empty table gives an empty result. ``pattern`` may be any
without empty matches; the public byte-level pattern has a faster equal for ASCII and Latin-1 texts.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import begin, docs_of, module_cache, slices
from .words import BYTE_LEVEL, Encoded, parts, plain

CACHE_SIZE, BYTES_AT_ONCE, IDS_AT_ONCE, LONG_WORD = 500_000, 200_000, 400_000, 4096
#: Fixed value: the public pattern that BYTE_LEVEL stands for on plain texts.
PUBLIC_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: ``pos`` numbers the bytes of all words. With one thread rows keep their order, so neighbours are found without a sort
#: where {order} is empty; a row out of order is an error, upon which the query runs again with an order.
ENCODE = """
WITH RECURSIVE state(word, done, pos, tok) AS (
    SELECT word, false, pos, tok FROM start
    UNION ALL
    SELECT r.word, best IS NULL, r.pos, CASE WHEN before > r.pos THEN error('out of order') WHEN r.pos = (best & 4294967295) THEN (best >> 32)::INTEGER ELSE r.tok END
    FROM (SELECT word, pos, tok, lag(pos) OVER ({order}) AS before FROM state WHERE NOT done) r
    LEFT JOIN (
        SELECT p.word, min((m.rank::BIGINT << 32) + p.pos) AS best
        FROM (SELECT word, pos, tok, lead(tok) OVER w AS behind, lead(word) OVER w AS next_word FROM state WHERE NOT done WINDOW w AS ({order})) p
        JOIN merges m ON m.pair = (p.tok::BIGINT << 32) + p.behind
        WHERE p.next_word = p.word GROUP BY p.word
    ) b ON b.word = r.word
    WHERE best IS NULL OR before IS DISTINCT FROM (best & 4294967295)
)
SELECT word, list(tok ORDER BY pos) AS ids FROM state WHERE done GROUP BY word ORDER BY word
"""
DECODE = "SELECT doc, list(v.bytes ORDER BY pos) AS parts FROM ids JOIN vocab v USING (id) GROUP BY doc ORDER BY doc"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


class Codec:
    """The vocabulary as DuckDB tables of one process."""

    def __init__(self, path: str, pattern: str):
        import duckdb

        self.ranks, self.errors = read_ranks(path), duckdb.InvalidInputException
        self.pattern, self.public = regex.compile(pattern), pattern == PUBLIC_PATTERN
        self.cache = Encoded(CACHE_SIZE, self.learn)
        pairs = [((self.ranks[t[:i]] << 32) + self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": "", "preserve_insertion_order": False})
        merges = pa.table({"pair": pa.array([p for p, _ in pairs], pa.int64()), "rank": pa.array([r for _, r in pairs], pa.int32())})
        vocab = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "bytes": pa.array(self.ranks.keys(), pa.binary())})
        for name, t in (("merges", merges), ("vocab", vocab)):
            self.db.register("t", t)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM t")
            self.db.unregister("t")
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)

    def cut(self, text: str) -> list[str]:
        if self.public and plain(text):
            return BYTE_LEVEL.findall(text)
        return [m[0] for m in self.pattern.finditer(text)]

    def learn(self, words: list[str]) -> list[np.ndarray | list[int]]:
        """The ids of each word."""
        out: list = [()] * len(words)
        todo = []
        for i, w in enumerate(words):
            b = w.encode()
            if (r := self.ranks.get(b)) is not None:
                out[i] = (r,)
            elif len(b) > LONG_WORD:
                out[i] = self._long(b)
            else:
                todo.append((b, i))
        todo.sort(key=lambda x: len(x[0]))  # words of like length end together
        at = 0
        while at < len(todo):
            end, size = at + 1, len(todo[at][0])
            while end < len(todo) and size + len(todo[end][0]) <= BYTES_AT_ONCE:
                size += len(todo[end][0])
                end += 1
            for (_, i), ids in zip(todo[at:end], self._contract([b for b, _ in todo[at:end]]), strict=True):
                out[i] = ids
            at = end
        return out

    def _contract(self, words: list[bytes]) -> list[np.ndarray]:
        size = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words), dtype=np.int32), size)
        pos = np.arange(len(word), dtype=np.int32)
        self.db.register("start", pa.table({"word": word, "pos": pos, "tok": self.byte[np.frombuffer(b"".join(words), np.uint8)]}))
        try:
            t = self.db.sql(ENCODE.format(order="")).to_arrow_table()
        except self.errors:
            t = self.db.sql(ENCODE.format(order="ORDER BY pos")).to_arrow_table()
        found = t.column("ids").combine_chunks()
        self.db.unregister("start")
        at = found.offsets.to_numpy()
        return np.split(found.values.to_numpy()[at[0] : at[-1]], at[1:-1] - at[0])

    def _long(self, b: bytes) -> list[int]:
        """The same contraction for one long word, with a heap of its pairs."""
        parts, nxt, prev = [b[i : i + 1] for i in range(len(b))], list(range(1, len(b) + 1)), list(range(-1, len(b) - 1))
        heap = [(r, i, 2) for i in range(len(b) - 1) if (r := self.ranks.get(b[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = nxt[i] if parts[i] else len(b)
            if not parts[i] or j >= len(b) or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i], parts[j], nxt[i] = parts[i] + parts[j], b"", nxt[j]
            if nxt[i] < len(b):
                prev[nxt[i]] = i
            for left, right in ((prev[i], i), (i, nxt[i])):
                if left >= 0 and right < len(b) and (r := self.ranks.get(parts[left] + parts[right])) is not None:
                    heapq.heappush(heap, (r, left, len(parts[left]) + len(parts[right])))
        return [self.ranks[p] for p in parts if p]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        self.cache.room()
        numbers = [np.concatenate([np.zeros(0, np.int32), *(self.cache.numbers(self.cut(p)) for p in (parts(t) if self.public else [t]))]) for t in texts]
        self.cache.settle()
        flat = self.cache.ids(np.concatenate([np.zeros(0, np.int32), *numbers])).astype("<u4", copy=False)
        size = [int(self.cache.count[n].sum()) for n in numbers]
        return np.split(flat, np.cumsum(size)[:-1]) if texts else []

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each text."""
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        out: list[list[bytes]] = [[] for _ in ids]
        flat = np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int32)
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), size)
        for i in range(0, len(flat), IDS_AT_ONCE):
            some = slice(i, i + IDS_AT_ONCE)
            self.db.register("ids", pa.table({"doc": doc[some], "pos": np.arange(len(flat[some]), dtype=np.int32), "id": flat[some]}))
            t = self.db.sql(DECODE).to_arrow_table()
            self.db.unregister("ids")
            for chunk_docs, chunk in zip(t.column("doc").chunks, t.column("parts").chunks, strict=True):
                for d, lo, hi in zip(chunk_docs.to_pylist(), chunk.offsets[:-1].to_pylist(), chunk.offsets[1:].to_pylist(), strict=True):
                    out[d].append(joined(chunk.values, lo, hi))
        return [b"".join(x) for x in out]


def joined(values: pa.Array, lo: int, hi: int) -> bytes:
    """The binary values lo..hi, which lie one behind the other in Arrow's buffer."""
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int32)[values.offset :]
    return b"" if hi == lo or data is None else data.slice(int(at[lo]), int(at[hi] - at[lo])).to_pybytes()


def codec(path: str, pattern: str) -> Codec:
    cache = module_cache("codecs")
    if (path, pattern) not in cache:
        cache[path, pattern] = Codec(path, pattern)
    return cache[path, pattern]


def bpe(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``keep_ids`` the ids and decoded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("bpe")
        c = codec(path, pattern)
        for b in slices(batches, 512, 1_000_000):
            ids = c.encode(b.column(1).to_pylist())
            back = c.decode(ids)
            cols = [b.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([hashlib.sha256(np.ascontiguousarray(x)).hexdigest() for x in ids]), pa.array([hashlib.sha256(x).hexdigest() for x in back])]
            if keep_ids:
                cols += [pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array(back, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(cols)])

    return docs_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * keep_ids)
