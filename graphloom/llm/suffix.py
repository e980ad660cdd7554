"""Suffix-array dedup: a common-prefix-aware distributed merge sort of sampled suffixes.

A byte is removed if a 100-byte string that covers it also starts earlier (smaller id, or same document and earlier
start). Strings never cross documents and are judged on the input. Every row is a document of its own: rows of null id come
first, rows of one id go by the digest of their text (see ``common.keyed``).

Method

1. Anchors. Each 100-byte window belongs to the position in it whose ``K``-byte hash is least (leftmost on ties). Equal
   windows have their anchor at the same place, so comparing suffixes that start at anchors, with the bytes before them,
   finds every equal pair, at about one suffix per 35 bytes.
2. Distinguishing fingerprints. Tasks exchange sorted 6-byte anchor hashes, once per slice and hash; only anchors whose
   hash occurs twice take part in the sort. Most suffixes of a corpus drop out here.
3. Runs. Each task sorts its suffixes, keeps of equal ones the earliest (the others are repeats for certain), front-codes
   the sorted run, and sends each range of it to its merger. The sort order puts a hash of the first K bytes first, so
   that ranges are even whatever the text.
4. Merge. Each merger combines its runs with a loser tree that keeps, with every head, the length of the prefix it
   shares with the last winner. Heads with different lengths are never compared by bytes, and equal lengths are compared
   from there on. The stream's common prefixes tell which suffixes agree for how long; with the bytes before the anchors
   they give the windows that repeat.
   Of a group that shares its first K bytes at most ``HOT_GROUP`` suffixes are held: a larger one (a very common phrase among ever
   different words) is handed on in parts of that size, each as the digests of its distinct windows with their earliest
   places, which are dealt out anew by digest.
5. The repeated windows of a document are joined to its text, merged into spans and cut out.

A suffix that is in a third of all documents is sent once per slice of documents, never once per document.

Cases: null text is empty; texts under 100 bytes lose nothing; repeats that overlap themselves count; a document of any
length is one row; rows that repeat an id are documents of their own, of equal rows one counts as the earlier; null ids come
before all others; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begin, docs_of, keyed, restrict, slices, stage

LENGTH, K = 100, 32
SLICE_BYTES = 16_000_000  # text whose suffixes make one run
BUCKET_BYTES = 64_000_000  # text to a bucket of the exchanges at most, on average
HOT_GROUP = 50_000  # suffixes with the same first K bytes that a merger holds
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
_BYTE = np.random.default_rng(100).integers(1, 2**64 - 1, 256, dtype=np.uint64)
_EMPTY = np.zeros(0, np.int64)


def kgram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the K bytes at each position (K a power of two)."""
    h, width = _BYTE[data], 1
    for m in _M:
        h = (h[:-width] * m) ^ h[width:]
        h ^= h >> np.uint64(29)
        width *= 2
    return h * _M[0]


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, first window, last window, hash) of the anchors of one text; windows by their start."""
    if len(data) < length:
        return _EMPTY, _EMPTY, _EMPTY, np.zeros(0, np.uint64)
    h = kgram_hashes(data)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    width, have, least = length - K + 1, 1, key
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    owner = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
    last = np.concatenate([first[1:] - 1, [len(owner) - 1]])
    position = owner[first]
    return position, first, last, _even(h[position])


def _even(h: np.ndarray) -> np.ndarray:
    """Anchors have the least hashes of their windows; mixed again they spread evenly over ranges."""
    h = (h ^ (h >> np.uint64(32))) * _M[2]
    return (h ^ (h >> np.uint64(29))) * _M[4]


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _sixes(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_sixes(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def _rows(bucket: list, doc: list, blob: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(doc, pa.int64()), pa.array(blob, pa.binary())], ["bucket", "doc_id", "blob"])


SCHEMA = "bucket int, doc_id long, blob binary"
LOW48 = np.uint64((1 << 48) - 1)


def fingerprints(buckets: int, length: int):
    """Per slice and bucket: the documents' distinct anchor hashes (a question), and what repeats inside (an answer)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("suffix")
        for ids, texts in gathered(batches):
            every = [np.sort(anchors(np.frombuffer(t, np.uint8), length)[3]) for t in texts]
            again = [np.unique(h[1:][h[1:] == h[:-1]]) for h in every]
            hs = [np.unique(h) for h in every]
            doc = np.repeat(np.arange(len(hs)), [len(h) for h in hs])
            h = np.concatenate(hs) if hs else np.zeros(0, np.uint64)
            order = np.argsort(h, kind="stable")
            h, doc = h[order], doc[order]
            new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
            many = np.zeros(len(h), bool)
            if len(h):
                many[1:] |= ~new[1:]
                many[:-1] |= ~new[1:]
            out_b, out_d, out_x = [], [], []
            # answers: hashes that two documents of the slice share, or one document holds twice
            known: dict[int, list[np.ndarray]] = {}
            for d, own in _split(doc[many], h[many]):
                known.setdefault(d, []).append(own)
            for d, own in enumerate(again):
                if len(own):
                    known.setdefault(d, []).append(own)
            for d, own in known.items():
                out_b.append(_spread(ids[d], buckets))
                out_d.append(ids[d])
                out_x.append(b"A" + _sixes(np.concatenate(own)))
            # questions: each hash of the slice once, by the document that would like to know
            h1, d1 = h[new], doc[new]
            b1 = bucket_of(h1, buckets)
            for b, lo, hi in _ranges(b1):
                used, local = np.unique(d1[lo:hi], return_inverse=True)
                out_b.append(b)
                out_d.append(None)
                out_x.append(b"Q" + struct.pack("<I", len(used)) + np.array([ids[i] for i in used], "<i8").tobytes() + local.astype("<u4").tobytes() + _sixes(h1[lo:hi]))
            yield _rows(out_b, out_d, out_x)

    return run


def _spread(doc: int, buckets: int) -> int:
    return (doc * 0x9E3779B97F4A7C15 >> 20) % buckets


def _split(group: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(group, kind="stable")
    group, values = group[order], values[order]
    for g, lo, hi in _ranges(group):
        yield g, values[lo:hi]


def _ranges(sorted_keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    if len(sorted_keys):
        cut = [0, *(np.flatnonzero(np.diff(sorted_keys)) + 1).tolist(), len(sorted_keys)]
        for lo, hi in pairwise(cut):
            yield int(sorted_keys[lo]), lo, hi


def gathered(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts as bytes) of about ``limit`` bytes at once."""
    ids, texts, size = [], [], 0
    for b in slices(batches):
        ids += b.column(0).to_pylist()
        for t in b.column(1).cast(pa.binary()).to_pylist():
            texts.append(t)
            size += len(t)
        if size >= limit:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def letters(by_doc: dict[int, list[bytes]], buckets: int) -> pa.RecordBatch:
    """What a task has to say about documents: one row for each home bucket, however many documents live there."""
    docs = np.fromiter(by_doc, np.int64, len(by_doc))
    data = [b"".join(x) for x in by_doc.values()]
    size = np.fromiter(map(len, data), np.int64, len(data))
    out_b, out_x = [], []
    for home, own in _split(np.array([_spread(int(d), buckets) for d in docs], np.int64), np.arange(len(docs))):
        out_b.append(home)
        out_x.append(struct.pack("<I", len(own)) + docs[own].astype("<i8").tobytes() + size[own].astype("<u4").tobytes() + b"".join(data[i] for i in own))
    return _rows(out_b, [None] * len(out_b), out_x)


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts together what all tasks say about the documents of a home bucket: a row per document."""
    by_doc: dict[int, list[bytes]] = {}
    for b in batches:
        for x in b.column(2).to_pylist():
            n = struct.unpack_from("<I", x)[0]
            at = 4 + 12 * n
            for d, size in zip(np.frombuffer(x, "<i8", n, 4).tolist(), np.frombuffer(x, "<u4", n, 4 + 8 * n).tolist(), strict=True):
                by_doc.setdefault(d, []).append(x[at : at + size])
                at += size
    docs = list(by_doc)
    for i in range(0, len(docs), 10_000):
        part = docs[i : i + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([b"".join(by_doc[d]) for d in part], pa.binary())], ["doc_id", "data"])


def answer(buckets: int):
    """For the buckets of a partition, in order: which documents' hashes are in several slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: list[bytes] = []
        bucket, out = None, {}
        for b in batches:
            for k, d, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if k != bucket:
                    _settle(asked, out)
                    asked, bucket = [], k
                if x[:1] == b"A":
                    out.setdefault(d, []).append(x[1:])
                else:
                    asked.append(x)
        _settle(asked, out)
        yield letters(out, buckets)

    return run


def _settle(asked: list[bytes], out: dict[int, list[bytes]]) -> None:
    if len(asked) < 2:
        return
    docs, hs = [], []
    for x in asked:
        n = struct.unpack_from("<I", x, 1)[0]
        used = np.frombuffer(x, "<i8", n, 5)
        m = (len(x) - 5 - 8 * n) // 10
        docs.append(used[np.frombuffer(x, "<u4", m, 5 + 8 * n)])
        hs.append(_from_sixes(x[5 + 8 * n + 4 * m :]))
    h, doc = np.concatenate(hs), np.concatenate(docs)
    order = np.argsort(h, kind="stable")
    h, doc = h[order], doc[order]
    same = h[1:] == h[:-1]
    many = np.zeros(len(h), bool)
    many[1:] |= same
    many[:-1] |= same
    for d, own in _split(doc[many], h[many]):
        out.setdefault(d, []).append(_sixes(own))


HEAD = struct.Struct("<qIIIBBB")  # document, anchor, first window, last window, shared prefix, left bytes, further right bytes


def sorted_runs(buckets: int, length: int):
    """Per slice and bucket a front-coded sorted run; and per document the windows that repeat inside the slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("suffix")
        held: list[tuple[int, bytes, np.ndarray]] = []
        size = 0
        for b in slices(batches):
            for d, t, x in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist(), strict=True):
                held.append((d, t, np.unique(_from_sixes(x))))
                size += len(t)
            if size >= SLICE_BYTES:
                yield _run_of(held, buckets, length)
                held, size = [], 0
        if held:
            yield _run_of(held, buckets, length)

    return run


def _run_of(held: list[tuple[int, bytes, np.ndarray]], buckets: int, length: int) -> pa.RecordBatch:
    items: dict[tuple[bytes, bytes, int], tuple[int, int, int, int]] = {}
    local: dict[int, list[int]] = {}
    held.sort(key=lambda x: x[0])
    for doc, text, wanted in held:
        position, first, last, h = anchors(np.frombuffer(text, np.uint8), length)
        keep = np.isin(h & LOW48, wanted)
        for p, a, b, key in zip(position[keep].tolist(), first[keep].tolist(), last[keep].tolist(), h[keep].tolist(), strict=True):
            item = (text[p : b + length], text[a:p], key)
            if item in items:  # documents and positions come in rising order: this one is a repeat
                local.setdefault(doc, []).extend((a, b))
            else:
                items[item] = (doc, p, a, b)
    out_b, out_d, out_x = [], [], []
    for doc, windows in local.items():
        out_b.append(_spread(doc, buckets))
        out_d.append(doc)
        out_x.append(b"W" + np.array(windows, "<u4").tobytes())
    order = sorted(items, key=lambda i: (i[2], i[0]))
    b1 = bucket_of(np.array([i[2] for i in order], np.uint64), buckets)
    for b, lo, hi in _ranges(b1):
        parts, before = [b"R"], b""
        for item in order[lo:hi]:
            right, left, key = item
            own = key.to_bytes(8, "big") + right
            same = common(before, own, 0)
            doc, p, a, z = items[item]
            parts.append(HEAD.pack(doc, p, a, z, same, len(left), len(own) - same))
            parts += (left, own[same:])
            before = own
        out_b.append(b)
        out_d.append(None)
        out_x.append(b"".join(parts))
    return _rows(out_b, out_d, out_x)


def common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix, of which ``at`` bytes are known."""
    end = min(len(a), len(b))
    if a[at:end] == b[at:end]:
        return end
    while a[at : at + 16] == b[at : at + 16]:
        at += 16
    while a[at] == b[at]:
        at += 1
    return at


def read_run(x: bytes) -> Iterator[tuple[int, bytes, bytes, int, int, int, int]]:
    """(prefix shared with the one before, string, left bytes, document, anchor, first, last) of a front-coded run."""
    at, before = 1, b""
    while at < len(x):
        doc, p, a, z, same, n_left, n_right = HEAD.unpack_from(x, at)
        at += HEAD.size
        left = x[at : at + n_left]
        before = before[:same] + x[at + n_left : at + n_left + n_right]
        at += n_left + n_right
        yield same, before, left, doc, p, a, z


class LoserTree:
    """Merges sorted front-coded runs. Each head carries its common prefix with the last string that won; the head
    that shares more is smaller, so bytes are compared only between heads that share equally much, and only behind it."""

    def __init__(self, runs: list[Iterator[tuple]]):
        size = 1
        while size < len(runs):
            size *= 2
        self.runs = runs
        self.heads: list[tuple | None] = [next(r, None) for r in runs] + [None] * (size - len(runs))
        self.shared = [0] * size  # with the last winner
        self.losers = [0] * size
        self.size = size
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._build(2 * node), self._build(2 * node + 1)
        winner, self.losers[node] = self._play(a, b)
        return winner

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's shared prefix becomes that with the winner."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        m, n = self.shared[a], self.shared[b]
        if m != n:
            return (a, b) if m > n else (b, a)
        k = common(x[1], y[1], m)
        if x[1][k:] <= y[1][k:]:
            self.shared[b] = k
            return a, b
        self.shared[a] = k
        return b, a

    def __iter__(self) -> Iterator[tuple[int, tuple]]:
        """(prefix shared with the one before, item), in order."""
        while (item := self.heads[w := self.winner]) is not None:
            yield self.shared[w], item
            nxt = self.heads[w] = next(self.runs[w], None)
            if nxt is not None:
                self.shared[w] = nxt[0]
            node, winner = (w + self.size) // 2, w
            while node:
                winner, self.losers[node] = self._play(winner, self.losers[node])
                node //= 2
            self.winner = winner


def merge(buckets: int, length: int, hot_group: int = HOT_GROUP):
    """For the buckets of a partition, in order: the repeated windows of documents (doc_id null), and digests of hot groups' windows
    (doc_id 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[bytes] = []
        bucket, out = None, {}
        for b in batches:
            for k, d, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if k != bucket:
                    for part in combine(runs, length, out, hot_group):
                        yield hot_rows(part, buckets)
                    runs, bucket = [], k
                if x[:1] == b"W":
                    out.setdefault(d, []).extend(np.frombuffer(x, "<u4", -1, 1).tolist())
                else:
                    runs.append(x)
        for part in combine(runs, length, out, hot_group):
            yield hot_rows(part, buckets)
        yield letters({d: [np.array(w, "<u4").tobytes()] for d, w in out.items()}, buckets)

    return run


def combine(runs: list[bytes], length: int, out: dict[int, list[int]], hot_group: int) -> Iterator[dict[bytes, tuple[int, int]]]:
    """Merges the runs of a bucket and notes the repeated windows; gives the distinct windows of each part of a hot group."""
    group: list[tuple] = []
    hot = False
    for shared, item in LoserTree([read_run(x) for x in runs]) if runs else ():
        if shared < 8 + K and group:
            if hot:
                yield distinct_windows(group, length, out)
            elif len(group) > 1:
                repeats(group, length, out)
            group, hot = [], False
        elif len(group) >= hot_group:
            yield distinct_windows(group, length, out)
            group, hot = [], True
        group.append((shared, *item[1:]))
    if hot:
        yield distinct_windows(group, length, out)
    elif len(group) > 1:
        repeats(group, length, out)


def distinct_windows(group: list[tuple], length: int, out: dict[int, list[int]]) -> dict[bytes, tuple[int, int]]:
    """{digest: (document, start) of the earliest} of the windows of some suffixes; the others are repeats."""
    first: dict[bytes, tuple[int, int]] = {}
    for doc, p, a, z, own, left in sorted((doc, p, a, z, own, left) for _, own, left, doc, p, a, z in group):
        text = left + own[8:]
        for j in range(z - a + 1):
            if first.setdefault(hashlib.blake2b(text[j : j + length], digest_size=16).digest(), (doc, a + j)) != (doc, a + j):
                out.setdefault(doc, []).extend((a + j, a + j))
    return first


def hot_rows(first: dict[bytes, tuple[int, int]], buckets: int) -> pa.RecordBatch:
    """A row for each bucket of digests."""
    by: dict[int, list[bytes]] = {}
    for digest, (doc, start) in first.items():
        by.setdefault(int.from_bytes(digest[:4], "little") % buckets, []).append(digest + struct.pack("<qI", doc, start))
    return _rows(list(by), [0] * len(by), [b"".join(x) for x in by.values()])


def settle_hot(buckets: int):
    """For the buckets of a partition, in order: of equal digests all but the earliest are repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        bucket, out = None, {}
        for b in batches:
            for k, x in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if k != bucket:
                    _settle_digests(held, out)
                    held, bucket = [], k
                held.append(x)
        _settle_digests(held, out)
        yield letters({d: [np.array(w, "<u4").tobytes()] for d, w in out.items()}, buckets)

    return run


def _settle_digests(held: list[bytes], out: dict[int, list[int]]) -> None:
    if held:
        e = np.frombuffer(b"".join(held), np.uint8).reshape(-1, 28)
        high, low = (np.ascontiguousarray(e[:, i : i + 8]).view("<u8").ravel() for i in (0, 8))
        doc, start = np.ascontiguousarray(e[:, 16:24]).view("<i8").ravel(), np.ascontiguousarray(e[:, 24:]).view("<u4").ravel()
        order = np.lexsort((start, doc, low, high))
        again = order[1:][(high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])]
        for d, s in zip(doc[again].tolist(), start[again].tolist(), strict=True):
            out.setdefault(d, []).extend((s, s))


def repeats(group: list[tuple], length: int, out: dict[int, list[int]]) -> None:
    """``group``: suffixes that share their first K bytes, in order, each with its prefix shared with the one before."""
    classes: dict[tuple[bytes, bytes], tuple] = {}
    rank: list[tuple] = []
    for shared, own, left, doc, p, a, z in group:
        was = classes.get((own, left))
        if was is None:
            classes[own, left] = (doc, p, a, z)
        elif was[:2] > (doc, p):
            classes[own, left] = (doc, p, a, z)
            out.setdefault(was[0], []).extend(was[2:])
        else:
            out.setdefault(doc, []).extend((a, z))
    rank = sorted((where, own, left) for (own, left), where in classes.items())
    if len(rank) < 2:
        return
    if len(rank) <= 12:
        for i, ((doc, p, a, z), own, left) in enumerate(rank):
            spans = []
            for (_, q, c, y), other, left2 in rank[:i]:
                # windows begin ``s`` bytes before the anchor: what both own, what agrees behind, what agrees before
                right = common(own, other, 8 + K) - 8
                lo, hi = max(p - z, q - y, length - right), min(p - a, q - c)
                if lo <= hi:
                    before = common(left[::-1], left2[::-1], 0)
                    hi = min(hi, before)
                    if lo <= hi:
                        spans += (p - hi, p - lo)
            if spans:
                out.setdefault(doc, []).extend(spans)
        return
    seen: set[tuple[int, bytes]] = set()
    for (doc, p, a, z), own, left in rank:  # earliest first
        text, hit = left + own[8:], []
        for j in range(z - a + 1):
            key = (p - a - j, text[j : j + length])
            if key in seen:
                hit += (a + j, a + j)
            else:
                seen.add(key)
        if hit:
            out.setdefault(doc, []).extend(hit)


def cut(length: int):
    """Per document with repeats: n_removed, n_spans, kept_sha256, kept text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            cols: list[list] = [[], [], [], []]
            for d, t, x in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist(), strict=True):
                w = np.frombuffer(x, "<u4").reshape(-1, 2).astype(np.int64)
                edge = np.zeros(len(t) + 1, np.int32)
                np.add.at(edge, w[:, 0], 1)
                np.add.at(edge, np.minimum(w[:, 1] + length, len(t)), -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
                spans = int((np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1).sum())
                for c, v in zip(cols, (d, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["doc_id", "n_removed", "n_spans", "kept_sha256"])

    return run


def suffix_dedup(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", hot_group: int = HOT_GROUP) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    keyed_rows, names = keyed(docs_of(docs, id_col, text_col))
    rows = keyed_rows.select(F.col("key").alias("doc_id"), "text")
    spark = rows.sparkSession
    base = stage(rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "base")
    size = base.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)
    home = F.col("bucket")
    asked = rows.mapInArrow(fingerprints(buckets, length), SCHEMA)
    told = asked.repartitionById(buckets, home).sortWithinPartitions("bucket").mapInArrow(answer(buckets), SCHEMA)
    wanted = stage(told.repartitionById(buckets, home).mapInArrow(gather, "doc_id long, data binary"), "wanted")
    some = restrict(rows, wanted, "doc_id").join(wanted.hint("merge"), "doc_id").select("doc_id", "text", "data")
    runs = some.mapInArrow(sorted_runs(buckets, length), SCHEMA)
    merged = stage(runs.repartitionById(buckets, home).sortWithinPartitions("bucket").mapInArrow(merge(buckets, length, hot_group), SCHEMA), "merged")
    found, hot = merged.filter("doc_id is null"), merged.filter("doc_id is not null")
    if hot.limit(1).count():
        found = found.unionByName(hot.repartitionById(buckets, home).sortWithinPartitions("bucket").mapInArrow(settle_hot(buckets), SCHEMA))
    windows = stage(found.repartitionById(buckets, home).mapInArrow(gather, "doc_id long, data binary"), "windows")
    cuts = restrict(rows, windows, "doc_id").join(windows.hint("merge"), "doc_id").select("doc_id", "text", "data").mapInArrow(cut(length), "doc_id long, n_removed long, n_spans long, kept_sha256 string")
    out = base.join(cuts, "doc_id", "left")
    if names is not None:
        out = out.withColumnRenamed("doc_id", "key").join(names, "key")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
