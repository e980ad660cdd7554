"""Structured documents to ordered, size-bounded chunks.

A profile names line patterns by level. Sections run from one element to the next; a level sets its heading and clears
the levels below; sections are packed greedily. Finding elements needs match offsets of Python's ``re``, so documents are
chunked by ``mapInArrow``, one document at a time; packing of ready pieces is also offered natively.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import context_prefix, hash_id
from ..plans.workers import small


@dataclass
class Profile:
    name: str
    patterns: dict[str, str]
    hierarchy: list[str]
    atomic_units: list[str] = field(default_factory=list)
    split_on: list[str] | None = None

    def __post_init__(self) -> None:
        if self.split_on is None:
            self.split_on = self.hierarchy[1:4] or list(self.hierarchy)
        top = self.hierarchy[0] if self.hierarchy else None
        self.compiled = {k: re.compile(p, re.MULTILINE | (re.IGNORECASE if k == top else 0)) for k, p in self.patterns.items()}
        for k, p in self.compiled.items():
            if p.groups < 1:
                raise ValueError(f"pattern {k!r} has no group for the id")

    def elements(self, text: str) -> Iterator[tuple[int, int, str, str, str]]:
        """(start, end, type, id, title), in order of start; the patterns go through the text side by side, so that no list is kept."""

        def of(k: str, p: re.Pattern) -> Iterator[tuple[int, int, str, str, str]]:
            for m in p.finditer(text):
                yield m.start(), m.end(), k, m[1], (m[2] or "").strip() if p.groups > 1 and m.lastindex and m.lastindex > 1 else ""

        return heapq.merge(*(of(k, p) for k, p in self.compiled.items()), key=lambda e: e[0])

    def sections(self, text: str) -> Iterator[tuple[dict[str, str | None], tuple, str]]:
        """(context, element, content) of each section with content; text before the first element belongs to none."""
        here: dict[str, str | None] = dict.fromkeys(self.hierarchy)
        for e, then in pairwise(chain(self.elements(text), [(len(text), len(text), "", "", "")])):
            if e[2] in here:
                at = self.hierarchy.index(e[2])
                here = {k: (f"{e[3]} - {e[4]}" if j == at else v if j < at else None) for j, (k, v) in enumerate(here.items())}
            content = text[e[0] : then[0]].strip()
            if content:
                yield dict(here), e, content


# The French accounting profile.
PCG = Profile(
    name="pcg",
    patterns={
        "livre": r"^Livre\s+([IVX]+|\d+)\s*[:\-–]?\s*(.+)$",
        "titre": r"^TITRE\s+([IVX]+)\s*[–\-:]\s*(.+)$",
        "chapitre": r"^CHAPITRE\s+([IVX]+)\s*[–\-:]\s*(.+)$",
        "section": r"^Section\s+(\d+)\s*[–\-:]\s*(.+)$",
        "sous_section": r"^Sous-section\s+(\d+)\s*[–\-:]\s*(.+)$",
        "article": r"^Article\s+(\d{3}-\d+(?:-\d+)?)\s*[:\-–]?\s*(.*)$",
        "account_def": r"^(\d{3,5})\s+([A-ZÀÂÄÉÈÊËÏÎÔÙÛÜÇ].+)$",
    },
    hierarchy=["livre", "titre", "chapitre", "section", "sous_section"],
    atomic_units=["article", "account_def"],
    split_on=["titre", "chapitre", "section"],
)
PROFILES = {"pcg": PCG}


def get_profile(name: str) -> Profile:
    if name not in PROFILES:
        raise ValueError(f"unknown profile {name!r}; there are {sorted(PROFILES)}")
    return PROFILES[name]


def chunk_type(ids: list[str]) -> str:
    if not ids:
        return "section"
    return "article" if any("-" in i for i in ids) else "account_group" if any(i.isdigit() for i in ids) else "mixed"


def regroup(parts: list[str], most: int) -> list[list[str]]:
    """Greedy groups of whole parts; separators don't count, and a part over ``most`` stays whole."""
    groups: list[list[str]] = []
    size = 0
    for p in parts:
        if groups and size + len(p) <= most:
            groups[-1].append(p)
            size += len(p)
        else:
            groups.append([p])
            size = len(p)
    return groups


def chunk_text(text: str, profile: Profile, most: int = 4000, least: int = 100) -> list[dict]:
    return list(iter_chunks(text, profile, most, least))


def _packed(text: str, profile: Profile, most: int) -> Iterator[tuple[dict, list[str], list[str]]]:
    """(context, parts, ids) of sections packed greedily, one pack at a time."""
    parts, ids, size, context = [], [], 0, None
    seen: set[str] = set()
    for here, (_, _, kind, own, _), content in profile.sections(text):
        if parts and (kind in profile.split_on or size + len(content) > most):
            yield context, parts, ids
            parts, ids, size, seen = [], [], 0, set()
        parts.append(content)
        size += len(content)
        context = here
        if kind in profile.atomic_units:
            ids.append(own)
            seen.add(own)
        for unit in profile.atomic_units:
            if unit in profile.compiled:
                fresh = [m[1] for m in profile.compiled[unit].finditer(content) if m[1] not in seen]
                ids += fresh
                seen.update(fresh)
    if parts:
        yield context, parts, ids


def iter_chunks(text: str, profile: Profile, most: int = 4000, least: int = 100) -> Iterator[dict]:
    """The chunks of one document. Packed chunks under ``least`` characters are dropped, those over 1.5 * ``most`` are
    split at blank lines. ``chunk_id`` is unique; ``compat_id`` numbers as before splitting and can repeat."""
    given = number = last = 0
    for context, parts, ids in _packed(text, profile, most):
        content = "\n\n".join(parts)
        if len(content) < least:
            continue
        kind, number = chunk_type(ids), number + 1
        pieces = ["\n\n".join(g) for g in regroup(content.split("\n\n"), most)] if len(content) > 1.5 * most else None
        for k, piece in enumerate(pieces or [content]):
            last = given if pieces and k == 0 else number - 1 if not pieces else last + 1
            yield {"chunk_id": f"{profile.name}-{given:04d}", "compat_id": f"{profile.name}-{last:04d}", "_n": last, "chunk_type": kind, "content": piece, "context": [(n, v) for n, v in context.items() if v is not None], "atomic_ids": [] if pieces else ids, "char_count": len(piece)}
            given += 1


#: Characters and rows of chunks that are handed on at once.
OUT_CHARS, OUT_ROWS = 2_000_000, 2000
CHUNK = "chunk_id string, compat_id string, ord int, chunk_type string, content string, context map<string,string>, atomic_ids array<string>, char_count int"


def chunk_documents(docs: DataFrame, profile: Profile, most: int = 4000, least: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per chunk, with the context prefix in ``text`` and the content hash of that in ``hash_id``."""
    kind = dict(docs.dtypes)[id_col]

    def batch(rows: list[tuple[object, int, dict]], id_type: pa.DataType) -> pa.RecordBatch:
        cols = [pa.array([d for d, _, _ in rows], id_type)]
        for n, t in (("chunk_id", pa.string()), ("compat_id", pa.string())):
            cols.append(pa.array([c[n] for _, _, c in rows], t))
        cols.append(pa.array([i for _, i, _ in rows], pa.int32()))
        for n, t in (("chunk_type", pa.string()), ("content", pa.string()), ("context", pa.map_(pa.string(), pa.string())), ("atomic_ids", pa.list_(pa.string())), ("char_count", pa.int32())):
            cols.append(pa.array([c[n] for _, _, c in rows], t))
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "chunk_id", "compat_id", "ord", "chunk_type", "content", "context", "atomic_ids", "char_count"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 1):  # chunks go on as they are found, so that of a long document only its text is held
            rows, held, kind = [], 0, b.column(0).type
            for at in range(b.num_rows):
                d, t = b.column(0)[at].as_py(), b.column(1)[at].as_py()
                for i, c in enumerate(iter_chunks(t or "", profile, most, least)):
                    rows.append((d, i, c))
                    held += c["char_count"]
                    if held > OUT_CHARS or len(rows) >= OUT_ROWS:
                        yield batch(rows, kind)
                        rows, held = [], 0
            if rows:
                yield batch(rows, kind)

    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, {CHUNK}")
    levels = out.withColumns({n: F.col("context")[n] for n in profile.hierarchy})
    return levels.withColumn("text", F.concat(context_prefix(profile.hierarchy), F.col("content"))).withColumn("hash_id", hash_id("text"))


def pack_pieces(pieces: Column | str, most: int) -> Column:
    """Greedy packing of an array of strings, natively: array of (first, last, chars) of the groups, by position.

    The accumulator holds positions and sizes, never text.
    """
    pieces = F.col(pieces) if isinstance(pieces, str) else pieces
    kind = "array<struct<first:int,last:int,chars:int>>"
    sized = F.transform(pieces, lambda s, i: F.struct(i.alias("i"), F.length(s).alias("n")))

    def step(done: Column, s: Column) -> Column:
        new = F.array(F.struct(s["i"].alias("first"), s["i"].alias("last"), s["n"].alias("chars")))
        last = F.try_element_at(done, F.lit(-1))
        longer = F.array(F.struct(last["first"].alias("first"), s["i"].alias("last"), (last["chars"] + s["n"]).alias("chars")))
        fits = F.coalesce(last["chars"] + s["n"] <= most, F.lit(False))
        return F.when(fits, F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), longer)).otherwise(F.concat(done, new))

    return F.aggregate(sized, F.array().cast(kind), lambda done, s: step(done, s).cast(kind))


def token_windows(tokens: Column | str, size: int = 100, overlap: int = 10) -> Column:
    """Array of windows over an array of tokens; each begins ``size - overlap`` behind the one before."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    starts = F.sequence(F.lit(0), F.greatest(F.size(tokens) - 1, F.lit(0)), F.lit(size - overlap))
    return F.transform(starts, lambda s: F.slice(tokens, s + 1, size))
