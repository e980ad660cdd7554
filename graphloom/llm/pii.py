"""Personal data: exact base patterns, and a skip-chain conditional random field that adds spans.

The field labels the tokens that hold a digit or an ``@`` (others can't be personal data and are fixed as outside), in every
document that has any. Its potentials: features of the token, its run of neighbouring candidates and the words around; chain
edges between candidates that follow each other; skip edges between tokens, or runs of tokens, of one normal form (the same
letters and digits, however far apart and however punctuated); and weaker skip edges between similar tokens (one host, or one
shape with the same ends). So labels agree across a document. Labels are inferred by loopy belief propagation with damping; the
base spans' labels are held fixed. A group of repeated tokens is a ring rather than all pairs, so edges grow with the tokens.

All weights are learned, by pseudo-likelihood, on at most ``train_docs`` documents chosen by hash (a documented bound), in
excerpts around at most 50 candidates each. They are labelled by the base patterns, as are tokens that a pattern takes whole where
they stand alone, and copies of labelled tokens. Each match also teaches in altered writings that the patterns miss, beside its
copy or alone, with the words around shown or hidden.

Tokens of which the field is sure (a marginal of ``SURE`` or more) become spans; neighbours of one label are one span. Base spans
always stay; an added span never overlaps one.

Cases: null text is empty (no spans); texts of any length are scanned whole in linear time; ties are ordered by start,
then kind; equal texts give equal spans, whatever the order of rows or files; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begin, docs_of, pick, slices

KINDS = ["email", "ip", "card", "phone"]
TRAIN_DOCS, SURE = 2000, 0.75
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"

_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = re.compile(rf"{_LOCAL}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match of these starts where a run of digits starts, as it always takes the run's last digit.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LONG_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9]){11}")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches. A later start inside a run of local characters fails if the run's start did, so that only
    runs' starts and the ends of matches are tried, which is linear."""
    out, at = [], 0
    while (at := text.find("@", at)) >= 0:
        lo = out[-1][1] if out else 0
        start = at
        while start > lo and (c := text[start - 1]) and (c.isascii() and c.isalnum() or c in "._%+-"):
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            out.append(m.span())
            at = m.end()
        else:
            at += 1
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    if LONG_DIGITS.search(text):
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                d = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(d) <= 19 and luhn(d):
                    out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(m[0].count, "0123456789")) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


MARK = re.compile(r"[0-9@]")
SPACE = re.compile(r"[\x20\x09-\x0D]")
EDGE_MARKS = ".,;:!?\"'()[]{}<>#*$%&|="
LABELS = 1 + len(KINDS)
LINKS = ("chain", "copy", "like")  # kinds of edges
EDGES = 100_000  # edges whose messages are computed at once


@dataclass
class Tokens:
    """The candidate tokens of a text."""

    spans: list[tuple[int, int]]  # without edge marks
    cores: list[str]
    left: list[str]  # the word before
    near: list[bool]  # whether the next candidate follows at once
    label: np.ndarray  # the base span's label that covers the token (0: none)

    def runs(self) -> list[tuple[int, int]]:
        """Candidates that follow each other at once, as [first, behind the last)."""
        out, first = [], 0
        for i, joined in enumerate(self.near):
            if not joined:
                out.append((first, i + 1))
                first = i + 1
        return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> Tokens:
    """White-space tokens that hold a digit or an @."""
    spans, left, near, end, raw_end = [], [], [], 0, -9
    while m := MARK.search(text, end):
        start = m.start()
        while start > end and text[start - 1] not in " \t\n\x0b\x0c\r":
            start -= 1
        behind = SPACE.search(text, m.end())
        end = behind.start() if behind else len(text)
        raw = text[start:end]
        a, b = start + len(raw) - len(raw.lstrip(EDGE_MARKS)), end - (len(raw) - len(raw.rstrip(EDGE_MARKS)))
        if a >= b:
            continue
        before = text[max(0, start - 24) : start].split()
        if spans:
            near.append(start - raw_end <= 1)
        raw_end = end
        spans.append((a, b))
        left.append(before[-1].strip(EDGE_MARKS).lower()[:12] if before else "^")
    label, k = np.zeros(len(spans), np.int64), 0
    for i, (a, b) in enumerate(spans):
        while k < len(base) and base[k][2] <= a:
            k += 1
        for start, kind, stop in base[k : k + 4]:
            if start < b and stop > a:
                label[i] = kind + 1
                break
    return Tokens(spans, [text[a:b] for a, b in spans], left, [*near, False] if spans else [], label)


def digits_of(core: str) -> str:
    return re.sub(r"[^0-9]", "", core)


def shape(core: str) -> str:
    return re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", "0", core[:200]))[:24]


def is_ip(core: str) -> bool:
    part = core.split(".")
    return len(part) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in part)


class SkipChainCRF:
    """Log-linear potentials over hashed features; see the module's text."""

    BITS, FEATURES = 14, 12

    def __init__(self):
        self.unary = np.zeros((1 << self.BITS, LABELS))
        self.pair = {k: np.zeros((LABELS, LABELS)) for k in LINKS}

    def features(self, t: Tokens) -> np.ndarray:
        mask, rows, forms = (1 << self.BITS) - 1, [], [shape(c) for c in t.cores]
        for first, behind in t.runs():
            whole = digits_of("".join(c[:200] for c in t.cores[first : min(behind, first + 12)]))
            run = f"r{min(len(whole), 20)}{'L' if 12 <= len(whole) <= 19 and luhn(whole) else ''}"
            for i in range(first, behind):
                core, own = t.cores[i], digits_of(t.cores[i][:200])
                valid = "L" if 12 <= len(own) <= 19 and luhn(own) else "I" if is_ip(core) else "-"
                names = (
                    "bias", "s" + forms[i], f"d{min(len(own), 20)}", "c" + core[:1], "b" + (forms[i - 1] if i else "^"), "n" + (forms[i + 1] if i + 1 < len(forms) else "$"),
                    "l" + t.left[i], "@" if "@" in core else "-", "v" + valid, f"v{valid}s{forms[i]}", run, f"{run}s{forms[i]}",
                )
                rows.append([zlib.crc32(x.encode("utf-8", "surrogatepass")) & mask for x in names])
        return np.array(rows, np.int64).reshape(-1, self.FEATURES)

    @staticmethod
    def edges(t: Tokens) -> dict[str, np.ndarray]:
        """Chain edges between candidates that follow each other; rings through tokens, or whole runs, of one normal form
        (letters and digits alone); and rings through similar tokens: one address's host, or one shape with the same first and
        last characters. A ring has as many edges as tokens, however often a form repeats."""
        chain = [(i, i + 1) for i, joined in enumerate(t.near) if joined]
        copies: dict[str, list[tuple[int, int]]] = {}
        alike: dict[str, list[int]] = {}
        for first, behind in t.runs():
            keys = {}
            if behind - first > 1:
                keys[digits_of("".join(t.cores[first:behind]))] = (first, behind)
            for i in range(first, behind):
                core = t.cores[i]
                form = re.sub(r"[^0-9A-Za-z]", "", core).lower()
                keys.setdefault(form, (i, i + 1))
                if form.isdigit() is False and len(own := digits_of(core)) >= 9:  # a number glued to letters
                    keys.setdefault(own, (i, i + 1))
                host = core.rpartition("@")[2].lower() if "@" in core else ""
                alike.setdefault("@" + host if host else f"{re.sub('[0-9]', '0', core[:64])}|{core[:2]}|{core[-2:]}", []).append(i)
            for key, run in keys.items():
                if len(key) >= 6:
                    copies.setdefault(key, []).append(run)
        copy = []
        for runs in copies.values():
            for x, y in [*pairwise(runs), *([(runs[0], runs[-1])] if len(runs) > 2 else [])]:
                n, m = x[1] - x[0], y[1] - y[0]
                copy += [(x[0] + min(j, n - 1), y[0] + min(j, m - 1)) for j in range(max(n, m))]
        like = []
        for k in alike.values():
            like += [*pairwise(k), *([(k[0], k[-1])] if len(k) > 2 else [])]
        same = set(copy)
        return {k: np.array(v, np.int64).reshape(-1, 2) for k, v in (("chain", chain), ("copy", copy), ("like", [e for e in like if e not in same]))}

    def train(self, docs: list[Tokens], epochs: int = 150, rate: float = 1.5, decay: float = 2e-5) -> None:
        """Pseudo-likelihood: each token's label given its features and its neighbours' labels. All weights, those of the skip
        edges too, start at nothing."""
        docs = [t for t in docs if t.cores]
        if not docs:
            return
        x, y, at = np.concatenate([self.features(t) for t in docs]), np.concatenate([t.label for t in docs]), 0
        links: dict[str, list[np.ndarray]] = {k: [] for k in LINKS}
        for t in docs:
            for k, e in self.edges(t).items():
                links[k].append(e + at)
            at += len(t.cores)
        ends = {k: np.concatenate(v) for k, v in links.items()}
        weights = [self.unary, *(self.pair[k] for k in LINKS)]
        order = np.argsort(x.ravel(), kind="stable")
        row, name = order // x.shape[1], x.ravel()[order]
        first = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
        grad2 = [np.full_like(w, 1e-8) for w in weights]
        for _ in range(epochs):
            z = self.unary[x].sum(1)
            for k, e in ends.items():
                np.add.at(z, e[:, 0], self.pair[k][:, y[e[:, 1]]].T)
                np.add.at(z, e[:, 1], self.pair[k][y[e[:, 0]]])
            q = np.exp(z - z.max(1, keepdims=True))
            q /= q.sum(1, keepdims=True)
            q[np.arange(at), y] -= 1
            grads = [np.zeros_like(w) for w in weights]
            grads[0][name[first]] = np.add.reduceat(q[row], first)
            for g, e in zip(grads[1:], ends.values(), strict=True):
                np.add.at(g.T, y[e[:, 1]], q[e[:, 0]])
                np.add.at(g, y[e[:, 0]], q[e[:, 1]])
            for w, g, s in zip(weights, grads, grad2, strict=True):
                g = g / at + decay * w
                s += g * g
                w -= rate * g / np.sqrt(s)

    def infer(self, own: np.ndarray, ends: dict[str, np.ndarray], clamp: np.ndarray, rounds: int = 12, damp: float = 0.3) -> np.ndarray:
        """Marginals by loopy belief propagation over ``own`` potentials; ``clamp`` holds the labels that are known, or -1."""
        own = own.copy()
        known = clamp >= 0
        own[known] = -30.0
        own[known, clamp[known]] = 0.0
        kinds = [k for k in LINKS if len(ends[k])]
        belief = own.copy()
        if kinds:
            src = np.concatenate([x for k in kinds for x in (ends[k][:, 0], ends[k][:, 1])])
            dst = np.concatenate([x for k in kinds for x in (ends[k][:, 1], ends[k][:, 0])])
            back, parts, at = np.zeros(len(src), np.int64), [], 0
            for k in kinds:
                n = len(ends[k])
                back[at : at + n], back[at + n : at + 2 * n] = np.arange(at + n, at + 2 * n), np.arange(at, at + n)
                for lo, w in ((at, self.pair[k]), (at + n, self.pair[k].T)):
                    parts += [(i, min(i + EDGES, lo + n), np.exp(w - w.max()), w.max()) for i in range(lo, lo + n, EDGES)]
                at += 2 * n
            msg = np.zeros((len(src), LABELS))
            for _ in range(rounds):
                new = np.empty_like(msg)
                for lo, hi, w, top in parts:
                    t = belief[src[lo:hi]] - msg[back[lo:hi]]
                    most = t.max(1, keepdims=True)
                    new[lo:hi] = np.log(np.exp(t - most) @ w + 1e-300) + most + top
                new -= new.max(1, keepdims=True)
                msg = damp * msg + (1 - damp) * new
                belief = own.copy()
                np.add.at(belief, dst, msg)
        q = np.exp(belief - belief.max(1, keepdims=True))
        return q / q.sum(1, keepdims=True)

    def marginals(self, t: Tokens, clamp: np.ndarray) -> np.ndarray:
        return self.infer(self.unary[self.features(t)].sum(1), self.edges(t), clamp)


def find_spans(crf: SkipChainCRF | None, text: str, sure: float = SURE) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, base): the base spans and those that the field adds."""
    base = base_spans(text)
    found = [(a, k, b, True) for a, k, b in base]
    if crf is None or not MARK.search(text):
        return found
    t = candidates(text, base)
    free = t.label == 0
    if free.any():
        q = crf.marginals(t, np.where(free, -1, t.label))
        label = np.where(free & (q.max(1) >= sure), q.argmax(1), 0)
        for first, behind in t.runs():  # neighbours of one label are one span
            i = first
            while i < behind:
                k, j = label[i], i + 1
                while j < behind and k > 2 and label[j] == k:
                    if k == 3 and len(digits_of(t.cores[j])) >= 12:
                        break  # a card of its own
                    j += 1
                if k:
                    found.append((t.spans[i][0], int(k) - 1, t.spans[j - 1][1], False))
                i = j
    return sorted(found)


def excerpt(text: str, most: int = 50, around: int = 40) -> str:
    """What lies around at most ``most`` candidates, spread evenly over the whole text."""
    t = candidates(text, [])
    pick = t.spans if len(t.spans) <= most else [t.spans[i * (len(t.spans) - 1) // (most - 1)] for i in range(most)]
    out, at = [], 0
    for a, b in pick:
        lo, hi = max(at, a - around), min(len(text), min(b, a + 100) + around)
        if hi > lo:
            out.append(text[lo:hi] if lo == at else "\n" + text[lo:hi])
            at = hi
    return "".join(out)


def _altered(kind: int, said: str, r: random.Random) -> tuple[str, bool]:
    """A writing of a base match that the patterns miss, and whether it is plain by itself what it is."""
    digits = digits_of(said)
    if kind == 0:
        return r.choice([(said.replace("@", "·"), False), (said.replace(".", "·"), True), (said.replace(".", ""), True)])
    if kind == 1:
        return r.choice([(said.replace(".", "-"), False), (said.replace(".", "·"), True), (f"v{said.replace('.', '_')}", False)])
    if kind == 2:
        four = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return r.choice([(".".join(four), True), ("x" + digits, True), ("/".join(four), True), (f"{digits} {digits}", True)])
    parts = (digits[:-10], digits[-10:-7], digits[-7:-4], digits[-4:])
    return r.choice([(" ".join(x for x in parts if x), False), ("-".join((digits[:-7], digits[-7:-4], digits[-4:])), True), (".".join((digits[:-7], digits[-7:-4], digits[-4:])), True), (digits, False), ("00" + digits, False)])


def lone_spans(t: Tokens) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the tokens without a label that a pattern takes whole where they stand alone."""
    return [(t.spans[i][0], k, t.spans[i][1]) for i in np.flatnonzero(t.label == 0) for a, k, b in base_spans(t.cores[i])[:1] if (a, b) == (0, len(t.cores[i]))]


def as_is(text: str) -> tuple[Tokens, list[tuple[int, int, int]]]:
    """The candidates with the labels to learn, and the spans that have them by the patterns. No base span covering a token doesn't
    mean that it is outside: one that a pattern takes whole where it stands alone, and a copy of a labelled one, have that label."""
    base = base_spans(text)
    said = sorted(base + lone_spans(candidates(text, base)))
    t = candidates(text, said)
    copies = SkipChainCRF.edges(t)["copy"].tolist()
    for a, b in copies + copies[::-1]:
        t.label[a], t.label[b] = t.label[a] or t.label[b], t.label[b] or t.label[a]
    return t, said


def lessons(text: str, seed: int) -> list[Tokens]:
    """Training texts made of one: as it is; with altered copies of its base matches, which keep their labels; with altered
    matches alone, which keep theirs only if they are plain by themselves; each once with the words around hidden, once shown."""
    (own, base), r = as_is(text), random.Random(seed)
    out = [own]
    for a, k, b in base[:3]:
        said = text[a:b]
        before = text[max(0, a - 20) : a].rpartition(" ")[0] + " "
        for shown in ("_ ", before):
            other, plain_by_itself = _altered(k, said, r)
            beside = f"{before}{said} _ {shown}{other} _"
            for whole, at, label in ((beside, beside.rindex(other), k + 1), (f"{shown}{other} _", len(shown), k + 1 if plain_by_itself else 0)):
                t = as_is(whole)[0]
                for i, (x, y) in enumerate(t.spans):
                    if x < at + len(other) and y > at:
                        t.label[i] = label
                out.append(t)
    return out


def train_field(docs: DataFrame, train_docs: int) -> SkipChainCRF:
    """From a bounded choice of documents by hash, each in excerpts, so that no order of rows or files matters."""
    share = min(1.0, 20 * train_docs / max(1, docs.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([excerpt(t) for t in b.column(1).to_pylist()], pa.string())], ["h", "text"])

    some = docs.filter((F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) <= int(share * (1 << 30))) & F.col("text").rlike("[0-9@]"))
    rows = some.select(F.xxhash64("doc_id", "text").alias("h"), "text").mapInArrow(run, "h long, text string").orderBy("h", "text").limit(train_docs).collect()
    crf = SkipChainCRF()
    crf.train([t for r in rows for t in lessons(r.text, r.h & 0xFFFFFFFF)])
    return crf


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS, with_text: bool = False) -> DataFrame:
    """Per document: doc_id, spans array<struct<kind,start,end,base>> in code points, sorted; with_text adds the text."""
    rows = docs_of(docs, id_col, text_col)
    model = rows.sparkSession.sparkContext.broadcast(train_field(rows, train_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("pii")
        crf = model.value
        for b in slices(batches):
            spans = [[{"kind": KINDS[k], "start": a, "end": e, "base": base} for a, k, e, base in find_spans(crf, t)] for t in b.column(1).to_pylist()]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([b.column(0), *([b.column(1)] if with_text else []), pa.array(spans, kind)], ["doc_id", *(["text"] if with_text else []), "spans"])

    return rows.mapInArrow(run, f"doc_id long, {'text string, ' if with_text else ''}spans {SPANS}")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (text), n_spans (all spans)."""

    def said(spans) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: (s["kind"] == kind) & s["base"])).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *map(of_kind, KINDS), F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first decides the kind."""
    out, at = [], 0
    for a, b, kind in sorted(spans):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, text with each span replaced by its kind in brackets, and the columns named in ``keep`` (strings)."""
    rows = docs_of(docs, id_col, text_col)
    model = rows.sparkSession.sparkContext.broadcast(train_field(rows, train_docs))
    extra = {f"x{i}": c for i, c in enumerate(keep)}
    base = pick(docs, doc_id=id_col, text=text_col, **extra).select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("pii")
        crf = model.value
        for b in slices(batches):
            texts = []
            for t in b.column(1).to_pylist():
                spans = find_spans(crf, t)
                texts.append(redact(t, [(a, e, KINDS[k]) for a, k, e, _ in spans]) if spans else t)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), *b.columns[2:]], b.schema.names)

    out = base.mapInArrow(run, "doc_id long, text string" + "".join(f", {x} string" for x in extra))
    return out.select("doc_id", "text", *[F.col(x).alias(c) for x, c in extra.items()])
