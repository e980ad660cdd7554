"""Chat formatting with offset-aligned loss masks.

Each conversation becomes one rendered text ``<|im_start|>role<|im_sep|>text<|im_end|>`` per turn, is encoded once with
offsets (each token of a byte-level vocabulary stands for as many bytes as its spelling has characters, so the ids give the
offsets), and its sorted turn spans are intersected with the sorted token spans by binary search: the mask holds, for
each assistant text, the first token that starts in it and the token behind its last. The three control strings are
special entries added to the tokenizer, so that no token straddles a boundary and the mask is exact.

Escaping: one backslash goes between ``<`` and ``|`` where only backslashes stood between them (``<|`` becomes
``<\\|``), in texts and roles; unescaping takes it out again. No control string survives in a text.

Cases: null text or role is empty; rows of a conversation are ordered by turn (null first), then role, then text, so
ties and repeated rows have a defined order; a conversation of null id is one conversation; an empty table gives an
empty result; texts of any length are encoded whole; conversations are encoded in slices of about ``SLICE`` bytes, a longer one
alone. A conversation is one row of the result and so is built in one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begin, module_cache, pick, workers_find_package

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
SLICE = 1_000_000
SCHEMA = "conv_id long, rendered string, token_ids array<int>, token_starts array<int>, token_ends array<int>, loss_mask array<boolean>"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation's text, and the sorted spans of its assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts.append(head + body + END)
        at += len(parts[-1])
    return "".join(parts), spans


def mask(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which tokens lie in a span; spans and tokens are sorted."""
    out = np.zeros(len(starts), bool)
    if spans:
        lo, hi = np.array(spans).T
        for a, b in zip(np.searchsorted(starts, lo, "left"), np.searchsorted(ends, hi, "right"), strict=True):
            out[a:b] = True
    return out


def parse(rendered: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    return [(unescape(r), unescape(t)) for r, t in (turn.split(SEP, 1) for turn in rendered[: -len(END)].removeprefix(START).split(END + START))] if rendered else []


def masked_text(rendered: str, starts: np.ndarray, ends: np.ndarray, masked: np.ndarray) -> str:
    """The text under the mask, unescaped: each run of tokens without a gap is one text."""
    out, k = [], np.flatnonzero(masked)
    for run in np.split(k, np.flatnonzero(starts[k][1:] > ends[k][:-1]) + 1) if len(k) else []:
        out.append(unescape(rendered[int(starts[run[0]]) : int(ends[run[-1]])]))
    return "".join(out)


def tokenizer(vocab: str):
    """The tokenizer with the control strings, and the number of bytes of each id."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import AddedToken, Tokenizer, processors

    cache = module_cache("chat tokenizers")
    if vocab not in cache:
        tok = Tokenizer.from_file(vocab)
        tok.add_special_tokens([AddedToken(x, special=True, normalized=False) for x in (START, SEP, END)])
        tok.post_processor = processors.ByteLevel(trim_offsets=False)
        size = np.zeros(tok.get_vocab_size(with_added_tokens=True), np.int64)
        for token, i in tok.get_vocab(with_added_tokens=True).items():
            size[i] = len(token)
        for i, token in tok.get_added_tokens_decoder().items():
            size[i] = len(token.content.encode())
        cache[vocab] = tok, size
    return cache[vocab]


def offsets(text: str, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and behind-last code point of each token; tokens that share a code point both have it."""
    end = np.cumsum(size[ids])
    start = end - size[ids]
    if not text.isascii():
        point = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80) - 1  # of each byte
        start, end = point[start], point[end - 1] + 1
    return start.astype(np.int32), end.astype(np.int32)


def _slices(whole: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Rows of about ``SLICE`` bytes of text."""
    turns = whole.column(1)
    at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(turns.values.field("text")), 0).to_numpy(zero_copy_only=False))])
    size = np.diff(at[turns.offsets.to_numpy()])
    first, held = 0, 0
    for i, n in enumerate(size.tolist()):
        if i > first and (held + n > SLICE or i - first >= rows):
            yield whole.slice(first, i - first)
            first, held = i, 0
        held += n
    if first < whole.num_rows:
        yield whole.slice(first)


def format_chats(turns: DataFrame, vocab: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: conv_id, rendered text, token ids with offsets (code points), and the loss mask over tokens."""
    workers_find_package(turns.sparkSession)
    rows = pick(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("chat")
        tok, size = tokenizer(vocab)
        for whole in batches:
            for b in _slices(whole):
                done = [render([(t["role"], t["text"]) for t in ts]) for ts in b.column(1).to_pylist()]
                cols: list[list] = [[], [], [], []]
                for (text, spans), e in zip(done, tok.encode_batch_fast([x for x, _ in done], add_special_tokens=False), strict=True):
                    ids = np.array(e.ids, np.int32)
                    starts, ends = offsets(text, ids, size)
                    for c, v in zip(cols, (ids, starts, ends, mask(spans, starts, ends)), strict=True):
                        c.append(v)
                arrays = [b.column(0), pa.array([x for x, _ in done]), *(pa.array(c, pa.list_(pa.int32())) for c in cols[:3]), pa.array(cols[3], pa.list_(pa.bool_()))]
                yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "rendered", "token_ids", "token_starts", "token_ends", "loss_mask"])

    return grouped.mapInArrow(run, SCHEMA)


def digests(formatted: DataFrame) -> DataFrame:
    """Reads the formatted conversations back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            starts, ends, masked = (b.column(b.schema.get_field_index(c)) for c in ("token_starts", "token_ends", "loss_mask"))
            at = [c.offsets.to_numpy() for c in (starts, ends, masked)]
            starts, ends = starts.values.to_numpy(), ends.values.to_numpy()
            for k, conv in enumerate(b.column(0).to_pylist()):
                rendered = b.column(1)[k].as_py()
                x, y, z = (slice(int(o[k]), int(o[k + 1])) for o in at)
                turns = parse(rendered)
                loss = masked_text(rendered, starts[x], ends[y], masked.values[z.start : z.stop].to_numpy(zero_copy_only=False).astype(bool))
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                rows.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(rendered)))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
