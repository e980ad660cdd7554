"""Token counts: a two-tier map-side lookup of pre-token lengths, with no shuffle of pre-tokens.

Tier one is a compact table of the most frequent pre-tokens and their numbers of tokens, made once on the driver from at
most ``SAMPLE_DOCS`` texts, chosen by hash of their id over all files, and broadcast (at most ``TABLE_SIZE`` entries, about
1 MB, at any input size). It only saves work: a pre-token that it lacks is encoded once per worker by the tokenizer's model
and kept in the worker's cache (at most ``CACHE_SIZE`` entries), so no count depends on the sample. Texts of every script
are cut into pre-tokens and use both tiers (see ``words``).

Cases: null text is empty (0 bytes, 0 tokens); a text that holds an added token's string goes whole to the library, which
then counts it as its default does; likewise every text under a vocabulary file whose pre-tokenizer isn't one of the two
that ``words`` knows; texts of any length are counted whole, in parts; equal rows give equal rows; an empty table gives an
empty result.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begin, docs_of, module_cache, slices
from .words import PreTokens, parts

SAMPLE_DOCS, SAMPLE_CHARS, TABLE_SIZE, CACHE_SIZE = 1000, 20_000, 32_768, 400_000
LIMIT = 1024


def load(vocab: str):
    """The tokenizer of this process, single-threaded."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    cache = module_cache("tokenizers")
    if vocab not in cache:
        cache[vocab] = Tokenizer.from_file(vocab)
    return cache[vocab]


def frequent_lengths(docs: DataFrame, vocab: str, sample_docs: int, size: int) -> dict[str, int]:
    """{pre-token: tokens} of the most frequent pre-tokens of a bounded sample, chosen by hash."""
    pre, seen = PreTokens(vocab, load(vocab)), Counter()
    if not pre.known:
        return {}
    share = min(1.0, 1.5 * sample_docs / max(1, docs.count()))
    some = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) <= int(share * (1 << 30)))
    for r in some.select(F.substring("text", 1, SAMPLE_CHARS).alias("text")).limit(sample_docs).collect():
        seen.update(pre.cut(r.text))
    words = sorted(w for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:size])
    return dict(zip(words, map(len, pre.learn(words)), strict=True))


class Tiers(dict):
    """Lengths by pre-token: the broadcast table, behind it the worker's bounded cache, behind it the model."""

    def __init__(self, table: dict[str, int], pre: PreTokens, size: int = CACHE_SIZE):
        super().__init__(table)
        self.pre, self.size, self.second = pre, size, {}

    def __missing__(self, word: str) -> int:
        n = self.second.get(word)
        if n is None:
            if len(self.second) >= self.size:
                self.second.clear()
            n = self.second[word] = len(self.pre.learn([word])[0])
        return n

    def count(self, text: str) -> int:
        if self.pre.whole(text):
            return len(self.pre.tok.encode(text, add_special_tokens=False))
        return sum(sum(map(self.__getitem__, self.pre.cut(p))) for p in parts(text))


def count_tokens(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, sample_docs: int = SAMPLE_DOCS, table_size: int = TABLE_SIZE) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    rows = docs_of(docs, id_col, text_col)
    table = rows.sparkSession.sparkContext.broadcast(frequent_lengths(rows, vocab, sample_docs, table_size))
    run = uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("tokens")
        cache = module_cache("tiers")
        if run not in cache:
            cache.clear()
            cache[run] = Tiers(table.value, PreTokens(vocab, load(vocab)))
        tiers = cache[run]
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            size = [len(t) if t.isascii() else len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array([tiers.count(t) for t in texts], pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    out = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
