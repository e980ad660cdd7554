"""Pluggable services: completion, embedding, extraction. Defaults work offline and repeat exactly.

Calls run per partition and are idempotent by content, so a retried task asks again for the same answers.
"""

from __future__ import annotations

import hashlib
import json
import logging
import re
import time
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


log = logging.getLogger(__name__)


class Completer(Protocol):
    def complete(self, prompt: str, temperature: float | None = None) -> str: ...

    def ping(self) -> bool: ...

    def close(self) -> None: ...


class Echo:
    """The offline completer: no answer."""

    def complete(self, prompt: str, temperature: float | None = None) -> str:
        return ""

    def ping(self) -> bool:
        return True

    def close(self) -> None:
        pass


def _request(url: str, body: dict | None, timeout: float) -> dict:
    data = None if body is None else json.dumps(body).encode()
    with urllib.request.urlopen(urllib.request.Request(url, data, {"Content-Type": "application/json"}), timeout=timeout) as r:
        return json.loads(r.read() or b"{}")


@dataclass
class ChatService:
    """A completer over HTTP, by the widespread chat-completions interface."""

    url: str
    model: str
    temperature: float = 0.0
    most_tokens: int = 1500
    timeout: float = 60.0

    def complete(self, prompt: str, temperature: float | None = None) -> str:
        body = {"model": self.model, "messages": [{"role": "user", "content": prompt}], "temperature": self.temperature if temperature is None else temperature, "max_tokens": self.most_tokens}
        return _request(f"{self.url.rstrip('/')}/chat/completions", body, self.timeout)["choices"][0]["message"]["content"] or ""

    def ping(self) -> bool:
        """Whether the service lists its models and completes a word."""
        try:
            _request(f"{self.url.rstrip('/')}/models", None, self.timeout)
            ChatService(self.url, self.model, most_tokens=5, timeout=self.timeout).complete("ok")
            return True
        except Exception as e:
            log.error("no answer from %s: %s", self.url, e)
            return False

    def close(self) -> None:
        pass


@dataclass
class EmbeddingService:
    """A vector function over HTTP: posts model and prompt, reads ``embedding``."""

    url: str
    model: str
    timeout: float = 60.0

    def __call__(self, text: str) -> np.ndarray:
        return np.asarray(_request(f"{self.url.rstrip('/')}/api/embeddings", {"model": self.model, "prompt": text}, self.timeout)["embedding"], np.float32)

    def ping(self) -> bool:
        """Whether the service has the model, or can fetch it."""
        try:
            names = {m["name"] for m in _request(f"{self.url.rstrip('/')}/api/tags", None, self.timeout).get("models", [])}
            if self.model not in names | {n.split(":")[0] for n in names}:
                _request(f"{self.url.rstrip('/')}/api/pull", {"name": self.model}, 5 * self.timeout)
            return True
        except Exception as e:
            log.error("no answer from %s: %s", self.url, e)
            return False


def with_retries(call: Callable[[], str], tries: int = 3, wait: float = 1.0) -> str:
    """Up to ``tries`` calls, waiting longer each time; then RuntimeError."""
    for k in range(1, tries + 1):
        try:
            return call()
        except Exception as e:
            if k == tries:
                raise RuntimeError(f"no answer after {tries} tries: {e}") from e
            time.sleep(wait * k)
    raise ValueError("tries must be positive")


def complete_batch(completer: Completer, prompts: list[str], at_once: int = 10, tries: int = 3, wait: float = 1.0, temperatures: list[float] | None = None) -> list[str]:
    """Answers in the order of the prompts; a failure is an empty answer."""
    def one(p: str, t: float | None) -> str:
        try:
            return with_retries(lambda: completer.complete(p) if t is None else completer.complete(p, t), tries, wait)
        except RuntimeError as e:
            log.warning("%s", e)
            return ""

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(one, prompts, temperatures or [None] * len(prompts)))


def complete(df: DataFrame, prompt: str, make: Callable[[], Completer] = Echo, at_once: int = 10, temperature: str | None = None, tries: int = 3, wait: float = 1.0) -> DataFrame:
    """``df`` with column ``completion``; one completer per partition, closed at its end. ``temperature`` names a column."""
    kinds = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    at = df.columns.index(prompt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = make()
        try:
            for b in batches:
                heat = b.column(b.schema.names.index(temperature)).to_pylist() if temperature else None
                said = complete_batch(own, [p or "" for p in b.column(at).to_pylist()], at_once, tries, wait, heat)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(said, pa.string())], [*b.schema.names, "completion"])
        finally:
            try:
                own.close()
            except Exception as e:
                log.error("closing failed: %s", e)

    return df.mapInArrow(run, f"{kinds}, completion string")


def parse_reply(reply: Column | str, least: int = 30) -> Column:
    """struct(q, a) of a JSON reply, with or without a code fence; null if it lacks either or the answer is short."""
    r = F.col(reply) if isinstance(reply, str) else reply
    bare = F.regexp_replace(F.trim(r), r"^```[a-zA-Z]*\s*|\s*```$", "")
    parsed = F.from_json(bare, "question string, answer string")
    return F.when((F.coalesce(parsed["question"], F.lit("")) != "") & (F.length(parsed["answer"]) >= least), F.struct(parsed["question"].alias("q"), parsed["answer"].alias("a")))


def hashed_vector(text: str, dim: int = 768) -> np.ndarray:
    """Signed counts of hashed words, at unit length; no words: zeros."""
    v = np.zeros(dim, np.float32)
    for w in re.findall(r"\w+", text.lower()):
        h = int.from_bytes(hashlib.md5(w.encode()).digest()[:8], "little")
        v[h % dim] += 1 if h >> 63 else -1
    n = float(np.linalg.norm(v))
    return v / n if n else v


def embed(df: DataFrame, text: str, vector: Callable[[str], np.ndarray] = hashed_vector, dim: int = 768, tries: int = 3, wait: float = 1.0) -> DataFrame:
    """``df`` with column ``embedding``; a text that fails ``tries`` times gives zeros."""
    kinds = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    at = df.columns.index(text)

    def one(t: str | None) -> np.ndarray:
        try:
            return np.asarray(with_retries(lambda: vector(t or ""), tries, wait), np.float32)
        except RuntimeError as e:
            log.error("%s", e)
            return np.zeros(dim, np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([one(t) for t in b.column(at).to_pylist()], pa.list_(pa.float32()))], [*b.schema.names, "embedding"])

    return df.mapInArrow(run, f"{kinds}, embedding array<float>")


# Fixed value: what the offline extractor takes for an entity: a capital and at least five small letters.
MENTION = r"\p{Lu}\p{Ll}{5,}"


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(ord, doc_id, line, pos, name, description): entity mentions of each line, described by the line. ``ord`` is the struct of
    document, line and place, so that ids and texts may be of any size."""
    lines = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(F.col(text_col), "\n")).alias("line", "description"))
    found = lines.select("doc_id", "line", "description", F.posexplode(F.regexp_extract_all("description", F.lit(MENTION), F.lit(0))).alias("pos", "name"))
    return found.select(F.struct("doc_id", "line", "pos").alias("ord"), "doc_id", "line", "pos", "name", "description")


def adjacent_relations(found: DataFrame) -> DataFrame:
    """Relations between mentions that follow each other in a line."""
    a = found.select("doc_id", "line", "pos", "ord", F.col("name").alias("source"), "description")
    b = found.select("doc_id", "line", (F.col("pos") - 1).alias("pos"), F.col("name").alias("target"))
    return a.join(b, ["doc_id", "line", "pos"]).filter(F.lower("source") != F.lower("target")).select("ord", "source", "target", F.lit("related_to").alias("relation_type"), "description", F.lit(1.0).alias("weight"), F.array(F.col("doc_id").cast("string")).alias("sources"))
