"""Work lists, resume, presets and configuration."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, fields, replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import ranked

#: Pipelines by preset.
PRESETS = {"4090": 2, "dual4090": 4, "8x5090": 16, "bigpu": 4, "max": 16}


def pipelines(preset: str, override: int | None = None) -> int:
    if preset not in PRESETS:
        raise ValueError(f"unknown preset {preset!r}; there are {sorted(PRESETS)}")
    return override or PRESETS[preset]


def ranges(total: int, parts: int) -> list[tuple[int, int]]:
    """Balanced contiguous ranges [start, end); the first ``total % parts`` have one more."""
    size, more = divmod(total, parts)
    out, at = [], 0
    for i in range(parts):
        out.append((at, at := at + size + (i < more)))
    return out


def assign_ranges(work: DataFrame, parts: int, ord: str = "ord") -> DataFrame:
    """Adds ``pipeline_id`` by balanced ranges in the order of ``ord``, which may have gaps and ties; the rows are numbered by a range
    sort, without a window over the whole table."""
    columns = work.columns
    work = ranked(work, ord, name="_rank")
    total = work.count()
    size, more = divmod(total, parts)
    cut = more * (size + 1)
    o = F.col("_rank")
    upper = F.lit(more) + F.floor((o - cut) / F.lit(max(size, 1)))
    return work.withColumn("pipeline_id", F.when(o < cut, F.floor(o / (size + 1))).otherwise(upper).cast("int")).select(*columns, "pipeline_id")


def valid(chunks: DataFrame) -> DataFrame:
    return chunks.filter(F.coalesce("text", F.lit("")) != "")


def pending(work: DataFrame, completed: DataFrame, key: str | list[str] = "hash_id") -> DataFrame:
    return work.join(completed.select(key).distinct(), key, "left_anti")


def totals(results: DataFrame) -> DataFrame:
    """One row over (pipeline_id, status, processed, total, duration_ms)."""
    minutes = F.max("duration_ms") / 60_000
    return results.agg(F.sum("processed").alias("processed"), F.sum("total").alias("total"), F.count_if(F.col("status") != "ok").alias("failed"), F.when(F.max("duration_ms") > 0, F.bround(F.sum("processed") / minutes, 1)).otherwise(F.lit(0.0)).alias("chunks_per_minute"))


#: Where the settings of nested sections go: (section, key): field.
SECTIONS = {
    ("project", "name"): "name",
    ("paths", "sources"): "input_dir",
    ("paths", "output"): "output_dir",
    ("chunking", "profile"): "profile",
    ("chunking", "max_chunk_size"): "max_chunk_size",
    ("chunking", "min_chunk_size"): "min_chunk_size",
    ("extraction", "cleanup_patterns"): "cleanup",
    ("llm", "url"): "llm_url",
    ("llm", "model"): "llm_model",
    ("llm", "embedding_url"): "embedding_url",
    ("llm", "embedding_model"): "embedding_model",
    ("llm", "embedding_dim"): "embedding_dim",
    ("finetune", "system_prompt"): "system_prompt",
    ("finetune", "strategies"): "strategies",
    ("finetune", "format"): "format",
    ("finetune", "augment"): "augment",
}


def _flat(values: dict) -> dict:
    """Nested sections as fields; empty values leave the defaults."""
    out = {k: v for k, v in values.items() if not isinstance(v, dict) or k == "training"}
    for (section, key), field_name in SECTIONS.items():
        v = (values.get(section) or {}).get(key) if isinstance(values.get(section), dict) else None
        if v not in (None, "", []):
            out[field_name] = v
    finetune = values.get("finetune")
    limits = finetune.get("filters") if isinstance(finetune, dict) else None
    for key in ("min_question_length", "min_answer_length", "max_answer_length", "deduplicate"):
        if isinstance(limits, dict) and limits.get(key) is not None:
            out[key] = limits[key]
    if isinstance(out.get("training"), dict):
        out["training"] = {k: v for k, v in out["training"].items() if v is not None}
    return out


@dataclass
class Config:
    name: str = "project"
    input_dir: str = "input"
    output_dir: str = "output"
    profile: str = "pcg"
    max_chunk_size: int = 4000
    min_chunk_size: int = 100
    pipelines: int = 2
    cleanup: list[str] | None = None
    strategies: list[str] | None = None
    format: str = "openai"
    system_prompt: str | None = None
    min_question_length: int = 10
    min_answer_length: int = 50
    max_answer_length: int = 2000
    deduplicate: bool = True
    llm_url: str | None = None
    llm_model: str | None = None
    embedding_url: str | None = None
    embedding_model: str | None = None
    embedding_dim: int = 768
    augment: int = 0
    seed: int = 0
    training: dict[str, Any] = field(default_factory=lambda: {"epochs": 3, "batch_size": 4, "gradient_accumulation": 4, "learning_rate": 2e-4, "lora_r": 16, "lora_alpha": 16, "save_method": "lora"})

    @classmethod
    def of(cls, values: dict) -> Config:
        if not isinstance(values, dict):
            raise ValueError("a configuration is a mapping")
        values = _flat(values)
        known = {f.name for f in fields(cls)}
        own = {k: v for k, v in values.items() if k in known and v is not None}
        if "training" in own:
            own["training"] = {**cls().training, **own["training"]}
        return cls(**own)

    @classmethod
    def load(cls, path: str) -> Config:
        """YAML where a reader is installed, else JSON. A missing file raises FileNotFoundError."""
        with open(path, encoding="utf-8") as f:
            text = f.read()
        try:
            import yaml

            values = yaml.safe_load(text)
        except ImportError:
            import json

            values = json.loads(text)
        return cls.of(values)

    def override(self, **values) -> Config:
        """Values that are set and known."""
        known = asdict(self)
        return replace(self, **{k: v for k, v in values.items() if v is not None and k in known})

    @property
    def effective_batch(self) -> int:
        return self.training["batch_size"] * self.training["gradient_accumulation"]
