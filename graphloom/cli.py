"""python -m graphloom.cli build|generate|status|health|train ..."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from . import api
from .functions.providers import ChatService, Echo, EmbeddingService
from .operators.graph import stats
from .plans.control import PRESETS, Config, pipelines
from .streaming import journal


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="graphloom")
    sub = p.add_subparsers(dest="verb", required=True)
    b = sub.add_parser("build", help="documents (Parquet: doc_id, text) to a graph")
    b.add_argument("documents")
    b.add_argument("out")
    b.add_argument("--preset", choices=sorted(PRESETS), default="4090")
    b.add_argument("--pipelines", type=int)
    b.add_argument("--test-chunks", type=int)
    b.add_argument("--clean", action="store_true", help="delete the output first")
    b.add_argument("--force", action="store_true", help="chunk again")
    b.add_argument("--skip-merge", action="store_true")
    g = sub.add_parser("generate", help="a graph to training records")
    g.add_argument("graph")
    g.add_argument("out")
    g.add_argument("--format")
    g.add_argument("--augment", type=int)
    g.add_argument("--strategy", action="append")
    s = sub.add_parser("status")
    s.add_argument("out")
    h = sub.add_parser("health", help="asks the configured services, or the offline ones")
    t = sub.add_parser("train", help="renders training records; training itself runs elsewhere")
    for name, kind in (("epochs", int), ("batch-size", int), ("learning-rate", float), ("lora-r", int)):
        t.add_argument(f"--{name}", type=kind)
    t.add_argument("records")
    t.add_argument("out")
    for x in (b, g, t, h):
        x.add_argument("--config")
    a = p.parse_args(args)
    config = Config.load(a.config) if getattr(a, "config", None) else Config()
    if a.verb == "health":
        services = [ChatService(config.llm_url, config.llm_model or "")] if config.llm_url else [Echo()]
        services += [EmbeddingService(config.embedding_url, config.embedding_model or "")] if config.embedding_url else []
        return 0 if all([s.ping() for s in services]) else 1
    spark = SparkSession.builder.appName("graphloom").getOrCreate()
    if a.verb == "build":
        spark.conf.set("spark.sql.shuffle.partitions", str(max(8, 4 * pipelines(a.preset, a.pipelines))))
        config = config.override(pipelines=pipelines(a.preset, a.pipelines))
        if api.build(spark, spark.read.parquet(a.documents), a.out, config, limit=a.test_chunks, clean=a.clean, force=a.force, skip_merge=a.skip_merge) is None:
            print("not merged")
            return 0 if a.skip_merge else 1
    elif a.verb == "generate":
        config = config.override(format=a.format, augment=a.augment, strategies=a.strategy)
        api.generate(spark, api.load(spark, a.graph), a.out, config)
    elif a.verb == "train":
        own = {"epochs": a.epochs, "batch_size": a.batch_size, "learning_rate": a.learning_rate, "lora_r": a.lora_r}
        config = config.override(training={**config.training, **{k: v for k, v in own.items() if v is not None}})
        print(json.dumps(api.train(spark, a.records, a.out, config)))
        return 0
    if a.verb in ("build", "status"):
        nodes, edges = spark.read.parquet(f"{a.out}/graph/nodes"), spark.read.parquet(f"{a.out}/graph/edges")
        entries = journal.read(spark, f"{a.out}/journal")
        journal.overall(entries).show(truncate=False)
        journal.summary(entries).show(truncate=False)
        stats(nodes, edges).show()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
