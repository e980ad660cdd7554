"""The engine as functions: build a graph from documents, generate pairs from it, prepare training records."""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import providers
from .operators import augment, chunking, filters, graph, merge, strategies
from .plans.control import Config, assign_ranges, pending, totals, valid
from .plans.ranks import ranked
from .plans.staging import delete, exists, stage, write_text
from .sources import formats
from .streaming.journal import Journal

Event = Callable[[str, dict], None]
log = logging.getLogger(__name__)


def extract(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entities, relations) of chunks (ord, text) by the offline extractor."""
    found = stage(providers.mentions(chunks, "ord", "text"), "mentions")
    entities = found.select("ord", "name", F.lit("concept").alias("entity_type"), "description", F.array(F.col("doc_id").cast("string")).alias("sources"))
    return entities, providers.adjacent_relations(found)


def numbered(chunks: DataFrame) -> DataFrame:
    """``chunks`` with ``ord`` counted from 0 over all of them, by document and place: a key of each chunk."""
    return ranked(chunks, "doc_id", "ord", name="_rank").withColumn("ord", F.col("_rank")).select(*chunks.columns)


def _in_order(merged: DataFrame) -> DataFrame:
    """``merged`` with ``ord`` as dense numbers; rows without one come last."""
    return ranked(merged.withColumnRenamed("ord", "_was"), F.col("_was").isNull(), "_was", name="ord").drop("_was")


Extractor = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


def cached_chunks(spark: SparkSession, docs: DataFrame, out: str, config: Config, force: bool = False) -> DataFrame:
    """The numbered chunks of ``docs``, kept under ``out``. They are used again where they were made with the same settings and can be
    read, unless ``force``."""
    path, told = f"{out}/chunks", json.dumps({"profile": config.profile, "max": config.max_chunk_size, "min": config.min_chunk_size})
    if not force and exists(spark, f"{path}.settings"):
        try:
            kept = spark.read.parquet(path)
            if spark.read.text(f"{path}.settings").first()[0] == told and kept.count():
                return kept
        except Exception as e:  # a broken cache is made anew
            log.warning("chunks under %s can't be used: %s", path, e)
    chunks = numbered(valid(chunking.chunk_documents(docs, chunking.get_profile(config.profile), config.max_chunk_size, config.min_chunk_size)))
    chunks.write.mode("overwrite").parquet(path)
    write_text(spark, f"{path}.settings", told)
    return spark.read.parquet(path)


def _completed(spark: SparkSession, out: str) -> DataFrame | None:
    """(hash_id, ord, part) of the chunks whose graphs are kept under ``out``."""
    return spark.read.schema("hash_id string, ord long, part string").parquet(f"{out}/completed") if exists(spark, f"{out}/completed") else None


def extract_range(spark: SparkSession, chunks: DataFrame, out: str, extractor: Extractor) -> int:
    """Extracts the graph of ``chunks`` into a part of its own, then notes its chunks as completed; their number. A part that isn't
    noted is never read, so that a run which broke off leaves nothing half done."""
    part = uuid.uuid4().hex
    entities, relations = extractor(chunks)
    entities.write.parquet(f"{out}/parts/{part}/entities")
    relations.write.parquet(f"{out}/parts/{part}/relations")
    chunks.select("hash_id", F.col("ord").cast("long").alias("ord"), F.lit(part).alias("part")).write.mode("append").parquet(f"{out}/completed")
    return chunks.count()


def build(
    spark: SparkSession, docs: DataFrame, out: str, config: Config = Config(), completed: DataFrame | None = None, on: Event = lambda name, info: None,
    limit: int | None = None, resume: bool = True, force: bool = False, clean: bool = False, skip_merge: bool = False, extractor: Extractor = extract,
) -> tuple[DataFrame, DataFrame] | None:
    """Chunks documents, extracts their graphs in ``config.pipelines`` ranges, merges them, and writes Parquet, a journal and
    ``timing_report.json`` under ``out``; (nodes, edges).

    After each range its chunks are noted as completed and its part of the graph is kept; a later call goes on from there unless
    ``resume`` is false or ``clean`` deletes ``out`` first. ``completed`` (hash_id) are further chunks to skip. A range that fails
    leaves the others to go on. Parts are merged only if every range succeeded and ``skip_merge`` is unset; else the result is None.
    """
    if clean:
        delete(spark, out)
    if not resume:
        delete(spark, f"{out}/completed")
        delete(spark, f"{out}/parts")
    began, journal = time.monotonic(), Journal(spark, f"{out}/journal")
    journal.start("chunking")
    chunks = cached_chunks(spark, docs, out, config, force)
    if limit:
        chunks = chunks.orderBy("ord").limit(limit)
    work = stage(assign_ranges(chunks, config.pipelines), "work")
    journal.complete("chunking", chunks=work.count())
    on("chunked", {"path": f"{out}/chunks"})
    results, done = [], _completed(spark, out)
    if done is not None:
        done = stage(done, "completed")
    for p in range(config.pipelines):
        own, start, error = work.filter(F.col("pipeline_id") == p).drop("pipeline_id"), time.monotonic(), None
        total = own.count()
        todo = own if completed is None else pending(own, completed)
        todo = stage(todo if done is None else pending(todo, done, ["hash_id", "ord"]), "todo")
        skipped, fresh = total - todo.count(), 0
        journal.start(f"extract {p}", total=total, skipped=skipped)
        try:
            fresh = extract_range(spark, todo, out, extractor) if skipped < total else 0
            journal.complete(f"extract {p}", chunks=fresh)
        except Exception as e:
            error = str(e)[:500]
            journal.error(f"extract {p}", error)
        results.append({"id": p, "processed": skipped + fresh, "total": total, "duration_ms": int(1000 * (time.monotonic() - start)), "success": error is None, "error": error})
        on("extracted", results[-1])
    merged = None
    if all(r["success"] for r in results) and not skip_merge:
        journal.start("merge")
        merged = _merge_parts(spark, out)
        journal.complete("merge", nodes=merged[0].count(), edges=merged[1].count())
        on("merged", {"path": f"{out}/graph"})
    took = int(1000 * (time.monotonic() - began))
    rows = spark.createDataFrame([(r["id"], "ok" if r["success"] else "failed", r["processed"], r["total"], r["duration_ms"]) for r in results], "pipeline_id int, status string, processed long, total long, duration_ms long")
    sums = totals(rows).first()
    report = {"project": config.name, "pipelines": config.pipelines, "chunks_total": sums.total, "chunks_processed": sums.processed, "failed": sums.failed, "chunks_per_minute": float(sums.chunks_per_minute), "total_time_ms": took, "total_time_min": round(took / 60_000, 2), "pipeline_results": results, "merged_graph": f"{out}/graph" if merged else None}
    write_text(spark, f"{out}/timing_report.json", json.dumps(report, indent=2))
    return merged


def _merge_parts(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    noted = _completed(spark, out)
    parts = [] if noted is None else [r.part for r in noted.select("part").distinct().orderBy("part").collect()]  # one a range and run
    if parts:
        entities, relations = (spark.read.parquet(*[f"{out}/parts/{p}/{kind}" for p in parts]) for kind in ("entities", "relations"))
    else:
        entities, relations = extract(spark.read.parquet(f"{out}/chunks").limit(0))
    nodes = merge.merge_entities(entities).drop("records")
    edges = merge.collapse_edges(merge.merge_relations(relations))
    nodes, edges = _in_order(merge.placeholder_nodes(nodes, edges)), _in_order(edges)
    formats.write_graph(nodes, edges, f"{out}/graph")
    return spark.read.parquet(f"{out}/graph/nodes"), spark.read.parquet(f"{out}/graph/edges")


def load(spark: SparkSession, path: str) -> strategies.Graph:
    """A graph that :func:`build` has written."""
    nodes, edges = spark.read.parquet(f"{path}/graph/nodes"), spark.read.parquet(f"{path}/graph/edges")
    names = nodes.select("key", "name")
    named = edges.join(names.toDF("a", "src"), "a").join(names.toDF("b", "tgt"), "b")
    return strategies.Graph(
        entities=nodes.select("ord", "name", "entity_type", F.split("description", "<SEP>").alias("descriptions")),
        relations=named.select("ord", "src", "tgt", "description", F.array().cast("array<string>").alias("keywords")),
        edges=named.select(F.col("src").alias("a"), F.col("tgt").alias("b"), "description", "ord"),
        chunks=spark.read.parquet(f"{path}/chunks").select("ord", "chunk_id", F.col("text").alias("content")),
    )


def generate(spark: SparkSession, g: strategies.Graph, out: str, config: Config = Config(), on: Event = lambda name, info: None, completer: Callable[[], providers.Completer] | None = None) -> DataFrame:
    """Pairs by the strategies, filtered, deduplicated, augmented (by a model where ``completer`` makes one) and written with their
    reports; the judged pairs."""
    limits = filters.Limits(config.min_question_length, config.min_answer_length, config.max_answer_length)
    pairs = filters.quality_filter(strategies.generate(g, config.strategies), limits)
    judged = stage(filters.dedupe_questions(pairs) if config.deduplicate else pairs, "judged")
    accepted = judged.filter("reason is null").drop("reason")
    final = augment.augmenter(config.augment, completer, config.seed)(accepted) if config.augment else accepted
    options = {"system": config.system_prompt} if config.system_prompt and config.format == "openai" else {}
    written = formats.write_jsonl(final, f"{out}/pairs_{config.format}", config.format, **options)
    formats.write_rejected(judged, f"{out}/rejected")
    filters.strategy_report(judged).write.mode("overwrite").json(f"{out}/report_by_strategy")
    filters.rejection_reasons(judged).write.mode("overwrite").json(f"{out}/rejection_reasons")
    filters.generation_report(judged, written - accepted.count()).write.mode("overwrite").json(f"{out}/report")
    on("generated", {"pairs": written})
    return judged


def query_local(g: strategies.Graph, question: str, vectors: DataFrame | None = None, k: int = 5) -> DataFrame:
    """The ``k`` entities nearest to a question, with their neighbours: (name, similarity, neighbor, description)."""
    spark = g.entities.sparkSession
    if vectors is None:
        vectors = providers.embed(g.entities.select(F.col("name").alias("vec_id"), F.concat_ws(" ", F.col("name"), F.array_join("descriptions", " ")).alias("text")), "text").drop("text")
    q = spark.createDataFrame([("?", [float(x) for x in providers.hashed_vector(question)])], "vec_id string, embedding array<float>")
    return graph.local_search(vectors, q, g.edges, k).select(F.col("node").alias("name"), "similarity", "neighbor", "description")


def training_set(spark: SparkSession, path: str) -> DataFrame:
    """(text) of training records, rendered by the plain chat template."""
    from .sources.kg import training_records

    return training_records(spark, path).select(formats.render_messages("messages").alias("text"))


def train(spark: SparkSession, records: str, out: str, config: Config = Config(), run: Callable[[str, dict], list[dict]] | None = None, on: Event = lambda name, info: None) -> dict:
    """Renders training records to text under ``out``, has ``run`` train on them, and writes ``training_report.json``.

    ``run`` takes the path of the texts and the training settings and returns the log (step, loss); without one only the set is made.
    """
    began = time.monotonic()
    training_set(spark, records).write.mode("overwrite").text(f"{out}/text")
    size = training_set(spark, records).count()
    on("rendered", {"path": f"{out}/text", "records": size})
    losses = [{"step": x.get("step"), "loss": x["loss"]} for x in (run(f"{out}/text", config.training) if run else []) if "loss" in x]
    took = time.monotonic() - began
    report = {"dataset": records, "dataset_size": size, "duration_s": round(took, 1), "duration_min": round(took / 60, 2), "config": config.training, "effective_batch": config.effective_batch, "output_dir": out, "final_loss": losses[-1]["loss"] if losses else None, "loss_history": losses}
    write_text(spark, f"{out}/training_report.json", json.dumps(report, indent=2, ensure_ascii=False))
    on("trained", report)
    return report
