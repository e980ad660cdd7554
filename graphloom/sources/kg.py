"""Readers of knowledge-graph folders: graph files, vector stores, key-value stores, journals, training records, documents.

Readers return plain tables; ``ord`` is the order in a file where it matters. A folder's single-document JSON files are
read with ``multiLine``; large collections belong in Parquet, which :func:`graphloom.sources.formats.write_graph` writes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean, normalize, split_clean, strip
from ..plans.staging import exists

KEPT = {"entity_name", "entity_type", "description", "source_id", "relation", "weight", "keywords"}
_DATA = "array<struct<_key:string,_VALUE:string>>"


def _attributes(spark: SparkSession, path: str, of: DataFrame) -> DataFrame:
    """``of`` with map ``attrs`` by attribute name; key ids resolve through the few key elements of the file."""
    keys = {r._id: r["_attr.name"] for r in spark.read.format("xml").option("rowTag", "key").schema("_id string, `_attr.name` string").load(path).collect()}
    names = F.create_map(*[F.lit(x) for k, v in keys.items() for x in (k, v)]) if keys else F.create_map().cast("map<string,string>")
    entry = F.transform(F.coalesce("data", F.array().cast(_DATA)), lambda d: F.struct(F.coalesce(F.try_element_at(names, d["_key"]), d["_key"]).alias("k"), F.coalesce(d["_VALUE"], F.lit("")).alias("v")))
    return of.withColumn("attrs", F.map_from_entries(entry))


def _or(name: str, default: str | Column) -> Column:
    return F.coalesce(F.try_element_at("attrs", F.lit(name)), F.lit(default) if isinstance(default, str) else default)


def graphml_nodes(spark: SparkSession, path: str) -> DataFrame:
    """(ord, node_id, name, entity_type, description, sources, attributes); defaults fill what is missing."""
    raw = spark.read.format("xml").option("rowTag", "node").schema(f"_id string, data {_DATA}").load(path).withColumn("ord", F.monotonically_increasing_id())
    n = _attributes(spark, path, raw)
    return n.select("ord", F.col("_id").alias("node_id"), _or("entity_name", F.col("_id")).alias("name"), _or("entity_type", "unknown").alias("entity_type"), _or("description", "").alias("description"), split_clean(_or("source_id", ""), ",").alias("sources"), F.map_filter("attrs", lambda k, v: ~k.isin(*KEPT)).alias("attributes"))


def graphml_edges(spark: SparkSession, path: str) -> DataFrame:
    """(ord, source, target, relation_type, description, weight, keywords, sources): each edge once, from its endpoint that comes first among nodes."""
    raw = spark.read.format("xml").option("rowTag", "edge").schema(f"_source string, _target string, data {_DATA}").load(path).withColumn("ord", F.monotonically_increasing_id())
    e = _attributes(spark, path, raw)
    at = graphml_nodes(spark, path).select("node_id", F.col("ord").alias("at"))
    e = e.join(at.toDF("_source", "x"), "_source", "left").join(at.toDF("_target", "y"), "_target", "left")
    turned = F.coalesce(F.col("x") > F.col("y"), F.lit(False))
    return e.select("ord", F.when(turned, F.col("_target")).otherwise(F.col("_source")).alias("source"), F.when(turned, F.col("_source")).otherwise(F.col("_target")).alias("target"), _or("relation", "related_to").alias("relation_type"), _or("description", "").alias("description"), F.coalesce(F.expr("try_cast(try_element_at(attrs, 'weight') as double)"), F.lit(1.0)).alias("weight"), split_clean(_or("keywords", ""), ",").alias("keywords"), split_clean(_or("source_id", ""), ",").alias("sources"))


def _store(spark: SparkSession, path: str, schema: str) -> DataFrame:
    raw = spark.read.option("multiLine", True).schema(f"data array<struct<{schema}>>").json(path)
    return raw.select(F.posexplode("data").alias("ord", "r")).select(F.col("ord").cast("long"), "r.*")


def vector_entities(spark: SparkSession, path: str, nodes: DataFrame | None = None) -> DataFrame:
    """(ord, entity_id, name, entity_type, descriptions, source_ids): of one name the last record at the first's place."""
    r = _store(spark, path, "__id__:string,entity_name:string,content:string,source_id:string").filter(F.coalesce("entity_name", F.lit("")) != "")
    r = r.groupBy("entity_name").agg(F.max_by(F.struct("__id__", "content", "source_id"), "ord").alias("r"), F.min("ord").alias("ord"))
    after = F.when(F.instr("r.content", "\n") > 0, F.substring_index("r.content", "\n", 1))
    text = F.when(after.isNotNull(), F.substring(F.col("r.content"), F.length(after) + 2, F.length("r.content"))).otherwise(F.lit(""))
    out = r.select("ord", F.col("r.__id__").alias("entity_id"), F.col("entity_name").alias("name"), split_clean(text, "<SEP>").alias("descriptions"), split_clean(F.coalesce("r.source_id", F.lit("")), "<SEP>").alias("source_ids"))
    if nodes is None:
        return out.withColumn("entity_type", F.lit("unknown"))
    return out.join(nodes.select(F.col("node_id").alias("name"), "entity_type"), "name", "left").withColumn("entity_type", F.coalesce("entity_type", F.lit("unknown")))


def vector_relations(spark: SparkSession, path: str) -> DataFrame:
    """(ord, src, tgt, keywords, description, weight): keywords before the first tab; the third line behind it, else the last."""
    r = _store(spark, path, "src_id:string,tgt_id:string,content:string").filter("coalesce(src_id, '') <> '' and coalesce(tgt_id, '') <> '' and coalesce(content, '') <> ''")
    return r.select("ord", F.col("src_id").alias("src"), F.col("tgt_id").alias("tgt"), *relation_content("content"), F.lit(1.0).alias("weight"))


def relation_content(content: str) -> tuple[Column, Column]:
    parts = F.split(F.col(content), "\t", 2)
    tabbed = F.size(parts) > 1
    body = F.split(F.when(tabbed, F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(0))), "\n")
    words = F.when(tabbed, split_clean(F.get(parts, F.lit(0)), ",")).otherwise(F.array().cast("array<string>"))
    return words.alias("keywords"), strip(F.when(F.size(body) > 2, F.get(body, F.lit(2))).otherwise(F.try_element_at(body, F.lit(-1)))).alias("description")


def kv_store(spark: SparkSession, path: str) -> DataFrame:
    """(ord, key, value as JSON text) of a JSON object."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.posexplode(F.from_json("value", "map<string,string>")).alias("ord", "key", "value")).withColumn("ord", F.col("ord").cast("long"))


def kv_chunks(store: DataFrame) -> DataFrame:
    """(ord, chunk_id, content, tokens, full_doc_id, order_index); values that aren't objects or hold little text go."""
    v = store.filter(F.ltrim("value").startswith("{")).withColumn("c", F.from_json("value", "content string, tokens int, full_doc_id string, chunk_order_index int"))
    return v.select("ord", F.col("key").alias("chunk_id"), F.coalesce("c.content", F.lit("")).alias("content"), F.coalesce("c.tokens", F.lit(0)).alias("tokens"), F.coalesce("c.full_doc_id", F.lit("")).alias("full_doc_id"), F.coalesce("c.chunk_order_index", F.lit(0)).alias("order_index")).filter(F.length(strip("content")) >= 10)


def kv_documents(store: DataFrame) -> DataFrame:
    """(ord, doc_id, content): an object's content, or the value itself; empty ones go."""
    text = F.when(F.ltrim("value").startswith("{"), F.get_json_object("value", "$.content")).otherwise(F.col("value"))
    return store.select("ord", F.col("key").alias("doc_id"), text.alias("content")).filter(F.coalesce("content", F.lit("")) != "")


def entity_chunks(store: DataFrame, entities: DataFrame) -> DataFrame:
    """``entities`` with ``chunk_ids``; names that aren't entities are left out."""
    ids = store.select(F.col("key").alias("name"), F.from_json(F.get_json_object("value", "$.chunk_ids"), "array<string>").alias("chunk_ids"))
    return entities.join(ids, "name", "left").withColumn("chunk_ids", F.coalesce("chunk_ids", F.array().cast("array<string>")))


def entity_texts(entities: DataFrame, chunks: DataFrame) -> DataFrame:
    """(name, texts) of the chunks of each entity, in order."""
    ids = entities.select("name", F.posexplode("chunk_ids").alias("pos", "chunk_id"))
    got = ids.join(chunks.select("chunk_id", "content"), "chunk_id").filter("content <> ''")
    return got.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("pos", "content"))).alias("x")).select("name", F.transform("x", lambda x: x["content"]).alias("texts"))


def entities_of_type(entities: DataFrame, kind: str) -> DataFrame:
    return entities.filter(F.col("entity_type") == kind)


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """(name, bytes) of the JSON files of a graph folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"))


def training_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("messages array<struct<role:string,content:string>>").json(path).filter("messages is not null")


SOURCE_BAR = "=" * 60


def text_files(spark: SparkSession, path: str, parse: Callable[[bytes], list[str]] | None = None, glob: str = "*.pdf") -> DataFrame:
    """(path, pages, chars, text) of the files of a folder. ``parse`` gives a file's pages; without one bytes are UTF-8.
    A path that isn't there raises FileNotFoundError, one without files ValueError."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    if not files.select("path").limit(1).count():
        raise ValueError(f"no {glob} in {path}")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            pages = [(parse or (lambda x: [x.decode("utf-8", "replace")]))(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(p) for p in pages], pa.int32()), pa.array(["\n".join(p) for p in pages], pa.string())], ["path", "pages", "raw"])

    out = files.select("path", "content").mapInArrow(run, "path string, pages int, raw string")
    return out.select("path", "pages", clean("raw").alias("text")).withColumn("chars", F.length("text"))


def combine_sources(files: DataFrame, by: list[str] | None = None, name: str = "path", text: str = "text") -> DataFrame:
    """The files in order of name, each under a banner, as one cleaned text (per ``by``)."""
    part = F.concat(F.lit(f"\n\n{SOURCE_BAR}\n# SOURCE: "), F.element_at(F.split(F.col(name), "/"), -1), F.lit(f"\n{SOURCE_BAR}\n\n"), F.col(text))
    rows = F.array_sort(F.collect_list(F.struct(F.col(name).alias("n"), part.alias("t"))))
    return files.groupBy(*(by or [])).agg(normalize(F.array_join(F.transform(rows, lambda r: r["t"]), "\n\n")).alias("text"), F.count(F.lit(1)).alias("files"))

