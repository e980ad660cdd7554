"""A corpus pipeline of five stages over the operators of graphloom.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's documents. All but the last return the columns of documents; what a stage decides takes effect in its rows.

1. language: documents whose text holds no letters are rejected; ``lang`` is filled where it was null, and stays null where
   no row of the table has a language to learn.
2. exact_dedup: of equal texts the one with the largest doc_id stays.
3. near_dedup: one document of each group of near-duplicates stays (five-word shingles, similarity of 0.8 or more).
4. pii: spans of personal data are replaced by their kind in brackets; n_chars follows.
5. packing: best-fit packing into sequences; returns pieces.

Cases: a null text is rejected by the first stage and is empty for the others; rows of null id are documents of their
own, but of equal texts among them one row stays; of rows equal in id and text the least by its other columns stays;
an id with several texts loses only those that are copies, and stays whole among near-duplicates if any of its rows
stays; extra columns are dropped; an empty table gives an empty result.

All stages run in the same executors, so each begins by having them return the heap that the one before needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import exact, langid, pii
from graphloom.llm.common import MAX_BROADCAST_IDS, join_groups, pick, restrict, stage
from graphloom.llm.minhash import near_dedup
from graphloom.llm.queries import pack_documents
from graphloom.plans.workers import give_back

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    return pick(docs, **{c: c for c in COLUMNS})


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    give_back(spark)
    docs = _documents(docs)
    told = langid.identify(docs, docs, keep=["lang", "source", "n_chars"]).filter("has_letters")
    learned = F.when(F.col("score") > 0, F.col("lang_pred"))  # a score of 0: no model was trained
    return told.select("doc_id", "text", F.coalesce("lang", learned).alias("lang"), "source", "n_chars")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    give_back(spark)
    docs = _documents(docs)
    verdict = exact.exact_dedup(docs)
    gone = stage(verdict.filter("not kept").select("doc_id"), "gone")
    told = gone.count()
    nulls = gone.filter("doc_id is null").count()
    rows = restrict(docs.select("doc_id"), gone, "doc_id").count()
    again = verdict.filter("kept and group_size > 1").groupBy("doc_id", "text_sha256").count().filter("count > 1").limit(1).count()
    if not nulls and rows == told and not again:  # ids tell the rows that go
        return _without(docs, gone)
    return _rows_that_stay(docs, verdict)


def _rows_that_stay(docs: DataFrame, verdict: DataFrame) -> DataFrame:
    """Settles by id and text, for tables whose ids repeat or are null; of rows equal in both the least stays."""

    def key(sha: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), sha).alias("key")

    groups = stage(verdict.groupBy(key(F.col("text_sha256"))).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("size")).filter("kept").drop("kept"), "stay")
    text = F.sha2(F.coalesce("text", F.lit("")), 256)
    rows = join_groups(docs.select(*COLUMNS, key(text)), groups, "key", "size")
    least = rows.filter("size > 1").groupBy("key").agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*")
    return rows.filter("size = 1").select(*COLUMNS).unionByName(least)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    give_back(spark)
    docs = _documents(docs)
    verdict = near_dedup(docs)
    gone = stage(verdict.filter("not kept").select("doc_id").distinct(), "gone")
    stay = stage(restrict(verdict.filter("kept").select("doc_id"), gone, "doc_id"), "stay")
    return _without(docs, gone.join(stay, "doc_id", "left_anti") if stay.limit(1).count() else gone)


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Documents less those whose doc_id is in ``gone``."""
    few = gone.count() <= MAX_BROADCAST_IDS
    return docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    give_back(spark)
    return pii.redacted(_documents(docs), keep=["lang", "source"]).select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    give_back(spark)
    return pack_documents(_documents(docs))


STAGES = [("language", language), ("exact_dedup", exact_dedup), ("near_dedup", near), ("pii", personal_data), ("packing", packing)]

#: SQL can't express language identification, near-duplicates or packing; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
