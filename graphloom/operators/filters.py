"""Quality filter, deduplication and reports of question-answer pairs (ord, question, answer, strategy_name, source_entities)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import cut_at_sentence, let, question_key, reason_bucket, strip
from ..plans.staging import stage


@dataclass(frozen=True)
class Limits:
    min_question: int = 10
    min_answer: int = 50
    max_answer: int = 2000
    drop_entity_names: bool = True


def quality_filter(pairs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Adds ``reason`` (null: accepted) and cuts long answers. Rules go in order; the first that fails gives the reason. A null
    question or answer is an empty one."""
    empty = F.lit("")

    def verdict(v: Column, bare: Column, cut: Column, said: Column) -> Column:
        q = F.concat(F.lit("question_too_short ("), F.length(v["question"]).cast("string"), F.lit(f" < {limits.min_question})"))
        a = F.concat(F.lit("answer_too_short ("), F.length(bare["answer"]).cast("string"), F.lit(f" < {limits.min_answer})"))
        reason = F.when(F.length(bare["question"]) < limits.min_question, q).when(F.length(bare["answer"]) < limits.min_answer, a).when((bare["question"] == "") | (said == ""), F.lit("empty_content"))
        if limits.drop_entity_names:
            named = F.exists("source_entities", lambda e: F.lower(e) == F.lower(said))
            reason = reason.when(F.coalesce(named, F.lit(False)), F.lit("answer_is_entity_name"))
        return let(reason, lambda r: F.struct(r.alias("reason"), F.when(r.isNull(), cut).otherwise(v["answer"]).alias("answer")))

    def judged(v: Column, bare: Column) -> Column:
        cut = F.when(F.length(bare["answer"]) > limits.max_answer, cut_at_sentence(v["answer"], limits.max_answer, limits.min_answer)).otherwise(v["answer"])
        return let(cut, lambda c: let(strip(c), lambda said: verdict(v, bare, c, said)))

    given = F.struct(F.coalesce("question", empty).alias("question"), F.coalesce("answer", empty).alias("answer"))
    # each text is made once for a row and use; as plain expressions they would be copied into one another
    found = let(given, lambda v: let(F.struct(strip(v["question"]).alias("question"), strip(v["answer"]).alias("answer")), lambda bare: judged(v, bare)))
    out = pairs.withColumn("_v", found)
    return out.withColumns({"question": F.coalesce("question", empty), "answer": F.col("_v.answer"), "reason": F.col("_v.reason")}).drop("_v")


#: A question with at least this share of the accepted pairs joins by broadcast; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 1000


def dedupe_questions(filtered: DataFrame) -> DataFrame:
    """Among the accepted, the first of each normalised question stays; others name the one that was kept. A null question counts
    as an empty one."""
    key = F.coalesce(question_key("question"), F.lit(""))
    accepted = filtered.filter("reason is null").withColumn("_k", key)
    # the first of each question is an aggregate, so that a very common question is combined map-side
    first = stage(accepted.groupBy("_k").agg(F.min("ord").alias("_first"), F.min_by("question", "ord").alias("_q"), F.count(F.lit(1)).alias("_n")), "first")
    pairs, groups = first.agg(F.sum("_n"), F.count(F.lit(1))).first()
    is_hot = F.col("_n") >= max(2, int((pairs or 0) * HOT_SHARE))
    hot = first.filter(is_hot)
    # the rejected and the common ones stay where they are, in one pass
    here = filtered.withColumn("_k", F.when(F.col("reason").isNull(), key)).join(F.broadcast(hot), "_k", "left")
    if hot.count() == groups:
        return _marked(here)
    rest = accepted.join(F.broadcast(hot.select("_k")), "_k", "left_anti").join(first.filter(~is_hot).hint("merge"), "_k")
    return _marked(here.filter("reason is not null or _first is not null")).unionByName(_marked(rest))


def _marked(pairs: DataFrame) -> DataFrame:
    said = F.concat(F.lit("duplicate_of:"), F.substring(F.coalesce("_q", F.lit("")), 1, 60))
    return pairs.withColumn("reason", F.when(F.col("reason").isNotNull(), F.col("reason")).when(F.col("ord") != F.col("_first"), said)).drop("_k", "_first", "_q", "_n")


def strategy_report(judged: DataFrame) -> DataFrame:
    ok = F.count_if(F.col("reason").isNull())
    n = F.count(F.lit(1))
    return judged.groupBy("strategy_name").agg(n.alias("generated"), ok.alias("accepted"), (n - ok).alias("rejected"), F.bround(100.0 * ok / n, 1).alias("acceptance_rate"))


def rejection_reasons(judged: DataFrame) -> DataFrame:
    return judged.filter("reason is not null").groupBy(reason_bucket("reason").alias("reason")).count()


def generation_report(judged: DataFrame, augmented: int = 0) -> DataFrame:
    """One row of totals; the rate leaves augmented pairs out."""
    ok = F.count_if(F.col("reason").isNull())
    n = F.count(F.lit(1))
    return judged.agg(n.alias("generated"), (ok + augmented).alias("accepted"), (n - ok).alias("rejected"), F.lit(augmented).cast("long").alias("augmented"), F.bround(100.0 * ok / F.greatest(n, F.lit(1)), 1).alias("acceptance_rate"))

