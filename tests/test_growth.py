"""Steps whose cost must not grow faster than their input, or than the paths, pairs or texts that they have to visit."""

import hashlib
import time
import tracemalloc
from collections import defaultdict
from itertools import combinations

import numpy as np

from pyspark.sql import functions as F

from graphloom import catalog
from graphloom.functions import text
from graphloom.functions.digests import md5_heads
from graphloom.operators import augment, chunking, filters, strategies


def test_md5_heads():
    for size in (0, 1, 46, 55, 56, 63, 64, 119, 120, 200):
        texts = np.arange(3 * size, dtype=np.uint8).reshape(3, size)
        assert md5_heads(texts).tolist() == [int.from_bytes(hashlib.md5(t.tobytes()).digest()[:4], "big") for t in texts]


def test_multihop_hashes_paths_where_they_are_made(spark):
    """Names of several lengths, several edges on a pair, edges without a description; most paths never leave their task."""
    names = [f"n{i}" + "é" * (i % 3) for i in range(700)]
    edges = [(n, hub, None if i % 7 == 0 else f"{n} in {hub}") for i, n in enumerate(names) for hub in ("H", "I|", "n1é") if n != hub]
    edges += [("H", n, f"more of {n}") for n in names[::2]] + [("H", "I|", " "), ("H", "H", "itself")]
    df = spark.createDataFrame(edges, "a string, b string, description string")
    said = defaultdict(set)
    for a, b, d in edges:
        said[frozenset((a, b))].add((d or "").strip())
    near = defaultdict(set)
    for a, b, _ in edges:
        if a != b:
            near[a].add(b), near[b].add(a)
    best = {}
    for middle, own in near.items():
        for first, last in combinations(sorted(own, key=str.encode), 2):
            if any(said[frozenset((first, middle))]) or any(said[frozenset((middle, last))]):
                h = hashlib.md5(f"{first}|{middle}|{last}".encode()).hexdigest()
                key = "|".join(sorted((first, middle, last), key=str.encode))
                best[key] = min(best.get(key, ("g",)), (h, first, middle, last))
    want = [list(p[1:]) for p in sorted(best.values())[:50]]
    got = strategies.multihop(strategies.Graph(edges=df), 50, None)
    assert [r.source_entities for r in got.orderBy(F.md5(F.array_join("source_entities", "|"))).collect()] == want
    low = strategies._lowest_paths(df, 50, None, block=64)
    assert 50 <= low.count() < 3000 < len(best)
    assert {(r.h, r.first, r.middle, r.last) for r in low.collect()} >= set(sorted(best.values())[:50])


def _articles(n: int) -> str:
    return "Livre I : A\n\nTITRE I – B\n\n" + "".join(f"Article 100-{i} : C\nLes comptes X doivent etre presentes avec soin dans l'annexe.\n\n" for i in range(n))


def test_ids_of_a_large_chunk_take_time_in_proportion():
    def seconds(n: int) -> float:
        body, at = _articles(n), time.process_time()
        (c,) = chunking.chunk_text(body, chunking.PCG, 10**9, 1)[1:]
        assert c["atomic_ids"] == [f"100-{i}" for i in range(n)]
        return time.process_time() - at

    assert seconds(16_000) < 9 * seconds(4_000)  # 16 times, if each id were sought in the list of those before it


def test_chunks_of_a_long_document_leave_as_they_are_found():
    body = _articles(60_000)
    tracemalloc.start()
    n = sum(len(c["atomic_ids"]) for c in chunking.iter_chunks(body, chunking.PCG, 2000, 100))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 60_000 and peak < 1_000_000 < len(body)  # all chunks of this text take over 5 MB


def test_strip_looks_only_at_the_ends(spark):
    every = [chr(c) for c in range(0x3100) if chr(c).isspace()] + ["᠎", "​", "﻿", "x", "é", "😀"]
    texts = [c + "a" + c + c for c in every] + every + ["", None, " \x1fa b \n", "\n\n", "é 　"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert {r.i: r.s for r in df.select("i", text.strip("t").alias("s")).collect()} == {i: t and t.strip() for i, t in enumerate(texts)}
    long = spark.range(1).select(text.strip(F.repeat(F.lit(" " * 3000 + "x"), 10)).alias("s"))
    at = time.time()
    assert len(spark.range(40).crossJoin(long.hint("broadcast")).select(F.length(text.strip(F.concat(F.col("id").cast("string"), "s"))).alias("n")).collect()) == 40
    assert time.time() - at < 20  # runs of blanks within a text were gone through from each of their places


def test_common_questions_are_judged_where_they_are(spark):
    q = F.when(F.col("id") % 3 == 0, "a very common question").when(F.col("id") % 3 == 1, F.concat(F.lit("Number "), (F.col("id") % 1000).cast("string"), F.lit(" is asked here"))).otherwise("short")
    pairs = spark.range(6000).select(F.col("id").alias("ord"), q.alias("question"), F.repeat(F.lit("long answer "), 10).alias("answer"), F.lit("s").alias("strategy_name"), F.array().cast("array<string>").alias("source_entities"))
    for some in (pairs, pairs.filter("ord % 3 = 0"), pairs.filter("ord < 3"), pairs.filter("ord % 3 = 2"), pairs.filter("ord < 0")):
        want, first = {}, {}
        for r in sorted(some.collect(), key=lambda r: r.ord):
            if len(r.question) < 10:
                want[r.ord] = "question_too_short (5 < 10)"
            else:
                kept = first.setdefault(r.question, r.ord)
                want[r.ord] = None if kept == r.ord else f"duplicate_of:{r.question}"
        got = filters.dedupe_questions(filters.quality_filter(some)).select("ord", "reason").collect()
        assert len(got) == len(want) and {r.ord: r.reason for r in got} == want
    plan = filters.dedupe_questions(filters.quality_filter(pairs.filter("ord % 3 = 0")))._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan and "_n" in plan and "strategy=merge" not in plan


def test_rows_of_a_small_table_are_dealt_over_all_cores(spark, data):
    for made in (catalog._rule_pairs, catalog._entities, catalog._cue_chunks):
        assert made(spark, data).rdd.getNumPartitions() >= 32


def test_an_answer_without_connectors_draws_no_order(monkeypatch):
    drawn = []
    number = augment.Draw.number
    monkeypatch.setattr(augment.Draw, "number", lambda self: drawn.append(0) or number(self))
    draw = augment.Draw("k")
    assert augment.paraphrase_answer("Part hot bolt of type ECONOMY", draw) == "Part hot bolt of type ECONOMY"
    assert not drawn and draw.n == len(augment.CONNECTORS)  # later draws are those that came before
