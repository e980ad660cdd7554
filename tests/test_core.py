"""Semantics on small tables: text functions, chunking, merging, graphs, pairs, filters, files, control."""

import json
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom import api
from graphloom.functions import providers, text
from graphloom.operators import augment, chunking, filters, graph, merge, strategies
from graphloom.operators.components import connected_components
from graphloom.plans import control
from graphloom.sources import formats, kg
from graphloom.streaming import journal

LEGAL = """preface dropped

Livre I : Principes generaux

TITRE I – Objet

CHAPITRE I – Champ

Article 111-1 : Le present reglement s'applique aux entites.
Les comptes annuels comprennent
- le bilan
- le compte de resultat et ses notes annexes detaillees

Article 112-1 : On entend par comptabilite un systeme d'organisation de l'information financiere.

TITRE II – Definitions

Article 211-1 : Un actif est un element identifiable du patrimoine qui doit etre evalue avec prudence.

101 Capital social de la societe
"""


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_text(spark):
    assert one(spark, text.strip(F.lit("　\x1c a b \t\n"))) == "a b"
    assert one(spark, text.question_key(F.lit("  Qu'est-ce QUE  ça, é_1 ?"))) == "questce que ça é_1"
    assert one(spark, text.cut_at_sentence(F.lit("aaaa. bbbb. cccc"), 12, 3)) == "aaaa. bbbb."
    assert one(spark, text.cut_at_sentence(F.lit("a. bbbbbbbbbbbbbb"), 8, 5)) == "a. bbbbb"
    assert one(spark, text.cut_to_full_stop(F.lit("x" * 20), 10)) == "x" * 10 + "."
    assert one(spark, text.longest(F.array(F.lit("aa"), F.lit("bbb"), F.lit("ccc")))) == "bbb"
    assert one(spark, text.distinct_ignoring_case(F.array(F.lit("A"), F.lit(" a "), F.lit("b")))) == ["A", "b"]
    assert one(spark, text.replace_first(F.lit("a b a"), "a", "c")) == "c b a"
    assert one(spark, text.context_of(F.lit("[Livre: I - X > Titre: II - Y]\n\nz"))) == "II - Y"
    assert one(spark, text.split_clean(F.lit(" a, ,b "), ",")) == ["a", "b"]
    assert one(spark, text.label(F.lit("z" * 50))) == "z" * 37 + "..."
    assert one(spark, text.embedding_text(F.lit(" \n"))) == "empty"
    assert one(spark, text.reason_bucket(F.lit("too_short (3 < 5)"))) == "too_short"


def test_profile_and_chunks(spark):
    assert chunking.Profile("p", {"a": "^(a)"}, ["a"]).split_on == ["a"]
    assert chunking.Profile("p", {}, ["a", "b", "c", "d", "e"]).split_on == ["b", "c", "d"]
    with pytest.raises(ValueError):
        chunking.get_profile("nope")
    with pytest.raises(ValueError):
        chunking.Profile("p", {"a": "^a"}, ["a"])
    kinds = [e[2] for e in chunking.PCG.elements(LEGAL)]
    assert kinds == ["livre", "titre", "chapitre", "article", "article", "titre", "article", "account_def"]
    chunks = chunking.chunk_text(LEGAL, chunking.PCG, 4000, 50)
    assert [c["atomic_ids"] for c in chunks] == [["111-1", "112-1"], ["211-1", "101"]]
    assert dict(chunks[0]["context"])["titre"] == "I - Objet" and "chapitre" not in dict(chunks[1]["context"])
    assert not chunking.chunk_text(LEGAL, chunking.PCG, 4000, 10_000) and not chunking.chunk_text("plain", chunking.PCG)
    assert "preface" not in "".join(c["content"] for c in chunks)
    small = chunking.chunk_text(LEGAL, chunking.PCG, 120, 20)
    assert len({c["chunk_id"] for c in small}) == len(small)
    df = chunking.chunk_documents(spark.createDataFrame([(1, LEGAL), (2, None)], "doc_id long, text string"), chunking.PCG, 4000, 50)
    assert [r.text[:30] for r in df.orderBy("ord").collect()][1].startswith("[Livre: I - Principes generaux"[:30])


def test_packing_equals_a_loop(spark):
    r = random.Random(1)
    rows = [(i, ["x" * r.randint(0, 50) for _ in range(r.randint(0, 30))]) for i in range(50)]
    got = {x.i: [(g.first, g.last) for g in x.g] for x in spark.createDataFrame(rows, "i int, p array<string>").select("i", chunking.pack_pieces("p", 90).alias("g")).collect()}
    for i, p in rows:
        groups, at = chunking.regroup(p, 90), 0
        want = []
        for g in groups:
            want.append((at, at + len(g) - 1))
            at += len(g)
        assert got[i] == want


def test_merge_is_the_ordered_fold_whatever_the_partitions(spark):
    r = random.Random(2)
    rows = [(i, r.choice(["A", "a ", "B", " b"]), r.choice(["", "t1", "t2"]), "d" * r.randint(0, 9) + str(i % 3), [r.choice("xyz")], {"k": r.choice(["", "v1", "v2"])}) for i in range(200)]
    want = {}
    for _, name, kind, d, s, at in rows:
        e = want.setdefault(name.strip().lower(), {"name": name, "kind": "", "d": "", "s": set(), "k": ""})
        e["kind"] = e["kind"] or kind
        e["d"] = d if len(d) > len(e["d"]) else e["d"]
        e["s"] |= set(s)
        e["k"] = e["k"] or at["k"]
    df = spark.createDataFrame(rows, "ord long, name string, entity_type string, description string, sources array<string>, attributes map<string,string>")
    for parts in (1, 7):
        got = {x.key: {"name": x.name, "kind": x.entity_type, "d": x.description, "s": set(x.sources), "k": x.attributes["k"]} for x in merge.merge_entities(df.repartition(parts)).collect()}
        assert got == want


def test_relations_edges_placeholders(spark):
    rel = spark.createDataFrame([(1, "A", "B", "r", "dd", 1.0, ["x"]), (2, "a", "b", "R", "longer", 3.0, ["y"]), (3, "B", "A", "s", "z", 2.0, [])], "ord long, source string, target string, relation_type string, description string, weight double, sources array<string>")
    m = merge.merge_relations(rel).orderBy("ord").collect()
    assert [(x.source, x.description, x.weight, x.sources) for x in m] == [("A", "longer", 3.0, ["x", "y"]), ("B", "z", 2.0, [])]
    e = merge.collapse_edges(merge.merge_relations(rel)).collect()
    assert [(x.a, x.b, x.relation_key, x.relations) for x in e] == [("a", "b", "s", 2)]
    n = spark.createDataFrame([("a", "A", "t")], "key string, name string, entity_type string")
    assert {(x.key, x.entity_type) for x in merge.placeholder_nodes(n, merge.collapse_edges(merge.merge_relations(rel))).collect()} == {("a", "t"), ("b", "unknown")}


def test_components_and_stats(spark):
    r = random.Random(3)
    edges = [(r.randint(0, 299), r.randint(0, 299)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    label = {x: x for e in edges for x in e}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        label[y] = x
    df = spark.createDataFrame(edges, "a long, b long")
    assert {x.node: x.label for x in connected_components(df).collect()} == {x: find(x) for x in label}
    nodes = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "node string")
    s = graph.stats(nodes, spark.createDataFrame([("a", "b"), ("b", "c")], "a string, b string")).first()
    assert (s.nodes, s.edges, s.connected_components) == (4, 2, 2) and math.isclose(s.density, 1 / 3)
    none = graph.stats(nodes.limit(0), spark.createDataFrame([], "a string, b string")).first()
    assert (none.nodes, none.density, none.connected_components) == (0, 0.0, 0)


def test_simple_paths(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d")], "a string, b string")
    assert {tuple(p.path) for p in graph.simple_paths(e, "a", "d").collect()} == {("a", "c", "d"), ("a", "b", "c", "d")}
    assert graph.simple_paths(e, "a", "a").count() == 0


def test_strategies(spark):
    ents = spark.createDataFrame([(1, "Actif", "concept", ["x" * 40, "y"]), (2, "Passif", "concept", ["z" * 35]), (3, "Bilan", "concept", ["short"])], "ord long, name string, entity_type string, descriptions array<string>")
    rels = spark.createDataFrame([(1, "Actif", "Passif", "too short", ["k"])], "ord long, src string, tgt string, description string, keywords array<string>")
    edges = spark.createDataFrame([("Passif", "Actif", "a long edge description<SEP>more"), ("Actif", "Bilan", "another edge of the graph")], "a string, b string, description string")
    chunks = chunking.chunk_documents(spark.createDataFrame([(1, LEGAL)], "doc_id long, text string"), chunking.PCG, 4000, 50).select("ord", "chunk_id", F.col("text").alias("content"))
    pairs = strategies.generate(strategies.Graph(ents, rels, edges, chunks)).collect()
    by = {}
    for p in pairs:
        by.setdefault(p.strategy_name, []).append(p)
    assert len(by["entity_def"]) == 2 and len(by["comparative"]) == 1 and len(by["multihop"]) == 1
    assert by["relational"][0].answer == "a long edge description (Mots-cles : k)"
    assert {p.metadata["sub_strategy"] for p in by["chunk_qa"]} == {"definition", "article", "rule", "list"}
    assert len(by["hierarchical"]) == 2 and len(by["thematic"]) == 2
    assert strategies.select(["multihop", "nope"]) == ["multihop"]


def test_filter_reasons_and_dedupe(spark):
    rows = [(1, "Short", "a" * 60, ["e"]), (2, "A long question ?", "short", ["e"]), (3, "A long question ?", "b" * 60, ["e"]), (4, "a LONG question", "c" * 60, ["e"]), (5, "Another long question", "E" * 55, ["e" * 55]), (6, "What about a long one?", "First sentence is quite long and has more than fifty characters. " + "x" * 100, ["e"])]
    df = spark.createDataFrame([(*r[:3], "s", r[3]) for r in rows], "ord long, question string, answer string, strategy_name string, source_entities array<string>")
    j = {r.ord: r for r in filters.dedupe_questions(filters.quality_filter(df, filters.Limits(max_answer=100))).collect()}
    assert j[1].reason == "question_too_short (5 < 10)" and j[2].reason == "answer_too_short (5 < 50)" and j[3].reason is None
    assert j[4].reason == "duplicate_of:A long question ?" and j[5].reason == "answer_is_entity_name"
    assert j[6].reason is None and j[6].answer.endswith("characters.")


def test_augment_repeats_and_varies(spark):
    df = spark.createDataFrame([(1, "Quel est le lien entre A et B dans le PCG ?", "A est lie. Ensuite, B doit suivre.", {"m": "1"})], "ord long, question string, answer string, metadata map<string,string>")
    a = augment.augment(df, 3, 5).collect()
    assert a == augment.augment(df, 3, 5).collect() and a[0].variant == 0 and 1 < len(a) <= 4
    assert len({r.question for r in a}) == len(a) and all(r.metadata["augmented"] == "true" for r in a[1:])
    assert all(isinstance(v, list) and v for v in augment.TERMS.values()) and len(augment.QUESTION_GROUPS) == 12 and len(augment.CONNECTORS) == 10


def test_formats(spark, tmp_path):
    p = spark.createDataFrame([(1, "q", "a", "s", "r")], "ord long, question string, answer string, strategy_name string, reason string")
    assert json.loads(formats.records(p, "openai").first()[0])["messages"][2] == {"role": "assistant", "content": "a"}
    assert json.loads(formats.records(p, "alpaca").first()[0]) == {"instruction": "q", "input": "", "output": "a"}
    assert json.loads(formats.records(p, "sharegpt").first()[0])["conversations"][0] == {"from": "human", "value": "q"}
    with pytest.raises(ValueError):
        formats.records(p, "xml")
    assert formats.write_jsonl(p, f"{tmp_path}/x", "openai", single=True) == 1
    assert kg.training_records(spark, f"{tmp_path}/x").count() == 1
    formats.write_rejected(p, f"{tmp_path}/rej")
    assert spark.read.json(f"{tmp_path}/rej").first().reason == "r"
    assert api.training_set(spark, f"{tmp_path}/x").first().text.endswith("<|assistant|>\na\n")


def test_readers(spark, tmp_path):
    (tmp_path / "e.json").write_text(json.dumps({"data": [{"__id__": "1", "entity_name": "A", "content": "A\nd1<SEP> d2 ", "source_id": "x<SEP>y"}, {"__id__": "2", "entity_name": "", "content": "z"}, {"__id__": "3", "entity_name": "A", "content": "A\nnew", "source_id": ""}]}))
    assert [(r.name, r.descriptions, r.entity_id) for r in kg.vector_entities(spark, str(tmp_path / "e.json")).collect()] == [("A", ["new"], "3")]
    (tmp_path / "r.json").write_text(json.dumps({"data": [{"src_id": "A", "tgt_id": "B", "content": "k1, k2\tA\nB\nsaid\nmore"}, {"src_id": "A", "tgt_id": "B", "content": "only"}, {"src_id": "", "tgt_id": "B", "content": "x"}]}))
    assert [(r.keywords, r.description) for r in kg.vector_relations(spark, str(tmp_path / "r.json")).orderBy("ord").collect()] == [(["k1", "k2"], "said"), ([], "only")]
    (tmp_path / "c.json").write_text(json.dumps({"c1": {"content": "long enough text", "tokens": 3}, "c2": {"content": "short"}, "c3": "no object"}))
    store = kg.kv_store(spark, str(tmp_path / "c.json"))
    assert [(r.chunk_id, r.tokens) for r in kg.kv_chunks(store).collect()] == [("c1", 3)]
    assert {(r.doc_id, r.content) for r in kg.kv_documents(store).collect()} == {("c1", "long enough text"), ("c2", "short"), ("c3", "no object")}
    nodes = spark.createDataFrame([("n1", "N 1", "t", 'a<b>&"c"'), ("n2", "N 2", "t", "")], "key string, name string, entity_type string, description string")
    edges = spark.createDataFrame([("n2", "n1", "r", "d", 2.5)], "a string, b string, relation string, description string, weight double")
    formats.write_graphml(nodes, edges, f"{tmp_path}/g")
    assert {(r.node_id, r.name, r.description) for r in kg.graphml_nodes(spark, f"{tmp_path}/g").collect()} == {("n1", "N 1", 'a<b>&"c"'), ("n2", "N 2", "")}
    assert [(r.source, r.target, r.relation_type, r.weight) for r in kg.graphml_edges(spark, f"{tmp_path}/g").collect()] == [("n1", "n2", "r", 2.5)]
    assert "N 1" in formats.html_view(nodes, edges)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/b.txt").write_text("two\n 7 \nx")
    (tmp_path / "in/a.txt").write_text("one")
    files = kg.text_files(spark, str(tmp_path / "in"), glob="*.txt")
    whole = kg.combine_sources(files).first().text
    assert whole.index("# SOURCE: a.txt") < whole.index("# SOURCE: b.txt") and "two\nx" in whole


def test_control(spark, tmp_path):
    for n, parts in ((9, 3), (10, 3), (5, 1), (3, 5), (0, 3), (17, 4), (7, 2)):
        want = control.ranges(n, parts)
        assert want[-1][1] == n and max(b - a for a, b in want) - min(b - a for a, b in want) <= 1
        got = {r.id: r.pipeline_id for r in control.assign_ranges(spark.range(n), parts, "id").collect()}
        assert got == {i: k for k, (a, b) in enumerate(want) for i in range(a, b)}
    assert control.pipelines("max") == 16 and control.pipelines("max", 3) == 3 and control.pipelines("max", 0) == 16
    c = control.Config.of({"format": "alpaca", "unknown": 1, "training": {"epochs": 9}}).override(seed=4, format=None, nope=1)
    assert (c.format, c.seed, c.training["epochs"], c.effective_batch) == ("alpaca", 4, 9, 16)
    with pytest.raises(FileNotFoundError):
        control.Config.load(str(tmp_path / "none.yaml"))
    with pytest.raises(ValueError):
        control.Config.of([1])


def test_journal(spark, tmp_path):
    j = journal.Journal(spark, f"{tmp_path}/j")
    j.start("p")
    j.progress("p", 1, 0)
    j.error("p", "boom")
    j.complete("p", chunks=2)
    (tmp_path / "j/bad.json").write_text("\nnot json\n")
    s = journal.summary(j.records()).first()
    assert s.started and s.completed and s.errors == 1 and s.duration_ms >= 0 and json.loads(s.details) == {"chunks": 2}
    assert journal.last_state(j.records()).first().completed == ["p"]
    journal.stream_summary(journal.summary(journal.read_stream(spark, f"{tmp_path}/j")), f"{tmp_path}/cp", "js")
    assert spark.table("js").first().errors == 1


def test_providers(spark):
    calls = []

    class Flaky:
        def complete(self, prompt):
            calls.append(prompt)
            if prompt == "bad":
                raise OSError("down")
            return prompt.upper()

        def ping(self):
            return True

        def close(self):
            pass

    assert providers.complete_batch(Flaky(), ["a", "bad", "c"], tries=2, wait=0) == ["A", "", "C"] and calls.count("bad") == 2
    with pytest.raises(RuntimeError):
        providers.with_retries(lambda: 1 / 0, 2, 0)
    assert {r.completion for r in providers.complete(spark.createDataFrame([("x",)], "p string"), "p").collect()} == {""}
    r = spark.createDataFrame([('```json\n{"question": "q", "answer": "' + "a" * 40 + '"}\n```',), ("no",), ('{"question": "q", "answer": "s"}',)], "r string")
    assert [x.p is not None for x in r.select(providers.parse_reply("r").alias("p")).collect()] == [True, False, False]
    v = providers.embed(spark.createDataFrame([("un actif",), ("",)], "t string"), "t").collect()
    assert math.isclose(sum(x * x for x in v[0].embedding), 1, rel_tol=1e-5) and not any(v[1].embedding)


def test_build_generate_query(spark, tmp_path):
    docs = spark.createDataFrame([(1, LEGAL), (2, LEGAL.replace("111", "311").replace("Capital", "Reserve"))], "doc_id long, text string")
    nodes, edges = api.build(spark, docs, f"{tmp_path}/kg", control.Config(min_chunk_size=50))
    assert nodes.count() > 5 and edges.count() > 0
    g = api.load(spark, f"{tmp_path}/kg")
    judged = api.generate(spark, g, f"{tmp_path}/ft", control.Config(augment=1))
    assert judged.filter("reason is null").count() > 0
    assert spark.read.json(f"{tmp_path}/ft/report").first().accepted > 0
    assert api.query_local(g, "Capital social").count() > 0


def test_build_keys_chunks_of_documents_apart(spark, tmp_path):
    slot = F.abs(F.xxhash64("id")) % (1 << 20)
    a, b = spark.range(10_000).groupBy(slot).agg(F.sort_array(F.collect_list("id")).alias("ids")).filter("size(ids) > 1").first().ids[:2]
    docs = spark.createDataFrame([(a, LEGAL), (b, LEGAL.replace("111", "311").replace("Capital", "Reserve"))], "doc_id long, text string")
    api.build(spark, docs, f"{tmp_path}/kg", control.Config(min_chunk_size=50))
    ords = [r.ord for r in spark.read.parquet(f"{tmp_path}/kg/chunks").orderBy("doc_id", "ord").collect()]
    assert ords == list(range(len(ords))) and len(ords) > 2


def test_cosine_top_k_in_blocks(spark):
    r = random.Random(5)
    v = spark.createDataFrame([(i, [r.random() - 0.5 for _ in range(4)]) for i in range(60)], "vec_id long, embedding array<float>").cache()
    whole = sorted(map(tuple, graph.cosine_top_k(v, v, 3).collect()))
    assert sorted(map(tuple, graph.cosine_top_k(v, v, 3, block=25).collect())) == whole and len(whole) == 180
    few = v.limit(2)
    many = spark.range(10_001).crossJoin(v.limit(1).select("embedding")).withColumnRenamed("id", "vec_id")
    assert graph.cosine_top_k(few, many, 1).count() == 10_001


# wrong results that must not come back ------------------------------------------------------------


def test_null_pairs_are_empty_ones(spark):
    long = "An answer that is long enough to be accepted by the rule on lengths."
    rows = [(1, None, long), (2, "A question long enough?", None), (3, None, None), (4, "A question long enough?", long), (5, "a question LONG enough", long)]
    pairs = spark.createDataFrame([(*r, "s", None) for r in rows], "ord long, question string, answer string, strategy_name string, source_entities array<string>")
    got = {r.ord: r.reason for r in filters.dedupe_questions(filters.quality_filter(pairs)).collect()}
    assert len(got) == 5 and got[4] is None and got[5].startswith("duplicate_of:")
    assert got[1].startswith("question_too_short (0") and got[2].startswith("answer_too_short (0") and got[3].startswith("question_too_short")
    kept = filters.dedupe_questions(spark.createDataFrame([(1, None, "x", None), (2, None, "y", None)], "ord long, question string, answer string, reason string"))
    assert sorted(r.reason or "" for r in kept.collect()) == ["", "duplicate_of:"]


def test_mentions_take_any_id(spark):
    docs = spark.createDataFrame([(2**62, "Capital Reserve Capital\nBonjour Reserve"), (2**62 + 1, "Reserve Capital")], "doc_id long, text string")
    found = providers.mentions(docs)
    e = {r.key: r for r in merge.merge_entities(found.select("ord", "name", F.lit("c").alias("entity_type"), "description", F.array(F.col("doc_id").cast("string")).alias("sources"))).collect()}
    assert e["capital"].records == 3 and len(e["capital"].sources) == 2 and e["capital"].description == "Capital Reserve Capital"
    assert {(r.source, r.target) for r in providers.adjacent_relations(found).collect()} == {("Capital", "Reserve"), ("Reserve", "Capital"), ("Bonjour", "Reserve")}


def test_ranges_of_sparse_keys(spark):
    for keys, parts, want in ((range(9), 3, [3, 3, 3]), ([10**9 * k for k in range(10)], 3, [4, 3, 3]), ([5], 5, [1]), ([-7, -7, 3], 2, [2, 1]), ([], 3, [])):
        work = spark.createDataFrame([(k,) for k in keys], "ord long")
        got = control.assign_ranges(work, parts).orderBy("ord", "pipeline_id").collect()
        ids = [r.pipeline_id for r in got]
        assert ids == sorted(ids) and [ids.count(i) for i in sorted(set(ids))] == want


def test_graphml_keeps_the_order_of_nodes(spark, tmp_path):
    nodes = spark.createDataFrame([(i, k, k, "t", "d") for i, k in enumerate(["z", "b", "a"])], "ord long, key string, name string, entity_type string, description string")
    edges = spark.createDataFrame([("a", "z", "r", "x", 1.0), ("b", "a", "r", "y", 1.0)], "a string, b string, relation string, description string, weight double")
    formats.write_graphml(nodes, edges, f"{tmp_path}/g")
    assert [r.node_id for r in kg.graphml_nodes(spark, f"{tmp_path}/g").orderBy("ord").collect()] == ["z", "b", "a"]
    assert {(r.source, r.target) for r in kg.graphml_edges(spark, f"{tmp_path}/g").collect()} == {("z", "a"), ("b", "a")}


def test_records_hold_whole_texts(spark):
    long = "word " * 2000
    pairs = spark.createDataFrame([(1, long, long + ".")], "ord long, question string, answer string")
    said = formats.records(pairs, "openai", system="S").first().value
    assert json.loads(said)["messages"] == [{"role": "system", "content": "S"}, {"role": "user", "content": long}, {"role": "assistant", "content": long + "."}]
    assert json.loads(formats.records(pairs, "sharegpt").first().value)["conversations"] == [{"from": "human", "value": long}, {"from": "gpt", "value": long + "."}]


# control ------------------------------------------------------------------------------------------


def legal_docs(spark, n=6):
    return spark.createDataFrame([(i, LEGAL.replace("111", f"{211 + i}")) for i in range(n)], "doc_id long, text string")


def test_build_goes_on_where_it_broke_off(spark, tmp_path):
    out, docs, config = f"{tmp_path}/kg", legal_docs(spark), control.Config(min_chunk_size=50, pipelines=3)
    want = api.build(spark, docs, f"{tmp_path}/whole", config)
    calls = []

    def breaks(chunks):
        calls.append(chunks.count())
        if len(calls) == 2:
            raise OSError("lost")
        return api.extract(chunks)

    assert api.build(spark, docs, out, config, extractor=breaks) is None
    report = json.loads("".join(r.value for r in spark.read.text(f"{out}/timing_report.json", wholetext=True).collect()))
    assert [r["success"] for r in report["pipeline_results"]] == [True, False, True] and report["failed"] == 1 and report["merged_graph"] is None
    assert report["chunks_processed"] == calls[0] + calls[2] and report["pipeline_results"][1]["error"] == "lost"
    status = journal.overall(journal.read(spark, f"{out}/journal")).first()
    assert status.status == "incomplete" and [e.error for e in status.errors] == ["lost"]
    again = []
    nodes, edges = api.build(spark, docs, out, config, extractor=lambda c: again.append(c.count()) or api.extract(c))
    assert again == [calls[1]]
    n = nodes.count()
    for got, own in ((nodes, want[0]), (edges, want[1])):
        columns = [c for c in own.columns if c != "ord"]
        assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, own.select(columns).collect()))
    assert journal.overall(journal.read(spark, f"{out}/journal")).first().status == "complete"
    assert api.build(spark, docs, out, config, extractor=lambda c: 1 / 0)[0].count() == n  # nothing is left to do
    assert api.build(spark, docs, out, config, clean=True, skip_merge=True) is None
    assert journal.overall(journal.read(spark, f"{tmp_path}/kg/journal")).first().errors == []


def test_chunks_are_used_again(spark, tmp_path):
    out, config = f"{tmp_path}/kg", control.Config(min_chunk_size=50)
    first = api.cached_chunks(spark, legal_docs(spark, 2), out, config).count()
    assert api.cached_chunks(spark, legal_docs(spark, 4), out, config).count() == first
    assert api.cached_chunks(spark, legal_docs(spark, 4), out, config, force=True).count() == 2 * first
    assert api.cached_chunks(spark, legal_docs(spark, 2), out, control.Config(min_chunk_size=51)).count() == first
    (tmp_path / "kg" / "chunks" / "part-broken.parquet").write_bytes(b"no parquet")
    assert api.cached_chunks(spark, legal_docs(spark, 2), out, control.Config(min_chunk_size=51)).count() == first


def test_nested_configuration():
    c = control.Config.of({"project": {"name": "p"}, "chunking": {"max_chunk_size": 9, "profile": ""}, "finetune": {"format": "alpaca", "filters": {"min_answer_length": 0, "deduplicate": False}}, "training": {"epochs": 7, "lora_r": None}, "llm": {"url": "http://x", "model": "m"}})
    assert (c.name, c.max_chunk_size, c.profile, c.format, c.min_answer_length, c.deduplicate, c.llm_url) == ("p", 9, "pcg", "alpaca", 0, False, "http://x")
    assert c.training["epochs"] == 7 and c.training["lora_r"] == 16 and control.Config.of({"name": "flat", "pipelines": 5}).pipelines == 5


def test_train_report(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text(json.dumps({"messages": [{"role": "user", "content": "q"}]}) + "\n\n")
    report = api.train(spark, f"{tmp_path}/r.jsonl", f"{tmp_path}/t", control.Config(), lambda path, settings: [{"step": 1, "loss": 2.0}, {"step": 2}, {"step": 3, "loss": 1.5}])
    assert report["dataset_size"] == 1 and report["final_loss"] == 1.5 and len(report["loss_history"]) == 2 and report["effective_batch"] == 16
    assert api.train(spark, f"{tmp_path}/r.jsonl", f"{tmp_path}/u")["final_loss"] is None


def test_augment_by_model(spark):
    class Parrot:
        """Answers by temperature: JSON in a fence, too short, or nothing."""

        def complete(self, prompt, temperature=None):
            if "fail" in prompt:
                raise OSError("down")
            n = round((temperature - 0.8) * 10)
            return ['```json\n{"question": " Autre question ? ", "answer": "Une autre reponse, assez longue pour compter."}\n```', '{"question": "q", "answer": "court"}', "no json"][n]

        def ping(self):
            return True

        def close(self):
            raise OSError("closing fails")

    pairs = spark.createDataFrame([(1, "Question une ?", "Reponse une.", {"k": "v"}), (2, "fail", "Reponse deux.", {})], "ord long, question string, answer string, metadata map<string,string>")
    out, counts = augment.augment_by_model(pairs, 3, Parrot)
    rows = sorted((r.ord, r.variant, r.question, r.metadata.get("augment_method")) for r in out.collect())
    assert rows == [(1, 0, "Question une ?", None), (1, 1, "Autre question ?", "model"), (2, 0, "fail", None)]
    assert counts.first().asDict() == {"originals": 2, "variants": 1, "failed": 3, "attempts": 6}
    assert augment.augmenter(2, Parrot)(pairs).count() == 3 and augment.augmenter(1)(pairs).count() >= 2


def test_embed_tries_again(spark):
    def vector(text):
        if text == "bad":
            raise OSError("down")
        return np.ones(4)

    df = spark.createDataFrame([("ok",), ("bad",), (None,)], "t string")
    assert {r.t: sum(r.embedding) for r in providers.embed(df, "t", vector, 4, wait=0.0).collect()} == {"ok": 4, "bad": 0, None: 4}


def test_services_report_what_fails():
    assert not providers.ChatService("http://127.0.0.1:9", "m", timeout=0.2).ping()
    assert not providers.EmbeddingService("http://127.0.0.1:9", "m", timeout=0.2).ping()


def test_key_value_writer(spark, tmp_path):
    store = spark.createDataFrame([('b "q"', '{"content": "x"}'), ("a", "1")], "key string, value string")
    assert formats.write_kv(store, f"{tmp_path}/kv") == 2
    got = [(r.key, json.loads(r.value)) for r in kg.kv_store(spark, f"{tmp_path}/kv").orderBy("ord").collect()]
    assert got == [("a", 1), ('b "q"', {"content": "x"})]
    assert formats.write_kv(store.limit(0), f"{tmp_path}/none") == 0 and not (tmp_path / "none").exists()


def test_source_folders(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        kg.text_files(spark, f"{tmp_path}/none")
    with pytest.raises(ValueError):
        kg.text_files(spark, str(tmp_path))
    (tmp_path / "kv_store_x.json").write_text("{}")
    (tmp_path / "other.txt").write_text("x")
    assert [tuple(r) for r in kg.file_stats(spark, str(tmp_path)).collect()] == [("kv_store_x.json", 2)]


def test_entity_readers(spark):
    entities = spark.createDataFrame([("A", "concept"), ("B", "data")], "name string, entity_type string")
    assert [r.name for r in kg.entities_of_type(entities, "data").collect()] == ["B"]
    store = spark.createDataFrame([("A", '{"chunk_ids": ["c2", "c1"]}'), ("X", '{"chunk_ids": ["c1"]}')], "key string, value string")
    linked = kg.entity_chunks(store, entities)
    assert {r.name: r.chunk_ids for r in linked.collect()} == {"A": ["c2", "c1"], "B": []}
    chunks = spark.createDataFrame([("c1", "one"), ("c2", "two"), ("c3", "")], "chunk_id string, content string")
    assert [tuple(r) for r in kg.entity_texts(linked, chunks).collect()] == [("A", ["two", "one"])]


def test_view(spark):
    nodes = spark.createDataFrame([("a", "A" * 50, "concept", "first<SEP>second"), ("b", "<B>", "odd", "x" * 400)], "key string, name string, entity_type string, description string")
    edges = spark.createDataFrame([("a", "b", 9.0, "said")], "a string, b string, weight double, description string")
    shown = {r.node: r for r in formats.view_nodes(nodes, edges).collect()}
    assert shown["a"].label == "A" * 37 + "..." and shown["a"].color == "#7c3aed" and shown["b"].color == "#6b7280" and "first" in shown["a"].title and "second" not in shown["a"].title
    assert shown["b"].title.endswith("x" * 300 + "...") and formats.view_edges(edges, formats.view_nodes(nodes, edges)).first().width == 5.0
    page = formats.html_view(nodes, edges)
    assert page.count("<circle") == 2 and page.count("<line") == 1 and "&lt;B&gt;" in page and "2 types" in page


def test_windows_of_a_late_stream(spark, tmp_path):
    """Records behind the watermark are dropped by a stream; the summary of what came is right."""
    rows = [("2024-01-01 00:10:00", "a"), ("2024-01-01 05:10:00", "a"), ("2024-01-01 05:20:00", "b")]
    schema = "ts timestamp, kind string"
    for i, batch in enumerate((rows, [("2024-01-01 00:20:00", "a"), ("2024-01-01 07:10:00", "b")], [("2024-01-01 09:00:00", "b")])):
        spark.createDataFrame(batch, "t string, kind string").select(F.to_timestamp("t").alias("ts"), "kind").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        events = spark.readStream.schema(schema).json(f"{tmp_path}/in")
        q = journal.windowed(events, "ts", "1 hour", "1 hour", "kind").select(F.date_format("window.start", "HH").alias("hour"), "kind", "count")
        q.writeStream.outputMode("append").format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert ("00", "a", 1) in got and ("05", "a", 1) in got and ("05", "b", 1) in got and ("00", "a", 2) not in got


def test_nearest_vectors_against_brute_force(spark):
    r = np.random.default_rng(3)
    v = r.normal(size=(700, 5))
    v[10], v[20], v[30] = v[11], 0, v[11] * 2
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)] + [(900, None)], "vec_id long, embedding array<double>").repartition(5)
    got = defaultdict(list)
    for x in graph.cosine_top_k(df, df.filter("vec_id % 100 = 10"), 7).orderBy("query_id", "rank").collect():
        got[x.query_id].append(x.vec_id)
    size = np.linalg.norm(v, axis=1)
    for q, ids in got.items():
        near = np.round(v @ v[q] / np.where(size * size[q] > 0, size * size[q], 1), 12)
        want = sorted((-s, i) for i, s in [*enumerate(near), (900, 0.0)] if i != q)[:7]
        assert ids == [i for _, i in want]
    assert len(got) == 7
