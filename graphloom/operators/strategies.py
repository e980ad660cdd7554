"""Question-answer pairs from a knowledge graph.

A graph is given by tables (see :class:`Graph`); each strategy maps it to pairs (ord, question, answer, strategy_name,
source_entities, metadata). Templates are chosen by a hash of the pair's content, so results repeat. Bounds per type or
per entity are part of what a strategy is: an overview names the first entities only.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.digests import md5_heads
from ..functions.text import choose, context_of, cut_to_full_stop, distinct_ignoring_case, fill, first_description, longest, strip
from ..plans.staging import stage
from ..plans.workers import small
from .graph import adjacency, edge_descriptions

# The questions of each strategy, labels of entity types, and cue phrases.
ENTITY = ["Qu'est-ce que {entity} dans le cadre du PCG ?", "Peux-tu definir {entity} selon le Plan Comptable General ?", "Quelle est la definition de {entity} en comptabilite francaise ?", "Explique le concept de {entity} dans le PCG 2026."]
RELATION = ["Quel est le lien entre {src} et {tgt} dans le PCG ?", "Comment {src} est-il lie a {tgt} en comptabilite ?", "Quelle relation existe entre {src} et {tgt} selon le PCG ?"]
SECTION = ["Que contient la section {section} du PCG ?", "Quel est le contenu de {section} dans le Plan Comptable General ?", "Resume la section {section} du PCG 2026."]
COMPARE = ["Quelle est la difference entre {a} et {b} dans le PCG ?", "Compare {a} et {b} selon le Plan Comptable General.", "En quoi {a} differe-t-il de {b} en comptabilite francaise ?"]
MULTIHOP = "Quel est le lien entre {first} et {last} en passant par {middle} dans le PCG ?"
OVERVIEW, OVERVIEW_ANSWER = "Quels sont les principaux {label} dans le PCG 2026 ?", "Les principaux {label} du PCG 2026 incluent :\n\n"
LINKED, LINKED_ANSWER = "Quels elements sont lies a {entity} dans le PCG ?", "Les elements lies a {entity} dans le PCG sont :\n\n"
TYPE_LABELS = {"concept": "concepts comptables", "content": "sections et contenus", "data": "donnees et references", "method": "methodes comptables", "artifact": "documents et artefacts", "organization": "organisations", "event": "evenements comptables", "location": "localisations"}
DEFINITION = r"(?:(?:on entend par|est defini[e]? comme|designe|constitue|s'entend de|correspond a)\s+(.+?)(?:\.|;|$))"
ARTICLE = r"(?:Art(?:icle)?\.?\s*(\d+[\-\d]*))[\s\-:]+(.+?)(?:\n\n|\Z)"
RULE = r"(?:(?:doivent|doit|sont tenus? de|il est interdit de|ne peuvent? pas|est obligatoire)\s+(.+?)(?:\.|;|$))"
LIST = r"(?:comprennent?|incluent?|sont\s*:)\s*\n((?:\s*[-–•]\s*.+\n?)+)"
SECTION_CONTEXT = r"(?iu)\[(?:Livre|LIVRE)\s*:\s*(.+?)(?:\s*>\s*(?:Titre|TITRE)\s*:\s*(.+?))?(?:\s*>\s*(?:Chapitre|CHAPITRE)\s*:\s*(.+?))?\]"


@dataclass
class Graph:
    """entities (ord, name, entity_type, descriptions array), relations (ord, src, tgt, description, keywords array),
    edges (a, b, description), chunks (ord, chunk_id, content)."""

    entities: DataFrame | None = None
    relations: DataFrame | None = None
    edges: DataFrame | None = None
    chunks: DataFrame | None = None


def _pairs(df: DataFrame, name: str, question: Column, answer: Column, sources: Column, **metadata: Column) -> DataFrame:
    entries = [x for k, v in metadata.items() for x in (F.lit(k), v.cast("string"))]
    meta = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")
    return df.select("ord", question.alias("question"), answer.alias("answer"), F.lit(name).alias("strategy_name"), sources.cast("array<string>").alias("source_entities"), meta.alias("metadata"))


def entity_definitions(g: Graph) -> DataFrame:
    own = distinct_ignoring_case("descriptions")
    e = g.entities.withColumn("n", F.size(own)).withColumn("best", longest(own)).filter(F.length("best") >= 20)
    q = choose("name", [fill(t, entity=F.col("name")) for t in ENTITY])
    return _pairs(e, "entity_def", q, F.col("best"), F.array("name"), entity_type=F.col("entity_type"), desc_count=F.col("n"))


def relations(g: Graph) -> DataFrame:
    r = edge_descriptions(g.relations, g.edges, "src", "tgt") if g.edges is not None else g.relations.withColumn("edge_description", F.lit(None).cast("string"))
    said = F.when(F.length("description") >= 20, F.col("description")).otherwise(F.col("edge_description"))
    r = r.withColumn("said", said).filter(F.length("said") >= 20)
    words = F.array_join("keywords", ", ")
    a = F.when(F.size("keywords") > 0, F.concat("said", F.lit(" (Mots-cles : "), words, F.lit(")"))).otherwise(F.col("said"))
    q = choose(F.concat_ws("|", "src", "tgt"), [fill(t, src=F.col("src"), tgt=F.col("tgt")) for t in RELATION])
    return _pairs(r, "relational", q, a, F.array("src", "tgt"), keywords=words)


def sections(g: Graph) -> DataFrame:
    """The first chunk of each section; a first chunk that is too short hides later ones."""
    parts = [strip(F.regexp_extract("content", SECTION_CONTEXT, i)) for i in (1, 2, 3)]
    c = g.chunks.filter(F.col("content").rlike(SECTION_CONTEXT)).withColumns(dict(zip(("livre", "titre", "chapitre"), parts, strict=True)))
    c = c.withColumn("parts", F.filter(F.array("livre", "titre", "chapitre"), lambda p: p != "")).filter(F.size("parts") > 0).withColumn("section", F.array_join("parts", " > "))
    first = c.groupBy("section").agg(F.min_by(F.struct("ord", "chunk_id", "content", "parts", "livre", "titre", "chapitre"), "ord").alias("c")).select("section", "c.*")
    whole = F.regexp_extract("content", SECTION_CONTEXT, 0)
    body = strip(F.substring(F.col("content"), F.instr("content", whole) + F.length(whole), F.length("content")))
    first = first.withColumn("body", body).filter(F.length("body") >= 50)
    q = choose("section", [fill(t, section=F.col("section")) for t in SECTION])
    return _pairs(first, "hierarchical", q, cut_to_full_stop("body"), F.col("parts"), livre=F.col("livre"), titre=F.col("titre"), chapitre=F.col("chapitre"), chunk_id=F.col("chunk_id"))


def _ranked(df: DataFrame, most: int) -> DataFrame:
    by = Window.partitionBy("entity_type").orderBy("ord")
    return df.withColumn("rn", F.row_number().over(by)).filter(F.col("rn") <= most)


def comparisons(g: Graph, most: int = 30, ahead: int = 3) -> DataFrame:
    """Each of a type's first ``most`` entities with the next ``ahead``; ranks come before the self-join."""
    best = longest(distinct_ignoring_case("descriptions"))
    e = _ranked(g.entities.withColumn("best", best).filter(F.length("best") >= 30), most).select("entity_type", "rn", "ord", "name", "best")
    first = e.withColumn("to", F.explode(F.array(*[F.col("rn") + i for i in range(1, ahead + 1)])))
    other = e.select("entity_type", F.col("rn").alias("to"), F.col("name").alias("name_b"), F.col("best").alias("best_b"))
    p = first.join(other, ["entity_type", "to"]).withColumn("ord", F.col("ord") * (ahead + 1) + F.col("to") - F.col("rn"))
    q = choose(F.concat_ws("|", "name", "name_b"), [fill(t, a=F.col("name"), b=F.col("name_b")) for t in COMPARE])
    a = F.concat("name", F.lit(" : "), "best", F.lit("\n\n"), "name_b", F.lit(" : "), "best_b")
    return _pairs(p, "comparative", q, a, F.array("name", "name_b"), entity_type=F.col("entity_type"))


def multihop(g: Graph, most: int = 200, most_neighbors: int | None = 100) -> DataFrame:
    """At most ``most`` paths of two edges, one per set of nodes, chosen by hash."""
    p = _lowest_paths(g.edges, most, most_neighbors)
    p = edge_descriptions(p, g.edges, "first", "middle").withColumnRenamed("edge_description", "d1")
    p = edge_descriptions(p, g.edges, "middle", "last").withColumnRenamed("edge_description", "d2")
    none = [F.coalesce(d, F.lit("")) == "" for d in ("d1", "d2")]
    # of several edges on a pair those with a description come first, then by it
    p = p.filter(~(none[0] & none[1])).groupBy("key").agg(F.min_by(F.struct("first", "middle", "last", "d1", "d2", "h"), F.struct("h", *none, "d1", "d2")).alias("p")).select("p.*")
    p = p.orderBy("h").limit(most).withColumn("ord", F.conv(F.substring("h", 1, 12), 16, 10).cast("long"))
    a = F.concat_ws(" Ensuite, ", F.when(F.col("d1") != "", F.col("d1")), F.when(F.col("d2") != "", F.col("d2")))
    return _pairs(p, "multihop", fill(MULTIHOP, first=F.col("first"), middle=F.col("middle"), last=F.col("last")), a, F.array("first", "middle", "last"), path_length=F.lit(3), hops=F.lit(2))


def _lowest_paths(edges: DataFrame, most: int, most_neighbors: int | None, block: int = 1000) -> DataFrame:
    """(first, middle, last, h, key): of the paths with a described edge those with the lowest hashes, of ``most`` sets of nodes at
    least, or all paths.

    Every path is hashed, which is quadratic in a hub's neighbours, but only as arrays of bytes in the task that makes it: a hub's
    neighbours are cut into blocks, pairs of blocks are dealt to the tasks evenly, and a path leaves its task only if its hash is
    below a bound that a few thousand of all paths are expected to meet. Where too few sets do, the bound is raised.
    """
    spark = edges.sparkSession
    adj = adjacency(edges.filter("a <> b").select("a", "b", (F.coalesce(first_description("description"), F.lit("")) != "").alias("said")))
    adj = adj.groupBy("node", "neighbor").agg(F.max("said").alias("said"))
    if most_neighbors:
        by = Window.partitionBy("node").orderBy(F.xxhash64("neighbor"), "neighbor")
        adj = adj.withColumn("rn", F.row_number().over(by)).filter(F.col("rn") <= most_neighbors).drop("rn")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("neighbor"))
    blocks = adj.withColumn("block", F.floor((rank - 1) / block)).groupBy("node", "block").agg(F.array_sort(F.collect_list(F.struct("neighbor", "said"))).alias("own"))
    blocks = stage(blocks.select("node", "block", F.col("own.neighbor").alias("names"), F.col("own.said").alias("said")), "blocks")
    hubs = blocks.groupBy("node").agg(F.sum(F.size("names")).cast("double").alias("d"), F.sum(F.size(F.filter("said", lambda s: ~s))).cast("double").alias("u"))
    total = hubs.agg(F.sum(F.expr("d * (d - 1) / 2 - u * (u - 1) / 2"))).first()[0] or 0.0
    left = blocks.select(F.col("node").alias("middle"), F.col("block").alias("i"), F.col("names").alias("x"), F.col("said").alias("x_said"))
    right = blocks.select(F.col("node").alias("middle"), F.col("block").alias("j"), F.col("names").alias("y"), F.col("said").alias("y_said"))
    both = left.join(right, "middle").filter("i <= j").select("middle", (F.col("i") == F.col("j")).alias("same"), "x", "x_said", "y", "y_said")
    both = both.repartition(4 * spark.sparkContext.defaultParallelism)
    share = 12.0 * most / max(total, 1.0)  # a set of nodes has three paths at most
    while True:
        bound = min(2**32 - 1, int(share * 2**32))
        low = both.mapInArrow(_hashed_below(bound), "first string, middle string, last string")
        low = low.withColumns({"h": F.md5(F.concat_ws("|", "first", "middle", "last")), "key": F.array_join(F.array_sort(F.array("first", "middle", "last")), "|")})
        low = stage(low, "paths")
        if bound == 2**32 - 1 or low.select("key").distinct().count() >= most:
            return low
        share *= 8


def _hashed_below(bound: int, most: int = 8192) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of the paths between two blocks of a node's neighbours those whose hash has first 32 bits up to ``bound``."""

    def by_size(names: list[str], said: list[bool]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(bytes of the names, rank, said) of the names of each length."""
        groups: dict[int, list[tuple[bytes, int, bool]]] = {}
        for i, (name, s) in enumerate(zip(names, said, strict=True)):
            groups.setdefault(len(raw := name.encode()), []).append((raw, i, s))
        return [(np.frombuffer(b"".join(r for r, _, _ in g), np.uint8).reshape(len(g), n), np.array([i for _, i, _ in g]), np.array([s for _, _, s in g])) for n, g in groups.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: list[tuple[str, str, str]] = []
            for middle, same, x, x_said, y, y_said in zip(*(c.to_pylist() for c in b.columns), strict=True):
                hub = np.frombuffer(f"|{middle}|".encode(), np.uint8)
                for (xb, xi, xs), (yb, yi, ys) in product(by_size(x, x_said), by_size(y, y_said)):
                    step = max(1, most // len(yi))
                    for at in range(0, len(xi), step):
                        part = slice(at, at + step)
                        wanted = xs[part, None] | ys
                        if same:
                            wanted &= xi[part, None] < yi
                        i, j = np.nonzero(wanted)
                        if len(i):
                            texts = np.hstack([xb[part][i], np.broadcast_to(hub, (len(i), len(hub))), yb[j]])
                            found += [(x[xi[at + i[k]]], middle, y[yi[j[k]]]) for k in np.flatnonzero(md5_heads(texts) <= bound).tolist()]
            cols = list(zip(*found, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], ["first", "middle", "last"])

    return run


def chunk_questions(g: Graph) -> DataFrame:
    """Definitions, articles, rules and lists found by cue phrases, whose places in the text matter."""
    one, dot = re.IGNORECASE | re.MULTILINE, re.IGNORECASE | re.DOTALL
    definition, article, rule, listing = re.compile(DEFINITION, one), re.compile(ARTICLE, dot), re.compile(RULE, one), re.compile(LIST, re.IGNORECASE)

    def found(text: str, context: str) -> Iterator[tuple[str, str, list[str], str, str]]:
        for m in definition.finditer(text):
            if len(said := m[0].strip()) >= 30:
                subject = text[max(0, m.start() - 100) : m.start()].strip().rsplit("\n", 1)[-1].strip()
                subject = subject if len(subject) >= 3 else context or "ce concept"
                yield f"Comment est defini(e) {subject} dans le PCG ?", said, [subject], "definition", ""
        for m in article.finditer(text):
            if len(said := m[2].strip()) >= 50:
                number = m[1].strip()
                yield f"Que dit l'article {number} du PCG ?", said, [f"Article {number}"], "article", number
        for m in rule.finditer(text):
            if len(said := m[0].strip()) >= 30:
                yield f"Quelle obligation est prevue par le PCG concernant {context or 'cette disposition'} ?", said, [], "rule", ""
        for m in listing.finditer(text):
            if len(said := m[0].strip()) >= 50:
                subject = text[max(0, m.start() - 150) : m.start()].strip().rsplit(".", 1)[-1].strip() or context or "ces elements"
                yield f"Quels sont les elements qui {subject} selon le PCG ?", said, [], "list", ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 2):
            rows = [(o, i, c, *f) for o, c, t, x in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True) for i, f in enumerate(found(t, x))]
            cols = list(zip(*rows, strict=True)) or [[]] * 8
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["o", "i", "chunk_id", "question", "answer", "sources", "kind", "article"])

    c = g.chunks.filter(F.length("content") >= 50).select(F.col("ord").cast("long"), F.col("chunk_id").cast("string"), "content", F.coalesce(context_of("content"), F.lit("")).alias("context"))
    f = c.mapInArrow(run, "o long, i int, chunk_id string, question string, answer string, sources array<string>, kind string, article string")
    f = f.withColumn("ord", F.col("o") * 10_000 + F.col("i"))
    return _pairs(f, "chunk_qa", F.col("question"), F.col("answer"), F.col("sources"), sub_strategy=F.col("kind"), article=F.col("article"), chunk_id=F.col("chunk_id"))


def _type_label() -> Column:
    out = None
    for k, v in TYPE_LABELS.items():
        out = F.when(F.col("entity_type") == k, v) if out is None else out.when(F.col("entity_type") == k, v)
    return out.otherwise(F.col("entity_type"))


def overviews(g: Graph) -> DataFrame:
    e = g.entities.filter("entity_type <> '' and entity_type <> 'UNKNOWN'")
    counts = e.groupBy("entity_type").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    top = _ranked(e.withColumn("said", F.try_element_at(distinct_ignoring_case("descriptions"), F.lit(1))), 20)
    line = F.when((F.col("rn") <= 10) & F.col("said").isNotNull(), F.concat(F.lit("- "), "name", F.lit(" : "), "said"))
    t = top.groupBy("entity_type").agg(F.array_sort(F.collect_list(F.struct("rn", "name", line.alias("line")))).alias("x"), F.min("ord").alias("ord")).join(counts, "entity_type")
    lines = F.filter(F.transform("x", lambda x: x["line"]), lambda v: v.isNotNull())
    t = t.withColumn("lines", lines).filter(F.size("lines") > 0).withColumn("label", _type_label())
    return _pairs(t, "thematic", fill(OVERVIEW, label=F.col("label")), F.concat(fill(OVERVIEW_ANSWER, label=F.col("label")), F.array_join("lines", "\n")), F.transform("x", lambda x: x["name"]), entity_type=F.col("entity_type"), count=F.col("n"))


def neighborhoods(g: Graph, most: int = 15, shown: int = 8) -> DataFrame:
    """For a type's first entities with two or more neighbours: the first neighbours with a described edge. Edges may
    have ``ord``; neighbours go by it, else by name."""
    e = g.entities.filter("entity_type <> '' and entity_type <> 'UNKNOWN'")
    several = e.groupBy("entity_type").count().filter("count >= 2").select("entity_type")
    top = _ranked(e, most).join(several, "entity_type").select("ord", "entity_type", "name")
    edges = g.edges.select("a", "b", *(["ord"] if "ord" in g.edges.columns else [F.lit(0).alias("ord")]), F.col("description")).withColumnRenamed("ord", "edge_ord")
    adj = adjacency(edges).withColumnRenamed("node", "name")
    near = top.join(adj, "name").withColumn("rn", F.row_number().over(Window.partitionBy("name").orderBy("edge_ord", "neighbor")))
    total = near.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    said = strip(F.split("description", "<SEP>")[0])
    line = F.when(F.coalesce(said, F.lit("")) != "", F.concat(F.lit("- "), "neighbor", F.lit(" : "), said))
    t = near.filter(F.col("rn") <= shown).groupBy("ord", "entity_type", "name").agg(F.array_sort(F.collect_list(F.struct("rn", "neighbor", line.alias("line")))).alias("x")).join(total, "name")
    t = t.withColumn("lines", F.filter(F.transform("x", lambda x: x["line"]), lambda v: v.isNotNull())).filter(F.size("lines") > 0)
    sources = F.concat(F.array("name"), F.transform("x", lambda x: x["neighbor"]))
    return _pairs(t, "thematic", fill(LINKED, entity=F.col("name")), F.concat(fill(LINKED_ANSWER, entity=F.col("name")), F.array_join("lines", "\n")), sources, entity_type=F.col("entity_type"), neighbors=F.col("n"))


def thematic(g: Graph) -> DataFrame:
    return overviews(g).unionByName(neighborhoods(g))


#: Strategies by name, in the order of their output. Own ones can be added.
STRATEGIES: dict[str, Callable[[Graph], DataFrame]] = {"entity_def": entity_definitions, "relational": relations, "hierarchical": sections, "comparative": comparisons, "multihop": multihop, "chunk_qa": chunk_questions, "thematic": thematic}


def select(names: list[str] | None) -> list[str]:
    """Known names in registry order; unknown ones are left out; None is all."""
    return [n for n in STRATEGIES if names is None or n in names]


def generate(g: Graph, names: list[str] | None = None) -> DataFrame:
    """The union of the strategies' pairs, numbered by strategy and ``ord``."""
    out = None
    for i, name in enumerate(select(names)):
        own = STRATEGIES[name](g).withColumn("ord", F.struct(F.lit(i).alias("strategy"), F.col("ord").cast("long").alias("ord"), F.md5("question").alias("tie")))
        out = own if out is None else out.unionByName(own)
    if out is None:
        raise ValueError("no strategy selected")
    return out
