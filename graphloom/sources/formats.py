"""Sinks: training records, rejected pairs, graph files, reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ranks import ranked

SYSTEM_PROMPT = "Tu es un expert en comptabilite."


def openai(question: Column, answer: Column, system: str = SYSTEM_PROMPT) -> Column:
    def message(role: str, c: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), c.alias("content"))

    return F.struct(F.array(message("system", F.lit(system)), message("user", question), message("assistant", answer)).alias("messages"))


def alpaca(question: Column, answer: Column, **_) -> Column:
    return F.struct(question.alias("instruction"), F.lit("").alias("input"), answer.alias("output"))


def sharegpt(question: Column, answer: Column, **_) -> Column:
    def turn(who: str, c: Column) -> Column:
        return F.struct(F.lit(who).alias("from"), c.alias("value"))

    return F.struct(F.array(turn("human", question), turn("gpt", answer)).alias("conversations"))


FORMATS: dict[str, Callable[..., Column]] = {"openai": openai, "alpaca": alpaca, "sharegpt": sharegpt}


def records(pairs: DataFrame, kind: str, **options) -> DataFrame:
    """One JSON text per pair, in column ``value``."""
    if kind not in FORMATS:
        raise ValueError(f"unknown format {kind!r}; there are {sorted(FORMATS)}")
    return pairs.select(F.to_json(FORMATS[kind](F.col("question"), F.col("answer"), **options)).alias("value"))


def write_jsonl(pairs: DataFrame, path: str, kind: str = "openai", single: bool = False, **options) -> int:
    """Writes records; one ordered file with ``single``. Returns their number."""
    ordered = pairs.orderBy("ord").coalesce(1) if single else pairs
    records(ordered, kind, **options).write.mode("overwrite").text(path)
    return pairs.sparkSession.read.text(path).count()


def write_kv(store: DataFrame, path: str) -> int:
    """A key-value table (key, value as JSON text) as one JSON object in the order of keys; nothing is written for no entries."""
    n = store.count()
    if n:
        rows = ranked(store.select("key", "value"), "key")
        entry = F.concat(F.to_json(F.struct(F.col("key").alias("k"))).substr(F.lit(6), F.length(F.to_json(F.struct(F.col("key").alias("k")))) - 6), F.lit(": "), "value", F.when(F.col("rank") < n - 1, F.lit(",")).otherwise(F.lit("")))
        ends = store.sparkSession.createDataFrame([(-1, "{"), (n, "}")], "rank long, line string")
        rows.select("rank", entry.alias("line")).unionByName(ends).orderBy("rank").coalesce(1).select("line").write.mode("overwrite").text(path)
    return n


def write_rejected(judged: DataFrame, path: str) -> None:
    judged.filter("reason is not null").select("question", "answer", F.col("strategy_name").alias("strategy"), "reason").write.mode("overwrite").json(path)


def render_messages(messages: Column | str) -> Column:
    """A plain chat template: role tags around each message."""
    m = F.col(messages) if isinstance(messages, str) else messages
    return F.array_join(F.transform(m, lambda x: F.concat(F.lit("<|"), x["role"], F.lit("|>\n"), x["content"], F.lit("\n"))), "")


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").parquet(f"{path}/edges")


def _escaped(c: Column) -> Column:
    out = F.coalesce(c.cast("string"), F.lit(""))
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def graphml_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(part, ord, line): a GraphML document's elements, nodes (key, name, entity_type, description) before edges
    (a, b, relation, description, weight), each in the order of their ``ord`` where they have one, as the order of nodes
    decides from which end an edge is read. Key names are the attributes' names."""
    def data(name: str, column: str) -> Column:
        return F.concat(F.lit(f'<data key="{name}">'), _escaped(F.col(column)), F.lit("</data>"))

    def place(df: DataFrame) -> Column:
        return (F.col("ord").cast("long") if "ord" in df.columns else F.lit(0).cast("long")).alias("ord")

    n = nodes.select(F.lit(1).alias("part"), place(nodes), F.concat(F.lit('<node id="'), _escaped(F.col("key")), F.lit('">'), data("entity_name", "name"), data("entity_type", "entity_type"), data("description", "description"), F.lit("</node>")).alias("line"))
    e = edges.select(F.lit(2).alias("part"), place(edges), F.concat(F.lit('<edge source="'), _escaped(F.col("a")), F.lit('" target="'), _escaped(F.col("b")), F.lit('">'), data("relation", "relation"), data("description", "description"), data("weight", "weight"), F.lit("</edge>")).alias("line"))
    return n.unionByName(e)


def write_graphml(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    spark = nodes.sparkSession
    keys = "".join(f'<key id="{k}" for="{w}" attr.name="{k}" attr.type="{t}"/>' for k, w, t in (("entity_name", "node", "string"), ("entity_type", "node", "string"), ("description", "all", "string"), ("relation", "edge", "string"), ("weight", "edge", "double")))
    head = spark.createDataFrame([(0, 0, f'<graphml><!-- undirected -->{keys}<graph edgedefault="undirected">'), (3, 0, "</graph></graphml>")], "part int, ord long, line string")
    graphml_lines(nodes, edges).unionByName(head).orderBy("part", "ord", "line").coalesce(1).select("line").write.mode("overwrite").text(path)


# The colour of each entity type.
TYPE_COLORS = {"concept": "#7c3aed", "content": "#2563eb", "data": "#059669", "method": "#d97706", "artifact": "#dc2626", "organization": "#db2777", "event": "#0891b2", "location": "#65a30d", "UNKNOWN": "#6b7280"}


def view_nodes(nodes: DataFrame, edges: DataFrame, most: int = 500) -> DataFrame:
    """(node, label, entity_type, color, size, title) of the ``most`` nodes of highest degree."""
    from ..functions.text import first_description, label, shorten
    from ..operators.graph import centrality

    top = centrality(nodes.select(F.col("key").alias("node")), edges).orderBy(F.desc("degree"), "node").limit(most)
    said = nodes.select(F.col("key").alias("node"), "name", F.coalesce("entity_type", F.lit("UNKNOWN")).alias("entity_type"), shorten(first_description(F.coalesce("description", F.lit("")))).alias("said"))
    color = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in TYPE_COLORS.items() for x in kv]), F.col("entity_type")), F.lit(TYPE_COLORS["UNKNOWN"]))
    title = F.concat_ws("\n", "name", F.concat(F.lit("Type: "), "entity_type"), F.concat(F.lit("Degree: "), F.col("degree").cast("string")), "said")
    return top.join(said, "node").select("node", label("name").alias("label"), "entity_type", color.alias("color"), "size", title.alias("title"), "degree")


def view_edges(edges: DataFrame, shown: DataFrame) -> DataFrame:
    """(a, b, width, title) of the edges among the nodes that are ``shown``."""
    few = shown.select("node")
    among = edges.join(F.broadcast(few.withColumnRenamed("node", "a")), "a", "left_semi").join(F.broadcast(few.withColumnRenamed("node", "b")), "b", "left_semi")
    weight = F.coalesce(F.col("weight").cast("double"), F.lit(1.0)) if "weight" in edges.columns else F.lit(1.0)
    return among.select("a", "b", F.least(weight * 1.5, F.lit(5.0)).alias("width"), F.concat("a", F.lit(" → "), "b", F.lit("\n"), F.substring(F.coalesce("description", F.lit("")), 1, 200) if "description" in edges.columns else F.lit("")).alias("title"))


def html_view(nodes: DataFrame, edges: DataFrame, most: int = 500) -> str:
    """A page that draws the ``most`` nodes of highest degree on rings, with the edges among them, tooltips and a legend."""
    from html import escape
    from math import cos, pi, sin

    shown = view_nodes(nodes, edges, most)
    circles = shown.orderBy(F.desc("degree"), "node").collect()
    lines = view_edges(edges, shown).orderBy("a", "b").limit(20 * most).collect()
    place, ring, left = {}, 0, list(circles)
    while left:
        on = max(1, 12 * ring)
        for i, r in enumerate(left[:on]):
            place[r.node] = (90 * ring * cos(2 * pi * i / on), 90 * ring * sin(2 * pi * i / on))
        left, ring = left[on:], ring + 1
    reach = 90 * ring + 60
    drawn = [f'<line x1="{place[r.a][0]:.0f}" y1="{place[r.a][1]:.0f}" x2="{place[r.b][0]:.0f}" y2="{place[r.b][1]:.0f}" stroke="#475569" stroke-width="{r.width:.1f}"><title>{escape(r.title)}</title></line>' for r in lines]
    drawn += [f'<circle cx="{place[r.node][0]:.0f}" cy="{place[r.node][1]:.0f}" r="{r["size"] / 2:.1f}" fill="{r.color}"><title>{escape(r.title)}</title></circle><text x="{place[r.node][0]:.0f}" y="{place[r.node][1] + r["size"] / 2 + 10:.0f}">{escape(r.label)}</text>' for r in circles]
    used = {r.entity_type: r.color for r in circles}
    legend = "".join(f'<div><span style="color:{c}">●</span> {escape(t)}</div>' for t, c in sorted(used.items()))
    return f'<!doctype html><meta charset="utf-8"><title>graph</title><style>body{{background:#1a1a2e;color:#e2e8f0;font-family:sans-serif}}text{{fill:#e2e8f0;font-size:9px;text-anchor:middle}}#key{{position:fixed;top:10px;right:10px}}</style><div id="key">{legend}<p>{len(circles)} nodes, {len(lines)} edges, {len(used)} types</p></div><svg viewBox="{-reach} {-reach} {2 * reach} {2 * reach}">{"".join(drawn)}</svg>'
