"""Registry of the core queries over the driver's tables, each with equivalent SQL where SQL can express it.

The tables hold no graph files or legal texts, so that some queries first build a graph or a structured text from the
star schema, in the same way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import providers, text
from .operators import augment, chunking, filters, graph, merge, strategies
from .operators.components import connected_components
from .plans import control
from .plans.staging import shared_dir, stage
from .plans.workers import spread
from .sources import formats, kg
from .streaming import journal

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _ORACLE[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    from .plans.workers import find_package

    find_package(spark)
    return spark.read.parquet(f"{d}/{name}.parquet")


STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


# text ---------------------------------------------------------------------------------------------


@_query(r"""
    WITH raw AS (SELECT doc_id, text || chr(10) || doc_id || chr(10) || 'tail  ' || chr(10) || chr(10) || chr(10) || chr(10) || 'end ' AS t FROM documents)
    SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '\n\s*\d+\s*\n', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '[ \t]+\n', chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS cleaned FROM raw""")
def clean_text(spark, d):
    raw = F.concat("text", F.lit("\n"), F.col("doc_id").cast("string"), F.lit("\ntail  \n\n\n\nend "))
    return _t(spark, d, "documents").select("doc_id", F.md5(text.clean(raw)).alias("cleaned"))


@_query(r"""
    WITH raw AS (SELECT doc_id, '“' || text || '” – x—y' || chr(160) || ' z’s' || chr(10) || chr(10) || chr(10) || 'end ' AS t FROM documents),
    plain AS (SELECT doc_id, translate(t, '‘’“”–—' || chr(160), '''''""-- ') AS t FROM raw)
    SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(t, '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS normalized FROM plain""")
def normalize_text(spark, d):
    raw = F.concat(F.lit("“"), "text", F.lit("” – x—y\xa0 z’s\n\n\nend "))
    return _t(spark, d, "documents").select("doc_id", F.md5(text.normalize(raw)).alias("normalized"))


@_query(r"""
    SELECT doc_id, md5(trim(regexp_replace(regexp_replace(lower(regexp_replace(text, '^\s+|\s+$', '', 'g')), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g'))) AS question_key FROM documents""")
def question_norm(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.md5(text.question_key("text")).alias("question_key"))


@_query("SELECT doc_id, substr(md5(substr(text, 1, 500)), 1, 12) AS hash_id FROM documents")
def hash_id(spark, d):
    return _t(spark, d, "documents").select("doc_id", text.hash_id("text").alias("hash_id"))


@_query(r"""SELECT doc_id, md5(CASE WHEN regexp_replace(substr(t, 1, 400), '\s+', '', 'g') = '' THEN 'empty' ELSE substr(t, 1, 400) END) AS prepared
    FROM (SELECT doc_id, CASE WHEN lang = 'de' THEN '   ' ELSE text END AS t FROM documents)""")
def embed_prep(spark, d):
    t = F.when(F.col("lang") == "de", F.lit("   ")).otherwise(F.col("text"))
    return _t(spark, d, "documents").select("doc_id", F.md5(text.embedding_text(t)).alias("prepared"))


@_query("""
    WITH h AS (SELECT doc_id, text, substr(text, 1, 700) AS head FROM documents)
    SELECT doc_id, md5(CASE WHEN length(text) <= 700 THEN text WHEN contains(head, '.') AND length(head) - instr(reverse(head), '.') > 50 THEN substr(head, 1, length(head) - instr(reverse(head), '.') + 1) ELSE head END) AS cut FROM h""")
def truncate_sentence(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.md5(text.cut_at_sentence("text", 700, 50)).alias("cut"))


@_query(r"""
    WITH p AS (SELECT source, string_agg(chr(10) || chr(10) || repeat('=', 60) || chr(10) || '# SOURCE: ' || doc_id || chr(10) || repeat('=', 60) || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY CAST(doc_id AS VARCHAR)) AS t, count(*) AS files FROM documents GROUP BY source)
    SELECT source, files, md5(regexp_replace(regexp_replace(regexp_replace(t, '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS combined FROM p""")
def combine_sources(spark, d):
    docs = _t(spark, d, "documents").select("source", F.col("doc_id").cast("string").alias("path"), "text")
    return kg.combine_sources(docs, ["source"]).select("source", "files", F.md5("text").alias("combined"))


@_query("""
    SELECT doc_id, CAST(w AS INTEGER) AS window_no, CAST(len(list_slice(tokens, w * 90 + 1, w * 90 + 100)) AS INTEGER) AS tokens, md5(array_to_string(list_slice(tokens, w * 90 + 1, w * 90 + 100), ' ')) AS content
    FROM (SELECT doc_id, string_split(text, ' ') AS tokens, unnest(generate_series(0, (len(string_split(text, ' ')) - 1) // 90)) AS w FROM documents)""")
def token_windows(spark, d):
    w = _t(spark, d, "documents").select("doc_id", F.posexplode(chunking.token_windows(F.split("text", " "))).alias("window_no", "w"))
    return w.select("doc_id", "window_no", F.size("w").alias("tokens"), F.md5(F.array_join("w", " ")).alias("content"))


@_query(r"""
    SELECT doc_id, name, CAST(count(*) AS BIGINT) AS mentions FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\p{Lu}\p{Ll}{5,}')) AS name FROM documents) GROUP BY ALL""")
def entity_mentions(spark, d):
    return providers.mentions(_t(spark, d, "documents")).groupBy("doc_id", "name").agg(F.count(F.lit(1)).alias("mentions"))


# chunking -----------------------------------------------------------------------------------------


@_query("""
    WITH RECURSIVE l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
    p(doc_id, lines, i, chunk, chars) AS (
        SELECT doc_id, lines, 1, 0, length(lines[1]) FROM l
        UNION ALL
        SELECT doc_id, lines, i + 1, CASE WHEN chars + length(lines[i + 1]) <= 1000 THEN chunk ELSE chunk + 1 END, CASE WHEN chars + length(lines[i + 1]) <= 1000 THEN chars + length(lines[i + 1]) ELSE length(lines[i + 1]) END
        FROM p WHERE i < len(lines))
    SELECT doc_id, CAST(chunk AS INTEGER) AS chunk, CAST(min(i) - 1 AS INTEGER) AS first_line, CAST(max(i) - 1 AS INTEGER) AS last_line, CAST(max(chars) AS INTEGER) AS chars FROM p GROUP BY doc_id, chunk""")
def pack_chunks(spark, d):
    g = _t(spark, d, "documents").select("doc_id", F.posexplode(chunking.pack_pieces(F.split("text", "\n"), 1000)).alias("chunk", "g"))
    return g.select("doc_id", "chunk", F.col("g.first").alias("first_line"), F.col("g.last").alias("last_line"), "g.chars")


def _legal(spark, d) -> DataFrame:
    """A structured text per region: regions are books, nations titles, customers articles."""
    n = _t(spark, d, "nation").join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = _t(spark, d, "customer").select(F.col("c_nationkey").alias("n_nationkey"), F.col("c_custkey").alias("k"), F.concat(F.lit("Article 100-"), "c_custkey", F.lit(" : "), "c_name", F.lit("\nLes comptes "), "c_mktsegment", F.lit(" doivent etre presentes avec soin dans l'annexe.\n\n")).alias("line"))
    per = c.groupBy("n_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda x: x["line"]), "").alias("body"))
    t = n.join(per, "n_nationkey", "left").withColumn("body", F.concat(F.lit("TITRE I – "), "n_name", F.lit("\n\n"), F.coalesce("body", F.lit(""))))
    return t.groupBy("r_regionkey", "r_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "body"))), lambda x: x["body"]), "").alias("body")).select(F.col("r_regionkey").cast("long").alias("doc_id"), F.concat(F.lit("avant\nLivre I : "), "r_name", F.lit("\n\n"), "body").alias("text"))


@_query("""
    SELECT CAST(n_regionkey AS BIGINT) AS doc_id, 'I - ' || n_name AS titre, CAST(count(c_custkey) AS BIGINT) AS articles, CAST(sum(c_custkey) AS BIGINT) AS keys
    FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""")
def sections_articles(spark, d):
    c = chunking.chunk_documents(_legal(spark, d), chunking.PCG, 10_000_000, 1)
    a = c.select("doc_id", "titre", F.explode("atomic_ids").alias("a"))
    return a.groupBy("doc_id", "titre").agg(F.count(F.lit(1)).alias("articles"), F.sum(F.substring_index("a", "-", -1).cast("long")).alias("keys"))


#: The chunks of _legal: sections in order, packed under their title up to 2,000 characters, those under 100 dropped.
_CHUNKS = """
    n AS (SELECT CAST(r_regionkey AS BIGINT) AS doc_id, r_name, n_nationkey, n_name FROM nation JOIN region ON n_regionkey = r_regionkey),
    parts AS (
        SELECT DISTINCT doc_id, -1 AS nation, 0 AS k, 'livre' AS kind, CAST(NULL AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS n_name, 'Livre I : ' || r_name AS content FROM n
        UNION ALL SELECT doc_id, n_nationkey, -1, 'titre', NULL, n_name, 'TITRE I – ' || n_name FROM n
        UNION ALL SELECT doc_id, n_nationkey, c_custkey, 'article', '100-' || c_custkey, n_name, 'Article 100-' || c_custkey || ' : ' || c_name || chr(10) || 'Les comptes ' || c_mktsegment || ' doivent etre presentes avec soin dans l''annexe.' FROM n JOIN customer ON c_nationkey = n_nationkey),
    listed AS (SELECT *, length(content) AS size, row_number() OVER (PARTITION BY doc_id ORDER BY nation, k) AS i FROM parts),
    packed(doc_id, i, pack, held) AS (
        SELECT doc_id, i, 0, size FROM listed WHERE i = 1
        UNION ALL
        SELECT l.doc_id, l.i, CASE WHEN l.kind = 'titre' OR p.held + l.size > 2000 THEN pack + 1 ELSE pack END, CASE WHEN l.kind = 'titre' OR p.held + l.size > 2000 THEN l.size ELSE p.held + l.size END
        FROM packed p JOIN listed l ON l.doc_id = p.doc_id AND l.i = p.i + 1),
    whole AS (SELECT doc_id, pack, arg_max(n_name, i) AS n_name, string_agg(content, chr(10) || chr(10) ORDER BY i) AS content, list(id ORDER BY i) FILTER (id IS NOT NULL) AS ids FROM packed JOIN listed USING (doc_id, i) GROUP BY doc_id, pack),
    chunks AS (
        SELECT w.doc_id, row_number() OVER (PARTITION BY w.doc_id ORDER BY pack) - 1 AS ord, 'I - ' || r_name AS livre, 'I - ' || n_name AS titre, content, coalesce(ids, []) AS ids, '[Livre: I - ' || r_name || CASE WHEN n_name IS NULL THEN '' ELSE ' > Titre: I - ' || n_name END || ']' || chr(10) || chr(10) || content AS text
        FROM whole w JOIN (SELECT DISTINCT doc_id, r_name FROM n) USING (doc_id) WHERE length(content) >= 100)"""


@_query(rf"""
    WITH RECURSIVE {_CHUNKS}
    SELECT doc_id, printf('pcg-%04d', ord) AS chunk_id, printf('pcg-%04d', ord) AS compat_id, CASE WHEN len(ids) = 0 THEN 'section' ELSE 'article' END AS chunk_type, CAST(length(content) AS INTEGER) AS char_count, livre, titre, CAST(len(ids) AS INTEGER) AS ids, substr(md5(substr(text, 1, 500)), 1, 12) AS hash_id FROM chunks""")
def chunk_documents(spark, d):
    c = chunking.chunk_documents(_legal(spark, d), chunking.PCG, 2000, 100)
    return c.select("doc_id", "chunk_id", "compat_id", "chunk_type", "char_count", "livre", "titre", F.size("atomic_ids").alias("ids"), "hash_id")


@_query(r"""
    WITH RECURSIVE d AS (SELECT doc_id, 'Livre I : D' || doc_id || chr(10) || regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM documents),
    w AS (SELECT doc_id, string_split(t, chr(10)) AS parts, replace(t, chr(10), chr(10) || chr(10)) AS content FROM d),
    p(doc_id, parts, i, g, held) AS (
        SELECT doc_id, parts, 1, 0, length(parts[1]) FROM w WHERE length(content) > 1500
        UNION ALL
        SELECT doc_id, parts, i + 1, CASE WHEN held + length(parts[i + 1]) <= 1000 THEN g ELSE g + 1 END, CASE WHEN held + length(parts[i + 1]) <= 1000 THEN held + length(parts[i + 1]) ELSE length(parts[i + 1]) END FROM p WHERE i < len(parts))
    SELECT doc_id, CAST(g AS INTEGER) AS ord, md5(string_agg(parts[i], chr(10) || chr(10) ORDER BY i)) AS content, CAST(sum(length(parts[i])) + 2 * (count(*) - 1) AS INTEGER) AS char_count FROM p GROUP BY doc_id, g
    UNION ALL SELECT doc_id, 0, md5(content), CAST(length(content) AS INTEGER) FROM w WHERE length(content) BETWEEN 100 AND 1500""")
def split_oversize(spark, d):
    """Each document as one section of paragraphs: over 1,500 characters it is split at blank lines."""
    body = F.concat(F.lit("Livre I : D"), F.col("doc_id").cast("string"), F.lit("\n"), text.strip("text"))
    docs = _t(spark, d, "documents").select("doc_id", F.replace(body, F.lit("\n"), F.lit("\n\n")).alias("text"))
    return chunking.chunk_documents(docs, chunking.PCG, 1000, 100).select("doc_id", "ord", F.md5("content").alias("content"), "char_count")


@_query(f"WITH RECURSIVE {_CHUNKS} SELECT doc_id, chunk_id, count AS chunks FROM (SELECT doc_id, arg_min(printf('pcg-%04d', ord), ord) AS chunk_id, count(*) AS count FROM chunks GROUP BY doc_id)")
def structure_counts(spark, d):
    c = chunking.chunk_documents(_legal(spark, d), chunking.PCG, 2000, 100)
    return c.groupBy("doc_id").agg(F.min_by("chunk_id", "ord").alias("chunk_id"), F.count(F.lit(1)).alias("chunks"))


@_query("SELECT doc_id, CAST(ntile(7) OVER (ORDER BY doc_id) - 1 AS INTEGER) AS pipeline_id FROM documents")
def range_split(spark, d):
    return control.assign_ranges(_t(spark, d, "documents").select("doc_id"), 7, "doc_id")


@_query("SELECT doc_id FROM documents WHERE text <> '' AND doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def pending_anti(spark, d):
    return control.pending(control.valid(_t(spark, d, "documents")), _t(spark, d, "labels"), "doc_id").select("doc_id")


# merging ------------------------------------------------------------------------------------------

_MENTIONS = r"""
    lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS description, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents),
    found AS (SELECT doc_id, line, description, unnest(regexp_extract_all(description, '\p{Lu}\p{Ll}{5,}')) AS name, generate_subscripts(regexp_extract_all(description, '\p{Lu}\p{Ll}{5,}'), 1) - 1 AS pos FROM lines),
    m AS (SELECT *, doc_id * 4294967296 + line * 4096 + pos AS ord FROM found)"""


@_query(f"""
    WITH {_MENTIONS}
    SELECT lower(name) AS key, arg_min(name, ord) AS name, md5(arg_max(description, (length(description), -ord))) AS description, CAST(count(DISTINCT doc_id) AS BIGINT) AS n_sources, md5(array_to_string(list_sort(list(DISTINCT CAST(doc_id AS VARCHAR))), ',')) AS sources, CAST(count(*) AS BIGINT) AS records
    FROM m GROUP BY lower(name)""")
def entity_merge(spark, d):
    m = providers.mentions(_t(spark, d, "documents")).select("ord", "name", F.lit("concept").alias("entity_type"), "description", F.array(F.col("doc_id").cast("string")).alias("sources"))
    e = merge.merge_entities(m)
    return e.select("key", "name", F.md5("description").alias("description"), F.size("sources").cast("long").alias("n_sources"), F.md5(F.array_join("sources", ",")).alias("sources"), "records")


@_query("""
    WITH kv AS (SELECT c_mktsegment AS key, 'k' || c_nationkey AS attr, c_custkey AS ord, CASE WHEN c_acctbal < 5000 THEN '' ELSE c_name END AS v FROM customer)
    SELECT key, attr, coalesce(arg_min(v, ord) FILTER (v <> ''), arg_min(v, ord)) AS value FROM kv GROUP BY key, attr""")
def entity_attrs_merge(spark, d):
    c = _t(spark, d, "customer")
    e = c.select(F.col("c_custkey").alias("ord"), F.initcap("c_mktsegment").alias("name"), F.lit("concept").alias("entity_type"), F.col("c_name").alias("description"), F.array().cast("array<string>").alias("sources"), F.create_map(F.concat(F.lit("k"), "c_nationkey"), F.when(F.col("c_acctbal") < 5000, "").otherwise(F.col("c_name"))).alias("attributes"))
    out = merge.merge_entities(e)
    return out.select(F.upper("key").alias("key"), F.explode("attributes").alias("attr", "value"))


_RELATIONS = """
    r AS (SELECT o_orderkey AS ord, c_mktsegment AS source, o_orderpriority AS target, o_orderstatus AS relation_type, repeat('x', CAST(o_orderkey % 7 AS INTEGER)) || o_orderkey AS description, o_totalprice AS weight, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey),
    merged AS (SELECT lower(source) AS source_key, lower(target) AS target_key, lower(relation_type) AS relation_key, arg_max(description, (length(description), -ord)) AS description, max(weight) AS weight, CAST(count(DISTINCT c_nationkey) AS BIGINT) AS n_sources, min(ord) AS ord FROM r GROUP BY ALL)"""


def _relations(spark, d) -> DataFrame:
    o = _t(spark, d, "orders").join(_t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return merge.merge_relations(o.select(F.col("o_orderkey").alias("ord"), F.col("c_mktsegment").alias("source"), F.col("o_orderpriority").alias("target"), F.col("o_orderstatus").alias("relation_type"), F.concat(F.repeat(F.lit("x"), (F.col("o_orderkey") % 7).cast("int")), "o_orderkey").alias("description"), F.col("o_totalprice").alias("weight"), F.array(F.col("c_nationkey").cast("string")).alias("sources")))


@_query(f"WITH {_RELATIONS} SELECT source_key, target_key, relation_key, description, weight, n_sources FROM merged")
def relation_merge(spark, d):
    return _relations(spark, d).select("source_key", "target_key", "relation_key", "description", "weight", F.size("sources").cast("long").alias("n_sources"))


@_query(f"WITH {_RELATIONS} SELECT least(source_key, target_key) AS a, greatest(source_key, target_key) AS b, arg_max(relation_key, ord) AS relation_key, arg_max(description, ord) AS description, arg_max(weight, ord) AS weight, CAST(count(*) AS BIGINT) AS relations FROM merged GROUP BY 1, 2")
def edge_collapse(spark, d):
    return merge.collapse_edges(_relations(spark, d)).select("a", "b", "relation_key", "description", "weight", "relations")


@_query("""
    SELECT n_name AS key, n_name AS name, 'nation' AS entity_type FROM nation
    UNION ALL SELECT DISTINCT r_name, r_name, 'unknown' FROM nation JOIN region ON n_regionkey = r_regionkey""")
def placeholder_nodes(spark, d):
    n = _t(spark, d, "nation")
    nodes = n.select(F.col("n_name").alias("key"), F.col("n_name").alias("name"), F.lit("nation").alias("entity_type"))
    return merge.placeholder_nodes(nodes, n.join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("a"), F.col("r_name").alias("b")))


@_query("SELECT c_mktsegment || c_nationkey AS key, arg_max(c_name, c_custkey) AS value FROM customer GROUP BY 1")
def kv_merge(spark, d):
    c = _t(spark, d, "customer")
    return merge.merge_kv(c.select(F.col("c_custkey").alias("ord"), F.concat("c_mktsegment", "c_nationkey").alias("key"), F.col("c_name").alias("value")))


# graph --------------------------------------------------------------------------------------------

_EDGES = """
    edges AS (SELECT s_name AS a, n_name AS b, 'Supplier ' || s_name || ' trades in ' || n_name AS description FROM supplier JOIN nation ON s_nationkey = n_nationkey
              UNION ALL SELECT n_name, r_name, 'Nation ' || n_name || ' is part of ' || r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
    nodes AS (SELECT s_name AS node FROM supplier UNION ALL SELECT n_name FROM nation UNION ALL SELECT r_name FROM region),
    adj AS (SELECT a AS node, b AS neighbor, description FROM edges UNION ALL SELECT b, a, description FROM edges)"""


def _edges(spark, d) -> DataFrame:
    n = _t(spark, d, "nation")
    s = _t(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    r = n.join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    up = s.select(F.col("s_name").alias("a"), F.col("n_name").alias("b"), F.concat(F.lit("Supplier "), "s_name", F.lit(" trades in "), "n_name").alias("description"))
    return up.unionByName(r.select(F.col("n_name").alias("a"), F.col("r_name").alias("b"), F.concat(F.lit("Nation "), "n_name", F.lit(" is part of "), "r_name").alias("description")))


def _nodes(spark, d) -> DataFrame:
    return _t(spark, d, "supplier").select(F.col("s_name").alias("node")).union(_t(spark, d, "nation").select("n_name")).union(_t(spark, d, "region").select("r_name"))


@_query(f"""
    WITH {_EDGES}, deg AS (SELECT n.node, CAST(count(j.neighbor) AS BIGINT) AS degree FROM nodes n LEFT JOIN adj j USING (node) GROUP BY n.node)
    SELECT node, degree, round(degree / (count(*) OVER () - 1), 9) AS centrality, round(10 + 30 * degree / max(degree) OVER (), 9) AS size FROM deg""")
def degree_centrality(spark, d):
    c = graph.centrality(_nodes(spark, d), _edges(spark, d))
    return c.select("node", "degree", F.round("centrality", 9).alias("centrality"), F.round("size", 9).alias("size"))


@_query(f"WITH {_EDGES} SELECT node, neighbor FROM adj")
def neighbors(spark, d):
    return graph.adjacency(_edges(spark, d)).select("node", "neighbor")


@_query("""
    SELECT CAST((SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM region) AS BIGINT) AS nodes,
           CAST((SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation) AS BIGINT) AS edges,
           CAST((SELECT count(*) FROM region) AS BIGINT) AS connected_components""")
def graph_stats(spark, d):
    return graph.stats(_nodes(spark, d), _edges(spark, d)).select("nodes", "edges", "connected_components")


@_query("""
    WITH m AS (SELECT r_name AS top, s_name AS node FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
               UNION ALL SELECT r_name, n_name FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, r_name FROM region)
    SELECT node, min(node) OVER (PARTITION BY top) AS label FROM m""")
def components(spark, d):
    return connected_components(_edges(spark, d))


@_query(f"WITH {_EDGES} SELECT x.neighbor AS first, x.node AS middle, y.neighbor AS last FROM adj x JOIN adj y ON x.node = y.node AND x.neighbor < y.neighbor")
def two_hop(spark, d):
    return graph.two_hop_paths(_edges(spark, d))


def _segments(spark, d) -> DataFrame:
    n = _t(spark, d, "customer").join(_t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return n.select(F.col("n_name").alias("a"), F.col("c_mktsegment").alias("b")).distinct()


@_query("""
    WITH e AS (SELECT DISTINCT n_name AS a, c_mktsegment AS b FROM customer JOIN nation ON c_nationkey = n_nationkey), j AS (SELECT a AS x, b AS y FROM e UNION ALL SELECT b, a FROM e)
    SELECT 'NATION_6' || '|' || p.y || '|NATION_7' AS path, 2 AS hops FROM j p JOIN j q ON p.y = q.x WHERE p.x = 'NATION_6' AND q.y = 'NATION_7'
    UNION ALL SELECT 'NATION_6|NATION_7', 1 FROM j WHERE x = 'NATION_6' AND y = 'NATION_7'
    UNION ALL SELECT 'NATION_6|' || p.y || '|' || q.y || '|NATION_7', 3 FROM j p JOIN j q ON p.y = q.x JOIN j r ON q.y = r.x WHERE p.x = 'NATION_6' AND r.y = 'NATION_7' AND q.y NOT IN ('NATION_6', 'NATION_7') AND p.y <> 'NATION_7' AND r.x <> p.x""")
def simple_paths3(spark, d):
    p = graph.simple_paths(_segments(spark, d), "NATION_6", "NATION_7", 3)
    return p.select(F.array_join("path", "|").alias("path"), "hops")


@_query("""
    WITH q AS (SELECT vec_id AS query_id, embedding AS e FROM embeddings WHERE vec_id % 100 = 0),
    s AS (SELECT query_id, vec_id, list_cosine_similarity(CAST(e AS DOUBLE[]), CAST(embedding AS DOUBLE[])) AS c FROM embeddings JOIN q ON vec_id <> query_id)
    SELECT query_id, vec_id, round(c, 6) AS similarity FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY c DESC, vec_id) <= 10""")
def cosine_topk(spark, d):
    v = _t(spark, d, "embeddings")
    return graph.cosine_top_k(v, v.filter("vec_id % 100 = 0"), 10).select("query_id", "vec_id", F.round("similarity", 6).alias("similarity"))


@_query("""
    WITH q AS (SELECT vec_id AS query_id, embedding AS e FROM embeddings WHERE vec_id % 100 = 0),
    s AS (SELECT query_id, vec_id, list_cosine_similarity(CAST(e AS DOUBLE[]), CAST(embedding AS DOUBLE[])) AS c FROM embeddings JOIN q ON vec_id <> query_id),
    near AS (SELECT query_id, vec_id, c, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, vec_id) AS rank FROM s QUALIFY rank <= 5),
    edges AS (SELECT vec_id AS a, -1 - label AS b FROM embeddings WHERE label > 2)
    SELECT query_id, vec_id AS node, round(c, 6) AS similarity, b AS neighbor, 'label ' || (-1 - b) AS description FROM near LEFT JOIN edges ON a = vec_id""")
def local_search(spark, d):
    v = _t(spark, d, "embeddings")
    edges = v.filter("label > 2").select(F.col("vec_id").alias("a"), (-1 - F.col("label")).cast("long").alias("b"), F.concat(F.lit("label "), F.col("label").cast("string")).alias("description"))
    return graph.local_search(v, v.filter("vec_id % 100 = 0"), edges).select("query_id", "node", F.round("similarity", 6).alias("similarity"), "neighbor", "description")


@_query(f"WITH {_EDGES}, n AS (SELECT count(*) AS n FROM nodes), m AS (SELECT count(*) AS m FROM edges) SELECT round(2 * m / (n * (n - 1)), 9) AS density FROM n, m")
def graph_density(spark, d):
    return graph.stats(_nodes(spark, d), _edges(spark, d)).select(F.round("density", 9).alias("density"))


@_query("""
    WITH RECURSIVE e AS (SELECT 'c' || o_custkey AS x, 'd' || CAST(floor(o_totalprice) AS BIGINT) AS y FROM orders),
    adj AS (SELECT x, y FROM e UNION SELECT y, x FROM e), reach(node, other) AS (SELECT DISTINCT x, x FROM adj UNION SELECT node, y FROM reach JOIN adj ON other = x)
    SELECT node, min(other) AS label FROM reach GROUP BY node""")
def components_orders(spark, d):
    """Customers and the whole prices of their orders."""
    price = F.floor("o_totalprice").cast("long").cast("string")
    return connected_components(_t(spark, d, "orders").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("a"), F.concat(F.lit("d"), price).alias("b")))


@_query("""
    WITH {_MENTIONS}
    SELECT x.doc_id, x.name AS source, y.name AS target, md5(x.description) AS description, CAST(1 AS DOUBLE) AS weight FROM m x JOIN m y ON x.doc_id = y.doc_id AND x.line = y.line AND y.pos = x.pos + 1 WHERE lower(x.name) <> lower(y.name)""".replace("{_MENTIONS}", _MENTIONS))
def relation_extract(spark, d):
    r = providers.adjacent_relations(providers.mentions(_t(spark, d, "documents")))
    return r.select(F.col("sources")[0].cast("long").alias("doc_id"), "source", "target", F.md5("description").alias("description"), "weight")


@_query("""
    WITH {_MENTIONS}, r AS (SELECT x.doc_id, x.name AS source, y.name AS target, x.description AS description, (x.doc_id, x.line, x.pos) AS o FROM m x JOIN m y ON x.doc_id = y.doc_id AND x.line = y.line AND y.pos = x.pos + 1 WHERE lower(x.name) <> lower(y.name))
    SELECT lower(source) AS source_key, lower(target) AS target_key, arg_min(source, o) AS source, arg_min(target, o) AS target, CAST(count(DISTINCT doc_id) AS BIGINT) AS n_sources, max(length(description)) AS longest FROM r GROUP BY ALL""".replace("{_MENTIONS}", _MENTIONS))
def relation_extract_merge(spark, d):
    r = merge.merge_relations(providers.adjacent_relations(providers.mentions(_t(spark, d, "documents"))))
    return r.select("source_key", "target_key", "source", "target", F.size("sources").cast("long").alias("n_sources"), F.length("description").cast("long").alias("longest"))


# pairs --------------------------------------------------------------------------------------------

_KG = f"""{_EDGES},
    ent AS (SELECT p_partkey AS ord, p_name || ' ' || p_partkey AS name, p_brand AS entity_type, 'Part ' || p_name || ' of type ' || p_type AS d1, 'It costs ' || p_size AS d2 FROM part)"""


def _entities(spark, d) -> DataFrame:
    p = spread(_t(spark, d, "part"))
    return p.select(F.col("p_partkey").alias("ord"), F.concat("p_name", F.lit(" "), "p_partkey").alias("name"), F.col("p_brand").alias("entity_type"), F.array(F.concat(F.lit("Part "), "p_name", F.lit(" of type "), "p_type"), F.concat(F.lit("It costs "), "p_size")).alias("descriptions"))


def _pick_sql(key: str, templates: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(templates))
    return f"CASE CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) % {len(templates)} {cases} END"


def _fill_sql(template: str, **values: str) -> str:
    out = "'" + template.replace("'", "''") + "'"
    for k, v in values.items():
        out = f"replace({out}, '{{{k}}}', {v})"
    return out


def _shown(pairs: DataFrame) -> DataFrame:
    return pairs.select("question", F.md5("answer").alias("answer"), F.array_join("source_entities", "|").alias("sources"))


@_query(f"WITH {_KG} SELECT {_pick_sql('name', [_fill_sql(t, entity='name') for t in strategies.ENTITY])} AS question, md5(CASE WHEN length(d2) > length(d1) THEN d2 ELSE d1 END) AS answer, name AS sources FROM ent WHERE greatest(length(d1), length(d2)) >= 20")
def pairs_entity_def(spark, d):
    return _shown(strategies.entity_definitions(strategies.Graph(entities=_entities(spark, d))))


@_query(f"""
    WITH {_KG}, rel AS (SELECT s_name AS src, n_name AS tgt, CASE WHEN s_suppkey % 2 = 0 THEN 'short' ELSE 'A long description of ' || s_name END AS d, CASE WHEN s_suppkey % 3 = 0 THEN 'k1, k2' END AS words FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    said AS (SELECT src, tgt, words, CASE WHEN length(d) >= 20 THEN d ELSE 'Supplier ' || src || ' trades in ' || tgt END AS d FROM rel)
    SELECT {_pick_sql("src || '|' || tgt", [_fill_sql(t, src='src', tgt='tgt') for t in strategies.RELATION])} AS question, md5(CASE WHEN words IS NULL THEN d ELSE d || ' (Mots-cles : ' || words || ')' END) AS answer, src || '|' || tgt AS sources FROM said""")
def pairs_relational(spark, d):
    s = _t(spark, d, "supplier").join(_t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    own = F.when(F.col("s_suppkey") % 2 == 0, F.lit("short")).otherwise(F.concat(F.lit("A long description of "), "s_name"))
    words = F.when(F.col("s_suppkey") % 3 == 0, F.array(F.lit("k1"), F.lit("k2"))).otherwise(F.array().cast("array<string>"))
    r = s.select(F.col("s_suppkey").alias("ord"), F.col("s_name").alias("src"), F.col("n_name").alias("tgt"), own.alias("description"), words.alias("keywords"))
    return _shown(strategies.relations(strategies.Graph(relations=r, edges=_edges(spark, d))))


@_query(f"""
    WITH {_KG}, e AS (SELECT *, CASE WHEN length(d2) > length(d1) THEN d2 ELSE d1 END AS best FROM ent), k AS (SELECT *, row_number() OVER (PARTITION BY entity_type ORDER BY ord) AS rn FROM e WHERE length(best) >= 30)
    SELECT {_pick_sql("x.name || '|' || y.name", [_fill_sql(t, a='x.name', b='y.name') for t in strategies.COMPARE])} AS question, md5(x.name || ' : ' || x.best || chr(10) || chr(10) || y.name || ' : ' || y.best) AS answer, x.name || '|' || y.name AS sources
    FROM k x JOIN k y ON x.entity_type = y.entity_type AND y.rn BETWEEN x.rn + 1 AND x.rn + 3 WHERE x.rn <= 30 AND y.rn <= 30""")
def pairs_comparative(spark, d):
    return _shown(strategies.comparisons(strategies.Graph(entities=_entities(spark, d))))


@_query(f"""
    WITH {_EDGES}, p AS (SELECT x.neighbor AS first, x.node AS middle, y.neighbor AS last, x.description AS d1, y.description AS d2 FROM adj x JOIN adj y ON x.node = y.node AND x.neighbor < y.neighbor),
    h AS (SELECT *, md5(first || '|' || middle || '|' || last) AS h, array_to_string(list_sort([first, middle, last]), '|') AS key FROM p)
    SELECT {_fill_sql(strategies.MULTIHOP, first='first', middle='middle', last='last')} AS question, md5(d1 || ' Ensuite, ' || d2) AS answer, first || '|' || middle || '|' || last AS sources
    FROM (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY key ORDER BY h) = 1) ORDER BY h LIMIT 200""")
def pairs_multihop(spark, d):
    return _shown(strategies.multihop(strategies.Graph(edges=_edges(spark, d)), most_neighbors=None))


@_query(f"""
    WITH {_KG}, k AS (SELECT *, row_number() OVER (PARTITION BY entity_type ORDER BY ord) AS rn, count(*) OVER (PARTITION BY entity_type) AS n FROM ent)
    SELECT {_fill_sql(strategies.OVERVIEW, label='entity_type')} AS question,
        md5({_fill_sql(strategies.OVERVIEW_ANSWER.strip(), label='entity_type')} || chr(10) || chr(10) || string_agg('- ' || name || ' : ' || d1, chr(10) ORDER BY rn) FILTER (rn <= 10)) AS answer, string_agg(name, '|' ORDER BY rn) AS sources
    FROM k WHERE rn <= 20 AND n >= 2 GROUP BY entity_type""")
def pairs_thematic(spark, d):
    return _shown(strategies.overviews(strategies.Graph(entities=_entities(spark, d))))


@_query(f"""
    WITH {_EDGES}, e AS (SELECT n_nationkey AS ord, n_name AS name, 'location' AS entity_type FROM nation), k AS (SELECT *, row_number() OVER (ORDER BY ord) AS rn FROM e),
    near AS (SELECT k.name, j.neighbor, j.description, row_number() OVER (PARTITION BY k.name ORDER BY j.neighbor) AS r, count(*) OVER (PARTITION BY k.name) AS n FROM k JOIN adj j ON k.name = j.node WHERE k.rn <= 15)
    SELECT {_fill_sql(strategies.LINKED, entity='name')} AS question, md5({_fill_sql(strategies.LINKED_ANSWER.strip(), entity='name')} || chr(10) || chr(10) || string_agg('- ' || neighbor || ' : ' || description, chr(10) ORDER BY r)) AS answer, name || '|' || string_agg(neighbor, '|' ORDER BY r) AS sources
    FROM near WHERE r <= 8 AND n >= 2 GROUP BY name""")
def pairs_thematic_neighbors(spark, d):
    e = _t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("ord"), F.col("n_name").alias("name"), F.lit("location").alias("entity_type"), F.array().cast("array<string>").alias("descriptions"))
    return _shown(strategies.neighborhoods(strategies.Graph(entities=e, edges=_edges(spark, d))))


def _legal_chunks(spark, d) -> DataFrame:
    c = chunking.chunk_documents(_legal(spark, d), chunking.PCG, 2000, 100)
    return c.select((F.col("doc_id") * 100_000 + F.col("ord")).alias("ord"), "chunk_id", F.col("text").alias("content"))


@_query(f"""
    WITH RECURSIVE {_CHUNKS}, named AS (SELECT *, array_to_string(list_filter([livre, titre], lambda x: x IS NOT NULL), ' > ') AS section, array_to_string(list_filter([livre, titre], lambda x: x IS NOT NULL), '|') AS sources FROM chunks),
    first AS (SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY section ORDER BY doc_id, ord) = 1)
    SELECT {_pick_sql("section", [_fill_sql(t, section="section") for t in strategies.SECTION])} AS question, sources,
        md5(CASE WHEN length(content) <= 1500 THEN content WHEN contains(substr(content, 1, 1500), '.') THEN substr(content, 1, 1500 - instr(reverse(substr(content, 1, 1500)), '.')) || '.' ELSE substr(content, 1, 1500) || '.' END) AS answer
    FROM first WHERE length(content) >= 50""")
def pairs_hierarchical(spark, d):
    return _shown(strategies.sections(strategies.Graph(chunks=_legal_chunks(spark, d))))


def _kinds(spark, d, *kinds: str) -> DataFrame:
    found = strategies.chunk_questions(strategies.Graph(chunks=_legal_chunks(spark, d)))
    return found.select("question", "answer", F.array_join("source_entities", "|").alias("sources"), F.col("metadata.sub_strategy").alias("kind")).filter(F.col("kind").isin(*kinds))


_ARTICLES = f"""WITH RECURSIVE {_CHUNKS}, a AS (SELECT c.titre, l.content, l.id FROM chunks c JOIN whole w ON w.doc_id = c.doc_id AND w.content = c.content JOIN packed p ON p.doc_id = w.doc_id AND p.pack = w.pack JOIN listed l ON l.doc_id = p.doc_id AND l.i = p.i WHERE l.kind = 'article'),
    qa AS (SELECT 'Que dit l''article ' || id || ' du PCG ?' AS question, regexp_replace(content, '^[^:]* : ', '') AS answer, 'Article ' || id AS sources, 'article' AS kind FROM a
           UNION ALL SELECT 'Quelle obligation est prevue par le PCG concernant ' || titre || ' ?', 'doivent etre presentes avec soin dans l''annexe.', '', 'rule' FROM a)"""


@_query(f"{_ARTICLES} SELECT question, answer, kind FROM qa")
def pairs_chunk_qa(spark, d):
    return _kinds(spark, d, "definition", "article", "rule", "list").select("question", "answer", "kind")


@_query(f"{_ARTICLES} SELECT question, answer, sources, kind FROM qa WHERE kind = 'article'")
def pairs_article(spark, d):
    return _kinds(spark, d, "article")


@_query(f"{_ARTICLES} SELECT question, answer, sources, kind FROM qa WHERE kind = 'rule'")
def pairs_rule(spark, d):
    return _kinds(spark, d, "rule")


def _cue_chunks(spark, d) -> DataFrame:
    """A chunk per part with a definition and, for every other one, a list."""
    p = spread(_t(spark, d, "part"))
    body = F.concat(F.lit("[Livre: I - L > Titre: II - "), "p_brand", F.lit("]\n\nIntro "), "p_partkey", F.lit(". Le terme "), "p_name", F.lit(" designe un element de type "), "p_type", F.lit(" et de taille "), F.col("p_size").cast("string"), F.lit("."))
    items = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" Les valeurs de "), "p_name", F.lit(" comprennent\n- la marque "), "p_brand", F.lit("\n- le type "), "p_type", F.lit(" complet\n"))).otherwise(F.lit(""))
    return p.select(F.col("p_partkey").alias("ord"), F.col("p_partkey").cast("string").alias("chunk_id"), F.concat(body, items).alias("content"))


@_query("""SELECT 'Comment est defini(e) Intro ' || p_partkey || '. Le terme ' || p_name || ' dans le PCG ?' AS question, 'designe un element de type ' || p_type || ' et de taille ' || p_size || '.' AS answer, 'Intro ' || p_partkey || '. Le terme ' || p_name AS sources, 'definition' AS kind FROM part""")
def pairs_definition(spark, d):
    found = strategies.chunk_questions(strategies.Graph(chunks=_cue_chunks(spark, d)))
    return found.filter("metadata.sub_strategy = 'definition'").select("question", "answer", F.array_join("source_entities", "|").alias("sources"), F.lit("definition").alias("kind"))


@_query("""SELECT 'Quels sont les elements qui Les valeurs de ' || p_name || ' selon le PCG ?' AS question, 'comprennent' || chr(10) || '- la marque ' || p_brand || chr(10) || '- le type ' || p_type || ' complet' AS answer, 'list' AS kind FROM part WHERE p_partkey % 2 = 0""")
def pairs_list(spark, d):
    found = strategies.chunk_questions(strategies.Graph(chunks=_cue_chunks(spark, d)))
    return found.filter("metadata.sub_strategy = 'list'").select("question", "answer", F.lit("list").alias("kind"))


# filters, reports, formats ------------------------------------------------------------------------

_PAIRS = """
    t AS (SELECT conv_id * 1000 + turn AS ord, role, text, lead(role) OVER w AS next_role, lead(text) OVER w AS answer, conv_id FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
    pairs AS (SELECT ord, text AS question, answer, 's' || (conv_id % 3) AS strategy_name FROM t WHERE role = 'user' AND next_role = 'assistant'),
    q AS (SELECT *, regexp_replace(answer, '^\\s+|\\s+$', '', 'g') AS a, regexp_replace(question, '^\\s+|\\s+$', '', 'g') AS qs FROM pairs),
    f AS (SELECT ord, question, strategy_name, CASE WHEN length(qs) < 10 THEN 'question_too_short (' || length(question) || ' < 10)' WHEN length(a) < 50 THEN 'answer_too_short (' || length(a) || ' < 50)' END AS rule,
            CASE WHEN length(qs) >= 10 AND length(a) >= 50 AND length(a) > 700 THEN CASE WHEN contains(substr(answer, 1, 700), '.') AND length(substr(answer, 1, 700)) - instr(reverse(substr(answer, 1, 700)), '.') > 50 AND length(answer) > 700 THEN substr(answer, 1, length(substr(answer, 1, 700)) - instr(reverse(substr(answer, 1, 700)), '.') + 1) ELSE substr(answer, 1, 700) END ELSE answer END AS answer,
            trim(regexp_replace(regexp_replace(lower(qs), '[^\\p{L}\\p{N}_\\s]', '', 'g'), '\\s+', ' ', 'g')) AS k FROM q),
    g AS (SELECT *, min(ord) FILTER (rule IS NULL) OVER (PARTITION BY k) AS first_ord FROM f),
    judged AS (SELECT g.ord, g.question, g.answer, g.strategy_name, CASE WHEN g.rule IS NOT NULL THEN g.rule WHEN g.ord > g.first_ord THEN 'duplicate_of:' || substr(p.question, 1, 60) END AS reason FROM g LEFT JOIN pairs p ON p.ord = g.first_ord)"""


def _conversation_pairs(spark, d) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = _t(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("ord"), "role", "text", F.lead("role").over(w).alias("next_role"), F.lead("text").over(w).alias("answer"), "conv_id")
    c = c.filter("role = 'user' and next_role = 'assistant'")
    return c.select("ord", F.col("text").alias("question"), "answer", F.concat(F.lit("s"), (F.col("conv_id") % 3).cast("string")).alias("strategy_name"), F.array().cast("array<string>").alias("source_entities"))


def _judged(spark, d) -> DataFrame:
    return filters.dedupe_questions(filters.quality_filter(_conversation_pairs(spark, d), filters.Limits(max_answer=700)))


@_query(f"WITH {_PAIRS} SELECT ord, md5(question) AS question, md5(answer) AS answer, CASE WHEN reason LIKE 'duplicate_of:%' THEN NULL ELSE reason END AS reason FROM judged")
def quality_filter(spark, d):
    f = filters.quality_filter(_conversation_pairs(spark, d), filters.Limits(max_answer=700))
    return f.select("ord", F.md5("question").alias("question"), F.md5("answer").alias("answer"), "reason")


@_query(f"WITH {_PAIRS} SELECT ord, reason FROM judged")
def dedupe_questions(spark, d):
    return _judged(spark, d).select("ord", "reason")


@_query(f"WITH {_PAIRS} SELECT trim(string_split(reason, '(')[1]) AS reason, CAST(count(*) AS BIGINT) AS count FROM judged WHERE reason IS NOT NULL GROUP BY 1")
def rejection_reasons(spark, d):
    return filters.rejection_reasons(_judged(spark, d))


@_query(f"WITH {_PAIRS} SELECT strategy_name, CAST(count(*) AS BIGINT) AS generated, CAST(count(*) FILTER (reason IS NULL) AS BIGINT) AS accepted, CAST(count(*) FILTER (reason IS NOT NULL) AS BIGINT) AS rejected, round_even(100.0 * count(*) FILTER (reason IS NULL) / count(*), 1) AS acceptance_rate FROM judged GROUP BY 1")
def strategy_report(spark, d):
    return filters.strategy_report(_judged(spark, d))


@_query(f"WITH {_PAIRS} SELECT CAST(count(*) AS BIGINT) AS generated, CAST(count(*) FILTER (reason IS NULL) AS BIGINT) AS accepted, CAST(count(*) FILTER (reason IS NOT NULL) AS BIGINT) AS rejected, CAST(0 AS BIGINT) AS augmented, round_even(100.0 * count(*) FILTER (reason IS NULL) / count(*), 1) AS acceptance_rate FROM judged")
def generation_report(spark, d):
    return filters.generation_report(_judged(spark, d))


def _records(spark, d, kind: str) -> DataFrame:
    return formats.records(_conversation_pairs(spark, d), kind)


@_query(f"WITH {_PAIRS} SELECT question AS said, answer FROM pairs")
def format_openai(spark, d):
    r = _records(spark, d, "openai").select(F.from_json("value", "messages array<struct<role string, content string>>").alias("r"))
    return r.select(F.col("r.messages")[1]["content"].alias("said"), F.col("r.messages")[2]["content"].alias("answer"))


@_query(f"WITH {_PAIRS} SELECT question AS instruction, '' AS input, answer AS output FROM pairs")
def format_alpaca(spark, d):
    return _records(spark, d, "alpaca").select(F.from_json("value", "instruction string, input string, output string").alias("r")).select("r.*")


@_query(f"WITH {_PAIRS} SELECT question AS human, answer AS gpt FROM pairs")
def format_sharegpt(spark, d):
    r = _records(spark, d, "sharegpt").select(F.from_json("value", "conversations array<struct<`from` string, value string>>").alias("r"))
    return r.select(F.col("r.conversations")[0]["value"].alias("human"), F.col("r.conversations")[1]["value"].alias("gpt"))


@_query(f"WITH {_PAIRS}, m AS (SELECT ord, unnest([{{'n': 0, 'role': 'system', 'content': 'S'}}, {{'n': 1, 'role': 'user', 'content': question}}, {{'n': 2, 'role': 'assistant', 'content': answer}}]) AS x FROM pairs) SELECT x.n AS place, x.role AS role, md5(x.content) AS content FROM m")
def records_openai(spark, d):
    r = formats.records(_conversation_pairs(spark, d), "openai", system="S").select(F.from_json("value", "messages array<struct<role string, content string>>").alias("r"))
    return r.select(F.posexplode("r.messages").alias("place", "m")).select("place", "m.role", F.md5("m.content").alias("content"))


@_query(f"WITH {_PAIRS}, m AS (SELECT ord, unnest([{{'n': 0, 'who': 'human', 'said': question}}, {{'n': 1, 'who': 'gpt', 'said': answer}}]) AS x FROM pairs) SELECT x.n AS place, x.who AS who, md5(x.said) AS said FROM m")
def records_sharegpt(spark, d):
    r = _records(spark, d, "sharegpt").select(F.from_json("value", "conversations array<struct<`from` string, value string>>").alias("r"))
    return r.select(F.posexplode("r.conversations").alias("place", "m")).select("place", F.col("m.from").alias("who"), F.md5("m.value").alias("said"))


_RULES = r"""
    raw AS (SELECT p_partkey AS ord, CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN ' ' || left(p_name, 4) ELSE 'Que dire de ' || p_name || ' ' || p_partkey % 7 || ' ?' END AS question,
                CASE p_size % 7 WHEN 0 THEN NULL WHEN 1 THEN p_type ELSE trim(repeat(p_name || ' ' || p_type || '. ', 1 + CAST(p_partkey % 60 AS INTEGER))) END AS answer, p_partkey % 4 = 0 AS named FROM part),
    p AS (SELECT ord, coalesce(question, '') AS question, coalesce(answer, '') AS answer, named FROM raw),
    ruled AS (SELECT *, length(answer) > 300 AS long, substr(answer, 1, 300) AS head FROM p),
    cut AS (SELECT *, CASE WHEN NOT long THEN answer WHEN contains(head, '.') AND length(head) - instr(reverse(head), '.') > 50 THEN substr(head, 1, length(head) - instr(reverse(head), '.') + 1) ELSE head END AS said FROM ruled),
    f AS (SELECT ord, question, CASE WHEN length(trim(question)) < 10 THEN 'question_too_short (' || length(question) || ' < 10)' WHEN length(answer) < 50 THEN 'answer_too_short (' || length(answer) || ' < 50)' WHEN named AND NOT long THEN 'answer_is_entity_name' END AS rule, answer, said FROM cut),
    k AS (SELECT *, trim(regexp_replace(regexp_replace(lower(trim(question)), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g')) AS k FROM f),
    g AS (SELECT *, min(ord) FILTER (rule IS NULL) OVER (PARTITION BY k) AS first_ord FROM k),
    judged AS (SELECT g.ord, CASE WHEN g.rule IS NULL THEN g.said ELSE g.answer END AS answer, CASE WHEN g.rule IS NOT NULL THEN g.rule WHEN g.ord > g.first_ord THEN 'duplicate_of:' || substr(o.question, 1, 60) END AS reason FROM g LEFT JOIN p o ON o.ord = g.first_ord)"""


def _rule_pairs(spark, d) -> DataFrame:
    """A pair per part: null, short, long and repeated ones, and answers that are an entity's name in capitals."""
    p = spread(_t(spark, d, "part"))
    size, key = F.col("p_size"), F.col("p_partkey")
    question = F.when(size % 5 == 1, F.concat(F.lit(" "), F.substring("p_name", 1, 4))).when(size % 5 != 0, F.concat(F.lit("Que dire de "), "p_name", F.lit(" "), (key % 7).cast("string"), F.lit(" ?")))
    answer = F.when(size % 7 == 1, F.col("p_type")).when(size % 7 != 0, F.trim(F.repeat(F.concat("p_name", F.lit(" "), "p_type", F.lit(". ")), (1 + key % 60).cast("int"))))
    return p.select(key.alias("ord"), question.alias("question"), answer.alias("answer"), F.lit("s").alias("strategy_name"), F.when(key % 4 == 0, F.array(F.upper(answer))).otherwise(F.array().cast("array<string>")).alias("source_entities"))


@_query(f"WITH {_RULES} SELECT ord, md5(answer) AS answer, reason FROM judged")
def filter_rules(spark, d):
    judged = filters.dedupe_questions(filters.quality_filter(_rule_pairs(spark, d), filters.Limits(max_answer=300)))
    return judged.select("ord", F.md5("answer").alias("answer"), "reason")


@_query(f"WITH {_RULES} SELECT trim(string_split(reason, '(')[1]) AS reason, CAST(count(*) AS BIGINT) AS count FROM judged WHERE reason IS NOT NULL GROUP BY 1")
def filter_rule_counts(spark, d):
    return filters.rejection_reasons(filters.dedupe_questions(filters.quality_filter(_rule_pairs(spark, d), filters.Limits(max_answer=300))))


@_query(f"WITH {_PAIRS} SELECT CAST(count(*) AS BIGINT) AS generated, CAST(count(*) FILTER (reason IS NULL) + 7 AS BIGINT) AS accepted, CAST(count(*) FILTER (reason IS NOT NULL) AS BIGINT) AS rejected, CAST(7 AS BIGINT) AS augmented, round_even(100.0 * count(*) FILTER (reason IS NULL) / count(*), 1) AS acceptance_rate FROM judged")
def augmented_report(spark, d):
    return filters.generation_report(_judged(spark, d), 7)


@_query("""SELECT conv_id, md5(string_agg('<|' || role || '|>' || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn)) AS rendered FROM conversations GROUP BY conv_id""")
def chat_render(spark, d):
    m = F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("content"))
    c = _t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(m)).alias("messages"))
    return c.select("conv_id", F.md5(formats.render_messages("messages")).alias("rendered"))


@_query()
def augment_template(spark, d):
    return augment.augment(strategies.entity_definitions(strategies.Graph(entities=_entities(spark, d))), 3, 7).select("ord", "variant", "question", "answer")


# journal and control ------------------------------------------------------------------------------

_EVENTS = "j AS (SELECT event_id, 'p' || (user_id % 7) AS phase, CASE event_type WHEN 'click' THEN 'start' WHEN 'purchase' THEN 'complete' WHEN 'view' THEN 'progress' ELSE 'error' END AS action, CAST(floor(value * 100) AS BIGINT) AS duration_ms, CAST(event_id AS VARCHAR) AS details FROM events)"


def _journal(events: DataFrame) -> DataFrame:
    kind = F.when(F.col("event_type") == "click", "start").when(F.col("event_type") == "purchase", "complete").when(F.col("event_type") == "view", "progress").otherwise("error")
    return events.select("event_id", F.concat(F.lit("p"), (F.col("user_id") % 7).cast("string")).alias("phase"), kind.alias("action"), F.floor(F.col("value") * 100).cast("long").alias("duration_ms"), F.col("event_id").cast("string").alias("details"), F.col("event_id").alias("timestamp"))


_SUMMARY = f"""WITH {_EVENTS} SELECT phase, bool_or(action = 'start') AS started, bool_or(action = 'complete') AS completed, arg_max(duration_ms, event_id) FILTER (action = 'complete') AS duration_ms, arg_max(details, event_id) FILTER (action = 'complete') AS details, CAST(count(*) FILTER (action = 'error') AS BIGINT) AS errors, min(event_id) AS first, max(event_id) AS last FROM j GROUP BY phase"""


@_query(_SUMMARY)
def journal_summary(spark, d):
    return journal.summary(_journal(_t(spark, d, "events")), "event_id")


@_query(f"WITH {_EVENTS} SELECT array_to_string(list_sort(list(DISTINCT phase) FILTER (action = 'complete')), ',') AS completed, arg_max(details, event_id) FILTER (action = 'error') AS error, arg_max(details, event_id) FILTER (action = 'progress') AS progress, max(event_id) AS last FROM j")
def journal_last_state(spark, d):
    return journal.last_state(_journal(_t(spark, d, "events")), "event_id").select(F.array_join("completed", ",").alias("completed"), "error", "progress", "last")


@_query(f"WITH {_EVENTS} SELECT event_id AS timestamp, phase, details FROM j WHERE action = 'error'")
def journal_errors(spark, d):
    return journal.errors(_journal(_t(spark, d, "events")))


@_query(_SUMMARY)
def stream_journal(spark, d):
    import uuid

    schema = _t(spark, d, "events").schema
    name = f"journal_{uuid.uuid4().hex}"
    events = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{d}/events.parquet*")
    journal.stream_summary(journal.summary(_journal(events), "event_id"), f"{shared_dir(spark)}/{name}", name)
    return spark.table(name)


@_query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, CAST(count(*) AS BIGINT) AS count FROM events GROUP BY ALL")
def stream_windows(spark, d):
    """Counts per day of the stream of events, with a watermark; what is there now, to the end."""
    import uuid

    name = f"windows_{uuid.uuid4().hex}"
    events = spark.readStream.schema(_t(spark, d, "events").schema).option("pathGlobFilter", "*.parquet").parquet(f"{d}/events.parquet*")
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    journal.stream_summary(journal.windowed(timed, "ts", "1 day", "1 hour", "event_type"), f"{shared_dir(spark)}/{name}", name)
    return spark.table(name).select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "count")


@_query(f"WITH {_EVENTS} SELECT phase, action, CAST(count(*) AS BIGINT) AS records, max(duration_ms) AS longest FROM j WHERE action <> 'error' GROUP BY ALL")
def journal_read(spark, d):
    """Events as JSON lines, those of errors broken or blank, written and read back as a journal."""
    import uuid

    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}.jsonl"
    rows = _journal(_t(spark, d, "events"))
    good = F.to_json(F.struct(F.col("timestamp").cast("string").alias("timestamp"), "phase", "action", "details", "duration_ms"))
    rows.select(F.when(F.col("action") != "error", good).when(F.col("duration_ms") > 5000, F.lit("")).otherwise(F.lit('{"phase": "broken')).alias("value")).write.text(path)
    return journal.read(spark, path).groupBy("phase", "action").agg(F.count(F.lit(1)).alias("records"), F.max("duration_ms").alias("longest"))


@_query("""
    WITH r AS (SELECT l_linenumber AS pipeline_id, CASE WHEN sum(l_quantity) > 0 THEN 'ok' ELSE 'failed' END AS status, CAST(count(*) FILTER (l_returnflag <> 'R') AS BIGINT) AS processed, CAST(count(*) AS BIGINT) AS total, CAST(60000 * l_linenumber AS BIGINT) AS duration_ms FROM lineitem GROUP BY l_linenumber)
    SELECT CAST(sum(processed) AS BIGINT) AS processed, CAST(sum(total) AS BIGINT) AS total, CAST(count(*) FILTER (status <> 'ok') AS BIGINT) AS failed, round_even(sum(processed) / (max(duration_ms) / 60000.0), 1) AS chunks_per_minute FROM r""")
def pipeline_totals(spark, d):
    r = _t(spark, d, "lineitem").groupBy(F.col("l_linenumber").alias("pipeline_id")).agg(F.when(F.sum("l_quantity") > 0, "ok").otherwise("failed").alias("status"), F.count_if(F.col("l_returnflag") != "R").alias("processed"), F.count(F.lit(1)).alias("total"))
    return control.totals(r.withColumn("duration_ms", (60_000 * F.col("pipeline_id")).cast("long")))


@_query(f"WITH {_EDGES} SELECT a AS source, b AS target, 'in' AS relation_type, description, CAST(2 AS DOUBLE) AS weight FROM edges")
def kg_round_trip(spark, d):
    """Writes a graph file, suppliers before nations before regions, and reads its edges back from the end that comes first."""
    return stage(kg.graphml_edges(spark, _graphml(spark, d)).select("source", "target", "relation_type", "description", "weight"), "graph")


@_query(f"""WITH {_EDGES} SELECT node AS node_id, node AS name, 'place' AS entity_type, 'a < b & "c" ' || node AS description FROM nodes""")
def kg_nodes(spark, d):
    return stage(kg.graphml_nodes(spark, _graphml(spark, d)).select("node_id", "name", "entity_type", "description"), "graph")


def _graphml(spark, d) -> str:
    import uuid

    e = _edges(spark, d)
    ord = F.when(F.col("node").startswith("Supplier"), 0).when(F.col("node").startswith("NATION"), 1).otherwise(2)
    nodes = _nodes(spark, d).select(F.col("node").alias("key"), F.col("node").alias("name"), F.lit("place").alias("entity_type"), F.concat(F.lit('a < b & "c" '), "node").alias("description"), ord.alias("ord"))
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}.graphml"
    formats.write_graphml(nodes, e.withColumns({"relation": F.lit("in"), "weight": F.lit(2.0)}), path)
    return path
