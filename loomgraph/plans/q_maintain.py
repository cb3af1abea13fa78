"""Queries over maintenance, source records, layout and headings."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomgraph.operators import catalog as C
from loomgraph.operators import extraction as X
from loomgraph.operators import graph as G
from loomgraph.operators import layout as L
from loomgraph.plans import q_catalog, q_extract, q_graph
from loomgraph.plans.q_catalog import mentions
from loomgraph.sources.rebase import SQL_CHUNKS, SQL_EDGES, SQL_NODES, chunks, edges, nodes, read, sources

# --- sources -----------------------------------------------------------------------------------


def source_records(spark, d):
    s = sources(spark, d).select("id", "title", F.concat(F.lit("author of "), "id").alias("author"), F.when(F.col("id") < "src2", "cli").otherwise("someone").alias("ingested_by"), F.lit("2024-01-02").alias("ingested_at"))
    r = C.source_records(q_catalog.catalog_sources(spark, d), s)
    return r.select("id", "title", "author", "pages", "units", "embedded", "status", "status_detail", "ingested_by", "created_at", F.col("updated_at").isNotNull().alias("dated"))


def source_lookup(spark, d):
    return C.source(q_catalog.catalog_sources(spark, d), "src5")


PROFILE = {"profile": "generic", "version": 2, "entities": [{"id": "concept", "label": "Concept", "desc": "an idea"}, {"id": "tool", "label": "Tool"}], "relations": [{"id": "USES"}, {"id": "PART_OF"}]}


def descriptor(spark, d):
    return C.descriptor(spark, PROFILE, {"search": True, "upload": False})


def _parents(spark, d):
    return chunks(spark, d).groupBy("source_id", F.call_function("div", F.col("chunk_index"), F.lit(3)).alias("k")).agg(F.concat_ws("_", "source_id", F.lit("p"), "k").alias("id")).select("id", "source_id")


def delete_census(spark, d):
    p = _parents(spark, d)
    e = p.select(F.col("id").alias("parent_id"), F.explode(F.array(F.lit("Book"), F.lit("Chunk"))).alias("other_label"))
    return C.delete_census(chunks(spark, d), p, mentions(spark, d), e, "src3")


def delete_source(spark, d):
    e = q_extract._edges(q_extract._relation_rows(spark, d))
    t = C.delete_source({"chunks": chunks(spark, d), "parents": _parents(spark, d), "mentions": mentions(spark, d), "edges": e}, "src3")
    count = lambda name: t[name].agg(F.count("*").alias("n")).select(F.lit(name).alias("kind"), F.lit(None).cast("string").alias("src"), F.lit(None).cast("string").alias("dst"), "n")
    left = t["edges"].select(F.lit("edge").alias("kind"), "src", "dst", F.coalesce(F.size("provenance"), F.lit(-1)).cast("long").alias("n"))
    return count("chunks").unionAll(count("parents")).unionAll(count("mentions")).unionAll(left)


def _labelled(spark, d):
    label = F.element_at(F.array(*map(F.lit, ("Chunk", "ChunkV2", "ChunkBackup", "ThingDev"))), (F.col("id") % 4 + 1).cast("int"))
    return chunks(spark, d).select("id", label.alias("label"))


def label_swap(spark, d):
    before = _labelled(spark, d)
    after = C.swap_labels(before, "Chunk", "ChunkV2", "ChunkBackup")
    return C.swap_census(before, after, "Chunk", "ChunkV2", "ChunkBackup")


def promote_dev(spark, d):
    return C.promote_dev(_labelled(spark, d)).groupBy("label").agg(F.count("*").alias("n"))


def upsert_entities(spark, d):
    old = q_extract._nodes(spark, d).groupBy("label", "name").agg(F.sum("freq").alias("freq")).withColumn("last_source", F.lit("old"))
    new = read(spark, d, "part").groupBy(F.lit("Part").alias("label"), F.col("p_name").alias("name")).agg(F.count("*").alias("freq")).withColumn("last_source", F.lit("new"))
    return C.upsert_entities(old, new)


# --- pathways and graph ------------------------------------------------------------------------


def ensure_nodes(spark, d):
    """Nations in upper case under their own label and another, names of parts as suppliers, and names of nothing."""
    n = nodes(spark, d)
    nation = read(spark, d, "nation").select(F.explode(F.array(F.lit("Nation"), F.lit("Place"))).alias("label"), F.lower("n_name").alias("name"))
    brand = read(spark, d, "part").select(F.lit("Brand").alias("label"), F.col("p_brand").alias("name")).distinct()
    return G.ensure_nodes(n, nation.unionAll(brand))


def dag_replace(spark, d):
    """Users' pathways in one-step form, those of users who clicked loaded again from their events."""
    e = q_graph._steps(spark, d)
    old = e.groupBy("dag").agg(F.min("node").alias("src"), F.max("node").alias("dst")).withColumn("kind", F.lit("old"))
    clicked = e.filter("event_type = 'click'").select("dag").distinct()
    out = G.replace_dag(old, e.join(clicked, "dag", "left_semi"))
    return G.delete_dag(out, 7).groupBy("dag", "kind").agg(F.count("*").alias("n"))


def ontology_crossed(spark, d):
    """Suppliers under one region and the nations under another that hold customers of their parts."""
    up = G.closure(q_graph._parents(spark, d), 5)
    li, o, c, n = (read(spark, d, t) for t in ("lineitem", "orders", "customer", "nation"))
    s = read(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("src"))
    links = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey")).select("src", F.col("n_name").alias("dst"))
    return G.crossed(up, links, "AFRICA", "EUROPE", 15)


# --- extraction --------------------------------------------------------------------------------


def _legacy(spark, d):
    return X.legacy_validate(q_extract._raw_entities(spark, d), q_extract._raw_relations(spark, d), ["concept", "tool"], ["USES", "PART_OF"])


def legacy_entities(spark, d):
    return _legacy(spark, d)[0].select("chunk_id", "at", "name", "type", F.array_join("synonyms", "|").alias("synonyms"))


def legacy_relations(spark, d):
    return _legacy(spark, d)[1].select("chunk_id", "at", "src", "relation", "dst")


def chunks_in_order(spark, d):
    e = read(spark, d, "lineitem").select(F.struct("l_orderkey", "l_linenumber").alias("ord"), F.col("l_partkey").alias("chunk_id"))
    return X.distinct_in_order(e).select("chunk_id", F.col("ord")["l_orderkey"].alias("l_orderkey"), F.col("ord")["l_linenumber"].alias("l_linenumber"))


def _typed_edges(spark, d):
    """Parts that follow each other in an order; the type is the flag, and some flags make no identifier."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    kind = F.when(F.col("l_returnflag") == "R", "next to").otherwise(F.concat(F.lit("NEXT_"), "l_returnflag"))
    return read(spark, d, "lineitem").select("l_orderkey", F.col("l_partkey").alias("src"), kind.alias("type"), F.lead("l_partkey").over(w).alias("dst")).filter("dst is not null")


def group_types(spark, d):
    out = X.group_types(_typed_edges(spark, d), X.duplicate_groups(q_extract._nodes(spark, d)))
    return out.select("label", "key", F.array_join("types", ",").alias("types"), "fine")


def merged_provenance(spark, d):
    e = _typed_edges(spark, d).groupBy("src", "type", "dst").agg(F.array_sort(F.collect_set("l_orderkey")).alias("o"))
    item = F.transform("o", lambda x: F.struct(x.alias("chunk"), F.lit("s").alias("source"), F.lit("e").alias("evidence")))
    e = e.select("src", "type", "dst", F.when((F.col("src") + F.col("dst")) % 11 != 0, item).alias("provenance"))
    out = X.merge_edge_provenance(e, X.duplicate_groups(q_extract._nodes(spark, d)))
    return out.select("src", "type", "dst", F.array_join(F.transform("provenance", lambda p: p["chunk"].cast("string")), ",").alias("chunks"))


def filled_provenance(spark, d):
    e = read(spark, d, "documents").select(F.col("doc_id").alias("src"), F.when(F.col("doc_id") % 5 != 0, F.array(F.struct(F.col("doc_id").alias("chunk"), F.when(F.col("doc_id") % 2 == 0, F.col("source")).alias("source"), F.when(F.col("doc_id") % 3 == 0, F.col("lang")).alias("profile"), F.lit("x").alias("evidence")))).alias("provenance"))
    return X.fill_provenance(e, "run source", "run profile").select("src", F.array_join(F.transform("provenance", lambda p: F.concat_ws("/", p["chunk"].cast("string"), p["source"], p["profile"])), ",").alias("provenance"))


def ontology_resolved(spark, d):
    """Types of parts as subcategories, brands as systems; some answers are blank, skipped or of no system."""
    p = read(spark, d, "part")
    cat = p.select("p_brand", F.split("p_type", " ")[0].alias("name")).distinct().select(F.lower("p_brand").alias("system"), "name", F.row_number().over(Window.orderBy("p_brand", "name")).alias("ord"), F.concat_ws("_", F.lower("p_brand"), F.lower("name")).alias("code"))
    system = F.when(F.col("p_partkey") % 7 == 0, "SKIP").when(F.col("p_partkey") % 11 == 0, "no such").otherwise(F.upper("p_brand"))
    sub = F.when(F.col("p_partkey") % 5 == 0, "nothing like it").otherwise(F.lower("p_type"))
    a = p.select(F.when(F.col("p_partkey") % 13 != 0, F.concat(F.lit("Part "), "p_partkey")).alias("name"), system.alias("system"), sub.alias("subcategory"))
    return X.resolve_ontology(a, cat)


# --- layout ------------------------------------------------------------------------------------


def table_text(spark, d):
    """Each order as a table with a header; every third line goes on from the one before."""
    li = read(spark, d, "lineitem")
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", F.concat(F.lit(" q "), F.col("l_quantity").cast("int")).alias("q"), "l_returnflag")))
    rows = F.transform(lines, lambda x, i: F.array(F.when((i > 0) & (x["l_linenumber"] % 3 == 2), "").otherwise(F.concat(F.lit("line "), x["l_linenumber"])), x["q"], x["l_returnflag"]))
    head = F.array(F.array(F.lit("line"), F.lit("how  many"), F.lit("flag")))
    return li.groupBy("l_orderkey").agg(rows.alias("r")).select("l_orderkey", L.render_table(F.concat(head, F.col("r"))).alias("text"))


def page_text(spark, d):
    """Parts as blocks of pages of twenty, one table a page; plain text that lacks or has other words."""
    p = read(spark, d, "part")
    page = F.call_function("div", F.col("p_partkey"), F.lit(20)).cast("int")
    x0, y0 = (F.col("p_size") % 5 * 20).cast("double"), (F.col("p_partkey") % 20 * 10).cast("double")
    blocks = p.select(F.lit("s").alias("source_id"), page.alias("page"), x0.alias("x0"), y0.alias("y0"), (x0 + 15).alias("x1"), (y0 + 8).alias("y1"), F.concat_ws(" ", "p_name", "p_partkey").alias("text"))
    pages = p.select(page.alias("page")).distinct()
    tables = pages.select(F.lit("s").alias("source_id"), "page", F.lit(0.0).alias("x0"), F.lit(45.0).alias("y0"), F.lit(200.0).alias("x1"), F.lit(85.0).alias("y1"), F.concat(F.lit("table "), "page").alias("text"))
    whole = blocks.groupBy("source_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y0", "x0", "text"))), lambda x: x["text"]), "\n").alias("all"))
    plain = whole.select("source_id", "page", F.when(F.col("page") % 2 == 0, F.concat(F.lit("table "), "page")).otherwise(F.col("all")).alias("plain"))
    return L.page_text(blocks, tables, plain)


CHAPTERS, SECTIONS = [r"Cap[ií]tulo \d+", r"Parte [IVX]+"], [r"\d+\.\d+ \p{Lu}"]


def _headed(spark, d):
    """Documents with a heading of one of seven forms above their text."""
    forms = ["Capítulo 4 Los ríos", "CAPITULO 12", "Capítulo\n\n 268\nOtro", "capítulo 7, las partes", "521 Capítulo 9 Infecciones", "parte del todo", "3.1 Temas y otros", "Capítulo 5) también", "Parte IV. De lo otro"]
    head = F.element_at(F.array(*map(F.lit, forms)), (F.col("id") % len(forms) + 1).cast("int"))
    return chunks(spark, d).select("source_id", "page", F.concat(head, F.lit("\n"), F.translate("text", "\n", " ")).alias("text"))


def headings(spark, d):
    return L.headings(_headed(spark, d), CHAPTERS, SECTIONS)


def joined_headings(spark, d):
    return L.joined_headings(_headed(spark, d)).select("source_id", "page", "line_no", F.md5("effective").alias("effective"), "consumed")


_CAT = q_catalog._CAT
_MEN = q_catalog._MEN
_EDGE = f"{q_extract._REL}, {q_extract._OLD}"
_DUP = q_extract._DUP
_FORMS = "['Capítulo 4 Los ríos', 'CAPITULO 12', 'Capítulo' || chr(10) || chr(10) || ' 268' || chr(10) || 'Otro', 'capítulo 7, las partes', '521 Capítulo 9 Infecciones', 'parte del todo', '3.1 Temas y otros', 'Capítulo 5) también', 'Parte IV. De lo otro']"
_HEAD = f"""{SQL_CHUNKS}, h AS (SELECT source_id, page, {_FORMS}[id % 9 + 1] || chr(10) || translate(text, chr(10), ' ') AS text FROM chunks),
l AS (SELECT source_id, page, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10)))))::INTEGER AS line_no FROM h),
n AS (SELECT *, trim(line) AS bare, first_value(nullif(trim(line), '') IGNORE NULLS) OVER (PARTITION BY source_id, page ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt,
  last_value(nullif(trim(line), '') IGNORE NULLS) OVER (PARTITION BY source_id, page ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM l),
j AS (SELECT source_id, page, line_no, CASE WHEN lower(trim(bare, '.,:;-')) IN ('capítulo', 'capitulo', 'sección', 'seccion', 'parte', 'chapter', 'section', 'part') AND coalesce(regexp_full_match(nxt, '\\d{{1,4}}'), false) THEN bare || ' ' || nxt ELSE line END AS effective,
  regexp_full_match(bare, '\\d{{1,4}}') AND coalesce(lower(trim(prev, '.,:;-')) IN ('capítulo', 'capitulo', 'sección', 'seccion', 'parte', 'chapter', 'section', 'part'), false) AS consumed FROM n)"""


def _holds(line: str, pattern: str) -> str:
    rest = f"regexp_replace({line}, '^(?:{pattern})', '')"
    return f"(regexp_matches({line}, '^(?:{pattern})') AND NOT regexp_matches({rest}, '^\\p{{L}}') AND ltrim({rest})[:1] <> ')' AND NOT (regexp_matches({line}, '^\\p{{Ll}}') AND ltrim({rest})[:1] IN ('.', ',', ';')) AND NOT regexp_matches(regexp_extract({rest}, '\\p{{L}}'), '^\\p{{Ll}}'))"


def _chapter(v: str) -> str:
    return "(" + " OR ".join(f"{_holds(v, p)} OR {_holds(f'strip_accents({v})', f'(?i:{L._plain(p)})')}" for p in CHAPTERS) + ")"


SQL = {
    "source_records": f"""WITH {_CAT} SELECT id, title, CASE WHEN registered THEN 'author of ' || id END AS author, pages, units, embedded, status,
      CASE WHEN status = 'fallido' THEN 'The source has no chunks: it was never loaded, or a later load left none of them.' WHEN status = 'parcial' THEN (units - embedded) || ' of ' || units || ' chunks have no embedding yet.' WHEN NOT registered THEN 'Chunks name the source, but it isn''t registered.' END AS status_detail,
      CASE WHEN registered AND id < 'src2' THEN 'cli' END AS ingested_by, CASE WHEN registered THEN '2024-01-02' END AS created_at, true AS dated FROM cat""",
    "source_lookup": f"WITH {_CAT} SELECT * FROM cat WHERE id = 'src5'",
    "delete_census": f"""WITH {_MEN}, p AS (SELECT name, max((source_id = 'src3')::INT) AS own, max((source_id <> 'src3')::INT) AS other FROM m GROUP BY 1)
      SELECT (SELECT count(*) FROM chunks WHERE source_id = 'src3') AS units, (SELECT count(*) FROM m WHERE source_id = 'src3') AS relations, coalesce(sum(own), 0)::BIGINT AS entities, count(*) FILTER (own = 1 AND other = 0) AS orphan_entities,
        (SELECT count(DISTINCT chunk_index // 3) FROM chunks WHERE source_id = 'src3') AS parents, (SELECT count(DISTINCT chunk_index // 3) FROM chunks WHERE source_id = 'src3') AS parent_relations FROM p""",
    "delete_source": f"""WITH {_MEN}, {_EDGE} SELECT 'chunks' AS kind, NULL AS src, NULL AS dst, count(*) AS n FROM chunks WHERE source_id <> 'src3' UNION ALL SELECT 'parents', NULL, NULL, count(DISTINCT (source_id, chunk_index // 3)) FROM chunks WHERE source_id <> 'src3'
      UNION ALL SELECT 'mentions', NULL, NULL, count(*) FROM m WHERE source_id <> 'src3' UNION ALL SELECT 'edge', src, dst, count(*) FROM old WHERE source <> 'src3' GROUP BY 2, 3 UNION ALL SELECT 'edge', src, dst, -1 FROM bare""",
    "label_swap": "SELECT count(*) FILTER (doc_id % 4 = 1) AS live, count(*) FILTER (doc_id % 4 IN (0, 2)) AS backup, 0 AS leftover, true AS fine FROM documents",
    "promote_dev": "SELECT CASE doc_id % 4 WHEN 0 THEN 'Chunk' WHEN 1 THEN 'ChunkV2' WHEN 2 THEN 'ChunkBackup' ELSE 'Thing' END AS label, count(*) AS n FROM documents GROUP BY 1",
    "upsert_entities": """WITH o AS (SELECT 'Part' AS label, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS name, sum(p_size)::BIGINT AS freq, 'old' AS last_source FROM part GROUP BY 2), n AS (SELECT 'Part' AS label, p_name AS name, count(*) AS freq, 'new' AS last_source FROM part GROUP BY 2)
      SELECT * FROM n UNION ALL SELECT * FROM o WHERE name NOT IN (SELECT name FROM n)""",
    "ensure_nodes": f"""WITH {SQL_NODES}, w AS (SELECT unnest(['Nation', 'Place']) AS label, lower(n_name) AS name FROM nation UNION SELECT 'Brand', p_brand FROM part),
      s AS (SELECT label, lower(name) AS k, min(name) AS same FROM nodes GROUP BY 1, 2), o AS (SELECT lower(name) AS k, arg_min(name, (label, name)) AS name, min(label) AS label FROM nodes GROUP BY 1)
      SELECT w.label, w.name, CASE WHEN same IS NOT NULL THEN w.label ELSE coalesce(o.label, w.label) END AS node_label, coalesce(same, o.name, w.name) AS node_name, same IS NULL AND o.k IS NULL AS made
      FROM w LEFT JOIN s ON s.label = w.label AND s.k = lower(w.name) LEFT JOIN o ON o.k = lower(w.name)""",
    "dag_replace": f"""WITH {q_graph._STEPS}, c AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'click')
      SELECT user_id AS dag, 'old' AS kind, 1::BIGINT AS n FROM (SELECT DISTINCT user_id FROM events) WHERE user_id NOT IN (SELECT user_id FROM c) AND user_id <> 7 UNION ALL SELECT dag, kind, count(*) FROM dag WHERE dag IN (SELECT user_id FROM c) AND dag <> 7 GROUP BY 1, 2""",
    "ontology_crossed": """SELECT DISTINCT s_name AS src, n.n_name AS dst FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation n ON n.n_nationkey = c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey AND r.r_name = 'EUROPE'
      JOIN supplier ON s_suppkey = l_suppkey JOIN nation m ON m.n_nationkey = s_nationkey JOIN region q ON q.r_regionkey = m.n_regionkey AND q.r_name = 'AFRICA' ORDER BY 1, 2 LIMIT 15""",
    "legacy_entities": f"""{q_extract._ENT} SELECT chunk_id, "at"::INTEGER AS "at", name, type, CASE WHEN length(syn) >= 2 AND syn <> name THEN syn ELSE '' END AS synonyms FROM k WHERE length(name) BETWEEN 2 AND 100 AND type IN ('concept', 'tool')""",
    "chunks_in_order": "SELECT l_partkey AS chunk_id, arg_min(l_orderkey, (l_orderkey, l_linenumber)) AS l_orderkey, arg_min(l_linenumber, (l_orderkey, l_linenumber)) AS l_linenumber FROM lineitem GROUP BY 1",
    "group_types": f"""WITH {_DUP}, e AS (SELECT * FROM (SELECT l_partkey AS src, CASE WHEN l_returnflag = 'R' THEN 'next to' ELSE 'NEXT_' || l_returnflag END AS type, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS dst FROM lineitem) WHERE dst IS NOT NULL)
      SELECT label, key, array_to_string(list_sort(list(DISTINCT type)), ',') AS types, bool_and(type <> 'next to') AS fine FROM g JOIN (SELECT src AS i, type FROM e UNION SELECT dst, type FROM e) x ON x.i = g.id WHERE id <> canonical GROUP BY 1, 2""",
    "merged_provenance": f"""WITH {_DUP}, e AS (SELECT DISTINCT l_orderkey AS o, src, type, dst FROM (SELECT l_orderkey, l_partkey AS src, CASE WHEN l_returnflag = 'R' THEN 'next to' ELSE 'NEXT_' || l_returnflag END AS type, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS dst FROM lineitem) WHERE dst IS NOT NULL),
      m AS (SELECT coalesce(a.canonical, src) AS src, type, coalesce(b.canonical, dst) AS dst, o, (src + dst) % 11 = 0 AS bare, (coalesce(a.canonical, src) <> src OR coalesce(b.canonical, dst) <> dst)::INT AS moved, src AS s, dst AS d FROM e LEFT JOIN g a ON a.id = src LEFT JOIN g b ON b.id = dst WHERE NOT coalesce(a.canonical = b.canonical, false)),
      f AS (SELECT *, row_number() OVER (PARTITION BY src, type, dst, o ORDER BY moved, s, d) AS r FROM m WHERE NOT bare)
      SELECT k.src, k.type, k.dst, string_agg(o, ',' ORDER BY moved, s, d, o) AS chunks FROM (SELECT DISTINCT src, type, dst FROM m) k LEFT JOIN f ON f.src = k.src AND f.type = k.type AND f.dst = k.dst AND f.r = 1 GROUP BY 1, 2, 3""",
    "filled_provenance": "SELECT doc_id AS src, CASE WHEN doc_id % 5 <> 0 THEN doc_id || '/' || CASE WHEN doc_id % 2 = 0 THEN coalesce(source, 'run source') ELSE 'run source' END || '/' || CASE WHEN doc_id % 3 = 0 THEN coalesce(lang, 'run profile') ELSE 'run profile' END ELSE '' END AS provenance FROM documents",
    "ontology_resolved": """WITH c AS (SELECT lower(p_brand) AS system, name, row_number() OVER (ORDER BY p_brand, name) AS ord, lower(p_brand) || '_' || lower(name) AS code FROM (SELECT DISTINCT p_brand, string_split(p_type, ' ')[1] AS name FROM part)),
      a AS (SELECT 'part ' || p_partkey AS name, lower(p_brand) AS system, CASE WHEN p_partkey % 5 = 0 THEN 'nothing like it' ELSE lower(p_type) END AS sub FROM part WHERE p_partkey % 13 <> 0 AND p_partkey % 7 <> 0 AND p_partkey % 11 <> 0)
      SELECT DISTINCT a.name, coalesce((SELECT arg_min(code, ord) FROM c WHERE c.system = a.system AND (contains(lower(c.name), sub) OR contains(sub, lower(c.name)))), a.system) AS target FROM a""",
    "table_text": """WITH x AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, ' q ' || l_quantity::INTEGER, l_returnflag) AS pos FROM lineitem),
      c AS (SELECT *, CASE WHEN pos > 1 AND l_linenumber % 3 = 2 THEN '' ELSE 'line ' || l_linenumber END AS c FROM x), i AS (SELECT *, sum((c <> '')::INT) OVER (PARTITION BY l_orderkey ORDER BY pos) AS k FROM c),
      r AS (SELECT l_orderkey, k, max(c) || ' (LINE); ' || string_agg('q ' || l_quantity::INTEGER, ' ' ORDER BY pos) || ' (HOW MANY); ' || string_agg(l_returnflag, ' ' ORDER BY pos) || ' (FLAG).' AS s FROM i GROUP BY 1, 2)
      SELECT l_orderkey, CASE WHEN count(*) < 2 THEN '' ELSE string_agg(s, chr(10) ORDER BY k) END AS text FROM r GROUP BY 1""",
    "page_text": """WITH b AS (SELECT p_partkey // 20 AS page, (p_size % 5 * 20)::DOUBLE AS x0, (p_partkey % 20 * 10)::DOUBLE AS y0, p_name || ' ' || p_partkey AS text FROM part),
      w AS (SELECT page, string_agg(text, chr(10) ORDER BY y0, x0, text) AS all_ FROM b GROUP BY 1), f AS (SELECT * FROM b WHERE NOT (greatest(0, least(y0 + 8, 85) - greatest(y0, 45)) / 8 > 0.5) UNION ALL SELECT DISTINCT page, 0, 45, 'table ' || page FROM b),
      m AS (SELECT page, string_agg(text, chr(10) ORDER BY y0, x0, text) AS made FROM f GROUP BY 1),
      z AS (SELECT page, made, CASE WHEN page % 2 = 0 THEN 'table ' || page ELSE all_ END AS plain FROM w JOIN m USING (page)),
      v AS (SELECT *, list_distinct(list_filter(string_split_regex(lower(plain), '\\s+'), lambda x: length(x) >= 2)) AS a, list_distinct(list_filter(string_split_regex(lower(made), '\\s+'), lambda x: length(x) >= 2)) AS c FROM z)
      SELECT 's' AS source_id, page::INTEGER AS page, CASE WHEN ok THEN made ELSE plain END AS text, ok AS tables_used FROM (SELECT *, len(list_filter(a, lambda x: NOT list_contains(c, x))) / greatest(len(a), 1) <= 0.02 AS ok FROM v)""",
    "joined_headings": f"WITH {_HEAD} SELECT source_id, page, line_no, md5(effective) AS effective, consumed FROM j",
    "headings": f"""WITH {_HEAD}, v AS (SELECT *, trim(effective) AS e, regexp_replace(trim(effective), '^\\d{{1,4}}\\s+', '') AS shorn FROM j WHERE NOT consumed),
      t AS (SELECT source_id, page, line_no, e, CASE WHEN length(e) >= 3 AND {_chapter('e')} THEN e[:120] WHEN shorn <> e AND length(shorn) >= 3 AND {_chapter('shorn')} THEN shorn[:120] END AS chapter FROM v)
      SELECT * FROM (SELECT source_id, page, line_no, chapter, CASE WHEN chapter IS NULL AND length(e) BETWEEN 3 AND 79 AND length(regexp_replace(e, '[^.]', '', 'g')) <= 2 AND regexp_matches(e, '^(?:{SECTIONS[0]})') THEN e[:100] END AS section FROM t) WHERE chapter IS NOT NULL OR section IS NOT NULL""",
}


def queries() -> dict:
    fs = [
        source_records, source_lookup, descriptor, delete_census, delete_source, label_swap, promote_dev, upsert_entities, ensure_nodes, dag_replace, ontology_crossed, legacy_entities, legacy_relations,
        chunks_in_order, group_types, merged_provenance, filled_provenance, ontology_resolved, table_text, page_text, headings, joined_headings,
    ]
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
