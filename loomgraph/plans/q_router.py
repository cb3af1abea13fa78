"""Queries over routing, entity search, guarantees and bundles."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.operators import graph as G
from loomgraph.operators import retrieval as R
from loomgraph.operators import router as Q
from loomgraph.plans import q_graph
from loomgraph.plans.q_retrieval import _BM, _FUSED, _T1, QUERY, SECOND, _bm, _cos, _lexical, _seed, index
from loomgraph.sources.rebase import SQL_CHUNKS, SQL_EDGES, SQL_NODES, chunks, edges, nodes, read, vectors


def router_fallback(spark, d):
    cue = F.element_at(F.array(*map(F.lit, ("", " MANEJO DE ", " clasificación ", " qué tipo: qué hago "))), (F.col("doc_id") % 4 + 1).cast("int"))
    return read(spark, d, "documents").select("doc_id", F.array_join(Q.fallback_layers(F.concat("text", cue)), ",").alias("layers"))


def type_alias(spark, d):
    """Aliases in other cases and with blanks around, beside words that are none: brands and plurals as labels."""
    known = spark.createDataFrame([(a,) for a in Q._table(Q.TYPE_ALIASES)], "type string").select(F.concat(F.lit(" "), F.upper("type")).alias("type"), F.lit("").alias("label"))
    plural = spark.createDataFrame([(a,) for a in Q._table(Q.LABEL_ALIASES)], "label string").select(F.lit("test").alias("type"), F.initcap("label").alias("label"))
    rest = read(spark, d, "part").select(F.col("p_brand").alias("type"), F.col("p_type").alias("label")).distinct()
    asked = known.unionAll(plural).unionAll(rest).select(F.col("type").alias("asked_type"), F.col("label").alias("asked_label"), "type", "label")
    return Q.normalise_types(asked)


def router_notice(spark, d):
    r = read(spark, d, "region").select(F.col("r_regionkey").alias("k"), F.when(F.col("r_regionkey") == 0, "total").when(F.col("r_regionkey") == 1, "parcial").otherwise("none").alias("level"))
    n = r.withColumn("n", Q.notice(F.col("level")))
    return n.select("k", F.col("n")["degraded"].alias("degraded"), F.left(F.col("n")["notice"], F.lit(8)).alias("starts"))


def _entities(spark, d):
    deg = G.degree(nodes(spark, d), edges(spark, d))
    return deg.withColumn("freq", F.col("degree"))


def entity_search(spark, d):
    """Names that hold the query, as without an index."""
    return Q.search_entities(_entities(spark, d), " PART 1 ", 20, indexed=False).select("label", "name", "freq", "degree", "score")


def entity_search_bm25(spark, d):
    return Q.search_entities(_entities(spark, d), "supplier part 7", 30).select("label", "name", "freq", "degree", "score")


def topic_relations(spark, d):
    return Q.topic_relations(_entities(spark, d), edges(spark, d), "supplier", indexed=False)


def concept_expansion(spark, d):
    n = _entities(spark, d)
    name = q_graph._first(spark, d, "Nation")
    out = Q.expand_concept(n, edges(spark, d), "Nation", name, ["IN_NATION", "IN_REGION"], 40)
    return out["edges"]


def _placed(spark, d):
    return chunks(spark, d).withColumn("parent_id", (F.floor(F.col("id") / 4) * 4).cast("long"))


def _guaranteed(spark, d):
    """Two lexical routes and a semantic one; src3, src7 and src9 are guaranteed, of which the request allows two."""
    allowed = Q.allowed_sources(["src9", "src3", "src7"], ["src3", "src7", "src1"])
    mine = chunks(spark, d).filter(F.col("source_id").isin(allowed)).select("id")
    vecs = vectors(spark, d)
    general = [R.top(_lexical(spark, d)), R.top(_lexical(spark, d, SECOND)), R.top(R.cosine(vecs, _seed(spark, d), True))]
    restricted = [R.top(_lexical(spark, d, QUERY, mine)), R.top(R.cosine(vecs.join(mine, "id", "left_semi"), _seed(spark, d), True))]
    return Q.guaranteed_hybrid(general, restricted, [(0, 0), (2, 1)], _placed(spark, d), 20, 6, "parent")


def guaranteed_hybrid(spark, d):
    top, _ = _guaranteed(spark, d)
    return top.select("id", "source_id", "parent_id", "rrf_score", "guaranteed", F.size("units").alias("n_units"))


def hybrid_provenance(spark, d):
    return Q.provenance(*_guaranteed(spark, d))


def chunk_results(spark, d):
    c = chunks(spark, d).withColumn("kind", F.lit("body"))
    return Q.chunk_results(R.top(_lexical(spark, d), 40).select("id", "score"), c).withColumn("text", F.md5("text"))


TOPIC = "erth"


def _facet_search(spark, d):
    ix = index(spark, d)

    def search(query: str, k: int):
        hits = R.top(ix.bm25(R.query_terms(spark, query)), k).select("id", F.round(1.0 / (60 + F.col("rank")), 6).alias("rrf_score"))
        return hits.join(chunks(spark, d).select("id", "source_id"), "id")

    return search


FACETS = [("definition", "the of"), ("context", "de la"), ("risks", "thing ation")]


def deep_dive(spark, d):
    return Q.deep_dive(_facet_search(spark, d), TOPIC, FACETS, 12)


def report_provenance(spark, d):
    """Each facet's pool is its search of 30."""
    kept, search, pools = Q.deep_dive(_facet_search(spark, d), TOPIC, FACETS, 12), _facet_search(spark, d), None
    for _, terms in FACETS:
        pool = search(f"{TOPIC} {terms}", 30)
        p = Q.provenance(pool.orderBy(F.desc("rrf_score"), "id").limit(12).withColumn("guaranteed", F.col("source_id").isin("src3", "src7")), pool)
        pools = p if pools is None else pools.unionAll(p)
    return Q.report_provenance(kept, pools)


def api_query(spark, d):
    layers = {
        "BIBLIOGRAPHY": lambda: R.top(_lexical(spark, d), 5).select("id", "rank"),
        "GRAPH": lambda: q_graph.graph_relations(spark, d),
        "DAGS": lambda: q_graph.dag_list(spark, d),
        "ONTOLOGY": lambda: q_graph.ontology_down(spark, d),
    }
    return Q.layer_results(Q.answer(spark, "¿Cómo manejar the erth, of thing ation?", layers))


_ENT = f"{SQL_NODES}, {SQL_EDGES}, {q_graph._DEG}, ent AS (SELECT label, name, degree AS freq, degree FROM deg)"
_GUAR = f"""{_FUSED.replace(_cos('c'), _cos('c', scale=True))}, mine AS (SELECT id FROM chunks WHERE source_id IN ('src3', 'src7')),
m_top AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rank FROM (SELECT id, score FROM a_r WHERE id IN (SELECT id FROM mine)) QUALIFY row_number() OVER (ORDER BY score DESC, id) <= 150),
v_top AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rank FROM (SELECT id, score FROM c_r WHERE id IN (SELECT id FROM mine)) QUALIFY row_number() OVER (ORDER BY score DESC, id) <= 150),
sure AS (SELECT id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS s FROM (SELECT id, rank FROM m_top UNION ALL SELECT id, rank FROM v_top) GROUP BY 1),
good AS (SELECT g.id, greatest(g.s, coalesce(f.rrf_score, 0)) AS rrf_score FROM sure g LEFT JOIN fused f ON f.id = g.id
  WHERE g.id IN (SELECT id FROM m_top WHERE score >= 0.5 * (SELECT max(score) FROM a_top)) OR g.id IN (SELECT id FROM v_top WHERE score >= 0.5 * (SELECT max(score) FROM c_top))),
seen AS (SELECT * FROM fused WHERE id IN (SELECT id FROM chunks)),
ga AS (SELECT (list(id ORDER BY rrf_score DESC, id))[1] AS id, max(rrf_score) AS rrf_score, count(*)::INTEGER AS n_units FROM seen GROUP BY id // 4),
gb AS (SELECT (list(id ORDER BY rrf_score DESC, id))[1] AS id, max(rrf_score) AS rrf_score, count(*)::INTEGER AS n_units FROM good GROUP BY id // 4),
one AS (SELECT *, true AS guaranteed FROM gb ORDER BY rrf_score DESC, id LIMIT 6),
two AS (SELECT *, false AS guaranteed FROM ga WHERE id NOT IN (SELECT id FROM one) ORDER BY rrf_score DESC, id LIMIT (20 - (SELECT count(*) FROM one))),
res AS (SELECT r.id, source_id, r.id // 4 * 4 AS parent_id, rrf_score, guaranteed, n_units FROM (SELECT * FROM one UNION ALL SELECT * FROM two) r JOIN chunks c ON c.id = r.id),
pool AS (SELECT id FROM seen UNION SELECT id FROM good)"""
_FACETS = f"""{SQL_CHUNKS}, {_bm('a', ['erth', 'the', 'of'], 30)}, {_bm('b', ['erth', 'de', 'la'], 30)}, {_bm('c', ['erth', 'thing', 'ation'], 30)},
every AS (SELECT 0 AS facet_order, 'definition' AS facet, id, rank FROM a_top UNION ALL SELECT 1, 'context', id, rank FROM b_top UNION ALL SELECT 2, 'risks', id, rank FROM c_top),
kept AS (SELECT facet_order, facet, e.id, source_id, round(1.0::DOUBLE / (60 + rank), 6) AS rrf_score FROM every e JOIN chunks c ON c.id = e.id WHERE rank <= 12 QUALIFY row_number() OVER (PARTITION BY e.id ORDER BY facet_order) = 1)"""
_ALIASES = ", ".join(f"('{a}', '{t}', '{x}')" for a, (t, x) in Q._table(Q.TYPE_ALIASES).items())
_PLURALS = ", ".join(f"('{a}', '{x}')" for a, (x,) in Q._table(Q.LABEL_ALIASES).items())
SQL = {
    "router_fallback": """WITH q AS (SELECT doc_id, lower(text || CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN ' MANEJO DE ' WHEN 2 THEN ' clasificación ' ELSE ' qué tipo: qué hago ' END) AS q FROM documents)
      SELECT doc_id, concat_ws(',', 'BIBLIOGRAPHY', CASE WHEN contains(q, 'qué hago') OR contains(q, 'que hago') OR contains(q, 'cómo manejar') OR contains(q, 'como manejar') OR contains(q, 'ante un paciente') OR contains(q, 'manejo de') THEN 'DAGS' END, 'GRAPH',
        CASE WHEN contains(q, 'clasificación') OR contains(q, 'clasificacion') OR contains(q, 'qué tipo') OR contains(q, 'que tipo') OR contains(q, 'a qué clase') OR contains(q, 'pertenece') THEN 'ONTOLOGY' END) AS layers FROM q""",
    "type_alias": f"""WITH al(a, t, x) AS (VALUES {_ALIASES}), pl(a, x) AS (VALUES {_PLURALS}),
      q AS (SELECT ' ' || upper(a) AS type, '' AS label FROM al UNION ALL SELECT 'test', upper(a[1]) || a[2:] FROM pl UNION ALL SELECT DISTINCT p_brand, p_type FROM part)
      SELECT q.type AS asked_type, q.label AS asked_label, coalesce(al.t, q.type) AS type, coalesce(pl.x, al.x, q.label) AS label FROM q LEFT JOIN al ON al.a = lower(trim(q.type)) LEFT JOIN pl ON pl.a = lower(trim(q.label))""",
    "router_notice": "SELECT r_regionkey AS k, r_regionkey < 2 AS degraded, CASE r_regionkey WHEN 0 THEN 'WARNING:' WHEN 1 THEN 'NOTE: on' END AS starts FROM region",
    "entity_search": f"WITH {_ENT} SELECT *, 0.0::DOUBLE AS score FROM ent WHERE contains(lower(name), 'part 1') ORDER BY freq DESC, label, name LIMIT 20",
    "entity_search_bm25": f"""WITH {_ENT}, names AS (SELECT label || chr(9) || name AS id, name AS text FROM ent), {_BM.format(n='z', terms=['supplier', 'part', '7'], k=100000000, src='names')}
      SELECT label, name, freq, degree, score FROM ent JOIN z_top ON id = label || chr(9) || name ORDER BY score DESC, label, name LIMIT 30""",
    "topic_relations": f"""WITH {_ENT}, best AS (SELECT *, row_number() OVER (ORDER BY freq DESC, label, name) AS "at" FROM ent WHERE contains(lower(name), 'supplier') QUALIFY row_number() OVER (ORDER BY freq DESC, label, name) <= 2),
      n AS (SELECT "at", e.src, e.type, e.dst, dst_label AS ol, dst AS o FROM edges e JOIN best b ON b.label = src_label AND b.name = e.src UNION ALL SELECT "at", e.src, e.type, e.dst, src_label, e.src FROM edges e JOIN best b ON b.label = dst_label AND b.name = e.dst),
      r AS (SELECT n.*, row_number() OVER (PARTITION BY "at" ORDER BY coalesce(freq, 0) DESC, ol, o, type, src) AS rank FROM n LEFT JOIN ent ON ent.label = ol AND ent.name = o), w AS (SELECT * FROM r WHERE rank <= 12)
      SELECT src, type, dst FROM w ORDER BY "at", rank LIMIT 25""",
    "concept_expansion": f"""WITH {_ENT}, {q_graph._BOTH} SELECT DISTINCT type, other_label, other FROM (SELECT DISTINCT type, other_label, other, degree FROM bw LEFT JOIN deg ON deg.label = other_label AND deg.name = other
      WHERE bw.name = (SELECT min(n_name) FROM nation) AND type IN ('IN_NATION', 'IN_REGION') ORDER BY degree DESC, other, type LIMIT 40)""",
    "guaranteed_hybrid": f"WITH {_GUAR} SELECT * FROM res",
    "hybrid_provenance": f"""WITH {_GUAR} SELECT 'top_k' AS scope, source_id, count(*) AS n FROM res GROUP BY 2 UNION ALL SELECT 'pool', source_id, count(*) FROM pool JOIN chunks USING (id) GROUP BY 2
      UNION ALL SELECT 'guaranteed', NULL, count(*) FILTER (guaranteed) FROM res UNION ALL SELECT 'unique', NULL, count(*) FROM pool""",
    "chunk_results": f"WITH {SQL_CHUNKS}, {_bm('a', _T1, 40)} SELECT a_top.id, score, source_id, page, chapter, section, 'body' AS kind, NULL AS quality, md5(text) AS text FROM a_top JOIN chunks USING (id)",
    "deep_dive": f"WITH {_FACETS} SELECT * FROM kept",
    "report_provenance": f"""WITH {_FACETS}, p AS (SELECT facet_order, source_id, rank FROM every e JOIN chunks c ON c.id = e.id)
      SELECT 'top_k' AS scope, source_id, count(*) AS n FROM kept GROUP BY 2 UNION ALL SELECT 'pool', source_id, count(*) FROM p GROUP BY 2
      UNION ALL SELECT 'guaranteed', NULL, count(*) FILTER (source_id IN ('src3', 'src7')) FROM p WHERE rank <= 12 UNION ALL SELECT 'unique', NULL, count(*) FROM p""",
    "api_query": f"""WITH {SQL_EDGES}, {SQL_CHUNKS}, {_bm('a', _T1, 5)}, {q_graph._BOTH}, {q_graph._STEPS},
      g AS (SELECT DISTINCT name, type, other FROM bw WHERE contains(lower(name), (SELECT lower(min(n_name)) FROM nation)) ORDER BY name, type, other LIMIT 15),
      u AS (SELECT 'BIBLIOGRAPHY' AS layer, json_object('id', id, 'rank', rank)::VARCHAR AS payload FROM a_top UNION ALL SELECT 'GRAPH', json_object('name', name, 'type', type, 'other', other)::VARCHAR FROM g
        UNION ALL SELECT 'DAGS', json_object('dag', dag, 'kind', kind, 'n', count(*))::VARCHAR FROM dag GROUP BY dag, kind)
      SELECT layer, (row_number() OVER (PARTITION BY layer ORDER BY payload))::INTEGER AS rank, payload FROM u""",
}


def queries() -> dict:
    fs = [router_fallback, type_alias, router_notice, entity_search, entity_search_bm25, topic_relations, concept_expansion, guaranteed_hybrid, hybrid_provenance, chunk_results, deep_dive, report_provenance, api_query]
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
