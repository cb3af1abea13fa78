"""Queries over sources, counters, upserts and deletes."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.operators import catalog as C
from loomgraph.sources.rebase import SQL_CHUNKS, SQL_SOURCES, chunks, read, sources, vectors



def flt_content(spark, d):
    kind = F.when(F.col("id") % 5 == 0, "referencias").when(F.col("id") % 5 == 1, "indice").when(F.col("id") % 5 == 2, F.lit(None)).otherwise("body")
    return C.content_only(chunks(spark, d).withColumn("kind", kind)).select("id", "source_id", "kind")


def flt_sources(spark, d):
    return C.apply_filters(chunks(spark, d), sources(spark, d), {"source_id": "src1", "source_ids": ["src2", " ", "src4"], "exclude": "src2"}).select("id", "source_id")


def flt_book_semi(spark, d):
    return C.apply_filters(chunks(spark, d), sources(spark, d), {"collections": ["shelf1", "shelf2"], "kinds": ["bibliografia"]}).select("id", "source_id")


def flt_contains_ci(spark, d):
    return read(spark, d, "part").filter(C.contains_ci(F.col("p_name"), "AL")).select("p_partkey", "p_name")


def flt_min_words(spark, d):
    w = read(spark, d, "documents").select("doc_id", F.size(T.words(F.col("text"))).alias("word_count"))
    return w.filter("word_count >= 100").orderBy("doc_id").offset(10).limit(50)


def flt_missing_emb(spark, d):
    return chunks(spark, d).join(vectors(spark, d), "id", "left_anti").select("id", "source_id", "chunk_index")


def units_by_source(spark, d):
    return C.unit_counts(chunks(spark, d), vectors(spark, d))


def catalog_sources(spark, d):
    return C.catalogue(chunks(spark, d), vectors(spark, d), sources(spark, d))


def catalog_filtered(spark, d):
    return C.filter_catalogue(catalog_sources(spark, d), status="parcial", q="TITLE", fields={"registered": "true"})


def cursor_page(spark, d):
    return C.page(catalog_sources(spark, d), "-stats.units", 7, C.cursor_of(7))


def unregistered_sources(spark, d):
    return chunks(spark, d).select("source_id").distinct().join(sources(spark, d).select(F.col("id").alias("source_id")), "source_id", "left_anti")


def source_quality_rollup(spark, d):
    q = F.when(F.col("id") % 4 == 0, "corrupta").when(F.col("id") % 9 == 0, "dudosa").when(F.col("id") % 3 == 0, F.lit(None)).otherwise("ok")
    return C.quality_rollup(chunks(spark, d).withColumn("quality", q))


def _versions(spark, d):
    """The table before, with vectors, and a new load of every registered source: texts changed, chunks dropped and added."""
    old = chunks(spark, d).join(vectors(spark, d).select("id", "embedding"), "id", "left").select("id", "source_id", "text", "embedding")
    few = chunks(spark, d).join(sources(spark, d).select(F.col("id").alias("source_id")), "source_id", "left_semi")
    new = few.filter("id % 7 <> 0").select("id", "source_id", F.when(F.col("id") % 5 == 0, F.concat("text", F.lit(" new"))).otherwise(F.col("text")).alias("text"))
    extra = few.filter("id % 11 = 0").select((F.col("id") + 1000000).alias("id"), "source_id", "text")
    return old, new.unionByName(extra)


def upsert_embedding_invalidation(spark, d):
    old, new = _versions(spark, d)
    return C.upsert(old, new).select("id", "source_id", F.md5("text").alias("text_md5"), F.col("embedding").isNotNull().alias("embedded"))


def orphan_chunks(spark, d):
    return C.orphans(*_versions(spark, d)).select("id", "source_id")


def skip_loaded(spark, d):
    old, new = _versions(spark, d)
    return C.skip_loaded(new, old.filter("id % 3 <> 0"))


def next_edges(spark, d):
    return C.next_edges(chunks(spark, d))


def child_of_edges(spark, d):
    c = chunks(spark, d).withColumn("parent_id", F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise((F.col("id") / 3).cast("long") * 3))
    return C.child_of_edges(c, chunks(spark, d).filter("id % 6 = 0").select("id"))


def contains_edges(spark, d):
    have = chunks(spark, d).filter("id % 2 = 0").select(F.col("source_id").alias("src"), F.col("id").alias("dst"))
    want = chunks(spark, d).join(sources(spark, d).select(F.col("id").alias("src")), F.col("source_id") == F.col("src")).select("src", F.col("id").alias("dst"))
    return want.join(have, ["src", "dst"], "left_anti")


def mentions(spark, d):
    """Entities of a chunk: its distinct words that end in tion, heit or mente."""
    x = chunks(spark, d).select(F.col("id").alias("chunk_id"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[a-z]{2,}(?:tion|heit|mente)"), F.lit(0)))).alias("name"))
    return x


def delete_preview(spark, d):
    return C.delete_preview(chunks(spark, d), mentions(spark, d), "src3")


def orphan_entities(spark, d):
    m = mentions(spark, d).join(chunks(spark, d).select(F.col("id").alias("chunk_id"), "source_id"), "chunk_id")
    return m.groupBy("name").agg(F.min("source_id").alias("lo"), F.max("source_id").alias("hi")).filter("lo = 'src3' and hi = 'src3'").select("name")


def unique_violations(spark, d):
    return C.assert_unique(read(spark, d, "part").select(T.fold_key(F.col("p_name")).alias("name")), "name")


def counts_verify(spark, d):
    c = chunks(spark, d)
    return c.agg(F.count("*").alias("chunks"), F.count_if(F.col("id") % 2 == 0).alias("live"), F.count_if(F.col("id") % 2 == 1).alias("backup"), F.count_distinct("source_id").alias("sources"))


def upsert_sources(spark, d):
    old = sources(spark, d).select("id", "title", "source_kind")
    new = old.filter("id < 'src15'").select("id", F.when(F.col("id") == "src1", "New title").alias("title"), F.lit("articulo").alias("source_kind"))
    return C.upsert_sources(old, new)


def prj_defaults(spark, d):
    c = chunks(spark, d).withColumn("kind", F.when(F.col("id") % 2 == 0, "tabla"))
    return C.project(c, ["id", "source_id"], {"kind": F.lit("body"), "version": F.lit(2), "chapter": F.lit("")})


def catalog_status_flow(spark, d):
    c = catalog_sources(spark, d)
    return c.groupBy("status", "registered").agg(F.count("*").alias("n"), F.sum("units").alias("units"))


_CAT = f"""{SQL_CHUNKS}, {SQL_SOURCES},
n AS (SELECT source_id, count(*) AS units, count(v.vec_id) AS embedded, min(page) AS first_page, max(page) AS last_page FROM chunks LEFT JOIN embeddings v ON vec_id = id GROUP BY 1),
cat AS (SELECT coalesce(s.id, n.source_id) AS id, coalesce(s.title, n.source_id) AS title, coalesce(s.source_kind, 'bibliografia') AS kind, s.id IS NOT NULL AS registered,
  coalesce(units, 0) AS units, coalesce(embedded, 0) AS embedded, last_page AS pages, CASE WHEN coalesce(units, 0) = 0 THEN 'fallido' WHEN embedded < units THEN 'parcial' ELSE 'ok' END AS status
  FROM sources s FULL JOIN n ON n.source_id = s.id)"""
_VER = f"""{SQL_CHUNKS}, {SQL_SOURCES}, few AS (SELECT * FROM chunks WHERE source_id IN (SELECT id FROM sources)),
new AS (SELECT id, source_id, CASE WHEN id % 5 = 0 THEN text || ' new' ELSE text END AS text FROM few WHERE id % 7 <> 0 UNION ALL SELECT id + 1000000, source_id, text FROM few WHERE id % 11 = 0)"""
_MEN = f"{SQL_CHUNKS}, m AS (SELECT DISTINCT id AS chunk_id, source_id, unnest(regexp_extract_all(lower(text), '[a-z]{{2,}}(?:tion|heit|mente)')) AS name FROM chunks)"
_K = "CASE id % 5 WHEN 0 THEN 'referencias' WHEN 1 THEN 'indice' WHEN 2 THEN NULL ELSE 'body' END"
SQL = {
    "flt_content": f"WITH {SQL_CHUNKS} SELECT id, source_id, {_K} AS kind FROM chunks WHERE coalesce({_K}, 'body') NOT IN ('referencias', 'indice')",
    "flt_sources": f"WITH {SQL_CHUNKS} SELECT id, source_id FROM chunks WHERE source_id IN ('src1', 'src2', 'src4') AND source_id <> 'src2'",
    "flt_book_semi": f"WITH {SQL_CHUNKS}, {SQL_SOURCES} SELECT id, source_id FROM chunks c WHERE EXISTS (SELECT 1 FROM sources s WHERE s.id = c.source_id AND list_has_any(collections, ['shelf1', 'shelf2']) AND coalesce(source_kind, 'bibliografia') IN ('bibliografia'))",
    "flt_contains_ci": "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'al')",
    "flt_min_words": "SELECT * FROM (SELECT doc_id, len(list_filter(string_split_regex(trim(text), '\\s+'), lambda x: x <> ''))::INTEGER AS word_count FROM documents) WHERE word_count >= 100 ORDER BY doc_id LIMIT 50 OFFSET 10",
    "flt_missing_emb": f"WITH {SQL_CHUNKS} SELECT id, source_id, chunk_index FROM chunks WHERE id NOT IN (SELECT vec_id FROM embeddings)",
    "units_by_source": f"WITH {_CAT} SELECT * FROM n",
    "catalog_sources": f"WITH {_CAT} SELECT * FROM cat",
    "catalog_filtered": f"WITH {_CAT} SELECT * FROM cat WHERE status = 'parcial' AND registered AND contains(lower(id || ' ' || title), 'title')",
    "cursor_page": f"WITH {_CAT} SELECT * FROM cat ORDER BY units DESC, id LIMIT 7 OFFSET 7",
    "unregistered_sources": f"WITH {SQL_CHUNKS}, {SQL_SOURCES} SELECT DISTINCT source_id FROM chunks WHERE source_id NOT IN (SELECT id FROM sources)",
    "source_quality_rollup": f"""WITH {SQL_CHUNKS}, q AS (SELECT source_id, CASE WHEN id % 4 = 0 THEN 'corrupta' WHEN id % 9 = 0 THEN 'dudosa' WHEN id % 3 = 0 THEN NULL ELSE 'ok' END AS q FROM chunks),
      g AS (SELECT source_id, count(q) AS measured, count(*) FILTER (q IN ('corrupta', 'dudosa')) AS degraded FROM q GROUP BY 1)
      SELECT source_id, measured, degraded, round(degraded / nullif(measured, 0), 6) AS fraction, CASE WHEN measured = 0 THEN NULL WHEN degraded / measured > 0.30 THEN 'corrupta' WHEN degraded / measured > 0.10 THEN 'dudosa' ELSE 'ok' END AS quality FROM g""",
    "upsert_embedding_invalidation": f"""WITH {_VER}, old AS (SELECT c.id, source_id, text, v.vec_id IS NOT NULL AS e FROM chunks c LEFT JOIN embeddings v ON vec_id = c.id)
      SELECT id, source_id, md5(text) AS text_md5, e AS embedded FROM old WHERE source_id NOT IN (SELECT id FROM sources)
      UNION ALL SELECT n.id, n.source_id, md5(n.text), coalesce(o.text = n.text AND o.e, false) FROM new n LEFT JOIN old o ON o.id = n.id""",
    "orphan_chunks": f"WITH {_VER} SELECT id, source_id FROM few WHERE id NOT IN (SELECT id FROM new)",
    "skip_loaded": f"WITH {_VER}, a AS (SELECT source_id, count(*) AS incoming FROM new GROUP BY 1), b AS (SELECT source_id, count(*) AS existing FROM chunks WHERE id % 3 <> 0 GROUP BY 1) SELECT source_id, incoming, coalesce(existing, 0) AS existing FROM a LEFT JOIN b USING (source_id) WHERE coalesce(existing, 0) < incoming",
    "next_edges": f"WITH {SQL_CHUNKS} SELECT * FROM (SELECT id AS src, lead(id) OVER (PARTITION BY source_id ORDER BY chunk_index) AS dst FROM chunks) WHERE dst IS NOT NULL",
    "child_of_edges": "SELECT doc_id AS src, doc_id // 3 * 3 AS dst FROM documents WHERE doc_id % 4 <> 0 AND (doc_id // 3 * 3) IN (SELECT doc_id FROM documents WHERE doc_id % 6 = 0)",
    "contains_edges": f"WITH {SQL_SOURCES} SELECT source AS src, doc_id AS dst FROM documents WHERE doc_id % 2 = 1 AND source IN (SELECT id FROM sources)",
    "mentions": f"WITH {_MEN} SELECT chunk_id, name FROM m",
    "delete_preview": f"""WITH {_MEN}, p AS (SELECT name, max((source_id = 'src3')::INT) AS own, max((source_id <> 'src3')::INT) AS other FROM m GROUP BY 1)
      SELECT (SELECT count(*) FROM chunks WHERE source_id = 'src3') AS units, (SELECT count(*) FROM m WHERE source_id = 'src3') AS relations, sum(own)::BIGINT AS entities, count(*) FILTER (own = 1 AND other = 0) AS orphan_entities FROM p""",
    "orphan_entities": f"WITH {_MEN} SELECT name FROM m GROUP BY name HAVING min(source_id) = 'src3' AND max(source_id) = 'src3'",
    "unique_violations": "SELECT trim(regexp_replace(lower(strip_accents(p_name)), '[^a-z0-9]+', ' ', 'g')) AS name, count(*) AS count FROM part GROUP BY 1 HAVING count(*) > 1",
    "counts_verify": "SELECT count(*) AS chunks, count(*) FILTER (doc_id % 2 = 0) AS live, count(*) FILTER (doc_id % 2 = 1) AS backup, count(DISTINCT source) AS sources FROM documents",
    "upsert_sources": f"WITH {SQL_SOURCES} SELECT id, CASE WHEN id = 'src1' THEN 'New title' ELSE title END AS title, CASE WHEN id < 'src15' THEN 'articulo' ELSE source_kind END AS source_kind FROM sources",
    "prj_defaults": "SELECT doc_id AS id, source AS source_id, CASE WHEN doc_id % 2 = 0 THEN 'tabla' ELSE 'body' END AS kind, 2 AS version, coalesce(lang, '') AS chapter FROM documents",
    "catalog_status_flow": f"WITH {_CAT} SELECT status, registered, count(*) AS n, sum(units)::BIGINT AS units FROM cat GROUP BY ALL",
}


def queries() -> dict:
    fs = [
        flt_content, flt_sources, flt_book_semi, flt_contains_ci, flt_min_words, flt_missing_emb, units_by_source, catalog_sources, catalog_filtered, cursor_page, unregistered_sources,
        source_quality_rollup, upsert_embedding_invalidation, orphan_chunks, skip_loaded, next_edges, child_of_edges, contains_edges, mentions, delete_preview, orphan_entities,
        unique_violations, counts_verify, upsert_sources, prj_defaults, catalog_status_flow,
    ]
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
