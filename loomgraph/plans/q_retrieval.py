"""Queries over retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.operators import catalog as C
from loomgraph.operators import retrieval as R
from loomgraph.sources.files import scratch
from loomgraph.sources.rebase import SQL_CHUNKS, SQL_SOURCES, chunks, read, sources, vectors

QUERY, SECOND, THIRD = "the erth, of [thing] ation", "ciónes de la", "einer schaft"
SEED = 7


def _seed(spark, d) -> list[float]:
    return list(vectors(spark, d).filter(F.col("id") == SEED).first()["embedding"])


_indexes: dict[tuple, R.Index] = {}


def index(spark, d, fields=("text",)) -> R.Index:
    """The stored index of the chunks; built once for a session and folder."""
    key = (spark.sparkContext.applicationId, d, fields)
    if key not in _indexes:
        docs = chunks(spark, d).withColumn("keywords", F.concat_ws(" ", "chapter", "section"))
        _indexes[key] = R.Index.build(docs, list(fields), scratch(spark))
    return _indexes[key]


def _lexical(spark, d, query=QUERY, docs=None, fields=("text",)):
    return index(spark, d, fields).bm25(R.query_terms(spark, query), docs)


def keyword_bm25_top40(spark, d):
    return R.top(_lexical(spark, d), 40)


def keyword_bm25_four_fields(spark, d):
    return R.top(_lexical(spark, d, "erth src1 en de", fields=("text", "section", "chapter", "keywords")), 40)


def search_index_build(spark, d):
    """Builds the index anew and tells how many postings and documents of each field it has."""
    made = R.Index.build(chunks(spark, d), ["text", "section"], scratch(spark))
    n = made.postings.groupBy("field").agg(F.count("*").alias("postings"), F.count_distinct("term").alias("terms"))
    return n.join(made.stats, "field").select("field", "postings", "terms", "n", F.round("a", 6).alias("mean_length"))


def semantic_cosine_top40(spark, d):
    return R.top(R.cosine(vectors(spark, d), _seed(spark, d)), 40)


def semantic_index_score(spark, d):
    return R.top(R.cosine(vectors(spark, d), _seed(spark, d), index_scale=True), 40)


def _fused(spark, d):
    return R.rrf([R.top(_lexical(spark, d)), R.top(_lexical(spark, d, SECOND)), R.top(R.cosine(vectors(spark, d), _seed(spark, d)))])


def hybrid_rrf_top20(spark, d):
    return _fused(spark, d).orderBy(F.desc("rrf_score"), "id").limit(20)


def hybrid_filtered_top20(spark, d):
    docs = C.apply_filters(chunks(spark, d), sources(spark, d), {"collections": ["shelf1"], "exclude": ["src4"]})
    vecs = vectors(spark, d).join(docs.select("id"), "id", "left_semi")
    both = R.rrf([R.top(_lexical(spark, d, QUERY, docs)), R.top(R.cosine(vecs, _seed(spark, d)))])
    return both.orderBy(F.desc("rrf_score"), "id").limit(20)


def guarantee_floor(spark, d):
    c = chunks(spark, d)
    mine = c.filter(F.col("source_id").isin("src3", "src7"))
    general = [R.top(_lexical(spark, d)), R.top(R.cosine(vectors(spark, d), _seed(spark, d), True))]
    restricted = [R.top(_lexical(spark, d, QUERY, mine)), R.top(R.cosine(vectors(spark, d).join(mine.select("id"), "id", "left_semi"), _seed(spark, d), True))]
    return R.passes_floor(mine.select("id"), general, restricted)


def _hits(spark, d):
    c = chunks(spark, d).select("id", "source_id", "page", (F.floor(F.col("id") / 4) * 4).cast("long").alias("parent_id"))
    return _fused(spark, d).select("id", "rrf_score").join(c, "id")


def group_by_parent(spark, d):
    g = R.group_hits(_hits(spark, d), "parent")
    return g.select("id", "parent_id", "rrf_score", F.size("units").alias("n_units"), F.array_join(F.transform("units", lambda u: u["id"].cast("string")), ",").alias("unit_ids"))


def group_by_page(spark, d):
    g = R.group_hits(_hits(spark, d).withColumn("page", F.floor(F.col("page") / 3)), "page")
    return g.select("id", "source_id", "page", "rrf_score", F.size("units").alias("n_units"))


def quota_select(spark, d):
    h = _hits(spark, d)
    return R.quota(h, h.filter(F.col("source_id").isin("src3", "src7", "src9")), 20, 6).select("id", "source_id", "rrf_score", "guaranteed")


def quota_select_capped(spark, d):
    h = _hits(spark, d)
    return R.quota_capped(h, h.filter(F.col("source_id").isin("src3", "src7", "src9")), 20, 6, 2).select("id", "source_id", "rrf_score", "guaranteed")


def provenance_counts(spark, d):
    return R.provenance(_hits(spark, d))


def facet_dedup(spark, d):
    facets = [R.top(_lexical(spark, d, q), 30).select(F.lit(i).alias("facet_order"), "id", "score") for i, q in enumerate((QUERY, SECOND, THIRD, "the"))]
    out = facets[0]
    for f in facets[1:]:
        out = out.unionAll(f)
    return R.facet_dedup(out)


def subquery_sum(spark, d):
    return R.sum_subqueries([R.top(_lexical(spark, d, q), 20) for q in (QUERY, SECOND, "the of", "the")], 15)


def legacy_term_score_top5(spark, d):
    return R.term_count_score(chunks(spark, d), ["erth", "thing", "ation", "cion"]).orderBy(F.desc("score"), "id").limit(5)


def postings_index(spark, d):
    p = R.postings(chunks(spark, d), ["text", "section"])
    return p.groupBy("field", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def _asked(spark, d):
    t = F.lower("text")
    return read(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat(t, F.lit(" vs ation"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("what is "), t, F.lit(" of the ation?"))).otherwise(F.concat_ws(" ", F.lit("how heit"), t)).alias("q"))


def query_expand(spark, d):
    return _asked(spark, d).select("doc_id", R.expand(F.col("q")).alias("expanded"))


def intent_classify(spark, d):
    return _asked(spark, d).select("doc_id", R.intent(F.col("q")).alias("intent"))


def query_decompose(spark, d):
    return _asked(spark, d).select("doc_id", F.array_join(R.decompose(F.col("q")), " | ").alias("parts"))


def retrieval_degradation(spark, d):
    r = spark.range(12).select(F.col("id"), (F.col("id") % 4).alias("failed"), F.when(F.col("id") % 2 == 0, 0).otherwise(5).alias("found"))
    return r.select("id", R.degraded(F.col("failed"), F.lit(3), F.col("found")).alias("state"))


_BM = """
{n} AS (SELECT id, list_filter(string_split_regex(lower(strip_accents(text)), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS t FROM {src}),
{n}_s AS (SELECT count(*) AS n, avg(len(t)) AS a FROM {n}),
{n}_q AS (SELECT unnest({terms}) AS term),
{n}_f AS (SELECT id, term, len(t) AS dl, len(list_filter(t, lambda x: x = term)) AS tf FROM {n}, {n}_q),
{n}_d AS (SELECT term, count(*) FILTER (tf > 0) AS df FROM {n}_f GROUP BY 1),
{n}_r AS (SELECT id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / a))), 6) AS score
  FROM {n}_f JOIN {n}_d USING (term), {n}_s WHERE df > 0 GROUP BY id HAVING sum(tf) > 0),
{n}_top AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rank FROM {n}_r QUALIFY row_number() OVER (ORDER BY score DESC, id) <= {k})"""
_COS = """
{n}_r AS (SELECT v.vec_id AS id, round({scale}(list_dot_product(v.embedding::DOUBLE[], q.embedding::DOUBLE[]) / (sqrt(list_dot_product(v.embedding::DOUBLE[], v.embedding::DOUBLE[])) * sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])))){end}, 6) AS score
  FROM {src} v, (SELECT embedding FROM embeddings WHERE vec_id = 7) q),
{n}_top AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rank FROM {n}_r QUALIFY row_number() OVER (ORDER BY score DESC, id) <= {k})"""


def _bm(n, terms, k=150, src="chunks"):
    return _BM.format(n=n, terms=terms, k=k, src=src)


def _cos(n, k=150, src="embeddings", scale=False):
    return _COS.format(n=n, k=k, src=src, scale="(1 + " if scale else "", end=") / 2" if scale else "")


_T1, _T2, _T3 = ["the", "erth", "of", "thing", "ation"], ["ciones", "de", "la"], ["einer", "schaft"]
_FUSED = f"""{SQL_CHUNKS}, {_bm('a', _T1)}, {_bm('b', _T2)}, {_cos('c')},
fused AS (SELECT id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS rrf_score, count(*) AS routes FROM (SELECT id, rank FROM a_top UNION ALL SELECT id, rank FROM b_top UNION ALL SELECT id, rank FROM c_top) GROUP BY 1)"""
_HITS = f"""{_FUSED}, hits AS (SELECT id, rrf_score, source_id, page, id // 4 * 4 AS parent_id FROM fused JOIN chunks USING (id))"""
_ASKED = """asked AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN lower(text) || ' vs ation' WHEN 1 THEN 'what is ' || lower(text) || ' of the ation?' ELSE concat_ws(' ', 'how heit', lower(text)) END AS q FROM documents)"""


def _four_fields() -> str:
    parts, total = [], []
    for f, e in (("text", "text"), ("section", "section"), ("chapter", "chapter"), ("keywords", "chapter || ' ' || section")):
        parts.append(_bm(f"f_{f}", ["erth", "src1", "en", "de"], 150, f"(SELECT id, {e} AS text FROM chunks)").split(f",\nf_{f}_top")[0].replace("round(sum(", "(sum(").replace("), 6) AS score", ")) AS score"))
        total.append(f"SELECT id, score FROM f_{f}_r")
    return f"WITH {SQL_CHUNKS}, {', '.join(parts)}, s AS (SELECT id, round(sum(score), 6) AS score FROM ({' UNION ALL '.join(total)}) GROUP BY 1) SELECT *, row_number() OVER (ORDER BY score DESC, id)::INTEGER AS rank FROM s ORDER BY score DESC, id LIMIT 40"


SQL = {
    "keyword_bm25_top40": f"WITH {SQL_CHUNKS}, {_bm('a', _T1, 40)} SELECT id, score, rank::INTEGER AS rank FROM a_top",
    "keyword_bm25_four_fields": _four_fields(),
    "semantic_cosine_top40": f"WITH {_cos('c', 40)} SELECT id, score, rank::INTEGER AS rank FROM c_top",
    "semantic_index_score": f"WITH {_cos('c', 40, scale=True)} SELECT id, score, rank::INTEGER AS rank FROM c_top",
    "hybrid_rrf_top20": f"WITH {_FUSED} SELECT * FROM fused ORDER BY rrf_score DESC, id LIMIT 20",
    "hybrid_filtered_top20": f"""WITH {SQL_CHUNKS}, {SQL_SOURCES}, ok AS (SELECT c.* FROM chunks c JOIN sources s ON s.id = source_id WHERE list_contains(collections, 'shelf1') AND source_id <> 'src4'),
      {_bm('w', _T1, 150)}, a_top AS (SELECT id, score, row_number() OVER (ORDER BY score DESC, id) AS rank FROM w_r WHERE id IN (SELECT id FROM ok) QUALIFY row_number() OVER (ORDER BY score DESC, id) <= 150), {_cos('c', 150, '(SELECT * FROM embeddings WHERE vec_id IN (SELECT id FROM ok))')}
      SELECT id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS rrf_score, count(*) AS routes FROM (SELECT id, rank FROM a_top UNION ALL SELECT id, rank FROM c_top) GROUP BY 1 ORDER BY rrf_score DESC, id LIMIT 20""",
    "guarantee_floor": f"""WITH {SQL_CHUNKS}, mine AS (SELECT * FROM chunks WHERE source_id IN ('src3', 'src7')), {_bm('a', _T1)}, {_cos('c', scale=True)}, m_top AS (SELECT id, score FROM a_r WHERE id IN (SELECT id FROM mine) QUALIFY row_number() OVER (ORDER BY score DESC, id) <= 150), {_cos('v', 150, '(SELECT * FROM embeddings WHERE vec_id IN (SELECT id FROM mine))', True)}
      SELECT id FROM mine WHERE id IN (SELECT id FROM m_top WHERE score >= 0.5 * (SELECT max(score) FROM a_top)) OR id IN (SELECT id FROM v_top WHERE score >= 0.5 * (SELECT max(score) FROM c_top))""",
    "group_by_parent": f"""WITH {_HITS} SELECT (list(id ORDER BY rrf_score DESC, id))[1] AS id, parent_id, max(rrf_score) AS rrf_score, count(*)::INTEGER AS n_units, string_agg(id::VARCHAR, ',' ORDER BY rrf_score DESC, id DESC) AS unit_ids FROM hits GROUP BY parent_id""",
    "group_by_page": f"""WITH {_HITS} SELECT (list(id ORDER BY rrf_score DESC, id))[1] AS id, source_id, page // 3 AS page, max(rrf_score) AS rrf_score, count(*)::INTEGER AS n_units FROM hits GROUP BY source_id, page // 3""",
    "quota_select": f"""WITH {_HITS}, g AS (SELECT *, true AS guaranteed FROM hits WHERE source_id IN ('src3', 'src7', 'src9') ORDER BY rrf_score DESC, id LIMIT 6),
      r AS (SELECT *, false AS guaranteed FROM hits WHERE id NOT IN (SELECT id FROM g) ORDER BY rrf_score DESC, id LIMIT (20 - (SELECT count(*) FROM g)))
      SELECT id, source_id, rrf_score, guaranteed FROM g UNION ALL SELECT id, source_id, rrf_score, guaranteed FROM r""",
    "provenance_counts": f"WITH {_HITS} SELECT source_id, count(*) AS n FROM hits GROUP BY 1",
    "facet_dedup": f"""WITH {SQL_CHUNKS}, {_bm('a', _T1, 30)}, {_bm('b', _T2, 30)}, {_bm('c', _T3, 30)}, {_bm('e', ['the'], 30)},
      u AS (SELECT 0 AS facet_order, id, score FROM a_top UNION ALL SELECT 1, id, score FROM b_top UNION ALL SELECT 2, id, score FROM c_top UNION ALL SELECT 3, id, score FROM e_top)
      SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY id ORDER BY facet_order) = 1""",
    "subquery_sum": f"""WITH {SQL_CHUNKS}, {_bm('a', _T1, 20)}, {_bm('b', _T2, 20)}, {_bm('c', ['the', 'of'], 20)}, {_bm('e', ['the'], 20)}
      SELECT id, round(sum(score), 6) AS total FROM (SELECT id, score FROM a_top UNION ALL SELECT id, score FROM b_top UNION ALL SELECT id, score FROM c_top UNION ALL SELECT id, score FROM e_top) GROUP BY 1 ORDER BY total DESC, id LIMIT 15""",
    "legacy_term_score_top5": """WITH t AS (SELECT doc_id AS id, lower(translate(text, 'áéíóúüñÁÉÍÓÚÜÑ', 'aeiouunAEIOUUN')) AS t FROM documents), q AS (SELECT unnest(['erth', 'thing', 'ation', 'cion']) AS w),
      s AS (SELECT id, sum((length(t) - length(replace(t, w, ''))) // length(w)) AS n, count(*) FILTER (contains(t, w)) AS f, count(*) FILTER (contains(t[:200], w)) AS h FROM t, q GROUP BY id)
      SELECT id, (n + 3 * h + 2 * f)::BIGINT AS score FROM s WHERE f >= 2 ORDER BY score DESC, id LIMIT 5""",
    "postings_index": f"""WITH {SQL_CHUNKS}, p AS (SELECT 'text' AS field, id, unnest(list_filter(string_split_regex(lower(strip_accents(text)), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')) AS term FROM chunks
      UNION ALL SELECT 'section', id, unnest(list_filter(string_split_regex(lower(strip_accents(section)), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')) FROM chunks)
      SELECT field, term, count(DISTINCT id) AS df, count(*) AS cf FROM p GROUP BY ALL""",
    "search_index_build": f"""WITH {SQL_CHUNKS}, p AS (SELECT 'text' AS field, id, list_filter(string_split_regex(lower(strip_accents(text)), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS t FROM chunks
      UNION ALL SELECT 'section', id, list_filter(string_split_regex(lower(strip_accents(section)), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') FROM chunks),
      s AS (SELECT field, count(*) AS n, round(avg(len(t)), 6) AS mean_length FROM p GROUP BY 1), u AS (SELECT DISTINCT field, id, unnest(t) AS term FROM p)
      SELECT field, count(*) AS postings, count(DISTINCT term) AS terms, any_value(n) AS n, any_value(mean_length) AS mean_length FROM u JOIN s USING (field) GROUP BY field""",
    "query_expand": f"""WITH {_ASKED}, w AS (SELECT doc_id, q, list_transform(list_filter(string_split_regex(trim(lower(q)), '\\s+'), lambda x: x <> ''), lambda x: trim(x, '.,;:?!()')) AS t FROM asked),
      s AS (SELECT *, array_to_string(list_filter(list_transform(t, lambda x: CASE x WHEN 'ation' THEN 'tion ing' WHEN 'heit' THEN 'keit' ELSE '' END), lambda x: x <> ''), ' ') AS e FROM w)
      SELECT doc_id, trim(q || CASE WHEN e <> '' THEN ' ' || e ELSE '' END || CASE WHEN contains(lower(q), 'of the') THEN ' von der' ELSE '' END) AS expanded FROM s""",
    "intent_classify": f"""WITH {_ASKED}, s AS (SELECT doc_id, len(regexp_extract_all(q, '\\bwhat\\b')) + len(regexp_extract_all(q, '\\bis\\b')) AS a, len(regexp_extract_all(q, '\\bvs\\b')) + len(regexp_extract_all(q, '\\bor\\b')) AS b,
      len(regexp_extract_all(q, '\\btreat')) + len(regexp_extract_all(q, '\\bhow\\b')) AS c FROM asked)
      SELECT doc_id, CASE WHEN greatest(a, b, c) = 0 THEN 'general' WHEN a = greatest(a, b, c) THEN 'definition' WHEN b = greatest(a, b, c) THEN 'comparison' ELSE 'treatment' END AS intent FROM s""",
    "query_decompose": f"""WITH {_ASKED}, w AS (SELECT doc_id, q, list_filter(string_split_regex(trim(lower(q)), '\\s+'), lambda x: x <> '') AS w, string_split(lower(q), ' vs ') AS s FROM asked)
      SELECT doc_id, CASE WHEN len(w) <= 3 THEN q WHEN len(s) = 2 THEN q || ' | ' || trim(s[1]) || ' features | ' || trim(s[2]) || ' features'
        WHEN len(w) > 6 THEN q || ' | ' || array_to_string(list_filter(w, lambda x: x NOT IN ('the', 'of', 'in', 'a', 'for', 'and', 'de', 'la', 'to')), ' ') ELSE q END AS parts FROM w""",
    "retrieval_degradation": "SELECT i AS id, CASE WHEN i % 4 = 3 AND i % 2 = 0 THEN 'total' WHEN i % 4 > 0 THEN 'parcial' ELSE 'none' END AS state FROM range(12) t(i)",
}


def queries() -> dict:
    fs = [
        hybrid_rrf_top20, keyword_bm25_top40, keyword_bm25_four_fields, semantic_cosine_top40, semantic_index_score, hybrid_filtered_top20, guarantee_floor, group_by_parent, group_by_page, quota_select,
        quota_select_capped, provenance_counts, facet_dedup, subquery_sum, legacy_term_score_top5, postings_index, search_index_build, query_expand, intent_classify, query_decompose, retrieval_degradation,
    ]
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
