"""Queries over the text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.sources.rebase import SQL_CHUNKS, chunks, read

FOLD = "lower(strip_accents({}))"
WORDS = "list_filter(string_split_regex(trim({}), '\\s+'), lambda x: x <> '')"


def fold_search_fields(spark, d):
    c = chunks(spark, d)
    return c.select("id", T.fold(F.col("text")).alias("text_search"), T.fold(F.col("section")).alias("section_search"), T.fold(F.col("chapter")).alias("chapter_search"), T.search_keywords(F.col("chapter"), F.col("section"), F.col("text")).alias("keywords"))


def embed_text_canonical(spark, d):
    c = chunks(spark, d)
    kind = F.when(F.col("id") % 3 == 0, "tabla").otherwise("body")
    return c.select("id", T.embedding_text(F.col("chapter"), F.col("section"), kind, F.col("text")).alias("canonical"))


def fn_fold_key(spark, d):
    return read(spark, d, "documents").select("doc_id", T.fold_key(F.col("text")).alias("key"))


def fn_slug(spark, d):
    return read(spark, d, "documents").select("doc_id", T.slug(F.col("text")).alias("slug"))


def fn_entity_name(spark, d):
    return read(spark, d, "documents").select("doc_id", T.entity_name(F.col("text")).alias("name"), T.entity_name(F.col("text"), accents=False).alias("plain"))


def fn_unaccent_positional(spark, d):
    t = F.col("text")
    return read(spark, d, "documents").select("doc_id", T.unaccent_in_place(t).alias("plain"), (F.length(T.unaccent_in_place(t)) == F.length(t)).alias("same_length"))


def fn_legacy_norm(spark, d):
    return read(spark, d, "documents").select("doc_id", T.legacy_unaccent(F.col("text")).alias("plain"))


def fn_query_terms(spark, d):
    return read(spark, d, "documents").select("doc_id", F.array_join(T.search_terms(F.col("text")), " ").alias("terms"))


def fn_line_key(spark, d):
    x = read(spark, d, "documents").select("doc_id", F.posexplode(T.lines(F.col("text"))).alias("line_no", "line"))
    return x.select("doc_id", "line_no", T.line_key(F.col("line")).alias("key"))


def fn_clean_page(spark, d):
    return read(spark, d, "documents").select("doc_id", T.clean_page(F.col("text")).alias("clean"))


def fn_clean_page_v1(spark, d):
    return read(spark, d, "documents").select("doc_id", T.clean_page_v1(F.col("text")).alias("clean"))


def _paged(spark, d):
    """Pages whose first or last line is a folio, made from the documents."""
    page = (F.col("doc_id") % 1000).cast("string")
    return read(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.concat(page, F.lit("\n"), "text")).otherwise(F.concat(F.col("text"), F.lit("\nchapter\n"), page)).alias("text"))


def fn_strip_folio(spark, d):
    return _paged(spark, d).select("doc_id", T.strip_folio(F.col("text")).alias("clean"))


def fn_folio_candidates(spark, d):
    return _paged(spark, d).select("doc_id", F.array_join(T.folio_candidates(F.col("text")).cast("array<string>"), ",").alias("folios"))


def quality_signatures(spark, d):
    s = {k: F.col("s")[k] for k in T.SCALE}
    return read(spark, d, "documents").select("doc_id", T.signature_struct(F.col("text")).alias("s")).select("doc_id", *(F.round(v, 6).alias(k) for k, v in s.items()), T.quality_value(s).alias("quality_value"), T.quality_label(s).alias("quality"))


def content_type(spark, d):
    c = chunks(spark, d)
    return c.select("id", T.content_type(F.col("text"), F.col("page"), F.lit(50)).alias("kind"), T.nature(T.content_type(F.col("text"))).alias("nature"))


def content_type_cases(spark, d):
    """The rules on texts made to meet them: citations, codes, an index, a table, a definition."""
    r = read(spark, d, "region").select(F.col("r_regionkey").alias("k"))
    cite = F.concat(F.lit("Author A. Journal "), F.lit("2018; 391"), F.lit("(10): 1234. "))
    text = (
        F.when(F.col("k") == 0, F.repeat(cite, 9))
        .when(F.col("k") == 1, F.repeat(F.lit("A10.1 B20.22 codes "), 6))
        .when(F.col("k") == 2, F.repeat(F.lit("Alpha, 12 Beta, 13-15 Gamma, 210 "), 8))
        .when(F.col("k") == 3, F.repeat(F.lit("10 mg (DOSE); 3 (DAYS). "), 4))
        .otherwise(F.lit("A term se define como something else."))
    )
    return r.select("k", T.content_type(text).alias("kind"))


def fn_snippet_locator(spark, d):
    c = chunks(spark, d)
    end = F.when(F.col("id") % 3 == 0, F.col("page")).when(F.col("id") % 3 == 1, F.col("page") + 2)
    start = F.when(F.col("id") % 7 != 0, F.col("page"))
    loc = T.locator(start, end)
    return c.select("id", T.snippet(F.col("text")).alias("snippet"), loc.alias("locator"), F.concat_ws(" — ", F.coalesce("source_id", F.lit("Source")), F.coalesce("section", "chapter"), loc).alias("title"))


def prj_fetch(spark, d):
    c = chunks(spark, d)
    return c.select("id", F.left("text", F.lit(12000)).alias("text"), (F.length("text") > 12000).alias("truncated"))


def prj_preview(spark, d):
    return read(spark, d, "documents").select("doc_id", T.preview(F.col("text"), ["ention", "sch", "eaux"]).alias("preview"))


def fn_embedding_props_json(spark, d):
    e = read(spark, d, "events")
    said = F.concat(F.lit("```json\n"), "props", F.lit("\n```"))
    return e.select("event_id", F.get_json_object(T.json_payload(said), "$.k").cast("long").alias("k"))


def fn_onto_code(spark, d):
    return read(spark, d, "part").select("p_partkey", T.ontology_code(F.col("p_brand"), F.col("p_name")).alias("code"))


def fn_lost_words(spark, d):
    return read(spark, d, "documents").select("doc_id", F.round(T.lost_words(F.col("text"), F.left("text", F.lit(400))), 6).alias("lost"))


def fn_render_table(spark, d):
    p = read(spark, d, "part")
    cells, head = F.array("p_name", F.col("p_size").cast("string"), F.when(F.col("p_size") % 2 == 0, F.lit(" ")).otherwise(F.col("p_brand"))), F.array(F.lit("name"), F.lit("size"), F.lit("brand"))
    return p.select("p_partkey", T.render_row(cells, head).alias("row"), T.is_header_row(cells).alias("is_header"))


def fn_index_tokens(spark, d):
    x = read(spark, d, "documents").select("doc_id", F.explode(T.tokens(F.col("text"))).alias("term"))
    return x.groupBy("doc_id").agg(F.count("*").alias("n_tokens"), F.count_distinct("term").alias("n_terms"))


_Q = "SELECT doc_id, {} FROM documents"
_LIST = lambda x: f"list_filter({x}, lambda x: x <> '')"
_TOP = """
WITH p AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN (doc_id % 1000)::VARCHAR || chr(10) || text ELSE text || chr(10) || 'chapter' || chr(10) || (doc_id % 1000)::VARCHAR END AS text FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM p),
n AS (SELECT *, CASE WHEN trim(line) <> '' THEN row_number() OVER (PARTITION BY doc_id, trim(line) <> '' ORDER BY i) END AS up,
  CASE WHEN trim(line) <> '' THEN row_number() OVER (PARTITION BY doc_id, trim(line) <> '' ORDER BY i DESC) END AS down,
  lag(CASE WHEN trim(line) <> '' THEN trim(line) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM l),
z AS (SELECT *, CASE WHEN up <= 2 THEN 'top' WHEN down <= 2 THEN 'bottom' END AS zone,
  regexp_matches(line, '^\\s*\\d{1,4}\\s*$') AND NOT coalesce(regexp_matches(prev, '^[^\\p{L}\\p{N}_]*(?i:cap[ií]tulo|secci[oó]n|parte|chapter|section|part)[^\\p{L}\\p{N}_]*$'), false) AS folio FROM n),
g AS (SELECT *, CASE WHEN folio AND zone = 'top' THEN row_number() OVER (PARTITION BY doc_id, zone, folio ORDER BY i)
  WHEN folio AND zone = 'bottom' THEN row_number() OVER (PARTITION BY doc_id, zone, folio ORDER BY i DESC) END AS hit FROM z)
"""

_SCALE = {k: v for k, v in T.SCALE.items()}


def _sql_scaled(name: str, expr: str) -> str:
    floor = T.NON_ALPHA_FLOOR if name == "non_alpha" else 0.0
    return f"CASE WHEN {expr} <= {floor} THEN 0.0::DOUBLE ELSE least(1.0::DOUBLE, ({expr} - {floor}::DOUBLE) / {T.SCALE[name] - floor}::DOUBLE) END"


_QUALITY = f"""
WITH a AS (SELECT doc_id, text AS t, {WORDS.format('text')} AS w, regexp_extract_all(text, '\\p{{L}}{{7,}}') AS lw FROM documents),
b AS (SELECT *, regexp_extract_all(array_to_string(list_transform(w, lambda x: CASE WHEN regexp_full_match(x, '\\p{{L}}') THEN x ELSE '|' END), ''), '[^|]{{4,}}') AS runs,
  length(regexp_replace(t, '\\s', '', 'g')) AS visible FROM a),
r AS (SELECT doc_id,
  len(regexp_extract_all(t, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]'))::DOUBLE / greatest(length(t), 1) AS control,
  len(regexp_extract_all(t, '\\x{{FFFD}}'))::DOUBLE / greatest(length(t), 1) AS replacement,
  len(regexp_extract_all(t, '\\(cid:\\s?\\d+\\)'))::DOUBLE / greatest(len(w), 1) AS cid,
  CASE WHEN len(w) >= 30 THEN len(list_filter(w, lambda x: regexp_full_match(x, '\\p{{L}}')))::DOUBLE / len(w) ELSE 0 END AS single_letters,
  CASE WHEN len(w) >= 30 THEN coalesce(list_sum(list_transform(list_filter(runs, lambda x: len(list_distinct(string_split(lower(x), ''))) >= 3
    AND length(regexp_replace(x, '[^\\p{{Ll}}]', '', 'g')) * 2 > length(x)), lambda x: length(x))), 0)::DOUBLE / len(w) ELSE 0 END AS spaced,
  CASE WHEN len(lw) >= 10 THEN len(list_filter(lw, lambda x: NOT regexp_matches(lower(x), '[{T.VOWELS}]')))::DOUBLE / len(lw) ELSE 0 END AS vowelless,
  CASE WHEN visible > 0 THEN length(regexp_replace(t, '[\\s\\p{{L}}]', '', 'g'))::DOUBLE / visible ELSE 0 END AS non_alpha FROM b),
s AS (SELECT doc_id, {", ".join(f"{_sql_scaled(k, k)} AS {k}" for k in T.SCALE)} FROM r)
SELECT doc_id, {", ".join(f"round({k}, 6) AS {k}" for k in T.SCALE)}, round(greatest({", ".join(T.SCALE)}), 3) AS quality_value,
  CASE WHEN greatest({", ".join(T.SCALE)}) > 0.30 AND greatest({", ".join(T.HARD)}) > 0.30 THEN 'corrupta' WHEN greatest({", ".join(T.SCALE)}) > 0.15 THEN 'dudosa' ELSE 'ok' END AS quality FROM s
"""


def _sql_type(t: str, page: str = "NULL", pages: str = "NULL") -> str:
    q = lambda p: p.replace("'", "''")
    entries = f"list_concat(regexp_extract_all({t}, '{q(T.TERM_AND_PAGE)}'), regexp_extract_all({t}, '{q(T.OUTLINE_ENTRY)}'))"
    w = WORDS.format(t)
    n = f"greatest(len({w}), 1)"
    cue = f"(regexp_matches({t}, '{q(T.INDEX_CUE.replace('(?iu)', '(?i)'))}') OR coalesce({page} > 0 AND {pages} > 0 AND ({page} <= 30 OR {page} >= {pages} * 0.95), false))"
    least = f"CASE WHEN {cue} THEN 8 ELSE 12 END"
    index = f"""(len({entries}) >= {least} AND len({entries}) / {n} * 280 >= {least} AND length(array_to_string({entries}, '')) / greatest(length({t}), 1) >= 0.35
      AND len(list_filter({w}, lambda x: regexp_matches(x, '^{T.PAGE_REF}[.,;:]?$'))) / {n} >= 0.20
      AND len(list_filter({w}, lambda x: regexp_matches(x, '[.?!]$') AND NOT regexp_matches(x, '^\\d+(?:\\.\\d+)*\\.?$'))) / {n} <= 0.02
      AND len(list_filter({w}, lambda x: lower(trim(x, '.,;:()')) IN ('es', 'se', 'puede', 'debe', 'son'))) / {n} <= 0.02)"""
    defines = " OR ".join(f"contains(lower({t}[:200]), '{p}')" for p in T.DEFINING)
    return f"""CASE WHEN trim({t}) = '' THEN 'body'
      WHEN len(regexp_extract_all({t}, '{q(T.CITATION)}')) >= 8 AND (strpos({t}, regexp_extract({t}, '{q(T.CITATION)}')) - 1) / greatest(length({t}), 1) < 0.25 THEN 'referencias'
      WHEN len(regexp_extract_all({t}, '{q(T.DOTTED_CODE)}')) >= 8 THEN 'indice' WHEN {index} THEN 'indice'
      WHEN len(regexp_extract_all({t}, '\\([^()]{{2,40}}\\);')) >= 3 THEN 'tabla' WHEN {defines} THEN 'definicion' ELSE 'body' END"""


_META = "".join(f"\\{c}" for c in T.QUERY_SYNTAX)
SQL = {
    "fold_search_fields": f"WITH {SQL_CHUNKS} SELECT id, {FOLD.format('text')} AS text_search, {FOLD.format('section')} AS section_search, {FOLD.format('chapter')} AS chapter_search, {FOLD.format('chapter || chr(32) || section || chr(32) || array_to_string(' + WORDS.format('text') + '[:50], chr(32))')} AS keywords FROM chunks",
    "embed_text_canonical": f"WITH {SQL_CHUNKS} SELECT id, ('Capítulo: ' || chapter || '. Sección: ' || section || CASE WHEN id % 3 = 0 THEN '. Tipo: tabla' ELSE '' END || '. ' || text)[:2000] AS canonical FROM chunks",
    "fn_fold_key": _Q.format("trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g')) AS key"),
    "fn_slug": _Q.format("regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')[:60] AS slug"),
    "fn_entity_name": _Q.format("trim(regexp_replace(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), '[.;,]+$', '')) AS name, strip_accents(trim(regexp_replace(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')), '[.;,]+$', ''))) AS plain"),
    "fn_unaccent_positional": _Q.format("strip_accents(text) AS plain, length(strip_accents(text)) = length(text) AS same_length"),
    "fn_legacy_norm": _Q.format("translate(text, 'áéíóúüñÁÉÍÓÚÜÑ', 'aeiouunAEIOUUN') AS plain"),
    "fn_query_terms": _Q.format(f"array_to_string({_LIST(f'''string_split_regex(trim(regexp_replace(lower(strip_accents(text)), '[{_META}]', ' ', 'g')), '\\s+')''')}, ' ') AS terms"),
    "fn_line_key": "SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INTEGER AS line_no, trim(regexp_replace(line, '\\s+', ' ', 'g')) AS key FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)",
    "fn_clean_page_v1": _Q.format("trim(regexp_replace(regexp_replace(regexp_replace(text, '(?m)^[ \\t]*\\d{1,4}[ \\t]*$', '', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), '[ \\t]+', ' ', 'g')) AS clean"),
    "fn_strip_folio": _TOP + "SELECT doc_id, string_agg(CASE WHEN hit = 1 THEN '' ELSE line END, chr(10) ORDER BY i) AS clean FROM g GROUP BY doc_id",
    "fn_folio_candidates": _TOP
    + """, w AS (SELECT doc_id, list_filter(string_split_regex(trim(line), '\\s+'), lambda x: x <> '') AS w FROM z WHERE zone IS NOT NULL),
e AS (SELECT doc_id, unnest([w[1], w[-1]]) AS t FROM w),
f AS (SELECT DISTINCT doc_id, trim(t, '.,;:()[]{}<>-—–·|/\\*') AS t FROM e)
SELECT doc_id, coalesce(array_to_string(list_sort(list(n)), ','), '') AS folios FROM (SELECT DISTINCT doc_id, CASE WHEN regexp_full_match(t, '\\d{1,4}') THEN TRY_CAST(t AS INTEGER) END AS n FROM f) GROUP BY doc_id""",
    "quality_signatures": _QUALITY,
    "content_type": f"WITH {SQL_CHUNKS} SELECT id, {_sql_type('text', 'page', '50')} AS kind, CASE WHEN {_sql_type('text')} IN ('referencias', 'indice') THEN {_sql_type('text')} ELSE 'contenido' END AS nature FROM chunks",
    "content_type_cases": f"""WITH c AS (SELECT r_regionkey AS k, CASE r_regionkey WHEN 0 THEN repeat('Author A. Journal 2018; 391(10): 1234. ', 9) WHEN 1 THEN repeat('A10.1 B20.22 codes ', 6)
      WHEN 2 THEN repeat('Alpha, 12 Beta, 13-15 Gamma, 210 ', 8) WHEN 3 THEN repeat('10 mg (DOSE); 3 (DAYS). ', 4) ELSE 'A term se define como something else.' END AS t FROM region)
      SELECT k, {_sql_type('t')} AS kind FROM c""",
    "fn_snippet_locator": f"""WITH {SQL_CHUNKS}, p AS (SELECT *, CASE WHEN id % 7 <> 0 THEN page END AS a, CASE WHEN id % 3 = 0 THEN page WHEN id % 3 = 1 THEN page + 2 END AS b FROM chunks),
      l AS (SELECT *, CASE WHEN a IS NULL THEN NULL WHEN b IS NULL OR b = a THEN 'p. ' || a ELSE 'pp. ' || a || '-' || b END AS locator FROM p)
      SELECT id, CASE WHEN length(trim(text)) > 320 THEN trim(text)[:320] || '…' ELSE trim(text) END AS snippet, locator, source_id || ' — ' || section || coalesce(' — ' || locator, '') AS title FROM l""",
    "prj_fetch": f"WITH {SQL_CHUNKS} SELECT id, text[:12000] AS text, length(text) > 12000 AS truncated FROM chunks",
    "prj_preview": """WITH f AS (SELECT doc_id, text, lower(strip_accents(text)) AS t FROM documents),
      p AS (SELECT *, greatest(coalesce(least(nullif(strpos(t, 'ention'), 0), nullif(strpos(t, 'sch'), 0), nullif(strpos(t, 'eaux'), 0)), 1) - 1 - 80, 0) AS s FROM f)
      SELECT doc_id, CASE WHEN s > 0 THEN '...' ELSE '' END || text[s + 1 : s + 300] || CASE WHEN s + 300 < length(text) THEN '...' ELSE '' END AS preview FROM p""",
    "fn_embedding_props_json": "SELECT event_id, (props::JSON ->> '$.k')::BIGINT AS k FROM events",
    "fn_onto_code": "SELECT p_partkey, p_brand || '_' || regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g')[:30] AS code FROM part",
    "fn_lost_words": """WITH w AS (SELECT doc_id, list_distinct(list_filter(string_split_regex(trim(lower(text)), '\\s+'), lambda x: length(x) >= 2)) AS a,
      list_distinct(list_filter(string_split_regex(trim(lower(text[:400])), '\\s+'), lambda x: length(x) >= 2)) AS b FROM documents)
      SELECT doc_id, round(len(list_filter(a, lambda x: NOT list_contains(b, x))) / greatest(len(a), 1), 6) AS lost FROM w""",
    "fn_render_table": """SELECT p_partkey, p_name || ' (NAME); ' || p_size || ' (SIZE)' || CASE WHEN p_size % 2 = 0 THEN '' ELSE '; ' || p_brand || ' (BRAND)' END || '.' AS row, false AS is_header FROM part""",
    "fn_index_tokens": "SELECT doc_id, count(*) AS n_tokens, count(DISTINCT t) AS n_terms FROM (SELECT doc_id, unnest(list_filter(string_split_regex(lower(strip_accents(text)), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) AS t FROM documents) GROUP BY doc_id",
    "fn_clean_page": """WITH l AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '\\n{3,}', chr(10) || chr(10), 'g'), chr(10))) AS line, generate_subscripts(string_split(regexp_replace(text, '\\n{3,}', chr(10) || chr(10), 'g'), chr(10)), 1) AS i FROM documents)
      SELECT doc_id, trim(string_agg(CASE WHEN length(line) <= 120 AND regexp_matches(line, '(?i)(?:©|\\(c\\))\\s*\\d{4}|copyright|all rights reserved|derechos\\s+reservados|fotocopiar') THEN '' ELSE trim(regexp_replace(line, '[ \\t]+', ' ', 'g')) END, chr(10) ORDER BY i), chr(10) || ' ' || chr(9)) AS clean FROM l GROUP BY doc_id""",
}


def queries() -> dict:
    fs = [
        fold_search_fields, embed_text_canonical, fn_fold_key, fn_slug, fn_entity_name, fn_unaccent_positional, fn_legacy_norm, fn_query_terms, fn_line_key, fn_clean_page,
        fn_clean_page_v1, fn_strip_folio, fn_folio_candidates, quality_signatures, content_type, content_type_cases, fn_snippet_locator, prj_fetch, prj_preview,
        fn_embedding_props_json, fn_onto_code, fn_lost_words, fn_render_table, fn_index_tokens,
    ]
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
