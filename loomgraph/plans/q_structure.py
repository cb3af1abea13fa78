"""Queries over layout, structure and chunking."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.operators import chunking as C
from loomgraph.operators import structure as S
from loomgraph.plans import q_text
from loomgraph.sources.rebase import SQL_CHUNKS, chunks, read

CHAPTER, SECTION = r"^\p{Lu}\p{Ll}* \p{Ll}+\.$", r"^\p{Lu}\p{Ll}*\.$"
MARK, CODE = r" (?:of|la|der|de) ", r" (?:th|en|el) "


def repeated_edge_lines(spark, d):
    return S.repeated_edge_lines(chunks(spark, d))


def drop_repeated_lines(spark, d):
    pages = chunks(spark, d)
    return S.drop_lines(pages, S.repeated_edge_lines(pages)).select("id", "text")


def _candidates(spark, d):
    c = chunks(spark, d)
    noise = F.when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 11 == 0, 99).when(F.col("id") % 2 == 0, 10).otherwise(F.col("page") % 4)
    return c.select("source_id", "page", (F.col("page") + noise).alias("printed")).filter("printed is not null")


def folio_series(spark, d):
    return S.folio_series(_candidates(spark, d), gap=5, least=5)


def heading_ffill(spark, d):
    return S.heading_ffill(chunks(spark, d), CHAPTER, SECTION)


def segments(spark, d):
    return S.segments(chunks(spark, d), CHAPTER, SECTION)


def nature_runs(spark, d):
    return S.line_natures(read(spark, d, "documents"), citation=MARK, code=CODE)


def flagged_runs(spark, d):
    ls = S.explode_lines(read(spark, d, "documents"), ["doc_id"])
    return S.flagged_runs(ls.select("doc_id", "line_no", F.regexp_count("line", F.lit(MARK)).alias("marks")), 2, 8)


def _books(spark, d):
    """Every document as a book whose lines are its pages."""
    x = read(spark, d, "documents").select(F.col("doc_id").alias("source_id"), F.col("lang").alias("chapter"), F.col("source").alias("section"), F.posexplode(F.split("text", "\n")).alias("at", "text"))
    return x.select("source_id", (F.col("at") + 1).alias("page"), F.lit(0).alias("seq"), "text", "chapter", "section")


def chunk_bounds(spark, d):
    return C.chunk_books(_books(spark, d)).select(F.col("source_id").alias("doc_id"), "chunk_index", "start", "end", "word_count")


def chunks_described(spark, d):
    return C.describe(C.chunk_books(_books(spark, d))).select("id", "source_id", "chunk_index", "page_start", "page_end", "word_count", "chapter", "section", "kind", "quality", "quality_value", F.md5("text").alias("text_md5"))


def parents(spark, d):
    g = C.parent_groups(C.chunk_books(_books(spark, d)))
    return C.parents(g).select("id", "source_id", "word_count", "page_start", "page_end", F.size("child_ids").alias("n_children"), F.md5("text").alias("text_md5"))


def chunk_paragraphs_v1(spark, d):
    x = read(spark, d, "documents").select("doc_id", F.posexplode(C.pack_paragraphs(F.replace("text", F.lit("\n"), F.lit("\n\n")))).alias("chunk_index", "text"))
    return x.select("doc_id", "chunk_index", F.size(F.split(F.trim("text"), r"\s+")).alias("word_count"))


def chunk_stats(spark, d):
    c = C.chunk_books(_books(spark, d))
    return c.agg(F.count("*").alias("n_chunks"), F.round(F.avg("word_count"), 6).alias("avg_words"), F.min("word_count").alias("min_words"), F.max("word_count").alias("max_words"), F.count_distinct("chapter").alias("n_chapters"), F.count_distinct("section").alias("n_sections"))


_LINES = "l AS (SELECT {k}, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10)))))::INTEGER AS line_no FROM {t})"
_CHUNK = r"""
RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(trim(text), '\s+'), lambda x: x <> '') AS ws FROM documents),
m AS (SELECT doc_id, len(ws) AS n, list_filter(range(len(ws)), lambda i: regexp_matches(ws[i + 1], '[.?!:]$') AND NOT regexp_matches(ws[i + 1], '^\d+\.$')) AS cuts FROM w WHERE len(ws) > 0),
c AS (
  SELECT doc_id, 0 AS k, 0::BIGINT AS a, CASE WHEN 280 >= n THEN n ELSE coalesce(list_min(list_transform(list_filter(cuts, lambda i: i >= 250 AND i < least(n, 310)), lambda i: abs(i - 280) * 1000000000 + i)) % 1000000000, 280) + 1 END AS b, n, cuts FROM m
  UNION ALL
  SELECT doc_id, k + 1, b - 60, CASE WHEN b + 220 >= n THEN n ELSE coalesce(list_min(list_transform(list_filter(cuts, lambda i: i >= b + 190 AND i < least(n, b + 250)), lambda i: abs(i - b - 220) * 1000000000 + i)) % 1000000000, b + 220) + 1 END, n, cuts FROM c WHERE b < n
), t AS (SELECT *, k > 0 AND b - a < 150 AS tail, lead(b - a) OVER o AS next_len, lead(b) OVER o AS next_b FROM c WINDOW o AS (PARTITION BY doc_id ORDER BY k)),
bounds AS (
  SELECT doc_id, k::INTEGER AS chunk_index, b, CASE WHEN next_len < 150 THEN next_b END AS rest, a::INTEGER AS start, (CASE WHEN next_len < 150 THEN next_b ELSE b END)::INTEGER AS "end", (b - a + CASE WHEN next_len < 150 THEN next_len ELSE 0 END)::INTEGER AS word_count
  FROM t WHERE NOT tail)
"""
_CHUNK_TEXTS = r"""
cum AS (SELECT doc_id, lang, source, list_transform(range(1, len(c) + 1), lambda i: list_sum(c[:i])) AS cum FROM
  (SELECT doc_id, lang, source, list_transform(string_split(text, chr(10)), lambda x: len(list_filter(string_split_regex(trim(x), '\s+'), lambda y: y <> ''))) AS c FROM documents)),
raw AS (SELECT b.*, printf('%s_v2_%05d', b.doc_id::VARCHAR, chunk_index) AS id, lang AS chapter, source AS section,
  array_to_string(ws[start + 1 : b.b], ' ') || CASE WHEN rest IS NULL THEN '' ELSE ' ' || array_to_string(ws[b.b - 59 : rest], ' ') END AS text,
  (len(list_filter(cum, lambda x: x <= start)) + 1)::INTEGER AS page_start, (len(list_filter(cum, lambda x: x <= "end" - 1)) + 1)::INTEGER AS page_end FROM bounds b JOIN w ON w.doc_id = b.doc_id JOIN cum ON cum.doc_id = b.doc_id),
ch AS (SELECT *, max(page_end) OVER (PARTITION BY doc_id) AS pages FROM raw)"""
_QUALITY_OF_CHUNKS = q_text._QUALITY.replace("FROM documents", "FROM (SELECT id AS doc_id, text FROM ch)")
SQL = {
    "repeated_edge_lines": f"""WITH {SQL_CHUNKS}, {_LINES.format(k='source_id, page', t='chunks')},
      k AS (SELECT source_id, page, line_no, trim(regexp_replace(line, '\\s+', ' ', 'g')) AS key FROM l),
      n AS (SELECT *, row_number() OVER (PARTITION BY source_id, page ORDER BY line_no) AS up, row_number() OVER (PARTITION BY source_id, page ORDER BY line_no DESC) AS down FROM k WHERE key <> ''),
      w AS (SELECT source_id, max(length(key)) AS widest FROM n GROUP BY 1)
      SELECT source_id, key, count(DISTINCT page) AS n_pages FROM n JOIN w USING (source_id) WHERE (up <= 2 OR down <= 2) AND length(key) <= least(120, floor(widest * 0.75)) GROUP BY ALL HAVING count(DISTINCT page) >= 3""",
    "drop_repeated_lines": f"""WITH {SQL_CHUNKS}, {_LINES.format(k='id, source_id, page', t='chunks')},
      k AS (SELECT *, trim(regexp_replace(line, '\\s+', ' ', 'g')) AS key FROM l),
      n AS (SELECT *, row_number() OVER (PARTITION BY source_id, page ORDER BY line_no) AS up, row_number() OVER (PARTITION BY source_id, page ORDER BY line_no DESC) AS down FROM k WHERE key <> ''),
      w AS (SELECT source_id, max(length(key)) AS widest FROM n GROUP BY 1),
      r AS (SELECT source_id, key FROM n JOIN w USING (source_id) WHERE (up <= 2 OR down <= 2) AND length(key) <= least(120, floor(widest * 0.75)) GROUP BY ALL HAVING count(DISTINCT page) >= 3)
      SELECT id, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '') AS text FROM (SELECT k.*, r.key IS NOT NULL AS gone FROM k LEFT JOIN r ON k.source_id = r.source_id AND k.key = r.key) GROUP BY id""",
    "folio_series": f"""WITH {SQL_CHUNKS}, c AS (SELECT DISTINCT source_id, page, CASE WHEN id % 11 = 0 THEN 99 WHEN id % 2 = 0 THEN 10 ELSE page % 4 END AS o FROM chunks WHERE id % 7 <> 0),
      i AS (SELECT *, page - row_number() OVER (PARTITION BY source_id, o ORDER BY page) AS x, CASE WHEN page - lag(page) OVER (PARTITION BY source_id, o ORDER BY page) > 6 THEN 1 ELSE 0 END AS new FROM c),
      j AS (SELECT *, sum(new) OVER (PARTITION BY source_id, o ORDER BY page) AS island FROM i),
      s AS (SELECT source_id, o, island, min(page) AS a, max(page) AS b, count(*) AS n FROM j GROUP BY ALL HAVING count(*) >= 5),
      t AS (SELECT *, rank() OVER (PARTITION BY source_id ORDER BY n DESC) AS r, count(*) OVER (PARTITION BY source_id, n) AS ties FROM s)
      SELECT source_id, unnest(range(a, b + 1))::INTEGER AS page, (unnest(range(a, b + 1)) + o)::INTEGER AS printed FROM t WHERE r = 1 AND ties = 1""",
    "nature_runs": f"""WITH {_LINES.format(k='doc_id', t='documents')},
      m AS (SELECT doc_id, line_no, len(regexp_extract_all(line, '{MARK}')) AS r, len(regexp_extract_all(line, '{CODE}')) AS i FROM l),
      ri AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM (SELECT *, CASE WHEN line_no - lag(line_no) OVER (PARTITION BY doc_id ORDER BY line_no) > 3 THEN 1 ELSE 0 END AS new FROM m WHERE r > 0)),
      rr AS (SELECT doc_id, min(line_no) AS a, max(line_no) AS b FROM ri GROUP BY doc_id, island HAVING sum(r) >= 8),
      ii AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM (SELECT *, CASE WHEN line_no - lag(line_no) OVER (PARTITION BY doc_id ORDER BY line_no) > 2 THEN 1 ELSE 0 END AS new FROM m WHERE i > 0)),
      ir AS (SELECT doc_id, min(line_no) AS a, max(line_no) AS b FROM ii GROUP BY doc_id, island HAVING sum(i) >= 8)
      SELECT doc_id, line_no, CASE WHEN EXISTS (SELECT 1 FROM rr WHERE rr.doc_id = m.doc_id AND m.line_no BETWEEN a AND b) THEN 'referencias' WHEN EXISTS (SELECT 1 FROM ir WHERE ir.doc_id = m.doc_id AND m.line_no BETWEEN a AND b) THEN 'indice' ELSE 'contenido' END AS nature FROM m""",
    "flagged_runs": f"""WITH {_LINES.format(k='doc_id', t='documents')}, m AS (SELECT doc_id, line_no, len(regexp_extract_all(line, '{MARK}')) AS marks FROM l),
      i AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM (SELECT *, CASE WHEN line_no - lag(line_no) OVER (PARTITION BY doc_id ORDER BY line_no) > 3 THEN 1 ELSE 0 END AS new FROM m WHERE marks > 0))
      SELECT doc_id, min(line_no) AS "first", max(line_no) AS "last", sum(marks)::BIGINT AS total FROM i GROUP BY doc_id, island HAVING sum(marks) >= 8""",
    "heading_ffill": f"""WITH {SQL_CHUNKS}, {_LINES.format(k='source_id, page', t='chunks')},
      h AS (SELECT *, CASE WHEN length(trim(line)) >= 3 AND regexp_matches(trim(line), '{CHAPTER}') THEN trim(line)[:120] END AS cap,
        CASE WHEN length(trim(line)) BETWEEN 3 AND 79 AND regexp_matches(trim(line), '{SECTION}') THEN trim(line)[:100] END AS sec FROM l),
      e AS (SELECT *, count(cap) OVER (PARTITION BY source_id ORDER BY page, line_no) AS epoch, last_value(cap IGNORE NULLS) OVER (PARTITION BY source_id ORDER BY page, line_no) AS chapter FROM h)
      SELECT source_id, page, line_no, chapter, last_value(sec IGNORE NULLS) OVER (PARTITION BY source_id, epoch ORDER BY page, line_no) AS section FROM e""",
    "segments": f"""WITH {SQL_CHUNKS}, {_LINES.format(k='source_id, page', t='chunks')},
      h AS (SELECT *, CASE WHEN length(trim(line)) >= 3 AND regexp_matches(trim(line), '{CHAPTER}') THEN trim(line)[:120] END AS cap,
        CASE WHEN length(trim(line)) BETWEEN 3 AND 79 AND regexp_matches(trim(line), '{SECTION}') THEN trim(line)[:100] END AS sec FROM l),
      e AS (SELECT *, count(cap) OVER (PARTITION BY source_id ORDER BY page, line_no) AS epoch, last_value(cap IGNORE NULLS) OVER (PARTITION BY source_id ORDER BY page, line_no) AS chapter FROM h),
      s AS (SELECT *, last_value(sec IGNORE NULLS) OVER (PARTITION BY source_id, epoch ORDER BY page, line_no) AS section, count(coalesce(cap, sec)) OVER (PARTITION BY source_id, page ORDER BY line_no) AS seq FROM e)
      SELECT source_id, page, seq, string_agg(line, chr(10) ORDER BY line_no) AS text, arg_max(chapter, line_no) AS chapter, arg_max(section, line_no) AS section FROM s GROUP BY source_id, page, seq HAVING NOT regexp_full_match(string_agg(line, chr(10) ORDER BY line_no), '\\s*')""",
    "chunk_bounds": f"""WITH {_CHUNK} SELECT doc_id, chunk_index, start, "end", word_count FROM bounds""",
    "chunks_described": f"""WITH {_CHUNK}, {_CHUNK_TEXTS}, q AS ({_QUALITY_OF_CHUNKS})
      SELECT ch.id, ch.doc_id AS source_id, chunk_index, page_start, page_end, word_count, chapter, section, {q_text._sql_type('text', 'page_start', 'pages')} AS kind, q.quality, q.quality_value, md5(text) AS text_md5 FROM ch JOIN q ON q.doc_id = ch.id""",
    "parents": f"""WITH {_CHUNK}, {_CHUNK_TEXTS}, p AS (SELECT *, chunk_index // 3 AS k, {q_text.WORDS.format('text')} AS ws2 FROM ch),
      g AS (SELECT doc_id, k, flatten(list(CASE WHEN chunk_index % 3 = 0 THEN ws2 ELSE ws2[least(60, len(ws2) // 3) + 1 :] END ORDER BY chunk_index))[:1200] AS ws3, arg_min(page_start, chunk_index) AS page_start, arg_max(page_end, chunk_index) AS page_end, count(*)::INTEGER AS n_children FROM p GROUP BY 1, 2)
      SELECT printf('%s_v2_parent_%05d', doc_id::VARCHAR, k) AS id, doc_id AS source_id, len(ws3)::INTEGER AS word_count, page_start, page_end, n_children, md5(array_to_string(ws3, ' ')) AS text_md5 FROM g""",
    "chunk_paragraphs_v1": """WITH RECURSIVE p AS (SELECT doc_id, list_filter(list_transform(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)), lambda x: trim(x, ' ')), lambda x: length(x) >= 10) AS ps FROM documents),
      k AS (SELECT doc_id, list_transform(ps, lambda x: len(list_filter(string_split_regex(trim(x), '\\s+'), lambda y: y <> ''))) AS ks FROM p WHERE len(ps) > 0),
      c AS (SELECT doc_id, 1 AS i, 0 AS chunk, ks[1] AS n, ks FROM k
        UNION ALL SELECT doc_id, i + 1, CASE WHEN n + ks[i + 1] > 800 AND n > 100 THEN chunk + 1 ELSE chunk END, CASE WHEN n + ks[i + 1] > 800 AND n > 100 THEN ks[i + 1] ELSE n + ks[i + 1] END, ks FROM c WHERE i < len(ks)),
      g AS (SELECT doc_id, chunk, max_by(n, i) AS n, max(chunk) OVER (PARTITION BY doc_id) AS last FROM c GROUP BY doc_id, chunk)
      SELECT doc_id, chunk::INTEGER AS chunk_index, n::INTEGER AS word_count FROM g WHERE chunk < last OR n > 50""",
    "chunk_stats": f"""WITH {_CHUNK} SELECT count(*) AS n_chunks, round(avg(word_count), 6) AS avg_words, min(word_count) AS min_words, max(word_count) AS max_words,
      (SELECT count(DISTINCT lang) FROM documents WHERE trim(text) <> '') AS n_chapters, (SELECT count(DISTINCT source) FROM documents WHERE trim(text) <> '') AS n_sections FROM bounds""",
}


def queries() -> dict:
    fs = [repeated_edge_lines, drop_repeated_lines, folio_series, heading_ffill, segments, nature_runs, flagged_runs, chunk_bounds, chunks_described, parents, chunk_paragraphs_v1, chunk_stats]
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
