"""Queries over extraction, provenance, resolution, providers and (as batches) streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.operators import extraction as X
from loomgraph.plans.q_catalog import mentions
from loomgraph.sources import files
from loomgraph.sources.rebase import SQL_CHUNKS, chunks, read
from loomgraph.streaming import streams

TAX = X.Taxonomy(
    types={"concept": "Concepts", "tool": "Tools"},
    relations={"USES": X.Relation("USES", ("concept",), ("tool",), ("use",), ("avoid",)), "PART_OF": X.Relation("PART_OF", ("concept",), ("concept",)), "HIDDEN": X.Relation("HIDDEN", extract=False)},
)


def _raw_entities(spark, d):
    w = F.col("w")
    item = lambda at, name, kind, syn=(): F.struct(F.lit(at).alias("at"), name.alias("name"), F.lit(kind).alias("type"), F.array(*syn).cast("array<string>").alias("synonyms"))
    at = lambda i: F.get(w, F.lit(i))
    rows = F.array(
        item(0, at(3), "Concept"), item(1, F.concat(at(5), F.lit("xs")), "tool"), item(2, F.lit("x"), "concept"), item(3, F.lit("zzqq absent"), "concept"),
        item(4, at(4), "unknown"), item(5, F.lit("Concepts"), "concept"), item(6, F.lit("absent thing"), "concept", (at(7),)),
    )
    x = read(spark, d, "documents").select(F.col("doc_id").alias("chunk_id"), "text", T.words(F.col("text")).alias("w"), X.fragment(F.col("text"), TAX).alias("fragment"))
    x = x.select("chunk_id", "text", "fragment", F.explode(rows).alias("e"))
    return x.select("chunk_id", "text", "fragment", "e.*")


def validate_entities(spark, d):
    return X.validate_entities(_raw_entities(spark, d), TAX).select("chunk_id", "at", "name", "type", "motive")


def extraction_discards(spark, d):
    return X.discards(X.validate_entities(_raw_entities(spark, d), TAX))


def _raw_relations(spark, d):
    w = F.col("w")
    at = lambda i: F.get(w, F.lit(i))
    item = lambda k, a, r, b, e: F.struct(F.lit(k).alias("at"), a.alias("src"), F.lit(r).alias("relation"), b.alias("dst"), e.alias("evidence"))
    span, tool = F.array_join(F.slice(w, 3, 8), " "), F.concat(at(5), F.lit("xs"))
    rows = F.array(
        item(0, at(3), "uses", tool, span), item(1, tool, "uses", at(3), span), item(2, at(3), "NOPE", tool, span), item(3, at(3), "uses", at(3), span),
        item(4, at(3), "part_of", tool, F.lit("nothing of this is in there")), item(5, at(3), "uses", F.lit(""), span), item(6, F.lit("ghost"), "uses", F.lit("spook"), span),
    )
    x = read(spark, d, "documents").select(F.col("doc_id").alias("chunk_id"), "text", T.words(F.col("text")).alias("w"), X.fragment(F.col("text"), TAX).alias("fragment"))
    return x.select("chunk_id", "text", "fragment", F.explode(rows).alias("r")).select("chunk_id", "text", "fragment", "r.*")


def validate_relations(spark, d):
    return X.validate_relations(_raw_relations(spark, d), X.validate_entities(_raw_entities(spark, d), TAX), TAX)


def evidence_spans(spark, d):
    """Which documents hold any six folded words in a row of a benchmark item, or all words of a shorter one."""
    key = T.fold_key(F.col("text"))
    windows = F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size("t") - 5, F.lit(1))), lambda i: F.array_join(F.slice("t", i, 6), " ")))).alias("name")
    b = read(spark, d, "benchmark").select("item_id", key.alias("key"), F.split(key, " ").alias("t")).filter("key <> ''")
    docs = read(spark, d, "documents").select("doc_id", key.alias("key"), F.split(key, " ").alias("t"))
    long = docs.select("doc_id", windows).join(F.broadcast(b.filter(F.size("t") >= 6).select("item_id", windows)), "name").select("doc_id", "item_id")
    short = b.filter(F.size("t") < 6).select("item_id", F.concat(F.lit(" "), "key", F.lit(" ")).alias("name"))
    held = docs.select("doc_id", F.concat(F.lit(" "), "key", F.lit(" ")).alias("text")).join(F.broadcast(short), F.contains("text", "name")).select("doc_id", "item_id")
    return long.union(held).distinct()


def _valid(spark, d):
    m = mentions(spark, d).join(chunks(spark, d).select(F.col("id").alias("chunk_id"), "source_id"), "chunk_id")
    return m.select("source_id", F.struct("chunk_id", "name").alias("ord"), "chunk_id", "name", F.lit("concept").alias("type"), F.array().cast("array<string>").alias("synonyms"))


def canonical_entities(spark, d):
    v = _valid(spark, d).withColumn("ord", F.row_number().over(X.Window.partitionBy("source_id").orderBy("chunk_id", "name")))
    return X.canonical_entities(v).select("source_id", "name", "freq", F.size("chunk_ids").alias("n_chunks"))


def mention_counts(spark, d):
    return X.mention_counts(_valid(spark, d))


def top_mentions(spark, d):
    return X.top_mentions(_valid(spark, d), 10)


def _relation_rows(spark, d):
    c = chunks(spark, d)
    return c.select(F.col("chapter").alias("src"), F.lit("IN").alias("relation"), F.concat(F.lit("d"), (F.col("id") % 13).cast("string")).alias("dst"), F.col("id").alias("chunk_id"), "source_id", F.col("id").alias("ord"), F.col("text").alias("evidence"))


def _said(c="provenance"):
    return F.array_join(F.transform(c, lambda p: F.concat_ws("/", p["chunk"].cast("string"), p["source"], F.length(p["evidence"]).cast("string"))), ",")


def relation_provenance(spark, d):
    return X.relation_provenance(_relation_rows(spark, d)).select("src", "relation", "dst", _said().alias("provenance"))


def _edges(rows):
    e = X.relation_provenance(rows)
    return e.withColumn("inherited", F.col("src").isin("en", "de")).withColumn("provenance", F.when((F.col("src") == "fr") & F.col("dst").isin("d1", "d2"), F.lit(None)).otherwise(F.col("provenance")))


def provenance_merge(spark, d):
    """Every chunk in both versions; in the old one its edge goes to another target, some of which the new one lacks."""
    new = _relation_rows(spark, d)
    old = new.withColumn("dst", F.concat(F.lit("d"), (F.col("chunk_id") % 17).cast("string")))
    return X.merge_provenance(_edges(old), X.relation_provenance(new)).select("src", "relation", "dst", _said().alias("provenance"), "inherited")


def fragment_purge(spark, d):
    gone = read(spark, d, "documents").filter("doc_id % 3 <> 1").select(F.col("doc_id").alias("chunk_id"))
    return X.purge_fragments(_edges(_relation_rows(spark, d)), gone).select("src", "relation", "dst", _said().alias("provenance"))


def inherited_census(spark, d):
    return X.inherited_census(_edges(_relation_rows(spark, d)))


def closed_inherited(spark, d):
    done = read(spark, d, "documents").filter("source <> 'src11'").select(F.col("source").alias("source_id")).distinct()
    return X.closed_inherited(_edges(_relation_rows(spark, d)), done)


def _nodes(spark, d):
    deg = read(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(F.count("*").alias("degree"))
    p = read(spark, d, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("name"), F.lit("Part").alias("label"), F.col("p_size").cast("long").alias("freq"))
    return p.join(deg, "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))


def dup_groups(spark, d):
    return X.duplicate_groups(_nodes(spark, d))


def doubtful_groups(spark, d):
    return X.doubtful(X.duplicate_groups(_nodes(spark, d)))


def merge_entities(spark, d):
    return X.merge_nodes(X.duplicate_groups(_nodes(spark, d))).select("canonical", "freq", F.array_join("synonyms", "|").alias("synonyms"))


def repoint_edges(spark, d):
    e = read(spark, d, "lineitem").select(F.col("l_partkey").alias("src"), F.lit("NEXT_TO").alias("type"), F.lead("l_partkey").over(X.Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")).alias("dst")).filter("dst is not null")
    return X.repoint(e, X.duplicate_groups(_nodes(spark, d)))


def dedup_report(spark, d):
    g = X.duplicate_groups(_nodes(spark, d)).select("label", "key", "size").distinct()
    return g.groupBy("label").agg(F.count("*").alias("groups"), F.sum("size").alias("nodes"), (F.sum("size") - F.count("*")).alias("removed"))


def checkpoint_resume(spark, d):
    """A checkpoint file over all documents: some lines are cut short, some records hold an error."""
    n, rec = F.col("doc_id"), F.concat(F.lit('{"chunk_id": '), "doc_id")
    line = F.when(n % 7 == 0, rec).when(n % 5 == 0, F.concat(rec, F.lit(', "error": "x"}'))).otherwise(F.concat(rec, F.lit("}")))
    todo = read(spark, d, "documents").select(F.col("doc_id").alias("chunk_id"))
    path = files.scratch(spark)
    spark.range(1).select(F.lit('{"header": "v1"}')).unionAll(read(spark, d, "documents").select(line)).write.text(path)
    return X.resume(files.read_checkpoint(spark, path), todo, "v1")


def prompt_rendered(spark, d):
    c = chunks(spark, d)
    return c.select("id", F.md5(X.render_prompt("Types: {entities}. Relations: {relations}. Text: {fragment}", F.col("text"), TAX)).alias("prompt_md5"))


def _provider(text: str) -> list[float]:
    import hashlib

    h = hashlib.sha256(text.encode()).digest()
    return [b / 255 for b in h[:8]]


def embedding_missing(spark, d):
    rows = chunks(spark, d).join(read(spark, d, "embeddings").select(F.col("vec_id").alias("id")), "id", "left_anti")
    out = X.embed_missing(rows, _provider)
    return out.agg(F.count("embedding").alias("embedded"), F.count_if(F.col("embedding").isNull()).alias("without"), F.coalesce(F.sum("calls"), F.lit(0)).alias("calls"), F.count_if("failed").alias("failed"))


def telemetry_tumbling(spark, d):
    return streams.tumbling(read(spark, d, "events"))


def telemetry_sessions(spark, d):
    return streams.sessions(read(spark, d, "events"), "12 hours")


def run_events(spark, d):
    return streams.run_event(read(spark, d, "events"), "event_seen", ident="event_id", detail="props")


_W = "list_filter(string_split_regex(trim(text), '\\s+'), lambda x: x <> '')"
_NORM = lambda x: f"trim(regexp_replace(trim(regexp_replace(lower({x}), '\\s+', ' ', 'g')), '[.;,]+$', ''))"
_KEY = lambda x: f"trim(regexp_replace(lower(strip_accents({x})), '[^a-z0-9]+', ' ', 'g'))"
_SAME = "(p[j + 1] = t[i + j + 1] OR (least(length(p[j + 1]), length(t[i + j + 1])) >= 4 AND abs(length(p[j + 1]) - length(t[i + j + 1])) <= 3 AND left(p[j + 1], least(length(p[j + 1]), length(t[i + j + 1])) - 1) = left(t[i + j + 1], least(length(p[j + 1]), length(t[i + j + 1])) - 1)))"


def _appears(n: str) -> str:
    p = f"string_split({n}, ' ')"
    same = _SAME.replace("p[", f"{p}[")
    return f"({n} <> '' AND (contains(f, {n}) OR (len({p}) <= len(t) AND len(list_filter(range(len(t) - len({p}) + 1), lambda i: len(list_filter(range(len({p})), lambda j: NOT {same})) = 0)) > 0)))"


_ENT = f"""
WITH w AS (SELECT doc_id AS chunk_id, text, {_W} AS w, {_KEY('text[:2500]')} AS f FROM documents),
r AS (SELECT chunk_id, f, string_split(f, ' ') AS t, unnest([0, 1, 2, 3, 4, 5, 6]) AS "at", unnest([w[4], w[6] || 'xs', 'x', 'zzqq absent', w[5], 'Concepts', 'absent thing']) AS name,
  unnest(['concept', 'tool', 'concept', 'concept', 'unknown', 'concept', 'concept']) AS type, unnest([NULL, NULL, NULL, NULL, NULL, NULL, w[8]]) AS syn FROM w),
n AS (SELECT chunk_id, "at", f, t, {_NORM("coalesce(name, '')")} AS name, type, {_NORM('syn')} AS syn FROM r),
k AS (SELECT *, {_KEY('name')} AS k, CASE WHEN length(syn) >= 2 AND syn <> name THEN {_KEY('syn')} ELSE '' END AS sk FROM n),
v AS (SELECT chunk_id, "at"::INTEGER AS "at", name, type, CASE WHEN length(name) < 2 THEN 'nombre_corto' WHEN length(name) > 100 THEN 'nombre_largo' WHEN type NOT IN ('concept', 'tool') THEN 'tipo_entidad'
  WHEN k IN ('concept', 'concepts', 'tool', 'tools') THEN 'nombre_de_tipo' WHEN f <> '' AND NOT {_appears('k')} AND NOT {_appears('sk')} THEN 'sin_evidencia' END AS motive FROM k)
"""
_MEN = f"{SQL_CHUNKS}, m AS (SELECT DISTINCT id AS chunk_id, source_id, unnest(regexp_extract_all(lower(text), '[a-z]{{2,}}(?:tion|heit|mente)')) AS name FROM chunks)"
_REL = "rel AS (SELECT lang AS src, 'IN' AS relation, 'd' || doc_id % 13 AS dst, doc_id AS chunk, source, length(text[:240]) AS n FROM documents)"
_OLD = """old AS (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY chunk) AS r FROM rel WHERE NOT (src = 'fr' AND dst IN ('d1', 'd2'))),
bare AS (SELECT DISTINCT src, relation, dst FROM rel WHERE src = 'fr' AND dst IN ('d1', 'd2'))"""
_O = "chunk || '/' || source || '/' || CASE WHEN r <= 12 THEN n ELSE 0 END"
_DUP = """n AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS name, 'Part' AS label, p_size::BIGINT AS freq, coalesce(degree, 0) AS degree FROM part LEFT JOIN (SELECT l_partkey, count(*) AS degree FROM lineitem GROUP BY 1) ON l_partkey = p_partkey),
g AS (SELECT label, trim(lower(strip_accents(name))) AS key, count(*) OVER p AS size, id, name, freq, degree, first_value(id) OVER (PARTITION BY label, trim(lower(strip_accents(name))) ORDER BY degree DESC, freq DESC, length(name) DESC, id) AS canonical FROM n WINDOW p AS (PARTITION BY label, trim(lower(strip_accents(name)))) QUALIFY count(*) OVER p > 1)"""
SQL = {
    "validate_entities": f"{_ENT} SELECT * FROM v",
    "extraction_discards": f"{_ENT} SELECT motive, count(*) AS n FROM v WHERE motive IS NOT NULL GROUP BY 1",
    "evidence_spans": f"""WITH b AS (SELECT item_id, string_split({_KEY('text')}, ' ') AS t FROM benchmark WHERE {_KEY('text')} <> ''), d AS (SELECT doc_id, string_split({_KEY('text')}, ' ') AS t FROM documents),
      w AS (SELECT DISTINCT item_id, array_to_string(t[i : i + 5], ' ') AS g FROM (SELECT item_id, t, unnest(range(1, len(t) - 4)) AS i FROM b WHERE len(t) >= 6)),
      x AS (SELECT DISTINCT doc_id, array_to_string(t[i : i + 5], ' ') AS g FROM (SELECT doc_id, t, unnest(range(1, len(t) - 4)) AS i FROM d WHERE len(t) >= 6))
      SELECT DISTINCT doc_id, item_id FROM x JOIN w USING (g) UNION SELECT doc_id, item_id FROM d, b WHERE len(b.t) < 6 AND contains(' ' || array_to_string(d.t, ' ') || ' ', ' ' || array_to_string(b.t, ' ') || ' ')""",
    "canonical_entities": f"WITH {_MEN} SELECT source_id, name, count(*) AS freq, count(DISTINCT chunk_id)::INTEGER AS n_chunks FROM m GROUP BY 1, 2",
    "mention_counts": f"WITH {_MEN} SELECT source_id, name, count(*) AS freq, min(chunk_id) AS first_chunk, count(DISTINCT chunk_id) AS n_chunks FROM m GROUP BY 1, 2",
    "top_mentions": f"WITH {_MEN} SELECT name, chunk_id FROM m QUALIFY row_number() OVER (PARTITION BY name ORDER BY chunk_id) <= 10",
    "relation_provenance": f"WITH {_REL}, o AS (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY chunk) AS r FROM rel) SELECT src, relation, dst, string_agg({_O}, ',' ORDER BY chunk) AS provenance FROM o GROUP BY 1, 2, 3",
    "provenance_merge": f"""WITH {_REL}, new AS (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY chunk) AS r FROM rel),
      o AS (SELECT src, relation, 'd' || chunk % 17 AS dst, chunk, source, n FROM rel), old AS (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY chunk) AS r FROM o WHERE NOT (src = 'fr' AND dst IN ('d1', 'd2'))),
      bare AS (SELECT DISTINCT src, relation, dst FROM o WHERE src = 'fr' AND dst IN ('d1', 'd2') AND (src, dst) NOT IN (SELECT src, dst FROM new)),
      u AS (SELECT src, relation, dst, 0 AS part, chunk, {_O} AS s FROM old WHERE (src, dst, chunk) NOT IN (SELECT src, dst, chunk FROM new) UNION ALL SELECT src, relation, dst, 1, chunk, {_O} FROM new)
      SELECT src, relation, dst, string_agg(s, ',' ORDER BY part, chunk) AS provenance, src IN ('en', 'de') AND (src, dst) NOT IN (SELECT src, dst FROM new) AS inherited FROM u GROUP BY 1, 2, 3 UNION ALL SELECT src, relation, dst, NULL, false FROM bare""",
    "fragment_purge": f"WITH {_REL}, {_OLD} SELECT src, relation, dst, string_agg({_O}, ',' ORDER BY chunk) AS provenance FROM old WHERE chunk % 3 = 1 GROUP BY 1, 2, 3 UNION ALL SELECT src, relation, dst, NULL FROM bare",
    "inherited_census": f"WITH {_REL}, {_OLD}, e AS (SELECT DISTINCT src, dst, true AS p FROM old UNION ALL SELECT src, dst, false FROM bare) SELECT count(*) AS total, count(*) FILTER (src IN ('en', 'de')) AS inherited, count(*) FILTER (NOT p) AS unmarked FROM e",
    "closed_inherited": f"WITH {_REL}, {_OLD} SELECT src, relation, dst FROM old WHERE src IN ('en', 'de') GROUP BY 1, 2, 3 HAVING bool_and(source <> 'src11')",
    "dup_groups": f"WITH {_DUP} SELECT * FROM g",
    "doubtful_groups": f"WITH {_DUP}, s AS (SELECT label, key, count(DISTINCT name) AS n, count(DISTINCT lower(name)) AS low FROM g GROUP BY 1, 2) SELECT label, key, CASE WHEN low < n THEN 'case' ELSE 'spellings' END AS why FROM s WHERE low < n OR n > 3",
    "merge_entities": f"WITH {_DUP} SELECT canonical, sum(freq)::BIGINT AS freq, coalesce(string_agg(DISTINCT name, '|' ORDER BY name) FILTER (name <> own), '') AS synonyms FROM (SELECT g.*, o.name AS own FROM g JOIN n o ON o.id = g.canonical) GROUP BY canonical",
    "repoint_edges": f"""WITH {_DUP}, e AS (SELECT * FROM (SELECT l_partkey AS src, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS dst FROM lineitem) WHERE dst IS NOT NULL)
      SELECT DISTINCT coalesce(a.canonical, src) AS src, 'NEXT_TO' AS type, coalesce(b.canonical, dst) AS dst FROM e LEFT JOIN g a ON a.id = src LEFT JOIN g b ON b.id = dst WHERE NOT coalesce(a.canonical = b.canonical, false)""",
    "dedup_report": f"WITH {_DUP} SELECT label, count(DISTINCT key) AS groups, count(*) AS nodes, count(*) - count(DISTINCT key) AS removed FROM g GROUP BY 1",
    "checkpoint_resume": "SELECT doc_id AS chunk_id FROM documents WHERE doc_id % 7 = 0 OR doc_id % 5 = 0",
    "prompt_rendered": "SELECT doc_id AS id, md5('Types: concept, tool. Relations: USES, PART_OF. Text: ' || text[:2500]) AS prompt_md5 FROM documents",
    "embedding_missing": "SELECT count(*) AS embedded, 0 AS without, count(*) AS calls, 0 AS failed FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)",
    "telemetry_tumbling": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2",
    "telemetry_sessions": "WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s) SELECT user_id, min(ts) AS start, count(*) AS n FROM i GROUP BY user_id, k",
    "run_events": "SELECT 'event_seen' AS event, event_id::VARCHAR AS ident, props[:200] AS detail FROM events",
}


def queries() -> dict:
    fs = [
        validate_entities, extraction_discards, validate_relations, evidence_spans, canonical_entities, mention_counts, top_mentions, relation_provenance, provenance_merge, fragment_purge,
        inherited_census, closed_inherited, dup_groups, doubtful_groups, merge_entities, repoint_edges, dedup_report, checkpoint_resume, prompt_rendered, embedding_missing,
        telemetry_tumbling, telemetry_sessions, run_events,
    ]
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
