"""The question router and the tools on top of retrieval and graph: layers, aliases, facets, entity search, bundles.

A bundle is a dict of DataFrames, one for each layer, all lazy; `layer_results` is the same as one table.
Transport isn't here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.operators import graph as G
from loomgraph.operators import retrieval as R
from loomgraph.sources.files import stored

# --- fixed values: what a question activates, and how its entities are typed, follows from exactly these ---
PATHWAY_CUES = ("qué hago", "que hago", "cómo manejar", "como manejar", "ante un paciente", "manejo de")
ONTOLOGY_CUES = ("clasificación", "clasificacion", "qué tipo", "que tipo", "a qué clase", "pertenece")
FACETS = {
    "es": {
        "definicion": "definicion concepto que es",
        "contexto": "antecedentes contexto historia origen",
        "mecanismo": "mecanismo funcionamiento proceso causas",
        "clasificacion": "clasificacion tipos formas variantes",
        "procedimiento": "procedimiento pasos metodo protocolo",
        "criterios": "criterios requisitos condiciones indicaciones",
        "riesgos": "riesgos limitaciones complicaciones advertencias",
        "evidencia": "evidencia datos resultados estudios",
    },
    "en": {
        "definition": "definition concept what is",
        "context": "background context history origin",
        "mechanism": "mechanism how it works process causes",
        "classification": "classification types forms variants",
        "procedure": "procedure steps method protocol",
        "criteria": "criteria requirements conditions indications",
        "risks": "risks limitations complications warnings",
        "evidence": "evidence data results studies",
    },
}
#: alias: type, label
TYPE_ALIASES = """
medicamento: farmaco, Farmaco
medicina: farmaco, Farmaco
droga: farmaco, Farmaco
drug: farmaco, Farmaco
farmaco: farmaco, Farmaco
fármaco: farmaco, Farmaco
clase de farmaco: clase_farmacologica, CategoriaATC
clase farmacologica: clase_farmacologica, CategoriaATC
grupo farmacologico: clase_farmacologica, CategoriaATC
clase_farmacologica: clase_farmacologica, CategoriaATC
enfermedad: patologia, Patologia
patologia: patologia, Patologia
patología: patologia, Patologia
condicion: patologia, Patologia
trastorno: patologia, Patologia
sindrome: patologia, Patologia
disease: patologia, Patologia
organo: anatomia, EstructuraAnatomica
órgano: anatomia, EstructuraAnatomica
estructura: anatomia, EstructuraAnatomica
anatomia: anatomia, EstructuraAnatomica
anatomía: anatomia, EstructuraAnatomica
estructura_anatomica: anatomia, EstructuraAnatomica
sistema: sistema_corporal, CategoriaSNOMED
sistema_corporal: sistema_corporal, CategoriaSNOMED
aparato: sistema_corporal, CategoriaSNOMED
procedimiento: procedimiento, Procedimiento
tecnica: procedimiento, Procedimiento
estudio: procedimiento, Procedimiento
signo: signo, Signo
sintoma: sintoma, Sintoma
síntoma: sintoma, Sintoma
metodo_dx: metodo_dx, MetodoDx
metodo diagnostico: metodo_dx, MetodoDx
prueba: metodo_dx, MetodoDx
test: metodo_dx, MetodoDx
agente: patologia, Agente
agente_infeccioso: patologia, Agente
microorganismo: patologia, Agente
virus: patologia, Agente
bacteria: patologia, Agente
parasito: patologia, Agente
parametro: metodo_dx, Parametro
valor: metodo_dx, Parametro
laboratorio: metodo_dx, MetodoDx
hallazgo: signo, Hallazgo
grupo_farmacologico: clase_farmacologica, GrupoFarmacologico
clase: clase_farmacologica, CategoriaATC
categoria: clase_farmacologica, CategoriaATC
tratamiento: farmaco, Farmaco
cirugia: procedimiento, Procedimiento
cirugía: procedimiento, Procedimiento
imagen: metodo_dx, MetodoDx
radiografia: metodo_dx, MetodoDx
ecografia: metodo_dx, MetodoDx
analisis: metodo_dx, MetodoDx
"""
LABEL_ALIASES = """
medicamentos: Farmaco
enfermedades: Patologia
farmacos: Farmaco
organos: EstructuraAnatomica
estructuras: EstructuraAnatomica
procedimientos: Procedimiento
signos: Signo
sintomas: Sintoma
sistemas: CategoriaSNOMED
patologias: Patologia
"""
TOTAL_NOTICE = (
    "WARNING: the corpus could not be queried (retrieval failure), so this empty result does NOT mean the corpus lacks material on this topic. "
    "Do not answer as if the sources had been consulted: say the corpus could not be reached, and retry in a couple of minutes."
)
PARTIAL_NOTICE = "NOTE: one of the retrieval paths failed, so these results are less complete than usual. Treat them as partial."
# --- end of the fixed values ---


def _table(lines: str) -> dict[str, list[str]]:
    return {alias: [x.strip() for x in rest.split(",")] for alias, _, rest in (line.partition(": ") for line in lines.strip().splitlines())}


# --- routing -----------------------------------------------------------------------------------


def fallback_layers(question: Column) -> Column:
    """Sorted layers of a question that nothing has analysed: texts and graph always, the others by cue."""
    q = F.lower(question)
    cued = lambda cues, layer: F.when(_any(F.contains(q, F.lit(c)) for c in cues), layer)
    return F.array_sort(F.array_compact(F.array(F.lit("BIBLIOGRAPHY"), F.lit("GRAPH"), cued(PATHWAY_CUES, "DAGS"), cued(ONTOLOGY_CUES, "ONTOLOGY"))))


def _any(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def normalise_types(entities: DataFrame, types: str = TYPE_ALIASES, labels: str = LABEL_ALIASES) -> DataFrame:
    """entities with type and label by alias: a known type sets both, then a known plural sets the label."""
    spark = entities.sparkSession
    t = spark.createDataFrame([(a, *v) for a, v in _table(types).items()], "_alias string, _type string, _label string")
    p = spark.createDataFrame([(a, *v) for a, v in _table(labels).items()], "_plural string, _plural_label string")
    e = entities.join(F.broadcast(t), F.lower(F.trim(F.coalesce("type", F.lit("")))) == F.col("_alias"), "left")
    e = e.join(F.broadcast(p), F.lower(F.trim(F.coalesce("label", F.lit("")))) == F.col("_plural"), "left")
    out = {"type": F.coalesce("_type", "type"), "label": F.coalesce("_plural_label", "_label", "label")}
    return e.withColumns(out).drop("_alias", "_type", "_label", "_plural", "_plural_label")


def facets(language: str | None, wanted: list[str] | None = None) -> list[tuple[str, str]]:
    """(name, terms): the facets of a language (of an unlisted one, the English names as terms), those of them
    that are wanted, and the wanted ones that are none of them, sorted, as they are."""
    known = FACETS.get((language or "").strip().lower()[:2])
    every = list(known.items()) if known else [(n, n) for n in FACETS["en"]]
    asked = {w.strip().lower() for w in wanted or [] if w and w.strip()}
    if not asked:
        return every
    return [f for f in every if f[0] in asked] + [(w, w) for w in sorted(asked - {n for n, _ in every})]


def notice(level: Column) -> Column:
    """struct(degraded, notice) of a level none, parcial or total."""
    said = F.when(level == "total", TOTAL_NOTICE).when(level == "parcial", PARTIAL_NOTICE)
    return F.struct(said.isNotNull().alias("degraded"), said.alias("notice"))


def result_shape(row: dict) -> dict:
    """What telemetry may tell of an answer: how many of each kind, and whether entities and graph took part; no content."""
    lists = ("results", "items", "passages", "chunks", "entities", "sources", "facets")
    shape: dict = {f"n_{k}": len(row[k]) for k in lists if isinstance(row.get(k), (list, dict))}
    return shape | {"with_entities": bool(row.get("entities")), "with_graph": any(row.get(k) for k in ("graph", "subgraph"))}


# --- retrieval with a guarantee ----------------------------------------------------------------

RESULT = ("id", "source_id", "page", "chapter", "section", "kind", "quality", "text")


def chunk_results(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """hits (id and scores) with the columns of a result: what chunks lack is null."""
    have = set(chunks.columns)
    cols = [F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in RESULT]
    return hits.join(chunks.select(*cols), "id")


def allowed_sources(guaranteed: list[str], requested: list[str] | None) -> list[str]:
    """The guaranteed sources that the request allows, in their order; all of them if it names none."""
    return [s for s in guaranteed if s in set(requested)] if requested else list(guaranteed)


def guaranteed_hybrid(general: list[DataFrame], restricted: list[DataFrame], pairs: list[tuple[int, int]], chunks: DataFrame, k: int, share: int | None = None, by: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(the k results, the pool): general rankings fused; restricted ones fused, kept where a raw score reaches the
    floor of its own route (pairs: general and restricted index), scored no lower than their general twin,
    grouped like the rest, and given their share of places. Rankings and the places of their rows are few, are read
    many times and therefore stored: each route and all chunks are gone through once."""
    general, restricted = [stored(r) for r in general], [stored(r) for r in restricted]
    fused = R.rrf(general).select("id", "rrf_score")
    mine = R.rrf(restricted).select("id", "rrf_score")
    mine = R.passes_floor(mine, [general[g] for g, _ in pairs], [restricted[r] for _, r in pairs])
    twin = fused.select("id", F.col("rrf_score").alias("_twin"))
    mine = mine.join(twin, "id", "left").select("id", F.greatest("rrf_score", "_twin").alias("rrf_score"))
    near = F.broadcast(fused.select("id").union(mine.select("id")).distinct())
    place = stored(chunks.select("id", "source_id", "page", "parent_id").join(near, "id", "left_semi"))
    a, b = fused.join(place, "id"), mine.join(place, "id")
    ga, gb = R.group_hits(a, by), R.group_hits(b, by)
    cols = ["id", "source_id", "page", "parent_id", "rrf_score", "units"]
    pool = a.select("id", "source_id").unionAll(b.join(a.select("id"), "id", "left_anti").select("id", "source_id"))
    return R.quota(ga.select(*cols), gb.select(*cols), k, share), pool


def provenance(top: DataFrame, pool: DataFrame) -> DataFrame:
    """scope (top_k, pool, guaranteed, unique), source_id, n: where results and candidates come from."""
    per = lambda df, name: df.filter("source_id is not null").groupBy("source_id").agg(F.count("*").alias("n")).select(F.lit(name).alias("scope"), "source_id", "n")
    sure = top.agg(F.count_if("guaranteed").alias("n")).select(F.lit("guaranteed").alias("scope"), F.lit(None).cast("string").alias("source_id"), "n")
    unique = pool.agg(F.count("*").alias("n")).select(F.lit("unique").alias("scope"), F.lit(None).cast("string").alias("source_id"), "n")
    return per(top, "top_k").unionAll(per(pool, "pool")).unionAll(sure).unionAll(unique)


def report_provenance(kept: DataFrame, facet_provenance: DataFrame) -> DataFrame:
    """scope, source_id, n of a report over facets: top_k counted again on what is left after one hit a chunk,
    the rest summed over the facets (so `unique` isn't a count of distinct chunks)."""
    top = kept.filter("source_id is not null").groupBy("source_id").agg(F.count("*").alias("n")).select(F.lit("top_k").alias("scope"), "source_id", "n")
    rest = facet_provenance.filter("scope <> 'top_k'").groupBy("scope", "source_id").agg(F.sum("n").alias("n")).select("scope", "source_id", "n")
    return top.unionAll(rest)


# --- entities ----------------------------------------------------------------------------------


def search_entities(nodes: DataFrame, query: str, limit: int = 20, indexed: bool = True) -> DataFrame:
    """label, name, freq, degree, score of entities (nodes: label, name, freq, degree) by name: best BM25 first or,
    without an index, names that hold the query, the most frequent first. Chunks, parents and sources are no entities."""
    limit = max(1, min(limit, 50))
    n = nodes.filter(~F.col("label").isin("Chunk", "ParentChunk", "Book"))
    if not query.strip():
        return n.withColumn("score", F.lit(0.0)).limit(0)
    if not indexed:
        held = n.filter(F.contains(F.lower("name"), F.lit(query.strip().lower())))
        return held.withColumn("score", F.lit(0.0)).orderBy(F.desc("freq"), "label", "name").limit(limit)
    keyed = n.withColumn("id", F.concat_ws("\t", "label", "name"))
    found = R.bm25(keyed.select("id", "name"), R.query_terms(nodes.sparkSession, query), ["name"])
    return keyed.join(found, "id").drop("id").orderBy(F.desc("score"), "label", "name").limit(limit)


def topic_relations(nodes: DataFrame, edges: DataFrame, topic: str, searched: int = 3, expanded: int = 2, each: int = 12, most: int = 25, indexed: bool = True) -> DataFrame:
    """src, type, dst around a topic: the neighbours of its best entities, the most frequent first."""
    order = (F.desc("score"), F.desc("freq"), "label", "name")
    best = search_entities(nodes, topic, searched, indexed).withColumn("at", F.row_number().over(Window.orderBy(*order))).filter(F.col("at") <= expanded)
    best = F.broadcast(best.select("at", F.col("label").alias("c_label"), F.col("name").alias("c_name")))
    e = edges.select("src_label", "src", "type", "dst_label", "dst").distinct()
    out = e.join(best, (F.col("src_label") == F.col("c_label")) & (F.col("src") == F.col("c_name"))).select("at", "src", "type", "dst", F.col("dst_label").alias("o_label"), F.col("dst").alias("o_name"))
    back = e.join(best, (F.col("dst_label") == F.col("c_label")) & (F.col("dst") == F.col("c_name"))).select("at", "src", "type", "dst", F.col("src_label").alias("o_label"), F.col("src").alias("o_name"))
    freq = nodes.select(F.col("label").alias("o_label"), F.col("name").alias("o_name"), "freq")
    both = out.unionAll(back).filter(~F.col("o_label").isin("Chunk", "ParentChunk")).join(freq, ["o_label", "o_name"], "left")
    by = Window.partitionBy("at").orderBy(F.desc(F.coalesce("freq", F.lit(0))), "o_label", "o_name", "type", "src")
    near = both.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= each)
    return near.orderBy("at", "rank").limit(most).select("src", "type", "dst")


def expand_concept(nodes: DataFrame, edges: DataFrame, label: str, name: str, types: list[str] | None = None, limit: int = 20) -> dict[str, DataFrame]:
    """The neighbours of one entity, one step away: their nodes and the edges. An unknown entity is an error."""
    here = nodes.filter((F.col("label") == label) & (F.col("name") == name))
    if not here.head(1):
        raise ValueError(f"no entity {label} {name}")
    near = G.one_hop(edges, nodes.select("label", "name", "degree"), name, types, limit)
    return {"center": here, "nodes": near.select(F.col("other_label").alias("label"), F.col("other").alias("name"), "degree").distinct(), "edges": near.select("type", "other_label", "other")}


# --- bundles -----------------------------------------------------------------------------------

Search = Callable[[str, int], DataFrame]


def deep_dive(search: Search, topic: str, chosen: list[tuple[str, str]], per_facet: int = 6) -> DataFrame:
    """facet_order, facet, id, source_id, rrf_score: a search for each facet, each chunk under the first that found it."""
    per_facet = max(2, min(per_facet, 12))
    found = [search(f"{topic} {terms}", per_facet).select(F.lit(i).alias("facet_order"), F.lit(name).alias("facet"), "id", "source_id", "rrf_score") for i, (name, terms) in enumerate(chosen)]
    out = found[0]
    for f in found[1:]:
        out = out.unionAll(f)
    return R.facet_dedup(out)


def answer(spark, question: str, layers: dict[str, Callable[[], DataFrame]], level: str = "none") -> dict[str, object]:
    """The bundle of a question: which layers its fallback analysis activates, their DataFrames, and the notice."""
    row = spark.range(1).select(fallback_layers(F.lit(question)).alias("l"), notice(F.lit(level)).alias("n")).first()
    on = [k for k in row["l"] if k in layers]
    return {"question": question, "layers": on, "degraded": row["n"]["degraded"], "notice": row["n"]["notice"], "results": {k: layers[k]() for k in on}}


def layer_results(bundle: dict) -> DataFrame | None:
    """layer, rank, payload (JSON) of a bundle as one table; each layer's rows are ranked by their JSON."""
    out = None
    for layer, df in bundle["results"].items():
        rows = df.select(F.to_json(F.struct(*df.columns)).alias("payload"))
        rows = rows.select(F.lit(layer).alias("layer"), F.row_number().over(Window.orderBy("payload")).alias("rank"), "payload")
        out = rows if out is None else out.unionAll(rows)
    return out
