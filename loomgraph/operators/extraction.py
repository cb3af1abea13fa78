"""Extracted entities and relations: vocabulary, validation, canonical entities, provenance, resolution."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions import text as T


@dataclass(frozen=True)
class Relation:
    """A relation of the vocabulary: allowed types at either end, stems that affirm and deny it."""

    name: str
    sources: tuple[str, ...] = ()
    targets: tuple[str, ...] = ()
    affirms: tuple[str, ...] = ()
    denies: tuple[str, ...] = ()
    extract: bool = True


@dataclass(frozen=True)
class Taxonomy:
    types: dict[str, str]
    relations: dict[str, Relation]
    synonyms: dict[str, tuple[str, ...]] = field(default_factory=dict)
    min_name: int = 2
    max_name: int = 100
    fragment: int = 2500
    fold_accents: bool = False

    def __post_init__(self):
        if not self.types:
            raise ValueError("a vocabulary without entity types")
        if len(set(self.types.values())) != len(self.types):
            raise ValueError("two types share a label")
        if not 0 < self.min_name <= self.max_name:
            raise ValueError("incoherent name lengths")
        seen: dict[str, str] = {}
        for t, names in self.synonyms.items():
            for n in names:
                if seen.setdefault(n, t) != t:
                    raise ValueError(f"synonym of two types: {n}")
        for r in self.relations.values():
            unknown = {*r.sources, *r.targets} - set(self.types)
            if unknown:
                raise ValueError(f"{r.name} names unknown types: {sorted(unknown)}")
            if not re.fullmatch(r"[A-Z][A-Z0-9_]*", r.name):
                raise ValueError(f"not a relation name: {r.name}")

    @classmethod
    def of_profile(cls, profile: dict) -> Taxonomy:
        canon = profile.get("canonicalization", {})
        return cls(
            types={e["id"]: e["label"] for e in profile["entities"]},
            relations={r["id"]: Relation(r["id"], tuple(r.get("from", ())), tuple(r.get("to", ())), tuple(r.get("affirms", ())), tuple(r.get("denies", ())), r.get("extract", True)) for r in profile.get("relations", [])},
            synonyms={e["id"]: tuple(e.get("synonyms", ())) for e in profile["entities"]},
            min_name=canon.get("min_name", 2),
            max_name=canon.get("max_name", 100),
            fold_accents=canon.get("fold_accents", False),
        )

    def class_names(self) -> list[str]:
        """Folded names of the classes themselves, which are no entities."""
        names = {*self.types, *self.types.values(), *(n for ns in self.synonyms.values() for n in ns)}
        return sorted({re.sub("[^a-z0-9]+", " ", n.lower()).strip() for n in names})

    def dimension(self, spark) -> DataFrame:
        return spark.createDataFrame(sorted(self.types.items()), "type string, label string")

    def rules(self, spark) -> DataFrame:
        return spark.createDataFrame([(r.name, list(r.sources), list(r.targets), r.extract) for r in self.relations.values()], "relation string, sources array<string>, targets array<string>, extract boolean")


def token_pattern(token: Column) -> Column:
    """A pattern of the words (of [a-z0-9]) that are the token up to a suffix: both of at least 4 letters, at most 3
    letters apart in length, and equal in all letters but the last of the shorter."""
    n = F.length(token)
    shorter = [F.when(n - k >= 4, F.concat(F.left(token, n - k - 1), F.lit("[^ ]"))) for k in (1, 2, 3)]
    same = F.concat_ws("|", F.concat(F.left(token, n - 1), F.lit("[^ ]{1,4}")), *shorter)
    return F.when(n >= 4, F.concat(F.lit("(?:"), same, F.lit(")"))).otherwise(token)


def appears(name: Column, fragment: Column) -> Column:
    """Whether a folded name is in a folded fragment: literally, or as neighbouring words up to suffixes."""
    pattern = F.concat(F.lit("(?:^| )"), F.array_join(F.transform(F.split(name, " "), token_pattern), " "), F.lit("(?: |$)"))
    return (name != "") & (F.contains(fragment, name) | F.rlike(fragment, pattern))


def entity_motive(name: Column, kind: Column, synonyms: Column, fragment: Column, tax: Taxonomy) -> Column:
    """Why an entity is refused (name already normalised, fragment folded), or null; the first reason in order."""

    def told(v: Column) -> Column:
        seen = appears(v["folded"], v["fragment"]) | F.exists(v["synonyms"], lambda s: appears(s, v["fragment"]))
        return (
            F.when(F.length(F.coalesce(v["name"], F.lit(""))) < tax.min_name, "nombre_corto")
            .when(F.length(v["name"]) > tax.max_name, "nombre_largo")
            .when(~F.coalesce(v["kind"], F.lit("")).isin(*tax.types), "tipo_entidad")
            .when(v["folded"].isin(*tax.class_names()), "nombre_de_tipo")
            .when((v["fragment"] != "") & ~seen, "sin_evidencia")
        )

    keys = F.transform(F.coalesce(synonyms, F.array().cast("array<string>")), lambda s: T.fold_key(s))
    first = {"name": name, "kind": kind, "synonyms": keys, "fragment": fragment}
    return T.bound(first, lambda v: T.bound({**{k: v[k] for k in first}, "folded": T.fold_key(v["name"])}, told))


def fragment(text: Column, tax: Taxonomy) -> Column:
    """What of a text the extraction has seen, folded."""
    return T.fold_key(F.left(F.coalesce(text, F.lit("")), F.lit(tax.fragment)))


def validate_entities(raw: DataFrame, tax: Taxonomy) -> DataFrame:
    """chunk_id, at, name, type, synonyms, motive over raw (chunk_id, at, name, type, synonyms, text). The fragment is
    folded once for each text, not for each entity: where raw has it as `fragment`, already folded, it is taken."""
    clean = F.filter(F.transform(F.coalesce("synonyms", F.array().cast("array<string>")), lambda s: T.entity_name(s)), lambda s: F.length(s) >= tax.min_name)
    x = raw.select("chunk_id", "at", T.entity_name(F.coalesce("name", F.lit("")), not tax.fold_accents).alias("name"), F.lower(F.trim(F.coalesce("type", F.lit("")))).alias("type"), clean.alias("synonyms"), (F.col("fragment") if "fragment" in raw.columns else fragment(F.col("text"), tax)).alias("_f"))
    x = x.withColumn("synonyms", F.filter("synonyms", lambda s: s != F.col("name")))
    return x.select("chunk_id", "at", "name", "type", "synonyms", entity_motive(F.col("name"), F.col("type"), F.col("synonyms"), F.col("_f"), tax).alias("motive"))


def denied(evidence: Column, r: Relation) -> Column:
    """A denying stem in the folded evidence and, once it is blotted out, no affirming one."""
    if not r.denies:
        return F.lit(False)
    stems = lambda xs: r"\b(?:" + "|".join(re.escape(s) for s in xs) + ")"
    rest = F.regexp_replace(evidence, stems(r.denies), " ")
    return evidence.rlike(stems(r.denies)) & (~rest.rlike(stems(r.affirms)) if r.affirms else F.lit(True))


def relation_motive(tax: Taxonomy, need_evidence: bool = True) -> Column:
    """Why a relation is refused, or null. Columns: src, relation, dst (normalised), src_type, dst_type, evidence (raw),
    src_synonyms, dst_synonyms, fragment (folded). `silencio` is a blank that nobody counts."""
    src, rel, dst, st, dt, frag = (F.col(c) for c in ("src", "relation", "dst", "src_type", "dst_type", "fragment"))
    classes, none = tax.class_names(), F.array().cast("array<string>")

    def told(v: Column) -> Column:
        ev, toks = v["ev"], F.split(v["ev"], " ")
        ends = lambda n, syn: appears(n, ev) | F.exists(F.coalesce(syn, none), lambda s: appears(T.fold_key(s), ev))
        # folded words have one blank between them
        spaced = lambda x: F.concat(F.lit(" "), x, F.lit(" "))
        share = F.size(F.filter(toks, lambda w: F.contains(spaced(frag), spaced(w)))) / F.size(toks)
        inverted, negated = F.lit(False), F.lit(False)
        for r in tax.relations.values():
            fits = lambda a, b, r=r: (a.isin(*r.sources) if r.sources else F.lit(True)) & (b.isin(*r.targets) if r.targets else F.lit(True))
            inverted = inverted | ((rel == r.name) & st.isNotNull() & dt.isNotNull() & ~fits(st, dt) & fits(dt, st))
            negated = negated | ((rel == r.name) & denied(ev, r))
        out = (
            F.when((src == "") | (dst == "") | (rel == ""), "silencio")
            .when(~rel.isin(*tax.relations), "tipo_relacion")
            .when(src == dst, "extremos_iguales")
            .when(v["src"].isin(*classes) | v["dst"].isin(*classes), "nombre_de_tipo")
            .when(st.isNull() & dt.isNull(), "extremo_ausente")
            .when(inverted, "orientacion")
        )
        if need_evidence:
            with_text = frag != ""
            out = (
                out.when(with_text & (ev == ""), "sin_evidencia_relacion")
                .when(with_text & (F.length(ev) > 240), "evidencia_larga")
                .when(with_text & F.trim("evidence").rlike(r"[.!?]\s+\S"), "evidencia_dos_oraciones")
                .when(with_text & ~F.contains(frag, ev) & ~((F.size(toks) >= 3) & (share >= 0.85)), "evidencia_ajena")
                .when(with_text & ~(ends(v["src"], F.col("src_synonyms")) & ends(v["dst"], F.col("dst_synonyms"))), "evidencia_incompleta")
                .when(with_text & negated, "polaridad")
            )
        return out

    return T.bound({"ev": T.fold_key(F.coalesce("evidence", F.lit(""))), "src": T.fold_key(src), "dst": T.fold_key(dst)}, told)


def validate_relations(raw: DataFrame, entities: DataFrame, tax: Taxonomy, need_evidence: bool = True) -> DataFrame:
    """chunk_id, at, src, relation, dst, motive, illegal over raw (chunk_id, at, src, relation, dst, evidence, text, or the
    folded fragment as `fragment`) and the validated entities. illegal: the types fit in neither direction, which is counted
    but not refused. A chunk's entities are one map, so relations meet them in one join."""
    good = entities.filter("motive is null").groupBy("chunk_id", "name").agg(F.max_by("type", "at").alias("type"), F.max_by("synonyms", "at").alias("synonyms"))
    known = good.groupBy("chunk_id").agg(F.map_from_entries(F.collect_list(F.struct("name", F.struct("type", "synonyms").alias("e")))).alias("_known"))
    folded = F.col("fragment") if "fragment" in raw.columns else fragment(F.col("text"), tax)
    x = raw.select("chunk_id", "at", *(T.entity_name(F.coalesce(c, F.lit(""))).alias(c) for c in ("src", "dst")), F.upper(F.trim(F.coalesce("relation", F.lit("")))).alias("relation"), "evidence", folded.alias("fragment"))
    x = x.join(known, "chunk_id", "left")
    for end in ("src", "dst"):
        x = x.withColumn("_e", F.try_element_at("_known", F.col(end))).withColumns({f"{end}_type": F.col("_e")["type"], f"{end}_synonyms": F.col("_e")["synonyms"]})
    illegal = F.lit(False)
    for r in tax.relations.values():
        bad = F.lit(False)
        for c, allowed in (("src_type", r.sources), ("dst_type", r.targets)):
            if allowed:
                bad = bad | F.coalesce(~F.col(c).isin(*allowed), F.lit(False))
        illegal = illegal | ((F.col("relation") == r.name) & bad)
    return x.select("chunk_id", "at", "src", "relation", "dst", relation_motive(tax, need_evidence).alias("motive"), illegal.alias("illegal"))


def discards(validated: DataFrame) -> DataFrame:
    return validated.filter("motive is not null and motive <> 'silencio'").groupBy("motive").agg(F.count("*").alias("n"))


# --- canonical entities and provenance ---------------------------------------------------------

CANONICAL = "source_id string, name string, type string, freq long, chunk_ids array<long>, synonyms array<string>"


def canonical_entities(valid: DataFrame) -> DataFrame:
    """One row for each entity of a source (valid: source_id, ord, chunk_id, name, type, synonyms).

    A synonym seen later doesn't move earlier mentions, so mentions are folded in order, source by source."""

    def one(pdf):
        import pandas as pd

        made: dict[str, dict] = {}
        alias: dict[str, str] = {}
        for row in pdf.sort_values("ord", kind="stable").itertuples(index=False):
            key = row.name if row.name in made else alias.get(row.name, row.name)
            e = made.setdefault(key, {"type": row.type, "freq": 0, "chunks": {}, "syn": {}})
            e["freq"] += 1
            e["chunks"][row.chunk_id] = None
            extra = [s for s in (row.synonyms if row.synonyms is not None else []) if s != key]
            e["syn"].update(dict.fromkeys(extra + ([row.name] if row.name != key else [])))
            for s in extra:
                alias.setdefault(s, key)
        rows = [(pdf["source_id"].iloc[0], k, e["type"], e["freq"], list(e["chunks"]), list(e["syn"])) for k, e in made.items()]
        return pd.DataFrame(sorted(rows, key=lambda r: -r[3]), columns=[c.split()[0] for c in CANONICAL.split(", ")])

    return valid.groupBy("source_id").applyInPandas(one, CANONICAL)


def mention_counts(valid: DataFrame) -> DataFrame:
    """source_id, name, freq, first_chunk, n_chunks: the part of canonicalisation that needs no order."""
    return valid.groupBy("source_id", "name").agg(F.count("*").alias("freq"), F.min_by("chunk_id", "ord").alias("first_chunk"), F.count_distinct("chunk_id").alias("n_chunks"))


def top_mentions(valid: DataFrame, most: int = 10) -> DataFrame:
    """name, chunk_id: an entity's first chunks in document order, at most `most`."""
    first = valid.groupBy("name", "chunk_id").agg(F.min("ord").alias("ord"))
    at = F.row_number().over(Window.partitionBy("name").orderBy("ord"))
    return first.withColumn("at", at).filter(F.col("at") <= most).select("name", "chunk_id")


def relation_provenance(rows: DataFrame, cut: int = 240, blank_after: int = 12) -> DataFrame:
    """src, relation, dst, provenance (chunk, source, evidence; one for each chunk, in order; evidence blank beyond the 12th)."""
    per = Window.partitionBy("src", "relation", "dst", "chunk_id").orderBy("ord")
    r = rows.withColumn("evidence", F.left("evidence", F.lit(cut))).withColumn("_at", F.row_number().over(per)).filter("_at = 1")
    item = F.struct("ord", F.col("chunk_id").alias("chunk"), F.col("source_id").alias("source"), "evidence")
    g = r.groupBy("src", "relation", "dst").agg(F.array_sort(F.collect_list(item)).alias("p"))
    said = F.transform("p", lambda x, i: F.struct(x["chunk"].alias("chunk"), x["source"].alias("source"), F.when(i < blank_after, x["evidence"]).otherwise(F.lit("")).alias("evidence")))
    return g.select("src", "relation", "dst", said.alias("provenance"))


def merge_provenance(old: DataFrame, new: DataFrame) -> DataFrame:
    """Idempotent by fragment: new entries replace those of their chunks, others stay before them; inherited marks go.
    Which entries go is found by a join, as one edge may have very many."""
    a = old.select("src", "relation", "dst", F.col("provenance").alias("_old"), "inherited")
    b = new.select("src", "relation", "dst", F.col("provenance").alias("_new"))
    j = a.join(b, ["src", "relation", "dst"], "full_outer")
    by = ["src", "relation", "dst"]
    gone = b.select(*by, F.explode("_new").alias("x")).select(*by, F.col("x")["chunk"].alias("_c"))
    rest = a.select(*by, F.posexplode("_old").alias("at", "p")).withColumn("_c", F.col("p")["chunk"]).join(gone, [*by, "_c"], "left_anti")
    rest = rest.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("at", "p"))).alias("x")).select(*by, F.transform("x", lambda y: y["p"]).alias("_kept"))
    kept = F.coalesce("_kept", F.slice("_old", 1, 0))
    merged = F.when(F.col("_new").isNull(), F.col("_old")).when(F.col("_old").isNull(), F.col("_new")).otherwise(F.concat(kept, "_new"))
    return j.join(rest, by, "left").select(*by, merged.alias("provenance"), F.when(F.col("_new").isNull(), F.col("inherited")).otherwise(False).alias("inherited"))


def purge_fragments(edges: DataFrame, chunks: DataFrame) -> DataFrame:
    """edges without the provenance of these chunks; an edge left without any goes, one that never had any stays (null)."""
    hit = edges.filter("provenance is not null").select("src", "relation", "dst", F.posexplode("provenance").alias("at", "p"))
    left = hit.join(chunks.select(F.col("chunk_id").alias("_c")), F.col("p")["chunk"] == F.col("_c"), "left_anti")
    again = left.groupBy("src", "relation", "dst").agg(F.array_sort(F.collect_list(F.struct("at", "p"))).alias("x")).select("src", "relation", "dst", F.transform("x", lambda y: y["p"]).alias("provenance"))
    bare = edges.filter("provenance is null").select("src", "relation", "dst", "provenance")
    return again.unionByName(bare)


def inherited_census(edges: DataFrame) -> DataFrame:
    return edges.agg(F.count("*").alias("total"), F.count_if("inherited").alias("inherited"), F.count_if(F.col("provenance").isNull()).alias("unmarked"))


def closed_inherited(edges: DataFrame, done: DataFrame) -> DataFrame:
    """Inherited edges all of whose sources were extracted again."""
    x = edges.filter("inherited and provenance is not null").select("src", "relation", "dst", F.explode("provenance").alias("p")).select("src", "relation", "dst", F.col("p")["source"].alias("source_id"))
    j = x.join(done.select("source_id", F.lit(True).alias("ok")).distinct(), "source_id", "left")
    return j.groupBy("src", "relation", "dst").agg(F.bool_and(F.coalesce("ok", F.lit(False))).alias("closed")).filter("closed").drop("closed")


# --- resolution --------------------------------------------------------------------------------


def duplicate_groups(nodes: DataFrame) -> DataFrame:
    """Nodes (id, name, label, freq, degree) whose folded names and labels agree, with canonical: the best by degree,
    frequency, name length, then the smallest id."""
    n = nodes.withColumn("key", F.trim(T.fold(F.col("name"))))
    by = Window.partitionBy("label", "key")
    n = n.withColumn("size", F.count("*").over(by)).filter("size > 1")
    best = F.first("id").over(by.orderBy(F.desc("degree"), F.desc("freq"), F.desc(F.length("name")), "id"))
    more = ["synonyms"] if "synonyms" in nodes.columns else []
    return n.select("label", "key", "size", "id", "name", "freq", "degree", best.alias("canonical"), *more)


def doubtful(groups: DataFrame) -> DataFrame:
    """label, key, why: variants in case only, or more than three spellings."""
    g = groups.groupBy("label", "key").agg(F.collect_set("name").alias("n")).withColumn("low", F.size(F.array_distinct(F.transform("n", lambda x: F.lower(x)))))
    why = F.when(F.col("low") < F.size("n"), "case").when(F.size("n") > 3, "spellings")
    return g.select("label", "key", why.alias("why")).filter("why is not null")


def merge_nodes(groups: DataFrame) -> DataFrame:
    """canonical, freq, synonyms: frequencies summed; names and, where groups have them, synonyms of all members, but
    for the canonical's own name."""
    own = F.max(F.when(F.col("id") == F.col("canonical"), F.col("name"))).alias("own")
    names = F.collect_set("name")
    if "synonyms" in groups.columns:
        names = F.array_union(names, F.flatten(F.collect_list(F.coalesce("synonyms", F.array().cast("array<string>")))))
    g = groups.groupBy("canonical").agg(own, F.sum("freq").alias("freq"), F.array_sort(names).alias("names"))
    return g.select("canonical", "freq", F.array_remove("names", F.col("own")).alias("synonyms"))


def repoint(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """Both ends (src, dst) replaced by their canonical node (mapping: id, canonical); edges inside a group go."""
    m = mapping.select("id", "canonical")
    x = edges.join(m.select(F.col("id").alias("src"), F.col("canonical").alias("cs")), "src", "left").join(m.select(F.col("id").alias("dst"), F.col("canonical").alias("cd")), "dst", "left")
    a, b = F.coalesce("cs", "src"), F.coalesce("cd", "dst")
    inside = F.col("cs").isNotNull() & F.col("cd").isNotNull() & (F.col("cs") == F.col("cd"))
    return x.filter(~inside).select(a.alias("src"), "type", b.alias("dst")).distinct()


# --- checkpoints and providers -----------------------------------------------------------------


def resume(lines: DataFrame, todo: DataFrame, header: str) -> DataFrame:
    """What of todo (chunk_id) a checkpoint (n, line) lacks: broken lines are skipped, rows with an error aren't done, and
    with another header nothing is."""
    j = lines.select("n", F.get_json_object("line", "$.header").alias("header"), F.get_json_object("line", "$.chunk_id").cast("long").alias("chunk_id"), F.get_json_object("line", "$.error").alias("error"))
    fits = j.filter((F.col("n") == 0) & (F.col("header") == header)).select(F.lit(1).alias("one"))
    done = j.filter("n > 0 and chunk_id is not null and error is null").withColumn("one", F.lit(1)).join(F.broadcast(fits.limit(1)), "one", "left_semi").select("chunk_id").distinct()
    return todo.join(done, "chunk_id", "left_anti")


def embed_missing(rows: DataFrame, provider, batch: int = 10, tries: int = 3) -> DataFrame:
    """id, embedding, calls, failed over rows (id, text): one billable call a text, a batch is kept whole or not at all, a
    failing batch doesn't stop the rest. Totals are sums over the result, so a repeated task doesn't count twice."""

    def run(frames):
        import pandas as pd

        for pdf in frames:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                vectors, calls = None, 0
                for _ in range(tries):
                    try:
                        got = []
                        for t in part["text"]:
                            calls += 1
                            got.append(provider(t))
                        vectors = got if len(got) == len(part) and all(v is not None for v in got) else None
                    except Exception:  # noqa: BLE001  whatever a provider raises is a failed try
                        vectors = None
                    if vectors is not None:
                        break
                yield pd.DataFrame({"id": part["id"].to_numpy(), "embedding": vectors if vectors is not None else [None] * len(part), "calls": [calls] + [0] * (len(part) - 1), "failed": [vectors is None] * len(part)})

    return rows.select("id", "text").mapInPandas(run, "id long, embedding array<float>, calls int, failed boolean")


def render_prompt(template: str, fragment: Column, tax: Taxonomy) -> Column:
    """The template with its markers {fragment}, {entities}, {relations} filled."""
    out = F.replace(F.lit(template), F.lit("{entities}"), F.lit(", ".join(tax.types)))
    out = F.replace(out, F.lit("{relations}"), F.lit(", ".join(r.name for r in tax.relations.values() if r.extract)))
    return F.replace(out, F.lit("{fragment}"), F.left(fragment, F.lit(tax.fragment)))


def embed_all(rows: DataFrame, provider, batch: int = 10, tries: int = 3, store=None) -> DataFrame:
    """id, embedding, calls, failed over rows (id, text): embed_missing, then once more over what it left without a
    vector. calls are those of both passes, failed is the second's. store(df) keeps a pass, so that it isn't run twice."""
    store = store or (lambda df: df.persist())
    first = store(embed_missing(rows, provider, batch, tries))
    lost = first.filter("embedding is null").select("id", F.col("calls").alias("_calls"))
    second = store(embed_missing(rows.join(lost.select("id"), "id", "left_semi"), provider, batch, tries))
    again = second.join(lost, "id").select("id", "embedding", (F.col("calls") + F.col("_calls")).alias("calls"), "failed")
    return first.filter("embedding is not null").unionByName(again)


def ask_batches(rows: DataFrame, provider, tries: int = 3) -> DataFrame:
    """id, answers over rows (id, prompt): the JSON array that the model answers, or an empty one after the last try."""

    def run(frames):
        import json

        import pandas as pd

        for pdf in frames:
            out = []
            for prompt in pdf["prompt"]:
                said: list = []
                for _ in range(tries):
                    try:
                        got = provider(prompt)
                        got = json.loads(got[got.index("[") : got.rindex("]") + 1])
                    except Exception:  # noqa: BLE001  whatever a provider raises or answers is a failed try
                        continue
                    said = [json.dumps(x, ensure_ascii=False, sort_keys=True) for x in got]
                    break
                out.append(said)
            yield pd.DataFrame({"id": pdf["id"].to_numpy(), "answers": out})

    return rows.select("id", "prompt").mapInPandas(run, "id long, answers array<string>")


# --- the older validation, and small operators -------------------------------------------------


def legacy_validate(entities: DataFrame, relations: DataFrame, types: list[str], kinds: list[str]) -> tuple[DataFrame, DataFrame]:
    """(entities, relations) that the older rules keep: names of 2 to 100 characters of a listed type; listed relations
    with both ends, one of them at least an entity kept in the same chunk."""
    name = T.entity_name(F.coalesce("name", F.lit("")))
    e = entities.select("chunk_id", "at", name.alias("name"), F.lower(F.trim(F.coalesce("type", F.lit("")))).alias("type"), F.coalesce("synonyms", F.array().cast("array<string>")).alias("_s"))
    clean = F.filter(F.transform("_s", lambda s: T.entity_name(s)), lambda s: (F.length(s) >= 2) & (s != F.col("name")))
    e = e.filter(F.length("name").between(2, 100) & F.col("type").isin(*types)).select("chunk_id", "at", "name", "type", clean.alias("synonyms"))
    end = lambda c: T.entity_name(F.coalesce(c, F.lit(""))).alias(c)
    r = relations.select("chunk_id", "at", end("src"), F.upper(F.trim(F.coalesce("relation", F.lit("")))).alias("relation"), end("dst"))
    r = r.filter((F.col("src") != "") & (F.col("dst") != "") & F.col("relation").isin(*kinds))
    known = e.groupBy("chunk_id").agg(F.collect_set("name").alias("_n"))
    held = F.array_contains("_n", F.col("src")) | F.array_contains("_n", F.col("dst"))
    return e, r.join(known, "chunk_id").filter(held).drop("_n")


def distinct_in_order(rows: DataFrame) -> DataFrame:
    """chunk_id, ord: each chunk at its first place (rows: ord, chunk_id), those that yielded nothing included."""
    return rows.groupBy("chunk_id").agg(F.min("ord").alias("ord"))


def group_types(edges: DataFrame, groups: DataFrame) -> DataFrame:
    """key, types, fine: the types of the edges that touch a duplicate of each group; a group with a type that isn't
    an upper-case identifier must not be merged."""
    d = groups.filter(F.col("id") != F.col("canonical")).select("label", "key", F.col("id").alias("_id"))
    ends = edges.select(F.col("src").alias("_id"), "type").unionAll(edges.select(F.col("dst").alias("_id"), "type")).distinct()
    t = d.join(ends, "_id").groupBy("label", "key").agg(F.array_sort(F.collect_set("type")).alias("types"))
    return t.select("label", "key", "types", F.forall("types", lambda x: x.rlike("^[A-Z][A-Z0-9_]*$")).alias("fine"))


def fill_provenance(edges: DataFrame, source: str, profile: str) -> DataFrame:
    """Entries of provenance without a source or profile get the run's; no provenance becomes an empty one."""
    item = lambda p: F.struct(p["chunk"].alias("chunk"), F.coalesce(p["source"], F.lit(source)).alias("source"), F.coalesce(p["profile"], F.lit(profile)).alias("profile"), p["evidence"].alias("evidence"))
    kind = "array<struct<chunk:{c},source:string,profile:string,evidence:string>>".format(c=edges.schema["provenance"].dataType.elementType["chunk"].dataType.simpleString())
    return edges.withColumn("provenance", F.coalesce(F.transform("provenance", item), F.array().cast(kind)))


def merge_edge_provenance(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """src, type, dst, provenance after duplicates gave way (mapping: id, canonical): an edge's own entries first, then
    those of the edges that fell onto it, each chunk once; edges without any lineage stay without."""
    m = mapping.select("id", "canonical")
    x = edges.join(m.select(F.col("id").alias("src"), F.col("canonical").alias("cs")), "src", "left").join(m.select(F.col("id").alias("dst"), F.col("canonical").alias("cd")), "dst", "left")
    inside = F.col("cs").isNotNull() & F.col("cd").isNotNull() & (F.col("cs") == F.col("cd"))
    moved = (F.coalesce("cs", "src") != F.col("src")) | (F.coalesce("cd", "dst") != F.col("dst"))
    x = x.filter(~inside).select(F.coalesce("cs", "src").alias("src"), "type", F.coalesce("cd", "dst").alias("dst"), F.struct(moved.alias("moved"), F.col("src").alias("s"), F.col("dst").alias("d")).alias("_from"), "provenance")
    by = ["src", "type", "dst"]
    p = x.select(*by, "_from", F.posexplode("provenance").alias("_at", "p"))
    first = F.row_number().over(Window.partitionBy(*by, F.col("p")["chunk"]).orderBy("_from", "_at"))
    p = p.withColumn("_n", first).filter("_n = 1").groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_from", "_at", "p"))).alias("x")).select(*by, F.transform("x", lambda y: y["p"]).alias("provenance"))
    return x.select(*by).distinct().join(p, by, "left")


def resolve_ontology(answers: DataFrame, catalogue: DataFrame) -> DataFrame:
    """name, target over answers (name, system, subcategory) and the catalogue (ord, code, system, name): the first
    subcategory of the system that holds the answer's or is held by it, else the system itself. Blank names, `skip`
    and systems that the catalogue lacks are dropped."""
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    a = answers.select(low("name").alias("name"), low("system").alias("system"), low("subcategory").alias("sub")).distinct()
    known = F.broadcast(catalogue.select("system").distinct())
    a = a.filter((F.col("name") != "") & (F.col("system") != "skip")).join(known, "system", "left_semi")
    c = F.broadcast(catalogue.select("system", "ord", "code", F.lower("name").alias("_c")))
    hit = a.join(c, "system", "left").withColumn("_fits", F.contains("_c", "sub") | F.contains("sub", "_c"))
    g = hit.groupBy("name", "system", "sub").agg(F.min_by(F.when(F.col("_fits"), F.col("code")), F.when(F.col("_fits"), F.col("ord"))).alias("code"))
    return g.select("name", F.coalesce("code", "system").alias("target")).distinct()
