"""Hybrid retrieval as one plan: BM25 and cosine rankings, reciprocal rank fusion, guarantees, grouping, quotas.

Filters sit below the top-k, so no pool is inflated. Rankings are at most POOL rows a route, taken with
TakeOrderedAndProject; what follows works on those few rows. Ties go to the smaller id everywhere.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.sources.files import stored

K1, B, RRF_K, POOL, FLOOR = 1.2, 0.75, 60, 150, 0.5


def query_terms(spark, query: str) -> list[str]:
    """The distinct index terms of a query, by the one fold that the index uses."""
    row = spark.range(1).select(T.tokens(F.concat_ws(" ", T.search_terms(F.lit(query)))).alias("t")).first()
    return list(dict.fromkeys(row["t"]))


def postings(docs: DataFrame, fields: list[str]) -> DataFrame:
    """field, term, id, tf: the inverted index, to be stored by term for repeated queries."""
    parts = [docs.select("id", F.lit(f).alias("field"), F.explode(T.tokens(F.coalesce(F.col(f), F.lit("")))).alias("term")) for f in fields]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.groupBy("field", "term", "id").agg(F.count("*").alias("tf"))


def _tokenised(docs: DataFrame, fields: list[str]) -> DataFrame:
    """id, field, t: the tokens of each field."""
    both = F.array(*(F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f), F.lit("")).alias("text")) for f in fields))
    return docs.select("id", F.inline(both)).select("id", "field", T.tokens(F.col("text")).alias("t"))


def term_counts(tokens: Column) -> Column:
    """array of (term, tf) of a document's tokens: they are sorted, a term's count is the way to where the next one starts."""

    def counted(v: Column) -> Column:
        s, at = v["s"], v["at"]
        return F.transform(at, lambda i, k: F.struct(F.get(s, i).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).cast("long").alias("tf")))

    def starts(v: Column) -> Column:
        s = v["s"]
        new = F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (x != F.get(s, i - 1)), i)), lambda i: i.isNotNull())
        return T.bound({"s": s, "at": new}, counted)

    return T.bound({"s": F.sort_array(tokens)}, starts)


def _statistics(tokenised: DataFrame) -> DataFrame:
    """field, n, a: documents and their mean length."""
    return tokenised.groupBy("field").agg(F.count("*").alias("n"), F.avg(F.size("t")).alias("a"))


def _scores(hits: DataFrame, stats: DataFrame) -> DataFrame:
    """id, score over hits (field, term, id, tf, dl): BM25 summed over fields and terms."""
    df = hits.groupBy("field", "term").agg(F.count("*").alias("df")).join(F.broadcast(stats), "field")
    idf = F.log(F.lit(1.0) + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = F.broadcast(df.select("field", "term", idf.alias("idf"), "a"))
    norm = F.col("tf") + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("dl") / F.col("a"))
    return hits.join(weights, ["field", "term"]).groupBy("id").agg(F.round(F.sum(F.col("idf") * F.col("tf") * F.lit(K1 + 1) / norm), 6).alias("score"))


def _no_scores(docs: DataFrame) -> DataFrame:
    return docs.select("id", F.lit(None).cast("double").alias("score")).limit(0)


def bm25(docs: DataFrame, terms: list[str], fields: list[str]) -> DataFrame:
    """id, score of the docs that hold a term, for docs that have no index: reads all of them. Only rows that hold a
    term are exchanged."""
    if not terms:
        return _no_scores(docs)
    t = _tokenised(docs, fields)
    found = t.select("id", "field", F.size("t").alias("dl"), F.explode(F.filter("t", lambda w: w.isin(terms))).alias("term"))
    hits = found.groupBy("field", "term", "id", "dl").agg(F.count("*").alias("tf"))
    return _scores(hits, _statistics(t))


class Index:
    """A stored inverted index: postings (field, term, id, tf, dl) sorted by term, so that a query reads the row
    groups of its terms only, and one row of statistics for each field."""

    def __init__(self, spark, path: str):
        self.postings, self.stats = spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/stats")

    @staticmethod
    def build(docs: DataFrame, fields: list[str], path: str) -> Index:
        """Terms are counted within their document, so only finished postings are exchanged, once."""
        t = stored(_tokenised(docs, fields).select("id", "field", F.size("t").alias("dl"), term_counts(F.col("t")).alias("c")))
        rows = t.select("id", "field", "dl", F.inline("c")).select("field", "term", "id", "dl", "tf")
        rows.repartitionByRange("term", "id").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/postings")
        t.groupBy("field").agg(F.count("*").alias("n"), F.avg("dl").alias("a")).write.mode("overwrite").parquet(f"{path}/stats")
        return Index(docs.sparkSession, path)

    def bm25(self, terms: list[str], allowed: DataFrame | None = None) -> DataFrame:
        """id, score of the docs that hold a term, of those allowed (id) if given; weights are those of the whole index."""
        if not terms:
            return _no_scores(self.postings)
        out = _scores(self.postings.filter(F.col("term").isin(terms)), self.stats)
        return out if allowed is None else out.join(allowed.select("id"), "id", "left_semi")


def cosine(vectors: DataFrame, query: list[float], index_scale: bool = False) -> DataFrame:
    """id, score against a query vector, in double arithmetic; index_scale maps it to (1 + cos) / 2."""
    q = F.array(*(F.lit(float(x)) for x in query))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    norm = F.sqrt(dot(F.col("embedding"), F.col("embedding"))) * math.sqrt(sum(float(x) ** 2 for x in query))
    cos = dot(F.col("embedding"), q) / norm
    return vectors.select("id", F.round((1 + cos) / 2 if index_scale else cos, 6).alias("score"))


def top(scored: DataFrame, k: int = POOL) -> DataFrame:
    """The k best with their rank from 1."""
    best = scored.orderBy(F.desc("score"), "id").limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "id")))


def rrf(rankings: list[DataFrame], k: int = RRF_K) -> DataFrame:
    """id, rrf_score, routes over rankings (id, rank)."""
    out = rankings[0].select("id", "rank")
    for r in rankings[1:]:
        out = out.unionAll(r.select("id", "rank"))
    return out.groupBy("id").agg(F.round(F.sum(1.0 / (k + F.col("rank"))), 6).alias("rrf_score"), F.count("*").alias("routes"))


def passes_floor(candidates: DataFrame, general: list[DataFrame], restricted: list[DataFrame], fraction: float = FLOOR) -> DataFrame:
    """Candidates (id) whose raw score in either restricted route reaches a fraction of the best of the same general route."""
    good = None
    for g, r in zip(general, restricted, strict=True):
        best = g.agg(F.coalesce(F.max("score"), F.lit(0.0)).alias("best"), F.lit(1).alias("one"))
        ok = r.withColumn("one", F.lit(1)).join(F.broadcast(best), "one").filter(F.col("score") >= fraction * F.col("best")).select("id")
        good = ok if good is None else good.union(ok)
    return candidates.join(good.distinct(), "id", "left_semi")


def group_hits(hits: DataFrame, by: str | None) -> DataFrame:
    """Collapse hits of one parent (or page) into the best, with its `units`; before anything is cut."""
    if by is None:
        return hits.withColumn("units", F.array(F.struct("rrf_score", "id")))
    key = {"parent": F.coalesce("parent_id", "id").cast("string"), "page": F.concat_ws("/", "source_id", "page")}[by]
    best = [F.max_by(c, F.struct("rrf_score", -F.col("id"))).alias(c) for c in hits.columns]
    units = F.reverse(F.array_sort(F.collect_list(F.struct("rrf_score", "id")))).alias("units")
    return hits.groupBy(key.alias("_key")).agg(*best, units).drop("_key")


def quota(general: DataFrame, guaranteed: DataFrame, k: int, share: int | None = None) -> DataFrame:
    """The first `share` of guaranteed, the rest from general, no id twice, sorted by score: k rows at most."""
    share = max(1, k // 2) if share is None else max(0, share)
    order = Window.orderBy(F.desc("rrf_score"), "id")
    first = guaranteed.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= min(share, k)).drop("_r").withColumn("guaranteed", F.lit(True))
    rest = general.join(first.select("id"), "id", "left_anti").withColumn("guaranteed", F.lit(False)).withColumn("_r", F.row_number().over(order))
    taken = first.withColumn("_r", F.row_number().over(order))
    both = taken.withColumn("_p", F.lit(0)).unionByName(rest.withColumn("_p", F.lit(1)))
    both = both.withColumn("_at", F.row_number().over(Window.orderBy("_p", "_r"))).filter(F.col("_at") <= k)
    return both.drop("_r", "_p", "_at")


def quota_capped(general: DataFrame, guaranteed: DataFrame, k: int, share: int | None, per_source: int) -> DataFrame:
    """The same with at most per_source rows of a source. What a row may take depends on all taken before, so the
    few candidates (a pool a route) are folded in one group."""
    share = max(1, k // 2) if share is None else max(0, share)
    both = guaranteed.withColumn("guaranteed", F.lit(True)).unionByName(general.withColumn("guaranteed", F.lit(False)))

    def fold(pdf):
        pdf = pdf.sort_values(["guaranteed", "rrf_score", "id"], ascending=[False, False, True], kind="stable")
        seen, used, keep = set(), {}, []
        for i, (ident, source, sure) in enumerate(zip(pdf["id"], pdf["source_id"], pdf["guaranteed"], strict=True)):
            if len(keep) >= (min(share, k) if sure else k) or ident in seen or used.get(source, 0) >= per_source:
                continue
            seen.add(ident)
            used[source] = used.get(source, 0) + 1
            keep.append(i)
        return pdf.iloc[keep]

    return both.groupBy(F.lit(1).alias("all")).applyInPandas(fold, both.schema)


def provenance(hits: DataFrame) -> DataFrame:
    """source_id, n: rows by source."""
    return hits.groupBy("source_id").agg(F.count("*").alias("n"))


def facet_dedup(hits: DataFrame) -> DataFrame:
    """hits (facet_order, id, ...): each id stays under the first facet that returned it."""
    at = Window.partitionBy("id").orderBy("facet_order")
    return hits.withColumn("_at", F.row_number().over(at)).filter("_at = 1").drop("_at")


def sum_subqueries(rankings: list[DataFrame], k: int) -> DataFrame:
    """id, total: scores of up to five sub-queries summed."""
    out = rankings[0].select("id", "score")
    for r in rankings[1:5]:
        out = out.unionAll(r.select("id", "score"))
    return out.groupBy("id").agg(F.round(F.sum("score"), 6).alias("total")).orderBy(F.desc("total"), "id").limit(k)


def term_count_score(docs: DataFrame, terms: list[str]) -> DataFrame:
    """The older score: occurrences, 3 for a term among the first 200 characters, 2 for each distinct term."""
    t = F.lower(T.legacy_unaccent(F.col("text")))
    count = lambda w: (F.length(t) - F.length(F.replace(t, F.lit(w), F.lit("")))) / len(w)
    found = [(count(w) > 0).cast("int") for w in terms]
    head = [F.contains(F.left(t, F.lit(200)), F.lit(w)).cast("int") for w in terms]
    total, distinct, early = (sum(xs[1:], xs[0]) for xs in ([count(w) for w in terms], found, head))
    scored = docs.select("id", (total + 3 * early + 2 * distinct).cast("long").alias("score"), distinct.alias("found"))
    return scored.filter(F.col("found") >= max(1, len(terms) // 2)).select("id", "score")


def degraded(failed: Column, total: Column, rows: Column) -> Column:
    """none, parcial or total: which notice an answer carries."""
    return F.when((failed == total) & (rows == 0), "total").when(failed > 0, "parcial").otherwise("none")


# --- query preparation -------------------------------------------------------------------------

SYNONYMS = {"ation": ["tion", "ing"], "heit": ["keit"], "of the": ["von der"]}
INTENTS = {"definition": [r"\bwhat\b", r"\bis\b"], "comparison": [r"\bvs\b", r"\bor\b"], "treatment": [r"\btreat", r"\bhow\b"]}
STOPWORDS = ("the", "of", "in", "a", "for", "and", "de", "la", "to")


def expand(q: Column, synonyms: dict[str, list[str]] = SYNONYMS) -> Column:
    """The query, the synonyms of its tokens in token order, then those of the phrases it holds in dictionary order."""
    t = F.lower(q)
    single = F.create_map(*(F.lit(x) for k, v in synonyms.items() if " " not in k for x in (k, " ".join(v))))
    toks = F.transform(T.words(t), lambda w: F.regexp_replace(w, r"^[.,;:?!()]+|[.,;:?!()]+$", ""))
    by_token = F.array_join(F.filter(F.transform(toks, lambda w: F.try_element_at(single, w)), lambda s: s.isNotNull()), " ")
    phrases = [F.when(F.contains(t, F.lit(k)), F.lit(" ".join(v))) for k, v in synonyms.items() if " " in k]
    return F.trim(F.concat_ws(" ", q, F.when(by_token != "", by_token), *phrases))


def intent(q: Column, intents: dict[str, list[str]] = INTENTS) -> Column:
    """The intent with most pattern hits, the first declared of several; general without a hit."""
    t = F.lower(q)
    scores = {k: sum((F.regexp_count(t, F.lit(p)) for p in ps[1:]), F.regexp_count(t, F.lit(ps[0]))) for k, ps in intents.items()}
    best = F.greatest(*scores.values())
    out = F.when(best == 0, "general")
    for k, s in scores.items():
        out = out.when(s == best, k)
    return out


def decompose(q: Column) -> Column:
    """Sub-queries: both sides of a comparison apart, or a long query also without its stop words."""
    w = T.words(F.lower(q))
    sides = F.split(F.lower(q), " vs ")
    bare = F.array_join(F.filter(w, lambda x: ~x.isin(*STOPWORDS)), " ")
    return (
        F.when(F.size(w) <= 3, F.array(q))
        .when(F.size(sides) == 2, F.array(q, F.concat(F.trim(sides[0]), F.lit(" features")), F.concat(F.trim(sides[1]), F.lit(" features"))))
        .when(F.size(w) > 6, F.array(q, bare))
        .otherwise(F.array(q))
    )
