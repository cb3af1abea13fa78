"""The pipeline's stages, one after the other, each beside a brute-force version or the SQL of its operator."""

from __future__ import annotations

from collections import Counter

import duckdb

import corpus_pipeline
from loomgraph.llm import queries
from tests.llm.test_free import brute


def planted(spark, sf):
    """The documents, copies and near copies of some, leaks of benchmark items, and texts in no language."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    top = max(r["doc_id"] for r in rows) + 1
    long = [r for r in rows if len((r["text"] or "").split()) > 60][:12]
    more = [{**r, "source": "copies"} for r in long] + [{**r, "text": r["text"] + " and so on"} for r in long[:6]]
    more += [{**rows[0], "text": t} for t in (None, "", "12 34 !")]
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() if len((r["text"] or "").split()) > 15][:5]
    more += [{**rows[k], "text": f"Before it stands number {k} of the leaks. {t} And after it too."} for k, t in enumerate(items)]
    return spark.createDataFrame(rows + [{**r, "doc_id": top + k} for k, r in enumerate(more)], docs.schema)


def sql_of(name, docs, sf):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{sf}/benchmark.parquet'")
    return con.execute(queries.oracle_sql()[name]).df()


def test_each_stage_equals_its_brute_force(spark, sf):
    stages, docs, counts = dict(corpus_pipeline.STAGES), planted(spark, sf), []
    assert list(stages) == ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]

    def step(name):
        out = stages[name](spark, docs, sf).cache()
        if name != "sharding":
            assert sorted(out.columns) == sorted(docs.columns)
        counts.append((docs.count(), out.count()))
        return out, Counter(r["doc_id"] for r in out.select("doc_id").collect())

    rows = docs.select("doc_id", "text").collect()
    docs, ids = step("language_id")
    assert ids == Counter(r["doc_id"] for r in rows if any(map(str.isalpha, r["text"] or "")))
    rows = docs.select("doc_id", "text").collect()
    docs, ids = step("near_dedup")
    assert set(ids) == {c for _, c in brute(rows, 5, 80).values()}
    gone = set(sql_of("op1_template_decontamination", docs, sf)["doc_id"])
    rows = docs.select("doc_id").collect()
    docs, ids = step("decontamination")
    assert len(gone) >= 5 and ids == Counter(r["doc_id"] for r in rows if r["doc_id"] not in gone)
    mix = sql_of("op6_source_mixing", docs, sf)
    docs, ids = step("mixing")
    assert ids == Counter({i: n for i, n in zip(mix["doc_id"], mix["copies"], strict=True) if n})
    kept, (docs, last) = ids, step("sharding")
    at = sorted((r["shard"], r["slot"]) for r in docs.collect())
    assert last == kept and at == sorted((k % 8, k // 8) for k in range(len(at)))
    assert all(a > b for a, b in counts[:3]) and counts[4][0] == counts[4][1]


def test_nulls_repeats_and_clashing_names_run_through(spark, sf):
    rows = [(None, None, None, None, 1), (None, "a word", None, None, 1), (1, "one two three four five six", "en", "s", 1), (1, "one two three four five six", "en", "s", 1), (1, "other words", "en", None, 1), (2, "one two three four five six", "de", "t", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, slot int")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    got = docs.collect()
    assert got and docs.columns == ["doc_id", "text", "lang", "source", "slot", "shard", "_slot"]
    assert all(r["doc_id"] in (None, 1) and r["text"] is not None for r in got)


def test_an_empty_table_runs_through(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0
