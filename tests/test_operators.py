"""Behaviour of single operators on small fixtures."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.operators import catalog, chunking, extraction, graph, retrieval


def one(spark, c, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(c).first()[0]


def test_fold_and_entity_name(spark):
    assert one(spark, T.fold_key(F.col("x")), x="  Ácido-Fólico (B9) ") == "acido folico b9"
    assert one(spark, T.fold_key(F.col("x")), x="") == ""
    assert one(spark, T.entity_name(F.col("x")), x="  Otitis   Média.. ") == "otitis média"


def test_chunks_overlap_and_stay_in_bounds():
    words = [f"w{i}" + ("." if i % 9 == 8 else "") for i in range(2400)]
    got = chunking.cut(words)
    assert got
    texts = [words[c.start : c.end] for c in got]
    assert all(150 <= len(t) <= 380 for t in texts[:-1])
    for a, b in zip(texts, texts[1:], strict=False):
        assert b[:60] == a[-60:]
    assert chunking.cut([]) == []


@pytest.mark.parametrize("bad", [{"overlap": 150}, {"least": 300}, {"target": 400}, {"parent_most": 300}, {"parent_window": 0}])
def test_incoherent_strategies_are_refused(bad):
    with pytest.raises(ValueError):
        chunking.Strategy(**bad)


def test_rrf_sums_ranks_and_breaks_ties_by_id(spark):
    rank = lambda ids: spark.createDataFrame([(i, float(100 - k)) for k, i in enumerate(ids)], "id long, score double")
    a, b = retrieval.top(rank([1, 2, 3]), 3), retrieval.top(rank([3, 1]), 3)
    got = {r["id"]: r["rrf"] if "rrf" in r.asDict() else r["rrf_score"] for r in retrieval.rrf([a, b]).collect()}
    assert got[1] == pytest.approx(1 / 61 + 1 / 62, abs=1e-6)
    assert got[3] == pytest.approx(1 / 63 + 1 / 61, abs=1e-6)
    assert got[2] == pytest.approx(1 / 62, abs=1e-6)


def test_closure_ends_on_a_cycle(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "child string, parent string")
    assert graph.closure(e, 5).count() >= 6


def test_upsert_clears_the_embedding_of_a_changed_text(spark):
    old = spark.createDataFrame([(1, "s", "same", [1.0]), (2, "s", "old", [2.0]), (3, "s", "gone", [3.0])], "id long, source_id string, text string, embedding array<float>")
    new = spark.createDataFrame([(1, "s", "same"), (2, "s", "new")], "id long, source_id string, text string")
    got = {r["id"]: r["embedding"] for r in catalog.upsert(old, new).collect()}
    assert got[1] == [1.0] and got[2] is None
    assert [r["id"] for r in catalog.orphans(old, new).collect()] == [3]


def test_batch_guards_stop_before_any_write(spark):
    empty = spark.createDataFrame([], "id long, source_id string, text string")
    foreign = spark.createDataFrame([(1, "other", "x")], "id long, source_id string, text string")
    for bad in (empty, foreign):
        with pytest.raises(Exception):  # noqa: B017
            catalog.check_batch(bad, "s")


def test_cursor_round_trip_and_bad_cursor():
    assert catalog.offset_of(catalog.cursor_of(40)) == 40
    assert catalog.offset_of(None) == 0
    with pytest.raises(ValueError):
        catalog.offset_of("not a cursor")


def test_entity_rules_in_order(spark):
    tax = extraction.Taxonomy(types={"drug": "Drugs"}, relations={})
    rows = [("a", "drug"), ("aspirin", "plant"), ("Drugs", "drug"), ("absentium", "drug"), ("Aspirins", "drug"), ("x" * 120, "drug")]
    raw = spark.createDataFrame([(1, i, n, t, None, "Aspirin helps against pain.") for i, (n, t) in enumerate(rows)], "chunk_id long, at int, name string, type string, synonyms array<string>, text string")
    got = {r["at"]: r["motive"] for r in extraction.validate_entities(raw, tax).collect()}
    assert got == {0: "nombre_corto", 1: "tipo_entidad", 2: "nombre_de_tipo", 3: "sin_evidencia", 4: None, 5: "nombre_largo"}


def test_vocabularies_that_contradict_themselves_are_refused():
    for bad in ({"types": {}}, {"types": {"a": "X", "b": "X"}}, {"types": {"a": "A"}, "relations": {"R": extraction.Relation("R", ("zz",))}}):
        with pytest.raises(ValueError):
            extraction.Taxonomy(**{"relations": {}, **bad})


def test_failed_batches_are_counted_and_leave_others_alone(spark):
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "id long, text string").coalesce(1)

    def provider(text):
        if text == "text 3":
            raise RuntimeError("refused")
        return [1.0, 2.0]

    out = extraction.embed_missing(rows, provider).collect()
    assert {r["id"] for r in out if r["failed"]} == set(range(10))
    assert all((r["embedding"] is None) == r["failed"] for r in out)
    assert sum(r["calls"] for r in out) == 3 * 4 + 10
