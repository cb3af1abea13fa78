"""Edge cases of the operators: very long texts, repeats, nulls, clashing columns, empty tables."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from loomgraph.llm import common, decontaminate, html_text, langid, secrets, sharding

DOCS = "doc_id long, text string, lang string, source string, score string"
SCRIPTS = {"am": 0x1208, "th": 0xE01, "ka": 0x10D0, "el": 0x3B1, "hy": 0x561, "xx": 0x61, "yy": 0x61, "zz": 0x61}


def invented(lang: str, n: int, rng) -> str:
    """Words of a made-up language: letters of its script, in an order of its own."""
    own = random.Random(lang)
    letters = [chr(SCRIPTS[lang] + k) for k in own.sample(range(20), 12)]
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(n))


def test_every_language_is_learned_and_many_machines_are_fitted_by_tasks(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, invented(lang, 40, rng), lang, "s", "clash") for i, lang in enumerate(list(SCRIPTS) * 25)]
    rows += [(5000, invented("th", 30_000, rng), None, "s", "x"), (5001, None, None, None, "x"), rows[3], rows[3]]
    monkeypatch.setattr(langid, "HERE", 3)
    docs = spark.createDataFrame(rows, DOCS)
    out = langid.identify(docs).collect()
    truth = {r[0]: r[2] for r in rows}
    told = [(r["lang_pred"], truth[r["doc_id"]]) for r in out if r["held_out"] and truth[r["doc_id"]]]
    assert len(out) == len(rows) and len(told) > 20 and sum(a == b for a, b in told) >= 0.95 * len(told)
    assert {r["lang_pred"] for r in out if r["doc_id"] == 5000} == {"th"}
    assert len({(r["lang_pred"], r["score"]) for r in out if r["doc_id"] == rows[3][0]}) == 1
    monkeypatch.setattr(langid, "HERE", 10_000)
    assert Counter(map(repr, langid.identify(docs).collect())) == Counter(map(repr, out))
    with pytest.raises(ValueError, match="machines"):
        langid.LanguageModel([], list(SCRIPTS), None, None, machines=5)


def test_pages_very_long_repeated_and_empty(spark):
    schema = "page_id long, url string, html string, text string"
    long = "<article>" + "<p>A sentence of the text, and more of it.</p>" * 30_000 + "</article>"
    out = html_text.extract(spark.createDataFrame([(1, "u", long, "clash"), (2, "u", "<p>One text of a page, and no more.</p>", "x"), (2, "u", "<p>One text of a page, and no more.</p>", "x")], schema)).collect()
    assert len(out) == 3 and [r["n_chars"] for r in out if r["page_id"] == 1] == [30_000 * 40 - 1]
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0


def test_secrets_very_long_and_clashing(spark):
    rows = [(1, "a plain line. " * 50_000 + "password: hunter22", "x"), (2, "1" * 300_000 + "Ab", "x"), (None, "=" * 200_000, "x")]
    out = {r["doc_id"]: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()}
    assert out[1]["n_assign"] == 1 and out[1]["spans"] == "assign:700000:700018" and out[None]["spans"] == ""


def test_leaks_of_very_long_and_repeated_texts(spark):
    item = "when the river rises over the bridge at the mill the bells of the town ring for an hour"
    filler = "nothing here is like it, we say 12 times to Anna Berg. " * 20_000
    docs = spark.createDataFrame([(1, filler + item + filler, "c"), (2, filler, "c"), (2, filler, "c"), (None, item, "c"), (None, None, "c")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(7, item, "c"), (7, item, "c"), (8, item.upper(), "c"), (9, "an hour", "c")], "item_id long, text string, doc_id string")
    got = sorted(((r["doc_id"] or 0, r["item_id"]) for r in decontaminate.leaks(docs, items).collect()))
    assert got == [(0, 7), (0, 8), (1, 7), (1, 8)]
    assert sorted(r["doc_id"] or 0 for r in decontaminate.drop_leaks(docs, items).collect()) == [0, 2, 2]


def test_rows_that_share_an_id_spread_over_buckets(spark):
    docs = spark.createDataFrame([(1, f"text {i}", "en", "s", "x") for i in range(200)], DOCS)
    out = sharding.shard_documents(docs, 4)
    slots = sorted((r["shard"], r["slot"]) for r in out.collect())
    assert slots == [(s, k) for s in range(4) for k in range(50)]


def test_scratch_tables_can_be_deleted(spark):
    df = common.materialise(spark.range(5))
    path = common._written[id(df)][1]
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = there.getFileSystem(spark._jsc.hadoopConfiguration())
    assert fs.exists(there)
    common.forget(df)
    assert not fs.exists(there)
