"""Queries that do the whole job: every row and the whole text, beside brute force."""

from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from loomgraph.plans import q_extract, q_graph, q_retrieval, q_text


def test_dags_hold_every_user(spark, sf, tmp_path):
    """The smallest tables have 15 users; every other one gets a larger number here."""
    e = spark.read.parquet(f"{sf}/events.parquet")
    e.withColumn("user_id", F.when(F.col("user_id") % 2 == 0, F.col("user_id") + 1000).otherwise(F.col("user_id"))).write.parquet(f"{tmp_path}/events.parquet")
    sf = str(tmp_path)
    events = spark.read.parquet(f"{sf}/events.parquet").select("user_id", "ts", "event_id", "event_type").collect()
    by_user = defaultdict(list)
    for r in sorted(events, key=lambda r: (r["ts"], r["event_id"])):
        by_user[r["user_id"]].append((r["ts"].date(), f"{r['event_type']} {r['event_id']}"))
    want = Counter()
    for user, steps in by_user.items():
        want.update((user, a[1], b[1], "linear") for a, b in zip(steps, steps[1:], strict=False) if a[0] != b[0])
        days = defaultdict(list)
        for day, node in steps:
            days[day].append(node)
        groups = [days[k] for k in sorted(days)]
        want.update((user, a[-1], node, "branch") for a, b in zip(groups, groups[1:], strict=False) if len(b) > 1 for node in b)
    got = Counter((r["dag"], r["src"], r["dst"], r["kind"]) for r in q_graph.dag_edges(spark, sf).collect())
    assert got == want and max(u for u, *_ in want) >= 1000
    assert {(r["dag"], r["kind"]): r["n"] for r in q_graph.dag_list(spark, sf).collect()} == Counter((u, k) for u, _, _, k in want.elements())
    clicks = defaultdict(set)
    for user, src, dst, _ in want:
        if "click" in src.lower():
            clicks[user].add((src, dst))
    assert {r["dag"]: (r["steps"], r["first_src"]) for r in q_graph.dag_paths(spark, sf).collect()} == {u: (len(x), min(x)[0]) for u, x in clicks.items()}


def _documents(spark, tmp_path, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_terms_and_names_of_whole_texts(spark, tmp_path):
    d = _documents(spark, tmp_path, ["Wört  " * 100 + "+Último", "short (one)"])
    assert {r["doc_id"]: r["terms"] for r in q_text.fn_query_terms(spark, d).collect()} == {0: "wort " * 100 + "ultimo", 1: "short one"}
    names = {r["doc_id"]: (r["name"], r["plain"]) for r in q_text.fn_entity_name(spark, d).collect()}
    assert names == {0: ("wört " * 100 + "+último", "wort " * 100 + "+ultimo"), 1: ("short (one)", "short (one)")}


def test_queries_are_whole_texts(spark, tmp_path):
    d = _documents(spark, tmp_path, [f"Filler {'word ' * 20}heit of the end"] * 3)
    text = f"filler {'word ' * 20}heit of the end"
    asked = {0: f"{text} vs ation", 1: f"what is {text} of the ation?", 2: f"how heit {text}"}
    synonyms = {0: " keit tion ing von der", 1: " keit tion ing von der", 2: " keit keit von der"}
    assert {r["doc_id"]: r["expanded"] for r in q_retrieval.query_expand(spark, d).collect()} == {k: q + synonyms[k] for k, q in asked.items()}
    assert {r["doc_id"]: r["q"] for r in q_retrieval._asked(spark, d).collect()} == asked
    parts = {r["doc_id"]: r["parts"] for r in q_retrieval.query_decompose(spark, d).collect()}
    assert parts[0] == f"{asked[0]} | {text} features | ation features" and all(parts[k].startswith(f"{asked[k]} | ") for k in (1, 2))
    assert q_retrieval.intent_classify(spark, d).count() == 3


def _chunks_of(rows):
    return {(r["src"], r["dst"]): [int(p.split("/")[0]) for p in r["provenance"].split(",")] if r["provenance"] is not None else None for r in rows}


def test_provenance_of_every_chunk(spark, sf):
    docs = sorted((r["doc_id"], r["lang"], r["source"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "source").collect())
    new, old, sources = defaultdict(list), defaultdict(list), defaultdict(set)
    for k, lang, source in docs:
        new[lang, f"d{k % 13}"].append(k)
        old[lang, f"d{k % 17}"].append(k)
        sources[lang, f"d{k % 13}"].add(source)
    bare = {("fr", "d1"), ("fr", "d2")}
    (census,) = q_extract.inherited_census(spark, sf).collect()
    assert tuple(census) == (len(new), sum(s in ("en", "de") for s, _ in new), len(bare & set(new)))
    closed = {(r["src"], r["dst"]) for r in q_extract.closed_inherited(spark, sf).collect()}
    assert closed == {e for e in new if e[0] in ("en", "de") and "src11" not in sources[e]}
    left = {e: [k for k in ks if k % 3 == 1] for e, ks in new.items() if e not in bare}
    assert _chunks_of(q_extract.fragment_purge(spark, sf).collect()) == {e: ks for e, ks in left.items() if ks} | {e: None for e in bare & set(new)}
    merged = q_extract.provenance_merge(spark, sf).collect()
    was = {e: None if e in bare else ks for e, ks in old.items()}
    assert _chunks_of(merged) == {e: [k for k in was.get(e) or [] if k not in new[e]] + new[e] if e in new else was[e] for e in {*new, *was}}
    assert {(r["src"], r["dst"]): r["inherited"] for r in merged} == {e: e not in new and e[0] in ("en", "de") for e in {*new, *was}}


def test_evidence_of_whole_items(spark, tmp_path):
    d = _documents(spark, tmp_path, ["x " * 9 + "g h i Jé, k l y", "a b c d e f", "z one, two z", "one twofold", "b c d e f", ""])
    spark.createDataFrame([(1, "a b c d e f g h i je k l"), (2, "One two"), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert sorted(tuple(r) for r in q_extract.evidence_spans(spark, d).collect()) == [(0, 1), (1, 1), (2, 2)]
