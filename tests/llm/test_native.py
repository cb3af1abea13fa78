"""Native operators against brute force on small tables with nulls, empties, repeats and clashing columns."""

from __future__ import annotations

import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from loomgraph.llm import chat, decontaminate, mixing, sharding

DOCS = "doc_id long, text string, source string, number int, shard string"
ROWS = [(i, f"word{i} and more " * (i % 5), f"s{i % 3}" if i % 7 else None, 1, "x") for i in range(60)]
ROWS += [(100, None, "s0", 1, "x"), (101, "", "s1", 1, "x"), (102, "é ß\t漢", "zero", None, None), (5, ROWS[5][1], ROWS[5][2], 1, "x"), (None, "no id", None, 1, "x"), (103, "long " * 50_000, "s1", 1, "x")]


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOCS)


def test_shards_are_even_and_gapless(spark):
    out = sharding.shard_digest(docs(spark)).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in ROWS)
    by = Counter(r["shard"] for r in out)
    assert set(by) == set(range(8)) and max(by.values()) - min(by.values()) <= 1
    for s, n in by.items():
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(n))
    again = sharding.shard_digest(docs(spark).repartition(7)).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))


def test_permutation_is_one_to_one_and_inverts(spark):
    for n in (1, 2, 17, 1000):
        x = sharding.permuted(spark.range(n), "p", F.col("id"), n)
        rows = sharding.unpermuted(x, "q", F.col("p"), n).collect()
        assert sorted(r["p"] for r in rows) == list(range(n)) and all(r["q"] == r["id"] for r in rows)


def test_sharded_documents_keep_their_columns(spark):
    out = sharding.shard_documents(docs(spark))
    assert out.columns[:5] == docs(spark).columns and out.count() == len(ROWS)
    assert sharding.shard_documents(docs(spark, [])).count() == 0 and sharding.shard_digest(docs(spark, [])).count() == 0


def test_mix_meets_its_targets(spark):
    out = mixing.mix_digest(docs(spark)).collect()
    assert len(out) == len(ROWS)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    per = Counter()
    for r in ROWS:
        per[r[2]] += size(r[1])
    order = sorted((s for s in per if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, left, free = {}, sum(per.values()), set(order)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 3 * per[s]}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        for s in full:
            target[s] = 3 * per[s]
            left -= 3 * per[s]
        free -= full
    for r in out:
        assert r["source_size"] == per[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6 * max(1, target[r["source"]])
        assert r["taken"] == r["size"] * r["copies"] <= 3 * r["size"]
    assert mixing.mix_documents(docs(spark, [])).count() == 0
    assert mixing.mix_documents(docs(spark)).columns == docs(spark).columns


ITEM = "If Maria buys 12 apples and 7 pears for 30 dollars then how many fruits does Maria carry home after she gives 5 apples away"


def test_reparameterised_questions_are_caught_and_jumbled_ones_are_not(spark):
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "what is it")], "item_id long, text string")
    swap = ITEM.replace("Maria", "Peter").replace("12", "99").replace("7 pears", "41 pears").replace("30", "55").replace("5 apples", "3 apples")
    jumbled = ITEM.replace("does Maria", "does Peter")
    rows = [(1, "some words before. " + swap + " and words after", "a", 1, "x"), (2, ITEM, "a", 1, "x"), (3, "nothing of this kind is in here at all", "a", 1, "x"), (4, None, "a", 1, "x"), (5, "", "a", 1, "x"), (6, jumbled, "a", 1, "x"), (2, ITEM, "a", 1, "x")]
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs(spark, rows), items).collect()}
    assert {(1, 1), (2, 1)} <= found and not {d for d, _ in found} & {3, 4, 5, 6}
    kept = decontaminate.drop_leaks(docs(spark, rows), items)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({3, 4, 5, 6} | set()) and kept.columns == docs(spark).columns
    assert decontaminate.leaks(docs(spark, []), items).count() == 0 and decontaminate.leaks(docs(spark, rows), items.limit(0)).count() == 0


def test_snapshots_collapse_to_the_longest(spark):
    conv = {1: "ab", 2: "abc", 3: "abc", 4: "x", 5: "abd", 6: "a"}
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", w, "extra") for c, ws in conv.items() for t, w in enumerate(ws)]
    rows += [(7, 0, None, None, "e"), (None, 0, "user", "lost", "e")]
    out = chat.chat_documents(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n string")).collect()
    assert sorted(r["conv_id"] for r in out) == [2, 4, 5, 7]
    assert next(r["text"] for r in out if r["conv_id"] == 2) == "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n<|user|>\nc<|end|>\n"
    assert next(r["text"] for r in out if r["conv_id"] == 7) == "<|unknown|>\n<|end|>\n"
    assert chat.chat_documents(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_a_conversation_over_several_blocks(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(2500)] + [(2, t, "user", f"t{t}") for t in range(1500)]
    out = chat.chat_documents(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("segment").collect()
    assert [(r["conv_id"], r["segment"], r["n_turns"]) for r in out] == [(1, 0, 2500), (1, 1, 2500), (1, 2, 2500)]
    assert "".join(r["text"] for r in out) == "".join(f"<|user|>\nt{t}<|end|>\n" for t in range(2500))


def test_runs_of_any_length_are_canonicalised(spark):
    """Sixty thousand capitalised words and a number of sixty thousand parts: no recursion by length."""
    long = "see " + "Maria " * 60_000 + "and " + "1" + ".1" * 60_000 + " apples"
    got = spark.createDataFrame([(1, long)], "doc_id long, text string").select(decontaminate.canonical(F.col("text")).alias("t")).first()["t"]
    assert got == ["see", "zqname", "and", "zqnum", "apples"]


def test_a_null_role_is_no_null_text(spark):
    rows = [(1, 0, None, "x"), (2, 0, "x", None), (2, 1, "a", "b"), (3, 0, None, "x"), (3, 1, "a", "c"), (4, 0, "u", None), (5, 0, "u", ""), (5, 1, "a", "d")]
    got = chat.chat_documents(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    assert sorted(r["conv_id"] for r in got.collect()) == [2, 3, 4, 5]
