"""Streams give what the batch gives."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from loomgraph.streaming import streams

SCHEMA = "id long, source_id string, text string, load int, closes boolean"


def loader(spark, tmp_path):
    src, table = str(tmp_path / "in"), str(tmp_path / "table")

    def load(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        q = streams.upsert_stream(spark.readStream.schema(SCHEMA).parquet(src), table, str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return {r["id"]: r["text"] for r in streams.current(spark, table).collect()}

    return load, table


def test_a_source_in_two_batches_keeps_both_parts_until_its_load_ends(spark, tmp_path):
    load, table = loader(spark, tmp_path)
    assert load([(1, "a", "one", 1, False)]) == {1: "one"}
    assert load([(2, "a", "two", 1, True), (9, "b", "nine", 1, False)]) == {1: "one", 2: "two", 9: "nine"}
    assert load([(1, "a", "new", 2, False)]) == {1: "new", 2: "two", 9: "nine"}
    assert load([(3, "a", "three", 2, True)]) == {1: "new", 3: "three", 9: "nine"}
    # only the newest files of a part and those of the manifest before it are kept
    assert len([n for n in os.listdir(table) if n.endswith(".manifest")]) == 2
    assert all(len(os.listdir(f"{table}/{p}")) <= 2 for p in os.listdir(table) if p.startswith("part="))


def test_vectors_are_asked_for_once(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")

    def load(rows):
        spark.createDataFrame(rows, "id long, text string").coalesce(1).write.mode("append").parquet(src)
        q = streams.embed_stream(spark.readStream.schema("id long, text string").parquet(src), lambda t: [float(len(t))], out, str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return sorted((r["id"], r["embedding"][0]) for r in streams.written(spark, out).collect())

    assert load([(1, "a"), (2, "bb")]) == [(1, 1.0), (2, 2.0)]
    assert load([(2, "bb"), (3, "ccc")]) == [(1, 1.0), (2, 2.0), (3, 3.0)]


def test_extraction_tries_errors_again_and_starts_anew_with_another_profile(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")

    def extractor(fails):
        def run(text):
            if text in fails:
                raise ValueError("refused")
            return text.upper()

        return run

    def load(rows, profile, fails=()):
        spark.createDataFrame(rows, "chunk_id long, text string").coalesce(1).write.mode("append").parquet(src)
        q = streams.extract_stream(spark.readStream.schema("chunk_id long, text string").parquet(src), extractor(fails), out, str(tmp_path / "cp"), profile).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return sorted((r["chunk_id"], r["record"] or r["error"]) for r in streams.written(spark, f"{out}/profile={profile}").collect())

    assert load([(1, "a"), (2, "b")], "v1", {"b"}) == [(1, "A"), (2, "refused")]
    assert load([(1, "a"), (2, "b")], "v1") == [(1, "A"), (2, "B"), (2, "refused")]
    assert load([(3, "c")], "v2") == [(1, "A"), (2, "B"), (3, "C")]


def test_windows_as_stream_and_as_batch(spark, sf, tmp_path):
    e = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    e.coalesce(2).write.parquet(str(tmp_path / "events"))
    s = spark.readStream.schema(e.schema).parquet(str(tmp_path / "events"))
    q = streams.tumbling(s).writeStream.outputMode("complete").format("memory").queryName("win").start()
    q.processAllAvailable()
    q.stop()
    want = sorted(map(tuple, streams.tumbling(e).select("start", "event_type", "n").collect()))
    assert sorted(map(tuple, spark.table("win").select("start", "event_type", "n").collect())) == want
