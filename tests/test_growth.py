"""What grows with the input: work in proportion to it, no task with the whole of a file, source or table."""

import time

from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.operators import chunking as C
from loomgraph.operators import extraction as X
from loomgraph.operators import layout as L
from loomgraph.operators import retrieval as R
from loomgraph.sources import files


def test_page_of_many_lines_is_cleaned_in_proportion(spark):
    body = "\n".join(f"line number {i} of it" for i in range(3000))
    df = spark.createDataFrame([(f"12\n{body}\n\n345",)], "text string").repartition(1)
    at = time.time()
    one, two = df.select(T.strip_folio(F.col("text")), T.clean_page(F.col("text"))).first()
    assert time.time() - at < 15
    assert one == f"\n{body}\n\n" and two == body


def test_pages_of_a_split_file_keep_their_numbers(spark, tmp_path):
    texts = {n: [f"{n} page {i} " + "x" * (i % 50 + 20) for i in range(1, 120)] for n in "abc"}
    rows = [(n, i, None if i == 7 else t) for n, ts in texts.items() for i, t in enumerate(ts, 1)]
    rows.reverse()
    pages = spark.createDataFrame(rows, "name string, at int, value string").repartition(5)
    files.write_text_pages(pages, str(tmp_path / "books"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in old:
            spark.conf.set(k, "1000")
        df = files.read_text_pages(spark, f"{tmp_path}/books/*.txt")
        assert df.rdd.getNumPartitions() > 10
        got = {(r["source_id"], r["page"]): r["text"] for r in df.collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {(n, i): t for n, ts in texts.items() for i, t in enumerate(ts, 1) if i != 7}


def test_many_books_share_a_batch_and_one_book_may_span_several(spark):
    small = spark.range(20000).select(F.col("id").alias("source_id"), F.lit(1).alias("page"), F.lit(0).alias("seq"), F.lit("one line, no more.").alias("text"), F.lit("c").alias("chapter"), F.lit("s").alias("section"))
    lines = spark.range(30000).select(F.lit(-1).cast("long").alias("source_id"), (F.col("id") + 1).cast("int").alias("page"), F.lit(0).alias("seq"), F.concat(F.lit("w"), F.col("id")).alias("text"), F.when(F.col("id") == 0, "first").alias("chapter"), F.lit(None).cast("string").alias("section"))
    C.chunk_books(small.limit(1)).collect()
    at = time.time()
    got = C.chunk_books(small.unionAll(lines.orderBy(F.desc("page")))).collect()
    assert time.time() - at < 25
    assert {(r["source_id"], r["text"], r["chapter"]) for r in got if r["source_id"] >= 0} == {(i, "one line, no more.", "c") for i in range(20000)}
    long = sorted((r for r in got if r["source_id"] < 0), key=lambda r: r["chunk_index"])
    want = C.cut([f"w{i}" for i in range(30000)])
    assert [(r["start"], r["end"], r["page_start"], r["page_end"], r["chapter"], r["section"]) for r in long] == [(c.start, c.last(), c.start + 1, c.last(), "first" if c.start == 0 else None, None) for c in want]


def test_term_counts_count_within_a_document(spark):
    df = spark.createDataFrame([(["b", "a", "b", "ñ", "b"],), ([],), (["x"],)], "t array<string>")
    got = [[(x["term"], x["tf"]) for x in r[0]] for r in df.select(R.term_counts(F.col("t"))).collect()]
    assert got == [[("a", 1), ("b", 3), ("ñ", 1)], [], [("x", 1)]]


def test_old_entries_of_a_long_provenance_give_way_in_proportion(spark):
    n = 20000
    entry = lambda e: F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.struct((i * e).cast("long").alias("chunk"), F.lit("s").alias("source"), F.lit(str(e)).alias("evidence")))
    side = lambda e: spark.range(1).select(F.lit("a").alias("src"), F.lit("R").alias("relation"), F.lit("b").alias("dst"), entry(e).alias("provenance"))
    at = time.time()
    got = X.merge_provenance(side(1).withColumn("inherited", F.lit(True)), side(2)).first()
    assert time.time() - at < 20 and not got["inherited"]
    chunks = [p["chunk"] for p in got["provenance"]]
    assert chunks == [i for i in range(1, n + 1) if i % 2] + [2 * i for i in range(1, n + 1)]


def test_table_of_many_rows_is_rendered_in_proportion(spark):
    rows = F.concat(F.array(F.array(F.lit("name"), F.lit("value"))), F.transform(F.sequence(F.lit(1), F.lit(1500)), lambda i: F.array(F.concat(F.lit("r"), i), F.concat(F.lit("v"), i))))
    at = time.time()
    text = spark.range(1).select(L.render_table(rows)).first()[0]
    assert time.time() - at < 15
    assert text.split("\n") == [f"r{i} (NAME); v{i} (VALUE)." for i in range(1, 1501)]
