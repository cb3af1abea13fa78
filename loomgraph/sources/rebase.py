"""Domain tables over the test tables: chunks, sources, embeddings, a property graph, an ontology, pathways."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document is one chunk of its source: id, source_id, chunk_index, page, chapter, section, text."""
    order = Window.partitionBy("source").orderBy("doc_id")
    d = read(spark, sf_dir, "documents")
    at = F.row_number().over(order)
    return d.select(
        F.col("doc_id").alias("id"), F.col("source").alias("source_id"), (at - 1).alias("chunk_index"), at.alias("page"),
        F.col("lang").alias("chapter"), F.concat(F.col("source"), F.lit(" "), F.col("lang")).alias("section"), "text",
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered sources: those whose number isn't a multiple of 5 (the rest is unregistered)."""
    d = read(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    num = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    return d.filter(num % 5 != 0).select(
        F.col("source").alias("id"), F.concat(F.lit("Title of "), F.col("source")).alias("title"),
        F.when(num % 2 == 0, "bibliografia").alias("source_kind"), F.array(F.concat(F.lit("shelf"), (num % 3).cast("string"))).alias("collections"),
    )


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """label, name of every node of the graph."""
    pick = lambda t, label, col: read(spark, sf_dir, t).select(F.lit(label).alias("label"), F.col(col).cast("string").alias("name"))
    return pick("supplier", "Supplier", "s_name").union(pick("customer", "Customer", "c_name")).union(pick("nation", "Nation", "n_name")).union(pick("region", "Region", "r_name")).union(read(spark, sf_dir, "part").select(F.lit("Part"), F.concat(F.lit("part "), F.col("p_partkey").cast("string"))))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """src_label, src, type, dst_label, dst: suppliers SUPPLIES parts, and IN_NATION, IN_REGION."""
    part = lambda c: F.concat(F.lit("part "), F.col(c).cast("string"))
    li = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct()
    s, c, n, r = (read(spark, sf_dir, t) for t in ("supplier", "customer", "nation", "region"))
    row = lambda df, a, x, t, b, y: df.select(F.lit(a).alias("src_label"), x.alias("src"), F.lit(t).alias("type"), F.lit(b).alias("dst_label"), y.alias("dst"))
    return (
        row(li.join(s, F.col("l_suppkey") == F.col("s_suppkey")), "Supplier", F.col("s_name"), "SUPPLIES", "Part", part("l_partkey"))
        .union(row(s.join(n, F.col("s_nationkey") == F.col("n_nationkey")), "Supplier", F.col("s_name"), "IN_NATION", "Nation", F.col("n_name")))
        .union(row(c.join(n, F.col("c_nationkey") == F.col("n_nationkey")), "Customer", F.col("c_name"), "IN_NATION", "Nation", F.col("n_name")))
        .union(row(n.join(r, F.col("n_regionkey") == F.col("r_regionkey")), "Nation", F.col("n_name"), "IN_REGION", "Region", F.col("r_name")))
    )


#: The same tables in SQL, for the oracles.
SQL_CHUNKS = """chunks AS (
  SELECT doc_id AS id, source AS source_id, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1)::INTEGER AS chunk_index,
    (row_number() OVER (PARTITION BY source ORDER BY doc_id))::INTEGER AS page, lang AS chapter, source || ' ' || lang AS section, text FROM documents)"""
SQL_SOURCES = """sources AS (
  SELECT source AS id, 'Title of ' || source AS title, CASE WHEN num % 2 = 0 THEN 'bibliografia' END AS source_kind, ['shelf' || (num % 3)] AS collections
  FROM (SELECT DISTINCT source, regexp_extract(source, '(\\d+)$', 1)::INTEGER AS num FROM documents) WHERE num % 5 <> 0)"""
SQL_EDGES = """edges AS (
  SELECT 'Supplier' AS src_label, s_name AS src, 'SUPPLIES' AS type, 'Part' AS dst_label, 'part ' || l_partkey AS dst
  FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN supplier ON l_suppkey = s_suppkey
  UNION ALL SELECT 'Supplier', s_name, 'IN_NATION', 'Nation', n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT 'Customer', c_name, 'IN_NATION', 'Nation', n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 'Nation', n_name, 'IN_REGION', 'Region', r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"""
SQL_NODES = """nodes AS (
  SELECT 'Supplier' AS label, s_name AS name FROM supplier UNION ALL SELECT 'Customer', c_name FROM customer UNION ALL SELECT 'Nation', n_name FROM nation
  UNION ALL SELECT 'Region', r_name FROM region UNION ALL SELECT 'Part', 'part ' || p_partkey FROM part)"""

__all__ = ["SQL_CHUNKS", "SQL_EDGES", "SQL_NODES", "SQL_SOURCES", "chunks", "edges", "nodes", "read", "sources", "vectors"]
