"""Chat formatting with cumulative-snapshot collapse.

A logger that writes a conversation after every turn leaves many that prefix a longer one. Turn i of a
conversation has a hash of (i, role, text); the running XOR of these over the turns is the hash of
that prefix. A conversation whose whole hash is the prefix hash of a longer one is dropped by an
anti-join; of equal conversations the one with the smallest conv_id stays. What remains is rendered.

Positions and running hashes are found within blocks of 1,024 turn numbers first and carried over the
blocks' sums, so that a conversation of any length is no single task's work, but for its rendering:
each block of turns is one segment of text, so no value holds an unbounded conversation.

Defined results: turns go by `turn` (null first), then role and text; repeated rows are turns of their
own; a null role is rendered as `unknown`, a null text as empty; rows without conv_id are dropped; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import materialise

BLOCK = 1024


def _positions(turns: DataFrame) -> DataFrame:
    """turns with block, at (0-based position in the conversation)."""
    t = turns.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**62))).cast("long"))
    order = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    t = t.withColumn("rank", F.row_number().over(order))
    before = Window.partitionBy("conv_id").orderBy("block")
    sums = t.groupBy("conv_id", "block").agg(F.count("*").alias("n")).withColumn("start", F.sum("n").over(before) - F.col("n")).select("conv_id", "block", "start")
    return t.join(sums, ["conv_id", "block"]).withColumn("at", F.col("start") + F.col("rank") - 1).drop("rank", "start")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, n, x, y: length and two running hashes of each prefix of each conversation."""
    # a hash passes over nulls, so which of the two is null goes in as well
    none = F.concat(F.isnull("role").cast("string"), F.isnull("text").cast("string"))
    one, two = F.xxhash64(F.lit(1), "at", none, "role", "text"), F.xxhash64(F.lit(2), "at", none, "text", "role")
    t = turns.select("conv_id", "block", "at", one.alias("h1"), two.alias("h2"))
    inside = Window.partitionBy("conv_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("r1", F.bit_xor("h1").over(inside)).withColumn("r2", F.bit_xor("h2").over(inside))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = t.groupBy("conv_id", "block").agg(F.bit_xor("h1").alias("s1"), F.bit_xor("h2").alias("s2"))
    sums = sums.select("conv_id", "block", F.coalesce(F.bit_xor("s1").over(earlier), F.lit(0)).alias("c1"), F.coalesce(F.bit_xor("s2").over(earlier), F.lit(0)).alias("c2"))
    t = t.join(sums, ["conv_id", "block"])
    return t.select("conv_id", (F.col("at") + 1).alias("n"), F.col("r1").bitwiseXOR(F.col("c1")).alias("x"), F.col("r2").bitwiseXOR(F.col("c2")).alias("y"))


def maximal(prefixes: DataFrame) -> DataFrame:
    """conv_id, n of the conversations that prefix no other; of equal ones, the smallest conv_id."""
    longest = prefixes.groupBy("conv_id").agg(F.max("n").alias("last"))
    p = prefixes.join(longest, "conv_id")
    whole = p.filter("n = last").groupBy("n", "x", "y").agg(F.min("conv_id").alias("conv_id"))
    proper = p.filter("n < last").select("n", "x", "y").distinct()
    return whole.join(proper, ["n", "x", "y"], "left_anti").select("conv_id", "n")


def chat_documents(conversations: DataFrame) -> DataFrame:
    """conv_id, segment, n_turns, text: the maximal conversations, rendered; a segment for each block of turns."""
    turns = conversations.filter("conv_id is not null").select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    turns = materialise(_positions(turns))
    kept = maximal(materialise(prefix_hashes(turns)))
    said = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("<|end|>\n"))
    lines = turns.join(kept.select("conv_id", F.col("n").alias("n_turns")), "conv_id").select("conv_id", "n_turns", F.floor(F.col("at") / BLOCK).cast("int").alias("segment"), F.struct("at", said.alias("said")).alias("line"))
    return lines.groupBy("conv_id", "n_turns", "segment").agg(F.array_sort(F.collect_list("line")).alias("lines")).select("conv_id", "segment", "n_turns", F.array_join(F.transform("lines", lambda x: x["said"]), "").alias("text"))
