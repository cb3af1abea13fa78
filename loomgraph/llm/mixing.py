"""Mixing sources to target weights: tokens by source, repetition rates, floor(rate) copies of each
document plus one hash-seeded Bernoulli copy with probability equal to the fraction.

Sources by code point, null last, weigh 1, 2, 3, repeating. Targets share all tokens by weight; a
target stops at 3 times its source's tokens and the excess is reshared by weight until none is above,
which is water-filling: target = min(3 * tokens, level * weight). The level comes from prefix sums over
the table of sources (one row each, aggregated with partial sums first, so a hot source is no hot task).

Defined results: null text has size 0; documents of size 0 take nothing; sources of size 0 have target
0; a null doc_id is seeded by its text; repeated rows share their draw; an empty table gives an empty
result; extra columns are kept by `mix_documents`, which adds none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import fresh, materialise, small_side

CAP, SEED, WEIGHTS = 3, "loom-mix", (1, 2, 3)
_SPACES = "\t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in text; null: 0."""
    parts = F.split(F.translate(text, _SPACES, " " * len(_SPACES)), " ")
    return F.coalesce(F.size(F.array_remove(parts, "")), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """A uniform number in [0, 1) that depends on doc_id (or, where null, on the text) and the seed."""
    who = F.when(doc_id.isNotNull(), doc_id.cast("string")).otherwise(F.concat(F.lit("t"), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), who)), 1, 12), 16, 10).cast("long") / float(16**12)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target, rate of each source of sizes (source, size); weights repeat over the sources in order."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.orderBy(F.col("source").asc_nulls_last())
    w = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(every) - 1) % len(weights) + 1))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    upto, whole = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = w.withColumn("total", F.sum("source_size").over(whole))
    # the level at which this source and all that fill up before it are full
    capped = CAP * (F.sum("source_size").over(upto) - F.col("source_size"))
    left = F.sum("weight").over(whole) - F.sum("weight").over(upto) + F.col("weight")
    w = w.withColumn("level", (F.col("total") - capped) / left)
    # the first source that its level doesn't fill sets the level for all
    open_ = F.col("level") * F.col("weight") <= CAP * F.col("source_size")
    w = w.withColumn("level", F.first(F.when(open_, F.col("level")), ignorenulls=True).over(whole))
    target = F.least(F.col("level") * F.col("weight"), (CAP * F.col("source_size")).cast("double"))
    w = w.withColumn("target", F.coalesce(target, F.lit(0.0)))
    return w.select("source", F.col("source_size").cast("long"), "target", F.coalesce(F.try_divide("target", F.col("source_size")), F.lit(0.0)).alias("rate"))


def _copies(rate: Column, doc_id: Column, text: Column) -> Column:
    whole = F.floor(rate)
    return (whole + F.when(draw(doc_id, text, SEED) < rate - whole, 1).otherwise(0)).cast("long")


def _rated(docs: DataFrame, size: str, weights: tuple[int, ...]) -> tuple[DataFrame, str]:
    src, rate = fresh(docs, "mix_source", "mix_rate")
    targets = materialise(source_targets(docs.select("source", F.col(size).alias("size")), weights))
    side = targets.select(F.col("source").alias(src), "source_size", "target", F.col("rate").alias(rate))
    return docs.join(small_side(side), docs["source"].eqNullSafe(F.col(src)), "left").drop(src), rate


def mix_digest(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """doc_id, size, source_size, target, taken (and source, copies) of every row of docs (doc_id, text, source)."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.when(F.col("doc_id").isNull(), F.col("text")).alias("text"))
    rows = materialise(rows)
    out, rate = _rated(rows, "size", weights)
    copies = _copies(F.col(rate), F.col("doc_id"), F.col("text"))
    return out.withColumn("copies", copies).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Every row of docs as often as the mix takes it; the columns of docs."""
    size, n, i = fresh(docs, "mix_size", "mix_copies", "mix_i")
    targets = materialise(source_targets(docs.select("source", word_count(F.col("text")).alias("size")), weights))
    src, rate = fresh(docs, "mix_source", "mix_rate")
    side = targets.select(F.col("source").alias(src), F.col("rate").alias(rate))
    out = docs.join(small_side(side), docs["source"].eqNullSafe(F.col(src)), "left")
    out = out.withColumn(n, _copies(F.col(rate), F.col("doc_id"), F.col("text"))).filter(F.col(n) > 0)
    return out.withColumn(i, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))).select(*docs.columns)
