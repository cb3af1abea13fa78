"""Sharding by a keyed permutation of global row numbers: law `rows`, shard counts at most one apart.

Rows are numbered 0..N-1 in an order that depends on their content alone: by a hash bucket, then by
the key columns. A generalised Feistel network on Z_a x Z_b (a*b >= N, as near as can be) permutes the
numbers; a value outside 0..N-1 walks the cycle until it is inside. Permuted number p goes to shard
p mod S, slot p div S: both follow from the number by arithmetic, and `unpermuted` leads back.

Numbering takes one exchange of the keys: counts by bucket are summed over the (few) buckets, then
added to the rank within the bucket. Equal rows are counted before the exchange and written out
again after it, so a row that repeats any number of times makes no hot task.

Defined results: null text: size 1, crc 0; a null doc_id sorts first; repeated rows each get a slot; an
empty table gives an empty result; extra columns stay where the operator carries them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import fresh, materialise, small_side

ROUNDS, SEED, WALK = 6, "loom-shards", 64
#: Rows a bucket holds on average; bounds the sort of one task.
BUCKET_ROWS = 50_000


def _digest(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def _halves(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, max(1, -(-n // a))


def _noise(half: Column, i: Column, seed: str) -> Column:
    return _digest(F.concat(F.lit(f"{seed}."), i.cast("string"), F.lit("."), half.cast("string")), 15)


def _once(x: Column, n: int, seed: str, back: bool = False) -> Column:
    """One pass of the network over 0..a*b-1, or its inverse."""
    a, b = _halves(n)
    sign = -1 if back else 1

    def turn(s: Column, i: Column) -> Column:
        low, high = s["low"], s["high"]
        even = i % 2 == 0
        return F.struct(
            F.when(even, F.pmod(low + sign * _noise(high, i, seed), F.lit(a).cast("long"))).otherwise(low).alias("low"),
            F.when(even, high).otherwise(F.pmod(high + sign * _noise(low, i, seed), F.lit(b).cast("long"))).alias("high"),
        )

    order = F.array(*(F.lit(i) for i in (range(ROUNDS - 1, -1, -1) if back else range(ROUNDS))))
    low = F.pmod(x, F.lit(a).cast("long"))
    start = F.struct(low.alias("low"), F.call_function("div", x - low, F.lit(a).cast("long")).alias("high"))
    return F.aggregate(order, start, turn, lambda s: s["high"] * F.lit(a).cast("long") + s["low"])


def _walked(x: Column, n: int, seed: str, back: bool) -> Column:
    """Fewer than a values lie outside 0..n-1, so for n <= 1024 no walk is longer than 32; beyond that each
    step ends it but for a chance of 1 in 32 at most. A walk beyond 64 steps raises an error."""
    step = lambda y: _once(y, n, seed, back)
    on = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), x, lambda y, _: F.when(y < n, y).otherwise(step(y)))
    on = F.when(on < n, on).otherwise(F.raise_error(F.lit("the walk did not end")).cast("long"))
    return F.when(x < n, x).otherwise(on)


def _two(df: DataFrame, name: str, x: Column, n: int, seed: str, back: bool) -> DataFrame:
    """As two projections: the first pass is computed once, not in each branch of the walk."""
    (tmp,) = fresh(df, "pass1")
    out = df.withColumn(tmp, _once(x, n, seed, back))
    return out.withColumn(name, _walked(F.col(tmp), n, seed, back)).drop(tmp)


def permuted(df: DataFrame, name: str, number: Column, n: int, seed: str = SEED) -> DataFrame:
    return _two(df, name, number, n, seed, False)


def unpermuted(df: DataFrame, name: str, number: Column, n: int, seed: str = SEED) -> DataFrame:
    return _two(df, name, number, n, seed, True)


def buckets_for(n: int) -> int:
    return max(64, -(-n // BUCKET_ROWS))


def _bucket(label: Column, n: int) -> Column:
    return _digest(label, 8) % buckets_for(n)


def number_distinct(rows: DataFrame, label: Column) -> tuple[DataFrame, int]:
    """(rows with `number`, N): every row of `rows`, which all its columns identify, numbered from 0."""
    keys = rows.columns
    cnt, buc, num = fresh(rows, "times", "bucket", "number")
    counted = materialise(rows.groupBy(*keys).agg(F.count("*").alias(cnt)))
    n = counted.agg(F.sum(cnt)).first()[0] or 0
    placed = counted.withColumn(buc, _bucket(label, n))
    sums = placed.groupBy(buc).agg(F.sum(cnt).alias("_all")).withColumn("_from", F.sum("_all").over(Window.orderBy(buc)) - F.col("_all")).drop("_all")
    within = F.sum(cnt).over(Window.partitionBy(buc).orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)) - F.col(cnt)
    out = placed.withColumn("_before", within).join(small_side(materialise(sums)), buc)
    out = out.withColumn(num, F.explode(F.sequence(F.lit(0).cast("long"), F.col(cnt) - 1)))
    return out.withColumn(num, F.col(num) + F.col("_before") + F.col("_from")).select(*keys, num), n


def shard_digest(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of docs (doc_id, text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    label = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size"), F.col("text_crc32"))
    numbered, n = number_distinct(rows, label)
    out = permuted(numbered, "p", F.col("number"), n) if n else numbered.withColumn("p", F.col("number"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("p") % shards).cast("int").alias("shard"), F.call_function("div", F.col("p"), F.lit(shards).cast("long")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """docs with shard and slot added (_shard and _slot where those names are taken), all columns kept.

    One exchange moves the rows; the bucket comes from doc_id and a hash of all columns, so rows that share
    a doc_id spread. Rows are ranked in their bucket by doc_id, then by that hash; rows that are equal in all
    are interchangeable, and stay in one bucket."""
    shard, slot, buc, at, start, num, p = fresh(docs, "shard", "slot", "bucket", "at", "start", "number", "p")
    n = docs.count()
    label = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.xxhash64(*docs.columns).cast("string"))
    placed = docs.withColumn(buc, _bucket(label, n))
    sums = placed.groupBy(buc).agg(F.count("*").alias("_all")).select(F.col(buc).alias(start + "_b"), (F.sum("_all").over(Window.orderBy(buc)) - F.col("_all")).alias(start))
    ranked = placed.withColumn(at, F.row_number().over(Window.partitionBy(buc).orderBy("doc_id", F.xxhash64(*docs.columns))))
    out = ranked.join(small_side(materialise(sums)), F.col(buc) == F.col(start + "_b")).withColumn(num, F.col(start) + F.col(at) - 1)
    out = permuted(out, p, F.col(num), n) if n else out.withColumn(p, F.col(num))
    return out.withColumn(shard, (F.col(p) % shards).cast("int")).withColumn(slot, F.call_function("div", F.col(p), F.lit(shards).cast("long"))).select(*docs.columns, shard, slot)
