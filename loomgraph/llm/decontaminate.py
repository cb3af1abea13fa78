"""Benchmark decontamination by template canonicalisation.

Numbers, runs of capitalised words inside a sentence (names) and units after a number become typed
placeholders; the rest is lower-cased and split at what is neither letter nor digit. Windows of five
tokens of the benchmark and of the documents meet in a hash join. A document leaks an item if at least
80% of the item's windows occur in it on diagonals (equal shift between the two) whose slots are
consistent: an item's value stands for one value of the document and the other way round. So an item
with other numbers or names in it is caught, and one with its values jumbled isn't.

Three phases. The first looks up, over all documents, windows that few templates have, enough of them
that no leak can lack all; nothing is exchanged but the hits. The second counts all windows of those
templates in those documents. The third looks at slots, in what the second has found.

Defined results: a null or empty text has no tokens and leaks nothing, a null or empty item is never
leaked. A text of fewer than five tokens is one window, its whole sequence. Repeated rows give one row
for a (doc_id, item_id); rows with a null doc_id are told apart by their text. Extra columns are kept
by `drop_leaks` and ignored by `leaks`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import fresh, materialise, small_side

WIDTH, PERCENT = 5, 80
#: Loops over groups are possessive: Java runs those without recursion, so a run of any length is safe.
NUMBER = r"[0-9]++(?:[.,][0-9]++)*+"
UNITS = (
    "kg|km|cm|mm|mg|ml|lb|lbs|oz|mph|kmh|kwh|hz|ghz|gb|mb|kb|tb|usd|eur|"
    "grams?|kilograms?|meters?|metres?|miles?|feet|foot|inch|inches|yards?|liters?|litres?|gallons?|"
    "seconds?|minutes?|hours?|days?|weeks?|months?|years?|dollars?|cents?|euros?|pounds?|percent|degrees?"
)
UNIT = rf"(zqnum +)(?:{UNITS})([^a-zA-Z0-9]|$)"
NAME = r" (?<=[^.!?:\n ] ) *(\p{Lu}\p{Ll}++(?: ++\p{Lu}\p{Ll}++)*+)"
SPLIT = r"[^\p{L}\p{N}]+"


def _numbered(text: Column) -> Column:
    t = F.regexp_replace(F.coalesce(text, F.lit("")), NUMBER, " zqnum ")
    return F.when(F.contains(t, F.lit("zqnum ")), F.regexp_replace(t, UNIT, "$1zqunit $2")).otherwise(t)


def canonical(text: Column) -> Column:
    """Tokens of the template of text."""
    t = F.lower(F.regexp_replace(_numbered(text), NAME, " zqname"))
    return F.array_remove(F.split(t, SPLIT), "")


def _windows(df: DataFrame, tokens: str, keep: list[str]) -> DataFrame:
    """keep, pos, hash: of each window of five tokens, or of the whole of a shorter sequence."""
    shifted = [F.col(tokens)] + [F.slice(tokens, i + 1, F.greatest(F.size(tokens), F.lit(1))) for i in range(1, WIDTH)]
    names = [f"_w{i}" for i in range(WIDTH)]
    zipped = F.arrays_zip(*(c.alias(n) for c, n in zip(shifted, names, strict=True)))
    out = df.select(*keep, F.posexplode(zipped).alias("pos", "_z"))
    full = F.col("_z")[names[-1]].isNotNull()
    out = out.filter(full | (F.col("pos") == 0))
    return out.select(*keep, "pos", F.xxhash64(*(F.col("_z")[n] for n in names)).alias("hash"))


def _slots(df: DataFrame, text: str, tokens: str, keep: list[str], at: str, value: str) -> DataFrame:
    """keep, at (token position), kind, value: of each number and name, in the order of the text."""

    def of(kind: str, values: Column) -> DataFrame:
        places = F.filter(F.transform(F.col(tokens), lambda x, i: F.when(x == kind, i)), lambda i: i.isNotNull())
        return df.select(*keep, F.lit(kind).alias("kind"), F.inline(F.arrays_zip(places.alias(at), values.alias(value))))

    numbers = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(NUMBER), F.lit(0))
    names = F.regexp_extract_all(_numbered(F.col(text)), F.lit(NAME), F.lit(1))
    return of("zqnum", numbers).union(of("zqname", names))


def _row_key(docs: DataFrame) -> Column:
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit(""))))


def _rarest(grams: DataFrame, size: DataFrame, percent: int) -> DataFrame:
    """t_key, hash: of each template the windows that few templates have, as many as cannot all be missing.

    A text that holds percent of a template's n windows lacks n - ceil(percent * n) at most, so it holds
    one of any n - ceil(percent * n) + 1 of them. A window that all templates share is looked up only for
    templates that have no rarer ones."""
    common = grams.groupBy("hash").agg(F.count_distinct("t_key").alias("n_templates"))
    order = Window.partitionBy("t_key").orderBy("n_templates", "hash", "qpos")
    ranked = grams.join(common, "hash").join(size, "t_key").withColumn("at", F.row_number().over(order))
    least = F.ceil(F.col("n_windows") * percent / 100)
    return ranked.filter(F.col("at") <= F.col("n_windows") - least + 1).select("t_key", "hash").distinct()


def leaks(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """row_key, doc_id, item_id, n_windows, n_matched, n_slots of each leak in docs (doc_id, text).

    Items with the same tokens are one template until their slots are looked at, so what is joined to
    documents grows with templates, not with items."""
    docs = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("row_key", _row_key(docs))
    items = items.select("item_id", F.col("text").cast("string").alias("text")).filter("item_id is not null").distinct()
    items = items.withColumn("item_key", F.md5(F.concat_ws(":", F.col("item_id").cast("string"), F.coalesce("text", F.lit("")))))
    known = items.withColumn("tokens", canonical(F.col("text"))).withColumn("t_key", F.md5(F.array_join("tokens", " ")))
    known = materialise(known)
    templates = known.dropDuplicates(["t_key"])
    grams = materialise(_windows(templates, "tokens", ["t_key"]).select("t_key", F.col("pos").alias("qpos"), "hash"))
    size = materialise(grams.groupBy("t_key").agg(F.count("*").alias("n_windows")))
    rare = materialise(_rarest(grams, size, percent))
    # rows that hold a rare window of a template
    first = _windows(docs.select("row_key", canonical(F.col("text")).alias("tokens")), "tokens", ["row_key"])
    maybe = materialise(first.join(small_side(rare), "hash").select("row_key", "t_key").distinct())
    # all windows of the template in those rows
    few = materialise(maybe.select("row_key").distinct())
    some = docs.join(small_side(few), "row_key", "left_semi").dropDuplicates(["row_key"]).withColumn("tokens", canonical(F.col("text")))
    some = materialise(some)
    sought = maybe.join(small_side(grams), "t_key")
    again = _windows(some, "tokens", ["row_key"]).select("row_key", F.col("pos").alias("dpos"), "hash").join(sought, ["row_key", "hash"])
    again = materialise(again.select("row_key", "t_key", "dpos", "qpos", (F.col("dpos") - F.col("qpos")).alias("shift")))
    hits = again.groupBy("row_key", "t_key").agg(F.count_distinct("qpos").alias("m")).join(small_side(size), "t_key")
    found = materialise(hits.filter(100 * F.col("m") >= percent * F.col("n_windows")).select("row_key", "t_key", "n_windows"))
    again = again.join(small_side(found.select("row_key", "t_key")), ["row_key", "t_key"], "left_semi")
    # slots of what was found, item by item
    places = again.select("row_key", "t_key", "shift", F.explode(F.sequence(F.lit(0), F.lit(WIDTH - 1))).alias("j"), "qpos").select("row_key", "t_key", "shift", (F.col("qpos") + F.col("j")).alias("iat")).distinct()
    mine = _slots(some, "text", "tokens", ["row_key"], "dat", "dvalue")
    theirs = _slots(known, "text", "tokens", ["t_key", "item_key"], "iat", "ivalue")
    pairs = places.join(theirs, ["t_key", "iat"]).withColumn("dat", F.col("iat") + F.col("shift")).join(mine, ["row_key", "dat", "kind"])
    by = ["row_key", "item_key", "shift"]
    slots = pairs.groupBy(*by).agg(F.count_distinct("kind", "ivalue", "dvalue").alias("n_slots"), F.count_distinct("kind", "ivalue").alias("iv"), F.count_distinct("kind", "dvalue").alias("dv"))
    slots = slots.withColumn("bad", (F.col("n_slots") != F.col("iv")) | (F.col("n_slots") != F.col("dv")))
    sound = again.join(small_side(known.select("t_key", "item_key", "item_id")), "t_key").join(slots.select(*by, "n_slots", "bad"), by, "left").filter("bad is null or not bad")
    sound = sound.groupBy("row_key", "t_key", "item_key", "item_id").agg(F.count_distinct("qpos").alias("n_matched"), F.coalesce(F.max("n_slots"), F.lit(0)).cast("long").alias("n_slots"))
    out = sound.join(small_side(found), ["row_key", "t_key"]).filter(100 * F.col("n_matched") >= percent * F.col("n_windows"))
    out = out.join(some.select("row_key", "doc_id"), "row_key")
    return out.groupBy("row_key", "doc_id", "item_id").agg(F.max("n_windows").alias("n_windows"), F.max("n_matched").alias("n_matched"), F.max("n_slots").alias("n_slots"))


def drop_leaks(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs without the rows that leak an item; all columns stay."""
    key, lost = fresh(docs, "row_key", "lost_key")
    gone = materialise(leaks(docs, items, percent).select(F.col("row_key").alias(lost)).distinct())
    text = docs.withColumn("text", F.col("text").cast("string"))
    return docs.withColumn(key, _row_key(text)).join(small_side(gone), F.col(key) == F.col(lost), "left_anti").drop(key)
