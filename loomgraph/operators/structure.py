"""Layout and structure of paged documents: repeated edge lines, folios, headings, segments, runs of references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions import text as T


def explode_lines(pages: DataFrame, keys: list[str]) -> DataFrame:
    """keys, line_no, line."""
    return pages.select(*keys, F.posexplode(T.lines(F.col("text"))).alias("line_no", "line"))


def repeated_edge_lines(pages: DataFrame, least_pages: int = 3, edge: int = 2) -> DataFrame:
    """source_id, key, n_pages of headers and footers: short lines among the edges of several pages."""
    ls = explode_lines(pages, ["source_id", "page"]).withColumn("key", T.line_key(F.col("line"))).filter("key <> ''")
    by = Window.partitionBy("source_id", "page")
    up, down = F.row_number().over(by.orderBy("line_no")), F.row_number().over(by.orderBy(F.desc("line_no")))
    ls = ls.withColumn("up", up).withColumn("down", down)
    widest = ls.groupBy("source_id").agg(F.max(F.length("key")).alias("widest"))
    edges = ls.filter((F.col("up") <= edge) | (F.col("down") <= edge)).groupBy("source_id", "key").agg(F.count_distinct("page").alias("n_pages")).filter(F.col("n_pages") >= least_pages)
    room = F.least(F.lit(T.MAX_LAYOUT), F.floor(F.col("widest") * 0.75))
    return edges.join(widest, "source_id").filter(F.length("key") <= room).select("source_id", "key", "n_pages")


def drop_lines(pages: DataFrame, repeated: DataFrame) -> DataFrame:
    """pages without the lines whose key is among the repeated ones of their source."""
    gone = repeated.groupBy("source_id").agg(F.collect_set("key").alias("gone"))
    kept = F.filter(T.lines(F.col("text")), lambda x: ~F.array_contains(F.coalesce("gone", F.array().cast("array<string>")), T.line_key(x)))
    return pages.join(gone, "source_id", "left").withColumn("text", F.array_join(kept, "\n")).drop("gone")


def folio_series(candidates: DataFrame, gap: int = 5, least: int = 5) -> DataFrame:
    """source_id, page, printed: pages numbered by the longest series of one offset; an exact tie publishes nothing."""
    c = candidates.select("source_id", "page", (F.col("printed") - F.col("page")).alias("offset")).distinct()
    by = Window.partitionBy("source_id", "offset").orderBy("page")
    c = c.withColumn("new", F.coalesce((F.col("page") - F.lag("page").over(by) - 1 > gap).cast("int"), F.lit(0)))
    c = c.withColumn("island", F.sum("new").over(by))
    s = c.groupBy("source_id", "offset", "island").agg(F.min("page").alias("first"), F.max("page").alias("last"), F.count("*").alias("n")).filter(F.col("n") >= least)
    best = Window.partitionBy("source_id")
    s = s.withColumn("most", F.max("n").over(best)).filter("n = most").withColumn("ties", F.count("*").over(best)).filter("ties = 1")
    return s.select("source_id", F.explode(F.sequence("first", "last")).alias("page"), "offset").select("source_id", "page", (F.col("page") + F.col("offset")).alias("printed"))


def heading_flags(line: Column, chapter: str, section: str) -> tuple[Column, Column]:
    """(is a chapter heading, is a section heading): the guards on length and full stops included."""
    t = F.trim(line)
    cap = (F.length(t) >= 3) & t.rlike(chapter)
    sec = ~cap & (F.length(t) >= 3) & (F.length(t) < 80) & (F.length(F.regexp_replace(t, "[^.]", "")) <= 2) & t.rlike(section)
    return cap, sec


def heading_ffill(pages: DataFrame, chapter: str, section: str) -> DataFrame:
    """source_id, page, line_no, chapter, section: the headings in force at each line; a chapter resets the section."""
    ls = explode_lines(pages, ["source_id", "page"])
    cap, sec = heading_flags(F.col("line"), chapter, section)
    ls = ls.withColumn("cap", F.when(cap, F.left(F.trim("line"), F.lit(120)))).withColumn("sec", F.when(sec, F.left(F.trim("line"), F.lit(100))))
    order = Window.partitionBy("source_id").orderBy("page", "line_no")
    ls = ls.withColumn("epoch", F.count("cap").over(order)).withColumn("chapter", F.last("cap", ignorenulls=True).over(order))
    within = Window.partitionBy("source_id", "epoch").orderBy("page", "line_no")
    return ls.withColumn("section", F.last("sec", ignorenulls=True).over(within)).select("source_id", "page", "line_no", "chapter", "section")


def segments(pages: DataFrame, chapter: str, section: str) -> DataFrame:
    """source_id, page, seq, text, chapter, section: each accepted heading opens a segment at its own line; blank ones go."""
    ls = explode_lines(pages, ["source_id", "page"])
    cap, sec = heading_flags(F.col("line"), chapter, section)
    titles = heading_ffill(pages, chapter, section)
    within = Window.partitionBy("source_id", "page").orderBy("line_no")
    ls = ls.withColumn("seq", F.sum((cap | sec).cast("int")).over(within)).join(titles, ["source_id", "page", "line_no"])
    out = ls.groupBy("source_id", "page", "seq").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("text"),
        F.max_by("chapter", "line_no").alias("chapter"),
        F.max_by("section", "line_no").alias("section"),
    )
    return out.filter(~F.col("text").rlike(r"^\s*$"))


def flagged_runs(flags: DataFrame, gap: int, least: int) -> DataFrame:
    """doc, first, last, total: runs of lines with marks > 0, at most `gap` lines without between, `least` marks in all."""
    by = Window.partitionBy("doc_id").orderBy("line_no")
    f = flags.filter("marks > 0")
    f = f.withColumn("new", F.coalesce((F.col("line_no") - F.lag("line_no").over(by) - 1 > gap).cast("int"), F.lit(0)))
    f = f.withColumn("island", F.sum("new").over(by))
    return f.groupBy("doc_id", "island").agg(F.min("line_no").alias("first"), F.max("line_no").alias("last"), F.sum("marks").alias("total")).filter(F.col("total") >= least).drop("island")


def line_natures(pages: DataFrame, citation: str = T.CITATION, code: str = T.DOTTED_CODE, least: int = 8) -> DataFrame:
    """doc_id, line_no, nature of each line: referencias, indice or contenido; references win."""
    ls = explode_lines(pages, ["doc_id"])

    def runs(pattern: str, gap: int) -> DataFrame:
        return flagged_runs(ls.select("doc_id", "line_no", F.regexp_count("line", F.lit(pattern)).alias("marks")), gap, least)

    out = ls.select("doc_id", "line_no")
    for name, found in (("r", runs(citation, 2)), ("i", runs(code, 1))):
        lines_ = found.select("doc_id", F.explode(F.sequence("first", "last")).alias("line_no"), F.lit(True).alias(name))
        out = out.join(lines_, ["doc_id", "line_no"], "left")
    return out.select("doc_id", "line_no", F.when(F.col("r"), "referencias").when(F.col("i"), "indice").otherwise("contenido").alias("nature"))
