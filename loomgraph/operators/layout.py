"""Layout and headings: spaced letters, tables, blocks of a page, heading lines and what belongs to a list of references."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.operators.structure import explode_lines, flagged_runs

# --- fixed values ---
LETTER = "A-ZÁÉÍÓÚÑa-záéíóúñ"
LOOSE_LETTERS = 2
TABLE_OVERLAP = 0.50
PAGE_LOSS, TABLE_LOSS = 0.02, 0.10
GLUED_FOLIO = r"^\d{1,4}\s+"
LINES_ABOVE = 3
# --- end of the fixed values ---
_RUN = re.compile(rf"(?:[{LETTER}] ){{2,}}[{LETTER}]")
_IS_LETTER = re.compile(f"[{LETTER}]")


# --- spaced letters ----------------------------------------------------------------------------


def close_up(text: str) -> str:
    """Runs of letters with blanks between them become words, if two letters at least stand free on both sides."""

    def closed(m: re.Match) -> str:
        ends = text[m.start() - 1 : m.start()] + text[m.end() : m.end() + 1]
        free = (len(m[0]) + 1) // 2 - len(_IS_LETTER.findall(ends))
        return m[0].replace(" ", "") if free >= LOOSE_LETTERS else m[0]

    return _RUN.sub(closed, text)


def despace(c: Column) -> Column:
    """close_up for a column, in Arrow batches; rows without such a run stay as they are."""
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else close_up(t))

    return F.when(c.rlike(f"[{LETTER}] [{LETTER}] [{LETTER}]"), run(c)).otherwise(c)


# --- tables ------------------------------------------------------------------------------------


def clean_cells(cells: Column) -> Column:
    return F.transform(cells, lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " ")))


def join_continuations(rows: Column) -> Column:
    """Rows whose first cell is empty, but not all of them, belong to the row before, cell by cell."""
    none = F.array().cast("array<array<string>>")

    def step(done, row):
        goes_on = (F.size(done) > 0) & (F.get(row, F.lit(0)) == "") & F.exists(row, lambda c: c != "")
        last = F.element_at(done, -1)
        merged = F.transform(last, lambda c, i: F.trim(F.concat_ws(" ", c, F.coalesce(F.get(row, i), F.lit("")))))
        return F.when(goes_on, F.array_append(F.slice(done, 1, F.size(done) - 1), merged)).otherwise(F.array_append(done, row))

    return F.aggregate(F.transform(rows, clean_cells), none, step)


def render_table(rows: Column) -> Column:
    """Each row under the header as `value (COLUMN); …` on a line of its own; empty with fewer than two of them or without a header."""

    def said(v: Column) -> Column:
        lines_ = F.array_join(F.transform(v["data"], lambda r: T.render_row(r, v["head"])), "\n")
        return F.when((F.size(v["data"]) >= 2) & T.is_header_row(v["head"]), lines_).otherwise("")

    def parted(v: Column) -> Column:
        whole = v["whole"]
        return T.bound({"head": F.get(whole, F.lit(0)), "data": F.slice(whole, 2, F.greatest(F.size(whole) - 1, F.lit(0)))}, said)

    return T.bound({"rows": rows}, lambda r: T.bound({"whole": join_continuations(r["rows"])}, parted))


def page_text(blocks: DataFrame, tables: DataFrame, plain: DataFrame) -> DataFrame:
    """source_id, page, text, tables_used: blocks (source_id, page, x0, y0, x1, y1, text) and rendered tables (the
    same columns) in reading order; blocks that lie in a table by more than half go. Pages that would lose more
    than 2% of the words of their plain text (source_id, page, plain) keep the plain text."""
    keys = ["source_id", "page"]
    b = blocks.withColumn("_id", F.struct("x0", "y0", "x1", "y1", "text"))
    t = tables.filter("text <> ''")
    box = t.select(*keys, *(F.col(c).alias(f"t{c}") for c in ("x0", "y0", "x1", "y1")))
    wide = F.least("x1", "tx1") - F.greatest("x0", "tx0")
    high = F.least("y1", "ty1") - F.greatest("y0", "ty0")
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    inside = (wide > 0) & (high > 0) & (area > 0) & (wide * high / area > TABLE_OVERLAP)
    covered = b.join(box, keys).filter(inside).select(*keys, "_id").distinct()
    left = b.join(covered, [*keys, "_id"], "left_anti").select(*keys, "x0", "y0", "text")
    parts = left.unionAll(t.select(*keys, "x0", "y0", "text"))
    order = F.array_sort(F.collect_list(F.struct(F.round("y0", 1).alias("y"), "x0", "text")))
    made = parts.groupBy(*keys).agg(F.array_join(F.transform(order, lambda x: x["text"]), "\n").alias("text"))
    both = plain.join(made, keys, "left")
    fine = F.col("text").isNotNull() & (T.lost_words(F.col("plain"), F.coalesce("text", F.lit(""))) <= PAGE_LOSS)
    return both.select(*keys, F.when(fine, F.col("text")).otherwise(F.col("plain")).alias("text"), F.coalesce(fine, F.lit(False)).alias("tables_used"))


# --- headings ----------------------------------------------------------------------------------


def joined_headings(pages: DataFrame) -> DataFrame:
    """source_id, page, line_no, line, effective, consumed: a lone heading word and the number on the next
    filled line count as one line where headings are looked for. The lines themselves don't change."""
    ls = explode_lines(pages, ["source_id", "page"])
    by = Window.partitionBy("source_id", "page").orderBy("line_no")
    bare = F.trim("line")
    full = F.when(bare != "", bare)
    after = F.first(full, ignorenulls=True).over(by.rowsBetween(1, Window.unboundedFollowing))
    before = F.last(full, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))
    number = lambda c: F.coalesce(c.rlike(r"^\d{1,4}$"), F.lit(False))
    word = lambda c: F.coalesce(T.is_heading_word(c), F.lit(False))
    ls = ls.withColumn("_after", after).withColumn("_before", before)
    opens = word(bare) & number(F.col("_after"))
    return ls.select("source_id", "page", "line_no", "line", F.when(opens, F.concat_ws(" ", bare, F.col("_after"))).otherwise(F.col("line")).alias("effective"), (number(bare) & word(F.col("_before"))).alias("consumed"))


def heading_holds(line: Column, pattern: str) -> Column:
    """Whether a line that starts with the pattern is a heading and not prose that starts like one: the label
    ends where a word ends, no bracket closes after it, a lower-case label has no full stop, comma or semicolon
    after it, and what follows doesn't go on in lower case."""
    return line.rlike(f"^(?:{pattern})") & T.bound({"line": line, "rest": F.regexp_replace(line, f"^(?:{pattern})", "")}, _goes_on_as_heading)


def _goes_on_as_heading(v: Column) -> Column:
    closing = F.left(F.ltrim(v["rest"]), F.lit(1))
    lower_start = v["line"].rlike(r"^\p{Ll}")
    return ~v["rest"].rlike(r"^\p{L}") & (closing != ")") & ~(lower_start & closing.isin(".", ",", ";")) & ~v["rest"].rlike(r"^\P{L}*\p{Ll}")


def chapter_title(line: Column, patterns: list[str]) -> Column:
    """The line, or the line without the folio glued to it, if it is a chapter heading as it stands or
    without accents and case; null if it is none."""
    bare = F.trim(line)
    forms = F.filter(F.array_distinct(F.array(bare, F.regexp_replace(bare, GLUED_FOLIO, ""))), lambda v: F.length(v) >= 3)

    def fits(v: Column) -> Column:
        out = F.lit(False)
        for p in patterns:
            out = out | heading_holds(v, p) | _folded_holds(v, f"(?i:{_plain(p)})")
        return out

    return F.get(F.filter(forms, fits), F.lit(0))


def _folded_holds(line: Column, pattern: str) -> Column:
    return T.bound({"plain": T.unaccent_in_place(line)}, lambda x: heading_holds(x["plain"], pattern))


def _plain(pattern: str) -> str:
    """A pattern with its accented letters as plain ones."""
    import unicodedata

    return "".join(c for c in unicodedata.normalize("NFD", pattern) if not unicodedata.combining(c))


def headings(pages: DataFrame, chapters: list[str], sections: list[str]) -> DataFrame:
    """source_id, page, line_no, chapter, section: the titles that lines hold; a section is short and has two stops at most."""
    ls = joined_headings(pages).filter("not consumed")
    bare = F.trim("effective")
    sec = F.lit(False)
    for p in sections:
        sec = sec | bare.rlike(f"^(?:{p})")
    short = (F.length(bare) >= 3) & (F.length(bare) < 80) & (F.length(F.regexp_replace(bare, r"[^.]", "")) <= 2)
    out = ls.select("source_id", "page", "line_no", F.left(chapter_title(F.col("effective"), chapters), F.lit(120)).alias("chapter"), F.when(short & sec, F.left(bare, F.lit(100))).alias("_s"))
    return out.select("source_id", "page", "line_no", "chapter", F.when(F.col("chapter").isNull(), F.col("_s")).alias("section")).filter("chapter is not null or section is not null")


# --- references --------------------------------------------------------------------------------


def reference_runs(pages: DataFrame, citation: str, heading: str, trailing: str, gap: int = 2, least: int = 8, above: int = LINES_ABOVE) -> DataFrame:
    """doc_id, first, last of the lists of references: runs of citations, from their heading (among the three
    filled lines above) to the last of the trailing lines (identifiers, addresses) right after them."""
    ls = explode_lines(pages, ["doc_id"]).withColumn("bare", F.trim("line"))
    by = Window.partitionBy("doc_id").orderBy("line_no")
    onward = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ls = ls.withColumn("filled", F.sum((F.col("bare") != "").cast("int")).over(by))
    ls = ls.withColumn("stop", F.min(F.when(~F.col("bare").rlike(trailing), F.col("line_no"))).over(onward))
    ls = ls.withColumn("lines", F.max("line_no").over(Window.partitionBy("doc_id")) + 1)
    runs = flagged_runs(ls.select("doc_id", "line_no", F.regexp_count("line", F.lit(citation)).alias("marks")), gap, least)
    start = ls.select("doc_id", F.col("line_no").alias("first"), (F.col("filled") - (F.col("bare") != "").cast("int")).alias("before"), "lines")
    runs = runs.join(start, ["doc_id", "first"])
    heads = ls.filter(F.col("bare").rlike(heading)).select("doc_id", F.col("line_no").alias("h"), F.col("filled").alias("h_filled"))
    near = runs.join(heads, "doc_id").filter((F.col("h") < F.col("first")) & (F.col("before") - F.col("h_filled") + 1 <= above)).groupBy("doc_id", "first").agg(F.max("h").alias("h"))
    ends = ls.select("doc_id", (F.col("line_no") - 1).alias("last"), "stop")
    out = runs.join(near, ["doc_id", "first"], "left").join(ends, ["doc_id", "last"], "left")
    nothing_after = F.col("last") + 1 >= F.col("lines")
    return out.select("doc_id", F.coalesce("h", "first").alias("first"), F.when(nothing_after, F.col("last")).otherwise(F.coalesce("stop", "lines") - 1).cast("int").alias("last"))
