"""Files of the engine: chunks, catalogue, profiles, pathways, trees, checkpoints, graphs, reports, events.

Large files are read and written by Spark's own sources. YAML and tree files are one document each; they are
read whole and parsed on the executors. Profiles are configuration of the driver.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Iterable
from functools import lru_cache
from itertools import islice

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgraph.functions import text as T

CHUNK = "id string, source_id string, chunk_index int, page int, chapter string, section string, kind string, text string"
STEP = "dag string, dag_kind string, at int, ord int, node string, node_type string, step_type string, condition string, note string"
#: Pages that leave a reader at once.
FRAME = 500
TREE = "code string, name string, level int, parent string"


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir); on a local master a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="loomgraph-files-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/files-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def stored(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again: computed once, whatever reads it, and safe from lost executors."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- chunks and catalogue ----------------------------------------------------------------------


def read_catalogue(spark: SparkSession, path: str, example: str | None = None) -> DataFrame:
    """One row for each source of the user's catalogue, or of the example where the user has none."""
    if not exists(spark, path):
        if example is None:
            raise FileNotFoundError(path)
        path = example
    return spark.read.option("multiLine", True).json(path).select(F.explode("libros").alias("s")).select("s.*")


def read_chunks(spark: SparkSession, folder: str, catalogue: DataFrame, schema: str = CHUNK) -> DataFrame:
    """Chunks of the sources that the catalogue (id, estado) calls parsed and that have a file <id>.json, an array of chunks."""
    every = spark.read.schema(schema).option("multiLine", True).json(f"{folder}/*.json")
    of = every.withColumn("_file", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", ""))
    parsed = catalogue.filter("estado = 'parseado'").select(F.col("id").alias("_file")).distinct()
    return of.join(parsed, "_file", "left_semi").drop("_file")


def write_chunks(chunks: DataFrame, folder: str) -> None:
    """A JSON array for each source, <source_id>.json; one source is written by one task, chunk after chunk."""
    rows = chunks.select("source_id", F.to_json(F.struct(*chunks.columns)).alias("j"), F.col("chunk_index").alias("_at"))
    arrays = rows.groupBy(F.col("source_id").alias("name")).agg(F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "j"))), lambda x: x["j"]), ",\n"), F.lit("]")).alias("value"))
    write_files(arrays, folder, ".json")


def write_files(rows: DataFrame, folder: str, suffix: str) -> None:
    """A text file <name><suffix> for each row (name, value)."""
    _write_named(rows.select("name", "value"), folder, suffix, "\n")


def _write_named(rows: DataFrame, folder: str, suffix: str, mark: str) -> None:
    """The rows (name, value) of each name in a file <name><suffix>, each closed by the mark; one name is in one partition."""
    root, spark = folder.rstrip("/"), rows.sparkSession
    rows.write.mode("overwrite").option("lineSep", mark).partitionBy("name").text(f"{root}/_parts")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for s in fs.globStatus(path(f"{root}/_parts/name=*/part-*")) or []:
        name = s.getPath().getParent().getName().partition("=")[2]
        fs.rename(s.getPath(), path(f"{root}/{name}{suffix}"))
    fs.delete(path(f"{root}/_parts"), True)


def write_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines, in a folder for each value of `by`."""
    w = df.write.mode("overwrite")
    (w.partitionBy(by) if by else w).json(path)


# --- pages -------------------------------------------------------------------------------------


def _cleaned(pages: DataFrame, least: int, old: bool) -> DataFrame:
    """pages cleaned, those of more than `least` characters; each text is cleaned once, for the rule and the result."""
    clean = T.clean_page_v1(F.col("text")) if old else T.clean_page(F.col("text"))
    return pages.select("source_id", "page", F.explode(F.filter(F.array(clean), lambda t: F.length(F.trim(t)) > least)).alias("text"))


def read_pages(spark: SparkSession, glob: str, pages_of: Callable[[bytes], Iterable[str]], least: int = 20, old: bool = False) -> DataFrame:
    """source_id, page (from 1), text of each file: a reader of the format gives its pages, cleaning and the
    rule that a page has more than `least` characters are ours. old: the older cleaning. A file is read whole, as its
    reader needs it; its pages leave in frames of FRAME."""

    def run(frames):
        import pandas as pd

        for pdf in frames:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                ident = name.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                pages, at = iter(pages_of(bytes(content))), 1
                while texts := list(islice(pages, FRAME)):
                    yield pd.DataFrame({"source_id": [ident] * len(texts), "page": range(at, at + len(texts)), "text": texts})
                    at += len(texts)

    raw = spark.read.format("binaryFile").load(glob).select("path", "content").mapInPandas(run, "source_id string, page int, text string")
    return _cleaned(raw, least, old)


def write_text_pages(pages: DataFrame, folder: str, mark: str = "\f") -> None:
    """A file <name>.txt for each name of pages (name, at, value), its pages by `at`, each closed by the mark. Rows are
    sorted and streamed out, so no file is in memory."""
    # a name that may be null would be sorted again, by itself alone
    rows = pages.select(F.coalesce("name", F.lit("")).alias("name"), "at", "value")
    _write_named(rows.repartition("name").sortWithinPartitions("name", "at").select("name", "value"), folder, ".txt", mark)


def read_text_pages(spark: SparkSession, glob: str, mark: str = "\f", least: int = 20, old: bool = False) -> DataFrame:
    """What read_pages gives, of text files whose pages are closed by a mark of one byte: Spark splits these files, so
    neither memory nor a task grows with a file. A page's number is its place in its part of the file (rows of a part are
    numbered one after the other) behind the pages of the parts before."""
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    rows = spark.read.option("lineSep", mark).text(glob).select(name.alias("source_id"), F.col("_metadata.file_block_start").alias("_part"), F.monotonically_increasing_id().alias("_at"), F.col("value").alias("text"))
    parts = rows.groupBy("source_id", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("source_id").orderBy("_part")) - F.col("_n")
    parts = parts.select("source_id", "_part", (before - F.col("_first") + 1).alias("_shift"))
    raw = rows.join(F.broadcast(parts), ["source_id", "_part"]).select("source_id", (F.col("_at") + F.col("_shift")).cast("int").alias("page"), "text")
    return _cleaned(raw, least, old)


# --- configuration -----------------------------------------------------------------------------


@lru_cache(maxsize=32)
def read_profile(path: str) -> dict:
    """A profile; an error if there is none."""
    import yaml

    with open(path, encoding="utf-8") as f:
        found = yaml.safe_load(f)
    if not isinstance(found, dict):
        raise ValueError(f"not a profile: {path}")
    return found


def profile_dimensions(spark: SparkSession, profile: dict) -> tuple[DataFrame, DataFrame]:
    """(entity types, relation types) of a profile as tables."""
    types = [(e["id"], e["label"], e.get("desc", ""), list(e.get("synonyms", []))) for e in profile.get("entities", [])]
    relations = [(r["id"], list(r.get("from", [])), list(r.get("to", [])), bool(r.get("extract", True))) for r in profile.get("relations", [])]
    return spark.createDataFrame(types, "type string, label string, description string, synonyms array<string>"), spark.createDataFrame(relations, "relation string, sources array<string>, targets array<string>, extract boolean")


def _whole(spark: SparkSession, glob: str, rows_of: Callable[[str], list[tuple]], schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(frames):
        import pandas as pd

        for pdf in frames:
            for value in pdf["value"]:
                yield pd.DataFrame(rows_of(value), columns=names, dtype=object)

    return spark.read.text(glob, wholetext=True).mapInPandas(run, schema)


def pathway_rows(value: str) -> list[tuple]:
    import yaml

    d = yaml.safe_load(value)
    get = lambda s, k: None if s.get(k) is None else str(s[k])
    return [(d["nombre"], d.get("tipo", "pathway"), i, int(s["orden"]), str(s["nodo"]), get(s, "tipo_nodo"), get(s, "tipo_paso"), get(s, "condicion"), get(s, "nota")) for i, s in enumerate(d.get("pasos") or [])]


def read_pathways(spark: SparkSession, folder: str) -> DataFrame:
    """The steps of the pathway files of a folder: STEP."""
    return _whole(spark, f"{folder}/*.yaml", pathway_rows, STEP)


def tree_rows(value: str) -> list[tuple]:
    """(code, name, level, parent) of a nested tree of {code, name, children}, or of several; any depth."""
    top = json.loads(value)
    todo, out = [(n, 0, None) for n in reversed(top if isinstance(top, list) else [top])], []
    while todo:
        node, level, parent = todo.pop()
        out.append((node["code"], node.get("name", ""), level, parent))
        todo += [(c, level + 1, node["code"]) for c in reversed(node.get("children") or [])]
    return out


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    return _whole(spark, path, tree_rows, TREE)


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """n, line of a checkpoint file: 0 for its header line, 1 for a record. Broken lines stay; `resume` skips them."""
    lines = spark.read.text(path).filter("value <> ''")
    return lines.select(F.when(F.get_json_object("value", "$.header").isNotNull(), 0).otherwise(1).alias("n"), F.col("value").alias("line"))


# --- graph -------------------------------------------------------------------------------------


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Nodes by label and edges by type: a query of one label or type reads only its folders."""
    nodes.write.mode("overwrite").partitionBy("label").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").partitionBy("type").parquet(f"{path}/edges")


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges")


def send_batches(df: DataFrame, send: Callable[[list[dict]], None], size: int = 500) -> None:
    """Rows to an outside store in batches of `size`, from the tasks. A task that is repeated sends again, so
    the store must take a row twice (by its key)."""

    def run(rows):
        batch: list[dict] = []
        for r in rows:
            batch.append(r.asDict(recursive=True))
            if len(batch) == size:
                send(batch)
                batch = []
        if batch:
            send(batch)

    df.foreachPartition(run)


# --- reports and events ------------------------------------------------------------------------


def dedup_report(groups: DataFrame, doubtful: DataFrame, top: int = 40, most_doubtful: int = 60) -> DataFrame:
    """part, at, line: the report of duplicate groups (label, key, size, id, name, degree, canonical) in Markdown."""
    per = groups.groupBy("label", "key").agg(
        F.count("*").alias("n"), F.max("degree").alias("degree"), F.max_by("name", F.struct(F.col("id") == F.col("canonical"), "id")).alias("name"),
        F.array_join(F.array_sort(F.collect_set("name")), ", ").alias("names"),
    )
    row = lambda part, at, line: [F.lit(part).alias("part"), at.cast("long").alias("at"), line.alias("line")]
    total = per.agg(F.count("*").alias("g"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    head = total.select(*row(0, F.lit(0), F.format_string("# Duplicates: %d groups, %d nodes, %d to remove", "g", "n", F.col("n") - F.col("g"))))
    labels = per.groupBy("label").agg(F.count("*").alias("g"), F.sum("n").alias("n"))
    at = F.row_number().over(Window.orderBy(F.desc("g"), "label"))
    by_label = labels.withColumn("r", at).select(*row(1, F.col("r"), F.format_string("- %s: %d groups, %d nodes", "label", "g", "n")))
    best = per.orderBy(F.desc("degree"), "key", "label").limit(top).withColumn("r", F.row_number().over(Window.orderBy(F.desc("degree"), "key", "label")))
    first = best.select(*row(2, F.col("r"), F.format_string("- %s (%s): %s", "name", "label", "names")))
    odd = doubtful.orderBy("key", "label").limit(most_doubtful).withColumn("r", F.row_number().over(Window.orderBy("key", "label")))
    last = odd.select(*row(3, F.col("r"), F.format_string("- doubtful (%s): %s (%s)", "why", "key", "label")))
    return head.unionAll(by_label).unionAll(first).unionAll(last)


def write_report(report: DataFrame, path: str) -> None:
    report.orderBy("part", "at").coalesce(1).select("line").write.mode("overwrite").text(path)


def append_events(events: DataFrame, path: str) -> None:
    """Named events (event and flat fields) as JSON lines after those that are there."""
    events.write.mode("append").json(path)
