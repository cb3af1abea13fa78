"""Structured Streaming forms: incremental upserts, embedding of what lacks a vector, extraction, telemetry windows, sessions."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.catalog import merge_rows
from loomgraph.operators.extraction import embed_missing

RESERVED = ("name", "message", "args", "levelname", "asctime")
#: Parts of a stored table; a batch writes only the parts that its sources fall into.
PARTS = 64


def run_event(df: DataFrame, event: str, **fields) -> DataFrame:
    """Rows of the run log: a named event with flat fields; reserved names are refused, details are cut at 200."""
    bad = [k for k in fields if k in RESERVED]
    if bad:
        raise ValueError(f"reserved names: {bad}")
    return df.select(F.lit(event).alias("event"), *(F.left(F.col(c).cast("string"), F.lit(200)).alias(k) for k, c in fields.items()))


def tumbling(events: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """start, event_type, n, total by window; the same on a table and on a stream."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """user_id, start, n of each session."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("start"), "n")


# --- a stored table of chunks ------------------------------------------------------------------


def _fs(spark, table: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path, path(table).getFileSystem(spark._jsc.hadoopConfiguration())


def _manifest(spark, table: str) -> tuple[int, dict[str, int]]:
    """(epoch, part -> epoch of its files) of the newest finished batch."""
    path, fs = _fs(spark, table)
    names = sorted(s.getPath().getName() for s in fs.globStatus(path(f"{table}/v*.manifest")) or [])
    if not names:
        return -1, {}
    value = spark.read.text(f"{table}/{names[-1]}", wholetext=True).first()["value"]
    return int(names[-1][1:-9]), json.loads(value)


def _read(spark, table: str, parts: dict[str, int]) -> DataFrame | None:
    paths = [f"{table}/part={p}/v={v}" for p, v in sorted(parts.items())]
    return spark.read.parquet(*paths) if paths else None


def current(spark, table: str) -> DataFrame | None:
    """The table as the newest finished batch left it."""
    return _read(spark, table, _manifest(spark, table)[1])


def upsert_stream(incoming: DataFrame, table: str, checkpoint: str, keep: int = 2):
    """Chunks (id, source_id, text, load, closes) into a stored table, batch by batch.

    Rows merge by id, and an embedding stays only if its text did. A source may come in any number of batches:
    its older rows go when a row with `closes` arrives, which ends the source's load `load`. Only the parts that
    a batch touches are written; a manifest written last names the files of every part, so readers never see
    half a batch, and a batch that is repeated gives the same table. Files that the last `keep` manifests don't
    name are deleted."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        path, fs = _fs(spark, table)
        done, parts = _manifest(spark, table)
        if epoch <= done:
            return
        part = F.pmod(F.xxhash64("source_id"), F.lit(PARTS)).cast("int")
        batch = batch.dropDuplicates(["id"]).persist()
        touched = sorted(r[0] for r in batch.select(part).distinct().collect())
        if not touched:
            batch.unpersist()
            return
        rows = batch.select("id", "source_id", "text", "load")
        old = _read(spark, table, {str(p): parts[str(p)] for p in touched if str(p) in parts})
        if old is None:
            new = rows.withColumn("embedding", F.lit(None).cast("array<float>"))
        else:
            new = merge_rows(old, rows)
        closed = batch.filter("closes").select("source_id", F.col("load").alias("_load")).distinct()
        new = new.join(closed, "source_id", "left").filter("_load is null or _load = load").drop("_load")
        new.select("id", "source_id", "text", "load", "embedding", part.alias("part")).repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{table}/_batch{epoch}")
        batch.unpersist()
        for p in touched:
            to = path(f"{table}/part={p}/v={epoch}")
            if fs.exists(to):
                fs.delete(to, True)
            made = path(f"{table}/_batch{epoch}/part={p}")
            if fs.exists(made):
                fs.mkdirs(to.getParent())
                fs.rename(made, to)
                parts[str(p)] = epoch
            else:
                parts.pop(str(p), None)
        out = fs.create(path(f"{table}/v{epoch:012d}.manifest"), True)
        out.write(bytearray(json.dumps(parts).encode()))
        out.close()
        fs.delete(path(f"{table}/_batch{epoch}"), True)
        _vacuum(spark, table, keep)

    return incoming.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def _vacuum(spark, table: str, keep: int) -> None:
    path, fs = _fs(spark, table)
    names = sorted(s.getPath().getName() for s in fs.globStatus(path(f"{table}/v*.manifest")) or [])
    named = set()
    for name in names[-keep:]:
        value = spark.read.text(f"{table}/{name}", wholetext=True).first()["value"]
        named |= {f"part={p}/v={v}" for p, v in json.loads(value).items()}
    for s in fs.globStatus(path(f"{table}/part=*/v=*")) or []:
        where = s.getPath()
        if f"{where.getParent().getName()}/{where.getName()}" not in named:
            fs.delete(where, True)
    for name in names[:-keep]:
        fs.delete(path(f"{table}/{name}"), False)


# --- what is still missing ---------------------------------------------------------------------


def embed_stream(incoming: DataFrame, provider, out: str, checkpoint: str):
    """Vectors of texts (id, text) that have none yet, appended batch by batch; a repeated batch replaces itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        todo = batch.dropDuplicates(["id"])
        have = written(batch.sparkSession, out, before=epoch)
        if have is not None:
            todo = todo.join(have.filter("embedding is not null").select("id"), "id", "left_anti")
        embed_missing(todo, provider).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    return incoming.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def written(spark, out: str, before: int | None = None) -> DataFrame | None:
    """What the batches so far have written."""
    path, fs = _fs(spark, out)
    found = fs.globStatus(path(f"{out}/epoch=*")) or []
    names = [s.getPath().getName() for s in found]
    names = [n for n in names if before is None or int(n.partition("=")[2]) < before]
    return spark.read.option("basePath", out).parquet(*(f"{out}/{n}" for n in sorted(names))) if names else None


def extract_stream(incoming: DataFrame, extractor, out: str, checkpoint: str, profile: str):
    """Extraction records (chunk_id, record, error) of chunks (chunk_id, text), under the profile's version: another
    version starts anew, records with an error are tried again when their chunk comes again."""
    root = f"{out}/profile={profile}"

    def run(frames):
        import pandas as pd

        for pdf in frames:
            records, errors = [], []
            for t in pdf["text"]:
                try:
                    records.append(extractor(t))
                    errors.append(None)
                except Exception as x:  # noqa: BLE001  whatever an extractor raises is the record's error
                    records.append(None)
                    errors.append(str(x)[:200])
            yield pd.DataFrame({"chunk_id": pdf["chunk_id"].to_numpy(), "record": records, "error": errors}, dtype=object)

    def write(batch: DataFrame, epoch: int) -> None:
        todo = batch.dropDuplicates(["chunk_id"]).select("chunk_id", "text")
        have = written(batch.sparkSession, root, before=epoch)
        if have is not None:
            todo = todo.join(have.filter("error is null").select("chunk_id"), "chunk_id", "left_anti")
        todo.mapInPandas(run, "chunk_id long, record string, error string").write.mode("overwrite").parquet(f"{root}/epoch={epoch}")

    return incoming.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/profile={profile}")
