"""Shared plumbing of the corpus operators: scratch tables, size-checked joins, Arrow buffers."""

from __future__ import annotations

import tempfile
import uuid
import weakref

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side may be broadcast; two or three short columns, so under 100 MB.
BROADCAST_ROWS = 1_000_000


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (spark.checkpoint.dir). Where it is unset, a temporary one on a local
    master, whose executors are this process; an error on a cluster, whose executors couldn't read it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="loomgraph-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/loomgraph-{spark.sparkContext.applicationId}"


def materialise(df: DataFrame) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: cuts the lineage, outlives executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _written[id(out)] = (weakref.ref(out), path)
    return out


_written: dict[int, tuple] = {}


def forget(df: DataFrame) -> None:
    """Delete the files of a materialised df that nothing reads any more."""
    ref, path = _written.pop(id(df), (None, None))
    if ref is not None and ref() is df:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all tables that this application has materialised; call it when its results are written."""
    where = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _written.clear()


def fits(df: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most so many rows; reads no more than it must to tell."""
    return df.limit(most + 1).count() <= most


def small_side(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df (already materialised), marked for broadcast if its row count proves small, else left to a
    shuffled join, which adaptive execution splits where it is skewed."""
    return F.broadcast(df) if fits(df, most) else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that df doesn't have (Spark ignores case)."""
    have, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in have:
            n = "_" + n
        have.add(n.lower())
        out.append(n)
    return out


def letters_of(batch, at: int):
    """(bytes, offsets, nulls) of a string column of an Arrow batch, without a copy."""
    import pyarrow as pa

    a = batch.column(at)
    wide = pa.types.is_large_string(a.type)
    _, offs, data = a.buffers()
    kind = np.int64 if wide else np.int32
    if len(a) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, bool)
    offsets = np.frombuffer(offs, kind)[a.offset : a.offset + len(a) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    nulls = np.asarray(a.is_null().to_numpy(zero_copy_only=False), bool)
    return raw, offsets, nulls


def row_slices(offsets: np.ndarray, most: int):
    """Row ranges of about `most` bytes; a longer row stands alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        to = min(n, max(at + 1, to))
        yield at, to
        at = to
