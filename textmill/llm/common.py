"""What the operators share: the word patterns, the shared folder, and materialised intermediates."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: space, tab to carriage return (ASCII only).
SPACE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors and the driver see.

    It is ``spark.checkpoint.dir`` of the session. Only where that is unset and everything runs in one process (local tests) a
    temporary folder is made and registered as the checkpoint folder; on a cluster a missing setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="textmill-")
    sc.setCheckpointDir(path)
    return path


def store(uri: str):
    """The file system of a folder and its path there, for workers."""
    from pyarrow import fs

    return fs.FileSystem.from_uri("file://" + uri if uri.startswith("/") else uri)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage is cut there and the rows outlive executors. ``remove`` deletes it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def remove(*tables: DataFrame) -> None:
    """Delete what ``materialize`` wrote for these tables, which nothing may read any more."""
    for df in tables:
        if path := getattr(df, "written_to", None):
            spark = df.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def uncollected(rows: Iterator) -> Iterator:
    """``rows``, while the worker's cycle collector rests: it would go through all that a worker keeps again and again, and finds nothing where no cycles are made."""
    gc.disable()
    try:
        yield from rows
    finally:
        gc.enable()


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null gives null."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row.

    Inside higher-order functions an outer expression is evaluated again for each element; binding
    it to a lambda variable avoids this.
    """
    return F.transform(F.array(value), body)[0]


def base_documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))
