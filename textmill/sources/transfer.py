"""Copies of files that can be taken up again: a manifest with checksums, copies by tasks, and nothing half-written under its own name.

A file is intact if its size and SHA-256 are those of its source. Tasks stream files in pieces, write under a name of their own and rename at the end, so a lost executor or a
stopped run leaves at most files that no reader takes. Both folders must be in stores that the workers can open.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE = 8 << 20
MANIFEST = "name string, size long, sha256 string"


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri("file://" + path if path.startswith("/") else path)


def _names(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """name (below the folder) and size of files, from metadata only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    root = _store(folder)[1].rstrip("/")
    # The folder's own path is part of each file's URI; names are what follows it.
    return files.select(F.expr("substring_index(path, '%s/', -1)" % root.replace("'", "\\'")).alias("name"), F.col("length").alias("size"))


def _digest(store, path: str) -> str:
    out = hashlib.sha256()
    with store.open_input_stream(path) as f:
        while piece := f.read(PIECE):
            out.update(piece)
    return out.hexdigest()


def manifest(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """name, size and sha256 of the files below a folder; tasks read them in pieces."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(folder)
        for batch in batches:
            yield batch.assign(sha256=[_digest(store, f"{root}/{n}") for n in batch["name"]])

    names = _names(spark, folder, glob)
    return names.repartition(spark.sparkContext.defaultParallelism, "name").mapInPandas(run, MANIFEST)


def transfer(files: DataFrame, source: str, target: str, check: bool = True) -> DataFrame:
    """Copies the files of a manifest that are not intact in ``target``: name, action (``kept``, ``copied`` or ``failed``) and reason.

    ``check`` False trusts sizes of files that are there. A copy whose bytes differ from the manifest is ``failed`` and is not put in place.
    """

    def one(name: str, size: int, sha256: str) -> tuple[str, str, str]:
        (store, root), (there, to) = _store(source), _store(target)
        path = f"{to}/{name}"
        info = there.get_file_info(path)
        if info.is_file and info.size == size and (not check or _digest(there, path) == sha256):
            return name, "kept", ""
        reason = "missing" if not info.is_file else "size" if info.size != size else "checksum"
        own = f"{path.rpartition('/')[0]}/.{name.rpartition('/')[2]}.{uuid.uuid4().hex}"
        there.create_dir(path.rpartition("/")[0], recursive=True)
        digest = hashlib.sha256()
        try:
            with store.open_input_stream(f"{root}/{name}") as f, there.open_output_stream(own) as out:
                while piece := f.read(PIECE):
                    digest.update(piece)
                    out.write(piece)
        except OSError as e:
            return name, "failed", type(e).__name__
        if digest.hexdigest() != sha256:
            there.delete_file(own)
            return name, "failed", "the source differs from the manifest"
        there.move(own, path)
        return name, "copied", reason

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([one(*r) for r in batch[["name", "size", "sha256"]].itertuples(index=False)], columns=["name", "action", "reason"])

    return files.select("name", "size", "sha256").mapInPandas(run, "name string, action string, reason string")
