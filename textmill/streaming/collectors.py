"""Collectors: pages as a stream with offsets, a sink by category and cycle, cycle counters, and progress rows for dashboards.

The source counts the rows of each file of a folder; a query's checkpoint holds the counts up to which it has read, so a stopped collector goes on where it was, and nothing is lost
or read twice. Files may be added and are never changed. The folder must be in a store that the workers can open.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PAGE = "page_id long, url string, html string"
#: Rows that one task reads at most.
ROWS = 50_000


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri("file://" + path if path.startswith("/") else path)


@dataclass
class Rows(InputPartition):
    """Rows [first, last) of a file."""

    file: str
    first: int
    last: int


class PageReader(DataSourceStreamReader):
    def __init__(self, path: str, names: list[str], rows: int):
        self.path, self.names, self.rows = path, names, rows

    def _sizes(self) -> dict[str, int]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, folder = _store(self.path)
        found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return {f.base_name: pq.read_metadata(f.path, filesystem=store).num_rows for f in found if f.base_name.endswith(".parquet") and f.base_name[0] not in "._"}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return dict(sorted(self._sizes().items()))

    def partitions(self, start: dict, end: dict) -> list[Rows]:
        out = []
        for file, last in end.items():
            out += [Rows(file, at, min(at + self.rows, last)) for at in range(start.get(file, 0), last, self.rows)]
        return out

    def read(self, partition: Rows) -> Iterator:
        import pyarrow.parquet as pq

        store, folder = _store(self.path)
        at = 0
        with store.open_input_file(f"{folder}/{partition.file}") as f:
            source = pq.ParquetFile(f)
            for group in range(source.num_row_groups):
                size = source.metadata.row_group(group).num_rows
                if at < partition.last and at + size > partition.first:
                    table = source.read_row_group(group, self.names).slice(max(0, partition.first - at))
                    yield from table.slice(0, partition.last - max(at, partition.first)).to_batches()
                at += size


class PageSource(DataSource):
    """``spark.readStream.format("collected_pages").load(folder)``; option ``rows``: those of one task at most."""

    @classmethod
    def name(cls) -> str:
        return "collected_pages"

    def schema(self) -> str:
        return PAGE

    def streamReader(self, schema) -> PageReader:
        return PageReader(self.options["path"], schema.names, int(self.options.get("rows", ROWS)))


def pages(spark: SparkSession, folder: str, rows: int = ROWS) -> DataFrame:
    spark.dataSource.register(PageSource)
    return spark.readStream.format("collected_pages").option("rows", rows).load(folder)


def articles(rows: DataFrame, least: int = 0) -> DataFrame:
    """title, content, url and category (the first part of the path, else ``other``) of pages whose content has ``least`` characters."""
    gone = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style|nav|footer)\b.*?</\1\s*>", " ")
    content = F.trim(F.regexp_replace(F.regexp_replace(gone, r"(?s)<[^>]*>", " "), r"\s+", " "))
    title = F.regexp_extract(F.coalesce("html", F.lit("")), r"(?is)<title>(.*?)</title>", 1)
    category = F.regexp_extract(F.coalesce("url", F.lit("")), r"^https?://[^/]+/([^/?#]+)", 1)
    out = rows.select("page_id", "url", title.alias("title"), content.alias("content"), F.when(category == "", "other").otherwise(F.lower(category)).alias("category"))
    return out.where(F.length("content") >= least)


def collect(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """What has come since the last run, as JSON lines by category and cycle. A cycle that was cut off is written again in the same place."""

    def cycle(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("cycle", F.lit(number))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("category", "cycle").json(path)

    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(cycle).start()
    query.awaitTermination()
    return query


COUNTS = "items long, bytes long, errors long, cycles long"


def count_cycle(idle_seconds: float | None):
    """Totals of a source since the first run: each cycle that has its rows adds to all of them; without rows for the idle time it is reported as idle."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        items, size, errors, cycles = state.get if state.exists else (0, 0, 0, 0)
        idle = idle_seconds is not None and state.hasTimedOut
        if not idle:
            for b in batches:
                items, size, errors = items + len(b), size + int(b["size"].sum()), errors + int(b["error"].sum())
            cycles += 1
            state.update((items, size, errors, cycles))
        if idle_seconds is not None:
            state.setTimeoutDuration(int(idle_seconds * 1000))
        yield pd.DataFrame([(*key, items, size, errors, cycles, idle)], columns=["source", "items", "bytes", "errors", "cycles", "idle"])

    return run


def cycle_counters(stream: DataFrame, source: Column, size: Column, error: Column, idle_seconds: float | None = None) -> DataFrame:
    """items, bytes, errors and cycles of each source over all runs, in update mode.

    With ``idle_seconds``, for a collector that goes on, a timer reports a source without rows as idle; a run that is to end takes none, as timers keep it going.
    """
    rows = stream.select(F.coalesce(source, F.lit("")).alias("source"), F.coalesce(size, F.lit(0)).cast("long").alias("size"), F.coalesce(error, F.lit(False)).alias("error"))
    timeout = "NoTimeout" if idle_seconds is None else "ProcessingTimeTimeout"
    return rows.groupBy("source").applyInPandasWithState(count_cycle(idle_seconds), f"source string, {COUNTS}, idle boolean", COUNTS, "update", timeout)


PROGRESS = "query string, run string, batch long, at timestamp, input_rows long, input_per_second double, processed_per_second double, state_rows long, seconds double"


class ProgressRows(StreamingQueryListener):
    """Writes a row for each finished trigger of each query, as one JSON file, for dashboards that poll the folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = spark._jvm.org.apache.hadoop.fs.Path(folder)
        self.files = self.folder.getFileSystem(spark._jsc.hadoopConfiguration())
        self.files.mkdirs(self.folder)
        self.path = spark._jvm.org.apache.hadoop.fs.Path

    @staticmethod
    def row(p) -> dict:
        state = sum(o.numRowsTotal for o in p.stateOperators)
        return {
            "query": p.name or str(p.id), "run": str(p.runId), "batch": p.batchId, "at": p.timestamp, "input_rows": p.numInputRows, "input_per_second": _finite(p.inputRowsPerSecond),
            "processed_per_second": _finite(p.processedRowsPerSecond), "state_rows": state, "seconds": p.durationMs.get("triggerExecution", 0) / 1000,
        }

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        out = self.files.create(self.path(self.folder, f"{uuid.uuid4().hex}.json"), True)
        out.write(bytearray((json.dumps(self.row(event.progress)) + "\n").encode()))
        out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def _finite(x: float) -> float:
    return x if x == x and abs(x) != float("inf") else 0.0


def dashboard(spark: SparkSession, folder: str) -> DataFrame:
    """Of each query: triggers, rows, rows an hour of processing, rows of state and the time of the last trigger."""
    rows = spark.read.schema(PROGRESS).json(folder)
    hours = F.sum("seconds") / 3600
    return rows.groupBy("query").agg(
        F.count(F.lit(1)).alias("triggers"), F.sum("input_rows").alias("input_rows"), F.coalesce(F.try_divide(F.sum("input_rows"), hours), F.lit(0.0)).alias("rows_per_hour"),
        F.max_by("state_rows", "at").alias("state_rows"), F.max("at").alias("last"),
    )
