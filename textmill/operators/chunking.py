"""Greedy chunks in parallel.

Where a chunk closes depends on all earlier rows of its group, but what a block of rows does to the running size is a step function: the size that comes in decides the
first cut, and from there on everything is settled. So each range of rows is summarised as (size in -> cuts, size out), the summaries are put together in order, one for each range, and each range then
numbers its rows from the size and number that come in.

Sizes are whole numbers of 0 or more, null counts as 0. Null groups are a group of their own. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.training.types import kept


class Summary:
    """What consecutive rows do: for a size that comes in, the cuts and the size that goes out."""

    def __init__(self, sizes: np.ndarray, limit: int, close_before: bool):
        n, p = len(sizes), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        self.whole, rows = int(p[-1]), np.arange(n)
        # The next cut after one at row i, where a chunk begins with that row's size.
        if close_before:
            after = np.maximum(np.searchsorted(p, limit + p[:-1], side="right") - 1, np.searchsorted(p, p[:-1], side="right"))
        else:
            after = np.searchsorted(p, limit + p[:-1], side="left")
        after = np.minimum(np.maximum(after, rows + 1), n).tolist()
        cuts, out, total = [0] * (n + 1), [0] * (n + 1), p.tolist()
        for i in range(n - 1, -1, -1):
            cuts[i], out[i] = (1, total[n] - total[i]) if after[i] >= n else (cuts[after[i]] + 1, out[after[i]])
        # Row j is cut for sizes above its threshold; those of later rows are lower, and the first row that is cut counts.
        thresholds = (limit - p[1:] if close_before else limit - p[:-1] - 1).tolist()
        last = next((j for j, t in enumerate(thresholds) if t < 0), n - 1)
        steps: list[tuple[int, int, int]] = []  # by falling threshold
        for j in range(min(last, n - 1) + 1):
            if steps and steps[-1][1:] == (cuts[j], out[j]):
                steps.pop()
            steps.append((thresholds[j], cuts[j], out[j]))
        self.steps = steps[::-1]
        # Nothing so far never closes a chunk before a row.
        first = next((j for j in range(n) if total[j] > 0 and total[j + 1] > limit), None) if close_before else 0 if limit <= 0 and n else None
        self.empty = (0, self.whole) if first is None else (cuts[first], out[first])
        if not close_before and limit > 0:
            self.empty = self._of(0)

    def _of(self, size: int) -> tuple[int, int]:
        at = bisect_left(self.steps, (size, -1, -1))  # the steps before it have a lower threshold
        return self.steps[at - 1][1:] if at else (0, size + self.whole)

    def __call__(self, size: int) -> tuple[int, int]:
        return self._of(size) if size else self.empty


def number(sizes: list[int], limit: int, close_before: bool, size: int, chunk: int) -> tuple[list[int], int, int]:
    """Chunk numbers of rows from the size and number that come in, and those that go out."""
    out = []
    for n in sizes:
        if (size and size + n > limit) if close_before else size >= limit:
            size, chunk = 0, chunk + 1
        size += n
        out.append(chunk)
    return out, size, chunk


def greedy_chunks(df: DataFrame, group: str, order: list[str], size: str, limit: int, close_before: bool = True) -> DataFrame:
    """``df`` with ``chunk`` (from 1): rows in order, a chunk closed before it would exceed ``limit`` (or after reaching it)."""
    whole = F.coalesce(F.col(size).cast("long"), F.lit(0))
    rows = df.repartitionByRange(group, *order).withColumns({"__part": F.spark_partition_id(), "__size": whole}).sortWithinPartitions(group, *order)
    rows = kept(rows)

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Of each range: whether it has one group, the groups at its ends, and what its last group does."""
        groups, parts, first, one = [], [], None, True
        part = None
        for batch in batches:
            if not len(batch):
                continue
            part = int(batch["__part"].iloc[0])
            keys = [None if pd.isna(g) else g for g in batch[group]]
            first = (keys[0],) if first is None else first
            starts = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
            if groups and groups[-1] != keys[0]:
                groups, parts, one = [], [], False
            if starts:
                groups, parts, one = [], [], False
            groups.append(keys[-1])
            parts.append(batch["__size"].to_numpy()[starts[-1] if starts else 0 :])
        if part is not None:
            found = Summary(np.concatenate(parts), limit, close_before)
            steps = found.steps if one else []  # a group that begins in the range has nothing coming in
            lists = [[s[i] for s in steps] for i in range(3)]
            yield pd.DataFrame([(part, one, first[0], groups[-1], found.whole, *found.empty, *lists)], columns=_SUMMARY_COLUMNS)

    kind = dict(df.dtypes)[group]
    schema = f"part int, one boolean, first {kind}, last {kind}, whole long, empty_cuts long, empty_out long, thresholds array<long>, cuts array<long>, outs array<long>"
    summaries = rows.select("__part", group, "__size").mapInPandas(summed, schema)
    begins: dict[int, tuple[int, int]] = {}
    at: tuple = ()  # the group that goes on, its size and number
    for r in summaries.orderBy("part").toLocalIterator():  # one row for each range
        if at and at[0] == r["first"]:
            begins[r["part"]] = at[1:]
        came = at[1:] if at and r["one"] and at[0] == r["first"] else (0, 1)
        more = Summary.__new__(Summary)
        more.whole, more.empty, more.steps = r["whole"], (r["empty_cuts"], r["empty_out"]), list(zip(r["thresholds"], r["cuts"], r["outs"], strict=True))
        cuts, out = more(came[0])
        at = (r["last"], out, came[1] + cuts)
    shared = df.sparkSession.sparkContext.broadcast(begins)  # two numbers for each range
    fields = T.StructType([*df.schema.fields, T.StructField("chunk", T.IntegerType())])

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple = ()
        now, chunk = 0, 1
        for batch in batches:
            out: list[int] = []
            keys = [None if pd.isna(g) else g for g in batch[group]]
            sizes, start = batch["__size"].tolist(), 0
            for end in [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]] + [len(keys)]:
                if end == start:
                    continue
                if not last:
                    now, chunk = shared.value.get(int(batch["__part"].iloc[0]), (0, 1))
                elif last[0] != keys[start]:
                    now, chunk = 0, 1
                own, now, chunk = number(sizes[start:end], limit, close_before, now, chunk)
                out += own
                last, start = (keys[start],), end
            yield batch.drop(columns=["__part", "__size"]).assign(chunk=pd.Series(out, dtype="int32", index=batch.index))

    return rows.mapInPandas(numbered, fields)


_SUMMARY_COLUMNS = ["part", "one", "first", "last", "whole", "empty_cuts", "empty_out", "thresholds", "cuts", "outs"]
