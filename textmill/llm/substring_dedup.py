"""Repeated substrings by column-wise construction over many strings.

Every 100-byte window of a text belongs to its minimizer: the 32-byte gram of smallest hash inside it (the leftmost of equals).
Consecutive windows with one minimizer form a segment, and two equal windows have equal minimizers at equal places.
So the strings that are built together are the segments of a minimizer, aligned at it:

* a minimizer with one segment has no repeated window;
* equal strings are inserted once: the first one stands for them, and of the others every window is repeated. They are found by a
  64-bit hash of their bytes, first within a block of rows and then over all, so very common lines and copies are aggregated before the shuffle;
* the different strings of a minimizer are inserted a column at a time, from the right: each round reads one column of a
  sequential file in the shared folder, puts one symbol of every string at the string's place in the transform, and moves the strings by
  a stable count of the symbols; common prefixes of neighbours are updated from those of the round before by range minima. Neighbours with a common
  prefix of 100 bytes are equal windows; all but the first in document order are repeated.

A minimizer with very many different segments (the edge of a passage that a large part of the documents shares) would be one
large group. So segments are counted first, by a part of the minimizer's hash; those of a part with more than ``total / PARTS`` segments
are taken apart into their windows, each of which is a string that is grouped by its own hash. The number of such parts is at most ``PARTS``, whatever the input.

A document is a row, known by its id and a hash of its text; documents are ordered by id and then by that hash.

Cases: null texts are empty; texts under 100 bytes lose nothing; null ids come before all others; rows with one id and different texts are
different documents; rows with equal id and text are one document, and each gets its result; a very long text is cut into overlapping slices at work, with the same result;
further columns, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmill.llm.common import base_documents, materialize, remove, shared_dir, store

LENGTH = 100
GRAM = 32
WIDTH = LENGTH - GRAM + 1
#: Bytes of a text handled at once; the next slice begins LENGTH - 1 bytes before the end of the last.
SLICE = 1 << 20
#: Texts are handled end to end until they have so many bytes.
GROUP = 1 << 17
#: Strings that are built together, if their minimizers allow.
STRINGS = 40_000
#: Columns: up to WIDTH - 1 bytes before the minimizer, GRAM, and WIDTH - 1 after.
COLUMNS = 2 * (WIDTH - 1) + GRAM
#: Stands for a null id; told from a real id of this value by the sign of the text's hash.
NULL_ID = -(1 << 63)
#: Bits of a minimizer's hash by which segments are counted.
PART_BITS = 20
#: A part with more segments than this, and than total / PARTS, is taken apart.
LEAST_LARGE, PARTS = 256, 20_000
#: Rows of a block.
BLOCK = 400_000

_RNG = np.random.default_rng(77)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = _RNG.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64((1 << 24) - 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _content(grams: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from ``start``, of ``size`` (at least GRAM) each, from the hashes of all grams: those that lie end to end, and the last."""
    out = size.astype(np.uint64) * _STEP[8]
    for k in range(int(size.max(initial=0)) // GRAM):
        inside = (k + 1) * GRAM <= size
        at = np.where(inside, start + k * GRAM, start)
        out = np.where(inside, _mixed((out ^ grams[at]) * _STEP[9]), out)
    return _mixed((out ^ grams[start + size - GRAM]) * _STEP[10])


def groups(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of several texts or slices end to end; of each the row, its offset in the text, and its size."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        row, at = (np.array([h[k] for h in held], np.int64) for k in (0, 1))
        return np.frombuffer(b"".join(h[2] for h in held), np.uint8), row, at, np.array([len(h[2]) for h in held])

    for i, text in enumerate(texts):
        data = (text.as_py() or "").encode("utf-8", "surrogatepass")
        for at in range(0, len(data) - LENGTH + 1, SLICE):
            held.append((i, at, data[at : at + SLICE + LENGTH - 1]))
            size += len(held[-1][2])
            if size > GROUP:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def segments(raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """start (in ``raw``), windows, minimizer hash and place (from start), text and content of each segment, and the hashes of all grams."""
    h, span = _BYTE[raw], 1
    for step in _STEP[: GRAM.bit_length() - 1]:
        h = h[:-span] * step + (h[span:] ^ (h[span:] >> np.uint64(29)))
        span *= 2
    grams = _mixed(h)
    low = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= WIDTH:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < WIDTH:
        low = np.minimum(low[: len(low) - (WIDTH - span)], low[WIDTH - span :])
    place = (low & _PLACE).astype(np.int64)
    windows = sizes - LENGTH + 1
    ends = np.cumsum(sizes)
    if len(sizes) > 1:  # windows that lie in one text
        own = np.arange(windows.sum()) + np.repeat((ends - sizes) - (np.cumsum(windows) - windows), windows)
        place = place[own]
    else:
        own = np.arange(len(place))
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    start, count = own[first], np.diff(np.append(first, len(place)))
    text = np.searchsorted(ends, start, side="right")
    return start, count, grams[place[first]], place[first] - start, text, _content(grams, start, count + LENGTH - 1), grams


def part(mini: np.ndarray) -> np.ndarray:
    return (mini >> np.uint64(64 - PART_BITS)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """part and number of the different segments in it, summed over blocks."""
    total = np.zeros(1 << PART_BITS, np.int64)
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def settle() -> None:
        if held:
            mini, both = (np.concatenate(c) for c in zip(*held, strict=True))
            once = np.unique(both, return_index=True)[1]
            np.add.at(total, part(mini[once]), 1)
            held.clear()

    rows = 0
    for batch in batches:
        for raw, _, _, sizes in groups(batch.column(0)):
            _, _, mini, _, _, content, _ = segments(raw, sizes)
            held.append((mini, _mixed(mini * _STEP[11] ^ content)))
            rows += len(mini)
            if rows > BLOCK:
                settle()
                rows = 0
    settle()
    here = np.flatnonzero(total)
    yield pa.record_batch([pa.array(here), pa.array(total[here])], names=["part", "n"])


def large_parts(docs: DataFrame) -> np.ndarray:
    """Parts whose segments are taken apart: at most ``PARTS`` numbers."""
    counts = docs.select("text").mapInArrow(_counts, "part long, n long").groupBy("part").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "parts")  # 2**PART_BITS rows at most
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = np.array(sorted(r[0] for r in counts.where(F.col("n") > max(LEAST_LARGE, total // PARTS)).select("part").collect()), np.int64)
    remove(counts)
    return found


ROW = "mini long, content long, id long, sub long, start long, size long, known long"


def _combined(mini: np.ndarray, content: np.ndarray, document: np.ndarray, start: np.ndarray, size: np.ndarray, ids: np.ndarray, subs: np.ndarray) -> pa.RecordBatch:
    """Rows of one block; of equal segments all but the first are marked as repeated, and get a key of their own that spreads them.

    ``document`` is a place in ``ids`` and ``subs``.
    """
    rank = np.empty(len(ids), np.int64)
    order = np.lexsort((subs, ids))
    rank[order] = np.cumsum(np.r_[False, (np.diff(ids[order]) != 0) | (np.diff(subs[order]) != 0)])
    place = (rank[document].astype(np.uint64) << np.uint64(40)) | start.astype(np.uint64)
    both = _mixed(mini * _STEP[11] ^ content)
    order = np.lexsort((place, both))
    mini, content, document, start, size, place, both = (c[order] for c in (mini, content, document, start, size, place, both))
    fresh = np.r_[True, both[1:] != both[:-1]]
    keep = fresh | np.r_[True, place[1:] != place[:-1]]  # else the same row once more
    spread = _mixed((ids[document].view(np.uint64) ^ subs[document].view(np.uint64)) * _STEP[6] + start.astype(np.uint64) * _STEP[7])
    columns = (np.where(fresh, mini, spread).view(np.int64), content.view(np.int64), ids[document], subs[document], start, size, (~fresh).astype(np.int64))
    return pa.record_batch([pa.array(c[keep]) for c in columns], names=["mini", "content", "id", "sub", "start", "size", "known"])


def _found(large: np.ndarray):
    """A row for each segment: minimizer, content hash, document, start, windows and place of the minimizer (packed), known to be repeated.

    Segments of the parts ``large`` are given as windows, whose own hash stands for minimizer and content.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, subs = (batch.column(k).to_numpy() for k in (0, 1))
            held: list[list[np.ndarray]] = [[], [], [], [], []]
            rows = 0
            for raw, row, at, sizes in groups(batch.column(2)):
                start, windows, mini, place, text, content, grams = segments(raw, sizes)
                size = (windows << 8) | place
                apart = np.isin(part(mini), large)
                if apart.any():
                    n = windows[apart]
                    own = np.repeat(start[apart], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    window = _content(grams, own, np.full(len(own), LENGTH))
                    start, size, text = np.r_[start[~apart], own], np.r_[size[~apart], np.full(len(own), 1 << 8)], np.r_[text[~apart], np.repeat(text[apart], n)]
                    mini, content = np.r_[mini[~apart], window], np.r_[content[~apart], window]
                offset = at - (np.cumsum(sizes) - sizes)
                for column, v in zip(held, (mini, content, row[text], start + offset[text], size), strict=True):
                    column.append(v)
                rows += len(start)
                if rows > BLOCK:
                    yield _combined(*[np.concatenate(c) for c in held], ids, subs)
                    held, rows = [[], [], [], [], []], 0
            if rows:
                yield _combined(*[np.concatenate(c) for c in held], ids, subs)

    return run


STRING = "mini long, id long, sub long, start long, windows int, place int, bytes binary"


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the segments that are to be compared, from (id, sub, text, list of (start, size, mini))."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    names = ["mini", "id", "sub", "start", "windows", "place", "bytes"]
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            data = (batch.column(2)[i].as_py() or "").encode("utf-8", "surrogatepass")
            key = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            for s in batch.column(3)[i].as_py():
                windows = s["size"] >> 8
                rows.append((s["mini"], *key, s["start"], windows, s["size"] & 255, data[s["start"] : s["start"] + windows + LENGTH - 1]))
            if len(rows) > 20_000 or i == batch.num_rows - 1:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 7, kinds, strict=True)], names=names)
                rows = []


def _range_minimum(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low .. high]) of each pair, from a table of minima of powers of two."""
    size = high - low + 1
    power = np.frexp(size)[1] - 1
    out = np.empty(len(low), values.dtype)
    row, top = values, int(power.max(initial=0))
    for p in range(top + 1):
        here = np.flatnonzero(power == p)
        out[here] = np.minimum(row[low[here]], row[high[here] - (1 << p) + 1])
        if p < top:
            row = np.minimum(row[: len(row) - (1 << p)], row[1 << p :])
    return out


def repeated_windows(group: np.ndarray, order_key: np.ndarray, column, begin: np.ndarray, windows: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """(strings, column) pairs of windows that occur earlier.

    ``column(x)`` reads the symbols of every string in column ``x``; a string's windows start in columns ``begin`` to
    ``begin + windows - 1``. Strings of different groups are never compared; ``order_key`` gives the document order of
    the strings' first bytes, as (document, start) pairs.
    """
    out = []
    order = np.argsort(group, kind="stable")  # the string at each place
    place = np.empty_like(order)  # the place of each string
    place[order] = np.arange(len(order))
    own = group[order].astype(np.int64) * 256  # strings move within their groups only
    prefix = np.zeros(len(group), np.uint8)  # common prefix with the string before in order, at most LENGTH
    transform = np.empty(len(group), np.int64)
    for x in range(COLUMNS - 1, -1, -1):
        transform[place] = column(x)  # a symbol of every string, in the order of what follows it
        key = own + transform
        move = np.argsort(key, kind="stable")
        same = np.r_[False, key[move][1:] == key[move][:-1]]
        at = np.flatnonzero(same)
        fresh = np.zeros(len(order), np.uint8)
        if len(at):
            fresh[at] = np.minimum(_range_minimum(prefix, move[at - 1] + 1, move[at]), LENGTH - 1) + 1
        order, prefix = order[move], fresh
        place[order] = np.arange(len(order))
        if x > COLUMNS - LENGTH:
            continue
        valid = (begin[order] <= x) & (x < begin[order] + windows[order])
        chain = np.cumsum(prefix < LENGTH)  # equal windows have equal numbers
        here = np.flatnonzero(valid)
        if not len(here):
            continue
        strings = order[here]
        chain, document, start = chain[here], order_key[strings, 0], order_key[strings, 1] + (x - begin[strings])
        by = np.lexsort((start, document, chain))
        new = np.r_[True, chain[by][1:] != chain[by][:-1]]
        first = by[np.flatnonzero(new)[np.cumsum(new) - 1]]
        repeated = (document[by] != document[first]) | (start[by] != start[first])  # a repeated row is the same place once more
        if repeated.any():
            out.append((strings[by[repeated]], x))
    return out


def _compared(folder: str):
    """id, sub, start, windows of repeated windows, from strings sorted by minimizer; groups are kept whole."""

    def solve(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(tables)
        mini, ids, subs, start, windows, place = (table.column(i).to_numpy() for i in range(6))
        begin = WIDTH - 1 - place.astype(np.int64)
        group = np.unique(mini, return_inverse=True)[1]
        documents = np.empty(len(ids), np.int64)
        order = np.lexsort((subs, ids))
        documents[order] = np.cumsum(np.r_[False, (np.diff(ids[order]) != 0) | (np.diff(subs[order]) != 0)])
        strings = table.column(6).to_pylist()
        ends = np.cumsum([0, *map(len, strings)])
        raw = np.frombuffer(b"".join(strings), np.uint8)
        files, top = store(folder)
        name = f"{top}/columns-{uuid.uuid4().hex}"
        files.create_dir(top, recursive=True)
        try:
            with files.open_output_stream(name) as f:
                for x in range(COLUMNS):
                    symbols = np.zeros(len(mini), np.uint8)
                    inside = (x >= begin) & (x < begin + np.diff(ends))
                    symbols[inside] = raw[(ends[:-1] + x - begin)[inside]]
                    f.write(symbols.tobytes())
            with files.open_input_file(name) as f:
                column = lambda x: np.frombuffer(f.read_at(len(mini), x * len(mini)), np.uint8)
                hits = repeated_windows(group, np.stack([documents, start], 1), column, begin, windows.astype(np.int64))
        finally:
            files.delete_file(name)
        if not hits:
            return pa.record_batch([pa.array([], pa.int64())] * 4, names=["id", "sub", "start", "windows"])
        string = np.concatenate([h[0] for h in hits])
        at = start[string] + np.concatenate([np.full(len(h[0]), h[1]) for h in hits]) - begin[string]
        order = np.lexsort((at, string))
        string, at = string[order], at[order]
        first = np.r_[True, (np.diff(string) != 0) | (np.diff(at) != 1)]
        runs = np.flatnonzero(first)
        return pa.record_batch([pa.array(c) for c in (ids[string[runs]], subs[string[runs]], at[runs], np.diff(np.r_[runs, len(at)]))], names=["id", "sub", "start", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if rows >= STRINGS:  # the last group may go on in this batch
                last = held[-1].column(0)[-1].as_py()
                cut = int(np.searchsorted(batch.column(0).to_numpy(), last, side="right"))
                held.append(batch.slice(0, cut))
                batch = batch.slice(cut)
                if batch.num_rows:
                    yield solve(held)
                    held, rows = [], 0
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
        if held:
            yield solve(held)

    return run


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n_bytes, n_removed, n_spans, kept (bytes) from (id, text, runs of repeated windows)."""
    for batch in batches:
        out: list[list] = [[], [], [], []]
        size = 0
        ids = []
        for i in range(batch.num_rows):
            data = (batch.column(1)[i].as_py() or "").encode("utf-8", "surrogatepass")
            spans: list[list[int]] = []
            for a, b in sorted((r["start"], r["start"] + r["windows"] + LENGTH - 1) for r in batch.column(2)[i].as_py() or ()):
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = max(b, spans[-1][1])
                else:
                    spans.append([a, b])
            edges = [0, *[x for s in spans for x in s], len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            ids.append(batch.column(0)[i].as_py())
            for column, v in zip(out, (len(data), len(data) - len(kept), len(spans), kept), strict=True):
                column.append(v)
            size += len(kept)
            if size > 1 << 23 or i == batch.num_rows - 1:
                yield pa.record_batch([pa.array(ids, pa.int64()), *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.binary())], names=["id", "n_bytes", "n_removed", "n_spans", "kept"])
                ids, out, size = [], [[], [], [], []], 0


def repeated_runs(docs: DataFrame) -> DataFrame:
    """id, sub, start, windows: runs of windows of ``docs`` (id, sub, text) that occur earlier."""
    found = docs.mapInArrow(_found(large_parts(docs)), ROW)
    own = Window.partitionBy("mini")
    ordered = own.orderBy("content", "id", "sub", "start")
    before = F.lag(F.struct("content", "id", "sub", "start")).over(ordered)
    found = found.withColumns({"before": before, "least": F.min("content").over(own), "most": F.max("content").over(own)})
    same = F.col("before.content") == F.col("content")
    again = same & (F.col("before.id") == F.col("id")) & (F.col("before.sub") == F.col("sub")) & (F.col("before.start") == F.col("start"))  # the same row once more
    found = found.withColumn("kind", F.when(F.col("known") == 1, 1).when(again, 0).when(same, 1).when(F.col("least") != F.col("most"), 2).otherwise(0)).where("kind > 0")
    found = materialize(found.select("mini", "id", "sub", "start", "size", "kind"), "segments")
    wanted = found.where("kind = 2").groupBy("id", "sub").agg(F.collect_list(F.struct("start", "size", "mini")).alias("segments"))
    strings = docs.join(wanted, ["id", "sub"]).select("id", "sub", "text", "segments").mapInArrow(_strings, STRING)
    folder = f"{shared_dir(docs.sparkSession)}/columns-{uuid.uuid4().hex}"
    compared = strings.repartition(F.col("mini")).sortWithinPartitions("mini").mapInArrow(_compared(folder), "id long, sub long, start long, windows long")
    whole = found.where("kind = 1").select("id", "sub", "start", F.shiftright("size", 8).alias("windows"))
    return whole.union(compared)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans and the kept bytes of every row of ``docs``."""
    own = F.xxhash64(F.col(text))
    sub = F.when(F.col(key).isNull(), own.bitwiseOR(F.lit(NULL_ID))).otherwise(own.bitwiseAND(F.lit((1 << 63) - 1)))
    docs = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)).alias("id"), sub.alias("sub"), F.col(text).alias("text"))
    runs = repeated_runs(docs).groupBy("id", "sub").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))
    rows = docs.join(runs, ["id", "sub"], "left").select(F.when((F.col("sub") >= 0) | (F.col("id") != NULL_ID), F.col("id")).alias("id"), "text", "runs")
    return rows.mapInArrow(_removed, "id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op4_column_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(base_documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def plain(texts: list[tuple[int, str | None]]) -> list[tuple[int, int, int, int, str]]:
    """The same by brute force, for tests; ``texts`` in document order, keys of any kind."""
    first: dict[bytes, tuple] = {}
    out = []
    for i, text in texts:
        d = (text or "").encode()
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - LENGTH + 1):
            if first.setdefault(d[p : p + LENGTH], (i, p)) != (i, p):
                gone[p : p + LENGTH] = True
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        out.append((i, len(d), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out
