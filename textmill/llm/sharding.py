"""Consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into ``2**cell_bits`` cells. A shard owns ``vnodes`` virtual nodes, each at the start
of a cell given by the MD5 of ``"<shard>#<replica>"``; a row's cell comes from the MD5 of its key. A row
goes to the first virtual node clockwise from its cell, unless that shard is full, and then on clockwise
to the next shard that has room.

Keys are placed in ring order, in rounds: in round ``d`` each cell offers the rows that are still
unplaced to its ``d``-th distinct shard clockwise, and a shard takes cells in ring order until it is
full. This depends only on the number of rows in each cell, so the plan is made from one small count
table (``2**cell_bits`` rows at most, whatever the size of the input) and rows are then placed by a
broadcast join with that plan. Capacities are exact: ``n // shards`` rows, and one more for the first
``n % shards`` shards. So counts are at most one apart (law ``rows``).

Cases: an empty table gives no rows; a null key hashes as the empty string; rows with equal keys
share a cell and are told apart by the given tie columns (fully equal rows are interchangeable); texts are not read, so their length does not matter;
other columns are kept, whatever their names, but for ``shard``, ``slot`` and ``home_shard``, which the result takes.
"""

from __future__ import annotations

import bisect
import hashlib
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmill.llm.common import base_documents

CELL_BITS = 16
VNODES = 128
SHARDS = 8
#: A cell with more rows than this, and than this share of all, is ranked in so many parts.
LEAST_LARGE, LARGE, RANKED = 10_000, 1e-3, 64


def ring_nodes(shards: int, vnodes: int = VNODES, bits: int = CELL_BITS) -> list[tuple[int, int]]:
    """(cell, shard) of the virtual nodes, in ring order; of two on one cell the smaller shard comes first."""
    return sorted((int(hashlib.md5(f"{s}#{r}".encode()).hexdigest()[:8], 16) >> (32 - bits), s) for s in range(shards) for r in range(vnodes))


def clockwise(ring: list[int], at: int) -> Iterator[int]:
    """The distinct shards from place ``at`` of the ring on, each found only when it is asked for."""
    seen: set[int] = set()
    for i in range(at, at + len(ring)):
        shard = ring[i % len(ring)]
        if shard not in seen:
            seen.add(shard)
            yield shard


def ring_plan(counts: dict[int, int], shards: int, vnodes: int = VNODES, bits: int = CELL_BITS) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (cell, lo, hi, home, shard, base) from the number of rows in each cell.

    Rows ``lo`` to ``hi - 1`` of the cell, in key order, go to ``shard``, which gives them slots from ``base``.
    """
    nodes = ring_nodes(shards, vnodes, bits)
    cells, ring = [c for c, _ in nodes], [s for _, s in nodes]
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    waiting = [(c, clockwise(ring, bisect.bisect_left(cells, c) % len(cells))) for c in sorted(counts)]
    done, home = dict.fromkeys(counts, 0), {}
    parts: list[tuple[int, int, int, int, int]] = []
    while waiting:  # only cells with rows left take another turn
        for c, turns in waiting:
            s = next(turns)
            home.setdefault(c, s)
            if take := min(counts[c] - done[c], room[s]):
                parts.append((c, done[c], done[c] + take, home[c], s))
                done[c] += take
                room[s] -= take
        waiting = [w for w in waiting if done[w[0]] < counts[w[0]]]
    used = [0] * shards
    plan = []
    for c, lo, hi, home, s in sorted(parts):
        plan.append((c, lo, hi, home, s, used[s]))
        used[s] += hi - lo
    return plan


def shard_rows(df: DataFrame, key: str, shards: int = SHARDS, vnodes: int = VNODES, bits: int = CELL_BITS, ties: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with shard, slot and home_shard (the owner if there were no bounds), which take the place of columns of these names."""
    spark, names = df.sparkSession, df.columns
    own = {c: f"c{i}" for i, c in enumerate(names)}
    digest = F.md5(F.coalesce(F.col(own[key]).cast("string"), F.lit("")).cast("binary"))
    placed = df.withColumnsRenamed(own).withColumn("key", digest)
    placed = placed.withColumn("cell", F.shiftright(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), 32 - bits).cast("int"))
    # At most 2**bits rows reach the driver.
    counts = {r[0]: r[1] for r in placed.groupBy("cell").count().collect()}
    columns = ("cell", "lo", "hi", "home_shard", "shard", "base")
    text = json.dumps([dict(zip(columns, row, strict=True)) for row in ring_plan(counts, shards, vnodes, bits)])
    schema = "array<struct<cell:int,lo:long,hi:long,home_shard:int,shard:int,base:long>>"
    plan = spark.range(1).select(F.inline(F.from_json(F.lit(text), schema))).withColumnRenamed("cell", "plan_cell")
    # A cell with very many rows (a key that is null or repeated) is ranked in parts, by a hash of the ties; 1 / LARGE cells at most.
    most = max(LEAST_LARGE, int(LARGE * sum(counts.values())))
    large = [c for c, n in counts.items() if n > most]
    tie = [own[t] for t in ties]
    part = F.when(F.col("cell").isin(large), F.pmod(F.xxhash64(*tie), F.lit(RANKED))).otherwise(F.lit(0)) if large and tie else F.lit(0)
    placed = placed.withColumn("part", part.cast("int"))
    rank = F.row_number().over(Window.partitionBy("cell", "part").orderBy("key", own[key], *tie)) - 1
    placed = placed.withColumn("rank", rank.cast("long"))
    if large and tie:
        sizes = placed.where(F.col("cell").isin(large)).groupBy("cell", "part").count()
        before = F.sum("count").over(Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
        sizes = sizes.select(F.col("cell").alias("large_cell"), F.col("part").alias("large_part"), F.coalesce(before, F.lit(0)).alias("before"))
        placed = placed.join(F.broadcast(sizes), (F.col("cell") == F.col("large_cell")) & (F.col("part") == F.col("large_part")), "left")  # RANKED / LARGE rows at most
        placed = placed.withColumn("rank", F.col("rank") + F.coalesce("before", F.lit(0)))
    inside = (F.col("cell") == F.col("plan_cell")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    out = placed.join(F.broadcast(plan), inside).withColumn("slot", F.col("base") + F.col("rank") - F.col("lo"))
    kept = [F.col(own[c]).alias(c) for c in names if c not in ("shard", "slot", "home_shard")]
    return out.select(*kept, "shard", "slot", "home_shard")


def op2_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base_documents(spark, sf_dir)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = shard_rows(rows, "doc_id", ties=("size", "text_crc32"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home_shard")
