"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import materialize, remove

#: A node with more edges than this, and than edges / PARTS, is joined by broadcast; so fewer than PARTS are.
LEAST_LARGE, PARTS = 2_048, 10_000


def _least(edges: DataFrame) -> DataFrame:
    """u, m (the smallest of u and its neighbours v) and edges, of each node; the minima are pre-aggregated."""
    return materialize(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("edges")), "least")


def _with_least(edges: DataFrame, least: DataFrame, count: int, most_of_one: int) -> DataFrame:
    """u, v and m of u, with ``least`` of the ``count`` edges, of which a node has ``most_of_one`` at most.

    Edges of nodes with very many meet them by broadcast, where they lie; only the others are dealt by node.
    """
    most = max(LEAST_LARGE, count // PARTS)
    if most_of_one <= most:
        return edges.join(least.select("u", "m"), "u")
    hubs = F.broadcast(least.where(F.col("edges") > most).select("u", F.col("m").alias("hub")))  # each has more than count / PARTS edges
    told = edges.join(hubs, "u", "left")
    few = told.where(F.col("hub").isNull()).select("u", "v").join(least.where(F.col("edges") <= most).select("u", "m"), "u")
    return few.union(told.where(F.col("hub").isNotNull()).select("u", "v", F.col("hub").alias("m")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (two long columns, in any order) but the roots; root is the smallest node reachable.

    Alternating large-star and small-star steps, until all components are stars. The minima and each step are written to the shared folder, where a few tasks read
    them again, so that a step's plan stays small: Spark keeps the plans of a session's last thousand queries on the driver. What a step has read is removed. Edges
    with a null end are left out, as are loops; repeated edges count once; an empty table gives no rows.
    """
    u, v = edges.columns
    pairs = edges.where(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
    pairs = materialize(pairs, "edges")
    while True:
        both = pairs.union(pairs.select("v", "u"))
        least = _least(both)
        # A node that is not the smallest around has one edge, then, and that leads to one which is.
        ends, top, open_ = least.agg(F.sum("edges"), F.max("edges"), F.count_if((F.col("m") < F.col("u")) & (F.col("edges") > 1))).first()
        if not open_:
            remove(least)
            break
        large = _with_least(both, least, ends, top).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "edges")
        remove(pairs, least)
        least = _least(large)
        count, top = least.agg(F.sum("edges"), F.max("edges")).first()
        small = _with_least(large, least, count, top).select("u", "v", "m")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        pairs = materialize(small, "edges")
        remove(large, least)
    out = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out.written_to = pairs.written_to
    return out
