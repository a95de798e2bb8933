"""Step series of any length: running and rolling values without a window that is the whole series.

Rows get their position within their group from a range partitioning; positions are then cut into blocks of a fixed size. A rolling value needs the block and the last rows of the one before it
(its halo), a running value needs the block and one carried value. So one series of all rows spreads over all tasks.

The order must be unique within a group. Null groups are a group of their own; null values are left out of aggregates, as Spark's are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from textmill.training.types import kept

#: Positions of a block.
BLOCK = 50_000


def positions(df: DataFrame, group: list[str], order: list[str], name: str = "position") -> DataFrame:
    """``df`` with its rows' positions (from 1) within their group; held in the shared folder, as later steps read it more than once."""
    rows = kept(df.repartitionByRange(*group, *order).withColumn("__part", F.spark_partition_id()))
    keys = ["__part", *group]
    own = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    earlier = F.sum("__n").over(Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))  # a row for each range
    before = sizes.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.coalesce(earlier, F.lit(0)).alias("__before"))
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    out = rows.withColumn("__own", own).join(before, same)
    return out.select(*df.columns, (F.col("__own") + F.col("__before")).alias(name))


def rolling(df: DataFrame, group: list[str], order: list[str], rows: int, values: Callable[[WindowSpec], dict[str, Column]], block: int = BLOCK) -> DataFrame:
    """``df`` with ``position`` and the columns that ``values`` makes of the window of the last ``rows`` rows (itself included)."""
    size, halo = max(block, rows), rows - 1
    placed = positions(df, group, order)
    at = F.floor((F.col("position") - 1) / size)
    late = (F.col("position") - 1) % size >= size - halo
    copies = F.when(late, F.array(at, at + 1)).otherwise(F.array(at)) if halo else F.array(at)
    spread = placed.withColumn("__block", F.explode(copies)).withColumn("__home", at)
    w = Window.partitionBy(*group, "__block").orderBy("position").rowsBetween(-halo, 0)
    return spread.withColumns(values(w)).where(F.col("__block") == F.col("__home")).drop("__block", "__home")


def running(df: DataFrame, group: list[str], order: list[str], value: Column, agg: Callable[[Column], Column], name: str, block: int = BLOCK) -> DataFrame:
    """``df`` with ``position`` and ``agg`` (min or max) of ``value`` over the rows so far: the block's own, and what earlier blocks carry."""
    rows = positions(df, group, order).withColumns({"__value": value, "__block": F.floor((F.col("position") - 1) / block)})
    blocks = rows.groupBy(*group, "__block").agg(agg(F.col("__value")).alias("__best"))
    earlier = Window.partitionBy(*group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block
    keys = [*group, "__block"]
    carried = blocks.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], agg(F.col("__best")).over(earlier).alias("__carried"))
    own = agg(F.col("__value")).over(Window.partitionBy(*keys).orderBy("position").rowsBetween(Window.unboundedPreceding, 0))
    out = rows.withColumn("__own", own).join(carried, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    return out.withColumn(name, agg_of(agg, F.col("__own"), F.col("__carried"))).select(*df.columns, "position", name)


def agg_of(agg: Callable, a: Column, b: Column) -> Column:
    """The two-column form of min or max; nulls are left out."""
    return (F.least if agg is F.min else F.greatest)(a, b)


def running_best(df: DataFrame, group: list[str], order: list[str], value: str, name: str = "best", block: int = BLOCK) -> DataFrame:
    return running(df, group, order, F.col(value), F.min, name, block)


def since_best(df: DataFrame, group: list[str], order: list[str], value: str, step: str, block: int = BLOCK) -> DataFrame:
    """``df`` with ``since_best``: steps since the best value so far was last reached.

    The best is the least pair of value and negative step, so that the later of equal values wins.
    """
    pair = F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), (-F.col(step)).alias("s")))
    out = running(df, group, order, pair, F.min, "__best", block)
    return out.withColumn("since_best", F.col(step) + F.col("__best")["s"]).drop("__best")


def trend(df: DataFrame, group: list[str], order: list[str], value: str, block: int = BLOCK) -> DataFrame:
    """``df`` with ``trend``: start, improving (less than the row before) or stable."""

    def made(w: WindowSpec) -> dict[str, Column]:
        before = F.first(value).over(w)
        return {"trend": F.when((F.count(F.lit(1)).over(w) == 1) | before.isNull(), "start").when(F.col(value) < before, "improving").otherwise("stable")}

    return rolling(df, group, order, 2, made, block)


def slope(value: str, step: str, w: WindowSpec) -> Column:
    """Least-squares slope over a window; 0 where it is not defined."""
    return F.coalesce(F.try_divide(F.covar_pop(step, value).over(w), F.var_pop(step).over(w)), F.lit(0.0))
