"""Quality reasons, first-wins deduplication, splits and corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmill.functions import text as T

KEPT = "high_quality"


def quality_reason(title: Column, body: Column, total_words: Column, body_words: Column, score: Column, over_18: Column, is_self: Column) -> Column:
    """The first rule that a post breaks, or ``high_quality``."""
    gone = ((body == "") | F.lower(body).isin(*T.GONE)) & ((title == "") | (F.length(title) < 10))

    def by_content(content: Column) -> Column:
        repetitive = T.bind(T.words(content), T.repetitive)
        return (
            F.when(T.is_spam(content), "spam_pattern").when(repetitive, "repetitive").when(score < -10, "heavily_downvoted")
            .when(~is_self & (body_words < 20), "link_post_short_text").otherwise(KEPT)
        )

    # The rules that read words come last, and read them once.
    plain = F.when(gone, "deleted_or_removed").when(over_18, "nsfw").when(total_words < 5, "too_short").when(total_words > 10000, "too_long")
    return plain.otherwise(T.bind(F.lower(F.concat(title, F.lit(" "), body)), by_content))


def first_wins(df: DataFrame, key: Column, order: str) -> DataFrame:
    """Rows that come first, by the unique column ``order``, of those with an equal key; rows with a null key are dropped.

    Rows are read once. Each task first keeps its own first row of a key, so a key which holds a large part of all
    rows sends one row from each task and never meets in one.
    """
    row = F.struct(*df.columns)
    firsts = df.where(key.isNotNull()).groupBy(key.alias("__key")).agg(F.min_by(row, order).alias("__row"))
    return firsts.select("__row.*")


def split(df: DataFrame, key: str, stratum: Column | None = None, seed: int = 42, train: float = 0.7, validation: float = 0.15, least: int = 10) -> DataFrame:
    """``df`` with ``split``: exact shares in each stratum of at least ``least`` rows and in the rest together.

    Ranks are by a hash of key and seed, within 256 hash groups of a stratum whose sizes are summed first, so that no
    stratum is sorted in one task.
    """
    base = df.withColumn("__hash", F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")).cast("binary")))
    base = base.withColumn("__stratum", F.lit("") if stratum is None else F.coalesce(stratum, F.lit("")))
    sizes = base.groupBy("__stratum").agg(F.count(F.lit(1)).alias("__size"))
    base = base.join(sizes, "__stratum").withColumn("__stratum", F.when(F.col("__size") >= least, F.col("__stratum")))
    base = base.withColumn("__group", F.substring("__hash", 1, 2)).drop("__size")
    groups = base.groupBy("__stratum", "__group").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("__stratum").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(F.col("__stratum").alias("__s"), F.col("__group").alias("__g"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"), F.sum("n").over(Window.partitionBy("__stratum")).alias("__n"))
    rank = F.row_number().over(Window.partitionBy("__stratum", "__group").orderBy("__hash", key))
    out = base.withColumn("__rank", rank).join(groups, F.col("__stratum").eqNullSafe(F.col("__s")) & (F.col("__group") == F.col("__g")))
    place = F.col("__before") + F.col("__rank")
    first, second = F.floor(F.col("__n") * train), F.floor(F.col("__n") * train) + F.floor(F.col("__n") * validation)
    out = out.withColumn("split", F.when(place <= first, "train").when(place <= second, "validation").otherwise("test"))
    return out.select(*df.columns, "split")


def holdout(df: DataFrame, key: str, share: float = 0.1, seed: int = 42) -> DataFrame:
    """``df`` with ``split`` eval for floor(share * n) rows, train for the others."""
    out = split(df, key, None, seed, share, 0.0, 0)
    return out.withColumn("split", F.when(F.col("split") == "train", "eval").otherwise("train"))


def reason_counts(df: DataFrame, reason: Column) -> list[Column]:
    """Counters of the cleaner, as aggregates."""
    count = lambda c: F.count_if(c)
    rest = ~reason.isin(KEPT, "deleted_or_removed", "nsfw", "spam_pattern", "repetitive")
    return [
        count(reason == KEPT).alias("kept"), count(reason == "deleted_or_removed").alias("removed_deleted"), count(reason == "nsfw").alias("removed_nsfw"),
        count(reason.isin("spam_pattern", "repetitive")).alias("removed_spam"), count(rest).alias("removed_low_quality"),
    ]


def describe(column: str, sample: bool = False) -> list[Column]:
    spread = F.stddev_samp(column) if sample else F.stddev_pop(column)
    return [
        F.round(F.avg(column), 6).alias("mean"), F.min(column).cast("double").alias("min"), F.max(column).cast("double").alias("max"),
        F.percentile(column, 0.5).alias("median"), F.round(spread, 6).alias("std"),
    ]
