"""Token sequences: windows, padding, packing, training examples and chunking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.operators.chunking import greedy_chunks  # noqa: F401  (one of this module's rules)

WINDOW, STRIDE = 1024, 512
#: Groups whose lengths are broadcast; with more, the rows are dealt by group.
FEW_GROUPS = 50_000


def window_starts(size: Column, length: int = WINDOW, stride: int = STRIDE) -> Column:
    """0-based starts: one window up to ``length`` ids, then one each ``stride`` until the end is reached."""
    extra = F.ceil((size - length) / F.lit(stride)).cast("int")
    return F.sequence(F.lit(0), F.greatest(extra, F.lit(0)) * stride, F.lit(stride))


def token_windows(df: DataFrame, ids: str, length: int = WINDOW, stride: int = STRIDE, keep_empty: bool = True) -> DataFrame:
    """A row for each window of ``ids``: window (number), start, input_ids. Empty sequences give one empty window or none."""
    rows = df if keep_empty else df.where(F.size(ids) > 0)
    out = rows.select("*", F.posexplode(window_starts(F.size(ids), length, stride)).alias("window", "start"))
    return out.withColumn("input_ids", F.slice(F.col(ids), F.col("start") + 1, length))


def window_count(size: Column, length: int = WINDOW, stride: int = STRIDE) -> Column:
    return 1 + F.greatest(F.ceil((size - length) / F.lit(stride)), F.lit(0))


def window_estimate(size: Column, length: int = WINDOW, stride: int = STRIDE) -> Column:
    """The planners' estimate, which rounds down."""
    return F.greatest(F.lit(1), 1 + F.floor((size - length) / F.lit(stride)))


def pad(ids: Column, length: Column | int, value: int = 0) -> Column:
    size = F.lit(length) if isinstance(length, int) else length
    return F.concat(F.slice(ids, 1, size), F.array_repeat(F.lit(value), F.greatest(size - F.size(ids), F.lit(0))))


def mask(ids: Column, length: Column | int) -> Column:
    size = F.lit(length) if isinstance(length, int) else length
    ones = F.least(F.size(ids), size)
    return F.concat(F.array_repeat(F.lit(1), ones), F.array_repeat(F.lit(0), size - ones))


def pad_to_longest(df: DataFrame, group: str, ids: str) -> DataFrame:
    """``df`` with padded ids, mask and length; the length is the longest of the group (a file). Rows of a null group go.

    The lengths are made first, so that they go to the rows, by broadcast, and no array is shuffled; only with more than ``FEW_GROUPS`` groups are rows dealt.
    """
    longest = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.max(F.size(ids)).alias("__longest"))
    found = longest.limit(FEW_GROUPS + 1).collect()
    if len(found) <= FEW_GROUPS:
        longest = F.broadcast(df.sparkSession.createDataFrame(found, longest.schema))
    out = df.join(longest, group).withColumns({"sequence_length": F.size(ids), "attention_mask": mask(F.col(ids), F.col("__longest"))})
    return out.withColumn("padded_ids", pad(F.col(ids), F.col("__longest"))).drop("__longest")


def pack_starts(size: Column, length: int, tail: str, stride: int | None = None) -> Column:
    """Starts of windows on a tape.

    ``pad``: full windows only, or one short window if there is none; ``keep``: a short last window as well; ``drop``: full windows only.
    """
    step = stride or length
    if tail == "keep":
        return F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0)), F.lit(step))
    full = F.sequence(F.lit(0), F.greatest(size - length, F.lit(0)), F.lit(step))
    return full if tail == "pad" else F.when(size >= length, full).otherwise(F.array().cast("array<int>"))


def pack(df: DataFrame, ids: str, length: int, tail: str = "pad", stride: int | None = None) -> DataFrame:
    """Windows of each row's tape of ids; short ones are padded with 0."""
    out = df.select("*", F.posexplode(pack_starts(F.size(ids), length, tail, stride)).alias("window", "start"))
    return out.withColumn("input_ids", pad(F.slice(F.col(ids), F.col("start") + 1, length), length))


def shift(ids: Column) -> tuple[Column, Column, Column]:
    """Inputs, labels (one later) and mask (input is not 0)."""
    inputs = F.slice(ids, 1, F.greatest(F.size(ids) - 1, F.lit(0)))
    labels = F.slice(ids, 2, F.greatest(F.size(ids) - 1, F.lit(0)))
    return inputs, labels, F.transform(inputs, lambda x: (x != 0).cast("int"))


def supervised(ids: Column, length: int, pad_id: int = 0) -> tuple[Column, Column]:
    """Ids cut or padded to ``length``, and labels with pads as -100."""
    full = pad(ids, length, pad_id)
    return full, F.transform(full, lambda x: F.when(x == pad_id, -100).otherwise(x))


def verify_windows(df: DataFrame, vocab: int, length: int) -> DataFrame:
    """Counts of windows, of wrong shapes, of masks that differ from ids in size, and of ids outside the vocabulary."""
    return df.agg(
        F.count(F.lit(1)).alias("windows"), F.count_if(F.size("input_ids") > length).alias("too_long"), F.count_if(F.size("input_ids") != F.size("attention_mask")).alias("mask_mismatch"),
        F.count_if(F.exists("input_ids", lambda x: (x < 0) | (x >= vocab))).alias("out_of_vocabulary"), F.count_if(F.size("input_ids") == 0).alias("empty"),
    )
