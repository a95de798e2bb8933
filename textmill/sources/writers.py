"""Sinks: splits, chunked JSON lines, token windows and one-row summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators.sequences import greedy_chunks


def splits(df: DataFrame, path: str, kind: str = "json") -> None:
    """One folder for each value of ``split``."""
    df.write.mode("overwrite").partitionBy("split").format(kind).save(path)


def summary(df: DataFrame, path: str) -> None:
    """A small table as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def training_set(df: DataFrame, folder: str, metadata: DataFrame) -> None:
    """Each ``split`` as CSV (all columns) and as JSON lines of training items, and a one-row ``training_metadata``.

    ``df`` has split, training_text, id, subreddit, score and training_word_count; texts keep their line ends in quotes.
    """
    df.write.mode("overwrite").partitionBy("split").option("header", "true").option("escape", '"').csv(f"{folder}/csv")
    items = df.select("split", F.col("training_text").alias("text"), "id", "subreddit", "score", F.col("training_word_count").alias("word_count"), F.lit("reddit_cleaned").alias("source"))
    items.write.mode("overwrite").partitionBy("split").json(f"{folder}/jsonl")
    summary(metadata, f"{folder}/training_metadata")


def chunked_lines(df: DataFrame, path: str, group: str, order: list[str], limit: int = 100 * 1024 * 1024, close_before: bool = True) -> None:
    """JSON lines in chunks of about ``limit`` bytes for each group; sizes count the line and its end."""
    line = F.to_json(F.struct(*[c for c in df.columns if c != group]))
    rows = df.select(group, *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], line.alias("value")).withColumn("__bytes", F.octet_length("value") + 1)
    out = greedy_chunks(rows, group, [f"__o{i}" for i in range(len(order))], "__bytes", limit, close_before)
    out.select(group, "chunk", "value").write.mode("overwrite").partitionBy(group, "chunk").text(path)


def windows(df: DataFrame, path: str) -> None:
    """Token windows as Parquet, without padding (export pads)."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def token_archives(df: DataFrame, group: str = "file") -> DataFrame:
    """``.npz`` bytes of each file's windows, padded to the longest: file, content; write them where the archive is wanted."""
    import io

    import pandas as pd

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        rows = rows.sort_values("window")
        ids, size = list(rows["input_ids"]), rows["input_ids"].map(len).to_numpy("int32")
        out = np.zeros((len(ids), max(size, default=0)), "int32")
        for i, x in enumerate(ids):
            out[i, : len(x)] = x
        data = io.BytesIO()
        np.savez_compressed(data, input_ids=out, attention_mask=(np.arange(out.shape[1]) < size[:, None]).astype("int32"), sequence_lengths=size)
        return pd.DataFrame({group: [rows[group].iloc[0]], "content": [data.getvalue()]})

    return df.select(group, "window", "input_ids").groupBy(group).applyInPandas(build, f"{group} string, content binary")
