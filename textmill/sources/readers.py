"""Readers: JSON lines (plain, gzip, zstd), SFT files, token archives and landing folders."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MESSAGES = "array<struct<role:string,content:string>>"
SFT = f"messages {MESSAGES}, prompt string, response string, instruction string, input string, output string, completion string, code string, problem string, solution string, text string"
POST = "id string, title string, selftext string, content string, text string, score variant, upvote_ratio variant, num_comments variant, created_utc variant, subreddit string, author string, url string, is_self string, over_18 string, spoiler string, locked string, archived string, removed_by_category string, source string"
ARTICLE = "title string, content string, summary string, url string, category string, timestamp string, cycle long, source string"
WINDOW = "input_ids array<int>, attention_mask array<int>, sequence_length int"


def json_lines(spark: SparkSession, path: str | list[str], schema: str, glob: str = "*") -> DataFrame:
    """JSON lines under a folder, with source_file and bad (the line, if it is not JSON). The codec follows the extension."""
    reader = spark.read.schema(f"{schema}, bad string").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("columnNameOfCorruptRecord", "bad")
    return reader.json(path).select("*", F.col("_metadata.file_name").alias("source_file"))


def line_numbers(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Lines of text files with source_path, source_file and source_line (from 1, blank lines counted).

    Large files are read in splits. A line's place in its split follows the reading order; lines of earlier splits are counted, and one
    row for each split tells what comes before it.
    """
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path)
    meta = F.col("_metadata")
    rows = text.select(meta["file_path"].alias("source_path"), meta["file_name"].alias("source_file"), meta["file_block_start"].alias("split"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    splits = rows.groupBy("source_path", "split").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("lines"))
    earlier = Window.partitionBy("source_path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split
    splits = splits.select("source_path", "split", (F.col("first") - F.coalesce(F.sum("lines").over(earlier), F.lit(0))).alias("zero"))
    out = rows.join(splits, ["source_path", "split"])
    return out.select("source_path", "source_file", (F.col("at") - F.col("zero") + 1).alias("source_line"), "line")


def numbered_lines(spark: SparkSession, path: str, schema: str, glob: str = "*") -> DataFrame:
    """JSON lines with source_file and source_line (from 1, blank lines counted); blank and bad lines are dropped."""
    rows = line_numbers(spark, path, glob).where(F.trim("line") != "").withColumn("r", F.from_json("line", schema, {"mode": "PERMISSIVE"}))
    rows = rows.where(F.col("r").isNotNull() & F.try_variant_get(F.try_parse_json("line"), "$", "string").isNotNull())
    return rows.select("r.*", "source_file", "source_line")


def corrupt_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("source_file").agg(F.count(F.lit(1)).alias("lines"), F.count("bad").alias("bad"))


def union_of(frames: list[DataFrame], rank: str = "source_rank") -> DataFrame:
    """Union by name; ``rank`` keeps the order of the sources for first-wins deduplication."""
    ranked = [f.withColumn(rank, F.lit(i)) for i, f in enumerate(frames)]
    out = ranked[0]
    for f in ranked[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def sft(spark: SparkSession, path: str) -> DataFrame:
    """Fine-tuning examples: ``.jsonl`` lines, or a ``.json`` list or object."""
    reader = spark.read.schema(SFT)
    if path.endswith(".jsonl"):
        return reader.json(path)
    if path.endswith(".json"):
        return reader.option("multiLine", "true").json(path)
    raise ValueError(f"neither .jsonl nor .json: {path}")


def there(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in any store that Spark reaches."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def known_folders(spark: SparkSession, folders: list[str], schema: str, glob: str = "*") -> DataFrame:
    """JSON lines of those folders that exist, in their order (source_rank); none gives an empty table."""
    found = [json_lines(spark, f, schema, glob) for f in folders if there(spark, f)]
    return union_of(found) if found else spark.createDataFrame([], f"{schema}, bad string, source_file string, source_rank int")


def tuning_folder(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame | None]:
    """Training and evaluation examples of a folder: ``train.jsonl`` with ``eval.jsonl``, else ``train.json`` with ``eval.json``; no evaluation file gives None."""
    kind = "jsonl" if there(spark, f"{folder}/train.jsonl") else "json"
    return sft(spark, f"{folder}/train.{kind}"), sft(spark, f"{folder}/eval.{kind}") if there(spark, f"{folder}/eval.{kind}") else None


def web_corpus(spark: SparkSession, path: str, schema: str, max_samples: int | None = None) -> DataFrame:
    """A web corpus of JSON lines; ``max_samples`` takes the first lines by file and place."""
    if max_samples is None:
        return json_lines(spark, path, schema)
    rows = line_numbers(spark, path).where(F.trim("line") != "").orderBy("source_path", "source_line").limit(max_samples)
    return rows.select(F.from_json("line", schema).alias("r"), "source_file", "source_line").select("r.*", "source_file", "source_line")


def text_column(df: DataFrame) -> str:
    """The first of the usual text columns, or else the first string column."""
    for name in ("text", "content", "prompt", "instruction", "input"):
        if name in df.columns:
            return name
    return next(n for n, kind in df.dtypes if kind == "string")


def token_archives(spark: SparkSession, path: str) -> DataFrame:
    """Token archives (``.npz``) as rows: file, seq, input_ids, status; a file that cannot be read gives one row with its reason."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                rows: list[tuple] = []
                try:
                    with np.load(io.BytesIO(content), allow_pickle=False) as z:
                        key = next((k for k in ("input_ids", "data", "sequences") if k in z), None)
                        if key is None:
                            rows = [(name, -1, None, "missing key")]
                        else:
                            data = z[key]
                            data = data.reshape(1, -1) if data.ndim == 1 else data.reshape(-1, data.shape[-1])
                            rows = [(name, i, r.astype("int32").tolist(), "ok") for i, r in enumerate(data)] or [(name, -1, None, "empty")]
                except Exception as e:  # noqa: BLE001 - any damage is reported with the file
                    rows = [(name, -1, None, f"corrupt: {type(e).__name__}")]
                yield pd.DataFrame(rows, columns=["file", "seq", "input_ids", "status"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.npz").load(path)
    return files.select("path", "content").mapInPandas(parse, "file string, seq int, input_ids array<int>, status string")


def log_tail(spark: SparkSession, path: str, lines: int) -> DataFrame:
    """The last lines of a log, by their numbers; of several files the last ones by name."""
    rows = line_numbers(spark, path)
    return rows.orderBy(F.desc("source_path"), F.desc("source_line")).limit(lines).orderBy("source_path", "source_line").select(F.col("line").alias("value"))


def checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """Folders with a model or tokenizer file, and their size in MB."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    parts = F.split("path", "/")
    rows = files.select(F.element_at(parts, -2).alias("checkpoint"), F.element_at(parts, -1).alias("name"), "length")
    out = rows.groupBy("checkpoint").agg(F.round(F.sum("length") / 1048576, 2).alias("mb"), F.max(F.col("name").rlike(r"^(model|pytorch_model|tokenizer).*\.(bin|safetensors|json|pt)$")).alias("model"))
    return out.where("model").drop("model")
