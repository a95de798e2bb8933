"""The corpus pipeline: quality rules, near-duplicates, decontamination, secrets, packing.

Each stage gets the rows that its predecessor kept, written as Parquet and read again, and all but the last return
the columns of ``documents``, with their own values but for ``text`` and ``n_chars`` of masked documents.

Cases: rows are told apart by id and text, so null and repeated ids are judged each for itself; a null or empty text fails the quality rules and goes there; a
row with a null id is not compared with others and stays in the near-duplicate stage; equal rows are copies, of which one stays; ties between copies go to the smallest id;
very long texts are handled whole; further columns are carried through, whatever their names, up to packing, whose rows are pieces; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import decontaminate, neardup, packing, quality_rules, secrets
from textmill.llm.common import materialize, remove


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the divergence rules."""
    return quality_rules.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group."""
    return neardup.deduplicated(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    # What is contaminated follows from the text alone, so rows are told apart by it and not by an id that may be null or repeated.
    own = F.md5(F.col("text").cast("binary"))
    bad = decontaminate.decontaminate(docs.select(own.alias("key"), "text"), items, key="key").where("contaminated").select("key").distinct()
    names = docs.columns
    held = docs.withColumnsRenamed({c: f"c{i}" for i, c in enumerate(names)})
    held = held.withColumn("key", F.md5(F.col(f"c{names.index('text')}").cast("binary"))).join(bad, "key", "left_anti")
    return held.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with findings masked and n_chars kept true."""
    clean = secrets.redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and places in sequences."""
    return packing.packed(docs)


STAGES = [("quality_rules", quality), ("minhash_near_dedup", near_duplicates), ("decontamination", benchmark), ("secret_scan", secret_scan), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name)
        remove(before)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Near-duplicate search by signatures, masking by position and the tokenizer are not SQL; tests hold the stages against plain code.
ORACLE_SQL = None
