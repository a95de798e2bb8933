"""What a tokenizer leaves behind and what is read back: vocabulary and merges, repaired ids, whole-text windows, lists of files, checkpoint states."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import bpe
from textmill.operators import intake, sequences


def byte_letters() -> list[str]:
    """A printable letter for each byte: its own where it has one, else the next from 256 on (the public byte-level rule)."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def tokenizer_files(merges: list[tuple[bytes, bytes]]) -> dict[str, str]:
    """Contents of ``vocab.json``, ``merges.txt`` and ``tokenizer.json``; the last one loads in the public tokenizer library."""
    letters = byte_letters()
    spell = lambda piece: "".join(letters[b] for b in piece)
    model = bpe.Bpe(merges)
    vocab = {**{s: i for i, s in enumerate(bpe.SPECIAL)}, **{spell(p): i for p, i in model.ids.items()}}
    lines = [f"{spell(a)} {spell(b)}" for a, b in merges]
    level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    flags = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
    whole = {
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [{"id": i, "content": s, **flags} for i, s in enumerate(bpe.SPECIAL)],
        "normalizer": None, "pre_tokenizer": level, "post_processor": None, "decoder": level,
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False, "vocab": vocab, "merges": lines},
    }
    dump = lambda x: json.dumps(x, ensure_ascii=False)
    return {"vocab.json": dump(vocab), "merges.txt": "\n".join(["#version: 0.2", *lines]) + "\n", "tokenizer.json": dump(whole)}


def write_tokenizer(spark: SparkSession, merges: list[tuple[bytes, bytes]], folder: str) -> None:
    """The three files in a folder of any store that Spark reaches; they grow with the vocabulary, not with the corpus."""
    for name, content in tokenizer_files(merges).items():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
        out.write(bytearray(content.encode()))
        out.close()


def encoded_windows(df: DataFrame, text: str, merges: list[tuple[bytes, bytes]], keep: list[str], length: int = sequences.WINDOW, stride: int = sequences.STRIDE) -> DataFrame:
    """Windows of the ids of each text that is long enough to tokenize: ``keep``, window, start, input_ids. Null and short texts give none."""
    long_enough = df.where(intake.tokenizable(F.col(text)))
    out = sequences.token_windows(bpe.encode(long_enough, text, merges, keep), "input_ids", length, stride, keep_empty=False)
    return out.select(*keep, "window", "start", "input_ids")


def repaired(ids: Column, vocab: int, unknown: int) -> Column:
    """Ids outside the vocabulary become ``unknown``."""
    return F.transform(ids, lambda x: F.when((x >= 0) & (x < vocab), x).otherwise(F.lit(unknown)))


def token_variety(df: DataFrame, ids: str) -> DataFrame:
    """Tokens of all sequences, how many are different, and their ratio (0 without tokens)."""
    n, different = F.count(F.lit(1)), F.countDistinct("id")
    return df.select(F.explode(ids).alias("id")).agg(n.alias("total_tokens"), different.alias("unique_tokens"), F.round(F.coalesce(F.try_divide(different, n), F.lit(0.0)), 6).alias("token_diversity"))


def write_names(df: DataFrame, name: str, path: str) -> None:
    """A list of names as text, one a line."""
    df.select(F.col(name).cast("string")).write.mode("overwrite").text(path)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """The names of such a list; blank lines and white space around names are dropped."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where("name <> ''")


def checkpoint_state(spark: SparkSession, folder: str, files: tuple[str, ...] = ("metadata", "config", "metrics")) -> dict[str, DataFrame | None]:
    """The JSON documents of a checkpoint by name; None for one that is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    there = lambda name: store.exists(spark._jvm.org.apache.hadoop.fs.Path(path, f"{name}.json"))
    return {name: spark.read.option("multiLine", "true").json(f"{folder}/{name}.json") if there(name) else None for name in files}
