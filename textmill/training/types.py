"""Tables of word types, which trainers read in each round."""

from __future__ import annotations

import re
import tempfile
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Parts of texts whose ids a worker keeps at most, and their longest.
KEPT_PARTS, KEPT_CHARS = 100_000, 64


def kept(df: DataFrame) -> DataFrame:
    """``df``, computed once and held in the folder that the driver and all executors share (a folder of its own only where none is set, as in tests)."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="textmill-"))
    return df.checkpoint(eager=True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` over all shuffle partitions, however small it is: its rows cost more time than their bytes tell."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def word_types(df: DataFrame, text: str, pattern: str, normalise: Callable[[str], list[str]]) -> DataFrame:
    """word, n: texts cut at ``pattern``, counted, and each type normalised once into words, which are counted again. A null text has none."""
    raw = df.select(F.explode(F.split(F.col(text), pattern)).alias("raw")).where("raw <> ''").groupBy("raw").agg(F.count(F.lit(1)).alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = [], []
            for r, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = normalise(r)
                words += own
                counts += [n] * len(own)
            yield pa.record_batch([pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])

    return raw.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


#: Cuts a text before each space: whatever its neighbours are, a part has the same words.
SPACED = "(?= )"


def spaced(texts: pa.StringArray) -> pa.ListArray:
    """Texts cut like at ``SPACED``, in Arrow; a null text is empty."""
    cut = pc.split_pattern(pc.fill_null(texts, ""), " ")
    first = np.zeros(len(cut.values), bool)
    first[np.asarray(cut.offsets)[:-1]] = True
    return pa.ListArray.from_arrays(cut.offsets, pc.if_else(pa.array(first), cut.values, pc.binary_join_element_wise("", cut.values, " ")))


def slices(texts: pa.StringArray, size: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``size`` bytes, or of one text, so that what a worker holds of a batch beside its texts has a bound."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + size, "right")))
        yield start, end
        start = end


_ASCII_WORDS = re.compile(r"[a-z0-9]+|[!-/:-@\[-`{-~]")
_CONTROLS = {c: None for c in [*range(32), 127] if chr(c) not in "\t\n\r"}


def inner(flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of lists of symbols, flat and by offsets: for each symbol but the last whether the next one is of the same list."""
    out = np.ones(max(0, len(flat) - 1), bool)
    out[ends[(ends > 0) & (ends < len(flat))] - 1] = False
    return out


def first_of_runs(at: np.ndarray) -> np.ndarray:
    """Of rising places those that don't overlap: in runs of neighbours every other one, from the first on."""
    run = np.diff(at, prepend=-2) != 1
    return (np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]) % 2 == 0


def summed(codes: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and their sums."""
    order = np.argsort(codes, kind="stable")
    codes, sums = codes[order], sums[order]
    starts = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[starts], np.add.reduceat(sums, starts) if len(starts) else sums


def bert_words(text: str) -> list[str]:
    """Lower-case words without accents, every punctuation mark and Chinese character alone."""
    if text.isascii():
        return _ASCII_WORDS.findall(text.translate(_CONTROLS).lower())
    out: list[str] = []
    text = "".join([" " if c in "\t\n\r" or unicodedata.category(c) == "Zs" else c for c in text if c not in "\0�" and (c in "\t\n\r" or unicodedata.category(c) not in ("Cc", "Cf", "Cn", "Co", "Cs"))])
    text = "".join([f" {c} " if _chinese(ord(c)) else c for c in text])
    text = "".join([c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn"]).lower()
    for word in text.split():
        start = 0
        for i, c in enumerate(word):
            if 33 <= ord(c) <= 47 or 58 <= ord(c) <= 64 or 91 <= ord(c) <= 96 or 123 <= ord(c) <= 126 or unicodedata.category(c)[0] == "P":
                out += [word[start:i], c]
                start = i + 1
        out.append(word[start:])
    return [w for w in out if w]


def _chinese(c: int) -> bool:
    # The blocks of Chinese characters that stand alone.
    blocks = [(0x4E00, 0x9FFF), (0x3400, 0x4DBF), (0x20000, 0x2A6DF), (0x2A700, 0x2B73F), (0x2B740, 0x2B81F), (0x2B920, 0x2CEAF), (0xF900, 0xFAFF), (0x2F800, 0x2FA1F)]
    return c >= 0x3400 and any(a <= c <= b for a, b in blocks)


def marked_words(text: str) -> list[str]:
    """Words with a mark in place of the space before each; quotes made plain, compatibility forms taken apart, accents dropped."""
    text = text.replace("``", '"').replace("''", '"')
    if not text.isascii():
        text = "".join([c for c in unicodedata.normalize("NFKD", text) if unicodedata.category(c) != "Mn"])
    text = text.replace(" ", "▁")
    if not text:
        return []
    text = text if text[0] == "▁" else "▁" + text
    return ["▁" + w for w in text.split("▁")[1:]]
