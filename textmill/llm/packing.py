"""Packing by minimum bin slack.

A document's ids (with an end id) are cut into full windows and one remainder. Full windows are
sequences of their own. Remainders are packed by length only: the histogram of their lengths (one
number for each length below the window, whatever the input's size) goes to the driver, where each
window is seeded with the longest length left and a bitset subset-sum dynamic programme over the
multiset of remaining lengths picks the filling closest to capacity; counts are backtracked through the
bitsets. A filling is used as many times as the counts allow, so that each step exhausts a length and there
are at most as many different fillings as lengths. Rows then find their place by their rank among the
remainders of their length, through a broadcast join with the plan, which depends
on the window and not on the input's size.

Cases: a null text has the end id only; an empty table gives no rows; equal documents are
interchangeable; further columns of the input are not carried (the piece's document id leads back to
them).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmill.llm.common import base_documents, materialize

WINDOW = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Encoded words kept by a Python worker; the store is emptied when it is full.
CACHED_WORDS = 900_000
#: Remainders of one length are ranked in that many groups at least.
RANK_GROUPS = 64


#: The rules that ``WordEncoder`` follows (fixed values); with others, texts go to the whole tokenizer.
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
}


class _Known(dict):
    """Ids by word; ``make`` gives those of a new one."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        found = self[word] = self.make(word)
        return found


class WordEncoder:
    """Encodes texts of a tokenizer that drops white space and case, a word at a time, keeping the ids of what it has seen.

    Words are cut into the tokenizer's pre-tokens here, and only unseen pre-tokens go to its model. Texts with characters of
    less plain rules (see ``ODD``) or a special token's opening are encoded by the whole tokenizer.
    """

    #: Below U+0180, all but U+0130 are their own normal form with a plain lower case; U+001C to U+001F are space to Python alone.
    ODD = re.compile("[\u0130\u0180-\U0010ffff]")

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        self.plain = {k: rules[k] for k in RULES} == RULES
        self.model = self.tokenizer.model
        self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.byte_char = [table[b] for b in range(256)]
        self.known = _Known(self.word)

    def odd(self, text: str) -> bool:
        if "<|" in text or "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            return True
        if text.isascii():
            return False
        try:
            text.encode("latin-1")  # much faster than the search
        except UnicodeEncodeError:
            return self.ODD.search(text) is not None
        return False

    def whole(self, text: str) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in self.tokenizer.encode(text, add_special_tokens=False).ids])

    def part(self, piece: str) -> bytes:
        found = self.known.get(piece)
        if found is None:
            shown = piece if piece.isascii() else "".join([self.byte_char[b] for b in piece.encode()])
            if not shown.isprintable():
                shown = "".join([self.byte_char[b] for b in piece.encode()])
            found = self.known[piece] = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])
        return found

    def word(self, word: str) -> bytes:
        if word.isalpha():
            return self.part(word)
        if word[-1] in ".," and (head := word[:-1]).isalpha():
            return self.part(head) + self.part(word[-1])
        return b"".join([self.part(p) for p in self.pieces(word)])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.plain or self.odd(text):
            return self.whole(text)
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, text.lower().split()))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Documents' ids, cut into full windows and a remainder: doc_id, start, length, doc_tokens, ids (binary, 32-bit little-endian)."""
    end = end_id.to_bytes(4, "little")
    step = 4 * window

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer or tokenizer_path())
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            held = 0
            for i in range(batch.num_rows):
                value = batch.column(1)[i].as_py()
                ids = enc.encode(value) + end if value else end
                for at in range(0, len(ids), step):
                    part = ids[at : at + step]
                    for column, v in zip(rows, (batch.column(0)[i].as_py(), at // 4, len(part) // 4, len(ids) // 4, part), strict=True):
                        column.append(v)
                held += len(ids)
                if held > 1 << 23:
                    yield _batch(rows)
                    rows, held = [[], [], [], [], []], 0
            if rows[0]:
                yield _batch(rows)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(cut, PIECES)


def _batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=["doc_id", "start", "length", "doc_tokens", "ids"])


def best_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths within ``counts`` whose sum is closest to ``capacity`` from below, long lengths first.

    ``reach`` has bit ``s`` set if sum ``s`` can be made; one bitset is kept for each length and backtracked.
    """
    reach, steps = 1, []
    mask = (1 << (capacity + 1)) - 1
    for length in sorted((k for k, c in counts.items() if c and k <= capacity), reverse=True):
        steps.append((length, reach))
        copies, chunk = min(counts[length], capacity // length), 1
        while copies:  # doubling: any number of copies up to the count
            n = min(chunk, copies)
            reach |= (reach << (length * n)) & mask
            copies -= n
            chunk *= 2
        if reach >> capacity:
            break
    left = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for length, before in reversed(steps):
        n = 0
        while not before >> left & 1:  # fewest copies of this length that lead back to a sum made without it
            left -= length
            n += 1
        if n:
            taken[length] = n
    return taken


def fill_plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[dict[int, int], int]]:
    """(filling, how many times) until no length is left."""
    left = {k: c for k, c in counts.items() if c}
    plan = []
    while left:
        seed = max(left)
        left[seed] -= 1
        fill = best_fill(left, window - seed)
        left[seed] += 1
        fill[seed] = fill.get(seed, 0) + 1
        times = min(left[k] // n for k, n in fill.items())
        plan.append((fill, times))
        for k, n in fill.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return plan


def pack(parts: DataFrame, window: int = WINDOW) -> DataFrame:
    """``parts`` (as from :func:`pieces`) with sequence_id and offset.

    ``parts`` is read twice, so it should be a written table.
    """
    spark = parts.sparkSession
    counts = {r[0]: r[1] for r in parts.groupBy("length").count().collect()}  # one row for each length
    total = sum(counts.values())
    full = counts.pop(window, 0)
    plan, first = [], full
    seen = dict.fromkeys(counts, 0)
    for fill, times in fill_plan(counts, window):
        at = 0
        for length in sorted(fill, reverse=True):
            n = fill[length]
            plan.append((length, seen[length], seen[length] + n * times, n, first, at))
            seen[length] += n * times
            at += n * length
        first += times
    if full:
        plan.append((window, 0, full, 1, 0, 0))
    groups = max(RANK_GROUPS, total // 200_000)
    grouped = parts.withColumn("__pack_group", F.pmod(F.xxhash64("doc_id", "start"), F.lit(groups)).cast("int"))
    # Rows of one length may be a third of all, so ranks come from group counts and a rank within each group.
    sizes = grouped.groupBy("length", "__pack_group").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("__pack_group").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("length", "__pack_group", F.coalesce(before, F.lit(0)).alias("__pack_before"))
    within = F.row_number().over(Window.partitionBy("length", "__pack_group").orderBy("doc_id", "start")) - 1
    ranked = grouped.withColumn("__pack_within", within).join(sizes, ["length", "__pack_group"])
    ranked = ranked.withColumn("__pack_rank", F.col("__pack_before") + F.col("__pack_within"))
    text = json.dumps([dict(zip(("l", "lo", "hi", "n", "s", "o"), r, strict=True)) for r in plan])
    slots = spark.range(1).select(F.inline(F.from_json(F.lit(text), "array<struct<l:long,lo:long,hi:long,n:long,s:long,o:long>>")))
    slots = slots.toDF("__pack_l", "__pack_lo", "__pack_hi", "__pack_n", "__pack_s", "__pack_o")
    here = (F.col("length") == F.col("__pack_l")) & (F.col("__pack_rank") >= F.col("__pack_lo")) & (F.col("__pack_rank") < F.col("__pack_hi"))
    nth = F.col("__pack_rank") - F.col("__pack_lo")
    out = ranked.join(F.broadcast(slots), here)
    out = out.withColumn("sequence_id", F.col("__pack_s") + F.floor(nth / F.col("__pack_n"))).withColumn("offset", F.col("__pack_o") + F.pmod(nth, F.col("__pack_n")) * F.col("length"))
    return out.select(*parts.columns, F.col("sequence_id").cast("long").alias("sequence_id"), F.col("offset").cast("long").alias("offset"))


def packed(docs: DataFrame, **options) -> DataFrame:
    """Pieces of documents with ids, sequence_id and offset; ids are encoded once and kept in the shared folder."""
    return pack(materialize(pieces(docs, **options), "pieces"), options.get("window", WINDOW))


def op3_minimum_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = pieces(base_documents(spark, sf_dir)).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return pack(materialize(parts, "pieces"))  # ids themselves need not be moved
