"""Alignment of two tokenizers by a dangling-suffix transducer.

Both encode the same bytes. The transducer takes tokens of the side that lags and keeps which side leads and the bytes by which it does (the residual);
an empty residual closes a group. Its state is that alone, so transitions are kept by side, residual and next token.

A text is cut into chunks at places where neither tokenizer joins characters, so the residual is empty there; chunks that were seen are not encoded or aligned again.
Counts of linked id pairs cover the whole corpus: a worker numbers the pairs of a block of documents (bounded by its tokens), Spark adds up the blocks' numbers, and
each block gets back one number for each of its pairs. A pair that all documents have is one row of each block, never one of each document.

Cases: a null or empty text, and one whose tokens do not give back a space and the text (U+2581 in it), have no tokens: zeros and an empty digest. Very long texts are
handled whole, as a block of their own. Rows are independent but for the counts, to which repeated rows add each time; null and repeated ids change nothing. Links of equal count are all best. An empty table gives no rows.
Further columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import base_documents, materialize, uncollected

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Tokens of the first tokenizer in a block of documents, beyond which a new one begins.
BLOCK = 3_000_000
#: Chunks and transitions that a Python worker keeps; a store is emptied when it is full.
CACHED_CHUNKS, CACHED_STEPS = 800_000, 500_000
MARK = "▁"
_LETTERS, _MARKS = "0-9A-Za-zÀ-ÖØ-öø-ÿ", r"!-/:-@\[-`{-~"
#: Chunks: both sides cut between a letter or digit and ASCII punctuation, a space or a line end, and between visible ASCII and a space.
CHUNKS = re.compile(rf" *[{_LETTERS}]+(?=[{_MARKS} \n]|\Z)|(?s:.)[^ ]*(?:(?<![!-~{_LETTERS}]) [^ ]*)*")
#: What no piece of the second vocabulary may have for that.
CROSSED = re.compile(rf"[{_LETTERS}][{_MARKS} \n]|[!-~{_LETTERS}] ")
#: Of a chunk: tokens of both sides, groups as text, linked pairs (``a << 32 | b``).
Chunk = tuple[int, int, str, tuple[int, ...]]


class Transducer:
    """Groups of tokens of two sides that end together. A state is a side that lags and the other's unmatched bytes; state 0 has none."""

    def __init__(self, first: list[bytes], second: list[bytes]):
        self.bytes = (first, second)
        self.forget()

    def forget(self) -> None:
        self.states: dict[tuple[int, bytes], int] = {(0, b""): 0}
        self.lags, self.residuals = [0], [b""]
        self.steps: list[dict[int, int]] = [{}]
        self.kept = 0

    def step(self, state: int, token: int) -> int:
        """The state after the next token of the side that lags (at no residual, of the first side); -1 if bytes differ."""
        lags, residual = self.lags[state], self.residuals[state]
        own = self.bytes[lags][token]
        if residual.startswith(own):
            new = (lags, residual[len(own) :])
        elif own.startswith(residual):
            new = (1 - lags, own[len(residual) :])
        else:
            new = None
        if new is None:
            found = -1
        elif not new[1]:
            found = 0
        else:
            found = self.states.setdefault(new, len(self.states))
            if found == len(self.lags):
                self.lags.append(new[0])
                self.residuals.append(new[1])
                self.steps.append({})
        self.steps[state][token] = found
        self.kept += 1
        return found

    def groups(self, first: list[int], second: list[int]) -> list[tuple[list[int], list[int]]] | None:
        """The groups, in order; None if the sides' bytes differ."""
        if self.kept > CACHED_STEPS:
            self.forget()
        out: list[tuple[list[int], list[int]]] = []
        steps, lags = self.steps, self.lags
        i = j = begun_i = begun_j = state = 0
        n, m = len(first), len(second)
        while state or i < n or j < m:
            if lags[state]:
                if j == m:
                    return None
                token = second[j]
                j += 1
            else:
                if i == n:
                    return None
                token = first[i]
                i += 1
            new = steps[state].get(token)
            state = self.step(state, token) if new is None else new
            if state == 0:
                out.append((first[begun_i:i], second[begun_j:j]))
                begun_i, begun_j = i, j
            elif state < 0:
                return None
        return out


def _byte_level() -> dict[str, int]:
    """Bytes by the characters that stand for them in byte-level vocabularies: visible ones by themselves, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Both tokenizers, and what is known of chunks: ids of pairs, tokens of both sides, groups."""

    def __init__(self, first: str, second: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(first)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=second)
        level = _byte_level()
        left = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            left[i] = bytes(level[c] for c in entry) if all(c in level for c in entry) else entry.encode()
        size, piece = self.b.get_piece_size(), self.b.id_to_piece
        right = [bytes([int(piece(i)[3:5], 16)]) if self.b.is_byte(i) else piece(i).replace(MARK, " ").encode() for i in range(size)]
        self.left, self.right, self.transducer = left, right, Transducer(left, right)
        self.mark = self.b.piece_to_id(MARK)
        plain = [i for i in range(size) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        # If a piece crossed a cut, texts would be handled whole.
        self.cut = (lambda text: [text]) if any(CROSSED.search(piece(i).replace(MARK, " ")) for i in plain) else CHUNKS.findall
        self.known: dict[str, Chunk] = {}

    def encode(self, chunks: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both sides. The second model puts a space before a text, but not before an empty one; a chunk without its own gets a letter, from which both sides cut it."""
        a = self.a.encode_batch_fast(chunks, add_special_tokens=False)
        b = self.b.encode([c[1:] if c[0] == " " else "a" + c for c in chunks], num_threads=1)
        return [(x.ids, (y or [self.mark]) if c[0] == " " else y[1:]) for c, x, y in zip(chunks, a, b, strict=True)]

    def learn(self, chunks: list[str]) -> None:
        """Keeps what chunks have; those whose bytes differ have less than no tokens."""
        for chunk, (a, b) in zip(chunks, self.encode(chunks), strict=True):
            groups = self.transducer.groups(a, b)
            if groups is None or b"".join([self.left[i] for i in a]) != chunk.encode():
                self.known[chunk] = (-1, -1, "", ())
            else:
                shown = ";".join([f"{x[0] if len(x) == 1 else ','.join(map(str, x))}|{y[0] if len(y) == 1 else ','.join(map(str, y))}" for x, y in groups])
                self.known[chunk] = (len(a), len(b), shown, tuple([x[-1] << 32 | y[-1] for x, y in groups]))

    def text(self, text: str | None) -> list[Chunk]:
        """What the chunks of a text have; none where the text has no tokens."""
        if not text:
            return []
        cut, known = self.cut(" " + text), self.known
        try:
            found = [known[c] for c in cut]
        except KeyError:
            if len(known) > CACHED_CHUNKS:
                known.clear()
            self.learn([c for c in dict.fromkeys(cut) if c not in known])
            found = [known[c] for c in cut]
        return [] if (-1, -1, "", ()) in found else found


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(first: str, second: str) -> Aligner:
    if (first, second) not in _ALIGNERS:
        _ALIGNERS[first, second] = Aligner(first, second)
    return _ALIGNERS[first, second]


def _paths(paths: tuple[str, str] | None) -> tuple[str, str]:
    if paths:
        return paths
    import public_tokenizers

    return public_tokenizers.path(FIRST), public_tokenizers.path(SECOND)


_INTS, _LONGS = pa.list_(pa.int32()), pa.list_(pa.int64())
_OWN = {"block": pa.string(), "n_a": pa.int64(), "n_b": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "at": _INTS, "times": _INTS}
_PAIRS = {"a": _INTS, "b": _INTS, "n": _LONGS}
_SCHEMA = "block string, n_a long, n_b long, n_links long, groups_sha256 string, at array<int>, times array<int>, a array<int>, b array<int>, n array<long>"


class _Block:
    """The pairs of consecutive documents, numbered as they come."""

    def __init__(self, name: str):
        self.name, self.tokens = name, 0
        self.numbers: dict[int, int] = {}
        self.times = array("q")

    def add(self, found: list[Chunk]) -> tuple:
        """A document's row: its pairs by their numbers."""
        n_a, n_b, shown, links = zip(*found, strict=True) if found else ((), (), (), ())
        own = Counter(chain.from_iterable(links))
        numbers, times = self.numbers, self.times
        at = []
        for pair, n in own.items():
            i = numbers.get(pair)
            if i is None:
                i = numbers[pair] = len(times)
                times.append(n)
            else:
                times[i] += n
            at.append(i)
        self.tokens += sum(n_a)
        digest = hashlib.sha256(";".join(shown).encode()).hexdigest() if found else ""
        return self.name, sum(n_a), sum(n_b), sum(own.values()), digest, at, list(own.values())

    def pairs(self, key_type: pa.DataType) -> pa.RecordBatch:
        """The block's own row: all its pairs."""
        codes = np.fromiter(self.numbers, np.int64, len(self.numbers))
        values = [[(codes >> 32).astype(np.int32)], [(codes & 0xFFFFFFFF).astype(np.int32)], [np.array(self.times)]]
        none = [pa.array([self.name]) if k == "block" else pa.nulls(1, t) for k, t in _OWN.items()]
        return pa.record_batch([pa.nulls(1, key_type), *none, *[pa.array(v, t) for v, t in zip(values, _PAIRS.values(), strict=True)]], names=["key", *_OWN, *_PAIRS])


def _rows(keys: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    own = [pa.array([r[i] for r in rows], t) for i, t in enumerate(_OWN.values())]
    return pa.record_batch([keys, *own, *[pa.nulls(len(rows), t) for t in _PAIRS.values()]], names=["key", *_OWN, *_PAIRS])


def _numbered(df: DataFrame, key: str, text: str, paths: tuple[str, str] | None, block: int) -> DataFrame:
    """A row for each document, with the numbers of its pairs in its block and how often it has them, and a row for each block with its pairs and their counts."""
    kind = dict(df.select(key).dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = aligner(*_paths(paths))
        part, made = TaskContext.get().partitionId(), 0
        now, key_type = _Block(f"{part}-0"), None
        for batch in uncollected(batches):
            keys, begun, rows = batch.column(0), 0, []
            key_type = keys.type
            for i, t in enumerate(batch.column(1).to_pylist()):
                rows.append(now.add(model.text(t)))
                if now.tokens >= block:
                    yield _rows(keys.slice(begun, len(rows)), rows)
                    yield now.pairs(key_type)
                    begun, rows, made = i + 1, [], made + 1
                    now = _Block(f"{part}-{made}")
            if rows:
                yield _rows(keys.slice(begun, len(rows)), rows)
        if now.numbers:
            yield now.pairs(key_type)

    return df.select(key, text).mapInArrow(run, f"`key` {kind}, {_SCHEMA}")


def _answered(documents: pa.Table, pairs: pa.Table) -> pa.Table:
    """Rows of a block's documents, with the corpus-wide counts of its pairs looked up by number."""
    at = pairs.column("at").to_numpy()
    count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    count[at] = pairs.column("count").to_numpy()
    best[at] = pairs.column("best").to_numpy()
    sums: list[list[int]] = [[], []]
    for own, times in zip(documents.column("at"), documents.column("times"), strict=True):
        i, n = own.values.to_numpy(), times.values.to_numpy().astype(np.int64)
        sums[0].append(int((best[i] * n).sum()))
        sums[1].append(int((count[i] * n).sum()))
    out = documents.select(["key", "n_a", "n_b", "n_links", "groups_sha256"])
    return out.append_column("n_best", pa.array(sums[0], pa.int64())).append_column("count_sum", pa.array(sums[1], pa.int64()))


def links(numbered: DataFrame) -> DataFrame:
    """a, b, count (of links in the whole corpus), best (the highest of its b)."""
    counts = _block_pairs(numbered).groupBy("a", "b").agg(F.sum("n").alias("count"))
    counts = materialize(counts, "links")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))  # a row for each id of the second vocabulary at most
    return counts.join(F.broadcast(most), "b").select("a", "b", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))


def _block_pairs(numbered: DataFrame) -> DataFrame:
    rows = numbered.where("a IS NOT NULL").select("block", F.posexplode(F.arrays_zip("a", "b", "n")).alias("at", "p"))
    return rows.select("block", "at", "p.a", "p.b", "p.n")


def aligned(df: DataFrame, key: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None, block: int = BLOCK) -> DataFrame:
    """key, n_a, n_b, n_links, groups_sha256, n_best and count_sum of each row."""
    numbered = materialize(_numbered(df, key, text, paths, block), "aligned")
    known = _block_pairs(numbered).join(links(numbered), ["a", "b"]).select(F.col("block").alias("of"), "at", "count", "best")
    documents = numbered.where("a IS NULL").select("key", "block", "n_a", "n_b", "n_links", "groups_sha256", "at", "times")
    kind = dict(numbered.dtypes)["key"]
    schema = f"key {kind}, n_a long, n_b long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return documents.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_answered, schema)


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None) -> DataFrame:
    """``key`` and the groups in order: ids of both sides and the bytes [start, end) of a space and the text."""
    kind = dict(df.select(key).dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = aligner(*_paths(paths))
        for batch in uncollected(batches):
            found = []
            for t in batch.column(1).to_pylist():
                own, end = [], 0
                for chunk in model.text(t):
                    for x in chunk[2].split(";"):
                        a, b = ([int(i) for i in side.split(",")] for side in x.split("|"))
                        start, end = end, end + sum(len(model.left[i]) for i in a)
                        own.append({"a": a, "b": b, "start": start, "end": end})
                found.append(own)
            kind = pa.list_(pa.struct([("a", _INTS), ("b", _INTS), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch([batch.column(0), pa.array(found, kind)], names=["key", "groups"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, groups array<struct<a: array<int>, b: array<int>, start: long, end: long>>")


def op11_dangling_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = aligned(base_documents(spark, sf_dir))
    return out.selectExpr("key AS doc_id", "n_a", "n_b", "n_links AS n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
