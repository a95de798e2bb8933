"""Exact token counts at every prefix of a text, by dynamic programming.

For a byte-pair model whose merges go by the score of the joined piece, a row of pieces is the encoding of its text if and only if each
neighbouring pair is the encoding of the two joined. So each prefix has one last piece: the one that ends there and goes with the last piece
of the prefix before it. ``count[p] = count[p - len(piece)] + 1`` follows, each position once, and answers every question on
prefixes (truncation, budgets) without encoding again.

A text is cut where no piece of the vocabulary spans two neighbouring characters; merges never cross such a place, so the table of a text
is the tables of its segments, each on top of the total before it. Workers keep the tables of segments that they have seen.

Cases: a null text counts as empty, and an empty text has no tokens; very long texts are handled whole, in time in proportion to their length;
rows are independent, so ties, repeated rows and null or repeated ids change nothing; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from textmill.llm.common import base_documents, uncollected

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
#: Segments whose tables a Python worker keeps; the store is emptied when it is full. Longer segments than LONG are not kept.
CACHED_SEGMENTS, LONG = 1_000_000, 48
#: New segments go on from the table of their first HEAD characters, of which so many are kept.
HEAD, CACHED_HEADS = 7, 200_000
#: How a space is written in pieces (fixed value).
MARK = "▁"
#: Segments by runs of letters and digits or of other characters, and by marks alone.
RUNS, MARKS = rf"{MARK}*\w+|{MARK}*[^\w{MARK}]+|{MARK}+", rf"{MARK}*[^{MARK}]+|{MARK}+"
UNKNOWN = -1


class PrefixCounter:
    """Tables of token counts for a sentencepiece byte-pair model with byte fallback and unchanged texts."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(SentencePieceProcessor(model_file=path).serialized_model_proto())
        norm, trained = proto.normalizer_spec, proto.trainer_spec
        plain = norm.name == "identity" and not norm.precompiled_charsmap and not norm.remove_extra_whitespaces and norm.add_dummy_prefix and norm.escape_whitespaces
        kinds = {p.type for p in proto.pieces}
        if trained.model_type != trained.BPE or not plain or not trained.byte_fallback or trained.treat_whitespace_as_suffix or kinds - {1, 2, 3, 6}:
            raise ValueError(f"{path}: not a byte-pair model with byte fallback over unchanged texts")
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == 1}
        self.pieces = list(self.scores)
        #: Ends of pieces: the piece's number if it is a piece that its own text is encoded as, else UNKNOWN.
        self.ends: dict[str, int] = {}
        for i, piece in enumerate(self.pieces):
            for k in range(1, len(piece)):
                self.ends.setdefault(piece[k:], UNKNOWN)
            if len(piece) == 1 or self.encode(piece) == [piece]:
                self.ends[piece] = i
            else:
                self.ends.setdefault(piece, UNKNOWN)
        self.longest = max(map(len, self.pieces), default=0)
        whole = [re.compile(x).findall for x in (RUNS, MARKS)]
        self.segments = next((f for f in whole if all(f(p) == [p] for p in self.pieces)), lambda text: [text])
        self.fits: dict[int, bool] = {}
        self.known: dict[str, bytes | array] = {}
        self.heads: dict[str, tuple[list[int], list[int]]] = {}

    def encode(self, text: str) -> list[str]:
        """Pieces by merging one pair after the other: the highest score first, the leftmost of equals."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fit(self, left: int, right: int) -> bool:
        """Whether the two pieces stand side by side in encodings."""
        a, b = self.pieces[left], self.pieces[right]
        found = self.fits[left << 32 | right] = self.ends.get(a + b, UNKNOWN) == UNKNOWN and self.encode(a + b) == [a, b]
        return found

    def table(self, segment: str) -> bytes | array:
        """The count at each prefix of a segment, from its first character on."""
        found = self.known.get(segment)
        if found is not None:
            return found
        head = segment[:HEAD]
        state = self.heads.get(head)
        if state is None:
            if len(self.heads) >= CACHED_HEADS:
                self.heads.clear()
            state = self.heads[head] = ([UNKNOWN], [0])
            self.extend(head, *state)
        last, count = state[0].copy(), state[1].copy()
        self.extend(segment, last, count)
        found = bytes(count[1:]) if max(count) < 256 else array("q", count[1:])
        if len(segment) <= LONG:
            if len(self.known) >= CACHED_SEGMENTS:
                self.known.clear()
            self.known[segment] = found
        return found

    def extend(self, segment: str, last: list[int], count: list[int]) -> None:
        """Goes on from the prefixes that have a last piece and a count already."""
        ends, fits, longest = self.ends, self.fits, self.longest
        for p in range(len(last), len(segment) + 1):
            start, least = p - 1, max(0, p - longest)
            while start >= least:
                piece = ends.get(segment[start:p])
                if piece is None:
                    start = -1
                    break
                if piece >= 0:
                    before = last[start]
                    if before < 0 or (ok := fits.get(before << 32 | piece)) or (ok is None and self.fit(before, piece)):
                        break
                start -= 1
            if start >= least:
                last.append(piece)
                count.append(count[start] + 1)
            else:  # a character without a piece stands as its bytes
                last.append(UNKNOWN)
                count.append(count[-1] + len(segment[p - 1].encode()))

    def prefixes(self, text: str | None) -> Prefixes:
        cut = self.segments(MARK + text.replace(" ", MARK)) if text else []
        known = self.known.get
        return Prefixes(cut, [known(s) or self.table(s) for s in cut])


class Prefixes:
    """The counts of one text: tables of its segments, each on top of the total before it."""

    def __init__(self, segments: list[str], tables: list[bytes | array]):
        self.segments, self.tables = segments, tables
        self.total = sum([t[-1] for t in tables])

    def counts(self) -> list[int]:
        """The count at every prefix, from the empty one to the whole text."""
        out, base = [], 0
        for table in self.tables:
            out += [base + c for c in table]
            base += table[-1]
        return [0, *out[1:]]  # the first character stands for the space that the model adds

    def within(self, budget: int) -> int:
        """Code points of the longest prefix of at most ``budget`` tokens."""
        if self.total <= budget:
            return max(0, sum(map(len, self.segments)) - 1)
        totals = list(accumulate([t[-1] for t in self.tables], initial=0))
        k = bisect_right(totals, budget) - 1  # all prefixes of later segments have more
        inside = next((i + 1 for i in range(len(self.tables[k]) - 1, -1, -1) if totals[k] + self.tables[k][i] <= budget), 0)
        return max(0, sum(map(len, self.segments[:k])) + inside - 1)


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _mapped(df: DataFrame, key: str, text: str, path: str | None, fields: str, of) -> DataFrame:
    """``key`` and the columns ``fields`` that ``of`` gives for each text and its prefixes."""
    rows = df.select(key, text)
    kind = dict(rows.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(path or model_path())
        for batch in uncollected(batches):
            found = [of(t or "", model.prefixes(t)) for t in batch.column(1).to_pylist()]
            out = pa.Table.from_arrays([batch.column(0)], names=["key"])
            for i, (name, pa_type) in enumerate(_ARROW[fields]):
                out = out.append_column(name, pa.array([f[i] for f in found], pa_type))
            yield from out.to_batches()

    return rows.mapInArrow(run, f"`{key}` {kind}, {fields}")


COUNTS, PREFIXES, CUT = "n_bytes long, n_tokens long, cut_chars long", "counts array<long>", "text string, n_tokens long"
_ARROW = {
    COUNTS: [("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("cut_chars", pa.int64())],
    PREFIXES: [("counts", pa.list_(pa.int64()))],
    CUT: [("text", pa.string()), ("n_tokens", pa.int64())],
}


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """``key``, bytes, tokens, and the code points of the longest prefix of at most ``limit`` tokens."""
    return _mapped(df, key, text, path, COUNTS, lambda t, p: (len(t.encode()), p.total, p.within(limit)))


def prefix_counts(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key`` and ``counts``: the token count at every prefix, so element ``n + 1`` is that of the first ``n`` code points."""
    return _mapped(df, key, text, path, PREFIXES, lambda t, p: (p.counts() if t else [0],))


def truncated(df: DataFrame, limit: int, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key``, the longest prefix of at most ``limit`` tokens (null: empty), and its tokens."""

    def cut(t: str, p: Prefixes) -> tuple[str, int]:
        n = p.within(limit)
        return t[:n], p.total if n == len(t) else p.counts()[n]

    return _mapped(df, key, text, path, CUT, cut)


def op13_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts(base_documents(spark, sf_dir))
    return out.selectExpr("doc_id", "n_bytes", "n_tokens", f"n_tokens > {LIMIT} AS over_limit", "cut_chars")
