"""Toxic spans by a linear-chain conditional random field with latent token states.

Labels are given for documents, not for tokens. So the states of the tokens (0 clean, 1 toxic) are latent: a document is
toxic if at least one of its tokens is in state 1. The field scores a path of states by hashed features of the words in
state 1 (the word, its beginnings, its ending, a bias) and by transitions; the path without a toxic token scores 0, so

    P(document clean) = 1 / Z,   P(document toxic) = 1 - 1 / Z,

with Z from the forward pass. The likelihood of the documents' labels is climbed by gradients: the expected features of the
tokens (marginals from forward-backward), times -1 in a clean document and 1 / (Z - 1) in a toxic one. No word list and no token label is given or mined;
what is toxic comes out of the fit. Score of a document: 1 - 1 / Z. Offending offsets: tokens whose marginal is at least one half.

Passes are exact over whole documents of any length. Tokens are cut into chunks of ``CHUNK``; the chunks' 2 x 2 transfer
matrices are multiplied for all chunks at once, joined along each document, and states within the chunks follow from the values at their edges.

Fitting uses at most ``max_docs`` labelled documents of each label (a documented bound on labelled rows), whole, taken in the order of a hash of the text,
and one of equal texts. It runs on the driver, which holds a number for each token of these.

Cases: null and empty texts score 0 and have no spans; labels for unknown ids or with null values are ignored; an id labelled both ways counts for both; a
repeated or null id has a result for each row; without toxic or without clean labels all scores are 0; ties in the sampling hash are settled by the text; a very long text is one
row of its block; further columns, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import base_documents, materialize

#: Labelled documents of each label that are learned from.
MAX_DOCS = 6_000
CHUNK = 32
BITS = 20
#: The step's size, the sum of squares that gradients start from (so that words of few documents move slowly), and the pull to 0.
EPOCHS, STEP, START, RIDGE = 30, 1.0, 10.0, 1e-3
#: Before the fit, a token is toxic with about this log-odds.
PRIOR = -7.0
#: Bounds of log potentials; 32 steps of both at their bounds stay within a double.
MOST_EMIT, MOST_MOVE = 12.0, 8.0
CACHED_WORDS = 400_000
#: Tokens that are swept at once; a longer document is swept alone.
BLOCK = 150_000
THRESHOLD = 0.7
EDGE = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»“”’…"
#: Lengths of the beginnings of words.
STEMS = range(4, 9)
FEATURES = len(STEMS) + 3


def bare(token: str) -> str:
    return token.lower().strip(EDGE)


def feature_ids(word: str) -> list[int]:
    """Places of the word, its beginnings, its ending and the bias (last)."""
    import xxhash

    names = [f"w{word}", *[f"{k}{word[:k]}" for k in STEMS], f"e{word[-3:]}", "b"]
    return [xxhash.xxh32_intdigest(x) >> (32 - BITS) for x in names]


class Field:
    """Weights by hashed feature for state 1, and log scores of entering, leaving and staying in it; state 0 and staying there score 0."""

    def __init__(self, weights: np.ndarray, trans: np.ndarray):
        self.weights, self.trans = weights, trans

    def emission(self, word: str) -> float:
        return min(MOST_EMIT, max(-30.0, sum(map(self.weights.item, feature_ids(word)))))


class Sweep:
    """Forward-backward over documents: ``emit`` has the log score of state 1 of all their tokens, ``starts`` the first token of each."""

    def __init__(self, emit: np.ndarray, starts: np.ndarray, trans: np.ndarray):
        self.docs, self.sizes = len(starts), np.diff(np.r_[starts, len(emit)])
        self.chunks = -(-self.sizes // CHUNK)
        self.first = np.r_[0, np.cumsum(self.chunks)[:-1]].astype(np.int64)
        n = int(self.chunks.sum())
        self.place = np.repeat(self.first * CHUNK - starts, self.sizes) + np.arange(len(emit))
        e, real = np.zeros(n * CHUNK), np.zeros(n * CHUNK, bool)
        e[self.place], real[self.place] = np.exp(emit), True
        # A row for each place in a chunk, a column for each chunk; padding leaves values as they are.
        self.e, self.real = (np.ascontiguousarray(x.reshape(n, CHUNK).T) for x in (e, real))
        self.whole = self.real.all(1).tolist()
        self.enter, self.leave, self.stay = np.exp(trans)
        self._transfer()
        self._forward()

    def _step(self, x0: np.ndarray, x1: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        y0, y1 = x0 + x1 * self.leave, (x0 * self.enter + x1 * self.stay) * self.e[t]
        return (y0, y1) if self.whole[t] else (np.where(self.real[t], y0, x0), np.where(self.real[t], y1, x1))

    def _transfer(self) -> None:
        """[from, to] sums over the paths through each chunk, scaled, and the logs of the scales."""
        n = self.e.shape[1]
        rows = [(np.ones(n), np.zeros(n)), (np.zeros(n), np.ones(n))]
        for t in range(CHUNK):
            rows = [self._step(*x, t) for x in rows]
        m = np.array(rows)
        total = m.sum((0, 1))
        self.m, self.scale = m / total, np.log(total)

    def _turns(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Documents that have a k-th chunk, and these chunks."""
        order = np.argsort(-self.chunks, kind="stable")
        counts = np.searchsorted(-self.chunks[order], -np.arange(1, self.chunks.max(initial=0) + 1), side="right")
        return [(order[:c], self.first[order[:c]] + k) for k, c in enumerate(counts.tolist())]

    def _forward(self) -> None:
        self.logz = np.zeros(self.docs)
        self.before = np.zeros((2, self.e.shape[1]))
        now = np.zeros((2, self.docs))
        now[0] = 1  # a document begins after a clean token
        self.turns = self._turns()
        for docs, chunk in self.turns:
            self.before[:, chunk] = now[:, docs]
            out = (now[:, None, docs] * self.m[:, :, chunk]).sum(0)
            total = out.sum(0)
            self.logz[docs] += np.log(total) + self.scale[chunk]
            now[:, docs] = out / total

    def toxic(self) -> np.ndarray:
        """P(some token in state 1) of each document."""
        return -np.expm1(-np.maximum(self.logz, 0))

    def backward(self, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """P(state 1) of each token, and the sums of expected enterings, leavings and stays, times the documents' weights."""
        n = self.e.shape[1]
        after = np.zeros((2, n))
        now = np.ones((2, self.docs))
        for docs, chunk in reversed(self.turns):
            after[:, chunk] = now[:, docs]
            out = (self.m[:, :, chunk] * now[None, :, docs]).sum(1)
            now[:, docs] = out / out.sum(0)
        alpha = [(self.before[0], self.before[1])]
        for t in range(CHUNK):
            alpha.append(self._step(*alpha[-1], t))
        marginal, moves = np.zeros((CHUNK, n)), np.zeros(3)
        w = None if weight is None else np.repeat(weight, self.chunks)
        b0, b1 = after
        for t in range(CHUNK - 1, -1, -1):
            a0, a1 = alpha[t + 1]
            up = a1 * b1
            z = a0 * b0 + up
            marginal[t] = up / z
            arrive = self.e[t] * b1
            if w is not None:
                p0, p1 = alpha[t]
                share = w * self.real[t] / z
                moves += [(share * p0 * arrive).sum() * self.enter, (share * p1 * b0).sum() * self.leave, (share * p1 * arrive).sum() * self.stay]
            c0, c1 = b0 + self.enter * arrive, b0 * self.leave + self.stay * arrive
            b0, b1 = (c0, c1) if self.whole[t] else (np.where(self.real[t], c0, b0), np.where(self.real[t], c1, b1))
        return marginal.T.reshape(-1)[self.place], moves


def slopes(sweep: Sweep, toxic: np.ndarray) -> tuple[float, np.ndarray]:
    """The log likelihood of the labels, and its slope by each document's log Z."""
    z = np.maximum(sweep.logz, 1e-9)
    value = np.where(toxic, np.log(-np.expm1(-z)), -z).sum()
    return float(value), np.where(toxic, 1 / np.maximum(np.expm1(np.minimum(z, 50)), 1e-3), -1.0)


def fit_field(docs: Iterable[tuple[list[str], int]], epochs: int = EPOCHS) -> Field:
    """From words and label of each document. Words are kept once, tokens as their places."""
    index: dict[str, int] = {}
    places, sizes, labels = array("i"), [], []
    for words, y in docs:
        if words:
            places.extend([index.setdefault(w, len(index)) for w in words])
            sizes.append(len(words))
            labels.append(y == 1)
    model = Field(np.zeros(1 << BITS), np.zeros(3))
    bias = feature_ids("")[-1]
    if not any(labels) or all(labels):
        model.weights[bias] = -1e6
        return model
    model.weights[bias] = PRIOR
    token, y = np.frombuffer(places, np.int32), np.array(labels)
    ids = np.array([feature_ids(w) for w in index], np.int32)
    ends = np.r_[0, np.cumsum(sizes)]
    cuts = [0]
    for i in range(len(sizes)):
        if ends[i + 1] - ends[cuts[-1]] > BLOCK and i > cuts[-1]:
            cuts.append(i)
    cuts.append(len(sizes))
    squares, squares_t = np.full(1 << BITS, START), np.full(3, START)
    pull = RIDGE * np.sqrt(len(sizes))
    for _ in range(epochs):
        by_word = np.clip(model.weights[ids].sum(1), -30, MOST_EMIT)
        grad_word, moves = np.zeros(len(ids)), np.zeros(3)
        for a, b in zip(cuts, cuts[1:], strict=False):
            own = token[ends[a] : ends[b]]
            sweep = Sweep(by_word[own], ends[a:b] - ends[a], model.trans)
            weight = slopes(sweep, y[a:b])[1]
            marginal, expected = sweep.backward(weight)
            grad_word += np.bincount(own, marginal * np.repeat(weight, sweep.sizes), len(ids))
            moves += expected
        held = pull * model.weights
        held[bias] = 0
        grad = np.bincount(ids.ravel(), np.repeat(grad_word, FEATURES), 1 << BITS) - held
        squares += grad**2
        model.weights += STEP * grad / np.sqrt(squares)
        squares_t += moves**2
        model.trans = np.clip(model.trans + STEP * moves / np.sqrt(squares_t), -MOST_MOVE, MOST_MOVE)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str, fold: int, held_out: int, max_docs: int = MAX_DOCS) -> Field:
    """Fit on labelled documents (id, text) whose CRC32 of the id, mod ``fold``, is not ``held_out``."""
    known = labels.where(F.col(label).isNotNull() & (F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(fold)) != held_out))
    known = known.select("id", F.col(label).cast("int").alias("y")).distinct()
    some = lambda y: known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(max_docs)
    rows = docs.join(F.broadcast(some(1).union(some(0))), "id").where(F.length("text") > 0).groupBy("text", "y").agg(F.count(F.lit(1)).alias("copies"))
    rows = materialize(rows, "toxicity")  # a repeated id may have brought more than max_docs texts

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [" ".join(b for w in x.as_py().split() if (b := bare(w))) for x in batch.column(0)]
            yield pa.record_batch([pa.array(out, pa.string()), batch.column(1)], names=["words", "y"])

    sample = lambda y: rows.where(F.col("y") == y).orderBy(F.xxhash64("text"), "text").limit(max_docs).select("text", "y").mapInArrow(seen, "words string, y int")
    return fit_field((r["words"].split(" ") if r["words"] else [], r["y"]) for y in (1, 0) for r in sample(y).toLocalIterator())


def tagged(docs: DataFrame, model: Field) -> DataFrame:
    """id, score and spans (start, end in code points, p) of every row of ``docs`` (id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(Field(model.weights.astype(np.float32), model.trans))  # 2**BITS weights

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value

        class Emissions(dict):
            def __missing__(self, token: str) -> float:
                word = bare(token)
                found = self[token] = field.emission(word) if word else -30.0
                return found

        def swept(held: list[tuple[int, str, np.ndarray]]) -> Sweep:
            sizes = [len(emit) for _, _, emit in held]
            return Sweep(np.concatenate([emit for _, _, emit in held]), np.cumsum([0, *sizes[:-1]]), field.trans)

        def score_block(held: list[tuple[int, str, np.ndarray]], scores: np.ndarray, spans: list[list]) -> None:
            if not held:
                return
            scores[[i for i, _, _ in held]] = swept(held).toxic()
            likely = [h for h in held if scores[h[0]] >= 0.5]  # no marginal exceeds the document's probability
            if not likely:
                return
            marginal, at = swept(likely).backward()[0], 0
            for i, text, emit in likely:
                own = marginal[at : at + len(emit)]
                at += len(emit)
                spans[i] = [{"start": m.start(), "end": m.end(), "p": float(p)} for m, p in zip(_TOKEN.finditer(text), own, strict=True) if p >= 0.5]

        known = Emissions()
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
        for batch in batches:
            scores, spans = np.zeros(batch.num_rows), [[] for _ in range(batch.num_rows)]
            held: list[tuple[int, str, np.ndarray]] = []
            size = 0
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py() or ""
                tokens = text.split()
                if not tokens:
                    continue
                held.append((i, text, np.fromiter(map(known.__getitem__, tokens), float, len(tokens))))
                size += len(tokens)
                if size > BLOCK:
                    score_block(held, scores, spans)
                    held, size = [], 0
            score_block(held, scores, spans)
            if len(known) > CACHED_WORDS:
                known.clear()
            yield pa.record_batch([batch.column(0), pa.array(np.clip(scores, 0, 1)), pa.array(spans, kind)], names=["id", "score", "spans"])

    return docs.mapInArrow(tag, "id long, score double, spans array<struct<start:long,end:long,p:double>>")


#: What str.split() takes for white space is ``\s`` of Python's own expressions.
_TOKEN = re.compile(r"\S+")


def op9_crf_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base_documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("id"), "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("id"), "toxic")
    out = tagged(docs, train(docs, labels, "toxic", 3, 1))
    held = F.coalesce(F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"], F.round(s["p"], 3))), ",")
    return out.select(F.col("id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("spans").cast("long").alias("n_spans"), spans.alias("spans"))
