"""Quality classifier: a generalised additive model with pairwise interactions.

Every text gives ``FEATURES`` numbers. Each is cut into quantile bins; cyclic boosting visits the features in turn and
adds a shallow tree's leaf values (at most four leaves on one feature) to the feature's lookup table, at a small rate. Then
the pairs of features whose joint table explains most of what is left are boosted in the same way with trees that split
once on either side. A score is the sum of table entries, looked up for all rows of a batch at once.

The tables are fitted on the driver from at most ``max_rows`` labelled rows (a documented bound, taken by a hash
of the id); features and scores are computed for every row of the table, in batches on the executors.

Cases: null and empty texts have all features zero and are scored like any other; labels for unknown ids or with null
values are ignored; a repeated id has a result for each row; without labels of both kinds every score is the
share of good labels (0.5 with none); an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import base_documents, materialize

FEATURES = [
    "log_chars", "log_words", "word_length", "upper", "digit", "symbol", "punctuation", "exclaim", "beyond_ascii", "distinct_words",
    "top_word", "repeated_lines", "repeated_grams", "line_length", "symbol_words", "capital_words", "short_words", "bars", "next_same", "byte_entropy",
]
MAX_ROWS = 40_000
BINS, RATE, ROUNDS, PAIR_BINS, PAIRS, PAIR_ROUNDS = 32, 0.1, 120, 8, 6, 60
THRESHOLD = 0.3

_UPPER, _DIGIT = np.arange(65, 91), np.arange(48, 58)
_SYMBOL = np.frombuffer(b"#*$%&|<>@^~=_\\{}[]", np.uint8)
_PUNCT = np.frombuffer(b".,;:'\"()-?", np.uint8)
_LETTERS = np.r_[_UPPER, np.arange(97, 123)]
_ODD = frozenset(b"#*$%&|<>!")


def text_features(text: str | None) -> list[float]:
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), len(data)
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters = max(1, int(count[_LETTERS].sum()) + int(count[0xC3]))
    seen = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    ids = {w: i for i, w in enumerate(seen)}
    code = np.fromiter(map(ids.__getitem__, words), np.int64, n)
    repeated = 0.0
    if n >= 3:
        gram = (code[:-2] * len(ids) + code[1:-1]) * len(ids) + code[2:]
        repeated = 1 - len(np.unique(gram)) / len(gram)
    odd = capital = short = 0
    for w, c in seen.items():
        odd += c * (w[-1] in _ODD or w[0] in _ODD)
        capital += c * (65 <= w[0] <= 90)
        short += c * (len(w) <= 3)
    share = count[count > 0] / size
    return [
        float(np.log1p(size)), float(np.log1p(n)), (size - n) / n, count[_UPPER].sum() / letters, count[_DIGIT].sum() / size, count[_SYMBOL].sum() / size,
        count[_PUNCT].sum() / size, count[33] / size, count[128:].sum() / size, len(seen) / n, max(seen.values()) / n,
        1 - len(set(lines)) / max(1, len(lines)), repeated, float(np.log1p(size / max(1, len(lines)))), odd / n, capital / n, short / n,
        count[124] / n, float((code[1:] == code[:-1]).mean()) if n > 1 else 0.0, float(-(share * np.log2(share)).sum()),
    ]


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [text_features(x.as_py()) for x in batch.column(1)]
        yield pa.record_batch([batch.column(0), pa.array(rows, pa.list_(pa.float32()))], names=["id", "x"])


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(_featured, "id long, x array<float>")


class AdditiveModel:
    """``intercept`` + tables[f][bin] for each feature + pair tables; cut points are sorted, bin = number of cuts below or at the value."""

    def __init__(self, intercept: float, cuts: list[np.ndarray], tables: list[np.ndarray], pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]):
        self.intercept, self.cuts, self.tables, self.pairs = intercept, cuts, tables, pairs

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for f, (cut, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            out += table[np.searchsorted(cut, x[:, f], side="right")]
        for f, g, cf, cg, table in self.pairs:
            out += table[np.searchsorted(cf, x[:, f], side="right"), np.searchsorted(cg, x[:, g], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values by bin of the best tree of that depth over sums of gradients and curvatures."""
    if depth and len(g) > 1:
        gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl)
        at = int(gain.argmax()) + 1
        if gain[at - 1] > _gain(g.sum(), h.sum()) + 1e-9:
            return np.r_[_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)]
    return np.full(len(g), g.sum() / (h.sum() + 1.0))


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Leaf values of the best tree that splits once on each side (four quadrants), and its gain."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    best, place = -1.0, (1, 1)
    for i in range(1, g.shape[0]):
        for j in range(1, g.shape[1]):
            a, b, c = (cg[i - 1, j - 1], ch[i - 1, j - 1]), (cg[i - 1, -1], ch[i - 1, -1]), (cg[-1, j - 1], ch[-1, j - 1])
            quads = (a, (b[0] - a[0], b[1] - a[1]), (c[0] - a[0], c[1] - a[1]), (cg[-1, -1] - b[0] - c[0] + a[0], ch[-1, -1] - b[1] - c[1] + a[1]))
            total = sum(_gain(x, y) for x, y in quads)
            if total > best:
                best, place = total, (i, j)
    out = np.zeros_like(g)
    for rows in (slice(0, place[0]), slice(place[0], None)):
        for cols in (slice(0, place[1]), slice(place[1], None)):
            out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + 1.0)
    return out, best


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    intercept, dims = float(np.log(share / (1 - share))), len(FEATURES)
    if not len(y) or y.min() == y.max():
        return AdditiveModel(intercept, [np.empty(0)] * dims, [np.zeros(1)] * dims, [])
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(dims)]
    bins = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    logit = np.full(len(y), intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(dims):
            g, h = slopes()
            size = len(tables[f])
            step = RATE * _tree(np.bincount(bins[f], g, size), np.bincount(bins[f], h, size))
            tables[f] += step
            logit += step[bins[f]]
    coarse_cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) for f in range(dims)]
    coarse = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(coarse_cuts)]
    g, h = slopes()

    def joint(f: int, k: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (len(coarse_cuts[f]) + 1, len(coarse_cuts[k]) + 1)
        at = coarse[f] * shape[1] + coarse[k]
        return np.bincount(at, g, shape[0] * shape[1]).reshape(shape), np.bincount(at, h, shape[0] * shape[1]).reshape(shape), at

    gains = sorted(((_cross(*joint(f, k, g, h)[:2])[1], f, k) for f in range(dims) for k in range(f)), reverse=True)[:PAIRS]
    pair_tables = {(f, k): np.zeros((len(coarse_cuts[f]) + 1, len(coarse_cuts[k]) + 1)) for _, f, k in gains}
    for _ in range(PAIR_ROUNDS):
        for (f, k), table in pair_tables.items():
            gs, hs, at = joint(f, k, *slopes())
            step = RATE * _cross(gs, hs)[0]
            table += step
            logit += step.ravel()[at]
    return AdditiveModel(intercept, cuts, tables, [(f, k, coarse_cuts[f], coarse_cuts[k], t) for (f, k), t in pair_tables.items()])


def train(table: DataFrame, labels: DataFrame, label: str, fold: int, held_out: int, max_rows: int = MAX_ROWS) -> AdditiveModel:
    """Fit on at most ``max_rows`` labelled rows whose CRC32 of the id, mod ``fold``, is not ``held_out``."""
    known = labels.where(F.col(label).isNotNull() & (F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(fold)) != held_out))
    known = known.select("id", F.col(label).cast("double").alias("y")).orderBy(F.xxhash64("id"), "id", "y").limit(max_rows)  # bounded
    rows = table.join(F.broadcast(known), "id").select("x", "y").orderBy(F.xxhash64("x", "y"), "x", "y").limit(2 * max_rows).toPandas()  # repeated ids may bring more
    x = np.array(rows["x"].tolist(), np.float32).reshape(len(rows), len(FEATURES)).astype(float)
    return fit(x, rows["y"].to_numpy(float))


def scored(table: DataFrame, model: AdditiveModel) -> DataFrame:
    """id and score of every row of a feature table."""
    shared = table.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(FEATURES)).astype(float)
            yield pa.record_batch([batch.column(0), pa.array(shared.value.score(x))], names=["id", "score"])

    return table.mapInArrow(score, "id long, score double")


def op5_additive_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("id"), "quality")
    table = materialize(features(base_documents(spark, sf_dir)), "features")
    out = scored(table, train(table, labels, "quality", 5, 0))
    held = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(5)) == 0
    return out.select(F.col("id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
