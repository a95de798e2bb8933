"""Alignment of tokenizers, ball k-means and prefix counts against brute force."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import pytest

from tests.llm.conftest import ROWS, VECTORS
from textmill.llm import alignment, ball_kmeans, prefix_counts, registry

BITS = ["a", "b", " ", "  ", "the", "é", "日", "𝄞", "\n", "\t", "▁", "ing", "1", ".", "aaa", "(", ")", '"', "=", "\x00", "tion", "<s>", "'s", "_", ",", "<|endoftext|>", "\xa0"]


def random_texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(BITS) for _ in range(rnd.randint(0, 18))) for _ in range(n)]


# 11 ------------------------------------------------------------------------------------------------


def plain_groups(text):
    """Groups by all common ends of the whole text's tokens, and links by all pairs that end together."""
    model = alignment.aligner(*alignment._paths(None))
    if not text:
        return [], [], [], []
    a, b = model.a.encode(" " + text, add_special_tokens=False).ids, model.b.encode(text)
    first, second = [model.left[i] for i in a], [model.right[i] for i in b]
    if not b"".join(first) == b"".join(second) == (" " + text).encode():
        return [], [], [], []
    ends = [list(accumulate(map(len, x))) for x in (first, second)]
    places = [{e: n + 1 for n, e in enumerate(x)} for x in ends]
    cuts = [0, *sorted(set(ends[0]) & set(ends[1]))]
    at = [[p.get(c, 0) for c in cuts] for p in places]
    out = [(a[at[0][n] : at[0][n + 1]], b[at[1][n] : at[1][n + 1]]) for n in range(len(cuts) - 1)]
    links = [(i, j) for i, x in zip(a, ends[0], strict=True) for j, y in zip(b, ends[1], strict=True) if x == y] if len(a) < 3000 else [(x[-1], y[-1]) for x, y in out]
    return a, b, out, links


def plain_alignment(rows):
    found = [(key, *plain_groups(t)) for key, t in rows]
    count = Counter(x for r in found for x in r[4])
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for key, a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        out.append((key, len(a), len(b), len(groups), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), digest))
    return sorted(out, key=str)


def aligned_rows(frame):
    return sorted([(r["key"], r["n_a"], r["n_b"], r["n_links"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in frame.collect()], key=str)


def test_alignment_of_the_fixture(spark, folder):
    rows = registry.QUERIES["op11_dangling_suffix"](spark, folder).collect()
    got = sorted([(r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in rows], key=str)
    assert got == plain_alignment([(i, t) for i, t, _ in ROWS])


@pytest.mark.parametrize("block", [1, 40, 10**6])
def test_alignment_of_random_texts(spark, block):
    rows = [(None if i % 50 == 0 else i // 2, t) for i, t in enumerate(random_texts(800, block))]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, block int").repartition(3)
    assert aligned_rows(alignment.aligned(df, block=block)) == plain_alignment(rows)


def test_groups_have_their_bytes(spark):
    rows = [(i, t) for i, t in enumerate(random_texts(200, 5))]
    for r in alignment.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        text = (" " + rows[r["doc_id"]][1]).encode()
        model = alignment.aligner(*alignment._paths(None))
        assert [(g["a"], g["b"]) for g in r["groups"]] == plain_groups(rows[r["doc_id"]][1])[2]
        assert all(b"".join(model.left[i] for i in g["a"]) == text[g["start"] : g["end"]] for g in r["groups"])


def test_transducer_of_small_vocabularies():
    left, right = [b"ab", b"c", b"d", b"abc"], [b"a", b"bc", b"d", b"abcd"]
    t = alignment.Transducer(left, right)
    assert t.groups([0, 1, 2], [0, 1, 2]) == [([0, 1], [0, 1]), ([2], [2])]
    assert t.groups([3, 2], [3]) == [([3, 2], [3])]
    assert t.groups([0, 2], [0, 1]) is None and t.groups([0], [0]) is None and t.groups([], []) == []


# 12 ------------------------------------------------------------------------------------------------


def plain_kmeans(rows, k=40, rounds=5):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [max(-ball_kmeans.MOST, min(ball_kmeans.MOST, x)) for x in q]) for i, q in kept]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(q) for _, q in order[:k]]

    def nearest():
        out = []
        for _, q in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), j) for j, c in enumerate(centroids)))
        return out

    for _ in range(rounds):
        found = nearest()
        for j in range(len(centroids)):
            own = [q for (_, q), (_, at) in zip(kept, found, strict=True) if at == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = nearest()
    big, inertia = (1 << 63) - 1, Counter()
    for d, j in found:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(i, j, min(d, big), min(inertia[j], big), min(sum(inertia.values()), big), digest[j]) for (i, _), (d, j) in zip(kept, found, strict=True)], key=str)


def cluster_rows(frame):
    return sorted([(r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in frame.collect()], key=str)


def test_clusters_of_the_fixture(spark, folder):
    assert cluster_rows(registry.QUERIES["op12_ball_kmeans"](spark, folder)) == plain_kmeans([(r[0], r[1]) for r in VECTORS])


@pytest.mark.parametrize("n", [1, 3, 45, 150])
def test_clusters_with_many_ties(spark, tmp_path, n):
    rnd = random.Random(n)
    rows = [(i, [float(rnd.randint(0, 1)) if j < 4 else 0.0 for j in range(64)]) for i in range(n)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert cluster_rows(registry.QUERIES["op12_ball_kmeans"](spark, str(tmp_path))) == plain_kmeans(rows)


def test_clusters_of_given_vectors(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    assert cluster_rows(registry.QUERIES["op12_ball_kmeans"](spark, path)) == plain_kmeans(rows)


def test_balls_spare_comparisons(spark):
    rnd = random.Random(3)
    rows = [(i, [10.0 * (i % 8 == j % 8) + rnd.random() for j in range(64)]) for i in range(800)]
    vectors = ball_kmeans.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    _, centroids, totals = ball_kmeans.ball_kmeans(vectors, k=8)
    compared = sum(t["compared"] for t in totals.values())
    assert len(centroids) == 8 and compared < 0.6 * 800 * 7


# 13 ------------------------------------------------------------------------------------------------


def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=prefix_counts.model_path())


def test_counts_of_the_fixture(spark, folder):
    model = library()
    rows = registry.QUERIES["op13_prefix_counts"](spark, folder).collect()
    want = sorted((i, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for i, t, _ in ROWS)
    assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows) == want
    texts = {i: t or "" for i, t, _ in ROWS}
    for r in rows:
        text = texts[r["doc_id"]]
        assert r["cut_chars"] == len(text) if not r["over_limit"] else len(model.encode(text[: r["cut_chars"]])) <= 4096
        assert not r["over_limit"] or all(len(model.encode(text[: r["cut_chars"] + i])) > 4096 for i in (1, 2, 5, 50))


def test_counts_at_every_prefix(spark):
    model, texts = library(), random_texts(300, 9) + ["x" * 400, "aaab" * 90, "▁" * 70, "é" * 300, "日本" * 200, None]
    rows = {r["doc_id"]: r["counts"] for r in prefix_counts.prefix_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        assert rows[i] == [len(model.encode((t or "")[:n])) for n in range(len(t or "") + 1)]


@pytest.mark.parametrize("limit", [0, 1, 3, 7])
def test_longest_prefix_within_a_budget(spark, limit):
    model, texts = library(), [*random_texts(300, limit), None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in prefix_counts.truncated(df, limit).collect():
        t = texts[r["doc_id"]] or ""
        want = t[: max(n for n in range(len(t) + 1) if len(model.encode(t[:n])) <= limit)]
        assert (r["text"], r["n_tokens"]) == (want, len(model.encode(want)))


def test_counts_of_given_documents(spark):
    model, path = library(), "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = registry.QUERIES["op13_prefix_counts"](spark, path).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: len(model.encode(t)) for i, t in texts.items()}
