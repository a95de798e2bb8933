from __future__ import annotations

import gzip
import io
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.functions import bpe
from textmill.functions import text as T
from textmill.operators import artifacts, cleaning, progress, records, sequences, tuning
from textmill.plans import pipelines, planner
from textmill.sources import readers, writers
from textmill.streaming import streams


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("see http://a.b/c?d=e&f=<x> and https://é.com/zz. End", "see [URL] and https://é.com/zz. End"),
        ("&gt;!spoil!&lt; t\n&gt; q &gt; r\rzz\nlast", "spoil t q &gt; r zz last"),
        ("/u/bob-1 /r/py u/al her/his and/or/not", "[USER] [SUBREDDIT] [USER] he[SUBREDDIT] and/o[SUBREDDIT]"),
        ("EDIT: credited UPDATE updates", "cred s"),
        ("**multi\nline** *a*b*", "multi line ab*"),
        ("**b** *i* ~~s~~ x^été^2", "b i s xété2"),
        ("&gt; a b\nc İx eDıT", "a b c İx"),
        ("", ""),
        (None, ""),
    ],
)
def test_clean_post(spark, text, want):
    assert one(spark, T.clean_post(F.lit(text).cast("string"))) == want


def test_white_space(spark):
    text = " a\u0085b\u001cc　"
    assert one(spark, T.word_count(F.lit(text))) == 3
    assert one(spark, T.strip(F.lit(text))) == "a\u0085b\u001cc"


def test_clean_dump(spark):
    clean = lambda t: one(spark, T.clean_dump(F.lit(t).cast("string")))
    assert clean(None) is None and clean("[deleted]") is None and clean("short text") is None
    assert clean("see  http://a.b/c here, **bold** words in a line") == "see  here, bold words in a line"
    assert clean("http://abcdefghijklmnopqrstuvwxyz.com x") is None


def reason(spark, body, title="", score=1, over=False, own=True, raw=None):
    words = len((title + " " + body).split())
    c = cleaning.quality_reason(F.lit(title), F.lit(body), F.lit(words), F.lit(len(body.split()) if raw is None else raw), F.lit(score), F.lit(over), F.lit(own))
    return one(spark, c)


def many(n):
    return " ".join(f"w{i}" for i in range(n))


@pytest.mark.parametrize(
    ("want", "options"),
    [
        ("deleted_or_removed", {"body": "[DELETED]", "title": "123456789"}), ("too_short", {"body": "[DELETED]", "title": "1234567890"}), ("nsfw", {"body": many(9), "over": True}),
        ("too_short", {"body": many(4)}), ("high_quality", {"body": many(5)}), ("high_quality", {"body": many(10000)}), ("too_long", {"body": many(10001)}),
        ("spam_pattern", {"body": "please subscribe if you can now"}), ("high_quality", {"body": " ".join(["a"] * 10)}), ("repetitive", {"body": many(7) + " a a a a"}),
        ("high_quality", {"body": many(14) + " a a a a a a"}), ("high_quality", {"body": many(9), "score": -10}), ("heavily_downvoted", {"body": many(9), "score": -11}),
        ("link_post_short_text", {"body": many(19), "own": False}), ("high_quality", {"body": many(20), "own": False}),
    ],
)
def test_reasons(spark, want, options):
    assert reason(spark, **options) == want


@pytest.mark.parametrize(("size", "points"), [(1000, 0), (1001, 10), (2000, 10), (2001, 20), (5000, 20), (5001, 30)])
def test_article_length_points(spark, size, points):
    assert one(spark, T.score_article(F.lit("x" * size), F.lit(""), F.lit(""))) == points


@pytest.mark.parametrize(("score", "points"), [(0, 0), (1, 5), (10, 5), (11, 10), (50, 10), (51, 15), (100, 15), (101, 20)])
def test_post_points(spark, score, points):
    assert one(spark, T.score_post(F.lit(score), F.lit(0), F.lit(""), F.lit(""))) == points


@pytest.mark.parametrize(("n", "windows", "estimate"), [(0, 1, 1), (1023, 1, 1), (1024, 1, 1), (1025, 2, 1), (1536, 2, 2), (1537, 3, 2), (2048, 3, 3), (5000, 9, 8)])
def test_windows(spark, n, windows, estimate):
    df = spark.range(1).select(F.when(F.lit(n) > 0, F.sequence(F.lit(1), F.lit(max(n, 1)))).otherwise(F.array().cast("array<int>")).alias("ids"))
    rows = sequences.token_windows(df, "ids").orderBy("window").collect()
    assert len(rows) == windows == df.select(sequences.window_count(F.size("ids"))).first()[0]
    assert df.select(sequences.window_estimate(F.size("ids"))).first()[0] == estimate
    assert sorted({i for r in rows for i in r["input_ids"]}) == list(range(1, n + 1))


def test_packing_tails_and_examples(spark):
    df = spark.createDataFrame([([7, 0, 9, 4, 5],)], "ids array<int>")
    assert [r["input_ids"] for r in sequences.pack(df, "ids", 8, "pad").collect()] == [[7, 0, 9, 4, 5, 0, 0, 0]]
    assert sequences.pack(df, "ids", 8, "drop").count() == 0
    a, b, m = df.select(*sequences.shift(F.slice("ids", 1, 3))).first()
    assert (a, b, m) == ([7, 0], [0, 9], [1, 0])
    ids, labels = df.select(*sequences.supervised(F.col("ids"), 7)).first()
    assert ids == [7, 0, 9, 4, 5, 0, 0] and labels == [7, -100, 9, 4, 5, -100, -100]
    padded = sequences.pad_to_longest(spark.createDataFrame([("f", [1]), ("f", [1, 2, 3])], "file string, ids array<int>"), "file", "ids")
    assert sorted((r["padded_ids"], r["attention_mask"]) for r in padded.collect()) == [([1, 0, 0], [1, 0, 0]), ([1, 2, 3], [1, 1, 1])]


def test_padding_by_broadcast_and_by_group(spark, monkeypatch):
    rows = spark.createDataFrame([("a", [1]), ("a", [1, 2, 3]), ("b", []), (None, [4]), ("c", [5, 6])], "file string, ids array<int>")
    want = [("a", [1, 0, 0], [1, 0, 0], 1), ("a", [1, 2, 3], [1, 1, 1], 3), ("b", [], [], 0), ("c", [5, 6], [1, 1], 2)]
    for few in (sequences.FEW_GROUPS, 3, 2):
        monkeypatch.setattr(sequences, "FEW_GROUPS", few)
        got = sequences.pad_to_longest(rows, "file", "ids").select("file", "padded_ids", "attention_mask", "sequence_length")
        assert sorted(map(tuple, got.collect())) == want
    assert sequences.pad_to_longest(rows.where("false"), "file", "ids").count() == 0


def test_greedy_chunks(spark):
    df = spark.createDataFrame([("a", i, n) for i, n in enumerate([60, 50, 40, 200, 10])], "file string, at int, bytes long")
    chunks = lambda early: [r["chunk"] for r in sequences.greedy_chunks(df, "file", ["at"], "bytes", 100, early).orderBy("at").collect()]
    assert chunks(True) == [1, 2, 2, 3, 4]
    assert chunks(False) == [1, 1, 2, 2, 3]


def test_splits_partition_the_input(spark):
    df = spark.range(1000).withColumn("s", F.when(F.col("id") < 5, "rare").otherwise((F.col("id") % 3).cast("string")))
    out = cleaning.split(df, "id", F.col("s"))
    got = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert sum(got.values()) == 1000 == out.select("id").distinct().count()
    assert abs(got["train"] - 700) <= 4 and abs(got["validation"] - 150) <= 4
    held = {r["split"]: r["count"] for r in cleaning.holdout(spark.range(95), "id").groupBy("split").count().collect()}
    assert held == {"eval": 9, "train": 86}


def test_first_wins_is_idempotent_and_order_matters(spark):
    df = spark.createDataFrame([(2, "A  b"), (1, "a b"), (3, "c"), (4, None)], "id long, text string")
    key = T.key_training(T.collapse(F.col("text")))
    out = cleaning.first_wins(df, key, "id")
    assert sorted(r["id"] for r in out.collect()) == [1, 3]
    assert cleaning.first_wins(out, key, "id").count() == 2


def test_stage_orders_differ(spark):
    """A poor first copy hides a good second one, unless quality is judged first."""
    text = "some words that are long enough to be kept here"
    rows = spark.createDataFrame([(1, text, 0), (2, text, 5)], "doc_id long, selftext string, score long")
    assert pipelines.clean_dumps(rows, "selftext", "score", "doc_id").count() == 0
    items = spark.createDataFrame([(1, text, 10.0), (2, text, 40.0)], "doc_id long, training_text string, quality_score double")
    assert [r["doc_id"] for r in pipelines.multi_source(items, "doc_id").collect()] == [2]


def test_records(spark):
    raw = spark.createDataFrame([("1", "T", "", "c", "12", None), ("2", "T", "b", "c", "12.5", "Py")], "id string, title string, selftext string, content string, score string, subreddit string")
    got = {r["id"]: r for r in records.posts(raw).collect()}
    assert got["1"]["selftext"] == "c" and got["1"]["score"] == 12 and got["1"]["normalizable"]
    assert got["2"]["score"] is None and not got["2"]["normalizable"] and got["2"]["subreddit"] == "py"
    wrapped = spark.sql("SELECT named_struct('id', 'x', 'title', 'in') AS data, 'out' AS title")
    assert records.posts(wrapped).first()["title"] == "in"
    two = spark.createDataFrame([("1", "t", "reddit"), ("2", "t", "huggingface_openwebtext"), ("3", "t", "other")], "id string, text string, source string")
    assert records.unified(two).count() == 2 and records.unified(two, unknown=True).count() == 3
    dump = spark.createDataFrame([("1", "a body of ten", "py_comments.zst"), ("2", "[deleted]", "py_comments.zst")], "id string, body string, file string")
    row = records.dump_rows(dump, F.col("file")).collect()
    assert [(r["subreddit"], r["type"]) for r in row] == [("py", "comment")]
    assert one(spark, T.dialogue(F.lit("why?"), F.lit("x"))) == "Question: why?\n\nAnswer: x"
    assert one(spark, records.plain(F.lit("[deleted]"), F.lit("x"))) == "x"
    article = spark.createDataFrame([("T", "c" * 3, "s" * 60, "k")], "title string, content string, summary string, category string")
    assert records.articles(article).first()["training_text"] == f"Title: T\n\nSummary: {'s' * 60}\n\nContent: ccc"
    assert records.general(spark.createDataFrame([("1", "", "c")], "id string, title string, content string")).first()["training_text"] == "c"


def test_fine_tuning_formats(spark):
    none = F.lit(None).cast("string")
    lit = F.lit
    messages = F.array(F.struct(lit("user").alias("role"), lit("hi").alias("content")), F.struct(lit("assistant").alias("role"), lit("yo").alias("content")))
    assert one(spark, tuning.chat(messages, none, none, none)) == "<|user|>hi<|end|>\n<|assistant|>yo<|end|>\n"
    empty = lit(None).cast("array<struct<role:string,content:string>>")
    assert one(spark, tuning.chat(empty, lit("a"), lit("b"), none)) == "<|user|>a<|end|>\n<|assistant|>b<|end|>"
    assert one(spark, tuning.instruct(lit("i"), none, lit("o"))) == "### Instruction:\ni\n\n### Response:\no"
    assert one(spark, tuning.instruct(lit("i"), lit("n"), lit("o"))) == "### Instruction:\ni\n\n### Input:\nn\n\n### Response:\no"
    assert one(spark, tuning.code(lit("p"), lit("c"), none, none)) == "# Task: p\n\nc"
    assert one(spark, tuning.custom(none, none, none, lit("a"), lit("b"), [])) == "a\nb"


def test_metrics(spark):
    words = lambda s: F.split(F.lit(s), " ")
    assert one(spark, tuning.simple_bleu(words("a b c d"), words("a b x"), 1)) == 0.5
    assert one(spark, tuning.simple_bleu(words("a"), words("a b"), 2)) == 0.0
    assert one(spark, tuning.pattern_consistency(words("a b c d"), words("x a b c"))) == 0.5
    rows = spark.createDataFrame([(1, 1), (2, 3), (4, -100)], "p int, l int")
    assert tuning.token_accuracy(rows, "p", "l").first()["accuracy"] == 0.5
    rep = tuning.repetition_rate(spark.createDataFrame([("a b c a b c".split(),)], "w array<string>"), "w").first()
    assert (rep["distinct"], rep["repeated"]) == (3, 1)
    assert one(spark, T.perplexity(F.lit(1000.0))) == float("inf")
    assert one(spark, T.eta(F.lit(3725.0))) == "1h 2m"


def test_planner(spark):
    hours = {g: spark.range(1).select(planner.training(F.lit(1_000_000_000), g)["hours"]).first()[0] for g in (1, 4)}
    batch = {g: spark.range(1).select(planner.training(F.lit(1_000_000_000), g)["effective_batch_size"]).first()[0] for g in (1, 4)}
    assert batch[4] > batch[1] and hours[4] < hours[1]
    assert spark.range(1).select(planner.local_training(F.lit(51_000_000_000))["recommended_steps"]).first()[0] == 50_000
    assert one(spark, planner.ready(F.lit(1), F.lit(1), F.lit(4), F.lit(19))) is False
    assert one(spark, planner.cleaning(F.lit(2_000_000))["n_workers"]) == 8
    assert one(spark, planner.processing(F.lit(20_000_000), F.lit(10.0), F.lit(8))["staged"]) is True


def test_progress(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([5, 3, 4, 2])], "step long, loss double")
    out = df.select("step", progress.running_best("loss", ["step"]).alias("best"), progress.trend("loss", ["step"]).alias("trend"), progress.slope("loss", "step", ["step"]).alias("slope")).orderBy("step").collect()
    assert [r["best"] for r in out] == [5, 3, 3, 2] and [r["trend"] for r in out] == ["start", "improving", "stable", "improving"]
    assert out[0]["slope"] == 0 and abs(out[1]["slope"] + 2) < 1e-9


def test_bpe(spark):
    assert one(spark, F.size(bpe.pretokens(F.lit("I'll go  now!")))) == 6
    df = spark.createDataFrame([("low lower lowest new newer I will build better habits.",)] * 5 + [("naïve été",)], "text string")
    merges = bpe.train(df, "text", 300)
    assert 0 < len(merges) <= 300 - 256 - len(bpe.SPECIAL)
    model = bpe.Bpe(merges)
    for r in bpe.encode(df, "text", merges, ["text"]).collect():
        assert model.decode(r["input_ids"]) == r["text"]


def test_bpe_encodes_texts_without_tokens(spark):
    from textmill import queries

    frame = spark.createDataFrame([(1, "ab ab", 5), (2, "", 0), (3, None, None), (4, None, 3)], "doc_id long, text string, n_chars long")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(queries, "documents", lambda *_: frame)
        rows = queries.QUERIES["bpe_encode"](spark, "").orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == [(1, 3, 1.666667), (2, 0, None), (3, 0, None), (4, 0, None)]


def test_bpe_counts_every_type(spark):
    from collections import Counter

    from textmill import queries

    spelt = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    frame = spark.createDataFrame([(i, f"common{spelt(i % 50)}" + f" rare{spelt(i)}zq" * 2 + f" once{spelt(i)}qz") for i in range(24_000)], "doc_id long, text string")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(queries, "documents", lambda *_: frame)
        merges = [(bytes.fromhex(r["left_hex"]), bytes.fromhex(r["right_hex"])) for r in queries.QUERIES["bpe_train"](spark, "").orderBy("rank").collect()]
    counts = Counter()
    for r in bpe.pretoken_counts(frame, "text").collect():
        counts[tuple(bytes([b]) for b in r["token"].encode())] += r["n"]
    assert len(counts) > 40_000
    for got in merges[:20]:  # plain BPE over all types
        pairs = Counter()
        for form, n in counts.items():
            for p in zip(form, form[1:], strict=False):
                pairs[p] += n
        assert got == max(pairs, key=lambda p: (pairs[p], p))
        after = Counter()
        for form, n in counts.items():
            after[tuple(bpe.merge(list(form), got))] += n
        counts = after
    assert len(merges) > 2000


def test_readers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "1", "text": "x"}\n\nnot json\n{"id": "2", "text": "é"}\n')
    with gzip.open(tmp_path / "b.jsonl.gz", "wt") as f:
        f.write('{"id": "3", "text": "z"}\n')
    got = readers.json_lines(spark, str(tmp_path), "id string, text string").cache()
    assert sorted(r["id"] for r in got.where("bad IS NULL").collect()) == ["1", "2", "3"]
    assert {r["source_file"]: r["bad"] for r in readers.corrupt_counts(got).collect()}["a.jsonl"] == 1
    lines = readers.numbered_lines(spark, str(tmp_path), "id string, text string", "*.jsonl")
    assert sorted((r["id"], r["source_line"]) for r in lines.collect()) == [("1", 1), ("2", 4)]
    (tmp_path / "s.json").write_text(json.dumps([{"prompt": "p", "response": "r"}, {"instruction": "i"}]))
    assert readers.sft(spark, str(tmp_path / "s.json")).count() == 2
    with pytest.raises(ValueError):
        readers.sft(spark, "x.csv")
    assert readers.text_column(spark.createDataFrame([(1, "a")], "n int, prompt string")) == "prompt"
    both = readers.union_of([got.select("id"), got.select("id", "text")])
    assert both.columns == ["id", "source_rank", "text"]


def test_token_archives(spark, tmp_path):
    rng = np.random.default_rng(0)
    data = rng.integers(0, 50_000, (100, 16)).astype("int32")
    np.savez(tmp_path / "tokenized_file_0.npz", input_ids=data)
    np.savez(tmp_path / "other.npz", data=data[0])
    np.savez(tmp_path / "none.npz", nothing=data)
    (tmp_path / "bad.npz").write_bytes(b"damaged")
    got = readers.token_archives(spark, str(tmp_path)).withColumn("name", F.element_at(F.split("file", "/"), -1))
    counts = {r["name"]: (r["n"], r["s"]) for r in got.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.first("status").alias("s")).collect()}
    assert counts["tokenized_file_0.npz"] == (100, "ok") and counts["other.npz"] == (1, "ok")
    assert counts["none.npz"][1] == "missing key" and counts["bad.npz"][1].startswith("corrupt")
    windows = spark.createDataFrame([("f", 1, [4]), ("f", 0, [1, 2, 3])], "file string, window int, input_ids array<int>")
    with np.load(io.BytesIO(bytes(writers.token_archives(windows).first()["content"]))) as z:
        assert z["input_ids"].tolist() == [[1, 2, 3], [4, 0, 0]] and z["attention_mask"].tolist() == [[1, 1, 1], [1, 0, 0]] and z["sequence_lengths"].tolist() == [3, 1]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("f", i, f"text {i}") for i in range(10)], "file string, at int, text string")
    writers.chunked_lines(df, str(tmp_path / "c"), "file", ["at"], limit=60)
    back = spark.read.text(str(tmp_path / "c")).groupBy("chunk").agg(F.sum(F.octet_length("value") + 1).alias("b"), F.count(F.lit(1)).alias("n")).collect()
    assert sum(r["n"] for r in back) == 10 and all(r["b"] <= 60 for r in back)
    writers.splits(cleaning.split(df, "at", None), str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).count() == 10


def test_stream_equals_batch(spark, tmp_path):
    src, seen = tmp_path / "in", []
    src.mkdir()
    (src / "1.json").write_text('{"id": 1, "text": "a"}\n{"id": 2, "text": "A"}\n')
    stream = streams.deduplicated(streams.landing(spark, str(src), "id long, text string"), T.key_training(F.col("text")))
    keep = lambda df, n: seen.extend(r["text"].lower() for r in df.collect())
    streams.run_once(stream, str(tmp_path / "cp"), keep)
    (src / "2.json").write_text('{"id": 3, "text": "a"}\n{"id": 4, "text": "b"}\n')
    streams.run_once(stream, str(tmp_path / "cp"), keep)
    assert sorted(seen) == ["a", "b"]
    counts: dict = {}
    stream = streams.counters(streams.landing(spark, str(src), "id long, text string"), "text", F.octet_length("text"))
    streams.run_once(stream, str(tmp_path / "cp2"), lambda df, n: counts.update({r["text"]: r["items"] for r in df.collect()}), "complete")
    assert counts == {"a": 2, "A": 1, "b": 1}
    assert one(spark, streams.rates(F.lit(10), F.lit(2e9), F.lit(3600))[0]) == 10


# Hand-computed rows ------------------------------------------------------------------------------------


def test_tape_windows_follow_the_length(spark):
    """Tapes of a full length give floor((n - L) / S) + 1 windows; only a shorter one is padded."""
    sizes = {5: 1, 1024: 1, 1500: 1, 2048: 2, 2500: 2}
    frame = spark.createDataFrame([(n, list(range(1, n + 1))) for n in sizes], "n int, ids array<int>")
    got = sequences.pack(frame, "ids", 1024, "pad").groupBy("n").count().collect()
    assert {r["n"]: r["count"] for r in got} == sizes
    half = sequences.pack(frame, "ids", 1024, "pad", 512).groupBy("n").count().collect()
    assert {r["n"]: r["count"] for r in half} == {5: 1, 1024: 1, 1500: 1, 2048: 3, 2500: 3}
    kept = sequences.pack(frame, "ids", 1024, "keep").groupBy("n").count().collect()
    assert {r["n"]: r["count"] for r in kept} == {5: 1, 1024: 1, 1500: 2, 2048: 2, 2500: 3}


def test_json_numbers_and_strings(spark, tmp_path):
    from textmill.sources import readers

    lines = ['{"id": "a", "score": "12.5"}', '{"id": "b", "score": null}', '{"id": "c", "score": " 12 "}', '{"id": "d", "score": 3.7}', '{"id": "e"}', '{"id": "f", "score": -3.7, "upvote_ratio": 0.25}', '{"id": "g", "score": 41, "created_utc": 1.5e9}']
    (tmp_path / "x.jsonl").write_text("\n".join(lines))
    got = {r["id"]: r for r in records.posts(readers.json_lines(spark, str(tmp_path), readers.POST)).collect()}
    assert {k: (r["score"] if r["normalizable"] else None) for k, r in got.items()} == {"a": None, "b": None, "c": 12, "d": 3, "e": 0, "f": -3, "g": 41}
    assert got["f"]["upvote_ratio"] == 0.25 and got["g"]["created_utc"] == 1_500_000_000


def test_what_to_load_and_to_evaluate_on():
    from textmill.operators import intake

    there = {"d/processed/train.jsonl", "d/cleaned/cleaned_reddit_data.jsonl"}
    assert intake.data_file(there.__contains__, "d") == ("d/processed/train.jsonl", "multi-source processed")
    assert intake.data_file({"d/cleaned/cleaned_reddit_data.jsonl"}.__contains__, "d")[1] == "cleaned reddit"
    assert intake.data_file(set().__contains__, "d") is None
    assert [intake.evaluation_split(x) for x in (["train", "test", "validation"], ["train", "test"], ["train"])] == ["validation", "test", None]


def test_encoding_equals_the_public_library(spark, tmp_path):
    from tokenizers import Tokenizer

    odd = ["  two  spaces\n\nand lines\t", "Café ñandú 東京 🙂 x²", "it's I'LL 1234 ---", "\u00a0\u2003wide"]
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").union(spark.createDataFrame([(x,) for x in odd], "text string"))
    merges = bpe.train(df, "text", 3_000)
    assert len(merges) == 3_000 - 256 - len(bpe.SPECIAL)
    artifacts.write_tokenizer(spark, merges, str(tmp_path / "tokenizer"))
    theirs = Tokenizer.from_file(str(tmp_path / "tokenizer/tokenizer.json"))
    rows = bpe.encode(df, "text", merges, ["text"]).where("text IS NOT NULL").collect()
    assert len(rows) > 100
    for r in rows:
        assert r["input_ids"] == theirs.encode(r["text"]).ids
    assert len((tmp_path / "tokenizer/merges.txt").read_text().splitlines()) == len(merges) + 1
    vocab = json.loads((tmp_path / "tokenizer/vocab.json").read_text())
    assert vocab == theirs.get_vocab()


def test_encoded_windows(spark):
    texts = [("a", "word " * 40), ("short", "  tiny   "), ("null", None), ("b", "exactly ten")]
    df = spark.createDataFrame(texts, "id string, text string")
    rows = artifacts.encoded_windows(df, "text", [], ["id"], 64, 32).orderBy("id", "window").collect()
    assert [(r["id"], r["window"], r["start"]) for r in rows if r["id"] == "a"] == [("a", i, 32 * i) for i in range(6)]  # 200 bytes
    assert {r["id"] for r in rows} == {"a", "b"}
    assert b"".join(bytes(i - len(bpe.SPECIAL) for i in r["input_ids"][: 32 if r["window"] < 5 else 64]) for r in rows if r["id"] == "a").decode() == "word " * 40


def test_repaired_ids_and_variety(spark):
    df = spark.createDataFrame([([0, 5, -1, 9, 10],), ([],), (None,)], "ids array<int>")
    assert [r[0] for r in df.select(artifacts.repaired(F.col("ids"), 10, 3)).collect()] == [[0, 5, 3, 9, 3], [], None]
    assert artifacts.token_variety(df, "ids").first()[:] == (5, 5, 1.0)
    assert artifacts.token_variety(df.where("ids IS NULL"), "ids").first()[:] == (0, 0, 0.0)


def test_names_and_checkpoint_state(spark, tmp_path):
    artifacts.write_names(spark.createDataFrame([("b.npz",), ("a.npz",)], "name string"), "name", str(tmp_path / "names"))
    assert sorted(r["name"] for r in artifacts.read_names(spark, str(tmp_path / "names")).collect()) == ["a.npz", "b.npz"]
    (tmp_path / "metadata.json").write_text('{\n "step": 7\n}')
    state = artifacts.checkpoint_state(spark, str(tmp_path))
    assert state["metadata"].first()["step"] == 7 and state["config"] is None and state["metrics"] is None


def test_prepared_code_skips_what_has_no_code(spark):
    df = spark.createDataFrame([("p", "c", None, None, None), (None, None, "q", "s", "x"), ("p", None, None, None, "x"), (None, None, None, None, None)], "a string, b string, c string, d string, e string")
    got = [r[0] for r in df.select(tuning.code_prepared(*[F.col(x) for x in "abcde"])).collect()]
    assert got == ["# Task: p\n\nc", "# Problem:\nq\n\n# Solution:\ns", "x", None]


def test_cleaning_skips_only_what_cannot_match(spark):
    """Cleaned texts, spam and repetition are those of all patterns on all texts, and patterns are tried behind a search for what they need."""
    rng = random.Random(11)
    marks = ["[deleted]", "[removed]", "&gt;!", "!&lt;", "&gt;", "http://a.b/c", "/u/ann", "/r/x-1", "u/b", "r/c", "**", "*", "~~", "^up", "EDIT:", "eDıt", "edİt:", "Update", "UPDATE:", "\n", "\n\n", "\t", " ", " ", "\x1c"]
    words = ["like", "to", "share", "check", "this", "link", "click", "here", "buy", "now", "limited", "time", "offer", "make", "money", "fast", "é", "word", " ", "  "]
    rows = [(i, "".join(rng.choice(marks + words) + rng.choice(["", " "]) for _ in range(rng.randrange(25)))) for i in range(600)] + [(600, None), (601, ""), (602, " \n ")]
    df = spark.createDataFrame(rows, "i int, t string")
    plain = F.coalesce("t", F.lit(""))
    for rule in T.POST_RULES:
        plain = F.regexp_replace(plain, *rule)
    key = F.md5(T.collapse(T.strip(F.lower(F.concat_ws(" ", F.lit(""), F.coalesce("t", F.lit("")))))).cast("binary"))
    pairs = [(T.clean_post(F.col("t")), T.strip(plain)), (T.is_spam(F.lower("t")), F.lower("t").rlike("(?d)" + "|".join(T.SPAM))), (T.key_post(F.lit(""), F.col("t")), key)]
    for got, want in pairs:
        assert df.where(~got.eqNullSafe(want)).collect() == []
    assert 50 < df.where(T.is_spam(F.lower("t"))).count() < 600
    assert "contains" in T.clean_post(F.col("t"))._jc.toString().lower()
    lists = [[rng.choice("abc" if i % 2 else "abcdef") for _ in range(i % 40)] + ["x"] * (i % 13) for i in range(400)]
    got = spark.createDataFrame(list(enumerate(lists)), "i int, w array<string>").select("i", T.bind(F.col("w"), T.repetitive).alias("r")).collect()
    want = {i: len(w) > 10 and 10 * max(map(w.count, w)) > 3 * len(w) for i, w in enumerate(lists)}
    assert {r["i"]: r["r"] for r in got} == want and len(set(want.values())) == 2
