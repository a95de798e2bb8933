"""Folders that may be missing, fine-tuning folders, first samples, and training sets in all forms."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from textmill.functions import bpe
from textmill.operators import cleaning
from textmill.sources import readers, writers
from textmill.training import compare, unigram, wordpiece


def lines(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r) if r is not None else "" for r in rows) + "\n")


def test_missing_folders_are_skipped(spark, tmp_path):
    lines(tmp_path / "b/x.jsonl", [{"id": "1"}, {"id": "2"}])
    lines(tmp_path / "a/sub/y.jsonl", [{"id": "3"}])
    rows = readers.known_folders(spark, [f"{tmp_path}/{f}" for f in ("none", "b", "a")], "id string", "*.jsonl").collect()
    assert sorted((r["id"], r["source_file"], r["source_rank"]) for r in rows) == [("1", "x.jsonl", 0), ("2", "x.jsonl", 0), ("3", "y.jsonl", 1)]
    assert readers.known_folders(spark, [f"{tmp_path}/none"], "id string").count() == 0


def test_tuning_folders(spark, tmp_path):
    lines(tmp_path / "one/train.jsonl", [{"text": "a"}, {"text": "b"}])
    train, evaluation = readers.tuning_folder(spark, str(tmp_path / "one"))
    assert train.count() == 2 and evaluation is None
    (tmp_path / "two").mkdir()
    (tmp_path / "two/train.json").write_text(json.dumps([{"text": "a"}]))
    (tmp_path / "two/eval.json").write_text(json.dumps([{"text": "b"}, {"text": "c"}]))
    train, evaluation = readers.tuning_folder(spark, str(tmp_path / "two"))
    assert [r["text"] for r in train.collect()] == ["a"] and sorted(r["text"] for r in evaluation.collect()) == ["b", "c"]


def test_first_samples(spark, tmp_path):
    for k in range(2):
        lines(tmp_path / f"{k}.jsonl", [{"text": f"{k}-{i}"} if i != 1 else None for i in range(5)])
    rows = readers.web_corpus(spark, str(tmp_path), "text string", 5).collect()
    assert sorted(r["text"] for r in rows) == ["0-0", "0-2", "0-3", "0-4", "1-0"]
    assert readers.web_corpus(spark, str(tmp_path), "text string").count() == 8


def test_training_set(spark, tmp_path):
    rows = [(str(i), f'text "{i}",\nmore', "sub", i, 2) for i in range(40)]
    df = cleaning.split(spark.createDataFrame(rows, "id string, training_text string, subreddit string, score int, training_word_count int"), "id")
    writers.training_set(df, str(tmp_path / "out"), df.agg(F.count(F.lit(1)).alias("total")))
    items = spark.read.json(str(tmp_path / "out/jsonl"))
    assert sorted(items.columns) == ["id", "score", "source", "split", "subreddit", "text", "word_count"]
    assert {r["split"]: r["count"] for r in items.groupBy("split").count().collect()} == {"train": 28, "validation": 6, "test": 6}
    table = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(str(tmp_path / "out/csv"))
    assert sorted((r["id"], r["training_text"]) for r in table.collect()) == sorted((r[0], r[1]) for r in rows)
    assert spark.read.json(str(tmp_path / "out/training_metadata")).first()["total"] == 40


def test_comparison_and_diagnosis(spark):
    df = spark.createDataFrame([("the cat and the hat",), ("the dog ☃",), (None,)], "text string")
    scores = {p: -1.0 for p in ["▁the", "▁and", *"▁thecandogh"]}
    models = {"bpe": bpe.Bpe([]), "unigram": unigram.Unigram(scores), "wordpiece": wordpiece.WordPiece([*wordpiece.SPECIAL, "the", "cat", "and", "hat"])}
    got = {r["tokenizer"]: r.asDict() for r in compare.compared(df, "text", models).collect()}
    assert all(r["texts"] == 3 for r in got.values())
    assert (got["bpe"]["tokens"], got["bpe"]["unknown_rate"]) == (19 + 11, 0.0) and got["bpe"]["chars_per_token"] == round(28 / 30, 6)
    assert (got["wordpiece"]["tokens"], got["wordpiece"]["unknown_rate"], got["wordpiece"]["coverage"]) == (8, 0.25, round(5 / 9, 6))
    own = [models["unigram"].encode(r["text"]) for r in df.collect()]
    assert got["unigram"]["tokens"] == sum(map(len, own)) and got["unigram"]["coverage"] == round(len({i for x in own for i in x}) / len(models["unigram"].ids), 6)
    words = spark.createDataFrame([("the",), ("dog",), ("the",)], "w string")
    for name, want in (("unigram", {"the": 1, "dog": 4}), ("wordpiece", {"the": 1, "dog": 1}), ("bpe", {"the": 3, "dog": 3})):
        rows = compare.preserved_words(words, "w", models[name]).collect()
        assert {r["word"]: r["tokens"] for r in rows} == want and all(r["preserved"] == (r["tokens"] == 1) for r in rows)
    common = spark.createDataFrame([("bpe", "the", 3), ("bpe", "and", 3), ("unigram", "the", 1)], "tokenizer string, word string, tokens int")
    found = {r["tokenizer"]: r["issues"] for r in compare.diagnosed(compare.compared(df, "text", models), common).collect()}
    assert found["bpe"] == ["low compression", "fragmented words"] and "unknown tokens" in found["wordpiece"]


def test_compressed_dumps_become_lines(spark, tmp_path):
    import zstandard

    from textmill.plans import pipelines

    (tmp_path / "in").mkdir()
    files = {
        "news_comments.zst": [{"id": "c1", "body": "a comment of some length", "score": 3}, {"id": "c2", "body": "[deleted]"}, {"id": "c3", "body": "short"}],
        "news_submissions.zst": [{"id": "s1", "selftext": "a post of some length", "title": "T", "created_utc": 1700000000}, {"id": "s2", "selftext": ""}],
        "empty_comments.zst": [{"id": "e1", "body": ""}],
    }
    for name, rows in files.items():
        data = "\n".join([json.dumps(r) for r in rows] + ["", "{not json"]) + "\n"
        (tmp_path / "in" / name).write_bytes(zstandard.ZstdCompressor().compress(data.encode()))
    found = pipelines.extract_dumps(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert {r["dump"]: r["rows"] for r in found.collect()} == {"news_comments": 1, "news_submissions": 1}
    rows = {r["id"]: r.asDict() for r in spark.read.json(str(tmp_path / "out")).collect()}
    assert rows["c1"]["text"] == "a comment of some length" and rows["c1"]["type"] == "comment" and rows["c1"]["subreddit"] == "news" and rows["c1"]["score"] == 3
    assert rows["s1"]["title"] == "T" and rows["s1"]["created_utc"] == 1700000000 and rows["s1"]["author"] == "[deleted]"
