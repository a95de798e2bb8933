"""Sequential rules in parallel, against the rule row by row; line numbers of files of several splits; what the mended readings give."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmill.operators import chunking, intake, reports, series, tuning
from textmill.plans import pipelines
from textmill.sources import readers


def plain_chunks(sizes, limit, close_before):
    out, total, chunk = [], 0, 1
    for n in sizes:
        if close_before and total and total + n > limit or not close_before and total >= limit:
            total, chunk = 0, chunk + 1
        total += n
        out.append(chunk)
    return out


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("close_before", [True, False])
def test_summaries_of_blocks(seed, close_before):
    import numpy as np

    rnd = random.Random(seed)
    sizes = [rnd.choice([0, 0, 1, 5, 9, 30, rnd.randint(0, 40)]) for _ in range(rnd.randint(1, 60))]
    found = chunking.Summary(np.array(sizes), 20, close_before)
    for came in range(45):
        _, out, chunk = chunking.number(sizes, 20, close_before, came, 1)
        assert found(came) == (chunk - 1, out), (sizes, came)


@pytest.fixture
def spread(spark):
    """Small tables stay in as many partitions as large ones would have."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("close_before", [True, False])
@pytest.mark.parametrize("groups", [1, 4, 300])
def test_chunks_equal_the_rule_row_by_row(spark, spread, close_before, groups):
    rnd = random.Random(groups)
    rows = [(i, None if (g := rnd.randint(0, groups) if groups > 1 else 1) == 2 else f"g{g}", rnd.choice([0, 3, 10, 50, 120])) for i in range(3000)]
    df = spark.createDataFrame(rows, "at long, file string, bytes long").repartition(5)
    out = chunking.greedy_chunks(df, "file", ["at"], "bytes", 100, close_before)
    got = {r["at"]: r["chunk"] for r in out.collect()}
    for file in {f for _, f, _ in rows}:
        own = [(i, n) for i, f, n in rows if f == file]
        assert [got[i] for i, _ in own] == plain_chunks([n for _, n in own], 100, close_before)
    tasks = out.select(F.spark_partition_id().alias("p")).distinct().count()
    assert len(got) == 3000 and tasks > 1  # also one group of all rows


def test_chunks_of_nothing_and_of_null_sizes(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 60), ("a", 3, 60)], "file string, at long, bytes long")
    assert [r["chunk"] for r in chunking.greedy_chunks(df, "file", ["at"], "bytes", 100).orderBy("at").collect()] == [1, 1, 2]
    assert chunking.greedy_chunks(df.where("false"), "file", ["at"], "bytes", 100).count() == 0


@pytest.fixture(scope="module")
def steps(spark):
    rnd = random.Random(1)
    rows = [("one" if i % 10 else None, i, None if i % 97 == 5 else float(rnd.randint(0, 50))) for i in range(2000)]
    return spark.createDataFrame(rows, "kind string, step long, loss double").repartition(6)


def both(steps, found, name, column):
    want = {r["step"]: r["x"] for r in steps.select("step", column.alias("x")).collect()}
    got = {r["step"]: r[name] for r in found.collect()}
    assert set(got) == set(want)
    assert all((got[k] is None) == (want[k] is None) and (want[k] is None or got[k] == want[k] or abs(got[k] - want[k]) < 1e-9) for k in want)


@pytest.mark.parametrize("block", [3, 64, 100_000])
def test_series_equal_whole_windows(spark, spread, steps, block):
    w = Window.partitionBy("kind").orderBy("step")
    args = (steps, ["kind"], ["step"])
    both(steps, series.positions(*args), "position", F.row_number().over(w))
    both(steps, series.running_best(*args, "loss", block=block), "best", F.min("loss").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    both(steps, series.rolling(*args, 20, lambda v: {"m": F.avg("loss").over(v)}, block), "m", F.avg("loss").over(w.rowsBetween(-19, 0)))
    before = F.lag("loss").over(w)
    want = F.when(before.isNull(), "start").when(F.col("loss") < before, "improving").otherwise("stable")
    both(steps.where("loss IS NOT NULL"), series.trend(steps.where("loss IS NOT NULL"), ["kind"], ["step"], "loss", block), "trend", want)


def test_steps_since_the_best(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5.0, 3.0, 4.0, 3.0, None, 9.0])], "step long, loss double")
    rows = series.since_best(df.withColumn("g", F.lit(1)), ["g"], ["step"], "loss", "step", 2).orderBy("step").collect()
    assert [r["since_best"] for r in rows] == [0, 0, 1, 0, 1, 2]


def test_line_numbers_of_splits(spark, tmp_path):
    lines = {f"f{k}.jsonl": [f'{{"id": "{k}-{i}"}}' if i % 7 else "" for i in range(900)] for k in range(3)}
    for name, own in lines.items():
        (tmp_path / name).write_text("\n".join(own) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = readers.numbered_lines(spark, str(tmp_path), "id string")
        got = {(r["source_file"], r["source_line"], r["id"]) for r in rows.collect()}
        splits = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
        tail = [r["value"] for r in readers.log_tail(spark, str(tmp_path / "f1.jsonl"), 5).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert splits > 10 and tail == lines["f1.jsonl"][-5:]
    assert got == {(name, i + 1, f"{name[1]}-{i}") for name, own in lines.items() for i in range(len(own)) if own[i]}


def test_resume_after_a_file_that_is_there(spark):
    files = spark.createDataFrame([(x,) for x in "abcde"], "name string")
    failed = spark.createDataFrame([("d",)], "name string")
    assert sorted(r["name"] for r in intake.resume_after(files, "b", failed).collect()) == ["c", "e"]
    assert intake.resume_after(files, "bb", failed).count() == 0


def test_web_files_by_their_spelling(spark):
    df = spark.createDataFrame([("p1", "text", "r")], "id string, text string, subreddit string")
    kind = lambda name: intake.chunk_records(df, F.lit(name), "id").first()["type"]
    assert kind("huggingface_1.jsonl") == "article" and kind("HuggingFace_1.jsonl") == "unknown"


def test_collection_info(spark):
    names = ["tokenized_cleaned_news_comments.npz", "tokenized_cleaned_news_submissions.npz", "commentsonly.npz", "a_b.npz", "tokenized_cleaned_comments_comments.npz"]
    row = reports.collection_info(spark.createDataFrame([(n,) for n in names], "name string")).first()
    assert (row["files"], row["comment_files"], row["submission_files"], row["subreddits"]) == (5, 3, 1, 2)


@pytest.mark.parametrize("task", ["general", "chat", "code", "instruct"])
def test_task_metrics(spark, task):
    pairs = spark.createDataFrame([(0, 1, 1), (1, 2, 1), (2, 1, 1), (3, 1, 4)], "place long, p int, l int")
    row = tuning.task_metrics(pairs, task).first()
    assert (row["accuracy"], row["vocab_usage"], row["unique_tokens"], row["total_tokens"], row["perplexity"]) == (0.5, 0.5, 2, 4, None)
    none = tuning.task_metrics(pairs.where("false"), task).first()
    assert none["accuracy"] == 0 and none["perplexity"] == float("inf") and none["vocab_usage"] is None


def test_file_statistics(spark):
    good = "a text that is long enough to stay"
    rows = [(1, "f1", good, 5), (2, "f1", good, 5), (3, "huggingface_2", good + " here", 0), (4, "f3", good + "!", 5), (5, "f3", "short", 5), (6, "f3", good + " too", 0), (7, "f3", None, 1)]
    df = spark.createDataFrame(rows, "at long, file string, body string, score int")
    out = pipelines.file_stats(df, "file", "body", "score", "at", F.col("file").contains("huggingface")).collect()
    got = {r["file"]: (r["files_processed"], r["posts_read"], r["posts_cleaned"], r["duplicates"]) for r in out}
    assert got == {"f1": (1, 2, 1, 1), "huggingface_2": (1, 1, 1, 0), "f3": (1, 4, 0, 1), None: (3, 7, 2, 2)}
    kept = pipelines.clean_dumps(df, "body", "score", "at", F.col("file").contains("huggingface"))
    assert sorted(r["at"] for r in kept.collect()) == [1, 3]
