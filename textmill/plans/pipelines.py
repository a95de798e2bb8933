"""The three stage orders. All differ in where duplicates are dropped, which decides what a poor first copy hides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.operators import cleaning, records
from textmill.sources import readers


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as posts: score and over_18 come from ``labels``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    score = F.when(F.col("quality") == 1, 50).when(F.col("quality") == 0, 0).otherwise(1)
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", F.lit("").alias("title"), F.coalesce("text", F.lit("")).alias("selftext"), F.col("source").alias("subreddit"), score.cast("long").alias("score"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("over_18"), F.lit(True).alias("is_self"), F.lit(0).cast("long").alias("num_comments"),
    )


def clean_posts(posts: DataFrame, order: str = "doc_id") -> DataFrame:
    """Duplicates by raw content go first, then texts are cleaned, then a reason is given to each row.

    ``word_count`` is that of the raw body; ``total_word_count`` is counted after cleaning.
    """
    unique = cleaning.first_wins(posts, T.key_post(F.col("title"), F.col("selftext")), order)
    out = T.once(unique, title=T.clean_post(F.col("title")), selftext=T.clean_post(F.col("selftext")), word_count=T.word_count(F.col("selftext")))
    out = T.once(out, total_word_count=T.word_count(F.col("selftext")) + T.word_count(F.col("title")))
    reason = cleaning.quality_reason(*(F.col(c) for c in ("title", "selftext", "total_word_count", "word_count", "score", "over_18", "is_self")))
    return T.once(out, quality_reason=reason)


def clean_dumps(rows: DataFrame, text: str, score: str, order: str, web: bool | Column = False) -> DataFrame:
    """Texts are cleaned, then duplicates of the cleaned text go, then low scores, but those of ``web`` rows (all, none, or by a row's own flag)."""
    out = T.once(rows, text_clean=T.clean_dump(F.col(text))).where(F.col("text_clean").isNotNull())
    out = cleaning.first_wins(out, T.key_dump(F.col("text_clean")), order)
    return out.where(_scored(score, web))


def _scored(score: str, web: bool | Column) -> Column:
    return (F.lit(web) if isinstance(web, bool) else F.coalesce(web, F.lit(False))) | (F.col(score) >= 1)


def file_stats(rows: DataFrame, file: str, text: str, score: str, order: str, web: bool | Column = False) -> DataFrame:
    """Of each file, and of all (file null): files_processed, posts_read, posts_cleaned and duplicates of the run that ``clean_dumps`` does.

    Texts become keys in the pass that reads them. Rows of a key are counted by file first, so a key meets in one task with a row for each file at most.
    """
    kept = _scored(score, web)
    keyed = T.once(rows.select(F.col(file).alias("file"), text, F.col(order).alias("order"), kept.alias("kept")), clean=T.clean_dump(F.col(text)))
    keyed = keyed.select("file", "order", "kept", F.when(F.col("clean").isNotNull(), T.key_dump(F.col("clean"))).alias("key"))
    by_file = keyed.groupBy("key", "file").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("order", "kept")).alias("first"))
    firsts = by_file.where("key IS NOT NULL").groupBy("key").agg(F.min("first").alias("least"))
    found = by_file.join(firsts, "key", "left").withColumn("wins", F.coalesce(F.col("first") == F.col("least"), F.lit(False)))
    duplicates = F.when(F.col("key").isNotNull(), F.col("n") - F.col("wins").cast("long")).otherwise(0)
    cleaned = F.count_if(F.col("wins") & F.col("first")["kept"])
    return found.rollup("file").agg(F.countDistinct("file").alias("files_processed"), F.sum("n").alias("posts_read"), cleaned.alias("posts_cleaned"), F.sum(duplicates).alias("duplicates"))


def multi_source(items: DataFrame, order: str, least: float = 25.0) -> DataFrame:
    """Blank items and low scores go first, then duplicates of the training text."""
    out = items.where((T.strip(F.col("training_text")) != "") & (F.col("quality_score") >= least))
    return cleaning.first_wins(out, T.key_training(F.col("training_text")), order)


def training_rows(posts: DataFrame) -> DataFrame:
    """Posts with training_text, text_length and text_words; shorter texts than 20 characters are dropped."""
    text = T.dialogue(T.strip(F.col("title")), T.strip(F.col("selftext")))
    out = posts.withColumn("training_text", text).where(F.length("training_text") >= 20)
    return out.withColumns({"text_length": F.length("training_text"), "text_words": T.word_count(F.col("training_text"))})


def items_from(posts: DataFrame) -> DataFrame:
    """Posts as discussion items with their order column."""
    rows = posts.withColumn("id", F.col("doc_id").cast("string"))
    made = records.discussions(rows)
    return made.withColumn("doc_id", F.col("id").cast("long"))


#: Fields of dump lines that records are made of.
DUMP = "id string, author string, created_utc string, score string, selftext string, body string, title string"


def extract_dumps(spark: SparkSession, folder: str, out: str, glob: str = "*.zst") -> DataFrame:
    """Compressed dumps as JSON lines of unified records, one folder for each dump; gives the rows that it wrote, by dump.

    Lines that are not JSON, and gone or short texts, are left out. A dump without rows has no folder. A compressed file is one task, so large dumps come in several.
    """
    raw = readers.json_lines(spark, folder, DUMP, glob).where("bad IS NULL")
    rows = records.dump_rows(raw, F.col("source_file"))
    rows = rows.withColumn("dump", F.concat_ws("_", "subreddit", F.when(F.col("type") != "unknown", F.concat("type", F.lit("s")))))
    rows.write.mode("overwrite").partitionBy("dump").json(out)
    return spark.read.schema(f"{DUMP_RECORD}, dump string").json(out).groupBy("dump").agg(F.count(F.lit(1)).alias("rows"))


DUMP_RECORD = "id string, subreddit string, type string, author string, created_utc long, score long, text string, title string"
