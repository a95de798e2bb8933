"""What comes before cleaning: raw records of collectors to unified ones, dispatch by source, length rules, and file names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.operators import records

#: Least lengths (fixed values): articles, posts, comments, texts to tokenize (usual and strict), short-form texts and their ids.
ARTICLE, POST, COMMENT = 1000, 50, 20
TOKENIZED, STRICT, SHORT_TEXT, SHORT_IDS = 10, 20, 10, 5
COMMENTS, SHORT_FORM = 10, 512


def _or(df: DataFrame, name: str, default: Column) -> Column:
    return F.coalesce(F.col(name), default) if name in df.columns else default


def post_records(raw: DataFrame, line: str) -> DataFrame:
    """Posts as unified records: title and body joined and stripped; empty ones go, and a missing id is made of the line's number."""
    text = T.strip(F.concat(_or(raw, "title", F.lit("")), F.lit(" "), _or(raw, "selftext", F.lit(""))))
    out = raw.select(
        _or(raw, "id", F.concat(F.lit("reddit_"), F.col(line))).alias("id"), text.alias("text"), F.lit("reddit").alias("source"),
        _or(raw, "subreddit", F.lit("")).alias("subreddit"), _or(raw, "score", F.lit(0)).alias("score"), _or(raw, "created_utc", F.lit(0)).alias("created_utc"),
    )
    return out.where(F.col("text") != "")


def web_records(raw: DataFrame, index: str, dataset: str) -> DataFrame:
    """Rows of a web corpus as unified records, named by their index in the corpus; blank ones go."""
    rows = raw.where(T.strip(F.coalesce("text", F.lit(""))) != "")
    return rows.select(F.concat(F.lit("hf_"), F.col(index)).alias("id"), "text", F.lit("huggingface_openwebtext").alias("source"), F.lit(dataset).alias("source_dataset"))


def chunk_records(raw: DataFrame, file_name: Column, line: str) -> DataFrame:
    """Records of unified chunks with the defaults of their kind; ``huggingface`` in the file's name, spelt so, marks web texts."""
    web = file_name.contains("huggingface")
    pick = lambda own, name, default: F.when(web, F.lit(own)).otherwise(_or(raw, name, F.lit(default)))
    return raw.select(
        pick("openwebtext", "subreddit", "").alias("subreddit"), F.when(web, _or(raw, "id", F.concat(F.lit("hf_"), F.col(line)))).otherwise(_or(raw, "id", F.lit(""))).alias("id"),
        pick("", "title", "").alias("title"), _or(raw, "text", F.lit("")).alias("text"), pick(0, "created_utc", 0).alias("created_utc"), pick(1, "score", 0).alias("score"),
        pick("openwebtext", "author", "[deleted]").alias("author"), pick("article", "type", "unknown").alias("type"),
    )


def normalized(raw: DataFrame) -> DataFrame:
    """Items of the three kinds in one schema; ``legacy`` ones with a subreddit or body are posts, others are general; unknown kinds go."""
    is_post = F.col("subreddit").isNotNull() | F.col("selftext").isNotNull()
    kind = F.when((F.col("source_type") == "legacy") & is_post, "reddit").otherwise(F.col("source_type"))
    rows = raw.withColumn("source_type", kind)
    general = rows.withColumn("content", F.coalesce(F.nullif(F.col("content"), F.lit("")), F.col("text")))
    made = ((records.articles, rows, "wikipedia"), (records.discussions, rows, "reddit"), (records.general, general, "legacy"))
    out = [make(frame.where(F.col("source_type") == name)) for make, frame, name in made]
    return out[0].unionByName(out[1]).unionByName(out[2])


def tokenizable(text: Column, least: int = TOKENIZED) -> Column:
    return F.length(T.strip(F.coalesce(text, F.lit("")))) >= least


def has_content(text: Column, title: Column) -> Column:
    return (F.coalesce(text, F.lit("")) != "") | (F.coalesce(title, F.lit("")) != "")


def short_form(text: Column, ids: Column, longest: int = SHORT_FORM) -> Column:
    """At most ``longest`` ids of a text that is long enough, without windows; null for others."""
    cut = F.slice(ids, 1, longest)
    return F.when((F.length(T.strip(text)) > SHORT_TEXT) & (F.size(cut) > SHORT_IDS), cut)


def long_articles(raw: DataFrame, text: str) -> DataFrame:
    return raw.where(F.length(text) >= ARTICLE)


def long_posts(raw: DataFrame, title: str, body: str) -> DataFrame:
    """Posts whose body, or title where there is none, is long enough."""
    content = F.coalesce(F.nullif(F.col(body), F.lit("")), F.col(title), F.lit(""))
    return raw.where(F.length(content) >= POST)


def kept_comments(comments: Column) -> Column:
    """Of the first ten comments (structs with body) those of more than 20 characters."""
    return F.filter(F.slice(comments, 1, COMMENTS), lambda c: F.length(c["body"]) > COMMENT)


def file_flags(name: Column, megabytes: Column) -> dict[str, Column]:
    """What a file's name and size tell: tokenized, cleaned, processed, and failed (next to empty)."""
    return {**{k: F.lower(name).contains(k) for k in ("tokenized", "cleaned", "processed")}, "failed": megabytes < 0.001}


def cache_key(path: Column) -> Column:
    return F.substring(F.md5(path.cast("binary")), 1, 12)


def load_order(rows: DataFrame, files: DataFrame) -> DataFrame:
    """``rows`` (file, line) with file_rank: files (file, size: one row each) are taken by size, largest first, then by name."""
    from pyspark.sql.window import Window

    ranked = files.select("file", F.row_number().over(Window.orderBy(F.desc("size"), "file")).alias("file_rank"))  # a row for each file
    return rows.join(ranked, "file")


def sample_of_files(rows: DataFrame, files: int, texts: int) -> DataFrame:
    """The first non-blank stripped texts of the first files by name, from rows (file, line, text); the limits are the feature."""
    from pyspark.sql.window import Window

    some = rows.select("file").distinct().orderBy("file").limit(files)
    rows = rows.withColumn("text", T.strip(F.col("text"))).where("text <> ''").join(F.broadcast(some), "file")  # ``files`` names
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("file").orderBy("line"))).where(F.col("place") <= texts)


def resume_after(inputs: DataFrame, sentinel: str, failed: DataFrame) -> DataFrame:
    """Files (name) after ``sentinel``, the last one that was done, without those that failed; none if ``sentinel`` is not among the inputs."""
    there = inputs.where(F.col("name") == sentinel).select(F.lit(1)).limit(1)
    return inputs.where((F.col("name") > sentinel) & there.exists()).join(failed.select("name"), "name", "left_anti")


def data_file(exists, folder: str) -> tuple[str, str] | None:
    """Path and kind of what there is to load: processed items before cleaned posts; ``exists`` tells whether a path does."""
    for path, kind in ((f"{folder}/processed/train.jsonl", "multi-source processed"), (f"{folder}/cleaned/cleaned_reddit_data.jsonl", "cleaned reddit")):
        if exists(path):
            return path, kind
    return None


def evaluation_split(available: Iterable[str]) -> str | None:
    """The split to evaluate on: validation, else test; None: a share of the training rows (``cleaning.holdout``)."""
    there = set(available)
    return next((s for s in ("validation", "test") if s in there), None)
