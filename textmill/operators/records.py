"""Normalizers: raw records of each source to the engine's schemas, as projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import text as T


def _get(df: DataFrame, name: str, default=None) -> Column:
    """Column of that name, or the default if the table has none or the value is null."""
    col = F.col(name) if name in df.columns else F.lit(None)
    return col if default is None else F.coalesce(col, F.lit(default))


def unwrap(df: DataFrame) -> DataFrame:
    """Fields of a nested ``data`` struct come before top-level ones of the same name."""
    if "data" not in df.columns:
        return df
    fields = df.schema["data"].dataType.fieldNames()
    merged = [F.coalesce(F.col(f"data.{f}"), F.col(f)).alias(f) if f in df.columns else F.col(f"data.{f}").alias(f) for f in fields]
    return df.select(*merged, *[c for c in df.columns if c != "data" and c not in fields])


def posts(raw: DataFrame) -> DataFrame:
    """Raw posts to the cleaner's schema; rows whose numbers cannot be read are marked by ``normalizable``."""
    df = unwrap(raw)
    body = F.coalesce(F.nullif(_get(df, "selftext").cast("string"), F.lit("")), _get(df, "content").cast("string"), F.lit(""))
    title = _get(df, "title", "").cast("string")
    out = df.select(
        _get(df, "id", "").cast("string").alias("id"), title.alias("title"), body.alias("selftext"), _number(df, "score", 0, "long").alias("score"),
        _number(df, "upvote_ratio", 0.5, "double").alias("upvote_ratio"), _number(df, "num_comments", 0, "long").alias("num_comments"), _number(df, "created_utc", 0, "long").alias("created_utc"),
        F.lower(_get(df, "subreddit", "").cast("string")).alias("subreddit"), _get(df, "author", "").cast("string").alias("author"), _get(df, "url", "").cast("string").alias("url"),
        *[_get(df, n, d).cast("boolean").alias(n) for n, d in (("is_self", True), ("over_18", False), ("spoiler", False), ("locked", False), ("archived", False))],
        _get(df, "removed_by_category").cast("string").alias("removed_by_category"),
    )
    out = out.withColumns({"word_count": T.word_count(F.col("selftext")), "title_word_count": T.word_count(F.col("title"))})
    ok = F.col("score").isNotNull() & F.col("upvote_ratio").isNotNull() & F.col("num_comments").isNotNull() & F.col("created_utc").isNotNull()
    return out.withColumn("total_word_count", F.col("word_count") + F.col("title_word_count")).withColumn("normalizable", ok)


def _number(df: DataFrame, name: str, default, kind: str) -> Column:
    if name not in df.columns:
        return F.lit(default).cast(kind)
    if dict(df.dtypes)[name] != "variant":
        return F.col(name).try_cast(kind)
    # A missing key has the default, a JSON null cannot be read; a JSON number is cut to whole, a JSON string must be a number of the kind as it stands.
    said = F.try_variant_get(name, "$", "string")
    value = F.when(F.schema_of_variant(name) == "STRING", said.try_cast(kind)).otherwise(said.try_cast("double").cast(kind))
    return F.when(F.col(name).isNull(), F.lit(default).cast(kind)).otherwise(value)


def unified(raw: DataFrame, unknown: bool = False) -> DataFrame:
    """Unified records (text, source) to posts; sources other than the two known ones are dropped unless ``unknown``."""
    web = F.col("source") == "huggingface_openwebtext"
    rows = raw if unknown else raw.where(F.col("source").isin("reddit", "huggingface_openwebtext"))
    return rows.select(
        F.col("id").cast("string").alias("id"), F.lit("").alias("title"), F.coalesce("text", F.lit("")).alias("selftext"),
        F.when(web, F.lit(1)).otherwise(_get(raw, "score", 0).try_cast("long")).cast("long").alias("score"), F.when(web, 1.0).otherwise(0.5).alias("upvote_ratio"),
        F.when(web, "openwebtext").otherwise(F.lower(_get(raw, "subreddit", ""))).alias("subreddit"),
        F.when(web, "huggingface_openwebtext").when(F.col("source") == "reddit", "reddit_unified").otherwise(F.col("source")).alias("data_source"),
    )


def dump_rows(raw: DataFrame, name: Column) -> DataFrame:
    """Dump rows to unified ones; subreddit and kind come from the file name; gone and short rows are dropped."""
    base = F.regexp_replace(name, r"\.(zst|jsonl|json|txt|gz)$", "")
    kind = F.when(base.endswith("_comments"), "comment").when(base.endswith("_submissions"), "submission").otherwise("unknown")
    self_ = _get(raw, "selftext", "")
    text = F.when(kind == "comment", F.coalesce(F.nullif(_get(raw, "body", ""), F.lit("")), self_)).otherwise(self_)
    out = raw.select(
        _get(raw, "id", "").alias("id"), F.regexp_replace(base, "_(comments|submissions)$", "").alias("subreddit"), kind.alias("type"), _get(raw, "author", "[deleted]").alias("author"),
        _get(raw, "created_utc").try_cast("long").alias("created_utc"), _get(raw, "score", 0).try_cast("long").alias("score"), text.alias("text"), _get(raw, "title", "").alias("title"),
    )
    return out.where(~F.col("text").isin("", *T.GONE) & (F.length(T.strip(F.col("text"))) >= 10))


def articles(raw: DataFrame) -> DataFrame:
    title, content, summary = (F.coalesce(F.col(c), F.lit("")) for c in ("title", "content", "summary"))
    return raw.select(
        F.concat(F.lit("wiki_"), F.substring(F.md5(title.cast("binary")), 1, 11)).alias("id"), title.alias("title"), content.alias("content"),
        T.article_text(title, content, summary).alias("training_text"), T.word_count(content).alias("word_count"), F.length(content).alias("content_length"),
        F.lit("wikipedia").alias("source_type"), T.score_article(content, summary, F.coalesce("category", F.lit(""))).alias("quality_score"),
    )


def discussions(raw: DataFrame) -> DataFrame:
    title, body = F.coalesce("title", F.lit("")), F.coalesce(F.nullif(F.col("selftext"), F.lit("")), F.lit(""))
    score, comments = F.col("score").try_cast("long"), F.col("num_comments").try_cast("long")
    return raw.select(
        F.substring(F.col("id").cast("string"), 1, 16).alias("id"), title.alias("title"), body.alias("content"), T.dialogue(title, body).alias("training_text"),
        T.word_count(body).alias("word_count"), F.length(body).alias("content_length"), F.lit("reddit").alias("source_type"), T.score_post(score, comments, body, title).alias("quality_score"),
    )


def general(raw: DataFrame) -> DataFrame:
    title, body = F.coalesce("title", F.lit("")), F.coalesce("content", F.lit(""))
    text = F.when(title != "", F.concat(F.lit("Topic: "), title, F.lit("\n\nContent: "), body)).otherwise(body)
    return raw.select(
        F.substring(F.col("id").cast("string"), 1, 16).alias("id"), title.alias("title"), body.alias("content"), text.alias("training_text"), T.word_count(body).alias("word_count"),
        F.length(body).alias("content_length"), F.lit("legacy").alias("source_type"), T.score_general(body, title).alias("quality_score"),
    )


def tagged(title: Column, text: Column, subreddit: Column) -> Column:
    """Text between start and end marks with a source tag; blank parts are left out."""
    tag = F.when(subreddit == "openwebtext", "<|hf|>").otherwise("<|reddit|>")
    part = lambda c: F.nullif(c, F.lit(""))
    return F.concat_ws("\n", F.lit("<|startoftext|>"), tag, part(title), part(text), F.lit("<|endoftext|>"))


def plain(title: Column, text: Column) -> Column:
    part = lambda c: F.when(~c.isin("", *T.GONE), c)
    return F.concat_ws("\n", part(title), part(text))
