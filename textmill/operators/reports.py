"""Reports over file lists, token counts and run logs. A file table has name and size (bytes)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MB = 1048576


def subreddit(name: Column) -> Column:
    """Subreddit of a dump file: the name without folder, extension and kind."""
    last = F.element_at(F.split(name, "/"), -1)
    return F.regexp_replace(F.regexp_replace(last, r"\.(zst|jsonl|json|txt|gz|npz)$", ""), "_(comments|submissions)$", "")


def subreddit_field(name: Column) -> Column:
    """The third ``_`` field of an archive's name, which cuts names that hold ``_`` themselves."""
    return F.try_element_at(F.split(name, "_"), F.lit(3))


def collection_info(files: DataFrame) -> DataFrame:
    """Of files (name): all, those whose names hold ``comments`` and ``submissions`` anywhere, and the different third fields of names that have one."""
    holds = lambda part: F.count_if(F.col("name").contains(part))
    return files.agg(F.count(F.lit(1)).alias("files"), holds("comments").alias("comment_files"), holds("submissions").alias("submission_files"), F.countDistinct(subreddit_field(F.col("name"))).alias("subreddits"))


def dump_inventory(files: DataFrame, record_bytes: int = 500) -> DataFrame:
    """Files, MB, estimated records and kinds of each subreddit."""
    return files.groupBy(subreddit(F.col("name")).alias("subreddit")).agg(
        F.count(F.lit(1)).alias("files"), F.round(F.sum("size") / MB, 6).alias("mb"), F.floor(F.sum("size") / record_bytes).alias("estimated_records"),
        F.max(F.col("name").contains("_comments")).alias("has_comments"), F.max(F.col("name").contains("_submissions")).alias("has_submissions"),
    )


def record_estimate(lines: DataFrame, total_bytes: Column, order: str, text: str, sample: int = 100, fallback_per_gb: int = 200_000) -> DataFrame:
    """Records in ``total_bytes`` from the mean size of the first ``sample`` lines; without lines, a fixed number for each GB."""
    head = lines.orderBy(order).limit(sample).agg(F.avg(F.octet_length(text)).alias("mean"), F.count(F.lit(1)).alias("sampled"))
    guess = F.floor(total_bytes / 1073741824 * fallback_per_gb)
    return head.select("sampled", F.round("mean", 6).alias("mean_bytes"), F.coalesce(F.floor(F.try_divide(total_bytes, F.col("mean"))), guess).cast("long").alias("estimated_records"))


def json_share(lines: DataFrame, text: str, order: str, sample: int = 10) -> DataFrame:
    """Share of the first lines that are JSON, and whether the file counts as JSON lines (over four fifths)."""
    head = lines.orderBy(order).limit(sample).select(F.try_parse_json(text).isNotNull().alias("ok"))
    return head.agg(F.count(F.lit(1)).alias("sampled"), F.count_if("ok").alias("parsed")).withColumn("json_lines", F.col("parsed") * 10 > F.col("sampled") * 8)


def sequence_totals(files: DataFrame, sequences: str = "sequences", tokens_each: int = 256) -> DataFrame:
    """Valid and failed files, sequences, mean of a file (whole number), estimated tokens and readiness."""
    ok = F.col(sequences).isNotNull()
    out = files.agg(F.count_if(ok).alias("valid"), F.count_if(~ok).alias("failed"), F.coalesce(F.sum(sequences), F.lit(0)).alias("sequences"))
    ready = F.when(F.col("valid") >= 700, "ready").when(F.col("valid") >= 500, "nearly").otherwise("not ready")
    return out.withColumns({"per_file": F.coalesce(F.expr("try_divide(sequences, valid)"), F.lit(0)).cast("long"), "estimated_tokens": F.col("sequences") * tokens_each, "readiness": ready})


def token_extrapolation(files: DataFrame, total_files: int, tokens: str = "tokens") -> DataFrame:
    """All tokens from the mean of valid files, the number of files and the share that is corrupt."""
    ok = F.col(tokens).isNotNull()
    out = files.agg(F.avg(tokens).alias("mean"), F.avg((~ok).cast("double")).alias("corrupt"))
    return out.select(F.round("mean", 6).alias("avg_tokens_per_file"), F.round("corrupt", 6).alias("corruption_rate"), F.round(F.col("mean") * total_files * (1 - F.col("corrupt")), 2).alias("total_tokens"))


def operation_times(log: DataFrame, operation: str, seconds: str) -> DataFrame:
    return log.groupBy(operation).agg(F.round(F.avg(seconds), 6).alias("avg"), F.max(seconds).alias("max"), F.min(seconds).alias("min"), F.count(F.lit(1)).alias("calls"))


def operation_rates(log: DataFrame, operation: str, seconds: str, size: str) -> DataFrame:
    """Times of each operation, its MB in all, and the mean of its calls' MB a second (calls without time left out)."""
    mb = F.col(size) / 1048576
    times = [F.round(F.avg(seconds), 6).alias("avg"), F.max(seconds).alias("max"), F.min(seconds).alias("min"), F.count(F.lit(1)).alias("calls")]
    return log.groupBy(operation).agg(*times, F.round(F.sum(mb), 6).alias("total_mb"), F.round(F.avg(F.try_divide(mb, F.nullif(F.col(seconds), F.lit(0.0)))), 6).alias("mb_per_second"))


def training_counts(rows: DataFrame, words: str, score: str, comments: str) -> DataFrame:
    """The conditional counts of training metadata: more than 20 words, a score above 10, more than 5 comments."""
    limits = ((words, 20, "over_20_words"), (score, 10, "over_score_10"), (comments, 5, "over_5_comments"))
    return rows.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(c) > n).alias(name) for c, n, name in limits])


def mean_of_present(metrics: DataFrame, columns: list[str]) -> DataFrame:
    """Mean of each metric over the batches that have it."""
    return metrics.agg(*[F.round(F.avg(c), 6).alias(c) for c in columns])


def keep_newest(checkpoints: DataFrame, keep: int, order: str = "step") -> DataFrame:
    """The newest checkpoints; ``keep`` is small, so a top-k suffices."""
    return checkpoints.orderBy(F.desc(order)).limit(keep)


def vocabulary_coverage(tokens: DataFrame, vocabulary: DataFrame, token: str) -> DataFrame:
    """Share of token occurrences, and of distinct tokens, that the vocabulary has."""
    counts = tokens.groupBy(token).agg(F.count(F.lit(1)).alias("n"))
    known = counts.join(vocabulary.select(token).distinct().withColumn("known", F.lit(1)), token, "left").withColumn("known", F.coalesce("known", F.lit(0)))
    return known.agg(F.round(F.sum(F.col("n") * F.col("known")) / F.sum("n"), 6).alias("token_coverage"), F.round(F.avg("known"), 6).alias("type_coverage"))


def unknown_rate(tokens: Column) -> Column:
    """Share of tokens that look unknown, by the usual marks (a word-start mark counts as well)."""
    odd = F.filter(tokens, lambda t: t.contains("[UNK]") | t.contains("<unk>") | t.contains("<UNK>") | t.contains("▁"))
    return F.coalesce(F.try_divide(F.size(odd), F.size(tokens)), F.lit(0.0))


def tier(score: Column) -> Column:
    """Quality tiers by score."""
    return F.when(score >= 50, "high").when(score >= 10, "medium").when(score >= 1, "basic").otherwise("none")
