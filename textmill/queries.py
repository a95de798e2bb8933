"""The engine's queries over the provided tables, each with its DuckDB twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import bpe
from textmill.functions import text as T
from textmill.operators import cleaning, progress, records, reports, sequences, series, tuning
from textmill.plans import pipelines, planner

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# White space and word characters as RE2 classes.
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WC = r"[\p{L}\p{N}_]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def sql_words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def sql_rules(x: str, rules: list[tuple[str, str]]) -> str:
    """The substitutions in RE2's notation."""
    for pattern, by in rules:
        flags = "gi" if pattern.startswith("(?iu)") else "g"
        pattern = pattern.replace("(?iu)", "").replace("(?dm)", "(?m)").replace("(?d)", "").replace(T.WS, WS).replace("(?U)", "")
        by = by.replace("$1", r"\1")
        x = f"regexp_replace({x}, {_quoted(pattern)}, {_quoted(by)}, '{flags}')"
    return x


SQL_CLEAN = lambda x: sql_strip(sql_rules(x, T.POST_RULES))
SQL_FLAT = lambda x: sql_strip(f"regexp_replace({x}, '{WS}+', ' ', 'g')")
SQL_DUMP = lambda x: sql_strip(sql_rules(SQL_FLAT(x), T.DUMP_RULES))
SQL_KEY_POST = lambda t, b: f"md5(regexp_replace({sql_strip(f"lower({t} || ' ' || {b})")}, '{WS}+', ' ', 'g'))"
SQL_KEY_DUMP = lambda x: f"md5(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}_]+', '', 'g'))"
SQL_POSTS = """posts AS (
  SELECT d.doc_id, '' AS title, coalesce(d.text, '') AS selftext, d.source AS subreddit,
    CAST(CASE WHEN quality = 1 THEN 50 WHEN quality = 0 THEN 0 ELSE 1 END AS BIGINT) AS score, coalesce(toxic = 1, false) AS over_18
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
SQL_REASON = f"""CASE
    WHEN selftext = '' OR lower(selftext) IN ('[deleted]', '[removed]') THEN 'deleted_or_removed'
    WHEN over_18 THEN 'nsfw' WHEN n < 5 THEN 'too_short' WHEN n > 10000 THEN 'too_long'
    WHEN regexp_matches(' ' || lower(selftext), {_quoted('|'.join(T.SPAM))}) THEN 'spam_pattern'
    WHEN n > 10 AND 10 * list_max(map_values(histogram_)) > 3 * n THEN 'repetitive'
    WHEN score < -10 THEN 'heavily_downvoted' ELSE 'high_quality' END"""
SQL_CLEANED = f"""{SQL_POSTS},
firsts AS (SELECT * FROM posts QUALIFY row_number() OVER (PARTITION BY {SQL_KEY_POST('title', 'selftext')} ORDER BY doc_id) = 1),
cleaned AS (SELECT doc_id, subreddit, score, over_18, len({sql_words('selftext')}) AS word_count, {SQL_CLEAN('selftext')} AS selftext FROM firsts),
counted AS (SELECT *, {sql_words('lower(selftext)')} AS w FROM cleaned),
top AS (SELECT doc_id, max(c) AS top FROM (SELECT doc_id, x, count(*) AS c FROM (SELECT doc_id, unnest(w) AS x FROM counted) GROUP BY ALL) GROUP BY doc_id),
reasons AS (SELECT c.doc_id, subreddit, word_count, selftext, score, len(w) AS n, {SQL_REASON.replace('list_max(map_values(histogram_))', 'top.top').replace('n <', 'len(w) <').replace('n >', 'len(w) >').replace('3 * n', '3 * len(w)')} AS quality_reason
  FROM counted c LEFT JOIN top ON c.doc_id = top.doc_id)"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Text functions ---------------------------------------------------------------------------------


@query("clean_text_reddit", f"SELECT doc_id, {SQL_CLEAN('text')} AS cleaned FROM documents")
def clean_text_reddit(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.clean_post(F.col("text")).alias("cleaned"))


@query("clean_text_massive", f"""
WITH c AS (SELECT doc_id, text, {SQL_FLAT('text')} AS flat, {SQL_DUMP('text')} AS done FROM documents)
SELECT doc_id, CASE WHEN text NOT IN ('', '[deleted]', '[removed]') AND length(flat) >= 20 AND length(done) >= 20 THEN done END AS cleaned FROM c""")
def clean_text_massive(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.clean_dump(F.col("text")).alias("cleaned"))


@query("dedup_keys", f"""
SELECT doc_id, {SQL_KEY_POST("''", 'text')} AS key_a, {SQL_KEY_DUMP('text')} AS key_b,
  CASE WHEN {sql_strip('lower(text)')} <> '' THEN md5({sql_strip('lower(text)')}) END AS key_c FROM documents""")
def dedup_keys(spark, sf_dir):
    text = F.col("text")
    return documents(spark, sf_dir).select("doc_id", T.key_post(F.lit(""), text).alias("key_a"), T.key_dump(text).alias("key_b"), T.key_training(text).alias("key_c"))


@query("text_measures", f"""
SELECT doc_id, length(text) AS chars, strlen(text) AS bytes, len({sql_words('text')}) AS words, {sql_strip('lower(text)')} AS stripped FROM documents""")
def text_measures(spark, sf_dir):
    text = F.col("text")
    return documents(spark, sf_dir).select("doc_id", F.length(text).alias("chars"), F.octet_length(text).alias("bytes"), T.word_count(text).alias("words"), T.strip(F.lower(text)).alias("stripped"))


def _sql_tiers(x: str, rows: list[tuple[int, int]]) -> str:
    return "CASE " + " ".join(f"WHEN {x} > {a} THEN {p}" for a, p in rows) + " ELSE 0 END"


@query("score_wikipedia", f"""
SELECT doc_id, CAST(least({_sql_tiers('length(text)', [(5000, 30), (2000, 20), (1000, 10)])} + CASE WHEN length(left(text, 150)) > 100 THEN 10 ELSE 0 END + CASE WHEN source <> '' THEN 5 ELSE 0 END
  + CASE WHEN contains(text, 'http') OR contains(text, 'www.') THEN 5 ELSE 0 END
  + CASE WHEN contains(lower(text), '==') OR contains(lower(text), 'category:') OR contains(lower(text), 'infobox') OR contains(lower(text), 'references') THEN 5 ELSE 0 END
  + CASE WHEN text <> '' AND len(string_split(text, '.')) > 5 THEN 5 ELSE 0 END + {_sql_tiers(f"len({sql_words('text')})", [(1000, 10), (500, 5)])}, 70) AS DOUBLE) AS quality_score FROM documents""")
def score_wikipedia(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.score_article(F.col("text"), F.substring("text", 1, 150), F.col("source")).alias("quality_score"))


SQL_POST_SCORE = f"CAST(least({_sql_tiers('score', [(100, 20), (50, 15), (10, 10), (0, 5)])} + {_sql_tiers(f"len({sql_words('selftext')})", [(200, 25), (100, 20), (50, 15), (20, 10)])}, 70) AS DOUBLE)"


@query("score_reddit", f"WITH {SQL_POSTS} SELECT doc_id, {SQL_POST_SCORE} AS quality_score FROM posts")
def score_reddit(spark, sf_dir):
    posts = pipelines.corpus(spark, sf_dir)
    return posts.select("doc_id", T.score_post(F.col("score"), F.col("num_comments"), F.col("selftext"), F.col("title")).alias("quality_score"))


@query("score_general", f"SELECT doc_id, CAST(least({_sql_tiers(f"len({sql_words('text')})", [(500, 40), (200, 30), (100, 20), (50, 10)])}, 50) AS DOUBLE) AS quality_score FROM documents")
def score_general(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.score_general(F.col("text"), F.lit("")).alias("quality_score"))


# Cleaning -----------------------------------------------------------------------------------------


@query("dedup_first_wins", f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY {SQL_KEY_POST("''", 'text')}")
def dedup_first_wins(spark, sf_dir):
    return cleaning.first_wins(documents(spark, sf_dir).select("doc_id", "text"), T.key_post(F.lit(""), F.col("text")), "doc_id").select("doc_id")


@query("quality_reason", f"WITH {SQL_CLEANED} SELECT doc_id, word_count, n AS total_word_count, quality_reason FROM reasons")
def quality_reason(spark, sf_dir):
    return pipelines.clean_posts(pipelines.corpus(spark, sf_dir)).select("doc_id", "word_count", "total_word_count", "quality_reason")


@query("cleaned_posts", f"WITH {SQL_CLEANED} SELECT doc_id, subreddit, score, selftext FROM reasons WHERE quality_reason = 'high_quality'")
def cleaned_posts(spark, sf_dir):
    return pipelines.clean_posts(pipelines.corpus(spark, sf_dir)).where(F.col("quality_reason") == cleaning.KEPT).select("doc_id", "subreddit", "score", "selftext")


@query("cleaning_stats", f"""WITH {SQL_CLEANED}
SELECT (SELECT count(*) FROM documents) AS processed, (SELECT count(*) FROM documents) - count(*) AS removed_duplicates, count(*) FILTER (quality_reason = 'high_quality') AS kept,
  count(*) FILTER (quality_reason = 'deleted_or_removed') AS removed_deleted, count(*) FILTER (quality_reason = 'nsfw') AS removed_nsfw, count(*) FILTER (quality_reason IN ('spam_pattern', 'repetitive')) AS removed_spam,
  count(*) FILTER (quality_reason NOT IN ('high_quality', 'deleted_or_removed', 'nsfw', 'spam_pattern', 'repetitive')) AS removed_low_quality FROM reasons""")
def cleaning_stats(spark, sf_dir):
    posts = pipelines.corpus(spark, sf_dir)
    total = documents(spark, sf_dir).agg(F.count(F.lit(1)).alias("processed"))
    stats = pipelines.clean_posts(posts).agg(F.count(F.lit(1)).alias("unique"), *cleaning.reason_counts(posts, F.col("quality_reason")))
    return total.crossJoin(stats).withColumn("removed_duplicates", F.col("processed") - F.col("unique")).drop("unique")  # one row each


@query("reason_counts", f"WITH {SQL_CLEANED} SELECT quality_reason, count(*) AS posts FROM reasons GROUP BY quality_reason")
def reason_counts(spark, sf_dir):
    return pipelines.clean_posts(pipelines.corpus(spark, sf_dir)).groupBy("quality_reason").agg(F.count(F.lit(1)).alias("posts"))


def _sql_describe(x: str, std: str) -> str:
    return f"round(avg({x}), 6) AS mean, CAST(min({x}) AS DOUBLE) AS min, CAST(max({x}) AS DOUBLE) AS max, CAST(median({x}) AS DOUBLE) AS median, round({std}({x}), 6) AS std"


@query("cleaning_metadata", f"WITH {SQL_CLEANED} SELECT count(*) AS posts, {_sql_describe('n', 'stddev_pop')} FROM reasons WHERE quality_reason = 'high_quality'")
def cleaning_metadata(spark, sf_dir):
    kept = pipelines.clean_posts(pipelines.corpus(spark, sf_dir)).where(F.col("quality_reason") == cleaning.KEPT)
    return kept.agg(F.count(F.lit(1)).alias("posts"), *cleaning.describe("total_word_count"))


@query("massive_pipeline", f"""WITH {SQL_POSTS},
c AS (SELECT doc_id, subreddit, score, selftext, {SQL_FLAT('selftext')} AS flat, {SQL_DUMP('selftext')} AS text FROM posts),
k AS (SELECT * FROM c WHERE selftext NOT IN ('', '[deleted]', '[removed]') AND length(flat) >= 20 AND length(text) >= 20),
f AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY {SQL_KEY_DUMP('text')} ORDER BY doc_id) = 1)
SELECT doc_id, subreddit, score, text FROM f WHERE score >= 1""")
def massive_pipeline(spark, sf_dir):
    out = pipelines.clean_dumps(pipelines.corpus(spark, sf_dir).select("doc_id", "subreddit", "score", "selftext"), "selftext", "score", "doc_id")
    return out.select("doc_id", "subreddit", "score", F.col("text_clean").alias("text"))


@query("massive_file_stats", f"""WITH {SQL_POSTS}, n AS (SELECT *, CASE WHEN doc_id % 5 = 0 THEN 'huggingface_' ELSE 'reddit_' END || subreddit AS file FROM posts),
c AS (SELECT doc_id, file, score, selftext, {SQL_FLAT('selftext')} AS flat, {SQL_DUMP('selftext')} AS text FROM n),
k AS (SELECT *, row_number() OVER (PARTITION BY {SQL_KEY_DUMP('text')} ORDER BY doc_id) AS place FROM c WHERE selftext NOT IN ('', '[deleted]', '[removed]') AND length(flat) >= 20 AND length(text) >= 20),
r AS (SELECT c.file, place, k.score >= 1 OR contains(c.file, 'huggingface') AS good FROM c LEFT JOIN k USING (doc_id))
SELECT file, count(DISTINCT file) AS files_processed, count(*) AS posts_read, count(*) FILTER (place = 1 AND good) AS posts_cleaned, count(*) FILTER (place > 1) AS duplicates FROM r GROUP BY ROLLUP (file)""")
def massive_file_stats(spark, sf_dir):
    rows = pipelines.corpus(spark, sf_dir).select("doc_id", "subreddit", "score", "selftext")
    rows = rows.withColumn("file", F.concat(F.when(F.col("doc_id") % 5 == 0, "huggingface_").otherwise("reddit_"), "subreddit"))
    return pipelines.file_stats(rows, "file", "selftext", "score", "doc_id", F.col("file").contains("huggingface"))


SQL_ITEMS = f"items AS (SELECT *, CASE WHEN {sql_strip('selftext')} = '' THEN 'Topic: ' ELSE 'Topic: ' || chr(10) || chr(10) || 'Discussion: ' || selftext END AS training_text, {SQL_POST_SCORE} AS quality_score FROM posts)"
SQL_KEPT_ITEMS = f"kept AS (SELECT * FROM items WHERE {sql_strip('training_text')} <> '' AND quality_score >= 25 QUALIFY row_number() OVER (PARTITION BY md5({sql_strip('lower(training_text)')}) ORDER BY doc_id) = 1)"


@query("multi_source_pipeline", f"WITH {SQL_POSTS}, {SQL_ITEMS}, {SQL_KEPT_ITEMS} SELECT doc_id, quality_score, training_text FROM kept")
def multi_source_pipeline(spark, sf_dir):
    return pipelines.multi_source(pipelines.items_from(pipelines.corpus(spark, sf_dir)), "doc_id").select("doc_id", "quality_score", "training_text")


@query("multi_source_stats", f"""WITH {SQL_POSTS}, {SQL_ITEMS}, {SQL_KEPT_ITEMS}
SELECT count(*) AS items, {_sql_describe('quality_score', 'stddev_pop')}, round(avg(len({sql_words('selftext')})), 6) AS avg_words, round(avg(length(selftext)), 6) AS avg_length FROM kept""")
def multi_source_stats(spark, sf_dir):
    kept = pipelines.multi_source(pipelines.items_from(pipelines.corpus(spark, sf_dir)), "doc_id")
    return kept.agg(F.count(F.lit(1)).alias("items"), *cleaning.describe("quality_score"), F.round(F.avg("word_count"), 6).alias("avg_words"), F.round(F.avg("content_length"), 6).alias("avg_length"))


SQL_TRAINING = f"training AS (SELECT *, CASE WHEN {sql_strip('selftext')} = '' THEN 'Topic: ' ELSE 'Topic: ' || chr(10) || chr(10) || 'Discussion: ' || {sql_strip('selftext')} END AS training_text FROM posts), rows_ AS (SELECT *, length(training_text) AS text_length, len({sql_words('training_text')}) AS text_words FROM training WHERE length(training_text) >= 20)"


@query("training_text", f"WITH {SQL_POSTS}, {SQL_TRAINING} SELECT doc_id, training_text, text_length, text_words FROM rows_")
def training_text(spark, sf_dir):
    return pipelines.training_rows(pipelines.corpus(spark, sf_dir)).select("doc_id", "training_text", "text_length", "text_words")


@query("training_metadata", f"""WITH {SQL_POSTS}, {SQL_TRAINING}
SELECT count(*) AS total, {_sql_describe('text_words', 'stddev_samp')}, round(avg(text_length), 6) AS avg_length, count(DISTINCT subreddit) AS subreddits,
  count(*) FILTER (text_words > 20) AS over_20_words, count(*) FILTER (score > 10) AS over_score_10 FROM rows_""")
def training_metadata(spark, sf_dir):
    rows = pipelines.training_rows(pipelines.corpus(spark, sf_dir))
    return rows.agg(
        F.count(F.lit(1)).alias("total"), *cleaning.describe("text_words", sample=True), F.round(F.avg("text_length"), 6).alias("avg_length"), F.countDistinct("subreddit").alias("subreddits"),
        F.count_if(F.col("text_words") > 20).alias("over_20_words"), F.count_if(F.col("score") > 10).alias("over_score_10"),
    )


@query("subreddit_distribution", "SELECT count(*) AS sources, CAST(min(n) AS DOUBLE) AS min, CAST(max(n) AS DOUBLE) AS max, round(avg(n), 6) AS mean, CAST(median(n) AS DOUBLE) AS median, round(stddev_pop(n), 6) AS std FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)")
def subreddit_distribution(spark, sf_dir):
    sizes = documents(spark, sf_dir).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count(F.lit(1)).alias("sources"), *cleaning.describe("n"))


@query("top_k_sources", "SELECT source, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, source) AS INTEGER) AS place FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 10")
def top_k_sources(spark, sf_dir):
    from pyspark.sql.window import Window

    top = documents(spark, sf_dir).groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "source").limit(10)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "source")))  # ten rows


@query("per_file_rollup", "SELECT source, lang, count(*) AS docs, sum(n_chars) AS chars FROM documents GROUP BY ROLLUP(source, lang)")
def per_file_rollup(spark, sf_dir):
    return documents(spark, sf_dir).rollup("source", "lang").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_chars").alias("chars"))


@query("custom_filter", f"SELECT doc_id FROM documents d JOIN labels l USING (doc_id) WHERE quality = 1 AND toxic = 0 AND len({sql_words('text')}) > 100")
def custom_filter(spark, sf_dir):
    good = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")
    return documents(spark, sf_dir).where(T.word_count(F.col("text")) > 100).join(good, "doc_id").select("doc_id")


def _sql_split(source: str, key: str, stratum: str, train: float, validation: float, least: int, names: tuple[str, str, str]) -> str:
    return f"""WITH s AS (SELECT *, count(*) OVER (PARTITION BY {stratum}) AS size_ FROM {source}),
g AS (SELECT *, CASE WHEN size_ >= {least} THEN {stratum} END AS stratum_ FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY stratum_ ORDER BY md5(CAST({key} AS VARCHAR) || '-42'), {key}) AS place, count(*) OVER (PARTITION BY stratum_) AS n FROM g)
SELECT {key}, CASE WHEN place <= floor(n * CAST({train} AS DOUBLE)) THEN '{names[0]}' WHEN place <= floor(n * CAST({train} AS DOUBLE)) + floor(n * CAST({validation} AS DOUBLE)) THEN '{names[1]}' ELSE '{names[2]}' END AS split FROM r"""


@query("stratified_split", _sql_split("documents", "doc_id", "source", 0.7, 0.15, 10, ("train", "validation", "test")))
def stratified_split(spark, sf_dir):
    return cleaning.split(documents(spark, sf_dir).select("doc_id", "source"), "doc_id", F.col("source")).select("doc_id", "split")


@query("split_report", f"""SELECT split, count(*) AS rows, round(100.0 * count(*) / (SELECT count(*) FROM documents), 6) AS percent FROM ({_sql_split("documents", "doc_id", "source", 0.7, 0.15, 10, ("train", "validation", "test"))}) GROUP BY split""")
def split_report(spark, sf_dir):
    total = documents(spark, sf_dir).agg(F.count(F.lit(1)).alias("total"))
    parts = stratified_split(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
    return parts.crossJoin(F.broadcast(total)).select("split", "rows", F.round(F.lit(100.0) * F.col("rows") / F.col("total"), 6).alias("percent"))  # one row


@query("sft_split", _sql_split("(SELECT DISTINCT conv_id FROM conversations)", "conv_id", "1", 0.1, 0.0, 0, ("eval", "train", "train")))
def sft_split(spark, sf_dir):
    return cleaning.holdout(table(spark, sf_dir, "conversations").select("conv_id").distinct(), "conv_id")


# Token sequences ----------------------------------------------------------------------------------

#: Stand-in ids for queries with a SQL twin: the lengths of the words.
SQL_IDS = f"ids AS (SELECT doc_id, source, list_transform({sql_words('text')}, lambda w: CAST(length(w) AS INTEGER)) AS ids FROM documents)"


def word_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", "source", F.transform(T.words(F.col("text")), lambda w: F.length(w)).alias("ids"))


@query("prepare_text_tagged", "SELECT doc_id, concat_ws(chr(10), '<|startoftext|>', CASE WHEN source = 'openwebtext' THEN '<|hf|>' ELSE '<|reddit|>' END, nullif(text, ''), '<|endoftext|>') AS tagged FROM documents")
def prepare_text_tagged(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", records.tagged(F.lit(""), F.col("text"), F.col("source")).alias("tagged"))


@query("prepare_text_plain", "SELECT doc_id, concat_ws(chr(10), CASE WHEN source NOT IN ('', '[deleted]', '[removed]') THEN source END, CASE WHEN text NOT IN ('', '[deleted]', '[removed]') THEN text END) AS plain FROM documents")
def prepare_text_plain(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", records.plain(F.col("source"), F.col("text")).alias("plain"))


def _fold(column: str) -> list:
    total = F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a + x)
    return [F.size(column).alias("length"), total.alias("id_sum"), F.try_element_at(column, F.lit(1)).alias("first_id"), F.try_element_at(column, F.lit(-1)).alias("last_id")]


SQL_FOLD = lambda x: f"len({x}) AS length, CAST(coalesce(list_sum({x}), 0) AS BIGINT) AS id_sum, {x}[1] AS first_id, {x}[-1] AS last_id"


@query("token_windows", f"""WITH {SQL_IDS},
s AS (SELECT doc_id, ids, unnest(range(0, CAST(1 + greatest(ceil((len(ids) - 1024) / 512.0), 0) AS BIGINT))) AS w FROM ids)
SELECT doc_id, CAST(w AS INTEGER) AS "window", CAST(w * 512 AS INTEGER) AS start, {SQL_FOLD('ids[w * 512 + 1 : w * 512 + 1024]')} FROM s""")
def token_windows(spark, sf_dir):
    return sequences.token_windows(word_ids(spark, sf_dir), "ids").select("doc_id", "window", "start", *_fold("input_ids"))


@query("window_estimate", f"WITH {SQL_IDS} SELECT doc_id, CAST(1 + greatest(ceil((len(ids) - 1024) / 512.0), 0) AS BIGINT) AS windows, CAST(greatest(1, 1 + floor((len(ids) - 1024) / 512.0)) AS BIGINT) AS estimate FROM ids")
def window_estimate(spark, sf_dir):
    size = F.size("ids")
    return word_ids(spark, sf_dir).select("doc_id", sequences.window_count(size).alias("windows"), sequences.window_estimate(size).alias("estimate"))


@query("pad_mask", f"""WITH {SQL_IDS}, m AS (SELECT source, max(len(ids)) AS longest FROM ids GROUP BY source)
SELECT doc_id, longest AS padded, CAST(len(ids) AS BIGINT) AS mask_sum, len(ids) AS sequence_length, CAST(coalesce(list_sum(ids), 0) AS BIGINT) AS id_sum FROM ids JOIN m USING (source)""")
def pad_mask(spark, sf_dir):
    out = sequences.pad_to_longest(word_ids(spark, sf_dir), "source", "ids")
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select("doc_id", F.size("padded_ids").alias("padded"), total("attention_mask").alias("mask_sum"), "sequence_length", total("padded_ids").alias("id_sum"))


def _sql_pack(length: int, tail: str) -> str:
    n = {"pad": f"greatest(1, CAST(floor((len(ids) - {length}) / {length}.0) AS BIGINT) + 1)", "keep": f"greatest(1, CAST(ceil(len(ids) / {length}.0) AS BIGINT))", "drop": f"len(ids) // {length}"}[tail]
    return f"""WITH {SQL_IDS}, s AS (SELECT doc_id, ids, unnest(range(0, {n})) AS w FROM ids)
SELECT doc_id, CAST(w AS INTEGER) AS "window", {length} AS length, CAST(coalesce(list_sum(ids[w * {length} + 1 : (w + 1) * {length}]), 0) AS BIGINT) AS id_sum FROM s"""


def _packed(spark, sf_dir, tail):
    out = sequences.pack(word_ids(spark, sf_dir), "ids", 128, tail)
    return out.select("doc_id", "window", F.size("input_ids").alias("length"), F.aggregate("input_ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("id_sum"))


@query("pack_pad", _sql_pack(128, "pad"))
def pack_pad(spark, sf_dir):
    return _packed(spark, sf_dir, "pad")


@query("pack_keep", _sql_pack(128, "keep"))
def pack_keep(spark, sf_dir):
    return _packed(spark, sf_dir, "keep")


@query("pack_drop", _sql_pack(128, "drop"))
def pack_drop(spark, sf_dir):
    return _packed(spark, sf_dir, "drop")


@query("shift_examples", f"""WITH {SQL_IDS}, e AS (SELECT doc_id, ids[1 : len(ids) - 1] AS a, ids[2 : len(ids)] AS b FROM ids WHERE len(ids) > 1)
SELECT doc_id, len(a) AS length, CAST(list_sum(a) AS BIGINT) AS input_sum, CAST(list_sum(b) AS BIGINT) AS label_sum, CAST(len(list_filter(a, lambda x: x <> 0)) AS BIGINT) AS mask_sum FROM e""")
def shift_examples(spark, sf_dir):
    a, b, m = sequences.shift(F.col("ids"))
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda x, y: x + y)
    out = word_ids(spark, sf_dir).where(F.size("ids") > 1).select("doc_id", a.alias("a"), b.alias("b"), m.alias("m"))
    return out.select("doc_id", F.size("a").alias("length"), total("a").alias("input_sum"), total("b").alias("label_sum"), total("m").alias("mask_sum"))


@query("supervised_labels", f"""WITH {SQL_IDS}
SELECT doc_id, 256 AS length, CAST(greatest(0, 256 - len(ids)) AS BIGINT) AS ignored, CAST(coalesce(list_sum(ids[1:256]), 0) AS BIGINT) AS id_sum FROM ids""")
def supervised_labels(spark, sf_dir):
    full, labels = sequences.supervised(F.col("ids"), 256)
    out = word_ids(spark, sf_dir).select("doc_id", full.alias("f"), labels.alias("l"))
    return out.select("doc_id", F.size("f").alias("length"), F.size(F.filter("l", lambda x: x == -100)).cast("long").alias("ignored"), F.aggregate("f", F.lit(0).cast("long"), lambda a, x: a + x).alias("id_sum"))


@query("token_quality", f"""WITH {SQL_IDS}
SELECT count(*) AS sequences, round(avg(len(ids)), 6) AS avg_length, max(len(ids)) AS max_length, count(*) FILTER (len(ids) = 0) AS empty, round(1 - sum(len(ids)) / (count(*) * max(len(ids))), 6) AS padding_ratio FROM ids""")
def token_quality(spark, sf_dir):
    size = F.size("ids")
    return word_ids(spark, sf_dir).agg(F.count(F.lit(1)).alias("sequences"), F.round(F.avg(size), 6).alias("avg_length"), F.max(size).alias("max_length"), F.count_if(size == 0).alias("empty"), F.round(1 - F.sum(size) / (F.count(F.lit(1)) * F.max(size)), 6).alias("padding_ratio"))


@query("chunk_greedy", """WITH RECURSIVE o AS (SELECT doc_id, source, strlen(text) + 1 AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
c AS (SELECT doc_id, source, n, i, n AS total, 1 AS chunk FROM o WHERE i = 1
  UNION ALL SELECT o.doc_id, o.source, o.n, o.i, CASE WHEN c.total + o.n > 20000 THEN o.n ELSE c.total + o.n END, CASE WHEN c.total + o.n > 20000 THEN c.chunk + 1 ELSE c.chunk END
  FROM c JOIN o ON o.source = c.source AND o.i = c.i + 1)
SELECT doc_id, source, chunk FROM c""")
def chunk_greedy(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", "source", (F.octet_length("text") + 1).cast("long").alias("bytes"))
    return sequences.greedy_chunks(rows, "source", ["doc_id"], "bytes", 20_000).select("doc_id", "source", "chunk")


@query("bpe_pretoken_counts")
def bpe_pretoken_counts(spark, sf_dir):
    return bpe.pretoken_counts(documents(spark, sf_dir), "text")


# The reference's vocabulary, special tokens and bytes included.
VOCABULARY = 50_257


@query("bpe_train")
def bpe_train(spark, sf_dir):
    merges = bpe.train(documents(spark, sf_dir), "text", VOCABULARY)
    rows = [(i, a.hex(), b.hex()) for i, (a, b) in enumerate(merges)]
    return spark.createDataFrame(rows, "rank int, left_hex string, right_hex string")


@query("bpe_encode")
def bpe_encode(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", "n_chars")
    out = bpe.encode(docs, "text", bpe.train(docs, "text", VOCABULARY), ["doc_id", "n_chars"])
    return out.select("doc_id", F.size("input_ids").alias("tokens"), F.round(F.try_divide("n_chars", F.size("input_ids")), 6).alias("chars_per_token"))  # null without tokens


# Fine-tuning --------------------------------------------------------------------------------------


@query("sft_chat", "SELECT conv_id, string_agg('<|' || role || '|>' || coalesce(text, '') || '<|end|>' || chr(10), '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def sft_chat(spark, sf_dir):
    return tuning.conversations(table(spark, sf_dir, "conversations")).select("conv_id", tuning.chat_messages(F.col("messages")).alias("text"))


SQL_PAIRS = "p AS (SELECT conv_id, turn, text AS prompt, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS response, role, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role FROM conversations), pairs AS (SELECT * FROM p WHERE role = 'user' AND next_role = 'assistant')"


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant's answer that follows."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").withColumns({"response": F.lead("text").over(w), "next_role": F.lead("role").over(w)})
    return rows.where("role = 'user' AND next_role = 'assistant'").select("conv_id", "turn", F.col("text").alias("prompt"), "response")


@query("sft_prompt_response", f"WITH {SQL_PAIRS} SELECT conv_id, turn, '<|user|>' || prompt || '<|end|>' || chr(10) || '<|assistant|>' || response || '<|end|>' AS text FROM pairs")
def sft_prompt_response(spark, sf_dir):
    return turn_pairs(spark, sf_dir).select("conv_id", "turn", tuning.chat_pair(F.col("prompt"), F.col("response")).alias("text"))


@query("sft_instruct", f"WITH {SQL_PAIRS} SELECT conv_id, turn, '### Instruction:' || chr(10) || prompt || chr(10) || chr(10) || CASE WHEN turn % 2 = 0 THEN '### Input:' || chr(10) || 'x' || chr(10) || chr(10) ELSE '' END || '### Response:' || chr(10) || response AS text FROM pairs")
def sft_instruct(spark, sf_dir):
    given = F.when(F.col("turn") % 2 == 0, "x")
    return turn_pairs(spark, sf_dir).select("conv_id", "turn", tuning.instruct(F.col("prompt"), given, F.col("response")).alias("text"))


@query("sft_code", f"WITH {SQL_PAIRS} SELECT conv_id, turn, '# Task: ' || prompt || chr(10) || chr(10) || response AS text FROM pairs")
def sft_code(spark, sf_dir):
    none = F.lit(None).cast("string")
    return turn_pairs(spark, sf_dir).select("conv_id", "turn", tuning.code(F.col("prompt"), F.col("response"), none, none).alias("text"))


@query("sft_custom", f"WITH {SQL_PAIRS} SELECT conv_id, turn, prompt || chr(10) || response AS text FROM pairs")
def sft_custom(spark, sf_dir):
    none = F.lit(None).cast("string")
    return turn_pairs(spark, sf_dir).select("conv_id", "turn", tuning.custom(none, F.col("prompt"), F.col("response"), none, none, [F.col("prompt")]).alias("text"))


SQL_PAIR_WORDS = f"{SQL_PAIRS}, pw AS (SELECT conv_id, turn, {sql_words('prompt')} AS g, {sql_words('response')} AS r FROM pairs)"


def pair_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_pairs(spark, sf_dir).select("conv_id", "turn", T.words(F.col("prompt")).alias("g"), T.words(F.col("response")).alias("r"))


SQL_GRAMS = lambda x, n: f"(CASE WHEN len({x}) >= {n} THEN list_transform(range(1, len({x}) - {n} + 2), lambda i: array_to_string({x}[i : i + {n - 1}], ' ')) ELSE [] END)"


@query("metric_general", """WITH e AS (SELECT quality AS p, CASE WHEN doc_id % 7 = 0 THEN -100 ELSE toxic END AS l FROM labels), u AS (SELECT * FROM e WHERE l <> -100)
SELECT round(avg(CASE WHEN p = l THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(DISTINCT p) AS unique_tokens, round(count(DISTINCT p) / count(*), 6) AS vocab_usage, count(*) AS total_tokens FROM u""")
def metric_general(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select(F.col("quality").alias("p"), F.when(F.col("doc_id") % 7 == 0, tuning.IGNORED).otherwise(F.col("toxic")).alias("l"))
    return tuning.token_accuracy(rows, "p", "l")


@query("metric_chat", f"WITH {SQL_PAIR_WORDS}, x AS (SELECT unnest({SQL_GRAMS('r', 2)}) AS g FROM pw) SELECT count(*) AS total, count(DISTINCT g) AS \"distinct\", round(count(DISTINCT g) / greatest(count(*), 1), 6) AS diversity FROM x")
def metric_chat(spark, sf_dir):
    return tuning.diversity(pair_words(spark, sf_dir), "r", 2)


@query("metric_code", f"WITH {SQL_PAIR_WORDS}, x AS (SELECT conv_id, turn, list_distinct({SQL_GRAMS('r', 3)}) AS a, {SQL_GRAMS('g', 3)} AS b FROM pw) SELECT conv_id, turn, CASE WHEN len(a) > 0 THEN round(len(list_filter(a, lambda y: list_contains(b, y))) / len(a), 6) ELSE 0.0 END AS consistency FROM x")
def metric_code(spark, sf_dir):
    return pair_words(spark, sf_dir).select("conv_id", "turn", F.round(tuning.pattern_consistency(F.col("r"), F.col("g")), 6).alias("consistency"))


@query("metric_repetition", f"WITH {SQL_PAIR_WORDS}, x AS (SELECT g, count(*) AS n FROM (SELECT unnest({SQL_GRAMS('r', 3)}) AS g FROM pw) GROUP BY g) SELECT count(*) AS \"distinct\", count(*) FILTER (n > 1) AS repeated, round(coalesce(count(*) FILTER (n > 1) / nullif(count(*), 0), 0), 6) AS repetition_rate FROM x")
def metric_repetition(spark, sf_dir):
    return tuning.repetition_rate(pair_words(spark, sf_dir), "r")


@query("metric_bleu", f"WITH {SQL_PAIR_WORDS}, x AS (SELECT conv_id, turn, g, r, {SQL_GRAMS('g', 1)} AS a, {SQL_GRAMS('r', 1)} AS b FROM pw) SELECT conv_id, turn, CASE WHEN len(g) >= 1 AND len(r) >= 1 THEN round(len(list_filter(a, lambda y: list_contains(b, y))) / len(a) * least(1.0, len(g) / len(r)), 6) ELSE 0.0 END AS bleu FROM x")
def metric_bleu(spark, sf_dir):
    return pair_words(spark, sf_dir).select("conv_id", "turn", F.round(tuning.simple_bleu(F.col("g"), F.col("r"), 1), 6).alias("bleu"))


@query("metric_generation", f"WITH {SQL_PAIR_WORDS} SELECT round(avg(len(g)), 6) AS avg_generated, round(avg(len(r)), 6) AS avg_reference, round(avg(len(g)) / avg(len(r)), 6) AS length_ratio FROM pw")
def metric_generation(spark, sf_dir):
    g, r = F.avg(F.size("g")), F.avg(F.size("r"))
    return pair_words(spark, sf_dir).agg(F.round(g, 6).alias("avg_generated"), F.round(r, 6).alias("avg_reference"), F.round(g / r, 6).alias("length_ratio"))


# Progress, completeness, planners -----------------------------------------------------------------


def _names(spark, sf_dir):
    inputs = documents(spark, sf_dir).select(F.concat(F.lit("cleaned_doc"), "doc_id", F.lit(".jsonl")).alias("name"), "doc_id")
    odd = documents(spark, sf_dir).where("doc_id % 3 = 0")
    outputs = odd.select(F.concat(F.lit("out/tokenized_"), F.when(F.col("doc_id") % 2 == 0, "cleaned_").otherwise(""), F.lit("doc"), "doc_id", F.when(F.col("doc_id") % 4 == 0, "_part001").otherwise(""), F.lit(".npz")).alias("name"))
    return inputs, outputs


@query("completed_files", "SELECT doc_id FROM documents WHERE doc_id % 3 = 0")
def completed_files(spark, sf_dir):
    return progress.completed(*_names(spark, sf_dir)).select("doc_id")


@query("missing_files", "SELECT doc_id FROM documents WHERE doc_id % 3 <> 0")
def missing_files(spark, sf_dir):
    return progress.missing(*_names(spark, sf_dir)).select("doc_id")


def _steps(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type", "event_id", "value")


SQL_W = "OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"


@query("rolling_loss", f"SELECT event_id, round(avg(value) {SQL_W.format(99)}, 9) AS mean_100, round(avg(value) {SQL_W.format(9)}, 9) AS mean_10, round(var_pop(value) {SQL_W.format(99)}, 2) AS variance_100 FROM events")
def rolling_loss(spark, sf_dir):
    def made(w):
        ten = w.rowsBetween(-9, 0)
        return {"mean_100": F.round(F.avg("value").over(w), 9), "mean_10": F.round(F.avg("value").over(ten), 9), "variance_100": F.round(F.var_pop("value").over(w), 2)}

    return series.rolling(_steps(spark, sf_dir), ["event_type"], ["event_id"], 100, made).select("event_id", "mean_100", "mean_10", "variance_100")


@query("running_best", f"SELECT event_id, min(value) {SQL_W.format('UNBOUNDED')} AS best FROM events")
def running_best(spark, sf_dir):
    return series.running_best(_steps(spark, sf_dir), ["event_type"], ["event_id"], "value").select("event_id", "best")


@query("loss_trend", "SELECT event_id, CASE WHEN p IS NULL THEN 'start' WHEN value < p THEN 'improving' ELSE 'stable' END AS trend FROM (SELECT *, lag(value) OVER (PARTITION BY event_type ORDER BY event_id) AS p FROM events)")
def loss_trend(spark, sf_dir):
    return series.trend(_steps(spark, sf_dir), ["event_type"], ["event_id"], "value").select("event_id", "trend")


@query("interval_average", "SELECT event_type, CAST(floor((event_id - 1) / 50.0) AS BIGINT) AS interval, round(avg(value), 6) AS mean, count(*) AS steps FROM events GROUP BY ALL")
def interval_average(spark, sf_dir):
    return progress.interval_average(_steps(spark, sf_dir), "event_id", "value", 50, ["event_type"])


@query("event_windows", "SELECT event_type, time_bucket(INTERVAL 1 hour, ts) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_windows(spark, sf_dir):
    rows = table(spark, sf_dir, "events").groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return rows.select("event_type", F.col("w.start").cast("timestamp_ntz").alias("start"), "n", "total")


@query("stream_counters", "SELECT source, count(*) AS items, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents GROUP BY source")
def stream_counters(spark, sf_dir):
    from textmill.streaming import streams

    return streams.counters(documents(spark, sf_dir), "source", F.octet_length("text"))


SQL_CAPACITY = "CASE WHEN n >= 32 THEN {} WHEN n >= 16 THEN {} WHEN n >= 8 THEN {} ELSE {} END"


@query("capacity_plan", f"""SELECT n AS memory_gb, {SQL_CAPACITY.format(10000, 7500, 5000, 2000)} AS recommended_batch_size, CAST(least(8, {SQL_CAPACITY.format(12, 8, 6, 4)}) AS INTEGER) AS recommended_workers,
  {SQL_CAPACITY.format(500, 250, 100, 50)} AS chunk_size_mb, n * 10 < 200 AS disk_warning, round(least(150.0, n * 10 * CAST(0.7 AS DOUBLE)), 6) AS estimated_max_dataset_gb, true AS parallel_source_processing FROM range(1, 65) t(n)""")
def capacity_plan(spark, sf_dir):
    n = F.col("memory_gb")
    plan = planner.capacity(n, F.lit(8), n * 10)
    plan["estimated_max_dataset_gb"] = F.round(plan["estimated_max_dataset_gb"], 6)
    return spark.range(1, 65).select(F.col("id").alias("memory_gb")).select("memory_gb", *[c.alias(k) for k, c in plan.items()])


def _sql_training(gpus: int, batch: int, rate: float) -> str:
    e = batch * 4 * gpus
    return f"""SELECT {gpus} AS gpus, t AS tokens, {e} AS effective_batch_size, {e * 1024} AS tokens_per_step, CAST(k AS BIGINT) AS recommended_steps, CAST(greatest(100, floor(k / 15)) AS BIGINT) AS save_steps,
  CAST(greatest(10, floor(k / 100)) AS BIGINT) AS logging_steps, round(k / CAST({rate} AS DOUBLE) / 3600, 6) AS hours, round(k * {e * 1024} / t, 6) AS data_utilization
FROM (SELECT t, floor(s / greatest(100, floor(s / 20))) * greatest(100, floor(s / 20)) AS k FROM (SELECT t, floor(floor(t / {e * 1024}) * 2.5) AS s FROM (SELECT n_chars * 1000000 AS t FROM documents)))"""


@query("training_recommendations", " UNION ALL ".join(_sql_training(g, b, r) for g, b, r in ((1, 4, 2.5), (2, 4, 5.0), (4, 6, 8.0), (8, 6, 16.0))))
def training_recommendations(spark, sf_dir):
    tokens = documents(spark, sf_dir).select((F.col("n_chars") * 1_000_000).alias("tokens"))  # made-up token totals to plan for
    out = None
    for gpus in (1, 2, 4, 8):
        part = tokens.select(F.lit(gpus).alias("gpus"), "tokens", *[c.alias(k) for k, c in planner.training(F.col("tokens"), gpus).items()])
        out = part if out is None else out.union(part)
    return out


@query("param_count", "SELECT CAST(l AS BIGINT) AS layers, CAST(2 * 50257 * 2048 + 1024 * 2048 + l * (4 * 2048 * 2048 + 2 * 2048 * 8192 + 4 * 2048) AS BIGINT) AS parameters, CAST(16 * (2048 + 8192) AS BIGINT) AS low_rank FROM range(1, 49) t(l)")
def param_count(spark, sf_dir):
    long = lambda x: F.lit(x).cast("long")
    total = planner.parameters(long(50257), long(2048), long(1024), long(8192), F.col("id"))
    return spark.range(1, 49).select(F.col("id").alias("layers"), total.alias("parameters"), planner.low_rank_parameters(long(16), long(2048), long(8192)).alias("low_rank"))


@query("token_totals", "SELECT source, count(*) AS sequences, count(*) * 1024 AS estimated_tokens FROM documents GROUP BY source")
def token_totals(spark, sf_dir):
    return documents(spark, sf_dir).groupBy("source").agg(F.count(F.lit(1)).alias("sequences"), (F.count(F.lit(1)) * 1024).alias("estimated_tokens"))


@query("compression", "SELECT lang, round(sum(n_chars) / sum(len(" + sql_words("text") + ")), 6) AS chars_per_token, count(*) AS texts FROM documents GROUP BY lang")
def compression(spark, sf_dir):
    return documents(spark, sf_dir).groupBy("lang").agg(F.round(F.sum("n_chars") / F.sum(T.word_count(F.col("text"))), 6).alias("chars_per_token"), F.count(F.lit(1)).alias("texts"))


@query("file_inventory")
def file_inventory(spark, sf_dir):
    return progress.inventory_by_extension(progress.inventory(spark, sf_dir, "*.parquet"))


# Reports ------------------------------------------------------------------------------------------

SQL_FILES = "files AS (SELECT source || CASE WHEN doc_id % 2 = 0 THEN '_comments' ELSE '_submissions' END || '.zst' AS name, n_chars AS size, CASE WHEN doc_id % 11 > 0 THEN n_chars // 100 END AS sequences FROM documents)"


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A made-up list of dump files: one for each document."""
    kind = F.when(F.col("doc_id") % 2 == 0, "_comments.zst").otherwise("_submissions.zst")
    return documents(spark, sf_dir).select(F.concat("source", kind).alias("name"), F.col("n_chars").alias("size"), F.when(F.col("doc_id") % 11 > 0, F.expr("n_chars div 100")).alias("sequences"))


@query("dump_inventory", f"WITH {SQL_FILES} SELECT regexp_replace(name, '_(comments|submissions)\\.zst$', '') AS subreddit, count(*) AS files, round(sum(size) / 1048576, 6) AS mb, CAST(floor(sum(size) / 500) AS BIGINT) AS estimated_records, max(contains(name, '_comments')) AS has_comments, max(contains(name, '_submissions')) AS has_submissions FROM files GROUP BY 1")
def dump_inventory(spark, sf_dir):
    return reports.dump_inventory(_files(spark, sf_dir))


@query("record_estimate", "SELECT count(*) AS sampled, round(avg(strlen(text)), 6) AS mean_bytes, CAST(floor(1073741824 / avg(strlen(text))) AS BIGINT) AS estimated_records FROM (SELECT text FROM documents ORDER BY doc_id LIMIT 100)")
def record_estimate(spark, sf_dir):
    return reports.record_estimate(documents(spark, sf_dir).select("doc_id", "text"), F.lit(1073741824), "doc_id", "text")  # the first 100 lines are the feature


@query("json_share", "SELECT count(*) AS sampled, count(*) FILTER (json_valid(props)) AS parsed, count(*) FILTER (json_valid(props)) * 10 > count(*) * 8 AS json_lines FROM (SELECT props FROM events ORDER BY event_id LIMIT 10)")
def json_share(spark, sf_dir):
    return reports.json_share(table(spark, sf_dir, "events").select("event_id", "props"), "props", "event_id")


@query("sequence_totals", f"WITH {SQL_FILES}, t AS (SELECT count(sequences) AS valid, count(*) - count(sequences) AS failed, CAST(coalesce(sum(sequences), 0) AS BIGINT) AS sequences FROM files) SELECT valid, failed, sequences, sequences // valid AS per_file, sequences * 256 AS estimated_tokens, CASE WHEN valid >= 700 THEN 'ready' WHEN valid >= 500 THEN 'nearly' ELSE 'not ready' END AS readiness FROM t")
def sequence_totals(spark, sf_dir):
    return reports.sequence_totals(_files(spark, sf_dir))


@query("token_extrapolation", f"WITH {SQL_FILES} SELECT round(avg(sequences), 6) AS avg_tokens_per_file, round(avg(CASE WHEN sequences IS NULL THEN 1.0 ELSE 0.0 END), 6) AS corruption_rate, round(avg(sequences) * 5000 * (1 - avg(CASE WHEN sequences IS NULL THEN 1.0 ELSE 0.0 END)), 2) AS total_tokens FROM files")
def token_extrapolation(spark, sf_dir):
    return reports.token_extrapolation(_files(spark, sf_dir), 5000, "sequences")


@query("operation_times", "SELECT event_type, round(avg(value), 6) AS avg, max(value) AS max, min(value) AS min, count(*) AS calls FROM events GROUP BY event_type")
def operation_times(spark, sf_dir):
    return reports.operation_times(table(spark, sf_dir, "events").select("event_type", "value"), "event_type", "value")


@query("metric_means", "SELECT round(avg(quality), 6) AS quality, round(avg(nullif(toxic, 0)), 6) AS toxic FROM labels")
def metric_means(spark, sf_dir):
    return reports.mean_of_present(table(spark, sf_dir, "labels").select("quality", F.nullif("toxic", F.lit(0)).alias("toxic")), ["quality", "toxic"])


@query("newest_checkpoints", "SELECT event_id AS step, value AS loss FROM events ORDER BY event_id DESC LIMIT 5")
def newest_checkpoints(spark, sf_dir):
    return reports.keep_newest(table(spark, sf_dir, "events").select(F.col("event_id").alias("step"), F.col("value").alias("loss")), 5)


@query("vocabulary_coverage", f"WITH x AS (SELECT lang, unnest({sql_words('text')}) AS w FROM documents), v AS (SELECT DISTINCT w FROM x WHERE lang = 'en'), c AS (SELECT w, count(*) AS n FROM x GROUP BY w) SELECT round(sum(CASE WHEN v.w IS NULL THEN 0 ELSE n END) / sum(n), 6) AS token_coverage, round(avg(CASE WHEN v.w IS NULL THEN 0.0 ELSE 1.0 END), 6) AS type_coverage FROM c LEFT JOIN v ON c.w = v.w")
def vocabulary_coverage(spark, sf_dir):
    tokens = documents(spark, sf_dir).select("lang", F.explode(T.words(F.col("text"))).alias("w"))
    return reports.vocabulary_coverage(tokens, tokens.where("lang = 'en'"), "w")


@query("quality_tiers", f"WITH {SQL_POSTS} SELECT CASE WHEN score >= 50 THEN 'high' WHEN score >= 10 THEN 'medium' WHEN score >= 1 THEN 'basic' ELSE 'none' END AS tier, count(*) AS posts FROM posts GROUP BY 1")
def quality_tiers(spark, sf_dir):
    return pipelines.corpus(spark, sf_dir).groupBy(reports.tier(F.col("score")).alias("tier")).agg(F.count(F.lit(1)).alias("posts"))


@query("seeded_shuffle", "SELECT doc_id, md5(CAST(doc_id AS VARCHAR) || '-42') AS place FROM documents")
def seeded_shuffle(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", F.md5(F.concat(F.col("doc_id").cast("string"), F.lit("-42")).cast("binary")).alias("place"))
    return rows.repartitionByRange("place").sortWithinPartitions("place")


@query("lora_parameters", "SELECT CAST(r AS BIGINT) AS rank, CAST(r * (2048 + 8192) AS BIGINT) AS parameters FROM range(1, 65) t(r)")
def lora_parameters(spark, sf_dir):
    return spark.range(1, 65).select(F.col("id").alias("rank"), planner.low_rank_parameters(F.col("id"), F.lit(2048).cast("long"), F.lit(8192).cast("long")).alias("parameters"))


@query("cleaning_plan", "SELECT n AS records, CASE WHEN n > 1000000 THEN 5000 WHEN n > 500000 THEN 3000 ELSE 2000 END AS batch_size, CAST(CASE WHEN n > 1000000 THEN greatest(2, least(8, n // 100000)) WHEN n > 500000 THEN 4 ELSE 2 END AS BIGINT) AS n_workers FROM (SELECT n_chars * 1000 AS n FROM documents)")
def cleaning_plan(spark, sf_dir):
    n = F.col("records")
    plan = planner.cleaning(n)
    return documents(spark, sf_dir).select((F.col("n_chars") * 1000).alias("records")).select("records", plan["batch_size"].alias("batch_size"), plan["n_workers"].cast("long").alias("n_workers"))


@query("local_training_plan", """SELECT t AS tokens, CAST(e AS DOUBLE) AS target_epochs, CAST(k AS BIGINT) AS recommended_steps, CAST(greatest(100, floor(k / 15)) AS BIGINT) AS save_steps, CAST(greatest(10, floor(k / 100)) AS BIGINT) AS logging_steps, round(k / 5.0 / 3600, 6) AS hours
FROM (SELECT t, e, floor(s / greatest(100, floor(s / 20))) * greatest(100, floor(s / 20)) AS k FROM (SELECT t, e, least(floor(floor(t / 32768) * e), 50000) AS s FROM (SELECT t, CASE WHEN t > 10000000000 THEN 0.5 WHEN t > 1000000000 THEN 1.0 ELSE 2.5 END AS e FROM (SELECT n_chars * 1000000 AS t FROM documents))))""")
def local_training_plan(spark, sf_dir):
    tokens = documents(spark, sf_dir).select((F.col("n_chars") * 1_000_000).alias("tokens"))
    plan = planner.local_training(F.col("tokens"))
    plan["target_epochs"] = plan["target_epochs"].cast("double")
    return tokens.select("tokens", *[c.alias(k) for k, c in plan.items()])


from textmill import intake_queries, report_queries, training_queries  # noqa: E402, F401  (add their queries)
