"""Queries of tokenizer artifacts and of the longer reports, each with its DuckDB twin where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.functions import bpe
from textmill.functions import text as T
from textmill.operators import artifacts, cleaning, reports, sequences, series, tuning
from textmill.plans import pipelines, planner
from textmill.queries import (
    SQL_GRAMS, SQL_IDS, SQL_PAIR_WORDS, SQL_PAIRS, SQL_POSTS, SQL_TRAINING, SQL_W, VOCABULARY, _sql_describe, _sql_split, documents, pair_words, query, sql_words, table, turn_pairs, word_ids,
)

# Tokens ------------------------------------------------------------------------------------------


@query("encoded_windows")
def encoded_windows(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = artifacts.encoded_windows(docs, "text", bpe.train(docs, "text", VOCABULARY), ["doc_id"])
    return out.select("doc_id", "window", "start", F.size("input_ids").alias("length"), F.aggregate("input_ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("id_sum"))


@query("token_id_repair", f"""WITH {SQL_IDS}
SELECT doc_id, len(list_filter(ids, lambda x: x >= 12)) AS repaired, CAST(coalesce(list_sum(list_transform(ids, lambda x: CASE WHEN x >= 12 THEN 3 ELSE x END)), 0) AS BIGINT) AS id_sum FROM ids""")
def token_id_repair(spark, sf_dir):
    rows = word_ids(spark, sf_dir).select("doc_id", "ids", artifacts.repaired(F.col("ids"), 12, bpe.SPECIAL.index("<unk>")).alias("fixed"))
    changed = F.size(F.filter("ids", lambda x: (x < 0) | (x >= 12))).alias("repaired")
    return rows.select("doc_id", changed, F.aggregate("fixed", F.lit(0).cast("long"), lambda a, x: a + x).alias("id_sum"))


@query("token_variety", f"WITH {SQL_IDS}, t AS (SELECT unnest(ids) AS id FROM ids) SELECT count(*) AS total_tokens, count(DISTINCT id) AS unique_tokens, round(count(DISTINCT id) / count(*), 6) AS token_diversity FROM t")
def token_variety(spark, sf_dir):
    return artifacts.token_variety(word_ids(spark, sf_dir), "ids")


# Reports -----------------------------------------------------------------------------------------


@query("training_scores", f"WITH {SQL_POSTS}, {SQL_TRAINING} SELECT {_sql_describe('score', 'stddev_samp')} FROM rows_")
def training_scores(spark, sf_dir):
    return pipelines.training_rows(pipelines.corpus(spark, sf_dir)).agg(*cleaning.describe("score", sample=True))


@query("training_top_subreddits", f"WITH {SQL_POSTS}, {SQL_TRAINING} SELECT subreddit, count(*) AS n FROM rows_ GROUP BY subreddit ORDER BY n DESC, subreddit LIMIT 10")
def training_top_subreddits(spark, sf_dir):
    rows = pipelines.training_rows(pipelines.corpus(spark, sf_dir))
    return rows.groupBy("subreddit").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "subreddit").limit(10)  # the top ten are the feature


@query("source_type_split", _sql_split("documents", "doc_id", "lang", 0.7, 0.15, 10, ("train", "validation", "test")))
def source_type_split(spark, sf_dir):
    return cleaning.split(documents(spark, sf_dir).select("doc_id", "lang"), "doc_id", F.col("lang")).select("doc_id", "split")


@query("loss_slope", f"SELECT event_id, round(coalesce(covar_pop(event_id, value) {SQL_W.format(99)} / nullif(var_pop(event_id) {SQL_W.format(99)}, 0), 0), 6) AS slope_100 FROM events")
def loss_slope(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    out = series.rolling(rows, ["event_type"], ["event_id"], 100, lambda w: {"slope": series.slope("value", "event_id", w)})
    return out.select("event_id", F.round("slope", 6).alias("slope_100"))


@query("json_estimate", "SELECT count(*) AS sampled, count(*) FILTER (json_valid(props)) AS parsed, count(*) FILTER (json_valid(props)) * 10 > count(*) * 8 AS json_lines, CAST(floor(count(*) FILTER (json_valid(props)) / count(*) * 2.5 * 1000000) AS BIGINT) AS estimated_records FROM (SELECT props FROM events ORDER BY event_id LIMIT 10)")
def json_estimate(spark, sf_dir):
    share = reports.json_share(table(spark, sf_dir, "events").select("event_id", "props"), "props", "event_id")  # the first ten lines are the feature
    return share.withColumn("estimated_records", F.floor(F.try_divide("parsed", "sampled") * 2.5 * 1_000_000))


@query("processing_plan", "SELECT doc_id, n_chars * 10000 > 10000000 AS staged, round(n_chars * 10000 / (2000.0 * 4), 6) AS hours, CAST(n_chars * 3 AS DOUBLE) AS disk_gb FROM documents")
def processing_plan(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", (F.col("n_chars") * 10_000).alias("records"), F.col("n_chars").cast("double").alias("gb"))  # made-up sizes to plan for
    plan = planner.processing(F.col("records"), F.col("gb"), F.lit(4))
    return rows.select("doc_id", plan["staged"].alias("staged"), F.round(plan["hours"], 6).alias("hours"), plan["disk_gb"].alias("disk_gb"))


# Fine-tuning -------------------------------------------------------------------------------------


@query("sft_code_prepared", f"""WITH {SQL_PAIRS}
SELECT conv_id, turn, CASE WHEN turn % 4 = 0 THEN '# Task: ' || prompt || chr(10) || chr(10) || response WHEN turn % 4 = 2 THEN '# Problem:' || chr(10) || prompt || chr(10) || chr(10) || '# Solution:' || chr(10) || response
  ELSE response END AS text FROM pairs WHERE conv_id % 5 <> 0 OR turn % 2 = 0""")
def sft_code_prepared(spark, sf_dir):
    kind = F.col("turn") % 4
    given = lambda name, at: F.when(kind == at, F.col(name))
    source = F.when((kind % 2 == 1) & (F.col("conv_id") % 5 != 0), F.col("response"))
    made = tuning.code_prepared(given("prompt", 0), given("response", 0), given("prompt", 2), given("response", 2), source)
    return turn_pairs(spark, sf_dir).select("conv_id", "turn", made.alias("text")).where("text IS NOT NULL")


_SQL_BLEU = lambda n: f"avg(CASE WHEN len(g) >= {n} AND len(r) >= {n} THEN len(list_filter({SQL_GRAMS('g', n)}, lambda y: list_contains({SQL_GRAMS('r', n)}, y))) / (len(g) - {n - 1}) * least(1.0, len(g) / len(r)) ELSE 0.0 END)"


@query("generation_quality", f"""WITH {SQL_PAIR_WORDS}, t AS (SELECT unnest(g) AS w FROM pw), v AS (SELECT count(*) AS total_tokens, count(DISTINCT w) AS unique_tokens FROM t)
SELECT (SELECT unique_tokens FROM v) AS unique_tokens, (SELECT round(unique_tokens / total_tokens, 6) FROM v) AS token_diversity, round({_SQL_BLEU(1)}, 6) AS bleu_1, round({_SQL_BLEU(2)}, 6) AS bleu_2 FROM pw""")
def generation_quality(spark, sf_dir):
    pairs = pair_words(spark, sf_dir)
    variety = artifacts.token_variety(pairs, "g").select("unique_tokens", "token_diversity")
    bleu = [F.round(F.avg(tuning.simple_bleu(F.col("g"), F.col("r"), n)), 6).alias(f"bleu_{n}") for n in (1, 2)]
    return pairs.agg(*bleu).crossJoin(F.broadcast(variety))  # one row each


@query("operation_rates", "SELECT lang, round(avg(n_chars / 1000.0), 6) AS avg, max(n_chars / 1000.0) AS max, min(n_chars / 1000.0) AS min, count(*) AS calls, round(sum(strlen(text) / 1048576), 6) AS total_mb, round(avg(strlen(text) / 1048576 / nullif(n_chars / 1000.0, 0)), 6) AS mb_per_second FROM documents GROUP BY lang")
def operation_rates(spark, sf_dir):
    """A text of 1,000 characters takes one second."""
    log = documents(spark, sf_dir).select("lang", (F.col("n_chars") / F.lit(1000.0)).alias("seconds"), F.octet_length("text").alias("bytes"))
    return reports.operation_rates(log, "lang", "seconds", "bytes")


@query("training_counts", f"""WITH c AS (SELECT conv_id, count(*) - 1 AS comments, max(CASE WHEN turn = 0 THEN len({sql_words("coalesce(text, '')")}) END) AS words, max(length(text)) AS score FROM conversations GROUP BY conv_id)
SELECT count(*) AS total, count(*) FILTER (words > 20) AS over_20_words, count(*) FILTER (score > 10) AS over_score_10, count(*) FILTER (comments > 5) AS over_5_comments FROM c""")
def training_counts(spark, sf_dir):
    """A conversation's first turn is the post, the others are its comments; the longest turn stands for the score."""
    words = F.when(F.col("turn") == 0, F.size(T.words(F.coalesce("text", F.lit("")))))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg((F.count(F.lit(1)) - 1).alias("comments"), F.max(words).alias("words"), F.max(F.length("text")).alias("score"))
    return reports.training_counts(rows, "words", "score", "comments")


@query("window_integrity", f"""WITH {SQL_IDS}, w AS (SELECT doc_id, ids, unnest(range(0, CAST(1 + greatest(ceil((len(ids) - 1024) / 512.0), 0) AS BIGINT))) AS w FROM ids), x AS (SELECT ids[w * 512 + 1 : w * 512 + 1024] AS i FROM w)
SELECT count(*) AS windows, count(*) FILTER (len(i) > 1024) AS too_long, 0 AS mask_mismatch, count(*) FILTER (len(list_filter(i, lambda x: x < 0 OR x >= 12)) > 0) AS out_of_vocabulary, count(*) FILTER (len(i) = 0) AS empty FROM x""")
def window_integrity(spark, sf_dir):
    """Shapes, masks and ids of all windows; ids are held against a small vocabulary, so that some are outside."""
    windows = sequences.token_windows(word_ids(spark, sf_dir), "ids")
    return sequences.verify_windows(windows.withColumn("attention_mask", sequences.mask(F.col("input_ids"), F.size("input_ids"))), 12, sequences.WINDOW)
