"""Queries of intake, reports over files and runs, and pooled metrics, each with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmill.functions import text as T
from textmill.operators import intake, reports, series, tuning
from textmill.plans import pipelines, planner
from textmill.queries import SQL_CLEANED, SQL_ITEMS, SQL_KEPT_ITEMS, SQL_POSTS, documents, query, sql_strip, sql_words, table

# Intake ------------------------------------------------------------------------------------------

SQL_RAW = "raw AS (SELECT CASE WHEN doc_id % 3 > 0 THEN 'p' || doc_id END AS id, CASE WHEN doc_id % 2 = 0 THEN source END AS title, CASE WHEN doc_id % 5 > 0 THEN text END AS selftext, text, doc_id AS line, source AS subreddit FROM documents)"


def _raw(spark, sf_dir):
    every = lambda n, value, keep: F.when(F.col("doc_id") % n == 0 if keep else F.col("doc_id") % n > 0, value)
    return documents(spark, sf_dir).select(
        every(3, F.concat(F.lit("p"), "doc_id"), False).alias("id"), every(2, F.col("source"), True).alias("title"), every(5, F.col("text"), False).alias("selftext"),
        "text", F.col("doc_id").alias("line"), F.col("source").alias("subreddit"),
    )


@query("post_records", f"WITH {SQL_RAW}, u AS (SELECT coalesce(id, 'reddit_' || line) AS id, {sql_strip("coalesce(title, '') || ' ' || coalesce(selftext, '')")} AS text, subreddit FROM raw) SELECT id, text, subreddit, 'reddit' AS source FROM u WHERE text <> ''")
def post_records(spark, sf_dir):
    return intake.post_records(_raw(spark, sf_dir), "line").select("id", "text", "subreddit", "source")


@query("web_records", f"SELECT 'hf_' || doc_id AS id, text, 'huggingface_openwebtext' AS source, 'openwebtext' AS source_dataset FROM documents WHERE {sql_strip('text')} <> ''")
def web_records(spark, sf_dir):
    return intake.web_records(documents(spark, sf_dir), "doc_id", "openwebtext")


@query("chunk_records", f"""WITH {SQL_RAW}, f AS (SELECT *, line % 4 = 0 AND line % 8 > 0 AS web FROM raw)
SELECT line, CASE WHEN web THEN 'openwebtext' ELSE subreddit END AS subreddit, CASE WHEN web THEN coalesce(id, 'hf_' || line) ELSE coalesce(id, '') END AS id, CASE WHEN web THEN '' ELSE coalesce(title, '') END AS title,
  length(text) AS length, CASE WHEN web THEN 1 ELSE 0 END AS score, CASE WHEN web THEN 'openwebtext' ELSE '[deleted]' END AS author, CASE WHEN web THEN 'article' ELSE 'unknown' END AS type FROM f""")
def chunk_records(spark, sf_dir):
    """A name in another spelling is no web file's."""
    name = F.concat(F.when(F.col("line") % 8 == 0, "HuggingFace_").when(F.col("line") % 4 == 0, "huggingface_").otherwise("reddit_"), F.col("line"), F.lit(".jsonl"))
    raw = _raw(spark, sf_dir)
    # The line is carried through the id's place, which every record has.
    out = intake.chunk_records(raw.withColumn("text", F.concat(F.col("line"), F.lit("\0"), F.col("text"))), name, "line")
    return out.select(F.split_part("text", F.lit("\0"), F.lit(1)).cast("long").alias("line"), "subreddit", "id", "title", (F.length("text") - F.instr("text", "\0")).alias("length"), "score", "author", "type")


SQL_KINDS = "CASE doc_id % 5 WHEN 0 THEN 'wikipedia' WHEN 1 THEN 'reddit' WHEN 2 THEN 'legacy' WHEN 3 THEN 'legacy' ELSE 'elsewhere' END"


@query("normalized_kinds", f"""WITH k AS (SELECT doc_id, text, {SQL_KINDS} AS kind FROM documents)
SELECT CASE WHEN kind = 'wikipedia' THEN 'wiki_' || left(md5('t' || doc_id), 11) ELSE CAST(doc_id AS VARCHAR) END AS id, CASE WHEN kind = 'legacy' AND doc_id % 5 = 2 THEN 'reddit' ELSE kind END AS source_type, len({sql_words('text')}) AS word_count, length(text) AS content_length
FROM k WHERE kind <> 'elsewhere'""")
def normalized_kinds(spark, sf_dir):
    turn = F.col("doc_id") % 5
    kind = F.when(turn == 0, "wikipedia").when(turn == 1, "reddit").when(turn.isin(2, 3), "legacy").otherwise("elsewhere")
    none = F.lit(None).cast("string")
    raw = documents(spark, sf_dir).select(
        F.col("doc_id").alias("id"), F.concat(F.lit("t"), "doc_id").alias("title"), "text", F.when(turn == 0, F.col("text")).otherwise(none).alias("content"), none.alias("summary"), none.alias("category"),
        F.when(turn.isin(1, 2), F.col("text")).alias("selftext"), F.when(turn == 1, F.col("source")).alias("subreddit"), F.lit("3").alias("score"), F.lit("1").alias("num_comments"), kind.alias("source_type"),
    )
    return intake.normalized(raw).select("id", "source_type", "word_count", "content_length")


@query("tokenize_filters", f"""SELECT doc_id, length({sql_strip('text')}) >= 10 AS usual, length({sql_strip('text')}) >= 20 AS strict, source <> '' OR text <> '' AS content,
  CASE WHEN length({sql_strip('text')}) > 10 AND len({sql_words('text')}) > 5 THEN least(512, len({sql_words('text')})) ELSE 0 END AS short_ids FROM documents""")
def tokenize_filters(spark, sf_dir):
    text = F.col("text")
    ids = intake.short_form(text, F.transform(T.words(text), lambda w: F.length(w)))
    return documents(spark, sf_dir).select("doc_id", intake.tokenizable(text).alias("usual"), intake.tokenizable(text, intake.STRICT).alias("strict"), intake.has_content(text, F.col("source")).alias("content"), F.when(ids.isNotNull(), F.size(ids)).otherwise(0).alias("short_ids"))


@query("long_articles", "SELECT doc_id FROM documents WHERE length(text) >= 1000")
def long_articles(spark, sf_dir):
    return intake.long_articles(documents(spark, sf_dir), "text").select("doc_id")


@query("long_posts", f"WITH {SQL_RAW} SELECT line FROM raw WHERE length(coalesce(nullif(selftext, ''), title, '')) >= 50")
def long_posts(spark, sf_dir):
    return intake.long_posts(_raw(spark, sf_dir), "title", "selftext").select("line")


@query("kept_comments", "WITH r AS (SELECT conv_id, length(text) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place FROM conversations) SELECT conv_id, count(*) FILTER (place <= 10 AND n > 20) AS kept, CAST(coalesce(sum(n) FILTER (place <= 10 AND n > 20), 0) AS BIGINT) AS chars FROM r GROUP BY conv_id")
def kept_comments(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("body")))).alias("comments"))
    kept = intake.kept_comments(F.col("comments"))
    return rows.select("conv_id", F.size(kept).cast("long").alias("kept"), F.aggregate(kept, F.lit(0).cast("long"), lambda a, c: a + F.length(c["body"])).alias("chars"))


@query("tokenizer_texts", f"SELECT doc_id, {sql_strip('text')} AS text FROM documents WHERE {sql_strip('text')} <> ''")
def tokenizer_texts(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.strip(F.col("text")).alias("text")).where("text <> ''")


@query("tokenizer_sample", f"""WITH f AS (SELECT DISTINCT source FROM documents ORDER BY source LIMIT 5), r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS place FROM documents WHERE {sql_strip('text')} <> '')
SELECT doc_id, source AS file, CAST(place AS INTEGER) AS place FROM r JOIN f USING (source) WHERE place <= 20""")
def tokenizer_sample(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", F.col("source").alias("file"), F.col("doc_id").alias("line"), "text")
    return intake.sample_of_files(rows, 5, 20).select("doc_id", "file", "place")


@query("load_order", "WITH f AS (SELECT source, row_number() OVER (ORDER BY sum(n_chars) DESC, source) AS file_rank FROM documents GROUP BY source) SELECT doc_id, source AS file, CAST(file_rank AS INTEGER) AS file_rank FROM documents JOIN f USING (source)")
def load_order(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", F.col("source").alias("file"), "n_chars")
    return intake.load_order(rows.select("doc_id", "file"), rows.groupBy("file").agg(F.sum("n_chars").alias("size")))


# Files and reports -------------------------------------------------------------------------------

SQL_FILES = "files AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'tokenized_' WHEN 1 THEN 'cleaned_' ELSE 'Processed_' END || source || '_' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '.npz' ELSE '.jsonl' END AS name, n_chars AS size, source FROM documents)"


def _files(spark, sf_dir):
    turn = F.col("doc_id") % 3
    name = F.concat(F.when(turn == 0, "tokenized_").when(turn == 1, "cleaned_").otherwise("Processed_"), "source", F.lit("_"), "doc_id", F.when(F.col("doc_id") % 2 == 0, ".npz").otherwise(".jsonl"))
    return documents(spark, sf_dir).select("doc_id", name.alias("name"), F.col("n_chars").alias("size"), "source")


@query("file_flags", f"WITH {SQL_FILES} SELECT name, contains(lower(name), 'tokenized') AS tokenized, contains(lower(name), 'cleaned') AS cleaned, contains(lower(name), 'processed') AS processed, size / 1048576.0 < 0.001 AS failed, left(md5(name), 12) AS cache_key FROM files")
def file_flags(spark, sf_dir):
    flags = intake.file_flags(F.col("name"), F.col("size") / 1048576.0)
    return _files(spark, sf_dir).select("name", *[c.alias(k) for k, c in flags.items()], intake.cache_key(F.col("name")).alias("cache_key"))


@query("bucket_overview", f"WITH {SQL_FILES} SELECT regexp_extract(name, '\\.([^.]+)$', 1) AS ext, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes, count(*) FILTER (contains(name, 'tokenized')) AS tokenized, count(*) FILTER (contains(name, 'tokenized')) * 50000 AS estimated_tokens FROM files GROUP BY 1")
def bucket_overview(spark, sf_dir):
    tokenized = F.count_if(F.col("name").contains("tokenized"))
    return _files(spark, sf_dir).groupBy(F.regexp_extract("name", r"\.([^.]+)$", 1).alias("ext")).agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), tokenized.alias("tokenized"), (tokenized * 50_000).alias("estimated_tokens"))


@query("file_orders", f"WITH {SQL_FILES} SELECT name, CAST(row_number() OVER (PARTITION BY source ORDER BY name) AS INTEGER) AS by_name, CAST(row_number() OVER (PARTITION BY source ORDER BY size DESC, name) AS INTEGER) AS by_size FROM files")
def file_orders(spark, sf_dir):
    place = lambda *by: F.row_number().over(Window.partitionBy("source").orderBy(*by))
    return _files(spark, sf_dir).select("name", place("name").alias("by_name"), place(F.desc("size"), "name").alias("by_size"))


@query("first_ten_names", f"WITH {SQL_FILES} SELECT name, size FROM files ORDER BY name LIMIT 10")
def first_ten_names(spark, sf_dir):
    return _files(spark, sf_dir).select("name", "size").orderBy("name").limit(10)


@query("emergency_resume", f"WITH {SQL_FILES}, last AS (SELECT name FROM files WHERE doc_id = 31) SELECT name FROM files WHERE name > (SELECT name FROM last) AND doc_id % 7 > 0 UNION ALL SELECT name FROM files WHERE name > 'cleaned_z' AND 'cleaned_z' IN (SELECT name FROM files)")
def emergency_resume(spark, sf_dir):
    """After a file that is there, and after one that is not, which gives none."""
    files = _files(spark, sf_dir)
    last = files.where("doc_id = 31").select("name").first()["name"]
    return intake.resume_after(files, last, files.where("doc_id % 7 = 0")).select("name").unionAll(intake.resume_after(files, "cleaned_z", files.where("false")).select("name"))


@query("split_line_counts", "SELECT source, CAST(sum(len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> ''))) AS BIGINT) AS lines FROM documents GROUP BY source")
def split_line_counts(spark, sf_dir):
    lines = F.size(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""))
    return documents(spark, sf_dir).groupBy("source").agg(F.sum(lines).alias("lines"))


SQL_DUMP_NAMES = "n AS (SELECT DISTINCT CASE doc_id % 4 WHEN 0 THEN 'cleaned_' WHEN 1 THEN 'tokenized_cleaned_' WHEN 2 THEN 'comments' ELSE 'x_y_' END || source || CASE WHEN doc_id % 3 = 0 THEN '_comments.npz' ELSE '_submissions_part001.npz' END AS name FROM documents)"


@query("collection_info", f"WITH {SQL_DUMP_NAMES} SELECT count(*) AS files, count(*) FILTER (contains(name, 'comments')) AS comment_files, count(*) FILTER (contains(name, 'submissions')) AS submission_files, count(DISTINCT string_split(name, '_')[3]) FILTER (len(string_split(name, '_')) >= 3) AS subreddits FROM n")
def collection_info(spark, sf_dir):
    start = F.when(F.col("doc_id") % 4 == 0, "cleaned_").when(F.col("doc_id") % 4 == 1, "tokenized_cleaned_").when(F.col("doc_id") % 4 == 2, "comments").otherwise("x_y_")
    name = F.concat(start, "source", F.when(F.col("doc_id") % 3 == 0, "_comments.npz").otherwise("_submissions_part001.npz"))
    return reports.collection_info(documents(spark, sf_dir).select(name.alias("name")).distinct())


@query("cleaning_report", f"WITH {SQL_CLEANED}, c AS (SELECT (SELECT count(*) FROM posts) AS processed, (SELECT count(*) FROM reasons WHERE quality_reason = 'high_quality') AS kept, (SELECT sum(length(selftext)) FROM reasons WHERE quality_reason = 'high_quality') AS size) SELECT processed, kept, round(100.0 * kept / processed, 6) AS kept_percent, round(processed / 3600.0, 6) AS posts_per_second, round(size / 1073741824.0, 9) AS output_gb, CAST(kept AS DOUBLE) AS kept_per_hour FROM c")
def cleaning_report(spark, sf_dir):
    """Of a run of one hour."""
    posts = pipelines.corpus(spark, sf_dir)
    total = posts.agg(F.count(F.lit(1)).alias("processed"))
    kept = pipelines.clean_posts(posts).where(F.col("quality_reason") == "high_quality").agg(F.count(F.lit(1)).alias("kept"), F.sum(F.length("selftext")).alias("size"))
    rows = total.withColumn("one", F.lit(1)).join(kept.withColumn("one", F.lit(1)), "one")  # one row each
    return rows.select("processed", "kept", F.round(100.0 * F.col("kept") / F.col("processed"), 6).alias("kept_percent"), F.round(F.col("processed") / 3600.0, 6).alias("posts_per_second"), F.round(F.col("size") / 1073741824.0, 9).alias("output_gb"), F.col("kept").cast("double").alias("kept_per_hour"))


@query("kept_top_subreddits", f"WITH {SQL_CLEANED} SELECT subreddit, count(*) AS n FROM reasons WHERE quality_reason = 'high_quality' GROUP BY subreddit ORDER BY n DESC, subreddit LIMIT 20")
def kept_top_subreddits(spark, sf_dir):
    kept = pipelines.clean_posts(pipelines.corpus(spark, sf_dir)).where(F.col("quality_reason") == "high_quality")
    return kept.groupBy("subreddit").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "subreddit").limit(20)


@query("kept_by_source", f"WITH {SQL_POSTS}, {SQL_ITEMS}, {SQL_KEPT_ITEMS} SELECT subreddit, count(*) AS kept, round(avg(quality_score), 6) AS mean_score FROM kept GROUP BY subreddit")
def kept_by_source(spark, sf_dir):
    posts = pipelines.corpus(spark, sf_dir)
    kept = pipelines.multi_source(pipelines.items_from(posts), "doc_id").select("doc_id", "quality_score")
    return kept.join(posts.select("doc_id", "subreddit"), "doc_id").groupBy("subreddit").agg(F.count(F.lit(1)).alias("kept"), F.round(F.avg("quality_score"), 6).alias("mean_score"))


@query("top_subreddits_of_kind", "SELECT source, count(*) AS n FROM documents WHERE doc_id % 2 = 0 GROUP BY source ORDER BY n DESC, source LIMIT 20")
def top_subreddits_of_kind(spark, sf_dir):
    """The most frequent names of one kind of items only."""
    kind = F.when(F.col("doc_id") % 2 == 0, "reddit").otherwise("wikipedia")
    return documents(spark, sf_dir).where(kind == "reddit").groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "source").limit(20)


@query("web_size_estimate", "SELECT count(*) AS sampled, round(avg(length(text)), 6) AS avg_text_length, round(8000000 * avg(length(text)) / 1073741824, 6) AS estimated_gb FROM (SELECT text FROM documents ORDER BY doc_id LIMIT 10000)")
def web_size_estimate(spark, sf_dir):
    """From the first 10,000 texts, which is the estimate's rule."""
    mean = F.avg(F.length("text"))
    return documents(spark, sf_dir).orderBy("doc_id").limit(10_000).agg(F.count(F.lit(1)).alias("sampled"), F.round(mean, 6).alias("avg_text_length"), F.round(8_000_000 * mean / 1073741824, 6).alias("estimated_gb"))


@query("tokenization_progress", "WITH s AS (SELECT source, sum(1 + greatest(ceil((n_chars - 1024) / 512.0), 0)) AS w, count(*) AS files FROM documents GROUP BY source) SELECT source, files, CAST(w AS BIGINT) AS sequences, CAST(w * 1024 AS BIGINT) AS tokens, round(w / 600.0, 6) AS per_second, round(600.0 / files * 100, 6) AS seconds_left FROM s")
def tokenization_progress(spark, sf_dir):
    """After ten minutes, with a hundred files to go."""
    windows = 1 + F.greatest(F.ceil((F.col("n_chars") - 1024) / 512.0), F.lit(0))
    rows = documents(spark, sf_dir).groupBy("source").agg(F.count(F.lit(1)).alias("files"), F.sum(windows).cast("long").alias("sequences"))
    return rows.select("source", "files", "sequences", (F.col("sequences") * 1024).alias("tokens"), F.round(F.col("sequences") / 600.0, 6).alias("per_second"), F.round(F.lit(600.0) / F.col("files") * 100, 6).alias("seconds_left"))


@query("event_dates", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, CAST(floor(epoch(ts)) AS BIGINT) AS epoch, strftime(ts + INTERVAL 90 MINUTE, '%Y%m%d_%H%M%S') AS stamp FROM events")
def event_dates(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select("event_id", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("iso"), F.unix_timestamp(ts).alias("epoch"), F.date_format(ts + F.expr("INTERVAL 90 MINUTES"), "yyyyMMdd_HHmmss").alias("stamp"))


@query("steps_since_best", "WITH b AS (SELECT *, min(value) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS best FROM events), f AS (SELECT *, max(CASE WHEN value = best THEN event_id END) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS reached FROM b) SELECT event_id, event_id - reached AS since_best FROM f")
def steps_since_best(spark, sf_dir):
    """Steps since the best value was last reached."""
    rows = table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    return series.since_best(rows, ["event_type"], ["event_id"], "value", "event_id").select("event_id", "since_best")


@query("step_speed", "WITH r AS (SELECT event_id, row_number() OVER w AS n, avg(abs(value) + 1) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS t FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id)) SELECT event_id, CASE WHEN n > 10 THEN round(32 / t, 6) END AS samples_per_second FROM r")
def step_speed(spark, sf_dir):
    """Samples a second from the mean time of the last ten steps, from the eleventh step on; batches of 32."""
    rows = table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    out = series.rolling(rows, ["event_type"], ["event_id"], 10, lambda w: {"t": F.avg(F.abs("value") + 1).over(w)})
    return out.select("event_id", F.when(F.col("position") > 10, F.round(32 / F.col("t"), 6)).alias("samples_per_second"))


SQL_TOKENIZERS = f"SELECT 'words' AS tokenizer, len({sql_words('text')}) AS n, n_chars FROM documents UNION ALL SELECT 'characters', length(text), n_chars FROM documents UNION ALL SELECT 'lines', len(string_split(text, chr(10))), n_chars FROM documents"


@query("tokenizer_comparison", f"SELECT tokenizer, count(*) AS texts, CAST(sum(n) AS BIGINT) AS tokens, round(sum(n_chars) / sum(n), 6) AS chars_per_token, max(n) AS longest FROM ({SQL_TOKENIZERS}) GROUP BY tokenizer")
def tokenizer_comparison(spark, sf_dir):
    """Each text is cut by all tokenizers in its own row; no join of texts and tokenizers."""
    made = {"words": F.size(T.words(F.col("text"))), "characters": F.length("text"), "lines": F.size(F.split("text", "\n"))}
    rows = documents(spark, sf_dir).select("n_chars", F.explode(F.array(*[F.struct(F.lit(k).alias("tokenizer"), c.alias("n")) for k, c in made.items()])).alias("t"))
    n = F.col("t.n")
    return rows.groupBy("t.tokenizer").agg(F.count(F.lit(1)).alias("texts"), F.sum(n).alias("tokens"), F.round(F.sum("n_chars") / F.sum(n), 6).alias("chars_per_token"), F.max(n).alias("longest"))


# Pooled metrics ----------------------------------------------------------------------------------

SQL_USED = "u AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS place, quality AS p, toxic AS l FROM labels WHERE doc_id % 7 > 0), n AS (SELECT count(*) AS total_tokens, count(DISTINCT p) AS unique_tokens, count(DISTINCT l) AS labels, count(*) FILTER (p = l) AS same FROM u)"
SQL_BASE = "round(same / total_tokens, 6) AS accuracy, round(unique_tokens / total_tokens, 6) AS vocab_usage, unique_tokens, total_tokens, CASE WHEN total_tokens = 0 THEN CAST('inf' AS DOUBLE) END AS perplexity"


def _used(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("p"), F.when(F.col("doc_id") % 7 == 0, tuning.IGNORED).otherwise(F.col("toxic")).alias("l"))
    return tuning.used_pairs(rows, "doc_id", "p", "l", 1000)


@query("metrics_instruct", f"WITH {SQL_USED} SELECT {SQL_BASE}, round(total_tokens / greatest(labels, 1), 6) AS avg_response_length, round(same / total_tokens, 6) AS adherence_score FROM n")
def metrics_instruct(spark, sf_dir):
    return tuning.task_metrics(_used(spark, sf_dir), "instruct")


@query("metrics_chat", f"WITH {SQL_USED}, g AS (SELECT p AS a, lead(p) OVER (ORDER BY place) AS b, place FROM u), h AS (SELECT count(*) AS n, count(DISTINCT (a, b)) AS d FROM g WHERE place < (SELECT max(place) FROM u)) SELECT {SQL_BASE}, round(unique_tokens / total_tokens, 6) AS response_diversity, round(d / greatest(h.n, 1), 6) AS bigram_diversity FROM n, h")
def metrics_chat(spark, sf_dir):
    return tuning.task_metrics(_used(spark, sf_dir), "chat")


@query("metrics_code", f"WITH {SQL_USED}, g AS (SELECT [p, lead(p) OVER w, lead(p, 2) OVER w] AS a, [l, lead(l) OVER w, lead(l, 2) OVER w] AS b, place FROM u WINDOW w AS (ORDER BY place)), k AS (SELECT * FROM g WHERE place < (SELECT max(place) FROM u) - 1), h AS (SELECT (SELECT count(DISTINCT b) FROM k) AS own, (SELECT count(*) FROM (SELECT b FROM k INTERSECT SELECT a FROM k)) AS common) SELECT {SQL_BASE}, round(same / total_tokens, 6) AS exact_match_rate, round(CASE WHEN own > 0 THEN common / own ELSE 0 END, 6) AS pattern_consistency FROM n, h")
def metrics_code(spark, sf_dir):
    return tuning.task_metrics(_used(spark, sf_dir), "code")


@query("metrics_formatted", f"WITH {SQL_USED}, m AS (SELECT same / total_tokens AS a, * FROM n) SELECT 'accuracy' AS name, 'eval_accuracy: ' || printf('%.4f', a) AS line FROM m UNION ALL SELECT 'vocab_usage', 'eval_vocab_usage: ' || printf('%.4f', unique_tokens / total_tokens) FROM m UNION ALL SELECT 'total_tokens', 'eval_total_tokens: ' || total_tokens FROM m UNION ALL SELECT 'unique_tokens', 'eval_unique_tokens: ' || unique_tokens FROM m")
def metrics_formatted(spark, sf_dir):
    return tuning.formatted(tuning.task_metrics(_used(spark, sf_dir), "general"), "eval_")


# Planners ----------------------------------------------------------------------------------------


@query("unified_estimates", "SELECT CAST(g AS BIGINT) AS gigabytes, round(greatest(1.0, g * 0.5), 6) AS extraction_hours, round(greatest(2.0, g * 1000000 / 50000.0), 6) AS processing_hours, round(greatest(1.0, g * 0.5) + greatest(2.0, g * 1000000 / 50000.0), 6) AS total_hours, round(g * 0.3, 6) AS clean_gb FROM range(1, 101) t(g)")
def unified_estimates(spark, sf_dir):
    g = F.col("id").cast("double")
    plan = planner.unified_estimates(g, g * 1_000_000)
    return spark.range(1, 101).select(F.col("id").alias("gigabytes"), *[F.round(c, 6).alias(k) for k, c in plan.items()])


@query("run_arithmetic", "SELECT CAST(s AS BIGINT) AS steps, 256 AS effective_batch, CAST(262144 AS BIGINT) AS tokens_per_step, CAST(s * 262144 AS BIGINT) AS total_tokens, round(s * 262144 / 51000000000.0, 6) AS epochs, round(s / 20.0 / 3600, 6) AS hours, CAST(floor(s / 20000.0) AS BIGINT) AS checkpoints FROM range(10000, 600000, 10000) t(s)")
def run_arithmetic(spark, sf_dir):
    plan = planner.run_arithmetic(F.col("id"), 8, 4, 8, 1024, 20_000)
    return spark.range(10_000, 600_000, 10_000).select(F.col("id").alias("steps"), *[(F.round(c, 6) if k in ("epochs", "hours") else c).alias(k) for k, c in plan.items()])
