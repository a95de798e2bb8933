"""Fine-tuning formats and the metrics over labels, predictions and generated texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import text as T

IGNORED = -100


def chat_messages(messages: Column) -> Column:
    """Messages as ``<|role|>content<|end|>`` lines."""
    one = lambda m: F.concat(F.lit("<|"), F.coalesce(m["role"], F.lit("user")), F.lit("|>"), F.coalesce(m["content"], F.lit("")), F.lit("<|end|>\n"))
    return F.array_join(F.transform(messages, one), "")


def chat_pair(prompt: Column, response: Column) -> Column:
    return F.concat(F.lit("<|user|>"), prompt, F.lit("<|end|>\n<|assistant|>"), response, F.lit("<|end|>"))


def chat(messages: Column, prompt: Column, response: Column, text: Column) -> Column:
    pair = F.when(prompt.isNotNull() & response.isNotNull(), chat_pair(prompt, response))
    return F.coalesce(F.when(messages.isNotNull(), chat_messages(messages)), pair, text, F.lit(""))


def instruct(instruction: Column, given: Column, output: Column) -> Column:
    part = lambda c: F.coalesce(c, F.lit(""))
    block = F.when(part(given) != "", F.concat(F.lit("### Input:\n"), given, F.lit("\n\n"))).otherwise("")
    return F.concat(F.lit("### Instruction:\n"), part(instruction), F.lit("\n\n"), block, F.lit("### Response:\n"), part(output))


def code(prompt: Column, completion: Column, source: Column, text: Column) -> Column:
    pair = F.when(prompt.isNotNull() & completion.isNotNull(), F.concat(F.lit("# Task: "), prompt, F.lit("\n\n"), completion))
    return F.coalesce(pair, source, text, F.lit(""))


def code_prepared(prompt: Column, completion: Column, problem: Column, solution: Column, source: Column) -> Column:
    """As ``code`` with problems and their solutions, and without plain text; null where an example has none of these (it is skipped)."""
    task = F.concat(F.lit("# Task: "), prompt, F.lit("\n\n"), completion)
    solved = F.concat(F.lit("# Problem:\n"), problem, F.lit("\n\n# Solution:\n"), solution)
    return F.coalesce(task, solved, source)


def custom(text: Column, prompt: Column, completion: Column, given: Column, output: Column, rest: list[Column]) -> Column:
    pair = lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.concat(a, F.lit("\n"), b))
    return F.coalesce(text, pair(prompt, completion), pair(given, output), F.concat_ws("\n", *rest))


def conversations(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """One row for each conversation, with its messages in order."""
    rows = turns.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, "role", F.col("text").alias("content")))).alias("messages"))
    return rows.withColumn("messages", F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))))


def token_accuracy(df: DataFrame, prediction: str, label: str) -> DataFrame:
    """accuracy, unique predicted tokens, their share of all, and the total, over labels that count."""
    used = df.where(F.col(label) != IGNORED)
    return used.agg(
        F.round(F.avg((F.col(prediction) == F.col(label)).cast("double")), 6).alias("accuracy"), F.countDistinct(prediction).alias("unique_tokens"),
        F.round(F.countDistinct(prediction) / F.count(F.lit(1)), 6).alias("vocab_usage"), F.count(F.lit(1)).alias("total_tokens"),
    )


def grams(found: Column, n: int) -> Column:
    """n-grams of an array, as strings joined by spaces."""
    size = F.size(found)
    made = F.transform(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(found, i, n), " "))
    return F.when(size >= n, made).otherwise(F.array().cast("array<string>"))


def diversity(df: DataFrame, found: str, n: int) -> DataFrame:
    """Distinct n-grams of all rows, over all n-grams."""
    rows = df.select(F.explode(grams(F.col(found), n)).alias("g"))
    return rows.agg(F.count(F.lit(1)).alias("total"), F.countDistinct("g").alias("distinct"), F.round(F.countDistinct("g") / F.greatest(F.count(F.lit(1)), F.lit(1)), 6).alias("diversity"))


def repetition_rate(df: DataFrame, found: str, n: int = 3) -> DataFrame:
    """Share of the distinct n-grams that occur more than once; n-grams never cross rows."""
    counts = df.select(F.explode(grams(F.col(found), n)).alias("g")).groupBy("g").count()
    return counts.agg(F.count(F.lit(1)).alias("distinct"), F.count_if(F.col("count") > 1).alias("repeated"), F.round(F.coalesce(F.try_divide(F.count_if(F.col("count") > 1), F.count(F.lit(1))), F.lit(0.0)), 6).alias("repetition_rate"))


def simple_bleu(generated: Column, reference: Column, n: int) -> Column:
    """Unclipped precision of n-grams times a brevity factor; 0 when either side is shorter than n."""
    hits = lambda own: T.bind(grams(reference, n), lambda other: F.size(F.filter(own, lambda g: F.array_contains(other, g))) / F.size(own))
    both = (F.size(generated) >= n) & (F.size(reference) >= n)
    return F.when(both, T.bind(grams(generated, n), hits) * F.least(F.lit(1.0), F.size(generated) / F.size(reference))).otherwise(0.0)


def pattern_consistency(labels: Column, predictions: Column, n: int = 3) -> Column:
    """Share of the distinct label n-grams that are among the prediction n-grams."""
    own = F.array_distinct(grams(labels, n))
    return F.when(F.size(own) > 0, F.size(F.array_intersect(own, grams(predictions, n))) / F.size(own)).otherwise(0.0)


def used_pairs(df: DataFrame, order: str, prediction: str, label: str, block: int = 65_536) -> DataFrame:
    """place (from 0, without gaps), p and l of the positions whose label counts, in order.

    Places come from the sizes of blocks of ``order`` (a long), so that only one row for each block is ranked together.
    """
    from pyspark.sql.window import Window

    rows = df.where(F.col(label) != IGNORED).select(F.floor(F.col(order) / block).alias("block"), F.col(order).alias("at"), F.col(prediction).alias("p"), F.col(label).alias("l"))
    sizes = rows.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("block", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("block").orderBy("at")) - 1
    return rows.withColumn("own", place).join(sizes, "block").select((F.col("before") + F.col("own")).alias("place"), "p", "l")


def pooled_grams(pairs: DataFrame, column: str, n: int) -> DataFrame:
    """The n-grams of consecutive places: each value goes to the grams it is in, which are then put together."""
    starts = pairs.select(F.explode(F.sequence(F.col("place") - (n - 1), F.col("place"))).alias("start"), "place", F.col(column).alias("v"))
    grams_ = starts.where("start >= 0").groupBy("start").agg(F.array_sort(F.collect_list(F.struct("place", "v"))).alias("g"))
    return grams_.where(F.size("g") == n).select(F.transform("g", lambda x: x["v"]).alias("g"))


def task_metrics(pairs: DataFrame, task: str) -> DataFrame:
    """One row of the task's measures, pooled over all places of ``pairs`` (as from ``used_pairs``). No places give accuracy 0 and an infinite perplexity, which is null otherwise."""
    n, same = F.count(F.lit(1)), F.count_if(F.col("p") == F.col("l"))
    base = [F.round(F.coalesce(F.try_divide(same, n), F.lit(0.0)), 6).alias("accuracy"), F.countDistinct("p").alias("unique_tokens"), n.alias("total_tokens")]
    base += [F.round(F.try_divide(F.countDistinct("p"), n), 6).alias("vocab_usage"), F.when(n == 0, F.lit(float("inf"))).alias("perplexity")]
    if task == "instruct":
        return pairs.agg(*base, F.round(n / F.greatest(F.countDistinct("l"), F.lit(1)), 6).alias("avg_response_length"), F.round(F.try_divide(same, n), 6).alias("adherence_score"))
    if task == "chat":
        found = pooled_grams(pairs, "p", 2).agg(F.count(F.lit(1)).alias("grams"), F.countDistinct("g").alias("distinct"))
        rows = pairs.agg(*base, F.round(F.try_divide(F.countDistinct("p"), n), 6).alias("response_diversity")).crossJoin(F.broadcast(found))  # one row each
        return rows.withColumn("bigram_diversity", F.round(F.col("distinct") / F.greatest("grams", F.lit(1)), 6)).drop("grams", "distinct")
    if task == "code":
        own, made = pooled_grams(pairs, "l", 3).distinct(), pooled_grams(pairs, "p", 3).distinct().withColumn("hit", F.lit(1))
        found = own.join(made, "g", "left").agg(F.count(F.lit(1)).alias("own"), F.count("hit").alias("common"))
        rows = pairs.agg(*base, F.round(F.try_divide(same, n), 6).alias("exact_match_rate")).crossJoin(F.broadcast(found))  # one row each
        return rows.withColumn("pattern_consistency", F.round(F.coalesce(F.try_divide("common", "own"), F.lit(0.0)), 6)).drop("own", "common")
    return pairs.agg(*base)


def formatted(metrics: DataFrame, prefix: str = "") -> DataFrame:
    """A row for each measure of a one-row table, by name: floats with four places."""
    kinds = dict(metrics.dtypes)
    line = lambda c: F.format_string(f"{prefix}{c}: %.4f", F.col(c)) if kinds[c] in ("double", "float") else F.format_string(f"{prefix}{c}: %s", F.col(c).cast("string"))
    rows = F.array(*[F.struct(F.lit(c).alias("name"), F.when(F.col(c).isNotNull(), line(c)).alias("line")) for c in sorted(metrics.columns)])
    rows = F.filter(rows, lambda r: r["line"].isNotNull())  # measures without a value have no line
    return metrics.select(F.inline(rows))
