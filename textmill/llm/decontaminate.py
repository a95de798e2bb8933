"""Benchmark decontamination by winnowing.

Each text is a sequence of words. Of every ``WINDOW - GRAM + 1`` consecutive hashes of ``GRAM`` words the
smallest is kept, so any two texts that share ``WINDOW`` consecutive words keep a common fingerprint inside
them. Fingerprints of documents and of test items are joined; a hit brings the words around it along, is
extended to all the windows that contain it, and these are joined, as strings, with the test windows.

Items shorter than a window count as one window of their own length. They have no fingerprint for sure, so
they are found by an anchor (their longest word) and extended in the same way.

Everything is a DataFrame or SQL function. The documents are read once and never shuffled whole: only
matched fingerprints leave their task. The test side is broadcast while its windows take at most
``BROADCAST_BYTES``; beyond, both joins shuffle on their keys.

Cases: null texts have no words; a null or repeated document id is a row of its own (results are kept for each
input row); items with a null id or no words are left out; empty tables give empty results; extra columns are not
carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import let

WINDOW = 13
GRAM = 6
BROADCAST_BYTES = 32 << 20
#: So many anchors are tested in the scan; with more, every word goes to the join.
ANCHORS = 5000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; other letters stay. Plain ASCII texts take the fast way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def item_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text; null has none."""
    parts = F.split(ascii_lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.coalesce(F.array_remove(parts, ""), F.array().cast("array<string>"))


def _grams(hashes: Column, size: int) -> Column:
    """Hashes of ``size`` consecutive words, by position."""
    last = F.size(hashes) - size
    made = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(size)]))
    return F.when(last >= 0, made).otherwise(F.array().cast("array<bigint>"))


def selected(words: Column, then, gram: int, width: int) -> Column:
    """``then(p, hash)`` for each kept position: the hash is the smallest of a run of ``width`` hashes around it.

    ``m[i]`` is the smallest of ``g[i .. i+width-1]``; position ``p`` is kept if the largest of ``m`` over the runs that
    contain it equals ``g[p]``.
    """

    def with_grams(g: Column) -> Column:
        last = F.size(g) - width
        m = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.least(*[F.get(g, i + j) for j in range(width)]))

        def with_minima(m: Column) -> Column:
            around = lambda p: F.greatest(*[F.when(p >= j, F.get(m, p - j)) for j in range(width)])
            kept = F.filter(F.sequence(F.lit(0), F.greatest(F.size(g) - 1, F.lit(0))), lambda p: F.get(g, p) == around(p))
            return F.transform(kept, lambda p: then(p, F.get(g, p)))

        return F.when(last >= 0, let(m, with_minima))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(_grams(h, gram), with_grams))


def _around(words: Column, p: Column, before: int, after: int) -> tuple[Column, Column]:
    first = F.greatest(p - before, F.lit(0))
    return first, F.slice(words, first + 1, p - first + after)


def benchmark_windows(items: DataFrame, item_id: str, text: str, window: int = WINDOW) -> DataFrame:
    """item (string), window (words joined by spaces) and its number of words, of all windows."""
    base = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("string").alias("item"), item_words(F.col(text)).alias("words"))
    base = base.where(F.size("words") > 0).withColumn("size", F.least(F.size("words"), F.lit(window)))
    cut = F.transform(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1), lambda i: F.array_join(F.slice("words", i, F.col("size")), " "))
    return base.select("item", "size", F.explode(F.array_distinct(cut)).alias("win")).distinct()


def find_hits(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, gram: int = GRAM, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """For each row of ``docs``: key, n_words, starts (array of (start, words) of windows that occur in an item), items (sorted)."""
    width = window - gram + 1
    windows = benchmark_windows(items, item_id, item_text, window)
    weight = windows.agg(F.coalesce(F.sum(F.octet_length("win") + 64), F.lit(0)), F.collect_set(F.when(F.col("size") < window, F.col("size")))).first()
    small, lengths = weight[0] <= broadcast_bytes, sorted(weight[1])
    hint = F.broadcast if small else (lambda df: df)

    words_of = F.split(F.col("win"), " ")
    longs = windows.where(F.col("size") == window).select(F.explode(selected(words_of, lambda p, g: g, gram, width)).alias("fp"))
    anchors: list[str] | None = []
    fingerprints = longs
    if lengths:
        shorts = windows.where(F.col("size") < window)
        longest = F.array_sort(F.transform(words_of, lambda w: F.struct((-F.length(w)).alias("size"), w.alias("word"))))[0]["word"]
        shorts = shorts.select(longest.alias("anchor")).distinct()
        anchors = [r[0] for r in shorts.limit(ANCHORS + 1).collect()]
        anchors = anchors if len(anchors) <= ANCHORS else None
        fingerprints = longs.union(shorts.select(F.xxhash64(F.lit("anchor"), "anchor")))
    fingerprints = fingerprints.distinct().select("fp", F.lit(True).alias("known"))

    def found(words: Column) -> Column:
        def row(p: Column, fp: Column, short: bool, before: int, after: int) -> Column:
            first, near = _around(words, p, before, after)
            return F.struct(p.alias("at"), fp.alias("fp"), first.alias("first"), near.alias("near"), F.lit(short).alias("short"))

        none = F.slice(F.array(row(F.lit(0), F.lit(0).cast("long"), False, 0, 0)), 1, 0)
        rows = F.coalesce(selected(words, lambda p, g: row(p, g, False, window - gram, window), gram, width), none)
        if lengths:
            some = (lambda w: F.lit(True)) if anchors is None else (lambda w: w.isin(anchors))
            places = F.filter(F.transform(words, lambda w, i: F.when(some(w), i)), lambda i: i.isNotNull())
            rows = F.concat(rows, F.transform(places, lambda p: row(p, F.xxhash64(F.lit("anchor"), F.get(words, p)), True, lengths[-1] - 1, lengths[-1])))
        head = F.struct(F.lit(-1).alias("at"), F.lit(None).cast("long").alias("fp"), F.size(words).alias("first"), F.array().cast("array<string>").alias("near"), F.lit(False).alias("short"))
        return F.concat(F.array(head), rows)

    # The first row of each document carries its number of words, so that one pass gives both it and the hits.
    base = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(key).alias("__key"), F.col(text).alias("__text"))
    base = base.select("__row", "__key", F.explode(let(item_words(F.col("__text")), found)).alias("r"))
    # Heads have no fingerprint, and rows without a window no window; values of their own keep them apart where joins shuffle.
    base = base.select("__row", "__key", "r.*").withColumn("fp", F.coalesce("fp", F.xxhash64(F.lit("head"), "__row")))
    base = base.join(hint(fingerprints), "fp", "left").where(F.col("known") | (F.col("at") < 0))

    def cut(size: int) -> Column:
        """Windows of ``size`` words that contain the hit."""
        low = F.greatest(F.col("at") - (size - gram if size == window else size - 1), F.lit(0))
        high = F.least(F.col("at"), F.col("first") + F.size("near") - size)
        starts = F.when(high >= low, F.sequence(low, F.greatest(high, low)))
        made = F.transform(starts, lambda s: F.struct(s.alias("start"), F.lit(size).alias("size"), F.array_join(F.slice("near", s - F.col("first") + 1, size), " ").alias("win")))
        return F.coalesce(made, F.slice(F.array(F.struct(F.lit(0).alias("start"), F.lit(size).alias("size"), F.lit("").alias("win"))), 1, 0))

    short = F.concat(*[cut(n) for n in lengths]) if lengths else cut(window)
    spread = F.when(F.col("at") >= 0, F.when(F.col("short"), short).otherwise(cut(window)))
    base = base.select("__row", "__key", F.when(F.col("at") < 0, F.col("first")).alias("n"), F.explode_outer(spread).alias("w"))
    base = base.select("__row", "__key", "n", "w.start", "w.size", F.coalesce("w.win", F.concat(F.lit("\0"), F.col("__row"))).alias("win"))  # no word has a NUL
    hits = base.join(hint(windows.withColumnRenamed("size", "__size")), "win", "left")
    seen = F.when(F.col("item").isNotNull(), F.struct("start", F.col("size").alias("words")))
    return hits.groupBy("__row").agg(F.first("__key").alias(key), F.max("n").cast("long").alias("n_words"), F.array_sort(F.collect_set(seen)).alias("starts"), F.array_sort(F.collect_set("item")).alias("items")).drop("__row")


def spans(starts: Column) -> Column:
    """Disjoint (first word, end) of windows sorted by start."""
    one = lambda s: F.struct(s["start"].alias("first"), (s["start"] + s["words"]).alias("end"))

    def grow(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["first"].alias("first"), F.greatest(last["end"], s["start"] + s["words"]).alias("end"))
        return F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= s["start"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(one(s))))

    return F.aggregate(starts, F.array().cast("array<struct<first:int,end:int>>"), grow)


def n_hit(starts: Column) -> Column:
    """Words inside any of the windows."""

    def add(a: Column, s: Column) -> Column:
        end = s["start"] + s["words"]
        return F.struct(F.greatest(a["end"], end).alias("end"), (a["n"] + F.greatest(F.lit(0), end - F.greatest(a["end"], s["start"]))).alias("n"))

    return F.aggregate(starts, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), add, lambda a: a["n"]).cast("long")


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """key, n_words, n_hit, items, starts, contaminated (a twentieth or more of the words hit) for each row of ``docs``."""
    out = find_hits(docs, items, key=key, **options).withColumn("n_hit", n_hit(F.col("starts")))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    out = decontaminate(docs, items)
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), "contaminated")


#: DuckDB twin of op6_winnowing: every window of a document is looked up directly.
OP6_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(w), 13) AS size, array_to_string(w[s : s + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, s, size, array_to_string(w[s : s + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM w, sizes WHERE len(w) >= size)),
hit AS (SELECT doc_id, s, dw.size, item FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
cov AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(s, s + size)) FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(its.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(its.items, '')) AS items_sha256,
  coalesce(cov.n, 0) > 0 AND 20 * coalesce(cov.n, 0) >= len(w) AS contaminated
FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id LEFT JOIN its ON w.doc_id = its.doc_id
"""
