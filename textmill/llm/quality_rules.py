"""Quality rules by distribution divergence.

Base rules count words, symbols, repeated lines and words in repeated five-word windows. The method compares two
histograms of each document with references of its language, made from the whole corpus: character classes, and
common words of the language (with all other words as one bin). The measure is the Jensen-Shannon distance (base 2,
so 0 to 1). Each comparison has a minimum length, below which a histogram is too noisy to judge.

References are sums over all documents of a language: one row for each listed language and one for the
rest, so they are small whatever the input's size. Documents of no listed language are held against the pooled
reference of all documents.

Cases: null texts count as empty and fail the base rules; empty tables give no rows; ids may be null or repeated (each
row is judged alone); other columns are kept by ``judged``, whose own columns replace columns of the same names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import let, materialize, SPACE, words

#: Common words of each language: function words, as any grammar lists them.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "be", "with", "as", "by", "this", "are", "at", "from"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "sur", "au", "il", "ne"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "con", "no", "una", "su", "para", "es", "al"],
}
#: Character classes, taken off the text one after the other; what is left is the last class.
CLASSES = [r"[a-z]+", r"[\x20\x09-\x0D]+", r"[A-Z]+", r"[0-9]+", r"[#*$%&|<>]+", r"[.,;:!?'\x22()-]+", r"\p{Ll}+", r"\p{Lu}+"]
SYMBOLS = 4
MIN_CHARS, MAX_CHAR_DISTANCE = 600, 0.2
MIN_WORDS, MAX_WORD_DISTANCE = 100, 0.29
ALL = "*"
POOLED = sorted({w for ws in COMMON.values() for w in ws})


def char_classes(text: Column) -> Column:
    """Counts of the character classes, the rest last."""

    def peel(rest: Column, k: int, counts: list[Column]) -> Column:
        if k == len(CLASSES):
            return F.array(*counts, F.length(rest))
        return let(F.regexp_replace(rest, CLASSES[k], ""), lambda left: peel(left, k + 1, [*counts, F.length(rest) - F.length(left)]))

    return peel(text, 0, [])


def common_counts(found: Column, lang: Column) -> Column:
    """Counts of the language's common words, all other words last."""
    lists = F.array(*map(F.lit, POOLED))
    for name, ws in COMMON.items():
        lists = F.when(lang == name, F.array(*map(F.lit, ws))).otherwise(lists)
    some = F.filter(found, lambda w: w.isin(POOLED))

    def count(known: Column, listed: Column) -> Column:
        each = F.transform(listed, lambda w: F.size(known) - F.size(F.array_remove(known, w)))
        return let(each, lambda c: F.concat(c, F.array(F.size(found) - F.aggregate(c, F.lit(0), lambda a, x: a + x))))

    return let(some, lambda known: let(lists, lambda listed: count(known, listed)))


def repeated_words(found: Column, width: int = 5) -> Column:
    """Words inside windows of ``width`` words that occur twice or more in the text."""
    last = F.size(found) - width
    none = F.lit(0)

    def covered(places: Column) -> Column:
        add = lambda a, p: F.struct((p + width).alias("end"), (a["n"] + p + width - F.greatest(a["end"], p)).alias("n"))
        return F.aggregate(F.sort_array(places), F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), add, lambda a: a["n"])

    def twins(s: Column) -> Column:
        same = lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])
        return F.filter(F.transform(s, lambda x, k: F.when(same(x, k), x["i"])), lambda i: i.isNotNull())

    def windows(g: Column) -> Column:
        ordered = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), none).otherwise(covered(let(ordered, twins)))

    grams = lambda h: F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(width)]))
    return F.when(last < 1, none).otherwise(let(F.transform(found, lambda w: F.xxhash64(w)), lambda h: let(grams(h), windows)))


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def measured(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with the histograms and counts of each text (``__chars``, ``__w``, ``__dups``); texts are read here only."""
    body = F.coalesce(F.col(text), F.lit(""))

    def counts(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words"), common_counts(w, F.col(lang)).alias("common"))

    return docs.withColumns({"__chars": char_classes(body), "__w": let(words(body), counts), "__dups": duplicate_lines(body).cast("long")})


def references(measures: DataFrame, lang: str = "lang") -> DataFrame:
    """One row for each listed language, and one for all documents: lang, char_ref, word_ref (shares), from the histograms of ``measured``."""
    base = measures.select("__chars", F.col("__w.common").alias("__common"), F.col(lang).alias("lang"), F.col(lang).isin(list(COMMON)).alias("listed"))
    own = F.when(F.coalesce("listed", F.lit(False)), F.col("lang")).otherwise(F.lit(ALL))
    size = max(len(CLASSES), len(POOLED)) + 1
    sums = [F.sum(F.get("__chars", F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES) + 1)] + [F.sum(F.get("__common", F.lit(i))).alias(f"w{i}") for i in range(size)]
    table = base.groupBy(own.alias("lang")).agg(*sums).collect()  # five rows at most
    rows = []
    for r in table:
        c = [r[f"c{i}"] or 0 for i in range(len(CLASSES) + 1)]
        w = [r[f"w{i}"] or 0 for i in range(len(COMMON.get(r["lang"], POOLED)) + 1)]
        rows.append({"lang": r["lang"], "c": c, "w": w})
    # Pooled counts of the listed languages' words come from their own lists.
    total_c = [sum(r["c"][i] for r in rows) for i in range(len(CLASSES) + 1)]
    pooled = dict.fromkeys(POOLED, 0)
    other = 0
    for r in rows:
        for w, n in zip(COMMON.get(r["lang"], POOLED), r["w"], strict=False):
            pooled[w] += n
        other += r["w"][-1]
    rows = [r for r in rows if r["lang"] != ALL] + [{"lang": ALL, "c": total_c, "w": [*pooled.values(), other]}]
    for r in rows:
        for k in "cw":
            r[k] = [x / max(1, sum(r[k])) for x in r[k]]
    schema = "array<struct<lang:string,c:array<double>,w:array<double>>>"
    return measures.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), schema))).toDF("__lang", "__char_ref", "__word_ref")


def distance(counts: Column, shares: Column) -> Column:
    """Jensen-Shannon distance of counts and reference shares; null for no counts."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)

    def part(q: Column, p: Column) -> Column:
        half = lambda x: F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(0.0)
        return half(p) + half(q)

    def of(n: Column) -> Column:
        both = F.zip_with(counts, shares, lambda c, p: let(c / n, lambda q: part(q, p)))
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(both, F.lit(0.0), lambda a, x: a + x) / 2))

    return F.when(total > 0, let(total, of))


def verdicts(measures: DataFrame, refs: DataFrame, lang: str = "lang") -> DataFrame:
    """``measures`` with the base counts, both distances, base_failed and kept."""
    sum_chars = F.aggregate("__chars", F.lit(0), lambda a, x: a + x)
    own = F.when(F.coalesce(F.col(lang).isin(list(COMMON)), F.lit(False)), F.col(lang)).otherwise(F.lit(ALL))
    out = measures.withColumn("__own", own).join(F.broadcast(refs), F.col("__own") == F.col("__lang"), "left")
    out = out.withColumns({
        "n_words": F.col("__w.n_words"),
        "word_chars": (sum_chars - F.get("__chars", F.lit(1))).cast("long"),
        "n_symbols": F.get("__chars", F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": F.col("__dups"),
        "n_repeat_words": F.col("__w.n_repeat_words"),
        "char_distance": F.round(distance(F.col("__chars"), F.col("__char_ref")), 6),
        "word_distance": F.round(distance(F.col("__w.common"), F.col("__word_ref")), 6),
        "__n_chars": sum_chars,
    })
    odd_chars = (F.col("__n_chars") >= MIN_CHARS) & (F.coalesce("char_distance", F.lit(0.0)) > MAX_CHAR_DISTANCE)
    odd_words = (F.col("n_words") >= MIN_WORDS) & (F.coalesce("word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE)
    out = out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    out = out.withColumn("kept", ~F.col("base_failed") & ~odd_chars & ~odd_words)
    return out.drop("__chars", "__w", "__dups", "__own", "__lang", "__char_ref", "__word_ref", "__n_chars")


def judged(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with the base counts, both distances, base_failed and kept, which take the place of columns of these names."""
    measures = materialize(measured(docs, text, lang), "measures")
    return verdicts(measures, references(measures, lang), lang)


def kept(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    names = docs.columns
    own = docs.withColumnsRenamed({c: f"c{i}" for i, c in enumerate(names)})
    out = judged(own, f"c{names.index(text)}", f"c{names.index(lang)}").where("kept")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def op1_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    measures = materialize(measured(docs).drop("text"), "measures")  # a few numbers for each document
    out = verdicts(measures, references(measures))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance")


def _lists() -> str:
    cases = " ".join(f"WHEN '{k}' THEN {ws}" for k, ws in COMMON.items())
    return f"CASE lang {cases} ELSE {POOLED} END"


def _peeled() -> str:
    """Lengths of what is left after each class."""
    expr, out = "t", ["length(t)"]
    for c in CLASSES:
        expr = f"regexp_replace({expr}, '{c.replace(chr(39), chr(39) * 2)}', '', 'g')"
        out.append(f"length({expr})")
    return "[" + ", ".join(out) + ", 0]"


#: DuckDB twin of op1_distribution_divergence.
OP1_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, CASE WHEN lang IN ({', '.join(f"'{k}'" for k in COMMON)}) THEN lang ELSE '{ALL}' END AS lang FROM documents),
a AS (
  SELECT doc_id, lang, t, list_filter(regexp_split_to_array(t, '{SPACE}'), lambda x: x <> '') AS w, {_peeled()} AS left_, {_lists()} AS listed FROM d),
b AS (
  SELECT *, list_transform(range(1, {len(CLASSES) + 2}), lambda i: left_[i] - left_[i + 1]) AS c,
    list_transform(listed, lambda x: len(list_filter(w, lambda y: y = x))) AS k FROM a),
e AS (SELECT *, list_append(k, len(w) - list_sum(k)) AS q FROM b),
lc AS (SELECT lang, i, sum(n) AS n FROM (SELECT lang, unnest(c) AS n, unnest(range(1, len(c) + 1)) AS i FROM e) GROUP BY ALL),
lw AS (SELECT lang, word, sum(n) AS n FROM (SELECT lang, unnest(q) AS n, unnest(list_append(listed, '')) AS word FROM e) GROUP BY ALL),
langs AS (SELECT DISTINCT lang, list_append(listed, '') AS listed FROM e),
rc AS (
  SELECT lang, list(n / greatest(1, s) ORDER BY i) AS p FROM (
    SELECT lang, i, n, sum(n) OVER (PARTITION BY lang) AS s FROM (SELECT lang, i, n FROM lc WHERE lang <> '{ALL}' UNION ALL SELECT '{ALL}', i, sum(n) FROM lc GROUP BY i)) GROUP BY lang),
rw AS (
  SELECT lang, list(n / greatest(1, s) ORDER BY i) AS p FROM (
    SELECT l.lang, l.i, coalesce(x.n, 0) AS n, sum(coalesce(x.n, 0)) OVER (PARTITION BY l.lang) AS s
    FROM (SELECT lang, unnest(listed) AS word, unnest(range(1, len(listed) + 1)) AS i FROM langs) l
    LEFT JOIN (SELECT lang, word, n FROM lw WHERE lang <> '{ALL}' UNION ALL SELECT '{ALL}', word, sum(n) FROM lw GROUP BY word) x ON l.lang = x.lang AND l.word = x.word) GROUP BY lang),
lines AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
win AS (SELECT doc_id, s, list_aggregate(w[s : s + 4], 'string_agg', ' ') AS v FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS s FROM e WHERE len(w) >= 5)),
rep AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(s, s + 5)) FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, v) AS m FROM win) WHERE m > 1) GROUP BY doc_id),
js AS (
  SELECT e.doc_id, e.t, len(e.w) AS n_words, list_sum(e.c) - e.c[2] AS word_chars, e.c[{SYMBOLS + 1}] AS n_symbols, length(e.t) AS chars,
    sqrt(greatest(0, list_sum(list_transform(range(1, len(e.c) + 1), lambda i:
      CASE WHEN rc.p[i] > 0 THEN rc.p[i] * log2(2 * rc.p[i] / (rc.p[i] + e.c[i] / list_sum(e.c))) ELSE 0.0 END
      + CASE WHEN e.c[i] > 0 THEN e.c[i] / list_sum(e.c) * log2(2 * (e.c[i] / list_sum(e.c)) / (rc.p[i] + e.c[i] / list_sum(e.c))) ELSE 0.0 END)) / 2)) AS cd,
    sqrt(greatest(0, list_sum(list_transform(range(1, len(e.q) + 1), lambda i:
      CASE WHEN rw.p[i] > 0 THEN rw.p[i] * log2(2 * rw.p[i] / (rw.p[i] + e.q[i] / list_sum(e.q))) ELSE 0.0 END
      + CASE WHEN e.q[i] > 0 THEN e.q[i] / list_sum(e.q) * log2(2 * (e.q[i] / list_sum(e.q)) / (rw.p[i] + e.q[i] / list_sum(e.q))) ELSE 0.0 END)) / 2)) AS wd
  FROM e LEFT JOIN rc ON e.lang = rc.lang LEFT JOIN rw ON e.lang = rw.lang),
r AS (
  SELECT js.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
    CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, chars,
    round(CASE WHEN chars > 0 THEN cd END, 6) AS char_distance, round(CASE WHEN n_words > 0 THEN wd END, 6) AS word_distance
  FROM js LEFT JOIN lines ON js.doc_id = lines.doc_id LEFT JOIN rep ON js.doc_id = rep.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (chars >= {MIN_CHARS} AND coalesce(char_distance, 0) > {MAX_CHAR_DISTANCE}) AND NOT (n_words >= {MIN_WORDS} AND coalesce(word_distance, 0) > {MAX_WORD_DISTANCE}) AS kept,
  char_distance, word_distance
FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM r)
"""
