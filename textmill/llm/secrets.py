"""Secret scans with multipart credential linking.

Strong findings (``assign``, ``access``, ``hex``) stand alone. Weak candidates (an account identifier, a mixed
string of some length, an endpoint) are reported only where a complementary part lies within the same scope: an identifier
or an endpoint needs a secret, and a weak secret needs an identifier or an endpoint. Strong findings count as parts as
well, and a weak candidate that overlaps one is dropped. Both are interval joins: spans fall into all blocks of ``SCOPE`` code points that they
touch (parts also into the neighbouring ones), a candidate meets those of its blocks by an equi-join, and the gap decides. They
are semi-joins, so no pairs are made. ``scan`` and ``redacted`` use the same joins.

Positions: ``split`` and ``regexp_extract_all`` cut a text by the same leftmost, non-overlapping matches, so running
sums of the lengths of both give starts and ends in code points. They are taken in runs of ``RUN`` matches, so that texts with very many matches
take about linear time. Patterns begin only where a run of their characters begins.

Cases: null texts count as empty and stay null when masked; empty tables give no rows; ids may be null or repeated (each row is scanned alone); equal texts
have equal spans; of spans with one start the kind decides the order; ``scan`` carries no further columns, ``redacted`` keeps all of them, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import base_documents, let, materialize

SCOPE = 200
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
WEAK = {
    "identifier": r"(?<![A-Za-z0-9._%+-])(?:[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]++|(?i:client|account|user)[_-]?(?i:id|name)\x20*[:=]\x20*[A-Za-z0-9._@+-]++|AKIA[A-Z0-9]{4,11}(?![A-Z0-9]))",
    "secret": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}",
    "endpoint": r"(?<![A-Za-z0-9])(?:https?|s3|ftp|jdbc:[a-z]+|postgres|mysql|redis|mongodb)://[^\x20\x09-\x0D\x22'<>]+",
}
#: In the order of the report.
KINDS = ["assign", "access", "hex", *WEAK]
#: Matches whose positions are summed together.
RUN = 256
SPAN = "array<struct<start:int,rank:int,end:int>>"


def _none() -> Column:
    return F.array().cast(SPAN)


def matches(text: Column, pattern: str, rank: int, keep=None) -> Column:
    """Spans of the pattern's matches; ``keep(match, index)`` may drop some."""

    def walk(found: Column) -> Column:
        def go(gaps: Column) -> Column:
            rows = F.transform(found, lambda m, i: F.struct(F.length(m).alias("size"), F.length(F.get(gaps, i)).alias("gap"), (F.lit(True) if keep is None else keep(m, i)).alias("keep")))
            return let(rows, spans)

        def step(a: Column, x: Column) -> Column:
            start = a["at"] + x["gap"]
            end = start + x["size"]
            one = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end")))
            return F.struct(end.alias("at"), F.when(x["keep"], F.concat(a["spans"], one)).otherwise(a["spans"]).alias("spans"))

        def spans(rows: Column) -> Column:
            run = lambda k: F.slice(rows, k * RUN + 1, F.lit(RUN))
            runs = F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / RUN).cast("int"))
            size = lambda k: F.aggregate(run(k), F.lit(0), lambda a, x: a + x["gap"] + x["size"])
            begin = F.aggregate(runs, F.array(F.lit(0)), lambda a, k: F.concat(a, F.array(F.element_at(a, -1) + size(k))))
            one = lambda at, k: F.aggregate(run(k), F.struct(at.alias("at"), _none().alias("spans")), step, lambda a: a["spans"])
            return let(begin, lambda starts: F.flatten(F.transform(runs, lambda k: one(F.get(starts, k), k))))

        return let(F.split(text, pattern, -1), go)

    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), walk)).otherwise(_none())


def strong(text: Column) -> Column:
    """Spans of the three strong kinds, by start and kind."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assign = F.when(text.rlike(ASSIGN), let(values, lambda v: matches(text, ASSIGN, 0, lambda m, i: F.length(F.get(v, i)) >= 8))).otherwise(_none())
    return F.sort_array(F.concat(assign, matches(text, ACCESS, 1), matches(text, HEX, 2)))


def weak(text: Column) -> Column:
    mixed = lambda m, i: m.rlike("[0-9]") & m.rlike("[A-Za-z]") & ~m.rlike("^[0-9a-f]{32,}$")
    parts = [matches(text, p, KINDS.index(k), mixed if k == "secret" else None) for k, p in WEAK.items()]
    return F.sort_array(F.concat(*parts))


def _blocks(start: Column, end: Column, scope: int, around: int = 0) -> Column:
    """A row for each block that the span touches, and ``around`` more on both sides."""
    return F.explode(F.sequence(F.floor(start / scope) - around, F.floor(end / scope) + around))


def _exploded(found: DataFrame, spans: str) -> DataFrame:
    return found.select("__row", F.explode(spans).alias("s"))


def _aside(spans: DataFrame, scope: int, around: int, *more: Column) -> DataFrame:
    """The right side of a join: spans in their blocks, under names of their own."""
    own = spans.select(F.col("__row").alias("p_row"), F.col("s.start").alias("p_start"), F.col("s.end").alias("p_end"), *more)
    return own.withColumn("p_block", _blocks(F.col("p_start"), F.col("p_end"), scope, around))


def link(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """__row and its linked weak spans, from __row, strong and weak; rows without any are left out."""
    role = F.when(F.col("s.rank").isin(0, 2, 4), "secret").otherwise("other")  # secrets meet the rest
    some = found.where(F.size("weak") > 0)
    own = _blocks(F.col("s.start"), F.col("s.end"), scope)
    same = (F.col("__row") == F.col("p_row")) & (F.col("block") == F.col("p_block"))
    strong_, weak_ = _exploded(some, "strong"), _exploded(some, "weak")
    overlap = same & (F.col("p_start") < F.col("s.end")) & (F.col("s.start") < F.col("p_end"))
    covered = weak_.withColumn("block", own).join(_aside(strong_, scope, 0), overlap, "left_semi").select("__row", "s").distinct()
    weak_ = weak_.join(covered, ["__row", "s"], "left_anti")
    parts = _aside(strong_.union(weak_), scope, 1, role.alias("p_role"))
    gap = F.greatest(F.col("s.start") - F.col("p_end"), F.col("p_start") - F.col("s.end"))
    near = same & (F.col("role") != F.col("p_role")) & (gap <= scope)
    return weak_.withColumns({"role": role, "block": own}).join(parts, near, "left_semi").groupBy("__row").agg(F.collect_set("s").alias("linked"))


def _base(docs: DataFrame, row: Column, text: str, *more: str) -> DataFrame:
    base = docs.select(row.alias("__row"), *more, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    return base.withColumn("strong", strong(F.col("__text"))).withColumn("weak", weak(F.col("__text"))).drop("__text")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """For each row: key, strong and linked spans (start, rank in KINDS, end)."""
    base = docs.select(F.col(key).alias("__key"), F.col(text).alias("__own"))
    base = materialize(_base(base, F.monotonically_increasing_id(), "__own", "__key"), "secrets")  # spans only, no texts; read again
    out = base.join(link(base, scope), "__row", "left")
    return out.select(F.col("__key").alias(key), "strong", F.sort_array(F.coalesce("linked", _none())).alias("linked"))


def listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with each span replaced; ``spans`` are in order, and overlapping ones give one mask."""

    def merged(a: Column, s: Column) -> Column:
        fresh = s["start"] >= a["at"]
        piece = F.when(fresh, F.array(F.substr(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mask))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.concat(a["out"], piece).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = lambda a: F.concat(F.array_join(a["out"], ""), F.substr(text, a["at"] + 1))
    return F.when(F.size(spans) > 0, F.aggregate(spans, begin, merged, done)).otherwise(text)


def redacted(docs: DataFrame, text: str = "text", scope: int = SCOPE, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with all findings of ``scan`` masked in ``text``; null texts stay null.

    Spans follow from the text alone. So the weak candidates of a text are linked under its MD5, copies once, and only rows that have
    some are joined with the links; the others are masked where they are.
    """
    names = docs.columns
    own = docs.withColumnsRenamed({c: f"c{i}" for i, c in enumerate(names)})
    column = f"c{names.index(text)}"
    value = F.coalesce(F.col(column), F.lit(""))
    own = materialize(own.withColumns({"strong": strong(value), "weak": weak(value), "__row": F.md5(value.cast("binary"))}), "scanned")
    waiting = own.where(F.size("weak") > 0)
    base = waiting.groupBy("__row").agg(F.first("strong").alias("strong"), F.first("weak").alias("weak"))
    linked = waiting.join(link(base, scope), "__row", "left").withColumn("spans", F.sort_array(F.concat("strong", F.coalesce("linked", _none()))))
    alone = own.where(F.size("weak") == 0).withColumn("spans", F.col("strong"))
    held = [f"c{i}" for i in range(len(names))]
    out = alone.select(*held, "spans").union(linked.select(*held, "spans"))
    out = out.withColumn(column, F.when(F.col(column).isNotNull(), masked(F.col(column), F.col("spans"), mask)))
    return out.select(*[F.col(h).alias(c) for h, c in zip(held, names, strict=True)])


def op8_credential_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(base_documents(spark, sf_dir))
    count = lambda k: F.size(F.filter("strong", lambda s: s["rank"] == k)).cast("long")
    return out.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(F.col("strong")).cast("binary"), 256).alias("base_sha256"),
        listed(F.sort_array(F.concat("strong", "linked"))).alias("spans"),
    )
