"""Text functions as Column expressions; all stay inside the JVM.

Regular expressions follow Python's rules: white space is Unicode white space and the separator controls, word characters are
letters, numbers and underscore, and only a line feed ends a line.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WS = r"(?U)[\s\x1c-\x1f]"
WORD = r"[\p{L}\p{N}_]"
GONE = ["[deleted]", "[removed]"]

# The ordered substitutions of the post cleaner.
POST_RULES = [
    (r"\[deleted\]", ""),
    (r"\[removed\]", ""),
    (r"(?d)&gt;!(.*)!&lt;", "$1"),
    (r"(?dm)&gt;(.*)$", "$1"),
    (r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+", "[URL]"),
    (r"/u/([a-zA-Z0-9_-]+)", "[USER]"),
    (r"/r/([a-zA-Z0-9_-]+)", "[SUBREDDIT]"),
    (r"u/([a-zA-Z0-9_-]+)", "[USER]"),
    (r"r/([a-zA-Z0-9_-]+)", "[SUBREDDIT]"),
    (r"(?d)\*\*(.*?)\*\*", "$1"),
    (r"(?d)\*(.*?)\*", "$1"),
    (r"(?d)~~(.*?)~~", "$1"),
    (rf"\^({WORD}+)", "$1"),
    (r"(?iu)EDIT:?", ""),
    (r"(?iu)UPDATE:?", ""),
    (r"\n+", " "),
    (f"{WS}+", " "),
]
#: What a text needs for a substitution of the post cleaner to find anything (None: tried on all): texts without it are not scanned.
POST_NEEDS = ["[deleted]", "[removed]", "&gt;!", "&gt;", "http", "/u/", "/r/", "u/", "r/", "**", "*", "~~", "^", "edit", "update", "\n", None]
# The substitutions of the large-dump cleaner, after white space is collapsed.
DUMP_RULES = [
    (r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\(\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+", ""),
    (rf"/u/{WORD}+", "[USER]"),
    (rf"/r/{WORD}+", "[SUBREDDIT]"),
    (r"(?d)\*\*(.+?)\*\*", "$1"),
]
# Spam patterns, tried on lower-cased title and body.
SPAM = [
    r"(upvote|like|share|subscribe|follow).{0,20}(if|to|for)",
    r"check.{0,10}(out|this).{0,10}(link|site|channel)",
    r"(click|visit).{0,10}(here|link|below)",
    r"(buy|purchase|order).{0,10}(now|today|here)",
    r"limited.{0,10}time.{0,10}offer",
    r"(make|earn).{0,10}money.{0,10}(fast|quick|easy)",
]
#: Of each spam pattern the words, of which a text needs one of each group.
SPAM_NEEDS = [re.findall(r"\(([a-z|]+)\)|([a-z]{4,})", pattern) for pattern in SPAM]


def strip(text: Column) -> Column:
    """White space off both ends, by Python's notion of it."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def collapse(text: Column) -> Column:
    return F.regexp_replace(text, f"{WS}+", " ")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once for each row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with further columns that later filters and projections read and never compute again (they come out of a generator)."""
    made = F.struct(*[c.alias(k) for k, c in columns.items()])
    rows = df.select(*[c for c in df.columns if c not in columns], F.explode(F.array(made)).alias("__made"))
    return rows.select(*[c for c in df.columns if c not in columns], *[F.col(f"__made.{k}").alias(k) for k in columns])


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{WS}+"), "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def clean_post(text: Column) -> Column:
    """The post cleaner: fixed substitutions in order, then strip; null and empty give the empty string."""
    out = F.coalesce(text, F.lit(""))
    for rule, need in zip(POST_RULES, POST_NEEDS, strict=True):
        if need != "\n":  # the last rule replaces line feeds as well
            out = F.regexp_replace(out, *rule) if need is None else bind(out, _where_needed(rule, need))
    return F.trim(out)  # spaces are the only white space by now


def _where_needed(rule: tuple[str, str], need: str) -> Callable[[Column], Column]:
    return lambda t: F.when(_has(t, need), F.regexp_replace(t, *rule)).otherwise(t)


def _has(text: Column, need: str) -> Column:
    """Whether a text may hold what a rule looks for; rules without regard to case take the two other letters I as well."""
    if need == "edit":
        return F.lower(text).contains(need) | text.contains("\u0130") | text.contains("\u0131")
    return (F.lower(text) if need == "update" else text).contains(need)


def clean_dump(text: Column) -> Column:
    """The large-dump cleaner; null when the text is gone or shorter than 20 characters before or after."""
    done = lambda flat: F.when(F.length(flat) >= 20, strip(reduce(lambda t, rule: F.regexp_replace(t, *rule), DUMP_RULES, flat)))
    long = lambda x: F.when(F.length(x) >= 20, x)
    return F.when(text.isNotNull() & ~text.isin("", *GONE), bind(bind(strip(collapse(text)), done), long))


def key_post(title: Column, body: Column) -> Column:
    """Hash of lower-cased title and body with white space collapsed."""
    return F.md5(F.trim(collapse(F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(body, F.lit("")))))).cast("binary"))


def key_dump(text: Column) -> Column:
    """Hash of the lower-cased word characters."""
    return F.md5(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]+", "").cast("binary"))


def key_training(text: Column) -> Column:
    """Hash of the stripped lower-cased text; null for blank texts."""
    low = strip(F.lower(text))
    return F.when(low != "", F.md5(low.cast("binary")))


def is_spam(text: Column) -> Column:
    """Each pattern is tried where its words are in the text at all; ``text`` should be bound."""
    any_of = lambda group: reduce(Column.__or__, [text.contains(w) for w in group])
    found = [reduce(Column.__and__, [any_of((a or b).split("|")) for a, b in needs]) & text.rlike(f"(?d){pattern}") for pattern, needs in zip(SPAM, SPAM_NEEDS, strict=True)]
    return reduce(Column.__or__, found)


def repetitive(found: Column) -> Column:
    """Whether one of more than ten words makes up more than three tenths of them; ``found`` should be bound.

    Among the sorted words such a word fills more than ``step`` places in a row, so one of every ``step``-th place is its own.
    """
    step, many = F.floor(3 * F.size(found) / 10).cast("int"), F.size(found) > 10

    def fills(ordered: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(ordered) - 1, step)
        far = lambda w: F.get(ordered, (F.array_position(ordered, w) - 1).cast("int") + step)
        return F.exists(places, lambda at: bind(F.get(ordered, at), lambda w: F.coalesce(far(w) == w, F.lit(False))))

    return F.when(many, bind(F.sort_array(found), fills)).otherwise(False)


def tiers(value: Column, table: list[tuple[int, int]]) -> Column:
    """Points of the first bound that ``value`` exceeds."""
    return reduce(lambda c, t: c.when(value > t[0], t[1]), table[1:], F.when(value > table[0][0], table[0][1])).otherwise(0)


def score_article(content: Column, summary: Column, category: Column) -> Column:
    body = F.coalesce(content, F.lit(""))
    low = F.lower(body)
    marked = low.contains("==") | low.contains("category:") | low.contains("infobox") | low.contains("references")
    points = tiers(F.length(body), [(5000, 30), (2000, 20), (1000, 10)]) + F.when(F.length(summary) > 100, 10).otherwise(0)
    points += F.when(category != "", 5).otherwise(0) + F.when(body.contains("http") | body.contains("www."), 5).otherwise(0)
    points += F.when(marked, 5).otherwise(0) + F.when((body != "") & (F.size(F.split(body, r"\.", -1)) > 5), 5).otherwise(0)
    return F.least(points + tiers(word_count(body), [(1000, 10), (500, 5)]), F.lit(70)).cast("double")


def score_post(score: Column, comments: Column, body: Column, title: Column) -> Column:
    points = tiers(score, [(100, 20), (50, 15), (10, 10), (0, 5)]) + tiers(comments, [(50, 15), (20, 10), (5, 5)])
    points += tiers(word_count(body), [(200, 25), (100, 20), (50, 15), (20, 10)])
    return F.least(points + tiers(word_count(title), [(4, 10), (2, 5)]), F.lit(70)).cast("double")


def score_general(content: Column, title: Column) -> Column:
    points = tiers(word_count(content), [(500, 40), (200, 30), (100, 20), (50, 10)]) + F.when(title != "", 10).otherwise(0)
    return F.least(points, F.lit(50)).cast("double")


def dialogue(title: Column, body: Column) -> Column:
    """Question and answer if the title asks, topic and discussion otherwise, or the topic alone."""
    asked = F.concat(F.lit("Question: "), title, F.lit("\n\nAnswer: "), body)
    told = F.concat(F.lit("Topic: "), title, F.lit("\n\nDiscussion: "), body)
    return F.when(strip(body) == "", F.concat(F.lit("Topic: "), title)).when(title.contains("?"), asked).otherwise(told)


def article_text(title: Column, content: Column, summary: Column) -> Column:
    brief = F.when(F.length(strip(summary)) > 50, F.concat(F.lit("Summary: "), strip(summary), F.lit("\n\n"))).otherwise("")
    body = F.when(content != "", F.concat(F.lit("Content: "), strip(content))).otherwise("")
    return strip(F.concat(F.lit("Title: "), title, F.lit("\n\n"), brief, body))


def perplexity(loss: Column) -> Column:
    return F.exp(loss)


def eta(seconds: Column) -> Column:
    """``Hh Mm``; N/A for unknown or negative."""
    text = F.concat(F.floor(seconds / 3600).cast("string"), F.lit("h "), F.floor((seconds % 3600) / 60).cast("string"), F.lit("m"))
    return F.when(seconds.isNull() | (seconds < 0), "N/A").otherwise(text)
