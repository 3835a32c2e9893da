"""Operator 2: line-first quality rules, in DataFrame functions only.

Every line of a text is judged by itself: *punctuation* (symbols or exclamation
marks at most of its words), *navigation* (menus split by bars, upper-case
banners) and *boilerplate* (stock phrases, a few words over and over, or a line
seen earlier in the text). Failing lines are removed; a document that loses more
than ``max_lost`` of its characters is rejected, as is one that fails the base
counts. All rules are row-local: no shuffle, whatever the size of a source or a
group of copies.

Defined results: a null or empty text has no words, fails the base and is not
kept; null ids pass through; repeated rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the base counts
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SPACES = " \t\x0b\x0c\r"                 # separators inside a line
SPACES_RE = r"[\x20\x09\x0B-\x0D]+"
# Stock phrases of web pages (boilerplate rule)
PHRASES = ("all rights reserved|terms of use|terms of service|privacy policy|cookie policy|use of cookies|"
           "accept cookies|lorem ipsum|javascript is disabled|enable javascript|skip to content|"
           "subscribe to our newsletter|click here|powered by|back to top|share this")
# Thresholds of the line rules; *_PERCENT of a line's words
SYMBOL_PERCENT = 50                      # punctuation: symbols
MARK_PERCENT = 50                        # punctuation: exclamation and question marks
BANNER_WORDS = 4                         # navigation: upper-case lines of so many words
REPEAT_LINE_WORDS, DISTINCT_PERCENT = 20, 25   # boilerplate: distinct words of a longer line
PHRASE_CHARS = 300                       # boilerplate: stock phrases count in lines up to here
MAX_LOST_PERCENT = 30


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _lines(text: Column) -> Column:
    """array<struct<line, w>>: the lines and their words."""
    def words(line):
        inner = F.btrim(line, F.lit(SPACES))
        return F.struct(line.alias("line"), F.when(F.length(inner) > 0, F.split(inner, SPACES_RE))
                        .otherwise(F.array().cast("array<string>")).alias("w"))
    return F.transform(F.split(text, "\n"), words)


def _measured(x: Column) -> Column:
    line, w = x["line"], x["w"]
    return F.struct(line.alias("line"), F.size(w).alias("n"),
                    F.when(F.size(w) >= REPEAT_LINE_WORDS, F.size(F.array_distinct(w))).alias("distinct"),
                    _count(line, SYMBOLS).alias("symbols"), _count(line, "|").alias("bars"),
                    _count(line, "!?").alias("marks"))


def _rule(x: Column) -> Column:
    """0 kept, 1 punctuation, 2 navigation, 3 boilerplate."""
    line, n = x["line"], x["n"]
    return (F.when(n == 0, 0)
            .when((x["bars"] * 200 > SYMBOL_PERCENT * n) & (x["bars"] * 2 > x["symbols"]), 2)
            .when(x["symbols"] * 100 > SYMBOL_PERCENT * n, 1)
            .when(x["marks"] * 100 > MARK_PERCENT * n, 1)
            .when((n >= BANNER_WORDS) & (line == F.upper(line)) & (line != F.lower(line)), 2)
            .when(F.coalesce(x["distinct"] * 100 < DISTINCT_PERCENT * n, F.lit(False)), 3)
            .when((F.length(line) <= PHRASE_CHARS) & F.lower(line).rlike(PHRASES), 3)
            .otherwise(0))


def quality_rules(docs: DataFrame, text_col: str = "text", max_lost_percent: int = MAX_LOST_PERCENT,
                  clean_text: bool = True, out: str = "quality") -> DataFrame:
    """The input's columns plus a struct ``out`` (in place of an input column of that name): ``n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, lines`` and ``removed`` counts, ``lost_percent``,
    ``base_failed``, ``kept`` and, with ``clean_text``, ``clean_text`` (the lines that passed)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = F.struct(*[F.col(c) for c in docs.columns if c != out]).alias("row")
    # one projection a step: an array that lambdas read often is made once
    x = docs.select(own, text.alias("t"), _lines(text).alias("lines"))
    x = x.select("row", "t", F.flatten(F.transform("lines", lambda v: v["w"])).alias("w"),
                 F.transform("lines", _measured).alias("lines"))
    n = F.size("w")
    w = F.col("w")
    x = x.select(
        "row", "t", "lines", n.alias("n_words"),
        F.length(F.translate("t", SPACES + "\n", "")).alias("word_chars"),
        F.when(n >= 3, F.slice(F.transform(w, lambda a, i: F.xxhash64(a, F.get(w, i + 1), F.get(w, i + 2))), 1, n - 2))
        .otherwise(F.array().cast("array<bigint>")).alias("h"))
    x = x.select("*", F.transform("lines", lambda v: F.struct(
        v["line"].alias("line"), v["n"].alias("n"), _rule(v).alias("rule"))).alias("judged"),
        F.when(F.size(F.array_distinct("h")) == F.size("h"), F.array().cast("array<struct<h:bigint,i:int>>"))
        .otherwise(F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("s"))
    s = F.col("s")
    x = x.select("row", "t", "n_words", "word_chars", "judged", F.sort_array(F.transform(
        F.filter(s, lambda v, k: (v["h"] == F.get(s, k - 1)["h"]) | (v["h"] == F.get(s, k + 1)["h"])),
        lambda v: v["i"])).alias("at"))
    at, judged = F.col("at"), F.col("judged")
    worded = F.filter(judged, lambda v: v["n"] > 0)
    x = x.select("row", "t", "n_words", "word_chars",
                 F.aggregate(F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))),
                             F.lit(0).cast("long"), lambda acc, v: acc + v).alias("n_repeat_words"),
                 worded.alias("worded"))
    x = x.select("*", F.array_distinct(F.transform("worded", lambda v: v["line"])).alias("firsts"),
                 F.array_distinct(F.filter("worded", lambda v: v["rule"] == 0)).alias("passed"))
    chars = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda acc, v: acc + F.length(v["line"]))
    x = x.select("row", "t", "n_words", "word_chars", "n_repeat_words",
                 (F.size("worded") - F.size("firsts")).alias("n_dup_lines"), F.size("worded").alias("n_lines"),
                 F.size("passed").alias("n_passed"), chars(F.col("worded")).alias("all_chars"),
                 chars(F.col("passed")).alias("left_chars"), F.transform("passed", lambda v: v["line"]).alias("passed"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    lost = F.col("all_chars") - F.col("left_chars")
    # exploding the one struct keeps a later filter on it from being pushed below, where
    # it would make every array above anew
    return x.select("row", F.explode(F.array(F.struct(
        F.col("n_words").cast("long").alias("n_words"), F.col("word_chars").cast("long").alias("word_chars"),
        _count(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"), F.col("n_dup_lines").cast("long").alias("n_dup_lines"),
        F.col("n_repeat_words").alias("n_repeat_words"), F.col("n_lines").cast("long").alias("lines"),
        (F.col("n_lines") - F.col("n_passed")).cast("long").alias("removed"),
        F.col("all_chars").alias("chars"), lost.alias("lost_chars"), failed.alias("base_failed"),
        (~failed & (100 * lost <= max_lost_percent * F.col("all_chars"))).alias("kept"),
        (F.array_join("passed", "\n") if clean_text else F.lit(None).cast("string")).alias("clean_text")))).alias("judgement")).select(
            *[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != out], F.col("judgement").alias(out))
