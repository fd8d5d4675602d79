"""Quality rules: a threshold table compiled into one Spark projection.

Method: every rule is a row ``(name, metric, least, most)``; :func:`measure`
computes all metrics of a text with built-in functions (no user code, no
shuffle: the plan is a scan and projections), and :func:`verdict` compiles the
table into one boolean.

Metrics: word length, symbols per word, share of stop words, shares of
repeated and of very short lines, share of words equal to the one before.

Defined results: a null text counts as empty; an empty text has no words and
fails the base test; repeated rows give repeated results; an empty table
gives an empty result; other columns of the input are neither read nor
returned by :func:`measure`, and kept as they are by :func:`keep`.  A text of
any length is measured whole; the repeated windows are found by sorting, so
its cost grows as n log n.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLANKS, fresh, only, replaced, settled, text_or_empty, words_of

# Fixed values of the base test.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30
#: Lines of fewer characters count as short.
SHORT_LINE = 12

# Frequent function words of English, French, German, Spanish.
STOP_WORDS = (
    "the of and to in a is that for on with as was at by it be are from or an this which not "
    "le la les de des du et en un une que qui dans est pour sur au aux pas par ce se "
    "der die das und ist von zu den mit auf für ein eine nicht dem im sich auch bei "
    "el los las y del al por con para su lo como más su es").split()


class Rule(NamedTuple):
    """``metric`` has to lie in ``least`` .. ``most`` (None: open)."""

    name: str
    metric: str
    least: float | None
    most: float | None


#: Production thresholds.
RULES = (
    Rule("word_length", "mean_word_chars", 3.0, 12.0),
    Rule("symbols", "symbol_ratio", None, 0.1),
    Rule("stop_words", "stop_ratio", 0.02, None),
    Rule("repeated_lines", "dup_line_ratio", None, 0.34),
    Rule("short_lines", "short_line_ratio", None, 0.7),
    Rule("same_words", "same_word_ratio", None, 0.3),
)


def _repeat_words(df: DataFrame, words: str, n: str, out: str) -> DataFrame:
    """Adds ``out``: words inside WINDOW-word windows found twice or more.

    Window hashes come from word hashes by doubling: one of two words from two
    of one, four from two, eight from four.  The last windows reach past the
    end and are cut off.
    """
    h, s, p = (fresh(df, f"{out}_{x}") for x in "hsp")
    no_rows = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.withColumn(h, F.transform(words, lambda w: F.xxhash64(w)))
    joined = lambda step: lambda x, i: F.xxhash64(x, F.get(F.col(h), i + step))
    for step in (1, 2, 4):
        df = df.withColumn(h, F.transform(h, joined(step)))
    df = df.withColumn(h, F.slice(h, 1, F.greatest(F.col(n).cast("int") - (WINDOW - 1), F.lit(0))))
    # Texts without a repeated window are settled by one hash set.
    df = df.withColumn(s, F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
        .otherwise(no_rows))
    same = lambda x, at: F.coalesce(F.get(F.col(s), at)["h"] == x["h"], F.lit(False))
    df = df.withColumn(p, F.sort_array(F.transform(
        F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"])))
    return df.withColumn(out, F.aggregate(
        F.transform(p, lambda x, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(F.col(p), i + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("bigint"), lambda a, x: a + x)).drop(h, s, p)


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            rules: Sequence[Rule] = RULES) -> DataFrame:
    """A row per document: id, base counts, ``base_failed``, the metrics,
    ``failed_rules`` (names) and ``kept``."""
    t = F.col("text")
    df = only(docs, [doc_id, text]).toDF("doc_id", "text")
    df = df.select("doc_id", text_or_empty(t).alias("text"))
    df = df.select(
        "doc_id", words_of(t).alias("words"),
        (F.length(t) - F.length(replaced(t, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split(t, "\n"), lambda x: F.length(replaced(x, BLANKS + " ", "")) > 0)
        .alias("lines"))
    df = df.withColumn("n_words", F.size("words").cast("bigint"))
    df = df.withColumns({
        "word_chars": F.length(F.array_join("words", "")).cast("bigint"),
        "n_lines": F.size("lines").cast("bigint"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        "n_short_lines": F.size(F.filter("lines", lambda x: F.length(x) < SHORT_LINE)).cast("bigint"),
        "n_stop": F.size(F.filter("words", lambda w: w.isin(*sorted(set(STOP_WORDS))))).cast("bigint"),
        "n_same": F.size(F.filter("words", lambda w, i: F.get("words", i - 1) == w)).cast("bigint"),
    })
    df = _repeat_words(df, "words", "n_words", "n_repeat_words").drop("words", "lines")
    n, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    df = df.withColumns({
        "base_failed": (F.col("n_words") < LEAST_WORDS)
        | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")),
        "mean_word_chars": F.col("word_chars") / n,
        "symbol_ratio": F.col("n_symbols") / n,
        "stop_ratio": F.col("n_stop") / n,
        "same_word_ratio": F.col("n_same") / n,
        "dup_line_ratio": F.col("n_dup_lines") / lines,
        "short_line_ratio": F.col("n_short_lines") / lines,
    })
    failed, passed = verdict(rules)
    df = settled(df).withColumns({"failed_rules": failed, "kept": ~F.col("base_failed") & passed})
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                     "n_repeat_words", "base_failed", "kept", "n_lines", "mean_word_chars",
                     "symbol_ratio", "stop_ratio", "same_word_ratio", "dup_line_ratio",
                     "short_line_ratio", "failed_rules")


def verdict(rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """The rules compiled: comma-joined names of failed rules, and whether
    none failed."""
    fails = []
    for r in rules:
        out = F.lit(False)
        if r.least is not None:
            out = out | (F.col(r.metric) < r.least)
        if r.most is not None:
            out = out | (F.col(r.metric) > r.most)
        fails.append((r.name, out))
    names = F.concat_ws(",", *[F.when(out, F.lit(name)) for name, out in fails])
    passed = F.lit(True)
    for _, out in fails:
        passed = passed & ~out
    return names, passed


def keep(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they were.  The rows ride
    through the projection as one struct; nothing is joined or shuffled."""
    row = F.struct(*[F.col(f"`{c}`").alias(str(i)) for i, c in enumerate(docs.columns)])
    judged = measure(docs.select(row.alias("row"), F.col(f"`{text}`").alias("text")), "row", "text", rules)
    return (judged.where("kept")
            .select(*[F.col("doc_id")[str(i)].alias(c) for i, c in enumerate(docs.columns)]))
