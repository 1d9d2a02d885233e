"""Quality rules: a threshold table compiled into one projection.

``measures`` lists the per-document figures as Column expressions,
``THRESHOLDS`` the bounds each figure must keep, and ``judge`` compiles the
table into one chain of projections over the documents: no shuffle, no user
function, each document on its own, so neither skew nor copies matter.

Defined results: a null text counts as empty; an empty or blank text has no
words and fails the base rule (fewer than 10 words); repeated rows are judged
row by row; an empty table gives an empty table; input columns are untouched
(the figures live in one struct column whose name the caller chooses).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtdw.llm.common import WORD, let, text_of, words_of

SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 5

# Frequent function words of the corpus languages (English,
# French, German, Spanish), as they stand in running text.
STOP_WORDS = (
    "the of and to in a is that it for on was be as with by at from this are or an not "
    "le la les de des du et un une que qui en est pour par dans pas sur "
    "der die das und zu den von mit für auf ist im nicht ein eine als dem "
    "el los las del y se por con para no su al lo"
).split()


@dataclass(frozen=True)
class Threshold:
    """``low <= figure <= high`` (an open side is None), for texts of at least
    ``min_words`` words; shorter ones pass."""

    figure: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


# Production thresholds. Ratios are per word, per character or per line.
THRESHOLDS = (
    Threshold("mean_word_chars", low=2.0, high=15.0),
    Threshold("symbols_per_word", high=0.3),
    Threshold("exclamations_per_word", high=0.5),
    Threshold("stop_word_ratio", low=0.01, min_words=50),
    Threshold("upper_ratio", high=0.5, min_words=20),
    Threshold("dup_line_ratio", high=0.5),
)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _count_of(text: Column, pattern: str) -> Column:
    """Characters in matches of ``pattern``, counted by what is left without them."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def triple_hashes(words: Column) -> Column:
    """At each word the 64-bit hash of it and the next two (fewer at the end)."""
    return F.transform(words, lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)))


def window_hashes(triples: Column) -> Column:
    """A hash of every five consecutive words: the triple that starts the window
    with the triple that ends it."""
    n = F.size(triples)
    return F.when(n < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.zip_with(F.slice(triples, 1, n - WINDOW + 1), F.slice(triples, 3, n - WINDOW + 1),
                   lambda a, b: F.xxhash64(a, b)))


def _covered(win: Column) -> Column:
    """Words inside windows that occur twice or more. Only texts whose windows
    are not all distinct sort them; equal neighbours give the positions, and a
    position covers the words up to the next one, five at most."""
    marked = let(
        F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
        lambda s: F.filter(s, lambda x, i: (F.get(s, i - 1)["h"].eqNullSafe(x["h"]))
                           | (F.get(s, i + 1)["h"].eqNullSafe(x["h"]))))
    width = let(
        F.sort_array(F.transform(marked, lambda x: x["p"])),
        lambda ps: F.aggregate(
            F.transform(ps, lambda p, i: F.coalesce(F.least(F.get(ps, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0), lambda a, x: a + x))
    return F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0)).otherwise(width).cast("long")


def figures(text: Column) -> Column:
    """Every figure of a text as one struct. Each intermediate array is bound once,
    so that Spark may move the expression (into a filter, say) as it likes."""
    def of(t, w, win):
        lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
        each = let(lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("distinct")))
        return let(each, lambda k: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _count_of(t, SYMBOLS).alias("n_symbols"),
            (k["all"] - k["distinct"]).cast("long").alias("n_dup_lines"),
            _covered(win).alias("n_repeat_words"),
            k["all"].cast("long").alias("n_lines"),
            F.size(F.filter(w, lambda x: x.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
            (F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))).cast("long").alias("n_exclamations"),
            _count_of(t, r"\p{Lu}+").alias("n_upper"),
        ))

    return let(text, lambda t: let(words_of(t), lambda w: let(triple_hashes(w), lambda h: let(
        window_hashes(h), lambda win: of(t, w, win)))))


def ratios(m: Column) -> dict[str, Column]:
    """The figures that thresholds name; a ratio over nothing is null and passes."""
    words, lines = m["n_words"], m["n_lines"]
    return {
        "mean_word_chars": F.try_divide(m["word_chars"], words),
        "symbols_per_word": F.try_divide(m["n_symbols"], words),
        "exclamations_per_word": F.try_divide(m["n_exclamations"], words),
        "stop_word_ratio": F.try_divide(m["n_stop_words"], words),
        "upper_ratio": F.try_divide(m["n_upper"], m["word_chars"]),
        "dup_line_ratio": F.try_divide(m["n_dup_lines"], lines),
    }


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def compiled(m: Column, thresholds=THRESHOLDS) -> Column:
    """The whole table as one boolean expression (true: every bound kept)."""
    r = ratios(m)
    passed = F.lit(True)
    for t in thresholds:
        for bound in ((r[t.figure] >= t.low) if t.low is not None else None,
                      (r[t.figure] <= t.high) if t.high is not None else None):
            if bound is not None:
                passed = passed & ((m["n_words"] < t.min_words) | F.coalesce(bound, F.lit(True)))
    return passed


def verdict(m: Column, thresholds=THRESHOLDS) -> Column:
    return ~base_failed(m) & compiled(m, thresholds)


def judge(docs: DataFrame, thresholds=THRESHOLDS, text_col: str = "text", into: str = "_quality") -> DataFrame:
    """``docs`` with the struct ``into``: every figure, ``base_failed``, ``kept``."""
    out = docs.withColumn(into, figures(text_of(docs, text_col)))
    m = F.col(into)
    return out.withColumn(into, m.withField("base_failed", base_failed(m)).withField("kept", verdict(m, thresholds)))


def keep_good(docs: DataFrame, thresholds=THRESHOLDS, text_col: str = "text") -> DataFrame:
    """The pipeline stage: documents that pass, with the input's columns."""
    return docs.where(let(figures(text_of(docs, text_col)), lambda m: verdict(m, thresholds)))
