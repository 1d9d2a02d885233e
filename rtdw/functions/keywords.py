"""Search-keyword tokenizer (UDF1, UDF2) and the lateral keyword join.

The reference segments search text with a Chinese/Latin analyzer in smart
mode, one JVM call per row. Here tokenizing is a native column expression:
lower-case the whole text and extract runs of ASCII letters and digits (what
that analyzer yields for Latin text: letters and digits form tokens, other
characters separate them). Han characters can optionally be emitted one per
token; with a caller-supplied dictionary the longest words are matched over a prefix
tree in Arrow batches. The
Python UDTF exists only so SQL users can keep writing
``LATERAL TABLE(ik_analyze(text))``-style queries; pipelines use the native
expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LATIN_TOKEN = "[a-z0-9]+"
HAN_CHAR = "\\p{IsHan}"
#: of a dictionary; ten million, some hundred MB as a tree in a worker
MOST_CHARACTERS = 10_000_000


def token_pattern(han: bool = False) -> str:
    """Regex for ``regexp_extract_all``: Latin runs, then (optionally) single Han characters."""
    return "|".join([LATIN_TOKEN] + ([HAN_CHAR] if han else []))


def tokenize(text, han: bool = False, dictionary: Sequence[str] = ()) -> Column:
    """UDF2 as a column: array of tokens of the whole text. With a dictionary, its words are
    taken first, the longest that fits, then Latin runs, then Han characters."""
    c = F.lower(F.col(text) if isinstance(text, str) else text)
    if dictionary:
        return segmenter(dictionary, han)(c)
    return F.regexp_extract_all(c, F.lit(token_pattern(han)), 0)


def prefix_tree(words: Iterable[str]) -> dict:
    """Nested dictionaries by character; the empty key ends a word."""
    root: dict = {}
    for w in words:
        node = root
        for ch in w:
            node = node.setdefault(ch, {})
        if w:
            node[""] = True
    return root


def segments(text: str, tree: dict, other: re.Pattern) -> list[str]:
    """At each place the longest word of the tree, else what ``other`` matches there, else
    nothing; the next place is behind what was taken."""
    out, at, n = [], 0, len(text)
    while at < n:
        node, end, i = tree, 0, at
        while i < n and (node := node.get(text[i])) is not None:
            i += 1
            if "" in node:
                end = i
        if not end:
            m = other.match(text, at)
            end = m.end() if m else 0
        if end:
            out.append(text[at:end])
        at = end or at + 1
    return out


def segmenter(dictionary: Sequence[str], han: bool = False):
    """A pandas function of lower-cased text: longest match over a prefix tree, in Arrow batches. The
    dictionary is sent to every worker, so its size is bounded (``MOST_CHARACTERS``)."""
    words = sorted({w.lower() for w in dictionary})
    if sum(map(len, words)) > MOST_CHARACTERS:
        raise ValueError(f"a dictionary has at most {MOST_CHARACTERS} characters")
    held = SparkSession.active().sparkContext.broadcast(words)
    pattern = LATIN_TOKEN + ("|[\u2e80-\u2fdf\u3005\u3007\u3021-\u3029\u3038-\u303b\u3400-\u4dbf\u4e00-\u9fff"
                             "\uf900-\ufad9\U00020000-\U000323af]" if han else "")

    @F.pandas_udf("array<string>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tree, other = prefix_tree(held.value), re.compile(pattern)
        for texts in batches:
            yield texts.map(lambda t: None if t is None else segments(t, tree, other))

    return cut


def explode_keywords(df: DataFrame, text_col: str, out: str = "keyword",
                     han: bool = False, dictionary: Sequence[str] = ()) -> DataFrame:
    """One row per token; rows without tokens (or NULL text) drop out,
    like an inner lateral join with a table function."""
    keep = [c for c in df.columns if c != text_col]
    return df.select(*keep, F.explode(tokenize(text_col, han, dictionary)).alias(out))


def register_udtf(spark: SparkSession, name: str = "ik_analyze") -> None:
    """UDF1: register ``name(text) -> word`` as a SQL table function."""
    from pyspark.sql.functions import udtf

    pattern = re.compile(token_pattern())

    @udtf(returnType="word string")
    class Analyze:
        def eval(self, text: str | None) -> Iterable[tuple[str]]:
            if text is None:
                return
            for tok in pattern.findall(text.lower()):
                yield (tok,)

    spark.udtf.register(name, Analyze)
