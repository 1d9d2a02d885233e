"""Benchmark decontamination: SimHash of item-sized windows (native).

An item of m words is looked for in every window of m words of every document (a
shorter document is one window). Words are lower-cased; the shingles are five words
(a text of one to four words is one shingle), weighted by how often they occur.

1. Anchors. Document shingles that equal some benchmark shingle are found by one
   join. A similarity of 0.75 needs anchors at 6/7 of the window's places (``_need``),
   so only starts whose window holds that many are proposed. A window all of whose
   anchors (place p in the document, q in the item) have p - q above its start is no
   better than the next one, and one with all below no better than the one before:
   every start from the least to the greatest p - q of its window's anchors is
   proposed, so a best window always is, also between two diagonals.
   The anchors are a filter of places only: they say where a window of m words may hold
   an item of that size, not which.
2. Fingerprints. Each such window and each item gets a 64-bit SimHash: every
   shingle votes, by weight, on every bit. At similarity 0.75 two fingerprints differ
   in 11 bits on average (deviation 3), ``RADIUS`` allows 23.
3. Multi-index Hamming blocks. The 64 bits fall into ``BLOCKS`` blocks; two fingerprints
   within the radius differ in at most ``RADIUS // BLOCKS`` bits of one block at least. The index
   holds each item under every block value that near to its own; a window looks up its
   own values, by equal (size, block, value), and the bit count of the XOR decides. So
   every pair within the radius is found, in the first block that shows it.
4. Candidates are verified exactly: sum of least over sum of greatest weights of
   all shingles of window and item, 0.75 or more.

Everything is a DataFrame operation. Only anchors travel, not documents; the
benchmark side of the joins is small and is broadcast only if Spark's size check says
so. An anchor shingle that is in a third of all documents costs them one row each.

Defined results: null and blank texts and items have no shingles and match nothing;
items of one to four words match documents of the same words only; rows that
share doc_id and text count once, rows that share only the doc_id are told apart; an
empty documents or benchmark table gives an empty table; clashing extra columns are
harmless (only ids and texts are read).
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtdw.llm.common import columns_of, let, stored, text_of, words_of

SHINGLE = 5
RADIUS = 23
BLOCKS = 8
PERCENT = 75


def _shingles(words: Column) -> Column:
    """64-bit hashes of the five-word shingles, in order: the triple of words that
    starts a shingle with the triple that ends it. Bound once, wherever Spark
    moves the expression."""
    def long(w):
        n = F.size(w) - SHINGLE + 1
        triples = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return let(triples, lambda t: F.zip_with(
            F.slice(t, 1, n), F.slice(t, SHINGLE - 2, n), lambda a, b: F.xxhash64(a, b)))

    return let(words, lambda w: F.when(F.size(w) >= SHINGLE, long(w))
               .when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " "))))
               .otherwise(F.array().cast("array<bigint>")))


def _shingled(df: DataFrame, text: str, keep: list[Column]) -> DataFrame:
    """``keep``, the words' number ``n`` and the shingles ``sh``."""
    words = df.select(*keep, words_of(F.lower(text_of(df, text))).alias("w"))
    names = [c for c in words.columns if c != "w"]
    return words.select(*names, F.size("w").alias("n"), _shingles(F.col("w")).alias("sh"))


def _simhash(sh: Column) -> Column:
    """Bit b is set when at least half of the (repeated) shingles have it set."""
    votes = lambda b: F.aggregate(
        sh, F.lit(0), lambda acc, h: acc + F.getbit(h, b).cast("int"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"),
        lambda acc, b: acc.bitwiseOR(F.when(2 * votes(b) >= F.size(sh), F.call_function(
            "shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))))


def _block(print_: Column, j: int) -> Column:
    """The value of block j of the 64 bits."""
    low, high = 64 * j // BLOCKS, 64 * (j + 1) // BLOCKS
    return F.shiftrightunsigned(print_, low).bitwiseAND(F.lit((1 << (high - low)) - 1).cast("long"))


def _near_masks(j: int, most: int) -> list[int]:
    """What may differ in block j: all masks of at most ``most`` bits."""
    width = 64 * (j + 1) // BLOCKS - 64 * j // BLOCKS
    return [sum(1 << b for b in some) for k in range(most + 1) for some in combinations(range(width), k)]


def _common(a: Column, b: Column) -> Column:
    """Sum over all shingles of the lesser of the two counts."""
    each = lambda s, x: F.size(F.filter(s, lambda y: y == x))
    distinct = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    counted = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda acc, x: acc + F.least(each(a, x), each(b, x)))
    return F.when(distinct, F.size(F.array_intersect(a, b))).otherwise(counted)


def _need(n: Column, item_size: Column, percent: int) -> Column:
    """The least number of common shingles that gives the similarity, in a
    document of n words."""
    both = item_size + F.least(item_size, F.greatest(n - SHINGLE + 1, F.lit(1)))
    return F.greatest(F.lit(1), F.ceil(percent * both / (100 + percent)).cast("int"))


def _starts() -> Column:
    """The starts proposed for a (document, item), each once: from the columns
    ``places`` (p, low, high: least and greatest p - q), n, m, item_size and need."""
    places, size, need = F.col("places"), F.col("item_size"), F.col("need")
    last = F.greatest(F.lit(0), F.col("n") - F.col("m"))

    def proposed(s, i):
        inside = F.filter(F.slice(places, i + 1, size), lambda y: y["p"] < s + size)
        return let(inside, lambda ys: ((s >= last) | F.exists(ys, lambda y: y["low"] <= s))
                   & ((s <= 0) | F.exists(ys, lambda y: y["high"] >= s)))

    def first_at(x, i):
        # starts whose window has place i as its first and holds ``need`` places
        low = F.greatest(F.coalesce(F.get(places, i - 1)["p"] + 1, F.lit(0)), F.get(places, i + need - 1)["p"] - size + 1)
        high = F.least(x["p"], last)
        enough = F.get(places, i + need - 1).isNotNull() & (low <= high)
        return F.when(enough, F.filter(F.sequence(low, high), lambda s: proposed(s, i))).otherwise(
            F.array().cast("array<int>"))

    return F.flatten(F.transform(places, first_at))


def _meetings(windows: DataFrame, prints: DataFrame, radius: int) -> DataFrame:
    """Windows (doc_id, text_key, m, start, print) with the items of their size whose
    fingerprint lies within the radius, each once."""
    most = radius // BLOCKS
    left = windows.select("doc_id", "text_key", "m", "start", "print", F.posexplode(
        F.array(*(_block(F.col("print"), j) for j in range(BLOCKS)))).alias("block", "value"))
    near = F.array(*(F.array(*(_block(F.col("item_print"), j).bitwiseXOR(F.lit(x).cast("long"))
                               for x in _near_masks(j, most))) for j in range(BLOCKS)))
    index = prints.select("item_id", "m", "item_print", F.posexplode(near).alias("block", "values")).select(
        "item_id", "m", "item_print", "block", F.explode("values").alias("value"))
    differ = F.col("print").bitwiseXOR(F.col("item_print"))
    # the first block that shows the pair: no block before it is that near
    first = F.lit(BLOCKS)
    for j in range(BLOCKS - 1, -1, -1):
        first = F.when(F.bit_count(_block(differ, j)) <= most, F.lit(j)).otherwise(first)
    return left.join(index, ["m", "block", "value"]).where(
        (F.bit_count(differ) <= radius) & (first == F.col("block"))).select("doc_id", "text_key", "m", "start", "item_id")


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """One row per (document, item) found: doc_id, text_key, item_id, start (first
    word of the best window), words (its length), similarity."""
    items = stored(_shingled(benchmark, "text", [benchmark["item_id"]]).where("n > 0"), "decontaminate-items")
    item_side = items.select("item_id", F.col("n").alias("m"), F.size("sh").alias("item_size"),
                             F.posexplode("sh").alias("q", "h"))
    keyed = [docs["doc_id"], F.xxhash64(text_of(docs)).alias("text_key")]
    shingled = _shingled(docs, "text", keyed)
    # outer: a plain explode makes Spark infer a filter that hashes every text twice
    pair = ["doc_id", "text_key", "item_id"]
    sizes = ["n", "m", "item_size"]
    anchors = shingled.select("doc_id", "text_key", "n", F.posexplode_outer("sh").alias("p", "h")).join(item_side, "h")
    # a place once, whatever the rows or shingles that repeat: at most n of them in a list
    places = anchors.groupBy(*pair, *sizes, "p").agg(F.max("q").alias("most"), F.min("q").alias("least")).groupBy(
        *pair, *sizes).agg(F.sort_array(F.collect_list(F.struct(
            "p", (F.col("p") - F.col("most")).alias("low"), (F.col("p") - F.col("least")).alias("high")))).alias("places"))
    places = places.withColumn("need", _need(F.col("n"), F.col("item_size"), percent)).where(F.size("places") >= F.col("need"))
    windows = stored(places.select(*pair, "m", F.explode_outer(_starts()).alias("start")).where(
        "start is not null"), "decontaminate-starts")

    # a place and a size once, whatever the items that have anchors there
    wd = windows.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t"), "m", "start").distinct()
    wide = docs.select(*keyed, text_of(docs).alias("text"))
    # the texts are shuffled once, whatever the number of ids: it grows with the corpus
    ids = wd.select("_d", "_t").distinct().hint("merge")
    held = wide.join(ids, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t")), "left_semi")
    held = stored(_shingled(held, "text", [F.col("doc_id"), F.col("text_key")]).dropDuplicates(["doc_id", "text_key"]),
                  "decontaminate-held")
    cut = F.slice(F.col("sh"), F.col("start") + 1, F.greatest(F.lit(1), F.col("m") - SHINGLE + 1))
    framed = held.join(wd, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t"))).select(
        "doc_id", "text_key", "m", "start", cut.alias("window"))
    framed = stored(framed.withColumn("print", _simhash(F.col("window"))), "decontaminate-windows")

    prints = items.select("item_id", F.col("n").alias("m"), F.col("sh").alias("item"), _simhash(F.col("sh")).alias("item_print"))
    # items that repeat their id and fingerprint meet a window once
    near = stored(_meetings(framed, prints, radius).distinct(), "decontaminate-near")
    n = near.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t"), F.col("m").alias("_m"),
                    F.col("start").alias("_s"), "item_id")
    both = framed.join(n, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t"))
                       & (F.col("m") == F.col("_m")) & (F.col("start") == F.col("_s"))).join(
        prints.select(F.col("item_id").alias("_i"), "item"), F.col("item_id").eqNullSafe(F.col("_i")))
    common = _common(F.col("window"), F.col("item"))
    judged = both.withColumn("common", common).withColumn(
        "union", F.size("window") + F.size("item") - F.col("common")).where(
        100 * F.col("common") >= percent * F.col("union"))
    best = judged.groupBy(*pair).agg(F.min(F.struct(
        (-F.col("common") / F.col("union")).alias("s"), "start", "m")).alias("x"))
    return best.select("doc_id", "text_key", "item_id", F.col("x")["start"].cast("long").alias("start"),
                       F.col("x")["m"].cast("long").alias("words"), (-F.col("x")["s"]).alias("similarity"))


def clean(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """The documents in which no item is found, with the input's columns."""
    found = contaminated(docs, benchmark, percent, radius).select(
        F.col("doc_id").alias("_found_doc"), F.col("text_key").alias("_found_text")).distinct().hint("merge")
    same = docs["doc_id"].eqNullSafe(found["_found_doc"]) & (F.xxhash64(text_of(docs)) == found["_found_text"])
    return docs.join(found, same, "left_anti").select(*columns_of(docs))
