"""Mixing sources to target weights by Pareto order sampling.

Targets: the sources' weights share all words; a target stops at ``MOST`` times
its source's words and the excess goes to the others by weight. Written in
closed form: with sources in order of (cap / weight), the capped ones are a
prefix, and the rest share what is left.

Copies: inside a source a document's expected copies are ``min(MOST, k *
sqrt(size))`` with the one ``k`` that makes expected words equal the target
(longer documents are favoured, gently; ``k`` comes from one pre-aggregated
histogram of sizes per source). The whole part of the expectation is certain:
that many copies are taken outright. The fraction left is the document's
inclusion probability ``p`` for one copy more, and Pareto order sampling draws
those: with ``u`` uniform from the document's key, documents are ranked by

    (u / (1 - u)) / (p / (1 - p))

and the smallest ranks are taken until the source's remaining words are used
up - a sample of fixed size (in words) with unequal probabilities. One closing
document, the one whose size is nearest to the gap, ends each source.

No source is ever sorted in one task: ranks fall into ``BUCKETS`` equal steps of
rank / (1 + rank); words per (source, bucket) are pre-aggregated, so buckets
below the cut are taken whole, and only the one bucket that holds the cut is
ranked row by row.

Defined results: sources in code point order with null last (null and empty
differ); a null or blank text has size 0, takes 0 words and 0 copies (in
``mix``); repeated rows are separate documents, told apart by an occurrence
number; with no words at all every target is 0; an empty table gives an empty
table. Reruns agree: every draw is a hash of (doc_id, text MD5, occurrence).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rtdw.llm.common import columns_of, fresh, stored, text_of, unit_draw, word_count

MOST = 3.0
WEIGHTS = (1.0, 2.0, 3.0)
BUCKETS = 1024
CLOSING = 2


def targets(sizes: DataFrame, weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """``sizes``: one row per (source, docs, words). Adds weight and target.
    One row per source: the windows below order sources, never documents."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (turn + 1).cast("int"))
    s = sizes.withColumn("weight", w).withColumn("cap", most * F.col("words"))
    by_need = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("all_words", F.sum("words").over(every).cast("double"))
          .withColumn("all_weight", F.sum("weight").over(every))
          .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
          .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # the level if this source and all later ones were free
    level = (F.col("all_words") - F.col("cap_before")) / (F.col("all_weight") - F.col("weight_before"))
    s = s.withColumn("level", level).withColumn("free", F.col("cap") >= F.col("level") * F.col("weight"))
    lowest = F.min(F.when(F.col("free"), F.struct("cap_before", "weight_before", "level"))).over(every)["level"]
    return s.withColumn("target", F.least(F.col("cap"), F.col("weight") * F.coalesce(lowest, F.lit(0.0)))).select(
        "source", "words", "weight", "target")


def factors(by_size: DataFrame, most: float = MOST) -> DataFrame:
    """Per source the ``k`` with sum(min(most, k * sqrt(size)) * size) = target.

    ``by_size``: rows (source, size, docs, target), one per distinct size, size
    above 0. With sizes falling, the documents at the limit are a prefix."""
    falling = Window.partitionBy("source").orderBy(F.col("size").desc())
    upto = falling.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("source")
    s = (by_size.withColumn("flat", F.col("docs") * F.col("size") * most)
                .withColumn("lift", F.col("docs") * F.col("size") * F.sqrt(F.col("size").cast("double"))))
    s = (s.withColumn("flat_before", F.coalesce(F.sum("flat").over(upto), F.lit(0.0)))
          .withColumn("lift_from", F.sum("lift").over(
              falling.rowsBetween(Window.currentRow, Window.unboundedFollowing))))
    k = (F.col("target") - F.col("flat_before")) / F.col("lift_from")
    s = s.withColumn("k", k).withColumn(
        "fits", F.col("k") * F.sqrt(F.col("size").cast("double")) <= most)
    first = F.max(F.when(F.col("fits"), F.struct("size", "k"))).over(every)["k"]
    return s.withColumn("k", first).groupBy("source").agg(F.first("k").alias("k"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def plan(docs: DataFrame, weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """One slim row per document: doc_id, source, digest, occurrence, size, the
    source's words and target, and ``copies`` taken."""
    t = text_of(docs)
    rows = docs.select("doc_id", "source", F.md5(t.cast("binary")).alias("digest"), word_count(t).alias("size"))
    rows = rows.withColumn("occurrence", F.row_number().over(
        Window.partitionBy("doc_id", "digest", "source").orderBy("size")))
    rows = stored(rows, "mix-sizes")
    by_size = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs"))
    sizes = by_size.groupBy("source").agg(F.sum(F.col("docs") * F.col("size")).alias("words"))
    goal = targets(sizes, weights, most)
    g = goal.select(F.col("source").alias("s0"), "words", "target")
    k = factors(by_size.join(g, _same(F.col("source"), F.col("s0"))).where("size > 0")
                .select("source", "size", "docs", "target"), most)
    by_source = goal.join(k.select(F.col("source").alias("s1"), "k"), _same(F.col("source"), F.col("s1")), "left")
    by_source = stored(by_source.select(F.col("source").alias("s"), "words", "target", "k"), "mix-sources")

    # Joins on the source: one row per source on one side; Spark broadcasts it
    # below its size limit and splits a hot source otherwise.
    expected = F.when(F.col("k").isNull(), F.lit(most)).otherwise(
        F.least(F.lit(most), F.col("k") * F.sqrt(F.col("size").cast("double"))))
    rows = rows.join(by_source, _same(F.col("source"), F.col("s")), "left").drop("s")
    rows = rows.withColumn("expected", F.when(F.col("size") > 0, expected).otherwise(F.lit(0.0)))
    rows = rows.withColumn("whole", F.floor("expected")).withColumn("p", F.col("expected") - F.col("whole"))
    u = unit_draw(F.col("doc_id"), F.col("digest"), F.col("occurrence"))
    rows = rows.withColumn("u", u)
    rank = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    rows = rows.withColumn("rank", F.when((F.col("p") > 0) & (F.col("size") > 0), rank))
    rows = rows.withColumn("step", F.floor(F.col("rank") / (1 + F.col("rank")) * BUCKETS).cast("int"))

    # words per source: certain ones, and per step of rank
    steps = rows.groupBy("source", "step").agg(
        F.sum(F.col("whole") * F.col("size")).alias("certain"), F.sum("size").alias("w"),
        F.first("target").alias("target"))
    by_rank = Window.partitionBy("source").orderBy(F.col("step"))
    steps = (steps.withColumn("left", F.col("target") - F.sum("certain").over(Window.partitionBy("source")))
             .where("step IS NOT NULL")
             .withColumn("before", F.coalesce(
                 F.sum("w").over(by_rank.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    cut = steps.where((F.col("before") <= F.col("left")) & (F.col("before") + F.col("w") > F.col("left")))
    cut = cut.groupBy("source").agg(F.min(F.struct("step", "before", "left")).alias("c"))
    cut = stored(cut.select(F.col("source").alias("s"), F.col("c")["step"].alias("cut_step"),
                            F.col("c")["before"].alias("before"), F.col("c")["left"].alias("room")), "mix-cut")
    rows = rows.join(cut, _same(F.col("source"), F.col("s")), "left").drop("s")
    # no cut: the fractions of all documents fit
    below = F.col("rank").isNotNull() & (F.col("cut_step").isNull() | (F.col("step") < F.col("cut_step")))
    at_cut = F.coalesce(F.col("step") == F.col("cut_step"), F.lit(False))
    order = ["rank", "doc_id", "digest", "occurrence"]
    at = rows.where(at_cut).withColumn("upto", F.col("before") + F.sum("size").over(
        Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    at = at.withColumn("taken_more", F.col("upto") <= F.col("room"))
    rest = rows.where(~at_cut).withColumn("upto", F.lit(None).cast("long")).withColumn("taken_more", below)
    drawn = stored(at.unionByName(rest), "mix-drawn")

    for _ in range(CLOSING):
        drawn = _closer(drawn, order)
    copies = F.col("whole") + F.when(F.col("taken_more"), F.lit(1)).otherwise(F.lit(0))
    return drawn.select("doc_id", "source", "digest", "occurrence", "size",
                        F.col("words").alias("source_size"), "target", copies.cast("long").alias("copies"))


def _closer(drawn: DataFrame, order: list[str]) -> DataFrame:
    """Turn the one document of each source - undrawn to drawn, or back - that
    brings the source's words nearest to its target, if any brings them nearer."""
    words = F.when(F.col("taken_more"), F.col("size")).otherwise(F.lit(0)) + F.col("whole") * F.col("size")
    gap = drawn.groupBy("source").agg((F.first("target") - F.sum(words)).alias("gap")).select(
        F.col("source").alias("s"), "gap")
    miss = F.abs(F.col("gap") + F.when(F.col("taken_more"), F.col("size")).otherwise(-F.col("size")))
    turn = (drawn.where(F.col("rank").isNotNull()).join(gap, _same(F.col("source"), F.col("s")))
            .where(miss < F.abs("gap"))
            .groupBy("source").agg(F.min(F.struct(miss.alias("miss"), *order)).alias("m"))
            .select(F.col("source").alias("s"), *(F.col("m")[c].alias(f"m_{c}") for c in order)))
    both = drawn.join(turn, _same(F.col("source"), F.col("s")), "left")
    turned = F.coalesce(_same(F.col("doc_id"), F.col("m_doc_id")) & (F.col("digest") == F.col("m_digest"))
                        & (F.col("occurrence") == F.col("m_occurrence")), F.lit(False))
    return stored(both.withColumn("taken_more", F.col("taken_more") != turned).select(*drawn.columns), "mix-closer")


def taken(docs: DataFrame, weights=WEIGHTS, most: float = MOST) -> DataFrame:
    p = plan(docs, weights, most)
    return p.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """The mixed corpus: each document as many times as the plan takes it, with
    the input's columns. Documents of no words take no part."""
    names = docs.columns
    d, o, c = fresh(docs, "_digest"), fresh(docs, "_occurrence"), fresh(docs, "_copies")
    p = plan(docs, weights, most).where("copies > 0").select(
        F.col("doc_id").alias(f"{c}id"), F.col("source").alias(f"{c}src"), F.col("digest").alias(f"{c}d"),
        F.col("occurrence").alias(f"{c}o"), F.col("copies").alias(c))
    rows = docs.withColumn(d, F.md5(text_of(docs).cast("binary")))
    rows = rows.withColumn(o, F.row_number().over(
        Window.partitionBy("doc_id", d, "source").orderBy(F.lit(1))))
    both = rows.join(p, _same(rows["doc_id"], F.col(f"{c}id")) & _same(rows["source"], F.col(f"{c}src"))
                     & (F.col(d) == F.col(f"{c}d")) & (F.col(o) == F.col(f"{c}o")))
    out = both.withColumn(c, F.explode(F.array_repeat(F.lit(1), F.col(c).cast("int"))))
    return out.select(*(F.col("`" + n.replace("`", "``") + "`") for n in names))
