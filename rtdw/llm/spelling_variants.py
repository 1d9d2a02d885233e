"""Spelling variants by a dictionary of trie-node pairs.

The words of the corpus are put in a forward trie and, reversed, in a second one,
and every node of either gets a number. A node of the first is a prefix, a node of
the second a suffix, so the integer pair (prefix node, suffix node) stands for a
split of a word:

* ``skip`` pairs leave one position out: (node of w[:i], node of w[i + 1:]);
* ``gap`` pairs leave nothing out: (node of w[:j], node of w[j:]), the place
  where a letter may be inserted.

Two words that share a skip pair differ by one replaced code point; a skip pair
of one that is a gap pair of another says that the second is the first with that
code point deleted. Nodes are numbered exactly (no hashes), so the pairs give the
exact neighbours. A pair is shared by at most one word per letter of the
alphabet (the skipped one) and the one word it spells: 26 + 64 letters and one,
whatever the corpus, so no group can grow hot and no pair list is unbounded.

Numbering needs no shared trie. The sorted words are dealt into ranges; in a
range, each word adds the nodes beyond its common prefix with the word before.
Only the prefixes that a range shares with the ranges before it have to be carried
over, which takes the first and the last word of each range (the driver folds
these: two rows per ``CHUNK`` words). The node that ends a word is larger the later
the word sorts, so it also serves as the word's id.

Chains of forms (``root``) end soon, as each step at least doubles the count; they
are followed by pointer doubling.

Defined results: a null text has no words; a null doc_id is written as nothing in
the hashed string; rows that repeat count as often as they stand; ties go to the
smallest word; an empty table gives an empty table; only doc_id and text are
read, so extra columns are harmless.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtdw.llm.common import pieces, stored

# Fixed values of the contract.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, FORM_FACTOR, SLIP = 5, 3, 2, 97
#: words per range of the numbering
CHUNK = 100_000
HELD = 200_000
LOWER = {c: c + 32 for c in range(65, 91)}


def _lower(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(LOWER)


def _count(least_length: int, slip: int):
    # a maximal run that is too short can give no word
    runs = re.compile(f"[{LETTERS}]{{{least_length},}}")

    def out(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                                          ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in pieces(batches, 1):
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                seed = zlib.crc32(b":" if doc is None else b"%d:" % doc)
                for raw, n in Counter(runs.findall(text)).items():
                    word = _lower(raw)
                    h = zlib.crc32(word.encode(), seed)
                    if h % slip == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least_length:
                            continue
                    found[word] += n
            if len(found) > HELD:
                yield out(found)
                found = Counter()
        if found:
            yield out(found)
    return run


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
               slip: int = SLIP) -> DataFrame:
    """word, n: the runs of letters, lower-cased and with the contract's slips, of at
    least so many code points and occurrences."""
    slim = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].cast("string").alias("text"))
    counted = slim.mapInArrow(_count(least_length, slip), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ------------------------------------------------------------------ tries --

def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


ROWS = "chunk int, edge boolean, used long, key string, rest long, nodes array<long>"


def _range_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of one sorted range, numbered from 0 (the root): per word the nodes of
    its prefixes, the empty one first. The first and the last row are marked."""
    chunk = TaskContext.get().partitionId()
    before, path, used = "", [0], 1
    rows: list[tuple] = []
    first = True

    def out(some: list[tuple]) -> pa.RecordBatch:
        edge, used_, key, rest, nodes = zip(*some)
        return pa.RecordBatch.from_arrays([
            pa.array([chunk] * len(some), pa.int32()), pa.array(edge, pa.bool_()), pa.array(used_, pa.int64()),
            pa.array(key, pa.string()), pa.array(rest, pa.int64()), pa.array(nodes, pa.list_(pa.int64()))],
            ["chunk", "edge", "used", "key", "rest", "nodes"])

    held = 0
    for b in batches:
        for key, rest in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            same = _common(before, key)
            fresh = len(key) - same
            path = path[:same + 1] + list(range(used, used + fresh))
            used += fresh
            rows.append((first, used, key, rest, path))
            before, first = key, False
            held += len(path)
            if held > 1_000_000:
                if len(rows) > 1:
                    yield out(rows[:-1])
                rows, held = rows[-1:], len(path)
    if rows:
        rows[-1] = (True, *rows[-1][1:])
        yield out(rows)


def trie(words: DataFrame, key: str, rest: str, chunks: int) -> DataFrame:
    """(key, rest, nodes): the trie nodes of the prefixes of each distinct key, from
    the root to the whole key, numbered over all keys."""
    spark = words.sparkSession
    ranged = words.select(F.col(key).alias("key"), F.col(rest).cast("long").alias("rest")) \
        .repartitionByRange(chunks, "key").sortWithinPartitions("key")
    local = stored(ranged.mapInArrow(_range_nodes, ROWS), "spelling-trie")
    # two rows a range at most, in order
    edges: dict[int, list] = {}
    for r in local.where("edge").orderBy("chunk", "used").collect():
        edges.setdefault(r["chunk"], []).append(r)
    offset, before, path, entries = 0, "", [0], []
    for chunk in sorted(edges):
        head, tail = edges[chunk][0], edges[chunk][-1]
        # nodes 0 to n of a range are the prefixes of its first word; those shared
        # with the range before keep their numbers
        carried = path[:_common(before, head["key"]) + 1]
        entries.append((chunk, offset, carried))
        path = [carried[x] if x < len(carried) else offset + x for x in tail["nodes"]]
        before, offset = tail["key"], offset + tail["used"]
    entry = spark.createDataFrame(entries, "chunk int, offset long, carried array<long>")
    number = lambda x: F.when(x < F.size("carried"), F.get("carried", x.cast("int"))).otherwise(
        F.col("offset") + x)
    return local.join(entry, "chunk").select("key", "rest", F.transform("nodes", number).alias("nodes"))


# ------------------------------------------------------------- neighbours --

def _pairs(prefix: Column, suffix: Column, letters: Column) -> Column:
    """All skip and gap pairs of a word of ``size(letters)`` code points; ``last`` marks
    the last position of a run of one letter, the one that stands for the run when a
    letter of it is deleted (the others spell the same word)."""
    n = F.size(letters)
    pair = lambda i, skipped, skip, last: F.struct(
        F.get(prefix, i).alias("prefix"), F.get(suffix, n - i - skipped).alias("suffix"),
        F.lit(skip).alias("skip"), last.alias("last"))
    skips = F.transform(F.sequence(F.lit(0), n - 1), lambda i: pair(
        i, 1, True, ~F.coalesce(F.get(letters, i) == F.get(letters, i + 1), F.lit(False))))
    gaps = F.transform(F.sequence(F.lit(0), n), lambda i: pair(i, 0, False, F.lit(False)))
    return F.concat(skips, gaps)


def numbered(vocab: DataFrame) -> DataFrame:
    """id, word, n, prefix (nodes of w[:0], w[:1], ...), suffix (nodes of the last 0,
    1, ... code points)."""
    many = vocab.count()
    # small ranges cost two rows each on the driver, large ones a longer task
    chunks = max(1, min(vocab.sparkSession.sparkContext.defaultParallelism, many // 2_000), -(-many // CHUNK))
    forward = stored(trie(vocab, "word", "n", chunks).select(
        F.element_at("nodes", -1).alias("id"), F.col("key").alias("word"), F.col("rest").alias("n"),
        F.col("nodes").alias("prefix")), "spelling-forward")
    backward = trie(forward.select("id", F.reverse("word").alias("key")), "key", "id", chunks)
    return forward.join(backward.select(F.col("rest").alias("id"), F.col("nodes").alias("suffix")), "id")


def neighbours(words: DataFrame) -> DataFrame:
    """id, n_near, best (n and id of the near word of largest count, the smallest of
    ties) of every word that has a near word."""
    split = words.select("id", "n", F.explode(_pairs(
        F.col("prefix"), F.col("suffix"), F.split("word", ""))).alias("p")).select("id", "n", "p.*")
    member = F.struct("id", "n", "skip", "last")
    groups = split.groupBy("prefix", "suffix").agg(F.collect_list(member).alias("m")).where(F.size("m") > 1)
    near = lambda t: F.filter("m", lambda o: (o["id"] != t["id"]) & (
        (t["skip"] & o["skip"]) | (t["skip"] & t["last"] & ~o["skip"]) | (~t["skip"] & o["skip"] & o["last"])))
    rows = groups.select("m", F.explode("m").alias("t")).select(
        F.col("t.id").alias("id"), near(F.col("t")).alias("near")).where(F.size("near") > 0)
    best = F.array_min(F.transform("near", lambda o: F.struct((-o["n"]).alias("less"), o["id"].alias("id"))))
    return rows.select("id", F.size("near").alias("k"), best.alias("best")).groupBy("id").agg(
        F.sum("k").alias("n_near"), F.min("best").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """(id, root) for links (id, up): pointer doubling, one round per doubling of the
    longest chain, and chains are no longer than the counts' logarithm."""
    links = stored(links, "spelling-links")
    while True:
        above = links.select(F.col("id").alias("up"), F.col("up").alias("further"))
        step = stored(links.join(above, "up", "left").select(
            "id", F.coalesce("further", "up").alias("up"), F.col("further").isNotNull().alias("moved")),
            "spelling-links")
        links = step.drop("moved")
        if step.where("moved").isEmpty():
            return links.withColumnRenamed("up", "root")


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
             factor: int = FORM_FACTOR, slip: int = SLIP) -> DataFrame:
    """Per word: word, n, n_near, form, form_n, root."""
    vocab = stored(vocabulary(docs, least_length, least_count, slip), "spelling-words")
    words = stored(numbered(vocab), "spelling-nodes")
    found = stored(neighbours(words), "spelling-near")
    named = words.select("id", "word", "n")
    up = F.when(-F.col("best.less") >= factor * F.col("n"), F.col("best.id"))
    linked = named.join(found, "id", "left").select("id", "word", "n", "n_near", up.alias("up"))
    roots = _roots(linked.where(F.col("up").isNotNull()).select("id", "up"))
    name = lambda *cols: named.select(*(F.col(a).alias(b) for a, b in cols))
    return linked.join(roots, "id", "left") \
        .join(name(("id", "up"), ("word", "form"), ("n", "form_n")), "up", "left") \
        .join(name(("id", "root"), ("word", "root_word")), "root", "left") \
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n",
                F.coalesce("root_word", "word").alias("root"))
