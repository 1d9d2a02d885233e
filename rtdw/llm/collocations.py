"""Phrase collocations by stripes.

A *stripe* belongs to a prefix of words and is an associative counter of the words
that follow it. Stripes of equal prefixes are merged elementwise. From a merged
stripe come

* the extensions: the counts of the phrases one word longer;
* the prefix total: the sum of the counter, the count of the prefix itself (word 0
  stands for "a piece ends here, or what follows is too rare to matter");
* the subsumption maximum: the largest count of an extension.

The empty prefix's stripe is the vocabulary, its total the number of words. Stripes of
one, two and three words follow, one pass over the texts each. A prefix gets a
stripe, and a follower a place in it, only if the level before found the phrase often
enough, so the millions of phrases that stand once are never shuffled. The level
before is consulted through a bit array (``sketch.py``) sized by the number of
phrases it holds, 64 MB at most: it may let a rare phrase through, which the exact
counts then drop, but never stops a frequent one.

Tasks merge what they read before the shuffle and send their stripes in buckets of
prefixes, one row a bucket, so a common prefix costs a task one stripe. The stripes of a prefix
that holds more than ``1 / HOT`` of all words are dealt over ``SEGMENTS`` buckets by the word that
follows. The number of buckets grows with the number of words, so a bucket stays of
a size; buckets are merged one after the other.

Words are known by a 64-bit hash of language and word. The vocabulary is checked for two
words of one hash (a second, independent hash tells them apart inside a task); if
there are any, the next seed is tried, so the counts are exact.

A candidate inside any longer one that is frequent enough is also inside one that is just
one word longer (whose count lies between the two), so the maxima over words that follow and
words that precede decide.

Defined results: a null text has no words, a null language is ``und``; repeated rows
count as often as they stand; an empty table gives an empty table; only lang and text
are read, so extra columns are harmless.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rtdw.llm import sketch
from rtdw.llm.common import pieces, stored
from rtdw.llm.wordhash import SEEDS, U, Words, mixed

# Fixed values of the contract.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
LONGEST, LEAST, TOP, SCALE = 4, 30, 2000, 2_000_000

BLOCK = 1 << 20        # bytes of text hashed at a time
HELD = 1_500_000       # entries a task holds before it merges them
WORDS_HELD = 600_000
HOT, SEGMENTS = 256, 64
PER_BUCKET, LEAST_BUCKETS = 500_000, 1024
ROUNDS = 64            # parts of a language in the first round of its ranking
KEYS = ["w1", "w2", "w3"]

_SPLIT = re.compile(b"[" + re.escape(BREAKS) + b"]")
_SEPARATES, _BREAKS = np.zeros(256, bool), np.zeros(256, bool)
_BREAKS[list(BREAKS)] = True
_SEPARATES[list(BREAKS + BLANKS)] = True


# -------------------------------------------------------------- in a task --

def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[bytes]]]:
    """Languages and texts, some 1 MB at a time; a longer text is cut at breaks,
    which no phrase crosses."""
    langs: list[str] = []
    texts: list[bytes] = []
    held = 0
    for b in pieces(batches, 1, BLOCK):
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            data = text.encode("utf-8", "replace") if text else b""
            while data:
                cut = _SPLIT.search(data, BLOCK) if len(data) > BLOCK else None
                end = cut.end() if cut else len(data)
                langs.append(lang)
                texts.append(data[:end])
                held += end
                data = data[end:]
                if held >= BLOCK:
                    yield langs, texts
                    langs, texts, held = [], [], 0
    if texts:
        yield langs, texts


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A hash per word, eight bytes at a time; the few words of more than 64 bytes
    one by one."""
    eights = np.ndarray((len(data),), "<u8", np.concatenate((data, np.zeros(8, np.uint8))), 0, (1,))
    size = ends - starts
    h = mixed(size.astype(np.uint64) + U(seed))
    at, some = starts, slice(None)
    for off in range(0, 64, 8):
        left = size[some] - off
        h[some] = mixed(h[some] ^ (eights[at + off] & _MASKS[np.minimum(left, 8)]))
        go = np.flatnonzero(left > 8)
        some = go if off == 0 else some[go]
        if not len(some):
            return h
        at = starts[some]
    key = (seed % (1 << 64)).to_bytes(8, "little")
    for k in np.flatnonzero(size > 64):
        digest = hashlib.blake2b(data[starts[k]:ends[k]].tobytes(), digest_size=8, key=key).digest()
        h[k] = int.from_bytes(digest, "little")
    return h


class _Tokens:
    """Ids (odd, so never 0) and piece numbers of the words of some texts."""

    def __init__(self, langs: list[str], texts: list[bytes], seed: int):
        self.words = w = Words(texts, lower=True, space=_SEPARATES)
        self.lang = np.repeat(np.arange(len(texts)), w.counts)
        salt = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(langs)}
        self.salt = np.array([salt[x] for x in langs], np.uint64)[self.lang]
        self.ids = self.hash(seed) | U(1)
        self.piece = np.searchsorted(np.flatnonzero(_BREAKS[w.data]), w.starts)

    def hash(self, seed: int) -> np.ndarray:
        return mixed(_hashes(self.words.data, self.words.starts, self.words.ends, seed) ^ self.salt)

    def spelt(self, at: np.ndarray) -> list[str]:
        raw = self.words.data.tobytes()
        return [raw[a:b].decode("utf-8", "replace")
                for a, b in zip(self.words.starts[at].tolist(), self.words.ends[at].tolist())]


def _seed(attempt: int) -> int:
    return SEEDS[0] + 2 * attempt


def _phrase_hash(columns: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = mixed(h + (c ^ U(SEEDS[1])))
    return h


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    """Flags of the rows that differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _summed(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of ``columns`` (a prefix and the word that follows) with the sums
    of ``n``, one prefix after the other. Rows are sorted by 32 bits of either part's hash; should two
    different rows share all 64, they are sorted by themselves."""
    *prefix, follow = columns
    key = (_phrase_hash(prefix) & ~U(0xFFFFFFFF)) | (mixed(follow) >> U(32))
    order = np.argsort(key)
    columns, key = [c[order] for c in columns], key[order]
    new = _changes(columns)
    if (new[1:] & (key[1:] == key[:-1])).any():
        again = np.lexsort(columns[::-1])
        columns, order = [c[again] for c in columns], order[again]
        new = _changes(columns)
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.add.reduceat(n[order], at) if len(at) else n


def _vocabulary(attempt: int):
    """(id, lang, word, n), summed over a task's blocks. Words of one id that a
    second hash tells apart give two rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        known = np.empty(0, np.uint64)          # a task's words, in order of their ids
        check = np.empty(0, np.uint64)
        new_ids: list[np.ndarray] = []
        names: list[tuple[list[str], list[str]]] = []

        def out() -> pa.RecordBatch:
            nonlocal ids, counts, new_ids, names, known, check
            spelt = np.concatenate(new_ids)
            every = np.concatenate(ids)
            order = np.argsort(every)
            cut = np.flatnonzero(_changes([every[order]]))
            total = np.add.reduceat(np.concatenate(counts)[order], cut)
            # a second word of an id carries no count of its own
            first = np.unique(spelt, return_index=True)[1]
            n = np.zeros(len(spelt), np.int64)
            n[first] = total
            done = pa.RecordBatch.from_arrays([
                pa.array(spelt.view(np.int64)), pa.array([x for a, _ in names for x in a], pa.string()),
                pa.array([x for _, b in names for x in b], pa.string()), pa.array(n)], ["id", "lang", "word", "n"])
            ids, counts, new_ids, names = [], [], [], []
            known = check = np.empty(0, np.uint64)
            return done

        for langs, texts in _texts(batches):
            t = _Tokens(langs, texts, _seed(attempt))
            if not len(t.ids):
                continue
            second = t.hash(SEEDS[1])
            order = np.argsort(t.ids)
            new = _changes([t.ids[order], second[order]])
            if new.sum() > _changes([t.ids[order]]).sum():
                order = np.lexsort((second, t.ids))
                new = _changes([t.ids[order], second[order]])
            at = order[new]                     # one token of each word
            first = _changes([t.ids[at]])       # ... and of each id
            starts = np.flatnonzero(new)[first]
            ids.append(t.ids[at[first]])
            counts.append(np.diff(np.append(starts, len(order))))
            place = np.minimum(np.searchsorted(known, t.ids[at]), max(len(known) - 1, 0))
            old = (known[place] == t.ids[at]) & (check[place] == second[at]) if len(known) else np.zeros(len(at), bool)
            at = at[~old]
            new_ids.append(t.ids[at])
            names.append(([langs[x] for x in t.lang[at].tolist()], t.spelt(at)))
            place = np.searchsorted(known, t.ids[at])
            known, check = np.insert(known, place, t.ids[at]), np.insert(check, place, second[at])
            if len(known) > WORDS_HELD:
                yield out()
        if ids:
            yield out()
    return run


STRIPES = "bucket int, w1 array<long>, w2 array<long>, w3 array<long>, many array<int>, next array<long>, n array<long>"


def _stripes(size: int, attempt: int, frequent_of, bits: int, hot: np.ndarray, buckets: int):
    """Stripes of the frequent prefixes of ``size`` words, merged over a task's blocks. A row
    holds all the task's stripes of one bucket: the prefixes, how many words follow
    each, and these with their counts."""
    def rows(columns: list[np.ndarray], n: np.ndarray) -> pa.RecordBatch:
        *prefix, follow = columns
        key = _phrase_hash(prefix)
        # a hot prefix is dealt by the words that follow as well
        cut = np.isin(key, hot)
        key[cut] += U(1) + mixed(follow[cut]) % U(SEGMENTS)
        bucket = (mixed(key) % U(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        prefix, follow, n, bucket = [c[order] for c in prefix], follow[order], n[order], bucket[order]
        of_bucket = _changes([bucket])
        of_stripe = of_bucket | _changes(prefix)
        stripes, starts = np.flatnonzero(of_stripe), np.flatnonzero(of_bucket)
        lists = lambda cuts, x: pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x))
        per_stripe = np.append(np.searchsorted(stripes, starts), len(stripes))
        per_word = np.append(starts, len(n))
        none = lists(np.zeros(len(starts) + 1, np.int32), np.empty(0, np.int64))
        keys = [lists(per_stripe, c[stripes].view(np.int64)) for c in prefix] + [none] * (3 - size)
        many = np.diff(np.append(stripes, len(n))).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[starts]), *keys, lists(per_stripe, many), lists(per_word, follow.view(np.int64)),
             lists(per_word, n)], ["bucket", *KEYS, "many", "next", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = lambda columns: sketch.test(frequent_of.value, _phrase_hash(columns), bits=bits)
        parts: list[tuple[list[np.ndarray], np.ndarray]] = []
        held = 0
        for langs, texts in _texts(batches):
            t = _Tokens(langs, texts, _seed(attempt))
            many = len(t.ids) - size + 1
            if many <= 0:
                continue
            grams = [t.ids[k:k + many] for k in range(size)]
            good = t.piece[:many] == t.piece[size - 1:]
            good[good] = frequent([g[good] for g in grams])
            follow = np.zeros(many, np.uint64)
            on = good[:-1] & good[1:] & (t.piece[:many - 1] == t.piece[size:])
            follow[:-1][on] = t.ids[size:][on]
            parts.append(([*(g[good] for g in grams), follow[good]], np.ones(int(good.sum()), np.int64)))
            held += len(parts[-1][1])
            if held > HELD:
                parts = [_joined(parts)]
                held = 0 if len(parts[0][1]) < HELD else len(parts[0][1])
                if held:
                    yield rows(*parts[0])
                    parts, held = [], 0
        if parts:
            columns, n = _joined(parts)
            if len(n):
                yield rows(columns, n)
    return run


def _joined(parts: list[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    return _summed([np.concatenate(c) for c in zip(*(p[0] for p in parts))], np.concatenate([p[1] for p in parts]))


MERGED = "w1 long, w2 long, w3 long, next long, n long, top long"


def _merge(size: int, least: int):
    """The rows of each bucket (they come one after the other), merged elementwise. Per
    stripe one row of word 0 with its total and its largest extension, and its
    frequent extensions."""
    def out(columns: list[np.ndarray], n: np.ndarray) -> pa.RecordBatch:
        *prefix, follow = columns
        cut = np.flatnonzero(_changes(prefix))
        total = np.add.reduceat(n, cut)
        extends = (follow != 0) & (n >= least)
        top = np.maximum.reduceat(np.where(extends, n, 0), cut)
        keys = [np.concatenate((c[cut], c[extends])).view(np.int64) for c in prefix]
        many, some = len(total), int(extends.sum())
        keys += [np.zeros(many + some, np.int64)] * (3 - size)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (
            *keys, np.concatenate((np.zeros(many, np.int64), follow[extends].view(np.int64))),
            np.concatenate((total, n[extends])), np.concatenate((top, np.zeros(some, np.int64))))],
            [*KEYS, "next", "n", "top"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[list[np.ndarray], np.ndarray]] = []
        held, last = 0, None
        for b in batches:
            for k, bucket in enumerate(b.column(0).to_pylist()):
                row = lambda i: b.column(i)[k].values.to_numpy()
                if bucket != last and held > HELD:
                    yield out(*_joined(parts))
                    parts, held = [], 0
                last = bucket
                many = row(4)
                parts.append(([*(np.repeat(row(i).view(np.uint64), many) for i in range(1, size + 1)),
                               row(5).view(np.uint64)], row(6)))
                held += len(row(6))
        if parts:
            yield out(*_joined(parts))
    return run


# ----------------------------------------------------------------- levels --

def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"),
                       docs["text"].cast("string").alias("text"))


def _counted(slim: DataFrame) -> tuple[DataFrame, int]:
    """The empty prefix's stripe: id, lang, word, n; and the seed's number."""
    attempt = 0
    while True:
        rows = slim.mapInArrow(_vocabulary(attempt), "id long, lang string, word string, n long")
        same = F.struct("lang", "word")
        vocab = stored(rows.groupBy("id").agg(F.sum("n").alias("n"), F.min(same).alias("w"), F.max(same).alias("z")),
                       "collocation-words")
        if vocab.where(F.col("w") != F.col("z")).isEmpty():
            return vocab.select("id", "w.lang", "w.word", "n"), attempt
        attempt += 1


def _level(slim: DataFrame, size: int, attempt: int, frequent: DataFrame, total: int, least: int) -> DataFrame:
    """The merged stripes of prefixes of ``size`` words; ``frequent``: those prefixes
    (w1, w2, w3, n)."""
    context = slim.sparkSession.sparkContext
    bits = sketch.bits_for(frequent.count(), 28)
    keys = lambda b: _phrase_hash([b.column(i).to_numpy().view(np.uint64) for i in range(size)])
    bitmap = context.broadcast(sketch.bit_array(sketch.build(frequent.select(*KEYS[:size]), keys, bits=bits), 1, bits=bits))
    # words that hold 1 / HOT of all words are at most HOT; longer phrases as well
    hot = frequent.where(F.col("n") * HOT >= total).select(*KEYS[:size]).collect()
    columns = [np.array([r[i] for r in hot], np.int64).view(np.uint64) for i in range(size)]
    buckets = max(LEAST_BUCKETS, total // PER_BUCKET)
    rows = slim.mapInArrow(_stripes(size, attempt, bitmap, bits, _phrase_hash(columns), buckets), STRIPES)
    # what falls to the segments of a hot prefix is summed afterwards
    return stored(rows.repartition("bucket").sortWithinPartitions("bucket")
                  .mapInArrow(_merge(size, least), MERGED), f"collocation-stripes{size}")


def _exact(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Per language its first ``top`` phrases of 2 to ``longest`` words: lang, rank, phrase,
    a, l, r, n, score."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    slim = _slim(docs)
    vocab, attempt = _counted(slim)
    totals = vocab.groupBy("lang").agg(F.sum("n").alias("n_words"))
    total = vocab.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    frequent = vocab.where(F.col("n") >= least).select(
        F.col("id").alias("w1"), F.lit(0).cast("long").alias("w2"), F.lit(0).cast("long").alias("w3"), "n")
    prefixes, phrases = None, None
    for size in range(1, longest):
        merged = _level(slim, size, attempt, frequent, total, least)
        known = merged.where("next = 0").groupBy(*KEYS).agg(
            F.sum("n").alias("f"), F.max("top").alias("top")).where(F.col("f") >= least)
        longer = merged.where("next <> 0").select(
            *KEYS[:size], F.col("next").alias(f"w{size + 1}"),
            *(F.lit(0).cast("long").alias(f"w{k}") for k in range(size + 2, 5)), F.lit(size + 1).alias("size"),
            F.col("n").alias("a"))
        prefixes = known if prefixes is None else prefixes.unionByName(known)
        phrases = longer if phrases is None else phrases.unionByName(longer)
        frequent = longer.select(*KEYS, F.col("a").alias("n"))

    prefixes = stored(prefixes, "collocation-prefixes")
    whole = ["w1", "w2", "w3", "w4"]
    # the largest count of a phrase with one word more before ...
    before = phrases.where("size > 2").groupBy(*(F.col(f"w{k + 1}").alias(f"w{k}") for k in (1, 2, 3))).agg(
        F.max("a").alias("before"))
    # ... and after; phrases of four words have no longer ones
    after = prefixes.select(*KEYS, "top")
    bound = F.greatest(F.coalesce("before", F.lit(0)), F.coalesce("top", F.lit(0)))
    short = phrases.where(F.col("size") < longest).join(before, KEYS, "left").join(after, KEYS, "left").where(
        _exact(bound) * 100 < _exact(F.col("a")) * 80).select(*whole, "size", "a")
    kept = stored(short.unionByName(phrases.where(F.col("size") == longest).select(*whole, "size", "a")),
                  "collocation-phrases")

    # every cut after k words: the counts of both parts
    word = lambda i, upto: F.when(i < upto, F.get(F.array(*whole), i)).otherwise(F.lit(0)).cast("long")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    left = [word(F.lit(i), F.col("k")).alias(f"l{i}") for i in range(3)]
    right = [word(F.col("k") + i, F.col("size")).alias(f"r{i}") for i in range(3)]
    cuts = cuts.select(*whole, "size", "a", "k", *left, *right)
    part = lambda side: prefixes.select(*(F.col(k).alias(f"{side}{i}") for i, k in enumerate(KEYS)),
                                        F.col("f").alias(side))
    cuts = cuts.join(part("l"), ["l0", "l1", "l2"]).join(part("r"), ["r0", "r1", "r2"])
    score = F.expr(f"(cast({SCALE} as decimal(8,0)) * cast(a as decimal(20,0))) div "
                   "(cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cuts.withColumn("score", score).groupBy(*whole, "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    spelt = scored.select("*", F.posexplode(F.filter(F.array(*whole), lambda w: w != 0)).alias("at", "id")) \
        .join(vocab.select("id", "lang", "word"), "id") \
        .groupBy(*whole, "a", "best").agg(F.min("lang").alias("lang"), F.array_join(F.transform(F.array_sort(
            F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    order = [F.col("best.score").desc(), F.col("a").desc(), F.col("phrase")]
    # ranked in two rounds, so that no task orders a whole language
    first = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(ROUNDS))).orderBy(*order)
    some = spelt.withColumn("place", F.row_number().over(first)).where(F.col("place") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")) \
        .where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"),
        F.col("n_words").alias("n"), F.col("best.score").cast("long").alias("score"))
