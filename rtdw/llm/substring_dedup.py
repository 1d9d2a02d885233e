"""Substring dedup: windows of 20 words, count-min prefilter, exact grouping.

Pass 1 fills a count-min sketch (``sketch.py``) with two kinds of keys: the whole
word sequence of each text, and per window of 20 words its minimizer, the 10-word
gram of smallest hash in it. Equal windows have equal minimizers at equal offsets,
so the sketch's count of a window's minimizer is never below the window's own
count: the estimate errs upwards only, with a sixth of the cells.

Pass 2 hashes the windows again and emits those estimated repeated; they are
grouped exactly (96-bit window hashes): the earliest start of each window by a
partially aggregated minimum, every other start is a repeat. None is lost.

Texts estimated to share their whole word sequence with another are split off
and classed exactly: with 20 words or more, each word of a later copy lies in a
window that starts earlier in the first one; with fewer there is no window.
So a group of copies that holds a third of the corpus costs one representative.

The bit arrays that are broadcast have a fixed size, not the corpus's.

Defined results: a null or blank text has no words (the hash is that of the empty
text); a start is earlier only if its doc_id or its position is smaller, so
repeated rows keep their words, but each row has its own windows: rows are known by id and
text; the text's digest is only carried where an id stands with several texts; null ids come last, as one document; an empty table gives an empty table;
clashing extra columns are harmless (only the id and the text are read).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtdw.llm import sketch
from rtdw.llm.common import pieces, stored, words_of
from rtdw.llm.wordhash import SEEDS, U, Words, mixed

WINDOW = 20
# a row of ``slim``: id, digest of the text, text
ROW = ["id", "digest"]
TEXT = 2
PIECE = 1 << 19


def _texts(column: pa.Array) -> list[bytes]:
    return [t.encode("utf-8", "replace") if t else b"" for t in column.to_pylist()]


def _sliding(values: np.ndarray, size: int, op) -> np.ndarray:
    """``op`` over values[i : i + size] (the ends see fewer)."""
    out, have = values.copy(), 1
    while have < size:
        step = min(have, size - have)
        out[:-step or None] = op(out[:-step or None], out[step:]) if step < len(out) else out[:-step or None]
        have += step
    return out


def _minimizers(w: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (their first words), each window's smallest gram hash, and the
    hashes of all grams that are smallest in some window, one per position."""
    gram = max(1, size // 2)
    many = size - gram + 1
    g = w.runs(hashes, gram, SEEDS[0])
    windows = w.has_run(size)
    low = _sliding(g, many, np.minimum)
    low[~windows] = 0
    # a gram is smallest in a window that covers it: the largest of these minima
    high = _sliding(low[::-1].copy(), many, np.maximum)[::-1]
    chosen = (high == g) & (high > 0)
    at = np.flatnonzero(windows)
    return at, low[at], g[chosen]


def _whole(w: Words, hashes: np.ndarray) -> np.ndarray:
    return mixed(w.whole(hashes, SEEDS[0]) ^ U(SEEDS[1]))


def _keys(size: int):
    def keys(b: pa.RecordBatch) -> np.ndarray:
        w = Words(_texts(b.column(TEXT)))
        h = w.hashes(SEEDS[0])
        return np.concatenate((_whole(w, h), _minimizers(w, h, size)[2]))
    return keys


def _window_key(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return mixed(one ^ (two << U(16)))


def _window_keys(b: pa.RecordBatch) -> np.ndarray:
    return _window_key(b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy().view(np.uint32).astype(np.uint64))


def _told_apart(b: pa.RecordBatch, several_of, several_bits: int) -> pa.RecordBatch:
    """The batch with the digest 0 where the id has one text only: most ids, whose rows then
    shuffle no digest. (A bit array that lets more through keeps more digests.)"""
    keep = sketch.test(several_of.value, _id_key(b), bits=several_bits)
    digest = b.column(1).to_numpy(zero_copy_only=False)
    return b.set_column(1, "digest", pa.array(np.where(keep, digest, 0)))


def _windows(several: tuple, size: int, bits_of, skip_shared: bool, only_of=None, only_bits: int = 0):
    """The windows estimated repeated; with ``only_of``, of these the ones whose hashes are in
    that bit array."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bits_of.value
        for b in pieces(batches, TEXT, PIECE):
            b = _told_apart(b, *several)
            w = Words(_texts(b.column(TEXT)))
            h = w.hashes(SEEDS[0])
            at, low, _ = _minimizers(w, h, size)
            ok = sketch.test(bits, low)
            doc = np.searchsorted(w.first, at, side="right") - 1
            if skip_shared:
                ok &= ~sketch.test(bits, _whole(w, h))[doc]
            at, doc = at[ok], doc[ok]
            one = w.runs(h, size, SEEDS[0])[at]
            two = w.runs(w.hashes(SEEDS[1]), size, SEEDS[1])[at] >> U(32)
            if only_of is not None:
                some = sketch.test(only_of.value, _window_key(one, two), bits=only_bits)
                at, doc, one, two = at[some], doc[some], one[some], two[some]
            yield pa.RecordBatch.from_arrays([
                pa.array(one.view(np.int64)), pa.array(two.astype(np.uint32).view(np.int32)),
                *(b.column(i).take(pa.array(doc)) for i in range(TEXT)),
                pa.array((at - w.first[doc]).astype(np.int32))], ["h1", "h2", *ROW, "start"])
    return run


def _shared(several: tuple, bits_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, TEXT, PIECE):
            w = Words(_texts(b.column(TEXT)))
            hit = sketch.test(bits_of.value, _whole(w, w.hashes(SEEDS[0])))
            some = _told_apart(b.filter(pa.array(hit)), *several)
            words = [t.split() for t in _texts(some.column(TEXT))]
            yield pa.RecordBatch.from_arrays([
                *some.columns, pa.array([len(x) for x in words], pa.int64()),
                pa.array([hashlib.sha256(b" ".join(x)).hexdigest() for x in words], pa.string())],
                [*ROW, "text", "n_words", "whole"])
    return run


def _flagged(several: tuple, bits_of, ids_of, id_bits: int, flagged: bool):
    """Texts of their own whose row may have repeated starts, or all others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, TEXT, PIECE):
            w = Words(_texts(b.column(TEXT)))
            b = _told_apart(b, *several)
            hit = sketch.test(ids_of.value, _row_keys(b), bits=id_bits)
            yield b.filter(pa.array((hit == flagged) & ~sketch.test(bits_of.value, _whole(w, w.hashes(SEEDS[0])))))
    return run


def _id_key(b: pa.RecordBatch) -> np.ndarray:
    return mixed(pc.fill_null(b.column(0), 0).to_numpy(zero_copy_only=False).view(np.uint64))


def _row_keys(b: pa.RecordBatch) -> np.ndarray:
    return mixed(_id_key(b) ^ b.column(1).to_numpy(zero_copy_only=False).view(np.uint64))


def _kept(size: int):
    """Words outside every repeated window: their number, hash and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, hashes, kept = [], [], [], []
            for t, s in zip(_texts(b.column(1)), b.column(2).to_pylist()):
                words = left = t.split()
                if s:
                    cover = np.zeros(len(words) + 1, np.int32)
                    s = np.array(s)
                    s = s[s < len(words)]
                    np.add.at(cover, s, 1)
                    np.add.at(cover, np.minimum(s + size, len(words)), -1)
                    gone = np.cumsum(cover)[:-1] > 0
                    left = [x for x, g in zip(words, gone) if not g]
                joined = b" ".join(left)
                n.append(len(words))
                removed.append(len(words) - len(left))
                hashes.append(hashlib.sha256(joined).hexdigest())
                kept.append(joined.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(hashes, pa.string()), pa.array(kept, pa.string())],
                ["id", "n_words", "n_removed", "kept_sha256", "kept_text"])
    return run


KEPT = "id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


SLIM = "id long, digest long, text string"


def _set_of(rows: DataFrame, keys):
    """A broadcast bit array of the rows' keys, and its width: by their number, 32 MB at most."""
    bits = sketch.bits_for(rows.count())
    array = sketch.bit_array(sketch.build(rows, keys, bits=bits), 1, bits=bits)
    return rows.sparkSession.sparkContext.broadcast(array), bits


def dedup(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 and kept_text (the words
    that stay, joined by one space)."""
    context = docs.sparkSession.sparkContext
    text = docs["text"].cast("string")
    slim = docs.select(docs["doc_id"].cast("long").alias("id"), F.xxhash64(text).alias("digest"), text.alias("text"))
    bits = context.broadcast(sketch.bit_array(sketch.build(slim, _keys(size), text=TEXT), 2))
    # ids with several texts: as rule none or few, told to the scans by a bit array
    several = _set_of(stored(slim.groupBy("id").agg(F.min("digest").alias("a"), F.max("digest").alias("b"))
                             .where("a <> b").select("id"), "substring-ids"), _id_key)
    # the larger the earlier: a null id is smaller than all others, so it comes last
    place = lambda *more: F.struct(F.bitwise_not("id").alias("id"), *(F.bitwise_not(c).alias(c) for c in more))

    # texts that may be copies: classed exactly by their whole word sequence
    copies = stored(slim.mapInArrow(_shared(several, bits), f"{SLIM}, n_words long, whole string"), "substring-copies")
    # stored, so that the join reads two plain exchanges and a hot group can be split
    first = stored(copies.groupBy("whole").agg(F.max(place()).alias("first")), "substring-firsts")
    classed = copies.join(first, "whole")
    firsts = classed.where(place() == F.col("first")).select(*ROW, "text")
    later = classed.where(place() < F.col("first"))
    gone = F.col("n_words") >= size
    later = later.select(
        "id", "n_words", F.when(gone, F.col("n_words")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("whole")).alias("kept_sha256"),
        F.when(gone, F.lit("")).otherwise(F.array_join(words_of(F.coalesce("text", F.lit(""))), " ")).alias("kept_text"))

    rows = "h1 long, h2 int, id long, digest long, start int"
    # not stored: hashing again is cheaper than a table of random hashes
    windows = lambda *only: slim.mapInArrow(_windows(several, size, bits, True, *only), rows).unionByName(
        firsts.mapInArrow(_windows(several, size, bits, False, *only), rows))
    earliest = stored(windows().groupBy("h1", "h2").agg(
        F.max(place("start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "substring-earliest")
    # only what stands twice goes to the join: told to the scan by a bit array of bounded size
    again, again_bits = _set_of(earliest.select("h1", "h2"), _window_keys)
    repeats = windows(again, again_bits).join(earliest, ["h1", "h2"]).where(place("start") < F.col("first"))
    # one row per document; its positions are bounded by its own length
    starts = stored(repeats.groupBy(*ROW).agg(F.collect_set("start").alias("starts")), "substring-starts")
    ids, id_bits = _set_of(starts.select(*ROW), _row_keys)

    plain = slim.mapInArrow(_flagged(several, bits, ids, id_bits, False), SLIM).withColumn("starts", F.lit(None).cast("array<int>"))
    some = slim.mapInArrow(_flagged(several, bits, ids, id_bits, True), SLIM).unionByName(firsts)
    some = some.join(starts.select(F.col("id").alias("of"), F.col("digest").alias("with"), "starts"),
                     F.col("id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("with")), "left")
    kept = lambda df: df.select("id", "text", "starts").mapInArrow(_kept(size), KEPT)
    out = kept(plain).unionByName(kept(some)).unionByName(later)
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256", "kept_text")
