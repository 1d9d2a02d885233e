"""Corpus scoring: a unigram base and online logistic context mixing.

Base. Token counts of the training texts are combined in the tasks and summed by
a shuffle. The most frequent tokens (``FREQUENT`` at most) go to the scoring tasks
as a dictionary of that fixed size; all rarer tokens of a text meet the rest of
the vocabulary in a join, so the vocabulary may grow with the corpus.

Mixing. The model predicts a text bit by bit: its UTF-8 bytes and one end byte.
Predictors are hashed contexts: the last 0 to 4 bytes hash to a slot, and each of the
255 nodes of the byte's bit tree has a count of zeros and ones there, from all
training texts. Their stretched probabilities are combined by a logistic mixer;
the weight set is gated by the bits of the byte known so far. Mixer weights are
learnt online: pass by pass over the corpus's byte grams in small steps, each
step's prediction made before its bits are learnt; tasks' weights are averaged by a
shuffle. Last, an adaptive map (known bits x quantised stretch) refines the
probability from what the mixer's predictions came out as.

So that predictors don't judge bits they were counted from, training texts are dealt
into two folds: counts of the first teach the mixer on the grams of the second;
the final counts use both. All counts come from every training text; the tables
have a fixed size (slots x 256 bytes per context), which bounds the broadcast.

Scoring looks a byte gram up in a per-worker table of fixed size and only computes
grams it doesn't hold: texts are scored whole, whatever their length.

Defined results: a null text counts as empty (one end token, one end byte); rows are
scored one by one, so repeated rows score alike; a null id hashes as the empty text;
with no training text every token is unknown and every bit has probability one
half; an empty table gives an empty table; clashing extra columns are harmless.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtdw.llm.common import pieces, stored
from rtdw.llm.wordhash import U, mixed

MODULUS, HELD_OUT = 7, 2
END = b"\xff"                      # never part of UTF-8: the end, in tokens and bytes
FREQUENT = 1 << 18
SLOT_BITS = (0, 8, 13, 15, 16)     # of the contexts of 0 to 4 bytes
ORDERS = len(SLOT_BITS)
FIRST_SLOT = np.concatenate(([0], np.cumsum([1 << b for b in SLOT_BITS])))
SLOTS = int(FIRST_SLOT[-1])
BLOCK = 64                         # slots a row of the table holds
SCALE = 12.0                       # stretch units per logit in a signed byte
MAP_STEPS = 33
PASSES, RATE, STEP = 3, 0.02, 1 << 14


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % MODULUS


def _texts(column: pa.Array) -> list[bytes]:
    return [t.encode("utf-8", "replace") if t else b"" for t in column.to_pylist()]


# ------------------------------------------------------------------ token counts

def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Combined inside the task; flushed when the dictionary is large."""
    counts: Counter = Counter()

    def rows():
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts.keys()), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["token", "n"])

    for b in batches:
        texts = _texts(b.column(0))
        for t in texts:
            counts.update(t.lower().split())
        counts[END] += len(texts)
        if len(counts) > 500_000:
            yield rows()
            counts.clear()
    if counts:
        yield rows()


def vocabulary(training: DataFrame) -> DataFrame:
    """(token, n) over all training texts, the end counted as a token."""
    parts = training.select("text").mapInArrow(_token_counts, "token binary, n long")
    return stored(parts.groupBy("token").agg(F.sum("n").alias("n")), "lm-vocabulary")


def frequent_above(vocab: DataFrame, most: int) -> int:
    """The least count that at most ``most`` tokens reach (counts of counts, cut at
    100,000, are a bounded table)."""
    rows = vocab.groupBy(F.least("n", F.lit(100_000)).alias("c")).count().collect()
    total, least = 0, 100_001
    for c, k in sorted(((r["c"], r["count"]) for r in rows), reverse=True):
        total += k
        if total > most:
            break
        least = c
    return least


# ------------------------------------------------------------------ byte grams

def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every byte of every text and its end byte: the byte with the
    four before it (zeros before the start); and the number of bytes per text."""
    data = np.frombuffer(b"".join(b"\0\0\0\0" + t + END for t in texts), np.uint8).astype(np.int64)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    if not len(texts):
        return np.empty(0, np.int64), lengths
    gram = data.copy()
    for k in range(1, ORDERS):
        gram[k:] |= data[:-k] << (8 * k)
    pad = np.zeros(len(data), bool)
    starts = np.concatenate(([0], np.cumsum(lengths + 4)[:-1]))
    for k in range(4):
        pad[starts + k] = True
    return gram[~pad], lengths


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, part, n): part 0 teaches the predictors, part 1 the mixer."""
    held: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]

    def combined(part: int):
        g = np.concatenate([x for x, _ in held[part]])
        n = np.concatenate([y for _, y in held[part]])
        u, at = np.unique(g, return_inverse=True)
        return u, np.bincount(at, weights=n).astype(np.int64)

    for b in pieces(batches, 0, 1 << 21):
        texts, parts = _texts(b.column(0)), b.column(1).to_numpy(zero_copy_only=False)
        for part in (0, 1):
            g, _ = _grams([t for t, p in zip(texts, parts) if p == part])
            held[part].append(np.unique(g, return_counts=True))
            if len(held[part]) > 8:
                held[part] = [combined(part)]
    for part in (0, 1):
        if held[part]:
            g, n = combined(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(g, pa.int64()), pa.array(np.full(len(g), part, np.int32)), pa.array(n, pa.int64())],
                ["gram", "part", "n"])


def gram_counts(training: DataFrame) -> DataFrame:
    parts = training.mapInArrow(_gram_counts, "gram long, part int, n long")
    return stored(parts.groupBy("gram", "part").agg(F.sum("n").alias("n")), "lm-grams")


def _slots(gram: np.ndarray, order: int) -> np.ndarray:
    context = (gram >> 8) & ((1 << (8 * order)) - 1)
    bits = SLOT_BITS[order]
    h = context if bits <= 8 else (mixed(context.astype(np.uint64) + U(order << 40)) >> U(64 - bits)).astype(np.int64)
    return h + FIRST_SLOT[order]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        g = b.column(0).to_numpy()
        for order in range(ORDERS):
            cell, at = np.unique(_slots(g, order) * 256 + (g & 255), return_inverse=True)
            n = np.bincount(at, weights=b.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(n.astype(np.int64))], ["cell", "n"])


def _nodes(counts: np.ndarray) -> np.ndarray:
    """Byte counts per slot (n x 256) to stretched node probabilities (n x 256)."""
    n = len(counts)
    tree = np.zeros((n, 512))
    tree[:, 256:] = counts
    for width in (128, 64, 32, 16, 8, 4, 2, 1):
        tree[:, width:2 * width] = tree[:, 2 * width:4 * width:2] + tree[:, 2 * width + 1:4 * width:2]
    ones, both = tree[:, 3::2][:, :255], tree[:, 1:256]
    p = (ones + 0.02) / (both + 0.04)
    logit = np.log(p / (1 - p))
    # an unseen node says nothing
    out = np.zeros((n, 256), np.int8)
    out[:, 1:] = np.clip(np.rint(logit * SCALE), -127, 127)
    return out


def _block_rows(pdf):
    import pandas as pd

    block = int(pdf["block"].iloc[0])
    counts = np.zeros((BLOCK, 256))
    cell = pdf["cell"].to_numpy() - block * BLOCK * 256
    np.add.at(counts.reshape(-1), cell, pdf["n"].to_numpy())
    return pd.DataFrame({"block": [block], "nodes": [_nodes(counts).tobytes()]})


def predictor_table(grams: DataFrame) -> np.ndarray:
    """SLOTS x 256 signed bytes: stretched probabilities of every node."""
    cells = grams.select("gram", "n").mapInArrow(_cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = cells.withColumn("block", F.floor(F.col("cell") / (BLOCK * 256)).cast("int"))
    rows = stored(cells.groupBy("block").applyInPandas(_block_rows, "block int, nodes binary"), "lm-nodes")
    table = np.zeros((SLOTS + BLOCK, 256), np.int8)
    for r in rows.toLocalIterator():
        nodes = np.frombuffer(bytes(r["nodes"]), np.int8).reshape(BLOCK, 256)
        table[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = nodes
    return table[:SLOTS]


# ------------------------------------------------------------------ mixer

def _inputs(table: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per gram and bit: the predictors' stretches and a constant (n x 8 x
    ORDERS + 1), the node, the bit."""
    byte = gram & 255
    shift = np.arange(7, -1, -1)
    bit = ((byte[:, None] >> shift) & 1).astype(np.float32)
    node = (1 << np.arange(8)) | (byte[:, None] >> (shift + 1))
    x = np.empty((len(gram), 8, ORDERS + 1), np.float32)
    for order in range(ORDERS):
        x[:, :, order] = table[_slots(gram, order)[:, None], node]
    x[:, :, :ORDERS] /= SCALE
    x[:, :, ORDERS] = 0.25
    return x, node, bit


def _squash(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -14, 14)))


def start_weights() -> np.ndarray:
    w = np.zeros((256, ORDERS + 1), np.float32)
    w[:, ORDERS - 1] = 0.5
    w[:, ORDERS - 2] = 0.3
    w[:, ORDERS - 3] = 0.2
    return w


def _learn(shared, w0: np.ndarray):
    """Online steps over the task's grams; one row per weight: (at, sum, count)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, seen = w0.copy(), np.zeros(256)
        scale = np.full(256, 1e-3, np.float64)
        for b in batches:
            gram, n = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i in range(0, len(gram), STEP):
                x, node, bit = _inputs(shared.value, gram[i:i + STEP])
                k = np.sqrt(n[i:i + STEP])[:, None].astype(np.float32)
                p = _squash((x * w[node]).sum(2))
                g = ((bit - p) * k)[:, :, None] * x
                step = np.zeros_like(w)
                np.add.at(step, node, g)
                np.add.at(scale, node, (k * np.square(x).sum(2)).astype(np.float64))
                w += (RATE * 50) * step / (scale[:, None] + 50).astype(np.float32)
                np.add.at(seen, node, np.broadcast_to(k, node.shape))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(w.size, dtype=np.int32)),
            pa.array((w * seen[:, None]).reshape(-1).astype(np.float64)),
            pa.array(np.repeat(seen, ORDERS + 1))], ["at", "total", "seen"])
    return run


def mixer_weights(grams: DataFrame, shared) -> np.ndarray:
    """256 x (ORDERS + 1): averaged over tasks, pass after pass."""
    w = start_weights()
    for _ in range(PASSES):
        rows = grams.mapInArrow(_learn(shared, w), "at int, total double, seen double").groupBy("at").agg(
            F.sum("total").alias("total"), F.sum("seen").alias("seen")).collect()  # 256 x (ORDERS + 1) rows
        flat = w.reshape(-1).copy()
        for r in rows:
            if r["seen"] > 0:
                flat[r["at"]] = r["total"] / r["seen"]
        w = flat.reshape(w.shape)
    return w


def _map_cell(z: np.ndarray, node: np.ndarray) -> np.ndarray:
    step = np.clip(np.rint((np.clip(z, -8, 8) + 8) * 2), 0, MAP_STEPS - 1).astype(np.int64)
    return node * MAP_STEPS + step


def _outcomes(shared, w: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones, both = np.zeros(256 * MAP_STEPS), np.zeros(256 * MAP_STEPS)
        for b in batches:
            gram, n = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i in range(0, len(gram), STEP):
                x, node, bit = _inputs(shared.value, gram[i:i + STEP])
                cell = _map_cell((x * w[node]).sum(2), node)
                k = np.broadcast_to(n[i:i + STEP, None], cell.shape)
                ones += np.bincount(cell.reshape(-1), (k * bit).reshape(-1), 256 * MAP_STEPS)
                both += np.bincount(cell.reshape(-1), k.reshape(-1), 256 * MAP_STEPS)
        at = np.flatnonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(ones[at]), pa.array(both[at])],
                                         ["at", "ones", "both"])
    return run


def refinement(grams: DataFrame, shared, w: np.ndarray) -> np.ndarray:
    """Per known bits and quantised stretch, the probability that came out; a
    step's own probability counts as 20 observations."""
    step = np.tile((np.arange(MAP_STEPS) / 2 - 8), 256)
    ones, both = 20 * _squash(step), np.full(256 * MAP_STEPS, 20.0)
    for r in grams.mapInArrow(_outcomes(shared, w), "at int, ones double, both double").groupBy("at").agg(
            F.sum("ones").alias("ones"), F.sum("both").alias("both")).collect():  # 256 x MAP_STEPS rows
        ones[r["at"]] += r["ones"]
        both[r["at"]] += r["both"]
    return (ones / both).astype(np.float32)


def gram_log10(gram: np.ndarray, table: np.ndarray, w: np.ndarray, refined: np.ndarray) -> np.ndarray:
    """log10 of the model's probability of each gram's last byte."""
    out = np.empty(len(gram))
    for i in range(0, len(gram), STEP):
        x, node, bit = _inputs(table, gram[i:i + STEP])
        z = (x * w[node]).sum(2)
        p = (_squash(z) + refined[_map_cell(z, node)]) / 2
        p = np.clip(p, 1e-6, 1 - 1e-6)
        out[i:i + STEP] = np.log10(np.where(bit > 0, p, 1 - p).astype(np.float64)).sum(1)
    return out


class Lookup:
    """log10 probabilities by gram: a direct-mapped table of fixed size."""

    BITS = 21

    def __init__(self, table, w, refined):
        self.model = (table, w, refined)
        self.keys = np.full(1 << self.BITS, -1, np.int64)
        self.values = np.zeros(1 << self.BITS)

    def __call__(self, gram: np.ndarray) -> np.ndarray:
        slot = (gram.astype(np.uint64) * U(0x9E3779B97F4A7C15) >> U(64 - self.BITS)).astype(np.int64)
        out = self.values[slot]
        miss = np.flatnonzero(self.keys[slot] != gram)
        if len(miss):
            new, at = np.unique(gram[miss], return_inverse=True)
            value = gram_log10(new, *self.model)
            out[miss] = value[at]
            place = (new.astype(np.uint64) * U(0x9E3779B97F4A7C15) >> U(64 - self.BITS)).astype(np.int64)
            # one gram may own a slot: the last written, with its own value
            self.keys[place] = new
            self.values[place] = value
        return out


def _score(shared, w, refined, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lookup = frequent.value, Lookup(shared.value, w, refined)
        for b in pieces(batches, 2):
            texts = _texts(b.column(2))
            gram, lengths = _grams(texts)
            ends = np.cumsum(lengths)
            # summed text by text: equal texts score alike to the last bit
            logs = np.add.reduceat(lookup(gram), ends - lengths) if len(gram) else np.empty(0)
            n_tokens, n_known, part, rest = [], [], [], []
            for t in texts:
                words = t.lower().split()
                words.append(END)
                got = [known.get(x) for x in words]
                hit = [c for c in got if c is not None]
                n_tokens.append(len(words))
                n_known.append(len(hit))
                part.append(sum(hit))
                rest.append(list(Counter(x for x, c in zip(words, got) if c is None).items()))
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()),
                pa.array(part, pa.float64()), pa.array(logs, pa.float64()), pa.array(lengths, pa.int64()),
                pa.array([[{"token": x, "k": k} for x, k in r] for r in rest],
                         pa.list_(pa.struct([("token", pa.binary()), ("k", pa.int64())])))],
                ["row", "doc_id", "n_tokens", "n_known", "part", "score", "n_bytes", "rest"])
    return run


def score(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score, bits_per_byte."""
    context = docs.sparkSession.sparkContext
    slim = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    training = slim.where(fold(F.col("doc_id")) != HELD_OUT)

    vocab = vocabulary(training)
    total = vocab.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    least = frequent_above(vocab, FREQUENT)
    frequent = context.broadcast({  # at most FREQUENT tokens
        bytes(r["token"]): math.log10(r["n"] + 1) for r in vocab.where(F.col("n") >= least).toLocalIterator()})

    # part 1 is one residue in six of the training texts
    grams = gram_counts(training.select("text", F.when(fold(F.col("doc_id")) == 5, 1).otherwise(0).alias("part")))
    first = context.broadcast(predictor_table(grams.where("part = 0").select("gram", "n")))
    lesson = grams.where("part = 1").select("gram", "n").repartition(12, "gram")
    w = mixer_weights(lesson, first)
    refined = refinement(lesson, first, w)
    first.unpersist()
    table = context.broadcast(predictor_table(grams.groupBy("gram").agg(F.sum("n").alias("n"))))

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = stored(slim.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
        _score(table, w, refined, frequent),
        f"row long, doc_id {kind}, n_tokens long, n_known long, part double, score double, n_bytes long, "
        "rest array<struct<token:binary,k:long>>"), "lm-scored")
    rare = scored.select("row", F.explode("rest").alias("t")).select("row", "t.token", "t.k")
    rare = rare.join(vocab.where(F.col("n") < least), "token").groupBy("row").agg(
        F.sum("k").alias("more"), F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("more_part"))
    out = scored.drop("rest").join(rare, "row", "left")
    below = math.log10(total["n"] + total["v"] + 1)
    return out.select(
        "doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total["n"]).cast("long").alias("train_tokens"),
        (F.col("part") + F.coalesce("more_part", F.lit(0.0)) - F.col("n_tokens") * F.lit(below)).alias("base_score"),
        "score", (-F.col("score") / math.log10(2) / F.col("n_bytes")).alias("bits_per_byte"))
