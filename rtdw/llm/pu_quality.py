"""Quality scores by positive-unlabelled learning.

Trusted positives are the documents labelled good, the unlabelled set is web text
without a label. An additive model over binned text features is fitted by the
non-negative unbiased risk

    prior * R_p(+)  +  max(0, R_u(-) - prior * R_p(-))

(logistic loss; while the second term is negative, its gradient is reversed, which
keeps a flexible model from explaining the positives away). The class prior is
estimated: a first model tells positives from unlabelled on one half of the sample;
on the other half the least ratio of unlabelled to positive mass above a score bounds
the positives' share of the unlabelled text. It is what is left of positives' mass
in the cleanest scores, with a margin for small counts.

The risk decides the order of the scores; where the contract's cut of 0.7 lies among them is
calibrated: on labelled rows of the training folds (good and bad ones) the cut with most rows on
their right side is found, and scores are shifted on the logit scale so that it becomes 0.7. With
labels of one kind only, scores stay as they are.

Features come from the whole text alone (labels, language, source and id are never
inputs): word and character shape, symbols, repetition, line structure, and how
well the text compresses. They are one slim stored row per document; only the
fitting sample (about ``POSITIVES``, ``UNLABELLED`` and, to calibrate, ``LABELLED`` rows at
most, by hash of the id) reaches the driver. Scoring is a projection, each row alone, so sources, copies
and long texts need no special care.

Defined results: a null text counts as empty, an empty text has a score like any
other (its features are zeros); labels that are null don't count; without
positives or without unlabelled text every score is 0.5; rows that share an id are
scored one by one; an empty table gives an empty table; clashing extra columns
are harmless (only id and text are read).
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtdw.llm.common import stored, unit_draw

MODULUS, HELD_OUT = 4, 2
POSITIVES, UNLABELLED, LABELLED = 20_000, 40_000, 20_000
BINS = 12
ROUNDS, RATE, DECAY = 400, 0.05, 1e-3
THRESHOLD = 0.7

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_ODD = b"#*$%&|<>"
_STOPS = b".,;:!?"

FEATURES = ("log_words", "word_mean", "word_spread", "odd_per_word", "shout_per_word", "stops_per_word",
            "upper", "digits", "distinct", "log_compressed", "top_share", "short_share", "lines_per_word",
            "dup_lines", "bars_per_word", "odd_ends", "wide_bytes")


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % MODULUS


def features(text: bytes) -> list[float]:
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    lengths = np.fromiter(map(len, words), np.float64, n)
    counts = Counter(words)
    chars = lengths.sum()
    lines = [x for x in text.split(b"\n") if x.strip()]
    without = lambda drop: len(text) - len(text.translate(None, drop))
    ends = sum(not (w[-1:].isalnum() or w[-1] > 127 or w[-1:] in _STOPS) for w in words)
    return [
        np.log1p(n), chars / n, float(lengths.std()), without(_ODD) / n, text.count(b"!") / n, without(_STOPS) / n,
        without(_UPPER) / chars, without(_DIGITS) / chars, len(counts) / n,
        float(np.log(len(zlib.compress(text, 1)) / len(text))), counts.most_common(1)[0][1] / n,
        float((lengths <= 3).mean()), len(lines) / n, 1 - len(set(lines)) / len(lines), text.count(b"|") / n,
        ends / n, (len(text) - len(text.decode("utf-8", "replace"))) / chars,
    ]


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flat = pa.list_(pa.float64())
    for b in batches:
        rows = [features(t.encode("utf-8", "replace") if t else b"") for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, flat)], ["doc_id", "x"])


def feature_table(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(
        _feature_rows, f"doc_id {kind}, x array<double>"), "quality-features")


# ------------------------------------------------------------------ model

def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Column j of the result indexes the one weight that feature j switches on."""
    out = np.empty(x.shape, np.int64)
    for j, c in enumerate(cuts):
        out[:, j] = np.searchsorted(c, x[:, j], side="right") + j * (BINS + 1)
    return out


def _cuts(x: np.ndarray) -> list[np.ndarray]:
    """Quantiles, with a cut beside a value that holds much of the mass."""
    return [np.unique(np.concatenate((np.quantile(x[:, j], np.linspace(0, 1, BINS - 1)[1:-1]),
                                      [np.quantile(x[:, j], 0.005), np.quantile(x[:, j], 0.995)])))
            for j in range(x.shape[1])]


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit(p: np.ndarray, u: np.ndarray, size: int, prior: float | None) -> np.ndarray:
    """Adam on the non-negative risk; without a prior, plain positive against
    unlabelled with equal weights. The last weight is the constant."""
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)

    def slope(rows, each):
        g = np.bincount(rows.reshape(-1), np.repeat(each, rows.shape[1]), size + 1) / len(rows)
        g[-1] = each.mean()
        return g

    for t in range(1, ROUNDS + 1):
        sp, su = _sigmoid(w[p].sum(1) + w[-1]), _sigmoid(w[u].sum(1) + w[-1])
        if prior is None:
            g = 0.5 * slope(p, sp - 1) + 0.5 * slope(u, su)
        else:
            negative = -np.log1p(-np.clip(su, 0, 1 - 1e-12)).mean() + prior * np.log1p(-np.clip(sp, 0, 1 - 1e-12)).mean()
            rest = slope(u, su) - prior * slope(p, sp)
            g = prior * slope(p, sp - 1) + rest if negative >= 0 else -rest
        g[:-1] += DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def estimated_prior(p: np.ndarray, u: np.ndarray, size: int) -> float:
    """The share of positives in the unlabelled rows, from the half not fitted on."""
    w = _fit(p[0::2], u[0::2], size, None)
    sp = np.sort(w[p[1::2]].sum(1))
    su = np.sort(w[u[1::2]].sum(1))
    if not len(sp) or not len(su):
        return 0.5
    above_p = 1 - np.arange(len(sp)) / len(sp)
    above_u = 1 - np.searchsorted(su, sp) / len(su)
    margin = np.sqrt(1 / (2 * len(sp))) + np.sqrt(1 / (2 * len(su)))
    ratio = (above_u + margin) / above_p
    best = int(np.argmin(ratio))
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.95))


class Model:
    def __init__(self, cuts, w, prior, shift: float = 0.0):
        self.cuts, self.w, self.prior, self.shift = cuts, w, prior, shift

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.w[_binned(x, self.cuts)].sum(1) + self.w[-1]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.w is None:
            return np.full(len(x), 0.5)
        return _sigmoid(self.margin(x) + self.shift)

    def calibrate(self, x: np.ndarray, quality: np.ndarray) -> "Model":
        """Shift so that the cut that parts the labelled rows best scores ``THRESHOLD``."""
        if self.w is not None and 0 < quality.sum() < len(quality):
            self.shift = float(np.log(THRESHOLD / (1 - THRESHOLD)) - best_cut(self.margin(x), quality))
        return self


def best_cut(margin: np.ndarray, quality: np.ndarray) -> float:
    """The cut with most rows right (1 at or above it); amid equally good ones, the middle."""
    order = np.argsort(margin, kind="stable")
    z, q = margin[order], quality[order].astype(np.int64)
    # right when the first k rows are called bad; only between different margins
    right = np.concatenate(([0], np.cumsum(1 - q))) + np.concatenate((np.cumsum(q[::-1])[::-1], [0]))
    edges = np.concatenate(([z[0] - 1], (z[1:] + z[:-1]) / 2, [z[-1] + 1]))
    apart = np.concatenate(([True], z[1:] > z[:-1], [True]))
    best = np.flatnonzero(apart & (right == right[apart].max()))
    return float(edges[best].mean() if np.array_equal(best, np.arange(best[0], best[-1] + 1)) else edges[best[len(best) // 2]])


def fit(positives: np.ndarray, unlabelled: np.ndarray) -> Model:
    if len(positives) < 2 or len(unlabelled) < 2:
        return Model(None, None, 0.5)
    cuts = _cuts(np.concatenate((positives, unlabelled)))
    size = len(FEATURES) * (BINS + 1)
    p, u = _binned(positives, cuts), _binned(unlabelled, cuts)
    prior = estimated_prior(p, u, size)
    return Model(cuts, _fit(p, u, size, prior), prior)


def _sample(rows: DataFrame, most: int, *more: str) -> tuple[np.ndarray, list]:
    """All rows, or about ``most`` of them, chosen by a hash of the id (the
    documented bound on what reaches the driver): features, and the columns ``more``."""
    n = rows.count()
    some = rows if n <= most else rows.where(unit_draw(F.col("doc_id"), F.lit("sample")) < most / n)
    got = some.select("x", *more).collect()
    return np.array([r["x"] for r in got], np.float64).reshape(len(got), len(FEATURES)), [r[1:] for r in got]


def train(table: DataFrame, labels: DataFrame) -> Model:
    """Only labels of training folds are read."""
    known = labels.where(fold(F.col("doc_id")) != HELD_OUT).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    good = table.join(known.where("quality = 1"), "doc_id", "left_semi")
    web = table.join(known, "doc_id", "left_anti")
    model = fit(_sample(good, POSITIVES)[0], _sample(web, UNLABELLED)[0])
    x, marks = _sample(table.join(known.where("quality IN (0, 1)"), "doc_id"), LABELLED, "quality")
    return model.calibrate(x, np.array([m[0] for m in marks], np.int64))


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column(1).to_pylist(), np.float64).reshape(b.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model(x))], ["doc_id", "score"])
    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    table = feature_table(docs)
    model = train(table, labels)
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = table.mapInArrow(_scores(model), f"doc_id {kind}, score double")
    return out.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
