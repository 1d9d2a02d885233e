"""A count-min sketch built by tasks and merged by Spark.

``2**bits`` cells in each of ``depth`` rows. A task's sketch is sparse: per block
of 2**22 cells the cells met once and those met more often, as compressed
differences. Blocks are merged in two levels, first within salts, so that one
group holds about the square root of all partial blocks. The merged sketch is
kept as bit arrays of a fixed size (``depth * 2**bits / 8`` bytes) whatever the
corpus: that bound is what makes them fit for a broadcast. A cell's bit is never
missing for what was counted; beyond the width more keys pass, never fewer.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rtdw.llm.common import pieces, stored
from rtdw.llm.wordhash import SEEDS, U, mixed

BITS = 27
DEPTH = 2
BLOCK_BITS = 22
SALTS = 16
HELD = 2_000_000
SCHEMA = "block int, once binary, more binary"


def bits_for(keys: int, most: int = BITS) -> int:
    """Width for a sketch of that many distinct keys: 16 cells a key, one block at least and
    ``most`` at most."""
    return min(most, max(BLOCK_BITS, (16 * keys).bit_length()))


def cells_of(h: np.ndarray, depth: int, bits: int) -> list[np.ndarray]:
    return [((mixed(h + U(r) * U(SEEDS[1])) >> U(64 - bits)).astype(np.int64) + (r << bits)) for r in range(depth)]


def _pack(cells: np.ndarray) -> bytes:
    return zlib.compress(np.diff(cells, prepend=0).astype(np.uint32).tobytes(), 1) if len(cells) else b""


def _unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), np.uint32).astype(np.int64)) if data else np.empty(0, np.int64)


def _task(keys: Callable[[pa.RecordBatch], np.ndarray], depth: int, bits: int, text: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []

        def block_rows() -> pa.RecordBatch:
            cells, n = np.unique(np.concatenate(parts), return_counts=True)
            block = cells >> BLOCK_BITS
            cut = np.flatnonzero(np.diff(block, prepend=-1))
            ids, once, more = [], [], []
            for a, b in zip(cut, [*cut[1:], len(cells)]):
                c, k = cells[a:b] & ((1 << BLOCK_BITS) - 1), n[a:b]
                ids.append(int(block[a]))
                once.append(_pack(c[k == 1]))
                more.append(_pack(c[k > 1]))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int32()), pa.array(once, pa.binary()), pa.array(more, pa.binary())],
                ["block", "once", "more"])

        held = 0
        for b in batches if text is None else pieces(batches, text):
            for c in cells_of(keys(b), depth, bits):
                parts.append(c)
                held += len(c)
            if held > HELD:
                yield block_rows()
                parts, held = [], 0
        if held:
            yield block_rows()
    return run


def _merge(pdf):
    import pandas as pd

    seen = np.zeros(1 << BLOCK_BITS, np.uint8)
    for once, more in zip(pdf["once"], pdf["more"]):
        c = _unpack(once)
        seen[c] = np.minimum(seen[c] + 1, 2)
        seen[_unpack(more)] = 2
    return pd.DataFrame({"block": [int(pdf["block"].iloc[0])],
                         "once": [_pack(np.flatnonzero(seen == 1))], "more": [_pack(np.flatnonzero(seen == 2))]})


def _merge_salted(pdf):
    return _merge(pdf[["block", "once", "more"]])


def build(df: DataFrame, keys: Callable[[pa.RecordBatch], np.ndarray], text: int | None = None,
          depth: int = DEPTH, bits: int = BITS) -> DataFrame:
    """Count the keys (uint64) that ``keys`` reads from each batch of ``df``; batches
    with texts in column ``text`` are cut to a bounded number of bytes."""
    parts = df.mapInArrow(_task(keys, depth, bits, text), SCHEMA)
    salted = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    level1 = salted.groupBy("block", "salt").applyInPandas(_merge_salted, SCHEMA)
    return stored(level1.groupBy("block").applyInPandas(_merge, SCHEMA), "sketch")


def bit_array(merged: DataFrame, least: int, depth: int = DEPTH, bits: int = BITS) -> np.ndarray:
    """One bit per cell: counted at least ``least`` (1 or 2) times."""
    out = np.zeros(depth << (bits - 3), np.uint8)
    columns = ["more"] if least == 2 else ["once", "more"]
    for row in merged.select("block", *columns).toLocalIterator():
        at = np.zeros(1 << BLOCK_BITS, np.uint8)
        for c in columns:
            at[_unpack(bytes(row[c]))] = 1
        start = row["block"] << (BLOCK_BITS - 3)
        packed = np.packbits(at, bitorder="little")[: len(out) - start]
        out[start:start + len(packed)] = packed
    return out


def test(bitmap: np.ndarray, h: np.ndarray, depth: int = DEPTH, bits: int = BITS) -> np.ndarray:
    """Whether all cells of each key are set."""
    ok = np.ones(len(h), bool)
    for c in cells_of(h, depth, bits):
        ok &= ((bitmap[c >> 3] >> (c & 7).astype(np.uint8)) & 1) == 1
    return ok
