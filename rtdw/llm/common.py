"""Small helpers the training-data operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rtdw.session import ensure_checkpoint_dir, ship_package

# The six ASCII white-space characters that separate words.
SPACES = " \t\n\x0b\f\r"
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Shared folder, package on the executors, and Arrow batches small enough
    that a batch of very long texts still fits a Python worker."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")


def pieces(batches: Iterator[pa.RecordBatch], column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that a piece holds about ``most`` bytes of text
    (one row at least): numpy works on several times that in 8-byte numbers."""
    for b in batches:
        length = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        at = 0
        upto = np.cumsum(length)
        while at < b.num_rows:
            done = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, done + most, side="right")))
            yield b.slice(at, end - at)
            at = end


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to a fresh table in the shared folder and read
    it back, so that a lost executor never costs more than the last step."""
    spark = df.sparkSession
    path = "/".join((ensure_checkpoint_dir(spark).rstrip("/"), "llm", f"{name}-{uuid.uuid4().hex}"))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that starts with ``stem`` and that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while any(c.startswith(stem.lower()) for c in taken):
        stem += "_"
    return stem


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, quoted, in order (names may hold dots or blanks)."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def text_of(docs: DataFrame, col: str = "text") -> Column:
    return F.coalesce(docs[col].cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array (empty for a blank text)."""
    return F.array_remove(F.split(text, GAP, -1), "")


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def unit_draw(*key: Column) -> Column:
    """A uniform draw in (0, 1) that depends on the key alone: 52 bits of the
    MD5 of the key's text, so any engine can repeat it."""
    text = F.concat_ws("|", *(F.coalesce(k.cast("string"), F.lit("")) for k in key))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and bind it in ``body`` (a one-element transform;
    a plain reference inside a lambda would be evaluated for every element)."""
    return F.element_at(F.transform(F.array(value), body), 1)
