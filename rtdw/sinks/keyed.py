"""A keyed table in buckets for ``foreachBatch`` writers (SNK4, SNK7, ST6-ST9).

Rows are dealt into a fixed number of buckets by the hash of their key. A batch
reads and rewrites only the buckets its rows fall into; all other buckets stay
as they are. Each batch makes a version: its buckets' files under
``data/version=<n>/bucket=<b>`` and a small manifest that says, for every bucket, which
version holds it (at most one entry a bucket). Batch ``n`` always starts from the last
version not after ``n`` and writes version ``n + 1``, so a batch that is run again after a
failure leaves the same table. The manifest is written last: readers see whole
versions only. Versions that no kept manifest names are removed.

The path may be any URI Spark's file systems know.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Merge = Callable[[DataFrame, DataFrame], DataFrame]
#: of stored rows: several versions of a bucket lie beside each other
CODEC = "zstd"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, complete or not there."""
    fs, p = _fs(spark, path)
    _, draft = _fs(spark, path + ".draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(p, False)
    fs.rename(draft, p)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


class KeyedTable:
    """``key``: what identifies a row. ``bucket_by`` (default: the key): what deals rows into
    buckets; rows of one key must agree in it. ``keep``: versions kept."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], schema: T.StructType | str,
                 buckets: int = 16, bucket_by: Sequence[str] | None = None, keep: int = 3):
        self.spark, self.path, self.key = spark, path.rstrip("/"), list(key)
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        self.buckets, self.bucket_by, self.keep = buckets, list(bucket_by or key), keep

    # ---------------------------------------------------------- versions --
    def versions(self) -> list[int]:
        names = list_names(self.spark, f"{self.path}/manifest")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _manifest(self, version: int | None) -> dict[int, int]:
        """Bucket -> version of the last manifest not after ``version``."""
        some = [v for v in self.versions() if version is None or v <= version]
        if not some:
            return {}
        held = json.loads(read_text(self.spark, f"{self.path}/manifest/{some[-1]}.json"))
        return {int(b): v for b, v in held.items()}

    # -------------------------------------------------------------- read --
    def _files(self, where: dict[int, int]) -> DataFrame:
        paths = [f"{self.path}/data/version={v}/bucket={b}" for b, v in sorted(where.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """The table at a version (the last one if none is named)."""
        return self._files(self._manifest(version))

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that ``rows`` (with the bucket columns) fall into: at most all."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def part(self, version: int, buckets: Sequence[int]) -> DataFrame:
        """The rows of some buckets at a version; no other bucket is read."""
        held = self._manifest(version)
        return self._files({b: held[b] for b in buckets if b in held})

    # ------------------------------------------------------------- write --
    def commit(self, batch_id: int, changes: DataFrame, merge: Merge, buckets: Sequence[int] | None = None,
               passes: int = 1) -> list[int]:
        """Merge a batch's changes into the buckets they fall into; returns these.
        ``merge(stored, changes)`` gives the new rows of those buckets. ``buckets``: those of the
        changes, if they are known. ``passes``: so many shares of the buckets are merged one after the other,
        each from its own share of the changes, so that less is dealt out at a time."""
        spark = self.spark
        held = self._manifest(batch_id)
        buckets = self.touched(changes) if buckets is None else list(buckets)
        now = dict(held)
        if buckets:
            at = f"{self.path}/data/version={batch_id + 1}"
            shares = [some for n in range(passes) if (some := buckets[n::passes])]
            for n, some in enumerate(shares):
                own = changes if len(shares) == 1 else changes.where(self.bucket().isin(some))
                merged = merge(self.part(batch_id, some), own).select(*self.schema.fieldNames())
                # a large bucket may be several files
                merged.withColumn("bucket", self.bucket()).hint("rebalance", "bucket").write \
                    .mode("append" if n else "overwrite").option("compression", CODEC).partitionBy("bucket").parquet(at)
            written = {int(n.split("=")[1]) for n in list_names(spark, at) if n.startswith("bucket=")}
            now = {b: v for b, v in held.items() if b not in buckets} | {b: batch_id + 1 for b in written}
        write_text(spark, f"{self.path}/manifest/{batch_id + 1}.json", json.dumps(now))
        self._expire()
        return buckets

    def _expire(self) -> None:
        versions = self.versions()
        old, kept = versions[:-self.keep], versions[-self.keep:]
        if not old:
            return
        used = {(v, b) for k in kept for b, v in self._manifest(k).items()}
        for v in old:
            remove(self.spark, f"{self.path}/manifest/{v}.json")
        for name in list_names(self.spark, f"{self.path}/data"):
            v = int(name.split("=")[1])
            if v > kept[-1]:
                continue
            parts = [n for n in list_names(self.spark, f"{self.path}/data/{name}") if n.startswith("bucket=")]
            stale = [n for n in parts if (v, int(n.split("=")[1])) not in used]
            if len(stale) == len(parts):
                remove(self.spark, f"{self.path}/data/{name}")
            else:
                for n in stale:
                    remove(self.spark, f"{self.path}/data/{name}/{n}")


def newest(key: Sequence[str], seq: str) -> Merge:
    """The row of largest ``seq`` per key; a redelivered row changes nothing."""
    def merge(stored: DataFrame, changes: DataFrame) -> DataFrame:
        rest = [c for c in stored.columns if c not in key and c != seq]
        agg = stored.unionByName(changes.select(*stored.columns)).groupBy(*key).agg(
            F.max(F.struct(seq, *rest)).alias("_r"))
        return agg.select(*key, *(F.col(f"_r.{c}").alias(c) for c in (seq, *rest))).select(*stored.columns)
    return merge


def replaced(key: Sequence[str], changed: DataFrame | None = None) -> Merge:
    """Changed keys take the batch's row (one per key), others stay. ``changed``: the keys of the changes, if they
    are at hand."""
    def merge(stored: DataFrame, changes: DataFrame) -> DataFrame:
        keys = changes.select(*key).distinct() if changed is None else changed
        kept = stored.join(keys, [stored[k].eqNullSafe(keys[k]) for k in key], "left_anti")
        return kept.unionByName(changes.select(*stored.columns))
    return merge
