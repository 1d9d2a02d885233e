"""The SKU metric as a stream (ST7, AGG6, WIN4, J13-J18, ST11).

Keyed state keeps each detail id's latest version for five seconds and emits it at a timer (of event time: JVM
session windows, whose rows are cut into the same periods);
the emitted rows are summed per SKU into tumbling windows of the time of emission (the
reference windows on processing time, trap X4), and each batch's changed windows go through the
six-hop dimension chain as the dimensions stand then. Sums and emitted rows are keyed
tables: a batch that runs again leaves the same sums.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import slot, window_labels
from ..operators import dims
from ..operators.metrics import MONEY, SKU_MEASURES
from ..session import settings, state_dir
from ..sinks.keyed import KeyedTable, replaced
from . import state as S
from .replay import Replay

CELL = ["window", "sku_id"]
NAMES = ["sku_name", "spu_id", "category3_id", "tm_id", "spu_name", "tm_name", "category3_name", "category2_id",
         "category2_name", "category1_id", "category1_name"]
_WINDOW = "window struct<start:timestamp,end:timestamp>, sku_id string"
SUMS = _WINDOW + "".join(f", {c} decimal(38,2)" for c in SKU_MEASURES.values())
OUT = _WINDOW + "".join(f", {c} string" for c in NAMES) + "".join(f", {c} decimal(38,2)" for c in SKU_MEASURES.values())
STORE = "spark.sql.streaming.stateStore.rocksdb"
#: closed sessions leave tombstones, over which every later look-up of an id would step; all stores of an executor
#: share one bounded piece of memory and take no room on disk in advance
COMPACT = {f"{STORE}.compactOnCommit": "true", f"{STORE}.boundedMemoryUsage": "true", f"{STORE}.allowFAllocate": "false",
           f"{STORE}.compression": "zstd"}
#: cells merged in one pass: a named cell is wide, and a batch's cells may fall into all buckets
AT_ONCE = 2_000_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _periods(rows: Column, delay_ms: int, order: tuple[str, ...]) -> Column:
    """The newest row of each period of a session's rows (with ``et_ms``), with the period's end ``emitted_ms``.
    A row later than ``delay_ms`` after the first of its period opens the next one."""
    newest = lambda r: F.struct(*(r[c] for c in order))
    end = lambda r: (r["et_ms"] + F.lit(delay_ms)).alias("emitted_ms")

    def step(acc: Column, new: Column) -> Column:
        opened = F.struct(acc["done"].alias("done"), new.alias("row"), end(new))
        closed = F.struct(F.concat(acc["done"], F.array(F.struct(acc["row"].alias("row"), acc["emitted_ms"].alias("emitted_ms"))))
                          .alias("done"), new.alias("row"), end(new))
        kept = F.struct(acc["done"].alias("done"), F.when(newest(new) >= newest(acc["row"]), new).otherwise(acc["row"]).alias("row"),
                        acc["emitted_ms"].alias("emitted_ms"))
        return F.when(acc["row"].isNull(), opened).when(new["et_ms"] > acc["emitted_ms"], closed).otherwise(kept)

    first = F.element_at(rows, 1)
    one = F.array(F.struct(first.alias("row"), end(first)))
    none = F.when(F.lit(False), first)
    start = F.struct(F.filter(one, lambda x: F.lit(False)).alias("done"), none.alias("row"), F.lit(None).cast("bigint").alias("emitted_ms"))
    walked = F.aggregate(F.array_sort(rows), start, step, lambda acc: F.concat(
        acc["done"], F.array(F.struct(acc["row"].alias("row"), acc["emitted_ms"].alias("emitted_ms")))))
    return F.when(F.size(rows) == 1, one).otherwise(walked)


def sku_latest(orders: DataFrame, delay_ms: int = 5_000, event_time: bool = False,
               watermark: str = "0 seconds") -> DataFrame:
    """ST7 stream: the latest version per detail id within ``delay_ms``, with ``emitted_ms``.
    Timers run on processing time, or with ``event_time`` on the watermark of ``et``: there rows of an id
    that follow each other within the delay make a session window, and a session, once
    the watermark passes it, is cut into the periods. No Python call per id and batch; rows without a time
    are in no period. A row behind the watermark by less than the delay still counts, as a session of its own."""
    names = ["id", "seq", "ts_ms", "sku_id", *SKU_MEASURES]
    rows = orders.select(*names, F.col("et").cast("timestamp").alias("et"))
    if event_time:
        timed = rows.withWatermark("et", watermark)
        # a gap in milliseconds, as the periods: at delay_ms a row is still in, one later it is not
        sessions = timed.groupBy(F.session_window("et", f"{delay_ms + 1} milliseconds"), "id").agg(F.collect_list(F.struct(
            F.unix_millis("et").alias("et_ms"), "ts_ms", "seq", "sku_id", *SKU_MEASURES)).alias("rows"))
        found = sessions.select("id", F.explode(_periods(F.col("rows"), delay_ms, ("ts_ms", "seq"))).alias("p"))
        return found.select("id", *(F.col(f"p.row.{c}").alias(c) for c in names[1:]), F.col("p.emitted_ms").alias("emitted_ms"))
    columns = rows.drop("et").schema.fields
    state_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns)
    return rows.drop("et").groupBy("id").transformWithState(
        statefulProcessor=S.LatestWithin([f.name for f in columns], state_schema, "ts_ms", "seq", delay_ms),
        outputStructType=state_schema + ", emitted_ms bigint", outputMode="Append", timeMode="ProcessingTime")


class SkuOrders:
    """``dimensions``: the six dimension tables (arguments of ``dims.enrich_sku``), read anew
    in each batch."""

    def __init__(self, spark: SparkSession, path: str, dimensions: Callable[[], Mapping[str, DataFrame]],
                 length: str = "10 seconds", buckets: int = 16):
        self.dimensions, self.length = dimensions, length
        self.sums = KeyedTable(spark, f"{path}/sums", CELL, SUMS, buckets)
        self.out = KeyedTable(spark, f"{path}/out", CELL, OUT, buckets)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` function over the rows of ``sku_latest``."""
        rows = batch.select(slot(F.timestamp_millis("emitted_ms"), self.length).alias("window"), "sku_id",
                            *(F.col(a).cast(MONEY).alias(b) for a, b in SKU_MEASURES.items()))
        summed = lambda df: df.groupBy(*CELL).agg(
            *(F.sum(c).cast("decimal(38,2)").alias(c) for c in SKU_MEASURES.values()))
        new = summed(rows).persist()
        try:
            cells = new.count() + self.sums.read(batch_id).count()
            buckets = self.sums.commit(batch_id, new, lambda stored, more: summed(stored.unionByName(more)),
                                       passes=1 + cells // AT_ONCE)
            if not buckets:
                return
            now = self.sums.part(batch_id + 1, buckets).join(new.select(*CELL), CELL, "left_semi")
            # the same cells, so the same buckets: the hops are not run to find them
            self.out.commit(batch_id, self.named(now, new.select("sku_id").distinct()), replaced(CELL, new.select(*CELL)),
                            buckets, 1 + cells // AT_ONCE)
        finally:
            new.unpersist()

    def named(self, cells: DataFrame, skus: DataFrame) -> DataFrame:
        """``cells`` with the names of their SKUs. The hops run over the batch's SKUs (``skus``), not its cells, which
        would be dealt anew for each hop: by the few brands and categories too."""
        names = dims.enrich_sku(skus, **self.dimensions()).withColumnRenamed("sku_id", "_sku")
        return cells.join(names, cells["sku_id"].eqNullSafe(names["_sku"]), "left").drop("_sku")

    def read(self) -> DataFrame:
        """The metric rows as last emitted."""
        return self.out.read().select(*window_labels("window"), "sku_id", *NAMES, *SKU_MEASURES.values())


def sku_order_window(orders: Replay, dimensions: Callable[[], Mapping[str, DataFrame]], length: str = "10 seconds",
                     delay_ms: int = 5_000, event_time: bool = False) -> DataFrame:
    spark = orders.spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    path = state_dir(spark, f"sku-{uuid.uuid4().hex[:8]}")
    job = SkuOrders(spark, path, dimensions, length)
    with settings(spark, COMPACT if event_time else {}):
        orders.run(sku_latest(orders.stream, delay_ms, event_time).writeStream.foreachBatch(job.write)
                   .option("checkpointLocation", f"{path}/checkpoint"))
    return job.read()
