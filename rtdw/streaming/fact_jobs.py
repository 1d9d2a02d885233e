"""The fact jobs as streams (J2-J8, ST10): chained stream-stream joins over the selections
of one change stream, with the join state's retention as watermark and time bound, and
keyed upsert output.

Every side carries its change's time under a watermark of ``retention`` and every join a time range of
the same width, so Spark drops state that can match nothing any more. A match further apart
than the retention is lost, as in the reference; rows may be late by the retention on
either side. A left join emits an unmatched row once the watermark passes its range (later,
not different, than the reference's retract-and-re-emit: the upsert gives the same final
row per key).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefn import ms_string_to_date
from ..operators import facts
from ..sinks.keyed import KeyedTable, newest

RETENTION = "1805 seconds"
STORE = "spark.sql.streaming.stateStore"
#: for the query at its start: join state on disk, in one store a join and partition instead of four. A batch
#: adds its changes to the checkpoint, not the stores' rewritten files; stores are packed closely, take no room
#: in advance and share one bounded piece of an executor's memory
JOIN_STATE = {f"{STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
              "spark.sql.streaming.join.stateFormatVersion": "3",
              f"{STORE}.rocksdb.changelogCheckpointing.enabled": "true", f"{STORE}.compression.codec": "zstd",
              f"{STORE}.rocksdb.compression": "zstd", f"{STORE}.rocksdb.allowFAllocate": "false",
              f"{STORE}.rocksdb.boundedMemoryUsage": "true"}
TIME = ("ts_ms",)


def _timed(df: DataFrame, alias: str, retention: str) -> DataFrame:
    """The side under an alias, with its event time ``_<alias>``."""
    return df.withColumn(f"_{alias}", F.timestamp_millis("ts_ms")).withWatermark(f"_{alias}", retention).alias(alias)


def _within(a: str, b: str, retention: str) -> Column:
    gap = F.expr(f"INTERVAL {retention}")
    return (F.col(a) >= F.col(b) - gap) & (F.col(a) <= F.col(b) + gap)


def order_detail_join(detail: DataFrame, header: DataFrame, activity: DataFrame, coupon: DataFrame,
                      retention: str = RETENTION, keep_time: bool = False) -> DataFrame:
    """J2-J4 on streams; with ``keep_time`` the detail's event time ``_od`` for the next join."""
    d, h, a, c = (_timed(x, n, retention) for x, n in
                  ((detail, "od"), (header, "oi"), (activity, "act"), (coupon, "cou")))
    j = (d.join(h, (F.col("od.order_id") == F.col("oi.id")) & _within("oi._oi", "od._od", retention))
          .join(a, (F.col("od.id") == F.col("act.order_detail_id")) & _within("act._act", "od._od", retention), "left")
          .join(c, (F.col("od.id") == F.col("cou.order_detail_id")) & _within("cou._cou", "od._od", retention), "left"))
    od = lambda *names: [F.col(f"od.{n}").alias(n) for n in names]
    return j.select(*od("id", "order_id"), F.col("oi.user_id").alias("user_id"), *od("sku_id", "sku_name"),
                    F.col("oi.province_id").alias("province_id"),
                    F.col("act.activity_id").alias("activity_id"),
                    F.col("act.activity_rule_id").alias("activity_rule_id"),
                    F.col("cou.coupon_id").alias("coupon_id"),
                    ms_string_to_date(F.col("od.create_time")).alias("date_id"),
                    *od("create_time", "sku_num", "split_original_amount", "split_activity_amount",
                        "split_coupon_amount", "split_total_amount", "ts_ms"),
                    *([F.col("od._od").alias("_od")] if keep_time else []))


def order_detail(cdc: DataFrame, retention: str = RETENTION, keep_time: bool = False) -> DataFrame:
    """J2-J4 from the change stream."""
    return order_detail_join(
        facts.select_order_detail(cdc), facts.select_order_info(cdc, keep=TIME),
        facts.select_order_detail_activity(cdc, keep=TIME), facts.select_order_detail_coupon(cdc, keep=TIME),
        retention, keep_time)


def order_cancel(cdc: DataFrame, retention: str = RETENTION) -> DataFrame:
    """J5; with the detail's time, which orders the versions of a key."""
    od = order_detail(cdc, retention, True).alias("od")
    oc = _timed(facts.select_order_cancel(cdc), "oc", retention)
    return od.join(oc, (F.col("od.order_id") == F.col("oc.id")) & _within("oc._oc", "od._od", retention)).select(
        *facts.cancel_columns(), F.col("od.ts_ms").alias("version_ms"))


def order_pay_success(cdc: DataFrame, retention: str = RETENTION) -> DataFrame:
    """J6, likewise."""
    od = order_detail(cdc, retention, True).alias("od")
    pi = _timed(facts.select_payment_success(cdc), "pi", retention)
    return od.join(pi, (F.col("pi.order_id") == F.col("od.order_id")) & _within("pi._pi", "od._od", retention)).select(
        *facts.pay_columns(), F.col("od.ts_ms").alias("version_ms"))


def order_refund(cdc: DataFrame, retention: str = RETENTION) -> DataFrame:
    """J7."""
    ri = _timed(facts.select_refund_request(cdc), "ri", retention)
    oi = _timed(facts.select_order_refunded(cdc, keep=TIME), "oi", retention)
    return ri.join(oi, (F.col("ri.order_id") == F.col("oi.id")) & _within("oi._oi", "ri._ri", retention)).select(
        *facts.refund_columns(), F.col("ri.ts_ms").alias("version_ms"))


def refund_pay_success(cdc: DataFrame, retention: str = RETENTION) -> DataFrame:
    """J8."""
    rp = _timed(facts.select_refund_payment_success(cdc), "rp", retention)
    ori = _timed(facts.select_refund_approved(cdc, keep=TIME), "ori", retention)
    oi = _timed(facts.select_order_refunded(cdc, with_user=True, keep=TIME), "oi", retention)
    j = rp.join(ori, (F.col("rp.order_id") == F.col("ori.order_id")) & (F.col("rp.sku_id") == F.col("ori.sku_id"))
                & _within("ori._ori", "rp._rp", retention))
    return j.join(oi, (F.col("rp.order_id") == F.col("oi.id")) & _within("oi._oi", "rp._rp", retention)).select(
        *facts.refund_pay_columns(), F.col("rp.ts_ms").alias("version_ms"))


#: name -> (job, key of the upsert)
JOBS: dict[str, tuple[Callable[..., DataFrame], str]] = {
    "order_cancel": (order_cancel, "id"), "order_pay_suc": (order_pay_success, "order_detail_id"),
    "order_refund": (order_refund, "id"), "refund_pay_suc": (refund_pay_success, "id")}


def fact_table(spark: SparkSession, path: str, fact: DataFrame, key: str, buckets: int = 16) -> KeyedTable:
    """The keyed table of a fact (SNK4): per key the newest version, ties by the row itself."""
    return KeyedTable(spark, path, [key], T.StructType([T.StructField(f.name, f.dataType) for f in fact.schema.fields]), buckets)


def upsert(table: KeyedTable) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer. The batch is read twice (buckets, merge), so it is kept: each reading
    would run the last join's state again."""
    def write(batch: DataFrame, n: int) -> None:
        batch.persist()
        try:
            table.commit(n, batch, newest(table.key, "version_ms"))
        finally:
            batch.unpersist()
    return write
