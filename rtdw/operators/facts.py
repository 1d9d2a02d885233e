"""Fact-table jobs: table/op selections over the change stream and the
fact joins (PRJ10-PRJ21, J1-J8, FN5).

Every selection is ``where`` + map-key projections over one envelope
DataFrame; Catalyst pushes the ``source.table`` predicate to the top of each
branch, and when the change log is stored partitioned by table the scan
reads only that table's files. All selections default to snapshot rows
(``op = 'r'``) like the reference (trap X9); pass ``ops`` to widen.

All joins are plain equi-joins (X10). No broadcast hints: both sides of every
fact join grow with the data, so Spark's size checks (static statistics and
AQE's measured shuffle sizes) pick the strategy, and AQE splits skewed keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import ms_string_to_date
from ..sources.envelope import table_is

SNAPSHOT = ("r",)


def _after(k: str) -> Column:
    return F.col("after")[k]


def _pick(*names: str) -> list[Column]:
    return [_after(n).alias(n) for n in names]


def _sel(cdc: DataFrame, table: str, ops: Sequence[str], cond: Column | None = None) -> DataFrame:
    c = table_is(table) & F.col("op").isin(*ops)
    if cond is not None:
        c = c & cond
    return cdc.where(c)


def original_amount(sku_num: Column, price: Column) -> Column:
    """PRJ20: ``sku_num x order_price`` as decimal(16,2) operands, rendered as a
    string with four decimals (``11999.0000``)."""
    return (sku_num.cast("decimal(16,2)") * price.cast("decimal(16,2)")).cast("string")


# ------------------------------------------------------------ selections --

def select_order_detail(cdc: DataFrame, ops: Sequence[str] = SNAPSHOT) -> DataFrame:
    """PRJ13 (+PRJ20)."""
    return _sel(cdc, "order_detail", ops).select(
        *_pick("id", "order_id", "sku_id", "sku_name", "create_time", "source_id",
               "source_type", "sku_num"),
        original_amount(_after("sku_num"), _after("order_price")).alias("split_original_amount"),
        *_pick("split_total_amount", "split_activity_amount", "split_coupon_amount"),
        "ts_ms")


def select_order_info(cdc: DataFrame, ops: Sequence[str] = SNAPSHOT, keep: Sequence[str] = ()) -> DataFrame:
    """PRJ14; ``keep``: columns of the envelope to carry (event time, in streams)."""
    return _sel(cdc, "order_info", ops).select(*_pick("id", "user_id", "province_id"), *keep)


def select_order_detail_activity(cdc: DataFrame, ops: Sequence[str] = SNAPSHOT, keep: Sequence[str] = ()) -> DataFrame:
    """PRJ15."""
    return _sel(cdc, "order_detail_activity", ops).select(
        *_pick("order_detail_id", "activity_id", "activity_rule_id"), *keep)


def select_order_detail_coupon(cdc: DataFrame, ops: Sequence[str] = SNAPSHOT, keep: Sequence[str] = ()) -> DataFrame:
    """PRJ16."""
    return _sel(cdc, "order_detail_coupon", ops).select(*_pick("order_detail_id", "coupon_id"), *keep)


def select_comment_info(cdc: DataFrame, ops: Sequence[str] = SNAPSHOT) -> DataFrame:
    """PRJ11."""
    return _sel(cdc, "comment_info", ops).select(
        *_pick("id", "user_id", "sku_id", "appraise", "comment_txt", "create_time"), "ts_ms")


def select_cart_add(cdc: DataFrame) -> DataFrame:
    """PRJ12 in reduced form (trap X2): the reference's predicate is
    ``op='r' OR (op='r' AND ... AND n > n)``, which is just ``op='r'``, and
    its IF then always takes the ``op='r'`` arm, so ``sku_num`` passes through."""
    return _sel(cdc, "cart_info", SNAPSHOT).select(
        *_pick("id", "user_id", "sku_id", "sku_num"), "ts_ms")


def select_order_cancel(cdc: DataFrame, strict: bool = False,
                        ops: Sequence[str] = SNAPSHOT) -> DataFrame:
    """PRJ17. The reference writes ``table AND op AND status='1001' OR
    status='1003'`` without brackets (trap X1): any row of any table or op
    with status 1003 passes. ``strict=True`` brackets the two statuses."""
    status = _after("order_status")
    base = table_is("order_info") & F.col("op").isin(*ops)
    if strict:
        cond = base & status.isin("1001", "1003")
    else:
        cond = (base & (status == "1001")) | (status == "1003")
    return cdc.where(F.coalesce(cond, F.lit(False))).select(
        *_pick("id", "operate_time"), "ts_ms")


def select_payment_success(cdc: DataFrame, ops: Sequence[str] = SNAPSHOT) -> DataFrame:
    """PRJ18."""
    st = _after("payment_status")
    return _sel(cdc, "payment_info", ops, st.isNotNull() & (st == "1602")).select(
        *_pick("user_id", "order_id", "payment_type", "callback_time"), "ts_ms")


def select_refund_request(cdc: DataFrame, ops: Sequence[str] = SNAPSHOT) -> DataFrame:
    """PRJ19 (refund requests)."""
    return _sel(cdc, "order_refund_info", ops).select(
        *_pick("id", "user_id", "order_id", "sku_id", "refund_type", "refund_num",
               "refund_amount", "refund_reason_type", "refund_reason_txt", "create_time"),
        "ts_ms")


def select_order_refunded(cdc: DataFrame, ops: Sequence[str] = SNAPSHOT,
                          with_user: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """PRJ19 (order headers in status 1006)."""
    st = _after("order_status")
    cols = ["id", "user_id", "province_id"] if with_user else ["id", "province_id"]
    return _sel(cdc, "order_info", ops, st.isNotNull() & (st == "1006")).select(*_pick(*cols), *keep)


def select_refund_payment_success(cdc: DataFrame, ops: Sequence[str] = SNAPSHOT) -> DataFrame:
    """PRJ19 (refund payments in status 1602)."""
    st = _after("refund_status")
    return _sel(cdc, "refund_payment", ops, st.isNotNull() & (st == "1602")).select(
        *_pick("id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount"),
        "ts_ms")


def select_refund_approved(cdc: DataFrame, ops: Sequence[str] = SNAPSHOT, keep: Sequence[str] = ()) -> DataFrame:
    """PRJ19 (refund requests in status 0705)."""
    st = _after("refund_status")
    return _sel(cdc, "order_refund_info", ops, st.isNotNull() & (st == "0705")).select(
        *_pick("order_id", "sku_id", "refund_num"), *keep)


# ----------------------------------------------------------------- joins --

def fact_comment(cdc: DataFrame, base_dic: DataFrame) -> DataFrame:
    """Comments joined to the dictionary; unknown codes drop out."""
    c = select_comment_info(cdc)
    d = base_dic.select("dic_code", F.col("info.dic_name").alias("appraise_name"))
    return c.join(d, c.appraise == d.dic_code).select(
        "id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts_ms")


def fact_order_detail(cdc: DataFrame, ops: Sequence[str] = SNAPSHOT) -> DataFrame:
    """J2-J4 + FN5: detail x header (inner) + activity (left) + coupon (left)."""
    od = select_order_detail(cdc, ops).alias("od")
    oi = select_order_info(cdc, ops).alias("oi")
    act = select_order_detail_activity(cdc, ops).alias("act")
    cou = select_order_detail_coupon(cdc, ops).alias("cou")
    j = (od.join(oi, F.col("od.order_id") == F.col("oi.id"))
           .join(act, F.col("od.id") == F.col("act.order_detail_id"), "left")
           .join(cou, F.col("od.id") == F.col("cou.order_detail_id"), "left"))
    return j.select(
        F.col("od.id").alias("id"), F.col("od.order_id").alias("order_id"),
        F.col("oi.user_id").alias("user_id"), F.col("od.sku_id").alias("sku_id"),
        F.col("od.sku_name").alias("sku_name"), F.col("oi.province_id").alias("province_id"),
        F.col("act.activity_id").alias("activity_id"),
        F.col("act.activity_rule_id").alias("activity_rule_id"),
        F.col("cou.coupon_id").alias("coupon_id"),
        ms_string_to_date(F.col("od.create_time")).alias("date_id"),
        F.col("od.create_time").alias("create_time"), F.col("od.sku_num").alias("sku_num"),
        F.col("od.split_original_amount").alias("split_original_amount"),
        F.col("od.split_activity_amount").alias("split_activity_amount"),
        F.col("od.split_coupon_amount").alias("split_coupon_amount"),
        F.col("od.split_total_amount").alias("split_total_amount"),
        F.col("od.ts_ms").alias("ts_ms"))


def fact_order_cancel(order_detail_fact: DataFrame, cdc: DataFrame, strict: bool = False) -> DataFrame:
    """Order-detail facts of cancelled orders; ``operate_time`` becomes
    ``cancel_time`` and ``ts_ms`` is the cancel event's."""
    od = order_detail_fact.alias("od")
    oc = select_order_cancel(cdc, strict).alias("oc")
    return od.join(oc, F.col("od.order_id") == F.col("oc.id")).select(*cancel_columns())


def cancel_columns() -> list[Column]:
    """PRJ21 of J5, over the aliases ``od`` and ``oc``."""
    keep = ["id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
            "activity_rule_id", "coupon_id"]
    return [
        *[F.col(f"od.{c}").alias(c) for c in keep],
        ms_string_to_date(F.col("od.create_time")).alias("date_id"),
        F.col("oc.operate_time").alias("cancel_time"),
        *[F.col(f"od.{c}").alias(c) for c in ("sku_num", "split_original_amount",
                                              "split_activity_amount", "split_coupon_amount",
                                              "split_total_amount")],
        F.col("oc.ts_ms").alias("ts_ms")]


def fact_order_pay_success(order_detail_fact: DataFrame, cdc: DataFrame,
                           within_ms: int | None = None) -> DataFrame:
    """Successful payments x order details. The reference's comment
    promises an interval join but the code has none; ``within_ms`` adds the
    bound as an option."""
    pi = select_payment_success(cdc).alias("pi")
    od = order_detail_fact.alias("od")
    cond = F.col("pi.order_id") == F.col("od.order_id")
    if within_ms is not None:
        cond = cond & (F.col("pi.ts_ms").between(F.col("od.ts_ms") - within_ms,
                                                 F.col("od.ts_ms") + within_ms))
    return pi.join(od, cond).select(*pay_columns())


def pay_columns() -> list[Column]:
    """PRJ21 of J6, over the aliases ``od`` and ``pi``."""
    return [
        F.col("od.id").alias("order_detail_id"), F.col("od.order_id").alias("order_id"),
        *[F.col(f"od.{c}").alias(c) for c in ("user_id", "sku_id", "sku_name", "province_id",
                                              "activity_id", "activity_rule_id", "coupon_id")],
        F.col("pi.payment_type").alias("payment_type_code"),
        F.col("pi.callback_time").alias("callback_time"),
        *[F.col(f"od.{c}").alias(c) for c in ("sku_num", "split_original_amount",
                                              "split_activity_amount", "split_coupon_amount")],
        F.col("od.split_total_amount").alias("split_payment_amount"),
        F.col("pi.ts_ms").alias("ts_ms")]


def fact_order_refund(cdc: DataFrame) -> DataFrame:
    """Refund requests x refunded order headers."""
    ri = select_refund_request(cdc).alias("ri")
    oi = select_order_refunded(cdc).alias("oi")
    return ri.join(oi, F.col("ri.order_id") == F.col("oi.id")).select(*refund_columns())


def refund_columns() -> list[Column]:
    """PRJ21 of J7, over the aliases ``ri`` and ``oi``."""
    return [
        *[F.col(f"ri.{c}").alias(c) for c in ("id", "user_id", "order_id", "sku_id")],
        F.col("oi.province_id").alias("province_id"),
        ms_string_to_date(F.col("ri.create_time")).alias("date_id"),
        F.col("ri.create_time").alias("create_time"),
        F.col("ri.refund_type").alias("refund_type_code"),
        F.col("ri.refund_reason_type").alias("refund_reason_type_code"),
        *[F.col(f"ri.{c}").alias(c) for c in ("refund_reason_txt", "refund_num", "refund_amount",
                                              "ts_ms")]]


def fact_refund_pay_success(cdc: DataFrame) -> DataFrame:
    """Refund payments x approved refund requests on (order, sku) x
    refunded order headers."""
    rp = select_refund_payment_success(cdc).alias("rp")
    ori = select_refund_approved(cdc).alias("ori")
    oi = select_order_refunded(cdc, with_user=True).alias("oi")
    j = (rp.join(ori, (F.col("rp.order_id") == F.col("ori.order_id"))
                 & (F.col("rp.sku_id") == F.col("ori.sku_id")))
           .join(oi, F.col("rp.order_id") == F.col("oi.id")))
    return j.select(*refund_pay_columns())


def refund_pay_columns() -> list[Column]:
    """PRJ21 of J8, over the aliases ``rp``, ``ori`` and ``oi``."""
    return [
        F.col("rp.id").alias("id"), F.col("oi.user_id").alias("user_id"),
        F.col("rp.order_id").alias("order_id"), F.col("rp.sku_id").alias("sku_id"),
        F.col("oi.province_id").alias("province_id"),
        F.col("rp.payment_type").alias("payment_type_code"),
        ms_string_to_date(F.col("rp.callback_time")).alias("date_id"),
        F.col("rp.callback_time").alias("callback_time"),
        F.col("ori.refund_num").alias("refund_num"),
        F.col("rp.total_amount").alias("refund_amount"),
        F.col("rp.ts_ms").alias("ts_ms")]


def upsert_latest(df: DataFrame, key: Sequence[str] | str, seq_col: str = "ts_ms",
                  tie_col: str | None = None) -> DataFrame:
    """SNK4 compaction view: the newest row per primary key, as an upsert
    topic reader would see it. ``max(struct(seq, tie, row))`` per key is a
    partial aggregate, so hot keys are combined before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [seq_col] + ([tie_col] if tie_col else [])
    rest = [c for c in df.columns if c not in keys and c not in order]
    agg = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in order + rest]).select(*df.columns)
