"""The query catalogue: one callable per query.

Each entry takes ``(spark, sf_dir)``, binds the driver tables with
``rtdw.sources.bindings`` and runs the library's operators. The matching
DuckDB statement lives under the same name in ``rtdw.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from .. import sinks
from ..functions import keywords, timefn
from ..operators import dedupe, dims, facts, logs, metrics, routing
from ..streaming import jobs as stream_jobs
from ..streaming.replay import in_time_order
from ..sources import bindings as B
from ..sources import envelope
from ..sources.envelope import ORDER_DETAIL_FACT_FIELDS, ORDER_DETAIL_FACT_SCHEMA

Query = Callable[[SparkSession, str], DataFrame]


def traffic_vc_ch_ar_is_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.traffic_vc_ch_ar_is_new(B.page_log(spark, sf_dir))



def _money(df: DataFrame, cols) -> DataFrame:
    """Amounts leave the engine as DECIMAL; the catalogue reports DOUBLE."""
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("double"))
    return df


def traffic_home_detail_uv(spark, sf_dir):
    return metrics.traffic_home_detail_uv(B.page_log(spark, sf_dir))


def user_login_window(spark, sf_dir):
    return metrics.user_login_window(B.page_log(spark, sf_dir))


def cart_add_uu_window(spark, sf_dir):
    return metrics.cart_add_uu_window(B.cart_info(spark, sf_dir), "2 seconds")


def cart_add_uu_window_ms(spark, sf_dir):
    # the reference's effective window: 2 s over ts_ms * 1000 = 2 ms
    return metrics.cart_add_uu_window(B.cart_info(spark, sf_dir), "2 milliseconds")


def province_order_window(spark, sf_dir):
    out = metrics.province_order_window(B.order_fact(spark, sf_dir),
                                        B.dim_base_province(spark, sf_dir), "4 seconds")
    return _money(out, ["order_amount"])


def province_order_window_ms(spark, sf_dir):
    out = metrics.province_order_window(B.order_fact(spark, sf_dir),
                                        B.dim_base_province(spark, sf_dir), "4 milliseconds")
    return _money(out, ["order_amount"])


def _sku_window(spark, sf_dir):
    return metrics.sku_order_window(B.order_fact(spark, sf_dir), "10 seconds")


def sku_order_window(spark, sf_dir):
    return _money(_sku_window(spark, sf_dir), list(metrics.SKU_MEASURES.values()))


def sku_order_enriched(spark, sf_dir):
    out = dims.enrich_sku(
        _sku_window(spark, sf_dir), B.dim_sku_info(spark, sf_dir), B.dim_spu_info(spark, sf_dir),
        B.dim_base_trademark(spark, sf_dir), B.dim_base_category3(spark, sf_dir),
        B.dim_base_category2(spark, sf_dir), B.dim_base_category1(spark, sf_dir))
    return _money(out, list(metrics.SKU_MEASURES.values()))


def keyword_tokens(spark, sf_dir):
    sl = B.search_log(spark, sf_dir)
    searched = sl.where((F.col("last_page_id") == "search") & (F.col("item_type") == "keyword")
                        & F.col("item").isNotNull()).select("et", "item")
    return keywords.explode_keywords(searched, "item", "keyword")


def keyword_window(spark, sf_dir):
    return metrics.keyword_window(keyword_tokens(spark, sf_dir), "10 seconds")


def is_new_repair(spark, sf_dir):
    pl = B.page_log(spark, sf_dir).select("mid", "d", "et", "seq", "is_new")
    return dedupe.repair_is_new(pl).select("seq", "mid", "is_new", "is_new_fixed")


def uv_by_channel(spark, sf_dir):
    return metrics.uv_by_channel(traffic_vc_ch_ar_is_new(spark, sf_dir))


def amount_by_province(spark, sf_dir):
    pw = metrics.province_order_window(B.order_fact(spark, sf_dir),
                                       B.dim_base_province(spark, sf_dir), "4 seconds")
    return _money(metrics.amount_by_province(pw), ["order_amount"])


# ------------------------------------------------------- change stream --

CDC_SELECTIONS = {
    "order_detail": facts.select_order_detail,
    "order_info": facts.select_order_info,
    "order_detail_activity": facts.select_order_detail_activity,
    "order_detail_coupon": facts.select_order_detail_coupon,
    "comment_info": facts.select_comment_info,
    "cart_add": facts.select_cart_add,
    "order_cancel": facts.select_order_cancel,
    "order_cancel_strict": lambda cdc: facts.select_order_cancel(cdc, strict=True),
    "payment_success": facts.select_payment_success,
    "refund_request": facts.select_refund_request,
    "order_refunded": lambda cdc: facts.select_order_refunded(cdc, with_user=True),
    "refund_payment_success": facts.select_refund_payment_success,
    "refund_approved": facts.select_refund_approved,
}


def _cdc_select(name):
    def run(spark, sf_dir):
        return CDC_SELECTIONS[name](B.topic_db(spark, sf_dir))
    run.__name__ = f"cdc_select_{name}"
    return run


def cdc_gate(spark, sf_dir):
    g = envelope.cdc_gate(B.topic_db(spark, sf_dir), B.DB_NAME)
    return g.select(F.col("source")["table"].alias("source_table"), "op", "ts_ms", "seq",
                    F.col("after")["id"].alias("after_id"))


def config_image(spark, sf_dir):
    img = envelope.config_image(B.topic_db(spark, sf_dir))
    return img.select(F.col("source")["table"].alias("source_table"), "op", "seq",
                      F.col("image")["id"].alias("image_id"),
                      F.col("image")["order_status"].alias("image_status"))


def split_original_amount(spark, sf_dir):
    return facts.select_order_detail(B.topic_db(spark, sf_dir)).select(
        "id", "sku_num", "split_original_amount")


def fact_comment(spark, sf_dir):
    return facts.fact_comment(B.topic_db(spark, sf_dir), B.base_dic(spark))


def fact_cart_add(spark, sf_dir):
    return facts.select_cart_add(B.topic_db(spark, sf_dir))


def fact_order_detail(spark, sf_dir):
    return facts.fact_order_detail(B.topic_db(spark, sf_dir))


def fact_order_cancel(spark, sf_dir):
    cdc = B.topic_db(spark, sf_dir)
    return facts.fact_order_cancel(facts.fact_order_detail(cdc), cdc)


def fact_order_cancel_strict(spark, sf_dir):
    cdc = B.topic_db(spark, sf_dir)
    return facts.fact_order_cancel(facts.fact_order_detail(cdc), cdc, strict=True)


def fact_order_pay_suc(spark, sf_dir):
    cdc = B.topic_db(spark, sf_dir)
    return facts.fact_order_pay_success(facts.fact_order_detail(cdc), cdc)


def fact_order_refund(spark, sf_dir):
    return facts.fact_order_refund(B.topic_db(spark, sf_dir))


def fact_refund_pay_suc(spark, sf_dir):
    return facts.fact_refund_pay_success(B.topic_db(spark, sf_dir))


def upsert_latest(spark, sf_dir):
    of = B.order_fact(spark, sf_dir).select(
        "id", "order_id", "sku_id", "province_id", "split_total_amount", "ts_ms", "seq")
    return _money(facts.upsert_latest(of, "id", seq_col="seq"), ["split_total_amount"])


QUERIES: dict[str, Query] = {
    **{f"cdc_select_{n}": _cdc_select(n) for n in CDC_SELECTIONS},
    "cdc_gate": cdc_gate,
    "config_image": config_image,
    "split_original_amount": split_original_amount,
    "fact_comment": fact_comment,
    "fact_cart_add": fact_cart_add,
    "fact_order_detail": fact_order_detail,
    "fact_order_cancel": fact_order_cancel,
    "fact_order_cancel_strict": fact_order_cancel_strict,
    "fact_order_pay_suc": fact_order_pay_suc,
    "fact_order_refund": fact_order_refund,
    "fact_refund_pay_suc": fact_refund_pay_suc,
    "upsert_latest": upsert_latest,
    "traffic_vc_ch_ar_is_new": traffic_vc_ch_ar_is_new,
    "traffic_home_detail_uv": traffic_home_detail_uv,
    "user_login_window": user_login_window,
    "cart_add_uu_window": cart_add_uu_window,
    "cart_add_uu_window_ms": cart_add_uu_window_ms,
    "province_order_window": province_order_window,
    "province_order_window_ms": province_order_window_ms,
    "sku_order_window": sku_order_window,
    "sku_order_enriched": sku_order_enriched,
    "keyword_window": keyword_window,
    "is_new_repair": is_new_repair,
    "uv_by_channel": uv_by_channel,
    "amount_by_province": amount_by_province,
}


# ------------------------------------------------- routing and dimensions --

def dim_route(spark, sf_dir):
    out = routing.dim_route(B.topic_db(spark, sf_dir), B.dim_config_changelog(spark), B.DB_NAME)
    return out.select("sink_table", "sink_family", "op", "ts_ms", "seq", "row_key",
                      routing.map_signature(F.col("data")).alias("data_sig"))


def dwd_route(spark, sf_dir):
    out = routing.dwd_route(B.topic_db(spark, sf_dir), B.dwd_config_changelog(spark))
    return out.select("sink_table", "seq", "ts",
                      routing.map_signature(F.col("data")).alias("data_sig"))


def dim_merge(spark, sf_dir):
    return dims.dim_merge(B.dim_changelog(spark, sf_dir), "id",
                          ["name", "nation_id", "balance", "segment"])


def dim_lookup_miss(spark, sf_dir):
    """Comment rows looked up in the province dimension by a key
    that is NULL for error comments and out of range for some users."""
    c = B.comment_info(spark, sf_dir).select(
        "id", F.when(F.col("appraise") != "error", (F.col("user_id").cast("bigint") % 30)
                     .cast("string")).alias("province_id"))
    return dims.lookup_dim(c, B.dim_base_province(spark, sf_dir), "province_id",
                           {"name": "province_name"})


# ------------------------------------------------------------------- logs --

def _split(spark, sf_dir):
    return logs.split(logs.repair_log(B.log_records(spark, sf_dir)))


def _n(arr):
    return F.when(F.col(arr).isNotNull(), F.size(arr))


def log_err(spark, sf_dir):
    e = _split(spark, sf_dir)["err"]
    return e.select("seq", F.col("common")["mid"].alias("mid"),
                    F.col("common")["is_new"].alias("is_new"),
                    F.col("page")["page_id"].alias("page_id"),
                    F.col("start")["entry"].alias("start_entry"),
                    F.col("err")["error_code"].alias("error_code"),
                    _n("displays").alias("n_displays"), _n("actions").alias("n_actions"), "ts")


def log_start(spark, sf_dir):
    s = _split(spark, sf_dir)["start"]
    return s.select("seq", F.col("common")["mid"].alias("mid"),
                    F.col("common")["is_new"].alias("is_new"),
                    F.col("start")["entry"].alias("entry"),
                    F.col("start")["loading_time"].alias("loading_time"),
                    F.col("err").isNotNull().alias("has_err"), "ts")


def log_page(spark, sf_dir):
    p = _split(spark, sf_dir)["page"]
    return p.select("seq", F.col("common")["mid"].alias("mid"),
                    F.col("common")["is_new"].alias("is_new"),
                    F.col("page")["page_id"].alias("page_id"),
                    F.col("page")["last_page_id"].alias("last_page_id"),
                    F.col("page")["during_time"].alias("during_time"),
                    _n("displays").alias("displays_left"), _n("actions").alias("actions_left"),
                    F.col("err").isNotNull().alias("has_err"), "ts")


def log_display(spark, sf_dir):
    d = _split(spark, sf_dir)["display"]
    return d.select("seq", F.col("common")["mid"].alias("mid"),
                    F.col("page")["page_id"].alias("page_id"),
                    F.col("display")["item"].alias("item"),
                    F.col("display")["item_type"].alias("item_type"),
                    F.col("display")["pos_id"].alias("pos_id"), "ts")


def log_action(spark, sf_dir):
    a = _split(spark, sf_dir)["action"]
    return a.select("seq", F.col("common")["mid"].alias("mid"),
                    F.col("page")["page_id"].alias("page_id"),
                    F.col("action")["action_id"].alias("action_id"),
                    F.col("action")["item"].alias("item"))


def dirty_records(spark, sf_dir):
    _, dirty = logs.clean(B.log_json(spark, sf_dir), keep=("seq",))
    return dirty.select("seq", "value")


def metric_json(spark, sf_dir):
    """PRJ29: metric rows as snake_case JSON (NULL fields dropped)."""
    pw = province_order_window(spark, sf_dir)
    return sinks.metric_json(pw).select("value")


def date_functions(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    ms = timefn.ts_to_ms("o_orderdate")
    d = timefn.ms_to_date(ms)
    dt = timefn.ms_to_datetime(ms)
    return o.select(
        "o_orderkey", ms.alias("ms"), d.alias("d_str"), dt.alias("dt_str"),
        timefn.ms_to_yyyymmdd(ms).alias("ymd"),
        timefn.datetime_str_to_ms(dt).alias("ms_from_dt"),
        timefn.date_str_to_ms(d).alias("ms_from_d"),
        timefn.ms_string_to_date(ms.cast("string")).alias("fn5_date"),
        timefn.previous_day(F.to_date(d)).cast("string").alias("prev_day"))


QUERIES.update({
    "dim_route": dim_route,
    "dwd_route": dwd_route,
    "dim_merge": dim_merge,
    "dim_lookup_miss": dim_lookup_miss,
    "log_err": log_err,
    "log_start": log_start,
    "log_page": log_page,
    "log_display": log_display,
    "log_action": log_action,
    "dirty_records": dirty_records,
    "metric_json": metric_json,
    "date_functions": date_functions,
})


# ------------------------------------------------------------- streaming --
# Stream forms: the events table is read as a file stream and run with an
# available-now trigger; windows come out once the watermark passes them.

def stream_traffic_vc_ch_ar_is_new(spark, sf_dir):
    ev = stream_jobs.events_replayed(spark, sf_dir)
    return stream_jobs.run_replayed(stream_jobs.traffic_vc_ch_ar_is_new(ev.stream), ev, "traffic")


def stream_traffic_home_detail_uv(spark, sf_dir):
    ev = stream_jobs.events_replayed(spark, sf_dir)
    # the closing record's page must pass the page filter, to move the watermark
    pages = B.page_log_from(ev.stream).withColumn("page_id", F.when(
        F.col("uid") == str(stream_jobs.CLOSING_USER), "home").otherwise(F.col("page_id")))
    return stream_jobs.run_replayed(stream_jobs.traffic_home_detail_uv(pages), ev, "home-detail")


def stream_user_login_window(spark, sf_dir):
    ev = stream_jobs.events_replayed(spark, sf_dir)
    return stream_jobs.run_replayed(stream_jobs.user_login_window(ev.stream), ev, "login")


def stream_cart_add_uu_window(spark, sf_dir):
    cart = B.cart_info(spark, sf_dir).select("user_id", "seq", "ts_ms")
    cart = cart.withColumn("et", F.timestamp_millis("ts_ms"))
    closing = spark.sql("SELECT timestamp'2200-01-01 00:00:00' AS et").select(
        F.lit(str(stream_jobs.CLOSING_USER)).cast(cart.schema["user_id"].dataType).alias("user_id"),
        F.lit(0).cast(cart.schema["seq"].dataType).alias("seq"), F.unix_millis("et").alias("ts_ms"), "et")
    replay = in_time_order(cart, "cart", "et", closing)
    return stream_jobs.run_replayed(stream_jobs.cart_add_uu_window(replay.stream), replay, "cart")


def stream_is_new_repair(spark, sf_dir):
    ev = stream_jobs.events_replayed(spark, sf_dir)
    out = stream_jobs.run_replayed(stream_jobs.is_new_repair(ev.stream), ev, "is_new")
    return out.where(F.col("mid") != f"mid_{stream_jobs.CLOSING_USER}").select(
        "seq", "mid", "is_new", "is_new_fixed")


def stream_keyword_window(spark, sf_dir):
    """The search log is built once and replayed: a join inside the stream would read every text in each batch."""
    log = B.search_log(spark, sf_dir).withColumn("et", F.col("et").cast("timestamp"))
    # the closing search has no words, but passes the keyword filter, to move the watermark
    values = {"last_page_id": "search", "item_type": "keyword", "item": "", "et": "2200-01-01 00:00:00"}
    closing = spark.range(1).select(*(F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in log.schema.fields))
    replay = in_time_order(log, "search", "et", closing)
    return stream_jobs.run_replayed(stream_jobs.keyword_window(replay.stream), replay, "keyword")


def stream_province_order_window(spark, sf_dir):
    """ST6 over several batches: the order fact (derived from the tables) replayed
    in arrival order, so that replaced rows come in later batches too."""
    of = B.order_fact(spark, sf_dir).select(
        "id", "seq", "order_id", "province_id", "split_total_amount", "et", "ts_ms")
    out = stream_jobs.province_order_window(in_time_order(of, "order-fact", "et", drop=True),
                                            lambda: B.dim_base_province(spark, sf_dir))
    return _money(out, ["order_amount"])


QUERIES.update({
    "stream_traffic_vc_ch_ar_is_new": stream_traffic_vc_ch_ar_is_new,
    "stream_traffic_home_detail_uv": stream_traffic_home_detail_uv,
    "stream_user_login_window": stream_user_login_window,
    "stream_cart_add_uu_window": stream_cart_add_uu_window,
    "stream_is_new_repair": stream_is_new_repair,
    "stream_keyword_window": stream_keyword_window,
    "stream_province_order_window": stream_province_order_window,
})


# ------------------------------------------------- facts re-read from text --

def _fact_from_json(spark, sf_dir):
    """SRC5/PRJ30: the order fact written as JSON text (amounts as strings) and
    read back through the fact topic's schema."""
    of = B.order_fact(spark, sf_dir)
    names = set(ORDER_DETAIL_FACT_FIELDS) & set(of.columns)
    text = of.select("seq", F.to_json(F.struct(
        *[F.col(c).cast("string").alias(c) for c in sorted(names)], "ts_ms")).alias("value"))
    fact = text.select("seq", F.from_json("value", ORDER_DETAIL_FACT_SCHEMA, {"mode": "FAILFAST"}).alias("j"))
    return fact.select("seq", "j.*").withColumn("et", F.timestamp_millis("ts_ms"))


def province_order_from_fact(spark, sf_dir):
    out = metrics.province_order_window(_fact_from_json(spark, sf_dir), B.dim_base_province(spark, sf_dir), "4 seconds")
    return _money(out, ["order_amount"])


def sku_order_from_fact(spark, sf_dir):
    out = metrics.sku_order_window(_fact_from_json(spark, sf_dir), "10 seconds")
    return _money(out, list(metrics.SKU_MEASURES.values()))


QUERIES.update({"province_order_from_fact": province_order_from_fact, "sku_order_from_fact": sku_order_from_fact})


# ------------------------------------------------------ JSON in, JSON out --

def metric_json_read(spark, sf_dir):
    """PRJ29: the metric's JSON lines, read back strictly."""
    pw = province_order_window(spark, sf_dir)
    return envelope.parse_strict(sinks.metric_json(pw), pw.schema)


def cdc_gate_json(spark, sf_dir):
    """SRC2/PRJ1/PRJ3: the change stream as JSON text, parsed and gated."""
    text = B.topic_db(spark, sf_dir).select("seq", F.to_json(F.struct(
        "op", "ts_ms", "before", "after", "source")).alias("value"))
    parsed = text.select("seq", F.from_json("value", envelope.CDC_SCHEMA, {"mode": "FAILFAST"}).alias("j"))
    g = envelope.cdc_gate(parsed.select("seq", "j.*"), B.DB_NAME)
    return g.select(F.col("source")["table"].alias("source_table"), "op", "ts_ms", "seq",
                    F.col("after")["id"].alias("after_id"))


def log_parsed(spark, sf_dir):
    """PRJ2: the good side of the tolerant log parse."""
    good, _ = logs.clean(B.log_json(spark, sf_dir), keep=("seq",))
    return good.select("seq", F.col("common")["mid"].alias("mid"), F.col("page")["page_id"].alias("page_id"), "ts")


QUERIES.update({"metric_json_read": metric_json_read, "cdc_gate_json": cdc_gate_json, "log_parsed": log_parsed})

from .stream_queries import STREAM_QUERIES  # noqa: E402

QUERIES.update(STREAM_QUERIES)
