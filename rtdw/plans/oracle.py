"""Independent DuckDB SQL for every registered query.

Each statement recomputes the query from the raw driver tables with plain SQL
(window functions, joins, CASE) instead of the library's operators, so a
match means the Spark plan and the SQL agree on the same data. Bindings are
CTEs that mirror ``rtdw.sources.bindings`` rule for rule.

Hygiene: money is summed as DECIMAL and cast to DOUBLE at the end, counts are
cast to BIGINT, time labels are strings, every output column is aliased.
"""

from __future__ import annotations

PAGE_LOG = """
page_log AS (
  SELECT 'mid_'||CAST(user_id AS STRING) AS mid, CAST(user_id AS STRING) AS uid,
         'v'||CAST(event_id%3 AS STRING) AS vc, 'ch'||CAST(user_id%4 AS STRING) AS ch,
         'ar'||CAST(user_id%7 AS STRING) AS ar, CAST((event_id+user_id)%2 AS STRING) AS is_new,
         CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail'
              WHEN 'purchase' THEN 'payment' WHEN 'signup' THEN 'mine' ELSE 'error' END AS page_id,
         CASE WHEN event_type='signup' THEN 'login' WHEN event_id%50=0 THEN NULL ELSE 'search' END AS last_page_id,
         CAST(floor(value) AS BIGINT) AS during_time, ts AS et, CAST(ts AS DATE) AS d,
         (epoch_us(ts) // 1000) AS ts_ms, event_id AS seq, event_type, user_id, props, value
  FROM events)"""

ORDER_DETAIL = """
order_detail AS (
  SELECT CAST(l_orderkey AS STRING)||'-'||CAST(l_linenumber AS STRING) AS id,
         CAST(l_orderkey AS STRING) AS order_id, CAST(l_partkey AS STRING) AS sku_id,
         'sku_'||CAST(l_partkey AS STRING) AS sku_name, l_suppkey, l_partkey,
         CAST(l_quantity AS DECIMAL(16,2)) AS sku_num,
         CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price,
         CAST(l_extendedprice AS DECIMAL(16,2)) AS split_original_amount,
         CAST(l_discount*100 AS DECIMAL(16,2)) AS split_activity_amount,
         CAST(l_tax*100 AS DECIMAL(16,2)) AS split_coupon_amount,
         CAST(l_extendedprice AS DECIMAL(16,2)) AS split_total_amount,
         l_returnflag, l_linestatus, l_discount, l_tax,
         epoch_ms(l_shipdate) + (l_partkey % 20) * 1000 AS ts_ms,
         epoch_ms(epoch_ms(l_shipdate) + (l_partkey % 20) * 1000) AS et,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                      l_discount, l_tax, l_returnflag, l_linestatus) AS seq
  FROM lineitem)"""

ORDER_INFO = """
order_info AS (
  SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_custkey AS STRING) AS user_id,
         CAST(c_nationkey AS STRING) AS province_id,
         CASE o_orderstatus WHEN 'F' THEN '1001' WHEN 'P' THEN '1003' ELSE '1006' END AS order_status,
         CASE o_orderkey%4 WHEN 0 THEN 'c' WHEN 1 THEN 'u' WHEN 2 THEN 'd' ELSE 'r' END AS op,
         CASE WHEN o_orderkey%5=0 THEN 'order_detail' ELSE 'order_info' END AS source_table,
         CAST(epoch_ms(o_orderdate) AS STRING) AS operate_time,
         epoch_ms(o_orderdate) AS ts_ms, o_orderdate AS et, o_orderstatus, o_orderkey
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

ORDER_FACT = ORDER_DETAIL + "," + ORDER_INFO + """,
order_fact AS (
  SELECT od.*, oi.user_id, oi.province_id FROM order_detail od JOIN order_info oi ON od.order_id = oi.id)"""


def _labels(start_ms: str, len_ms: int) -> str:
    return (f"strftime(epoch_ms({start_ms}), '%Y-%m-%d %H:%M:%S') AS stt, "
            f"strftime(epoch_ms({start_ms} + {len_ms}), '%Y-%m-%d %H:%M:%S') AS edt, "
            f"strftime(epoch_ms({start_ms}), '%Y-%m-%d') AS cur_date")


def _bucket(ms_expr: str, len_ms: int) -> str:
    return f"(({ms_expr}) // {len_ms}) * {len_ms}"


def _ms_from_et(col: str = "et") -> str:
    # event times carry microseconds; floor to the window on microseconds
    return f"(epoch_us({col}) // 1000)"


def traffic_vc_ch_ar_is_new(len_ms: int = 10000) -> str:
    return f"""
WITH {PAGE_LOG},
f AS (SELECT *, row_number() OVER (PARTITION BY mid, d ORDER BY et, seq) AS rn FROM page_log),
b AS (SELECT *, {_bucket(_ms_from_et(), len_ms)} AS ws FROM f)
SELECT {_labels('ws', len_ms)}, vc, ch, ar, is_new,
       CAST(sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS uv_ct,
       CAST(sum(CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END) AS BIGINT) AS sv_ct,
       CAST(count(*) AS BIGINT) AS pv_ct,
       CAST(sum(during_time) AS BIGINT) AS dur_sum
FROM b GROUP BY ws, vc, ch, ar, is_new"""



def traffic_home_detail_uv(len_ms: int = 10000) -> str:
    return f"""
WITH {PAGE_LOG},
p AS (SELECT * FROM page_log WHERE page_id IN ('home', 'good_detail')),
f AS (SELECT *, row_number() OVER (PARTITION BY mid, d, page_id ORDER BY et, seq) AS rn FROM p),
b AS (SELECT *, {_bucket(_ms_from_et(), len_ms)} AS ws FROM f WHERE rn = 1)
SELECT {_labels('ws', len_ms)},
       CAST(sum(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END) AS BIGINT) AS home_uv_ct,
       CAST(sum(CASE WHEN page_id = 'good_detail' THEN 1 ELSE 0 END) AS BIGINT) AS good_detail_uv_ct
FROM b GROUP BY ws"""


def user_login_window(len_ms: int = 10000) -> str:
    return f"""
WITH {PAGE_LOG},
l AS (SELECT * FROM page_log WHERE coalesce(uid, '') <> ''
        AND (last_page_id = 'login' OR coalesce(last_page_id, '') = '')),
f AS (SELECT *, row_number() OVER (PARTITION BY uid, d ORDER BY et, seq) AS rn FROM l),
g AS (SELECT *, lag(d) OVER (PARTITION BY uid ORDER BY d) AS prev FROM f WHERE rn = 1),
b AS (SELECT *, {_bucket(_ms_from_et(), len_ms)} AS ws FROM g)
SELECT {_labels('ws', len_ms)},
       CAST(sum(CASE WHEN prev IS NOT NULL AND date_diff('day', prev, d) >= 8 THEN 1 ELSE 0 END) AS BIGINT) AS back_ct,
       CAST(count(*) AS BIGINT) AS uu_ct
FROM b GROUP BY ws"""


CART = """
cart AS (SELECT CAST(event_id AS STRING) AS id, CAST(user_id AS STRING) AS user_id,
                (epoch_us(ts) // 1000) AS ts_ms, event_id AS seq
         FROM events WHERE event_type = 'purchase')"""


def cart_add_uu_window(len_ms: int) -> str:
    return f"""
WITH {CART},
f AS (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(epoch_ms(ts_ms) AS DATE)
                                   ORDER BY ts_ms, seq) AS rn FROM cart),
b AS (SELECT *, {_bucket('ts_ms', len_ms)} AS ws FROM f WHERE rn = 1)
SELECT {_labels('ws', len_ms)}, CAST(count(*) AS BIGINT) AS cart_add_uu_ct FROM b GROUP BY ws"""


def province_order_window(len_ms: int) -> str:
    return f"""
WITH {ORDER_FACT},
r AS (SELECT *, lead(seq) OVER (PARTITION BY id ORDER BY seq) AS nxt FROM order_fact),
s AS (SELECT ts_ms, province_id, order_id, split_total_amount AS amount FROM r
      UNION ALL
      SELECT ts_ms, province_id, order_id, -split_total_amount AS amount FROM r WHERE nxt IS NOT NULL),
b AS (SELECT *, {_bucket('ts_ms', len_ms)} AS ws FROM s),
a AS (SELECT ws, province_id, CAST(count(DISTINCT order_id) AS BIGINT) AS order_count,
             sum(amount) AS order_amount FROM b GROUP BY ws, province_id)
SELECT {_labels('ws', len_ms)}, a.province_id, coalesce(n.n_name, '') AS province_name,
       order_count, CAST(order_amount AS DOUBLE) AS order_amount
FROM a LEFT JOIN nation n ON CAST(n.n_nationkey AS STRING) = a.province_id"""


SKU_LATEST = """
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, seq DESC) AS rn
                          FROM order_fact) WHERE rn = 1),
sku_win AS (SELECT ts_ms // 10000 * 10000 AS ws, sku_id,
                   sum(split_original_amount) AS original_amount,
                   sum(split_activity_amount) AS activity_reduce_amount,
                   sum(split_coupon_amount) AS coupon_reduce_amount,
                   sum(split_total_amount) AS order_amount
            FROM latest GROUP BY 1, 2)"""

SKU_AMOUNTS = """CAST(original_amount AS DOUBLE) AS original_amount,
       CAST(activity_reduce_amount AS DOUBLE) AS activity_reduce_amount,
       CAST(coupon_reduce_amount AS DOUBLE) AS coupon_reduce_amount,
       CAST(order_amount AS DOUBLE) AS order_amount"""


def sku_order_window() -> str:
    return f"""
WITH {ORDER_FACT}, {SKU_LATEST}
SELECT {_labels('ws', 10000)}, sku_id, {SKU_AMOUNTS} FROM sku_win"""


def sku_order_enriched() -> str:
    return f"""
WITH {ORDER_FACT}, {SKU_LATEST},
sku AS (SELECT CAST(p_partkey AS STRING) AS id, p_name AS sku_name, p_name AS spu_id, p_brand AS tm_id,
               CAST(p_partkey % (SELECT count(*) FROM supplier) AS STRING) AS category3_id FROM part),
spu AS (SELECT DISTINCT p_name AS id, p_name AS spu_name FROM part),
tm AS (SELECT DISTINCT p_brand AS id, p_brand AS tm_name FROM part)
SELECT {_labels('ws', 10000)}, w.sku_id, {SKU_AMOUNTS},
       sku.sku_name, sku.spu_id, spu.spu_name, sku.tm_id, tm.tm_name,
       sku.category3_id, c3.s_name AS category3_name,
       CAST(c3.s_nationkey AS STRING) AS category2_id, c2.n_name AS category2_name,
       CAST(c2.n_regionkey AS STRING) AS category1_id, c1.r_name AS category1_name
FROM sku_win w
LEFT JOIN sku ON sku.id = w.sku_id
LEFT JOIN spu ON spu.id = sku.spu_id
LEFT JOIN tm ON tm.id = sku.tm_id
LEFT JOIN supplier c3 ON CAST(c3.s_suppkey AS STRING) = sku.category3_id
LEFT JOIN nation c2 ON CAST(c2.n_nationkey AS STRING) = CAST(c3.s_nationkey AS STRING)
LEFT JOIN region c1 ON CAST(c1.r_regionkey AS STRING) = CAST(c2.n_regionkey AS STRING)"""


def keyword_window() -> str:
    return f"""
WITH {PAGE_LOG},
t AS (SELECT p.et, unnest(regexp_extract_all(lower(d.text), '[a-z0-9]+')) AS keyword
      FROM documents d JOIN page_log p ON p.seq = d.doc_id % (SELECT count(*) FROM events)),
b AS (SELECT *, {_bucket(_ms_from_et(), 10000)} AS ws FROM t)
SELECT {_labels('ws', 10000)}, keyword, CAST(count(*) AS BIGINT) AS keyword_count
FROM b GROUP BY ws, keyword"""


def is_new_repair() -> str:
    return f"""
WITH {PAGE_LOG},
f AS (SELECT *, first_value(CASE WHEN is_new = '1' THEN d ELSE d - INTERVAL 1 DAY END)
                OVER (PARTITION BY mid ORDER BY et, seq) AS fixed FROM page_log)
SELECT seq, mid, is_new,
       CASE WHEN is_new = '1' AND CAST(fixed AS DATE) <> d THEN '0' ELSE is_new END AS is_new_fixed
FROM f"""


def uv_by_channel() -> str:
    return f"""
SELECT cur_date, ch, CAST(sum(uv_ct) AS BIGINT) AS uv_ct
FROM ({traffic_vc_ch_ar_is_new()}) t GROUP BY cur_date, ch"""


def amount_by_province() -> str:
    return f"""
WITH {ORDER_FACT},
r AS (SELECT *, lead(seq) OVER (PARTITION BY id ORDER BY seq) AS nxt FROM order_fact),
s AS (SELECT ts_ms, province_id, split_total_amount AS amount FROM r
      UNION ALL
      SELECT ts_ms, province_id, -split_total_amount FROM r WHERE nxt IS NOT NULL)
SELECT strftime(epoch_ms(ts_ms // 4000 * 4000), '%Y-%m-%d') AS cur_date, s.province_id,
       coalesce(n.n_name, '') AS province_name, CAST(sum(amount) AS DOUBLE) AS order_amount
FROM s LEFT JOIN nation n ON CAST(n.n_nationkey AS STRING) = s.province_id
GROUP BY 1, 2, 3"""


ORACLE: dict[str, str] = {
    "traffic_vc_ch_ar_is_new": traffic_vc_ch_ar_is_new(),
    "traffic_home_detail_uv": traffic_home_detail_uv(),
    "user_login_window": user_login_window(),
    "cart_add_uu_window": cart_add_uu_window(2000),
    "cart_add_uu_window_ms": cart_add_uu_window(2),
    "province_order_window": province_order_window(4000),
    "province_order_window_ms": province_order_window(4),
    "sku_order_window": sku_order_window(),
    "sku_order_enriched": sku_order_enriched(),
    "keyword_window": keyword_window(),
    "is_new_repair": is_new_repair(),
    "uv_by_channel": uv_by_channel(),
    "amount_by_province": amount_by_province(),
}


def _all() -> dict[str, str]:
    from . import oracle_cdc, oracle_more, oracle_stream
    out = dict(ORACLE)
    out.update(oracle_cdc.oracles())
    out.update(oracle_more.oracles())
    out.update(oracle_stream.oracles())
    return out


ORACLE = _all()


# The streams end with a record of the far future, so the watermark closes every
# window of the data: same rows as the batch queries.
ORACLE.update({
    "stream_traffic_vc_ch_ar_is_new": traffic_vc_ch_ar_is_new(),
    "stream_user_login_window": user_login_window(),
    "stream_is_new_repair": is_new_repair(),
    "stream_keyword_window": keyword_window(),
})

ORACLE.update({
    "stream_province_order_window": province_order_window(4000),
    "stream_traffic_home_detail_uv": traffic_home_detail_uv(),
    "stream_cart_add_uu_window": cart_add_uu_window(2000),
    "province_order_from_fact": province_order_window(4000),
    "sku_order_from_fact": sku_order_window(),
})

ORACLE.update({
    "metric_json_read": province_order_window(4000),
    "cdc_gate_json": ORACLE["cdc_gate"],
    "log_parsed": """
SELECT event_id AS seq, 'mid_' || CAST(user_id AS STRING) AS mid, event_type AS page_id, epoch_us(ts) // 1000 AS ts
FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0 AND event_id % 79 <> 0""",
})
