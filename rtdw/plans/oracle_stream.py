"""DuckDB SQL of the jobs that keep tables or join streams. What a job leaves after its
batches is stated on the base tables: the newest value per cell, the configuration in force in
a batch, the periods of the five-second state."""

from __future__ import annotations

from .oracle import ORDER_FACT, PAGE_LOG, sku_order_enriched
from .oracle_cdc import HEADER, TOPIC_DB, fact_order_pay_suc
from .oracle_more import _sig, _values, dim_merge, dirty_records


def dim_job() -> str:
    """Cells of the routed dimension tables: headers that pass the gate (a delete takes its only row
    away), payments, comments, and the merged user changes."""
    return f"""
WITH {HEADER},
users AS ({dim_merge()}),
cells AS (
  SELECT 'dim_order_info' AS sink_table, id AS row_key, unnest([
           {{'column': 'id', 'value': id}}, {{'column': 'user_id', 'value': user_id}},
           {{'column': 'province_id', 'value': province_id}}, {{'column': 'order_status', 'value': order_status}}]) AS c
  FROM header WHERE source_table = 'order_info' AND in_db AND has_after
  UNION ALL
  SELECT 'dim_payment', CAST(o_orderkey AS STRING), unnest([
           {{'column': 'order_id', 'value': CAST(o_orderkey AS STRING)}},
           {{'column': 'payment_status', 'value': CASE WHEN o_orderstatus = 'F' THEN '1602' ELSE '1601' END}}])
  FROM orders
  UNION ALL
  SELECT 'dim_comment_info', CAST(event_id AS STRING), unnest([
           {{'column': 'id', 'value': CAST(event_id AS STRING)}}, {{'column': 'appraise', 'value': event_type}}])
  FROM events
  UNION ALL
  SELECT 'dim_user_info', id, unnest([
           {{'column': 'id', 'value': id}}, {{'column': 'name', 'value': name}}, {{'column': 'nation_id', 'value': nation_id}},
           {{'column': 'balance', 'value': balance}}, {{'column': 'segment', 'value': segment}}])
  FROM users)
SELECT sink_table, row_key, c['column'] AS "column", c['value'] AS value FROM cells
WHERE c['value'] IS NOT NULL AND c['value'] <> ''"""


def _in_force(rows, names: list[str], keys: str) -> str:
    """cur: the configuration per batch b."""
    return f"""
cfg AS {_values(rows, ['arrival', *names])},
cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY b, {keys} ORDER BY arrival >= 0 DESC, seq DESC) AS rn
                       FROM cfg, (SELECT unnest([0, 1, 2]) AS b) WHERE arrival <= b) WHERE rn = 1 AND op <> 'd')"""


def stream_dim_route() -> str:
    from ..sources.bindings import DIM_CONFIG_ARRIVALS
    cfg = _in_force(DIM_CONFIG_ARRIVALS, ["source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key", "op",
                                          "seq"], "source_table")
    return "WITH " + TOPIC_DB + f""",{cfg},
g AS (SELECT *, CAST((ts_ms // 86400000) % 3 AS INTEGER) AS batch FROM topic_db
      WHERE source['db'] = 'gmall' AND op IN ('c', 'u', 'd', 'r') AND after IS NOT NULL AND cardinality(after) > 0)
SELECT g.batch, cur.sink_table, g.op, g.seq,
       CASE WHEN list_contains(string_split(cur.sink_columns, ','), cur.sink_row_key) THEN g.after[cur.sink_row_key] END AS row_key,
       {_sig('g.after', 'cur.sink_columns')} AS data_sig
FROM g JOIN cur ON g.source['table'] = cur.source_table AND g.batch = cur.b"""


def stream_dwd_route() -> str:
    from ..sources.bindings import DWD_CONFIG_ARRIVALS
    cfg = _in_force(DWD_CONFIG_ARRIVALS, ["source_table", "source_type", "sink_table", "sink_columns", "op", "seq"],
                    "source_table, source_type")
    return "WITH " + TOPIC_DB + f""",{cfg},
g AS (SELECT * FROM (SELECT *, CASE op WHEN 'd' THEN before ELSE after END AS image,
             CASE op WHEN 'r' THEN 'bootstrap-insert' WHEN 'c' THEN 'insert' WHEN 'u' THEN 'update' WHEN 'd' THEN 'delete' END AS typ,
             CAST((ts_ms // 86400000) % 3 AS INTEGER) AS batch FROM topic_db) WHERE image IS NOT NULL)
SELECT g.batch, cur.sink_table, g.seq, g.ts_ms AS ts, {_sig('g.image', 'cur.sink_columns')} AS data_sig
FROM g JOIN cur ON g.source['table'] = cur.source_table AND g.typ = cur.source_type AND g.batch = cur.b"""


# per detail id, rows in order of time: a row more than five seconds after the first of its
# period opens the next one; a period emits its newest row at its end
SKU_PERIODS = """
arrived AS (SELECT *, epoch_us(et) // 1000 AS t_ms, row_number() OVER (PARTITION BY id ORDER BY et, ts_ms, seq) AS k FROM order_fact),
walk AS (
  SELECT id, k, t_ms, t_ms AS opened FROM arrived WHERE k = 1
  UNION ALL
  SELECT a.id, a.k, a.t_ms, CASE WHEN a.t_ms > w.opened + 5000 THEN a.t_ms ELSE w.opened END
  FROM walk w JOIN arrived a ON a.id = w.id AND a.k = w.k + 1),
kept AS (SELECT a.*, ((w.opened + 5000) // 10000) * 10000 AS ws
         FROM walk w JOIN arrived a USING (id, k)
         QUALIFY row_number() OVER (PARTITION BY a.id, w.opened ORDER BY a.ts_ms DESC, a.seq DESC) = 1),
sku_win AS (SELECT ws, sku_id, sum(split_original_amount) AS original_amount, sum(split_activity_amount) AS activity_reduce_amount,
                   sum(split_coupon_amount) AS coupon_reduce_amount, sum(split_total_amount) AS order_amount
            FROM kept GROUP BY ws, sku_id)"""


def stream_sku_order_window() -> str:
    """The enriched batch query with the periods in place of each id's newest row."""
    sql = sku_order_enriched()
    start, rest = sql.index("WITH "), sql.index("sku AS (")
    return sql[:start] + f"WITH RECURSIVE {ORDER_FACT},{SKU_PERIODS},\n" + sql[rest:]


def stream_log_split() -> str:
    """Undamaged lines are repaired per device and split; damaged ones come out as they are."""
    return f"""
WITH {PAGE_LOG},
damaged AS ({dirty_records()}),
good AS (SELECT * FROM page_log WHERE seq NOT IN (SELECT seq FROM damaged)),
fixed AS (SELECT *, first_value(CASE WHEN is_new = '1' THEN d ELSE d - INTERVAL 1 DAY END)
                      OVER (PARTITION BY mid ORDER BY ts_ms, seq) AS fx FROM good),
lg AS (SELECT mid, CASE WHEN is_new = '1' AND CAST(fx AS DATE) <> d THEN '0' ELSE is_new END AS is_new, seq, ts_ms,
              event_type = 'signup' AS is_start, event_type = 'error' OR seq % 7 = 0 AS has_err, user_id, last_page_id,
              CASE WHEN event_type <> 'signup' THEN page_id END AS page_id,
              CASE WHEN event_type IN ('view', 'click') THEN seq % 4 END AS n_disp,
              CASE WHEN event_type IN ('click', 'purchase') THEN user_id % 3 END AS n_act FROM fixed)
SELECT 'err' AS topic, mid, is_new, CAST(user_id % 5 AS STRING) AS detail, page_id, ts_ms AS ts,
       CAST(4 + (n_disp IS NOT NULL)::INT + (n_act IS NOT NULL)::INT AS INTEGER) AS n_keys, NULL AS raw
FROM lg WHERE has_err
UNION ALL SELECT 'start', mid, is_new, 'icon', NULL, ts_ms, 3, NULL FROM lg WHERE is_start
UNION ALL SELECT 'page', mid, is_new, last_page_id, page_id, ts_ms,
       CAST(3 + coalesce(n_disp = 0, false)::INT + coalesce(n_act = 0, false)::INT AS INTEGER), NULL FROM lg WHERE NOT is_start
UNION ALL SELECT 'display', mid, is_new, CAST(p AS STRING), page_id, ts_ms, 4, NULL
FROM lg, LATERAL (SELECT unnest(generate_series(1, n_disp)) AS p) WHERE NOT is_start AND n_disp > 0
UNION ALL SELECT 'action', mid, is_new, CASE WHEN p = 1 THEN 'cart_add' ELSE 'favor_add' END, page_id, NULL, 3, NULL
FROM lg, LATERAL (SELECT unnest(generate_series(1, n_act)) AS p) WHERE NOT is_start AND n_act > 0
UNION ALL SELECT 'dirty', NULL, NULL, NULL, NULL, NULL, NULL, value FROM damaged"""


def stream_fact_order_pay_suc() -> str:
    """The batch fact's newest version per detail id, ties by the columns in order."""
    inner = fact_order_pay_suc().replace("pi.ts_ms\nFROM", "pi.ts_ms, od.ts_ms AS version_ms\nFROM")
    order = ["order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id", "coupon_id",
             "payment_type_code", "callback_time", "sku_num", "split_original_amount", "split_activity_amount",
             "split_coupon_amount", "split_payment_amount", "ts_ms"]
    return f"""
SELECT * FROM ({inner})
QUALIFY row_number() OVER (PARTITION BY order_detail_id
                           ORDER BY version_ms DESC, {', '.join(c + ' DESC NULLS LAST' for c in order)}) = 1"""


def oracles() -> dict[str, str]:
    return {"stream_fact_order_pay_suc": stream_fact_order_pay_suc(), "stream_log_split": stream_log_split(), "dim_job": dim_job(), "stream_dim_route": stream_dim_route(), "stream_dwd_route": stream_dwd_route(),
            "stream_sku_order_window": stream_sku_order_window()}
