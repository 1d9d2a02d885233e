"""DuckDB SQL for routing, dimension maintenance, log split, dead letters
and the date helpers. The nested log is described by its per-event rules
(counts of displays/actions, presence of start/err) instead of being rebuilt
as maps, which keeps this SQL independent of the Spark construction."""

from __future__ import annotations

from .oracle import PAGE_LOG
from .oracle_cdc import TOPIC_DB


def _values(rows, cols) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) t({', '.join(cols)}))"


def _sig(map_expr: str, cols_expr: str) -> str:
    return (f"array_to_string(list_sort([e.key || '=' || coalesce(e.value, '') "
            f"for e in map_entries({map_expr}) "
            f"if list_contains(string_split({cols_expr}, ','), e.key)]), ',')")


def dim_route() -> str:
    from ..sources.bindings import DIM_CONFIG_ROWS
    cfg = _values(DIM_CONFIG_ROWS, ["source_table", "sink_table", "sink_columns", "sink_family",
                                    "sink_row_key", "op", "seq"])
    return "WITH " + TOPIC_DB + f""",
cfg AS {cfg},
cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_table ORDER BY seq DESC) AS rn
                       FROM cfg) WHERE rn = 1 AND op <> 'd'),
g AS (SELECT * FROM topic_db WHERE source['db'] = 'gmall' AND op IN ('c', 'u', 'd', 'r')
        AND after IS NOT NULL AND cardinality(after) > 0)
SELECT cur.sink_table, cur.sink_family, g.op, g.ts_ms, g.seq, g.after[cur.sink_row_key] AS row_key,
       {_sig('g.after', 'cur.sink_columns')} AS data_sig
FROM g JOIN cur ON g.source['table'] = cur.source_table"""


def dwd_route() -> str:
    from ..sources.bindings import DWD_CONFIG_ROWS
    cfg = _values(DWD_CONFIG_ROWS, ["source_table", "source_type", "sink_table", "sink_columns",
                                    "op", "seq"])
    return "WITH " + TOPIC_DB + f""",
cfg AS {cfg},
cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_table, source_type
                                                    ORDER BY seq DESC) AS rn FROM cfg)
        WHERE rn = 1 AND op <> 'd'),
g AS (SELECT *, CASE op WHEN 'r' THEN 'bootstrap-insert' WHEN 'c' THEN 'insert'
                        WHEN 'u' THEN 'update' WHEN 'd' THEN 'delete' END AS typ
      FROM topic_db WHERE after IS NOT NULL)
SELECT cur.sink_table, g.seq, g.ts_ms AS ts, {_sig('g.after', 'cur.sink_columns')} AS data_sig
FROM g JOIN cur ON g.source['table'] = cur.source_table AND g.typ = cur.source_type"""


def dim_merge() -> str:
    return """
WITH c AS (SELECT c_custkey AS k, CAST(c_custkey AS STRING) AS id, c_name, c_nationkey,
                  CAST(c_acctbal AS DECIMAL(16,2)) AS bal, c_mktsegment FROM customer),
ch AS (
  SELECT id, k * 10 + 1 AS seq, 'r' AS op, c_name AS name, CAST(c_nationkey AS STRING) AS nation_id,
         CAST(bal AS STRING) AS balance, c_mktsegment AS segment FROM c
  UNION ALL
  SELECT id, k * 10 + 2, 'u', '', NULL, CAST(bal + 1 AS STRING), NULL FROM c
  UNION ALL
  SELECT id, k * 10 + 3, 'd', NULL, NULL, NULL, NULL FROM c WHERE k % 10 = 0
  UNION ALL
  SELECT id, k * 10 + 4, 'c', c_name || '*', NULL, NULL, 'REBORN' FROM c WHERE k % 20 = 0),
ld AS (SELECT id, max(seq) FILTER (WHERE op = 'd') AS del FROM ch GROUP BY id),
v AS (SELECT ch.* FROM ch JOIN ld USING (id) WHERE ch.op <> 'd' AND (ld.del IS NULL OR ch.seq > ld.del))
SELECT id,
       arg_max(name, seq) FILTER (WHERE name IS NOT NULL AND name <> '') AS name,
       arg_max(nation_id, seq) FILTER (WHERE nation_id IS NOT NULL AND nation_id <> '') AS nation_id,
       arg_max(balance, seq) FILTER (WHERE balance IS NOT NULL AND balance <> '') AS balance,
       arg_max(segment, seq) FILTER (WHERE segment IS NOT NULL AND segment <> '') AS segment
FROM v GROUP BY id"""


def dim_lookup_miss() -> str:
    return """
SELECT CAST(e.event_id AS STRING) AS id, k.province_id, n.n_name AS province_name
FROM events e
CROSS JOIN LATERAL (SELECT CASE WHEN e.event_type <> 'error'
                                THEN CAST(e.user_id % 30 AS STRING) END AS province_id) k
LEFT JOIN nation n ON CAST(n.n_nationkey AS STRING) = k.province_id"""


LOG = PAGE_LOG + """,
fixed AS (SELECT *, CASE WHEN is_new = '1' AND CAST(fx AS DATE) <> d THEN '0' ELSE is_new END AS is_new_fixed
          FROM (SELECT *, first_value(CASE WHEN is_new = '1' THEN d ELSE d - INTERVAL 1 DAY END)
                          OVER (PARTITION BY mid ORDER BY et, seq) AS fx FROM page_log)),
lg AS (SELECT *, event_type = 'signup' AS is_start,
              (event_type = 'error' OR seq % 7 = 0) AS has_err,
              CASE WHEN event_type IN ('view', 'click') THEN seq % 4 END AS n_disp,
              CASE WHEN event_type IN ('click', 'purchase') THEN user_id % 3 END AS n_act
       FROM fixed)"""


def log_err() -> str:
    return f"""
WITH {LOG}
SELECT seq, mid, is_new_fixed AS is_new, CASE WHEN NOT is_start THEN page_id END AS page_id,
       CASE WHEN is_start THEN 'icon' END AS start_entry, CAST(user_id % 5 AS STRING) AS error_code,
       CAST(n_disp AS INTEGER) AS n_displays, CAST(n_act AS INTEGER) AS n_actions, ts_ms AS ts
FROM lg WHERE has_err"""


def log_start() -> str:
    return f"""
WITH {LOG}
SELECT seq, mid, is_new_fixed AS is_new, 'icon' AS entry,
       CAST(CAST(floor(value) AS BIGINT) AS STRING) AS loading_time, false AS has_err, ts_ms AS ts
FROM lg WHERE is_start"""


def log_page() -> str:
    return f"""
WITH {LOG}
SELECT seq, mid, is_new_fixed AS is_new, page_id, last_page_id, CAST(during_time AS STRING) AS during_time,
       CASE WHEN n_disp = 0 THEN 0 END AS displays_left, CASE WHEN n_act = 0 THEN 0 END AS actions_left,
       false AS has_err, ts_ms AS ts
FROM lg WHERE NOT is_start"""


def log_display() -> str:
    return f"""
WITH {LOG}
SELECT seq, mid, page_id, uid AS item, 'sku_id' AS item_type, CAST(p AS STRING) AS pos_id, ts_ms AS ts
FROM lg, LATERAL (SELECT unnest(generate_series(1, n_disp)) AS p)
WHERE NOT is_start AND n_disp > 0"""


def log_action() -> str:
    return f"""
WITH {LOG}
SELECT seq, mid, page_id, CASE WHEN p = 1 THEN 'cart_add' ELSE 'favor_add' END AS action_id,
       CAST(seq AS STRING) AS item
FROM lg, LATERAL (SELECT unnest(generate_series(1, n_act)) AS p)
WHERE NOT is_start AND n_act > 0"""


def dirty_records() -> str:
    return """
WITH raw AS (
  SELECT event_id AS seq,
         CASE WHEN event_id % 97 = 0 THEN substring('{"common":{"mid":"mid_' || CAST(user_id AS STRING), 1, 20)
              WHEN event_id % 89 = 0 THEN ''
              WHEN event_id % 83 = 0 THEN '[' || CAST(event_id AS STRING) || ']'
              WHEN event_id % 79 = 0 THEN 'null'
              ELSE '{"common":{"mid":"mid_' || CAST(user_id AS STRING) || '","uid":"' || CAST(user_id AS STRING)
                   || '"},"page":{"page_id":"' || event_type || '"},"ts":' || CAST(epoch_us(ts) // 1000 AS STRING) || '}'
         END AS value
  FROM events)
SELECT seq, value FROM raw
WHERE NOT coalesce(CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' END, false)"""


def date_functions() -> str:
    return """
SELECT o_orderkey, epoch_us(o_orderdate) // 1000 AS ms,
       strftime(o_orderdate, '%Y-%m-%d') AS d_str, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS dt_str,
       strftime(o_orderdate, '%Y%m%d') AS ymd,
       epoch_us(strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S')) // 1000 AS ms_from_dt,
       epoch_us(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d')) // 1000 AS ms_from_d,
       strftime(o_orderdate, '%Y-%m-%d') AS fn5_date,
       CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 DAY AS DATE)::VARCHAR AS prev_day
FROM orders"""


def oracles() -> dict[str, str]:
    return {
        "dim_route": dim_route(),
        "dwd_route": dwd_route(),
        "dim_merge": dim_merge(),
        "dim_lookup_miss": dim_lookup_miss(),
        "log_err": log_err(),
        "log_start": log_start(),
        "log_page": log_page(),
        "log_display": log_display(),
        "log_action": log_action(),
        "dirty_records": dirty_records(),
        "date_functions": date_functions(),
    }
