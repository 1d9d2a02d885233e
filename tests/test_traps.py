"""Unit tests on tiny inline inputs: one per semantic trap / stateful rule."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from rtdw import sinks
from rtdw.operators import dedupe, dims, facts, logs, metrics, routing
from rtdw.sources import envelope


def _cdc(spark, rows):
    return spark.createDataFrame(
        rows, "op string, ts_ms bigint, before map<string,string>, after map<string,string>, "
              "source map<string,string>")


def _src(table, db="gmall"):
    return {"db": db, "table": table}


def test_cancel_precedence_x1(spark):
    cdc = _cdc(spark, [
        ("r", 1, None, {"id": "1", "order_status": "1001", "operate_time": "10"}, _src("order_info")),
        ("u", 2, None, {"id": "2", "order_status": "1003", "operate_time": "20"}, _src("order_info")),
        ("r", 3, None, {"id": "3", "order_status": "1003"}, _src("payment_info")),
        ("u", 4, None, {"id": "4", "order_status": "1001"}, _src("order_info")),
    ])
    literal = {r.id for r in facts.select_order_cancel(cdc).collect()}
    strict = {r.id for r in facts.select_order_cancel(cdc, strict=True).collect()}
    assert literal == {"1", "2", "3"}
    assert strict == {"1"}


def test_cart_reduced_predicate_x2(spark):
    cdc = _cdc(spark, [
        ("r", 1, None, {"id": "1", "sku_num": "3"}, _src("cart_info")),
        ("u", 2, None, {"id": "1", "sku_num": "5"}, _src("cart_info")),
        ("c", 3, None, {"id": "2", "sku_num": "1"}, _src("cart_info")),
    ])
    out = facts.select_cart_add(cdc).collect()
    assert [(r.id, r.sku_num) for r in out] == [("1", "3")]


def test_original_amount_string(spark):
    df = spark.createDataFrame([("1", "11999.00")], "n string, p string")
    assert df.select(facts.original_amount(F.col("n"), F.col("p"))).first()[0] == "11999.0000"


def test_cdc_gate_and_image(spark):
    cdc = _cdc(spark, [
        ("r", 1, None, {"id": "1"}, _src("t")),
        ("d", 2, {"id": "2"}, None, _src("t")),
        ("c", 3, None, {}, _src("t")),
        ("c", 4, None, {"id": "4"}, _src("t", db="other")),
        ("x", 5, None, {"id": "5"}, _src("t")),
    ])
    assert [r.ts_ms for r in envelope.cdc_gate(cdc, "gmall").collect()] == [1]
    img = {r.ts_ms: r.image for r in envelope.config_image(cdc).collect()}
    assert img[2] == {"id": "2"} and img[1] == {"id": "1"}


def test_normalise_second_envelope_x8(spark):
    alt = spark.createDataFrame(
        [("t", "insert", 1, {"id": "1"}, None), ("t", "delete", 2, {"id": "2"}, None)],
        envelope.CDC_ALT_SCHEMA)
    rows = {r.ts_ms: r for r in envelope.normalise(alt).collect()}
    assert rows[1].op == "c" and rows[1].after == {"id": "1"}
    assert rows[2].op == "d" and rows[2].after is None and rows[2].before == {"id": "2"}


def test_tolerant_parse_dead_letters(spark):
    raw = spark.createDataFrame([('{"common":{"mid":"a"},"ts":1}',), ("{broken",), ("",),
                                 ("[1]",), ("null",)], "value string")
    good, dirty = logs.clean(raw)
    assert good.count() == 1 and dirty.count() == 4


def test_lookup_null_key_and_miss_x13(spark):
    facts_df = spark.createDataFrame([("a", "1"), ("b", None), ("c", "9")], "id string, k string")
    dim = spark.createDataFrame([("1", "one")], "id string, name string")
    out = {r.id: r.name for r in dims.lookup_dim(facts_df, dim, "k", {"name": "name"}).collect()}
    assert out == {"a": "one", "b": None, "c": None}
    out = {r.id: r.name for r in dims.lookup_dim(facts_df, dim, "k", {"name": "name"}, default="").collect()}
    assert out["b"] == "" and out["c"] == ""


def test_dim_merge_st9(spark):
    ch = spark.createDataFrame([
        ("r", 1, None, {"id": "1", "name": "a", "city": "x"}),
        ("u", 2, None, {"id": "1", "name": "", "city": "y"}),   # empty keeps old name
        ("r", 3, None, {"id": "2", "name": "b", "city": "z"}),
        ("d", 4, {"id": "2"}, None),                            # delete by before image
        ("r", 5, None, {"id": "3", "name": "c", "city": "q"}),
        ("d", 6, {"id": "3"}, None),
        ("c", 7, None, {"id": "3", "name": "", "city": "w"}),   # re-insert after delete
    ], "op string, seq bigint, before map<string,string>, after map<string,string>")
    out = {r.id: (r.name, r.city) for r in dims.dim_merge(ch, "id", ["name", "city"]).collect()}
    assert out == {"1": ("a", "y"), "3": (None, "w")}
    again = dims.dim_merge(ch.unionByName(ch), "id", ["name", "city"]).collect()
    assert {r.id: (r.name, r.city) for r in again} == out     # idempotent on replay


def test_config_compaction_st8(spark):
    cfg = spark.createDataFrame([
        ("a", "dim_a", "id,x", "f", "id", "r", 1),
        ("a", "dim_a", "id,x,y", "f", "id", "u", 2),
        ("b", "dim_b", "id", "f", "id", "r", 3),
        ("b", "dim_b", "id", "f", "id", "d", 4),
    ], routing.DIM_CFG_SCHEMA)
    cur = {r.source_table: r.sink_columns for r in routing.compact_config(cfg, ["source_table"]).collect()}
    assert cur == {"a": "id,x,y"}
    m = spark.createDataFrame([({"id": "1", "x": "2", "z": "3"},)], "m map<string,string>")
    pruned = m.select(routing.prune_columns(F.col("m"), F.lit("id,x,no_such"))).first()[0]
    assert pruned == {"id": "1", "x": "2"}


def _pl(spark, rows):
    return spark.createDataFrame(rows, "mid string, is_new string, et timestamp, seq bigint") \
        .withColumn("d", F.to_date("et"))


def test_is_new_repair_st1(spark):
    t = dt.datetime
    rows = [("m1", "1", t(2024, 1, 1, 10), 1), ("m1", "1", t(2024, 1, 1, 11), 2),
            ("m1", "1", t(2024, 1, 2, 0, 5), 3),                 # next day: repaired to 0
            ("m2", "0", t(2024, 1, 1, 10), 4), ("m2", "1", t(2024, 1, 1, 12), 5),
            ("m3", None, t(2024, 1, 3), 6), ("m3", "1", t(2024, 1, 3, 1), 7)]
    out = {r.seq: r.is_new_fixed for r in dedupe.repair_is_new(_pl(spark, rows)).collect()}
    assert out == {1: "1", 2: "1", 3: "0", 4: "0", 5: "0", 6: None, 7: "0"}


def test_login_gaps_st4(spark):
    t = dt.datetime
    rows = [("u", t(2024, 1, 1, 9), 1), ("u", t(2024, 1, 1, 10), 2), ("u", t(2024, 1, 8), 3),
            ("u", t(2024, 1, 16), 4), ("u", t(2024, 1, 25), 5)]
    df = spark.createDataFrame(rows, "uid string, et timestamp, seq bigint").withColumn("d", F.to_date("et"))
    out = {r.seq: (r.uu_ct, r.back_ct) for r in dedupe.login_days(df).collect()}
    # gaps: 7 days (not back), 8 days (back), 9 days (back); second login of day 1 dropped
    assert out == {1: (1, 0), 3: (1, 0), 4: (1, 1), 5: (1, 1)}


def test_daily_first_ties_and_midnight(spark):
    t = dt.datetime
    rows = [("m", "0", t(2024, 1, 1, 23, 59, 59), 2), ("m", "0", t(2024, 1, 1, 23, 59, 59), 1),
            ("m", "0", t(2024, 1, 2, 0, 0, 0), 3)]
    firsts = dedupe.daily_first(_pl(spark, rows), "mid").collect()
    assert sorted(r.seq for r in firsts) == [1, 3]


def test_retract_replace_nets_to_latest(spark):
    t = dt.datetime
    rows = [("d1", 1, "o1", "p1", Decimal("10.00"), t(2024, 1, 1, 0, 0, 1)),
            ("d1", 2, "o1", "p2", Decimal("12.00"), t(2024, 1, 1, 0, 0, 9)),
            ("d1", 3, "o1", "p2", None, t(2024, 1, 1, 0, 0, 9)),
            ("d2", 1, "o2", "p1", Decimal("5.00"), t(2024, 1, 1, 0, 0, 2))]
    df = spark.createDataFrame(rows, "id string, seq bigint, order_id string, province_id string, "
                                     "split_total_amount decimal(16,2), et timestamp")
    out = {(r.stt, r.province_id): (r.order_count, r.order_amount)
           for r in metrics.province_order_window(df, None, "4 seconds").collect()}
    lit = dedupe.retract_replace(df.withColumnRenamed("split_total_amount", "amount"), "id", "amount")
    assert lit.count() == 6
    assert out[("2024-01-01 00:00:00", "p1")] == (2, Decimal("5.00"))
    assert out[("2024-01-01 00:00:08", "p2")] == (1, Decimal("0.00"))


def test_log_split_arrays_x14(spark):
    rows = [
        ({"mid": "a", "is_new": "1"}, None, {"entry": "icon"}, {"code": "1"}, [], None, 1000, 1),
        ({"mid": "a", "is_new": "1"}, {"page_id": "home"}, None, {"code": "2"},
         [{"item": "1"}, {"item": "2"}], [{"action_id": "x"}], 2000, 2),
        ({"mid": "b", "is_new": "0"}, {"page_id": "home"}, None, None, [], [], 3000, 3),
    ]
    log = spark.createDataFrame(rows, "common map<string,string>, page map<string,string>, "
                                      "start map<string,string>, err map<string,string>, "
                                      "displays array<map<string,string>>, "
                                      "actions array<map<string,string>>, ts bigint, seq bigint")
    parts = logs.split(logs.repair_log(log))
    assert parts["err"].count() == 2
    err2 = parts["err"].where("seq = 2").first()
    assert len(err2.displays) == 2                      # error record keeps arrays
    assert parts["start"].count() == 1
    page = {r.seq: r for r in parts["page"].collect()}
    assert page[2].displays is None and page[2].err is None
    assert page[3].displays == [] and page[3].actions == []   # empty arrays stay
    assert parts["display"].count() == 2 and "ts" in parts["display"].columns
    assert parts["action"].count() == 1 and "ts" not in parts["action"].columns


def test_metric_json_drops_nulls(spark):
    df = spark.createDataFrame([("a", None, 1)], "provinceId string, provinceName string, orderCount long")
    assert sinks.metric_json(df).first().value == '{"province_id":"a","order_count":1}'


def test_upsert_latest_by_arrival(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("j", 1, "c")], "id string, seq int, v string")
    out = {r.id: r.v for r in facts.upsert_latest(df, "id", "seq").collect()}
    assert out == {"k": "b", "j": "c"}
