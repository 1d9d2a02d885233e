"""Readers, the SQL table function and the stream-stream join."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from rtdw.streaming import fact_jobs as FJ
from rtdw.functions import keywords
from rtdw.operators import facts
from rtdw.sources import readers
from rtdw.streaming import jobs as J


def test_udtf_lateral(spark):
    keywords.register_udtf(spark, "ik_analyze")
    spark.createDataFrame([(1, "Red Phone 5G red"), (2, None)], "id int, t string") \
        .createOrReplaceTempView("kw_src")
    rows = spark.sql("SELECT id, word FROM kw_src, LATERAL ik_analyze(t)").collect()
    assert sorted(r.word for r in rows) == ["5g", "phone", "red", "red"]
    native = spark.table("kw_src").select(F.explode(keywords.tokenize("t")).alias("w"))
    assert sorted(r.w for r in native.collect()) == ["5g", "phone", "red", "red"]


def test_snapshot_envelopes_feed_selections(spark):
    df = spark.createDataFrame([("1", "u1", "p1")], "id string, user_id string, province_id string")
    env = readers.snapshot_as_envelopes(df, "order_info", "gmall", ts_ms=5)
    out = facts.select_order_info(env).collect()
    assert [(r.id, r.user_id, r.province_id) for r in out] == [("1", "u1", "p1")]


def test_json_lines_stream_to_envelopes(spark):
    src = tempfile.mkdtemp(prefix="rtdw-json-")
    rec = {"op": "r", "ts_ms": 7, "after": {"id": "9", "order_status": "1001", "price": 10.10},
           "source": {"db": "gmall", "table": "order_info"}}
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write(json.dumps(rec) + "\n")
    stream = readers.read_envelopes(readers.read_json_lines_stream(spark, src))
    out = J.run_available_now(stream.select("op", "ts_ms", F.col("after")["price"].alias("price")),
                              "t-json")
    r = out.first()
    assert (r.op, r.ts_ms, r.price) == ("r", 7, "10.1")   # numbers come through as text


def test_stream_stream_order_detail_join(spark):
    base = tempfile.mkdtemp(prefix="rtdw-join-")
    # the *9 rows arrive much later on every input and move the (minimum)
    # watermark past d1's join range
    extra = "sku_name string, create_time string, sku_num string, split_original_amount string, " \
            "split_activity_amount string, split_coupon_amount string, split_total_amount string, ts_ms bigint"
    more = ("sku", "86400000", "1", "5.00", "0.00", "0.00")
    d = spark.createDataFrame([("d1", "o1", "s1", *more, "5.00", 1000), ("d2", "o2", "s2", *more, "6.00", 2000),
                               ("d9", "o9", "s9", *more, "1.00", 10_000_000)],
                              "id string, order_id string, sku_id string, " + extra)
    h = spark.createDataFrame([("o1", "u1", "p1", 1500), ("o9", "u9", "p9", 10_000_000)],
                              "id string, user_id string, province_id string, ts_ms bigint")
    a = spark.createDataFrame([("d1", "a1", "r1", 1200), ("d9", "a9", "r9", 10_000_000)],
                              "order_detail_id string, activity_id string, activity_rule_id string, ts_ms bigint")
    c = spark.createDataFrame([("dx", "c1", 1200), ("dy", "c9", 10_000_000)], "order_detail_id string, coupon_id string, ts_ms bigint")
    streams = {}
    for name, df in {"d": d, "h": h, "a": a, "c": c}.items():
        p = os.path.join(base, name)
        df.write.parquet(p)
        streams[name] = spark.readStream.schema(df.schema).parquet(p)
    out = J.run_available_now(FJ.order_detail_join(streams["d"], streams["h"], streams["a"], streams["c"]),
                              "t-join")
    rows = [(r.id, r.user_id, r.activity_id, r.coupon_id) for r in out.collect()]
    assert len(out.columns) == 17 and out.first().date_id == "1970-01-02"
    # d1: header and activity matched, no coupon -> emitted once the watermark passed;
    # d2: no header (inner join); d9: still inside its retention range
    assert rows == [("d1", "u1", "a1", None)]


def test_plain_parse_fails_on_malformed_text(spark):
    import pytest
    bad = spark.createDataFrame([('{"op":"r"}',), ("{oops",)], "value string")
    with pytest.raises(Exception):
        readers.read_envelopes(bad).collect()


def test_lost_offsets_fail_by_default():
    from rtdw import sinks
    assert sinks.kafka_source_options("h:1", "t", "g")["failOnDataLoss"] == "true"
    assert sinks.kafka_source_options("h:1", "t", "g", False)["failOnDataLoss"] == "false"


def test_snapshot_and_log_overlap(spark, tmp_path):
    """Changes older than the snapshot are dropped, redelivered ones written once."""
    snapshot = readers.snapshot_as_envelopes(spark.createDataFrame([("1", "new"), ("2", "b")], "id string, v string"), "t", "db", 5)
    env = lambda part, pos, i, v: (part, pos, "u", pos, None, {"id": i, "v": v}, {"db": "db", "table": "t"})
    schema = "part string, position bigint, op string, ts_ms bigint, before map<string,string>, " \
             "after map<string,string>, source map<string,string>"
    batches = [
        [env("a", 9, "1", "old"), env("a", 10, "1", "new"), env("a", 11, "2", "c"), env("b", 3, "3", "x"), env("a", 11, "2", "c")],
        [env("a", 10, "1", "new"), env("a", 11, "2", "c"), env("a", 12, "1", "d"), env("c", 1, "4", "y")],
        [env("b", 3, "3", "x"), env("b", 4, "3", "z")],
    ]
    make = lambda rows: spark.createDataFrame(rows, schema)
    h = readers.Handover(spark, str(tmp_path), snapshot, {"a": 10, "b": 2})
    for n, rows in enumerate(batches):
        for _ in range(2):
            h.write(make(rows), n)
    got = sorted((r["op"], r["after"]["id"], r["after"]["v"]) for r in h.read().collect())
    assert got == [("r", "1", "new"), ("r", "2", "b"), ("u", "1", "d"), ("u", "2", "c"), ("u", "3", "x"), ("u", "3", "z"), ("u", "4", "y")]
    log = make([r for rows in batches for r in rows if r[0] == "a"])
    assert sorted(r["position"] for r in readers.after_snapshot(log, 10, "position").collect()) == [11, 12]
