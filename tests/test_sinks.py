"""Keyed tables and replayed batches."""

from rtdw import sinks
from rtdw.sinks.keyed import KeyedTable
from rtdw.streaming.province_job import ProvinceOrders


def test_a_stale_change_does_not_replace_a_newer_row(spark):
    now = spark.createDataFrame([("a", 5, "new"), ("b", 1, "old")], "id string, seq int, v string")
    late = spark.createDataFrame([("a", 3, "stale"), ("b", 2, "newer"), ("c", 1, "first")], now.schema)
    got = {r.id: r.v for r in sinks.merge_upsert(now, late, ["id"], "seq").collect()}
    assert got == {"a": "new", "b": "newer", "c": "first"}


def test_deletes_leave_the_table(spark):
    now = spark.createDataFrame([("a", 5, "x"), ("b", 1, "y")], "id string, seq int, v string")
    changes = spark.createDataFrame([("a", 6, None, "d"), ("b", 0, None, "d"), ("c", 1, "z", "u")],
                                    "id string, seq int, v string, op string")
    got = {r.id: r.v for r in sinks.merge_upsert(now, changes, ["id"], "seq", "op").collect()}
    assert got == {"b": "y", "c": "z"}


def test_replayed_batches_leave_one_result(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", ["id"], "id string, seq int", buckets=4)
    write = sinks.keyed_upsert(table, "seq")
    one = spark.createDataFrame([("a", 1), ("b", 1)], "id string, seq int")
    two = spark.createDataFrame([("a", 2), ("c", 1)], "id string, seq int")
    for batch, n in ((one, 0), (two, 1), (two, 1)):
        write(batch, n)
    got = sorted(map(tuple, table.read().collect()))
    assert got == [("a", 2), ("b", 1), ("c", 1)]
    bad = spark.createDataFrame([("{x",)], "value string")
    for _ in range(2):
        sinks.write_dead_letters(bad, f"{tmp_path}/dirty", 7)
    assert spark.read.json(f"{tmp_path}/dirty").count() == 1
    split = spark.createDataFrame([("err", "1"), ("page", "2"), ("page", "3")], "topic string, value string")
    for _ in range(2):
        sinks.write_split(split, f"{tmp_path}/split", 3)
    assert spark.read.json(f"{tmp_path}/split").groupBy("topic").count().orderBy("topic").collect()[1][1] == 2


def test_retract_replace_over_batches(spark, tmp_path):
    """A replaced row, a late row, a NULL amount and a replayed batch."""
    cols = "id string, seq int, order_id string, province_id string, split_total_amount string, et string"
    make = lambda rows: spark.createDataFrame(rows, cols).selectExpr(
        "id", "seq", "order_id", "province_id", "split_total_amount", "timestamp(et) AS et")
    batches = [
        [("d1", 1, "o1", "p1", "10.10", "2024-01-01 00:00:01"), ("d2", 1, "o2", "p1", None, "2024-01-01 00:00:02")],
        [("d3", 1, "o3", "p1", "0.20", "2024-01-01 00:00:09")],
        # replaces d1 in another window, replaces the NULL, and one row far behind
        [("d1", 2, "o1", "p1", "7.00", "2024-01-01 00:00:10"), ("d2", 2, "o2", "p1", "1.00", "2024-01-01 00:00:03"),
         ("d4", 1, "o4", "p1", "5.00", "2024-01-01 00:00:00")],
    ]
    provinces = spark.createDataFrame([("p1", "north")], "id string, name string")
    job = ProvinceOrders(spark, str(tmp_path), lambda: provinces, buckets=4)
    for n, rows in enumerate(batches):
        job.write(make(rows), n)
    job.write(make(batches[2]), 2)
    got = {(r["window"].start.second, r["order_id"]): float(r["amount"]) for r in job.net.read().collect()}
    assert got == {(0, "o1"): 0.0, (0, "o2"): 1.0, (0, "o4"): 5.0, (8, "o3"): 0.2, (8, "o1"): 7.0}


def test_string_amounts_add_up_exactly(spark):
    from rtdw.operators import metrics
    rows = spark.createDataFrame(
        [("a", 1, "o1", "p1", "0.10", "s"), ("b", 1, "o2", "p1", "0.20", "s")],
        "id string, seq int, order_id string, province_id string, split_total_amount string, sku_id string").selectExpr(
        "*", "timestamp'2024-01-01' AS et", "1L AS ts_ms", "'0.10' AS split_original_amount",
        "'0' AS split_activity_amount", "'0' AS split_coupon_amount")
    assert str(metrics.province_order_window(rows).first().order_amount) == "0.30"
    assert str(metrics.sku_order_window(rows).first().original_amount) == "0.20"


def test_a_uri_checkpoint_folder_is_never_used_as_a_local_path(spark, tmp_path, monkeypatch):
    import os

    from rtdw import session
    monkeypatch.setattr(session, "ensure_checkpoint_dir", lambda spark: "hdfs://nn/shared/")
    spark.conf.unset("rtdw.package.shipped")
    monkeypatch.chdir(tmp_path)
    session.ship_package(spark)
    assert not os.listdir(tmp_path)
    assert session.state_dir(spark, "x") == "hdfs://nn/shared/streams/x"
