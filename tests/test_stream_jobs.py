"""Stream jobs over several batches: redelivery, renamed dimensions, late rows, timers."""

import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rtdw.sources import bindings as B
from rtdw.streaming import jobs as J
from rtdw.streaming import sku_job
from rtdw.streaming.province_job import ProvinceOrders
from rtdw.streaming.replay import Replay, in_time_order

SF = "/root/testdata/sf0.001"
ORDER = "id string, seq int, order_id string, province_id string, split_total_amount string, et string"


def orders(spark, rows):
    return spark.createDataFrame(rows, ORDER).withColumn("et", F.col("et").cast("timestamp"))


def amounts(job):
    return {(r["stt"][-2:], r["province_id"]): (r["order_count"], float(r["order_amount"])) for r in job.read().collect()}


def provinces(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, name string")


def test_a_redelivered_row_adds_nothing(spark, tmp_path):
    job = ProvinceOrders(spark, str(tmp_path), lambda: provinces(spark, ("p", "north")), buckets=4)
    row = ("d", 1, "o", "p", "10.00", "2024-01-01 00:00:01")
    job.write(orders(spark, [row, row]), 0)
    assert amounts(job) == {("00", "p"): (1, 10.0)}
    job.write(orders(spark, [row]), 1)
    assert amounts(job) == {("00", "p"): (1, 10.0)}
    # a newer version in another window, together with the old one again
    job.write(orders(spark, [row, ("d", 2, "o", "p", "4.00", "2024-01-01 00:00:05")]), 2)
    assert amounts(job) == {("00", "p"): (1, 0.0), ("04", "p"): (1, 4.0)}
    job.write(orders(spark, [row]), 3)
    assert amounts(job) == {("00", "p"): (1, 0.0), ("04", "p"): (1, 4.0)}


def test_a_stored_row_is_forgotten_after_its_time(spark, tmp_path):
    job = ProvinceOrders(spark, str(tmp_path), lambda: provinces(spark), ttl="1 second", buckets=2)
    job.write(orders(spark, [("d", 1, "o", "p", "10.00", "2024-01-01 00:00:01")]), 0)
    time.sleep(1.5)
    job.write(orders(spark, [("d", 2, "o", "p", "4.00", "2024-01-01 00:00:01")]), 1)
    assert amounts(job) == {("00", "p"): (1, 14.0)}       # as the reference: nothing left to take back


def test_a_renamed_province_shows_from_its_batch_on(spark, tmp_path):
    """ST11: the dimension is read in every batch; windows emitted before keep the old name."""
    from rtdw.sinks.dim_store import DimStore
    store = DimStore(spark, f"{tmp_path}/dim", 2)
    routed = lambda seq, name: spark.createDataFrame(
        [("dim_base_province", "p", "u", seq, {"name": name})], "sink_table string, row_key string, op string, seq int, data map<string,string>")
    store.put(routed(1, "old"), 0)
    job = ProvinceOrders(spark, f"{tmp_path}/job", lambda: store.read("dim_base_province", ["name"]), buckets=4)
    job.write(orders(spark, [("a", 1, "o1", "p", "1", "2024-01-01 00:00:01"), ("b", 1, "o2", "p", "2", "2024-01-01 00:00:05")]), 0)
    store.put(routed(2, "new"), 1)
    job.write(orders(spark, [("c", 1, "o3", "p", "3", "2024-01-01 00:00:06"), ("e", 1, "o4", "q", "3", "2024-01-01 00:00:09")]), 1)
    got = {(r["stt"][-2:], r["province_id"]): r["province_name"] for r in job.read().collect()}
    assert got == {("00", "p"): "old", ("04", "p"): "new", ("08", "q"): ""}


@pytest.mark.parametrize("job", ["traffic", "home", "cart"])
def test_both_ways_of_daily_firsts_agree(spark, job):
    """Windowed minima (JVM) against keyed state, over several micro-batches."""
    got = {}
    for emit in ("day", "now"):
        ev = J.events_replayed(spark, SF)
        if job == "traffic":
            df = J.traffic_vc_ch_ar_is_new(ev.stream, emit=emit)
        elif job == "home":
            df = J.traffic_home_detail_uv(B.page_log_from(ev.stream).withColumn("page_id", F.when(
                F.col("uid") == str(J.CLOSING_USER), "home").otherwise(F.col("page_id"))), emit=emit)
        else:
            users = B.page_log_from(ev.stream).select(F.col("uid").alias("user_id"), "seq", "ts_ms")
            df = J.cart_add_uu_window(users, emit=emit)
        out = J.run_replayed(df, ev, f"t-{job}-{emit}")
        got[emit] = sorted(map(tuple, out.collect()))
        if emit == "day":
            plan = df._jdf.queryExecution().toString()
            assert "InPandas" not in plan and "Python" not in plan
    # without a delay, windows of "now" count a late first visit only if it is in time
    assert got["day"] == got["now"]


def test_late_rows_are_dropped_and_counted(spark):
    """WM3: a row of the third batch behind the watermark is absent and counted."""
    make = lambda *rows: spark.createDataFrame(
        [(t, k) for t, k in rows], "et string, item string").select(
        F.col("et").cast("timestamp").alias("et"), F.lit("search").alias("last_page_id"),
        F.lit("keyword").alias("item_type"), "item")
    replay = Replay([make(("2024-01-01 00:00:01", "red")), make(("2024-01-01 00:01:00", "blue")),
                     make(("2024-01-01 00:00:02", "late"), ("2024-01-01 00:01:01", "red blue")),
                     make(("2200-01-01 00:00:00", "end"))], "late")
    out, late = J.run_counted(J.keyword_window(replay.stream), replay, "late")
    assert sorted((r["stt"][-8:], r["keyword"], r["keyword_count"]) for r in out.collect()) == [
        ("00:00:00", "red", 1), ("00:01:00", "blue", 2), ("00:01:00", "red", 1)]
    assert late == 1


def test_rows_without_a_time_are_replayed(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, None), (3, "2024-01-02 00:00:00")], "k int, et string")
    replay = in_time_order(df.withColumn("et", F.col("et").cast("timestamp")), "nulls", "et")
    assert sorted(r["k"] for p in replay.parts for r in p.collect()) == [1, 2, 3]
    assert [r["k"] for r in replay.parts[0].collect()].count(2) == 1


SKU = "id string, seq int, ts_ms bigint, sku_id string, split_original_amount string, split_activity_amount string, " \
      "split_coupon_amount string, split_total_amount string, et string"


def sku_rows(spark, *rows):
    return spark.createDataFrame([(i, q, ts, "s", str(a), "0", "0", str(a), et) for i, q, ts, a, et in rows], SKU).withColumn(
        "et", F.col("et").cast("timestamp"))


def dimensions(spark):
    t = lambda cols, *rows: spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in cols.split()))
    return {"sku": t("id sku_name spu_id category3_id tm_id", ("s", "shoe", "u", "c3", "t")), "spu": t("id spu_name", ("u", "unit")),
            "trademark": t("id tm_name", ("t", "mark")), "category3": t("id name category2_id", ("c3", "n3", "c2")),
            "category2": t("id name category1_id", ("c2", "n2", "c1")), "category1": t("id name", ("c1", "n1"))}


def test_sku_periods_of_event_time(spark):
    """Within five seconds of the first row the newest counts; a later row opens a period of its own."""
    d = "2024-01-01 00:00:"
    replay = Replay([sku_rows(spark, ("a", 1, 10, 1, d + "01"), ("a", 2, 30, 2, d + "03"), ("b", 1, 10, 5, d + "02")),
                     sku_rows(spark, ("a", 3, 20, 3, d + "05"), ("a", 4, 40, 7, d + "08"), ("c", 1, 1, 9, d + "19")),
                     sku_rows(spark, ("z", 1, 1, 0, "2200-01-01 00:00:00"))], "sku-periods")
    got = {r["stt"][-8:]: (float(r["order_amount"]), r["sku_name"], r["category1_name"]) for r in sku_job.sku_order_window(
        replay, lambda: dimensions(spark), event_time=True).collect()}
    # a: 2 (newest by ts_ms) at :06; b: 5 at :07; a again: 7 at :13; c: 9 at :24
    assert got == {"00:00:00": (7.0, "shoe", "n1"), "00:00:10": (7.0, "shoe", "n1"), "00:00:20": (9.0, "shoe", "n1")}


def test_sku_periods_in_one_session(spark):
    """Rows that follow each other within the delay, over two batches: at the deadline a row still counts, of equal
    versions the later one; no Python operator is asked for each id."""
    d = "2024-01-01 00:00:"
    replay = Replay([sku_rows(spark, ("a", 1, 10, 1, d + "00"), ("a", 1, 10, 2, d + "05"), ("a", 9, 1, 3, d + "05.001")),
                     sku_rows(spark, ("a", 2, 5, 4, d + "09"), ("a", 1, 5, 6, d + "10.001"), ("a", 1, 1, 8, d + "10.002"),
                              ("b", 1, 1, 9, None)),
                     sku_rows(spark, ("z", 1, 1, 0, "2200-01-01 00:00:00"))], "sku-session")
    latest = sku_job.sku_latest(replay.stream, event_time=True)
    assert "Python" not in latest._jdf.queryExecution().analyzed().toString() and "Transform" not in latest._jdf.queryExecution().analyzed().toString()
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", sku_job.ROCKSDB)
    seen = []
    replay.run(latest.writeStream.foreachBatch(lambda df, n: seen.extend(
        (r["id"], r["split_total_amount"], r["emitted_ms"] % 60_000) for r in df.collect()))
        .option("checkpointLocation", f"{replay.path}/checkpoint"))
    assert sorted(seen) == [("a", "2", 5000), ("a", "4", 10001), ("a", "8", 15002)]


def test_sku_timers_of_processing_time(spark, tmp_path):
    """The timer emits the newest row some time after the first, without further input."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", sku_job.ROCKSDB)
    replay = Replay([sku_rows(spark, ("a", 1, 10, 1, "2024-01-01 00:00:00"))], "sku-timer")
    seen = []
    q = (sku_job.sku_latest(replay.stream, delay_ms=3000).writeStream
         .foreachBatch(lambda df, n: seen.extend((r["id"], r["seq"], r["emitted_ms"]) for r in df.collect()))
         .option("checkpointLocation", str(tmp_path)).start())
    started = time.time()
    try:
        replay._feed(0, replay.parts[0])
        time.sleep(0.5)
        replay._feed(1, sku_rows(spark, ("a", 2, 10, 2, "2024-01-01 00:00:00")))
        replay._feed(2, sku_rows(spark, ("a", 0, 5, 3, "2024-01-01 00:00:00")))
        while not seen and time.time() - started < 60:
            time.sleep(0.5)
    finally:
        q.stop()
    assert [s[:2] for s in seen] == [("a", 2)] and seen[0][2] >= started * 1000 + 2500


def test_logins_are_not_framed_user_by_user(spark):
    """Rows, not pandas frames; the back flag over batches, rows of one day and a row without a time."""
    rows = lambda *r: spark.createDataFrame(
        [(k, u, "signup", 0.0, t) for k, (u, t) in enumerate(r, 1)], "event_id long, user_id long, event_type string, value double, ts string"
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    replay = Replay([rows((1, "2024-01-01 00:00:01"), (1, "2024-01-01 00:00:31"), (2, "2024-01-01 00:00:02"), (4, None)),
                     rows((1, "2024-01-09 00:00:01"), (2, "2024-01-08 00:00:02"), (3, "2024-01-09 00:00:03"), (2, "2024-01-09 00:00:04")),
                     rows((9, "2200-01-01 00:00:00"))], "login-rows")
    days = J.user_login_window(replay.stream)
    assert "InPandas" not in days._jdf.queryExecution().analyzed().toString()
    got = {r["stt"][5:]: (r["uu_ct"], r["back_ct"]) for r in J.run_replayed(days, replay, "login-rows").collect()}
    assert got == {"01-01 00:00:00": (2, 0), "01-08 00:00:00": (1, 0), "01-09 00:00:00": (3, 1)}


def test_search_texts_are_joined_before_the_replay(spark, monkeypatch):
    """No batch of the stream reads the documents again."""
    from rtdw.plans import queries as Q
    seen = []
    monkeypatch.setattr(Q.stream_jobs, "run_replayed", lambda df, *a: seen.append(df))
    Q.stream_keyword_window(spark, SF)
    assert "Join" not in seen[0]._jdf.queryExecution().analyzed().toString()


def test_sku_hops_run_over_skus_not_cells(spark, tmp_path, monkeypatch):
    """SKUs without a name, without an id and named twice included; in one pass or in several."""
    row = "id string, seq int, ts_ms bigint, sku_id string, " + ", ".join(f"{c} decimal(16,2)" for c in sku_job.SKU_MEASURES) + \
        ", emitted_ms bigint"
    batch = spark.createDataFrame([(f"d{k}", 1, 0, sku, *[Decimal(k)] * 4, 10_000 * (k % 4)) for k, sku in enumerate(
        ["s1", "s1", "s1", "s2", "s2", "none", None, "s1"])], row)
    two = lambda *rows: spark.createDataFrame(list(rows), "id string, name string, up string")
    dims_ = lambda: {"sku": spark.createDataFrame([("s1", "n1", "p", "t", "3"), ("s2", "n2", "p", "t", "3"), ("s2", "n3", "p", "t", "3")],
                                                  "id string, sku_name string, spu_id string, tm_id string, category3_id string"),
                     "spu": two(("p", "spu", "")).withColumnRenamed("name", "spu_name"),
                     "trademark": two(("t", "brand", "")).withColumnRenamed("name", "tm_name"),
                     "category3": two(("3", "c3", "2")).withColumnRenamed("up", "category2_id"),
                     "category2": two(("2", "c2", "1")).withColumnRenamed("up", "category1_id"), "category1": two(("1", "c1", ""))}
    seen, enrich = [], sku_job.dims.enrich_sku
    monkeypatch.setattr(sku_job.dims, "enrich_sku", lambda df, **d: (seen.append((df.columns, sorted(str(r[0]) for r in df.collect()))), enrich(df, **d))[1])
    got = []
    for at_once in (10**6, 3):
        monkeypatch.setattr(sku_job, "AT_ONCE", at_once)
        job = sku_job.SkuOrders(spark, f"{tmp_path}/{at_once}", dims_, buckets=4)
        for n in (0, 1):
            job.write(batch, n)
        got.append(sorted((r["sku_id"], r["stt"][-8:], r["sku_name"] or "", r["category1_name"] or "", int(r["order_amount"]))
                          for r in job.read().collect()))
    assert got[0] == got[1] and seen[0] == (["sku_id"], ["None", "none", "s1", "s2"])
    sums = {("s1", 0): 0, ("s1", 1): 1, ("s1", 2): 2, ("s1", 3): 7, ("s2", 3): 3, ("s2", 0): 4, ("none", 1): 5}
    names = {"s1": ["n1"], "s2": ["n2", "n3"], "none": [""]}
    assert got[0] == sorted((sku, f"00:00:{10 * w:02d}", name, "c1" if name else "", 2 * total)
                            for (sku, w), total in sums.items() for name in names[sku])
