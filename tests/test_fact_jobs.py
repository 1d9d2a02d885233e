"""Fact joins as streams: several micro-batches, late sides, the bound of the retention."""

from rtdw.session import settings
from pyspark.sql import functions as F

from rtdw.session import settings
from rtdw.streaming import fact_jobs as FJ
from rtdw.streaming.replay import Replay

CDC = "op string, ts_ms bigint, before map<string,string>, after map<string,string>, source map<string,string>"
T0 = 1_700_000_000_000
S = 1000


def env(table, at_s, **after):
    return ("r", T0 + at_s * S, None, {k: str(v) for k, v in after.items()}, {"db": "gmall", "table": table})


def detail(i, order, at_s, n=1):
    return env("order_detail", at_s, id=i, order_id=order, sku_id="s", sku_name="n", create_time=T0, sku_num=n, order_price="2.00",
               split_total_amount="2.00")


def run(spark, batches, job="order_pay_suc", retention=FJ.RETENTION):
    import uuid

    from rtdw.session import state_dir
    # the last batch is far ahead on every side and moves the watermark past all
    far = [detail("z", "z1", 10**6), env("order_info", 10**6, id="z2", order_status="1006"),
           env("order_detail_activity", 10**6, order_detail_id="z3"), env("order_detail_coupon", 10**6, order_detail_id="z4"),
           env("payment_info", 10**6, order_id="z5", payment_status="1602"),
           env("order_refund_info", 10**6, id="z6", order_id="z7", sku_id="z", refund_status="0705"),
           env("refund_payment", 10**6, id="z8", order_id="z9", sku_id="y", refund_status="1602")]
    replay = Replay([spark.createDataFrame(b, CDC) for b in [*batches, far]], "t-fact")
    make, key = FJ.JOBS[job]
    fact = make(replay.stream, retention)
    path = state_dir(spark, f"t-fact-{uuid.uuid4().hex[:8]}")
    table = FJ.fact_table(spark, f"{path}/table", fact, key, 4)
    replay.run(fact.writeStream.foreachBatch(FJ.upsert(table)).option("checkpointLocation", f"{path}/c"))
    return {r[key]: r for r in table.read().collect()}


def test_payments_join_over_batches_and_the_bound_drops_a_match(spark):
    pay = lambda order, at_s: env("payment_info", at_s, user_id="u", order_id=order, payment_type="1101",
                                  callback_time=T0, payment_status="1602")
    got = run(spark, [
        [detail("d1", "o1", 0), env("order_info", 10, id="o1", user_id="u", province_id="p"), detail("d2", "o2", 0),
         env("order_info", 0, id="o2", user_id="u", province_id="p"), detail("d3", "o3", 0)],
        # the payment of o1 comes in time, that of o2 two hours after its order: beyond 1805 s
        [pay("o1", 600), pay("o2", 7200), env("order_detail_activity", 100, order_detail_id="d1", activity_id="a", activity_rule_id="r")],
        # a header that is late by the watermark's allowance joins its stored detail; a newer version of d1
        [env("order_info", 1200, id="o3", user_id="v", province_id="q"), pay("o3", 1500), detail("d1", "o1", 300, n=2)],
    ])
    assert set(got) == {"d1", "d3"}
    assert (got["d1"]["sku_num"], got["d1"]["activity_id"], got["d1"]["coupon_id"]) == ("2", "a", None)
    assert got["d3"]["user_id"] == "v" and got["d3"]["split_payment_amount"] == "2.00"


def test_refunds_join_three_sides(spark):
    req = env("order_refund_info", 0, id="r1", user_id="u", order_id="o", sku_id="s", refund_num="3", refund_amount="6",
              refund_status="0705", create_time=T0)
    head = env("order_info", 60, id="o", user_id="u", province_id="p", order_status="1006")
    paid = env("refund_payment", 900, id="p1", order_id="o", sku_id="s", payment_type="1", callback_time=T0, total_amount="6",
               refund_status="1602")
    got = run(spark, [[req], [paid], [head]], "refund_pay_suc")
    assert set(got) == {"p1"} and got["p1"]["refund_num"] == "3" and got["p1"]["province_id"] == "p"
    got = run(spark, [[head], [req]], "order_refund")
    assert set(got) == {"r1"} and got["r1"]["refund_amount"] == "6"


def test_a_batch_is_kept_while_it_is_upserted(spark):
    """Its two readings must not run the last join's state twice."""
    class Table:
        key = ["id"]

        def commit(self, n, batch, merge):
            self.seen = (n, batch.is_cached, batch.count())

    table, batch = Table(), spark.range(3).select("id", F.lit(1).alias("version_ms"))
    FJ.upsert(table)(batch, 7)
    assert table.seen == (7, True, 3) and not batch.is_cached


def test_a_join_keeps_one_store_a_partition(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1_000)], "id string, ts_ms bigint")
    replay = Replay([rows], "one-store")
    x, y = (FJ._timed(replay.stream, n, "1 hour") for n in ("x", "y"))
    joined = x.join(y, (F.col("x.id") == F.col("y.id")) & FJ._within("x._x", "y._y", "1 hour")).select("x.id")
    with settings(spark, FJ.JOIN_STATE):
        replay.run(joined.writeStream.foreachBatch(lambda b, n: b.count()).option("checkpointLocation", f"{tmp_path}/c"))
    stores = [p.name for p in (tmp_path / "c" / "state" / "0" / "0").iterdir()]
    assert not any("key" in name.lower() for name in stores), stores


def test_a_batch_adds_only_its_changes_to_the_checkpoint(spark, tmp_path):
    parts = [spark.createDataFrame([(f"{n}-{k}", 1_000) for k in range(20)], "id string, ts_ms bigint") for n in (0, 1)]
    replay = Replay(parts, "changes")
    x, y = (FJ._timed(replay.stream, n, "1 hour") for n in ("x", "y"))
    joined = x.join(y, (F.col("x.id") == F.col("y.id")) & FJ._within("x._x", "y._y", "1 hour")).select("x.id")
    with settings(spark, FJ.JOIN_STATE):
        replay.run(joined.writeStream.foreachBatch(lambda b, n: b.count()).option("checkpointLocation", f"{tmp_path}/c"))
    names = [p.name for p in (tmp_path / "c" / "state" / "0" / "0").iterdir() if not p.name.startswith(".")]
    # the first version also holds the new stores themselves
    assert "2.changelog" in names and {n for n in names if n.endswith(".zip")} <= {"1.zip"}, names
