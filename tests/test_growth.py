"""Plans and files whose size must follow the input: the change stream, routing, replays."""

import time

from pyspark.sql import functions as F

from rtdw.operators import facts, routing
from rtdw.sinks.keyed import list_names
from rtdw.sources import bindings as B
from rtdw.streaming import routing_jobs
from rtdw.streaming.replay import PART, Replay, in_time_order

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_selection_reads_its_own_table_only(spark):
    """No copy of the change stream is made for it."""
    got = facts.select_payment_success(B.topic_db(spark, SF))
    assert {f.rsplit("/", 1)[1] for f in got.inputFiles()} == {"orders.parquet"}
    assert "Exchange" not in plan(got)


def test_details_are_numbered_before_anything_is_derived(spark):
    below = B.order_detail(spark, SF)._jdf.queryExecution().optimizedPlan().toString().split("+- Window", 1)[1]
    assert "concat(" not in below and "decimal(16,2)" not in below


def test_the_order_fact_deals_details_once(spark):
    text = plan(B.order_fact(spark, SF))
    assert text.count("Exchange hashpartitioning(l_orderkey") == 1 and "Exchange hashpartitioning(order_id" not in text


def test_routes_are_broadcast(spark):
    cdc = B.topic_db(spark, SF)
    for routed in (routing.dim_route(cdc, B.dim_config_changelog(spark), B.DB_NAME),
                   routing.dwd_route(cdc, B.dwd_config_changelog(spark))):
        text = plan(routed)
        assert "BroadcastHashJoin [source" in text or "BroadcastHashJoin [_rk" in text
        assert "Exchange hashpartitioning(source#" not in text and "Exchange hashpartitioning(_rk" not in text


def test_a_routed_batch_is_not_kept(spark, tmp_path):
    state = routing_jobs.ConfigState(spark, f"{tmp_path}/config", ["source_table"], routing.DIM_CFG_SCHEMA)
    kept = []
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    write = lambda routed, n: kept.append((routed.count(), spark.sparkContext._jsc.getPersistentRDDs().size() - before))
    job = routing_jobs._routed(state, lambda changes, cfg: routing.dim_route(changes, cfg, B.DB_NAME), write)
    records = routing_jobs.tagged(B.cdc_cart_info(spark, SF), B.dim_config_changelog(spark).where("seq = 3"), routing.DIM_CFG_SCHEMA)
    job(records, 0)
    assert kept == [(B.cart_info(spark, SF).count(), 0)]


def test_dealt_parts_are_written_in_one_pass(spark, tmp_path):
    """Parts as before, an empty one and one that comes again included."""
    df = spark.createDataFrame([(k, f"2024-01-0{k} 00:00:00") for k in range(1, 7)], "k int, t string").select(
        "k", F.col("t").cast("timestamp").alias("t"))
    parts = [df.where("k % 2 = 1"), df.where("k > 100"), df.where("k % 2 = 0")]
    number = F.when(F.col("k") % 2 == 1, 0).otherwise(2)
    for replay in (Replay([*parts, parts[0]], "dealt", (df, number), {3: 0}), in_time_order(df, "in-order", "t")):
        replay.run(replay.stream.writeStream.foreachBatch(lambda b, n: None).option("checkpointLocation", f"{tmp_path}/{id(replay)}"))
        for k, part in enumerate(replay.parts):
            read = spark.read.schema(replay.schema).parquet(f"{replay.path}/in/part-{k}")
            assert sorted(r["k"] for r in read.collect()) == sorted(r["k"] for r in part.collect())
        assert PART not in replay.schema.fieldNames() and replay.dealt is not None


def test_processed_parts_and_shuffle_files_go(spark, tmp_path):
    """A part that comes again stays until then; no batch leaves shuffle files."""
    blocks = lambda: {b for b in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
                      .getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}
    df = spark.range(30).select(F.col("id").alias("k"))
    parts = [df.where(f"k % 3 = {n}") for n in range(3)]
    replay = Replay([*parts, parts[1]], "dropped", (df, (F.col("k") % 3).cast("int")), {3: 1}, drop=True)
    before, rows = blocks(), []
    replay.run(replay.stream.writeStream.foreachBatch(lambda b, n: rows.append(sorted(
        r["k"] for r in b.groupBy("k").count().repartition(2, "k").collect()))).option("checkpointLocation", f"{tmp_path}/c"))
    assert rows == [[*range(n, 30, 3)] for n in (0, 1, 2, 1)]
    # folders stay, since the query may be listing them
    assert [list_names(spark, f"{replay.path}/in/part-{n}") for n in range(4)] == [[]] * 4
    assert len(list_names(spark, f"{replay.path}/in")) == 4
    for _ in range(50):      # they are removed in the background
        if not (left := blocks() - before):
            break
        time.sleep(0.2)
    assert not left
