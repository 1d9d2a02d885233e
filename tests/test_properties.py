"""Property tests: retract/replace nets to the latest version; windows sum to
the global total."""

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rtdw.operators import dedupe, metrics

versions = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(-500, 500),
                              st.integers(0, 30)), min_size=1, max_size=25)


@settings(max_examples=15, deadline=None)
@given(versions)
def test_retract_replace_nets_to_latest(spark, rows):
    data = [(f"id{k}", i, f"o{k}", f"p{p}", Decimal(a) / 100, s)
            for i, (k, p, a, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "id string, seq int, order_id string, province_id string, "
                                     "amount decimal(16,2), sec int") \
        .withColumn("et", F.timestamp_seconds("sec"))
    lit = dedupe.retract_replace(df, "id", "amount")
    total = lit.agg(F.sum("amount")).first()[0] or Decimal(0)
    latest = {}
    for i, (k, p, a, s) in enumerate(rows):
        latest[k] = Decimal(a) / 100
    assert total == sum(latest.values(), Decimal(0))
    windows = metrics.province_order_window(df.withColumnRenamed("amount", "split_total_amount"),
                                            None, "4 seconds")
    assert (windows.agg(F.sum("order_amount")).first()[0] or Decimal(0)) == total
