"""The log job as a stream (PRJ2, ST1, SNK8, SNK9): raw lines are parsed, devices that return
repaired, and every record written to its topics in one pass, dead letters included.

The date that a device's first record fixes is kept in a keyed table: the first to arrive decides
(within a batch, the earliest by time and ``seq``) and stays, for ``ttl`` if one is given. All of it is
JVM operators; a batch that runs again writes the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..functions.timefn import previous_day
from ..operators import logs
from ..sinks.keyed import KeyedTable
from ..sources.envelope import LOG_SCHEMA, is_json_object

FIRST = "mid string, day date, stored timestamp"


class LogJob:
    """Lines: ``value`` (text) and ``seq`` (order among equal times)."""

    def __init__(self, spark: SparkSession, path: str, ttl: str | None = None, buckets: int = 16):
        self.path, self.ttl = path.rstrip("/"), ttl
        self.first = KeyedTable(spark, f"{self.path}/first", ["mid"], FIRST, buckets)

    def _keep_first(self, stored: DataFrame, new: DataFrame) -> DataFrame:
        if self.ttl is not None:
            stored = stored.where(F.col("stored") >= F.current_timestamp() - F.expr(f"INTERVAL {self.ttl}"))
        return stored.unionByName(new.join(stored.select("mid"), "mid", "left_anti"))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` function."""
        lines = batch.withColumn("ok", F.coalesce(is_json_object("value"), F.lit(False))).select(
            "seq", "value", "ok", F.when(F.col("ok"), F.from_json("value", LOG_SCHEMA)).alias("j")).select(
            "seq", "value", "ok", "j.*").persist()
        try:
            day = F.to_date(F.timestamp_millis("ts"))
            known = lines.where(F.col("ok") & F.col("common")["mid"].isNotNull())
            fixed = known.groupBy(F.col("common")["mid"].alias("mid")).agg(
                F.min(F.struct("ts", "seq", F.col("common")["is_new"].alias("is_new"), day.alias("day"))).alias("f"))
            fixed = fixed.select("mid", F.when(F.col("f.is_new") == "1", F.col("f.day")).otherwise(
                previous_day("f.day")).alias("day"), F.current_timestamp().alias("stored"))
            buckets = self.first.commit(batch_id, fixed, self._keep_first)
            dates = self.first.part(batch_id + 1, buckets).select("mid", F.col("day").alias("first_day"))
            rows = lines.withColumn("mid", F.col("common")["mid"]).join(dates, "mid", "left")
            wrong = (F.col("common")["is_new"] == "1") & (F.col("first_day") != day)
            common = F.when(F.coalesce(wrong, F.lit(False)), F.transform_values(
                "common", lambda k, v: F.when(k == "is_new", F.lit("0")).otherwise(v))).otherwise(F.col("common"))
            sinks.write_split(logs.route_lines(rows.withColumn("common", common)), f"{self.path}/out", batch_id)
        finally:
            lines.unpersist()
