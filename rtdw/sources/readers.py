"""Source readers (SRC1, SRC2, SRC4, SRC5, SRC6, SRC7).

Kafka and JDBC need connector jars that are not part of this build; the
functions build the reader with the right options and work wherever the
cluster provides the jars. File forms run everywhere and are what the tests use.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks import camel_case, kafka_source_options
from ..sinks.keyed import KeyedTable
from .envelope import CDC_SCHEMA, ORDER_DETAIL_FACT_SCHEMA, parse_plain


def read_topic(spark: SparkSession, servers: str, topic: str, group: str,
               fail_on_data_loss: bool = True) -> DataFrame:
    """SRC1: a topic from the earliest offset; ``value`` as a string and the
    record ``timestamp`` kept (SRC4). Offsets repeat across partitions, so
    ``seq`` is the pair (partition, offset): ordering by ``(ingest_ts, seq)`` is
    total (X15)."""
    raw = spark.readStream.format("kafka").options(
        **kafka_source_options(servers, topic, group, fail_on_data_loss)).load()
    return raw.select(F.col("value").cast("string").alias("value"),
                      F.col("timestamp").alias("ingest_ts"),
                      F.struct("partition", "offset").alias("seq"))


def read_json_lines_stream(spark: SparkSession, path: str,
                           max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC1 file form: a folder of JSON-lines files as a stream of ``value``
    strings, with the file time as the record timestamp (SRC4)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).select(F.col("value"),
                               F.col("_metadata.file_modification_time").alias("ingest_ts"))


def read_envelopes(df: DataFrame, col: str = "value") -> DataFrame:
    """SRC2/SRC3: change envelopes from JSON text (stream or batch)."""
    return parse_plain(df, CDC_SCHEMA, col)


def snapshot_as_envelopes(df: DataFrame, table: str, db: str, ts_ms: int | None = None) -> DataFrame:
    """SRC2 re-aimed: a table snapshot (e.g. ``spark.read.jdbc``) as ``op='r'``
    envelopes, all values as strings, like a change stream's initial read."""
    after = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.col(c).cast("string"))])
    ts = F.lit(ts_ms).cast("bigint") if ts_ms is not None else F.unix_millis(F.current_timestamp())
    return df.select(F.lit("r").alias("op"), ts.alias("ts_ms"),
                     F.lit(None).cast(T.MapType(T.StringType(), T.StringType())).alias("before"),
                     after.alias("after"),
                     F.create_map(F.lit("db"), F.lit(db), F.lit("table"), F.lit(table)).alias("source"))


def read_fact_topic(df: DataFrame, col: str = "value") -> DataFrame:
    """SRC5: the order-detail fact topic re-read as a table."""
    return parse_plain(df, ORDER_DETAIL_FACT_SCHEMA, col)


def read_dimension(spark: SparkSession, path: str, nested: Sequence[str] = ()) -> DataFrame:
    """SRC6: a dimension table; ``nested`` columns are wrapped in a row
    ``info`` (the column-family shape, read back as ``info.<col>``)."""
    d = spark.read.parquet(path)
    if not nested:
        return d
    rest = [c for c in d.columns if c not in nested]
    return d.select(*rest, F.struct(*nested).alias("info"))


def read_jdbc(spark: SparkSession, url: str, query: str, user: str, password: str,
              camel: bool = False) -> DataFrame:
    """SRC7: a relational query as rows, optionally with camelCase names."""
    df = (spark.read.format("jdbc").option("url", url).option("query", query)
          .option("user", user).option("password", password).load())
    return df.toDF(*[camel_case(c) for c in df.columns]) if camel else df


def after_snapshot(changes: DataFrame, position: int, column: str = "seq") -> DataFrame:
    """SRC2, batch: the log's changes that a snapshot taken at ``position`` does not hold, each
    once however often it was delivered."""
    return changes.where(F.col(column) > position).dropDuplicates([column])


class Handover:
    """SRC2 as a stream: a snapshot, then the changes behind it, each once.

    ``write`` is a ``foreachBatch`` function over the change log (envelopes with ``part``, the log's
    partition, and ``position``, ascending in it). Per partition a change passes if its position is
    beyond the highest one written so far, which starts at the snapshot's; the positions are a keyed
    table, so a batch that runs again or comes again writes nothing twice. Every batch writes its own
    folder under ``path/out``; the snapshot is folder 0."""

    def __init__(self, spark: SparkSession, path: str, snapshot: DataFrame, positions: dict[str, int]):
        self.path, self.spark = path.rstrip("/"), spark
        self.held = KeyedTable(spark, f"{self.path}/positions", ["part"], "part string, position bigint", buckets=1)
        self.start = spark.createDataFrame(sorted(positions.items()), "part string, position bigint")
        snapshot.write.mode("overwrite").parquet(f"{self.path}/out/batch=-1")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        latest = lambda df: df.groupBy("part").agg(F.max("position").alias("position"))
        known = latest(self.held.read(batch_id).unionByName(self.start)).withColumnRenamed("position", "known")
        new = batch.join(known, "part", "left").where(F.col("known").isNull() | (F.col("position") > F.col("known"))).drop(
            "known").dropDuplicates(["part", "position"]).persist()
        try:
            new.drop("part", "position").write.mode("overwrite").parquet(f"{self.path}/out/batch={batch_id}")
            self.held.commit(batch_id, latest(new), lambda stored, more: latest(stored.unionByName(more)))
        finally:
            new.unpersist()

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/out").drop("batch")
