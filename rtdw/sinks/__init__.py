"""Sinks (SNK1-SNK11) and output formatting (PRJ29, FN15).

Batch writers take a DataFrame; streaming writers are ``foreachBatch``
functions built on the same batch writers, so a micro-batch is written exactly
like a batch job. Idempotence on replay: every micro-batch write replaces the
output folder of its own ``batch_id`` (files) or merges by key (tables), so a
batch re-run after a failure leaves no duplicates.

Kafka and JDBC targets are described by option builders: their connector jars
are not part of this build, so only the file targets run in tests.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .keyed import KeyedTable

# ------------------------------------------------------------- formatting --


def snake_case(name: str) -> str:
    """FN15: ``camelCase`` -> ``snake_case``."""
    return re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()


def camel_case(name: str) -> str:
    """FN15: ``snake_case`` -> ``camelCase``."""
    head, *rest = name.split("_")
    return head + "".join(p[:1].upper() + p[1:] for p in rest)


def rename_columns(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    return df.toDF(*[fn(c) for c in df.columns])


def metric_json(df: DataFrame, hidden: Sequence[str] = ()) -> DataFrame:
    """PRJ29: one JSON object per metric row, snake_case names, hidden fields
    left out, NULL fields dropped (``to_json`` omits them)."""
    visible = [F.col(c).alias(snake_case(c)) for c in df.columns if c not in hidden]
    return df.select(F.to_json(F.struct(*visible)).alias("value"))


# ------------------------------------------------------------ file writers --

def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """SNK1 / SNK5 file form: JSON lines (batch). Streams use ``idempotent_files``."""
    df.write.mode(mode).json(path)


def write_routed(df: DataFrame, path: str, route_col: str = "sink_table",
                 mode: str = "append") -> None:
    """SNK2: destination chosen per row (one folder per sink table)."""
    df.write.mode(mode).partitionBy(route_col).parquet(path)


def write_with_serializer(df: DataFrame, path: str, key: F.Column | None,
                          value: F.Column, mode: str = "append") -> None:
    """SNK3: caller supplies key/value expressions."""
    cols = [value.alias("value")] + ([key.alias("key")] if key is not None else [])
    df.select(*cols).write.mode(mode).json(path)


def write_dead_letters(dirty: DataFrame, path: str, batch_id: int) -> None:
    """SNK8: unparsable records, raw text kept; a replayed batch replaces its own."""
    dirty.write.mode("overwrite").json(f"{path.rstrip('/')}/batch={batch_id}")


def write_split(routed: DataFrame, base: str, batch_id: int) -> None:
    """SNK9: the outputs of one log batch in one write and one pass: rows
    ``(topic, value)``, one folder per topic under the batch's own folder."""
    routed.write.mode("overwrite").partitionBy("topic").json(f"{base.rstrip('/')}/batch={batch_id}")


def show(df: DataFrame, label: str, n: int = 20) -> None:
    """SNK10: labelled debug print."""
    print(f"--- {label} ---")
    df.show(n, truncate=False)


def create_dim_table(spark: SparkSession, name: str, columns: Sequence[str],
                     location: str | None = None) -> None:
    """SNK11: create a dimension table of string columns if absent."""
    cols = ", ".join(f"`{c}` STRING" for c in columns)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{loc}")


def drop_dim_table(spark: SparkSession, name: str) -> None:
    """SNK11: drop a dimension table if present."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


# --------------------------------------------------------- keyed / upsert --

def upsert_key_value(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """SNK4 record form: JSON key of the primary key, JSON value of the row."""
    return df.select(F.to_json(F.struct(*key)).alias("key"),
                     F.to_json(F.struct(*df.columns)).alias("value"))


def merge_upsert(current: DataFrame | None, changes: DataFrame, key: Sequence[str],
                 seq_col: str, op_col: str | None = None) -> DataFrame:
    """SNK4 / SNK7 table form: the newest row per key of the current table and
    the changes together, in one aggregation, so a change older than the stored row
    (a replay, a late record) changes nothing. With ``op_col`` a newest change of op
    ``d`` removes its key (``keyed_upsert`` keeps such a table in buckets)."""
    from ..operators.facts import upsert_latest

    rows = changes if op_col is None else changes.withColumn(op_col, F.coalesce(F.col(op_col), F.lit("u")))
    if current is not None:
        stored = current if op_col is None else current.withColumn(op_col, F.lit("u"))
        rows = stored.unionByName(rows, allowMissingColumns=True)
    newest = upsert_latest(rows, list(key), seq_col)
    # a delete that is the newest row of its key leaves the table with it
    return newest if op_col is None else newest.where(F.col(op_col) != "d").drop(op_col)


# -------------------------------------------------- streaming foreachBatch --

def keyed_upsert(table: KeyedTable, seq_col: str,
                 op_col: str | None = None) -> Callable[[DataFrame, int], None]:
    """SNK4/SNK7: ``foreachBatch`` writer of a keyed table. A batch rewrites only the buckets its
    keys fall into, and a replayed batch leaves no trace of the first try."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table.commit(batch_id, batch, lambda stored, changes: merge_upsert(stored, changes, table.key, seq_col, op_col))
    return write


def idempotent_files(path: str, fmt: str = "json") -> Callable[[DataFrame, int], None]:
    """SNK5/SNK6: ``foreachBatch`` writer that overwrites the folder of its
    own batch id, so a replayed batch replaces instead of duplicating."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch={batch_id}")
    return write


# ------------------------------------------------------ connector options --

def kafka_source_options(servers: str, topic: str, group: str,
                         fail_on_data_loss: bool = True) -> dict[str, str]:
    """SRC1 options: whole topic from the earliest offset. Offsets that are no
    longer there fail the query unless the caller says otherwise."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": "earliest", "kafka.group.id": group,
            "failOnDataLoss": str(fail_on_data_loss).lower()}


def kafka_sink_options(servers: str, topic: str | None = None) -> dict[str, str]:
    """SNK1/SNK2 options; without ``topic`` the ``topic`` column routes rows."""
    opts = {"kafka.bootstrap.servers": servers}
    if topic:
        opts["topic"] = topic
    return opts


def jdbc_options(url: str, table: str, user: str, password: str) -> dict[str, str]:
    """SRC7 / OLAP sink options."""
    return {"url": url, "dbtable": table, "user": user, "password": password}
