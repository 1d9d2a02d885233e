"""Application-log cleaning, new-visitor repair and five-way split
(ST1, PRJ2, PRJ25-PRJ28, SNK8, SNK9).

Input is the parsed log (``common``/``page``/``start``/``err``/``displays``/
``actions``/``ts``, maps of strings). ``split`` gives five projections of one
repaired DataFrame; a sink that writes all five explodes each record into its outputs in one
pass (``route_tag``, ``sinks.write_split``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.envelope import LOG_SCHEMA, parse_tolerant
from . import dedupe

OUTPUTS = ("err", "start", "page", "display", "action")


def clean(raw: DataFrame, col: str = "value", keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """PRJ2: (parsed logs, dirty lines for the dead-letter sink)."""
    return parse_tolerant(raw, LOG_SCHEMA, col, keep)


def repair_log(log: DataFrame, seq_col: str = "seq") -> DataFrame:
    """ST1 applied to nested log records: ``common['is_new']`` is rewritten
    where a returning device claims to be new."""
    flat = log.withColumn("_mid", F.col("common")["mid"]) \
              .withColumn("_is_new", F.col("common")["is_new"]) \
              .withColumn("_et", F.timestamp_millis("ts")) \
              .withColumn("_d", F.to_date("_et"))
    fixed = dedupe.repair_is_new(flat, key="_mid", flag="_is_new", date_col="_d",
                                 time_col="_et", seq_col=seq_col, out="_fixed")
    common = F.transform_values(
        "common", lambda k, v: F.when(k == "is_new", F.col("_fixed")).otherwise(v))
    return fixed.withColumn("common", common).drop("_mid", "_is_new", "_et", "_d", "_fixed")


def _nonempty(arr: str):
    return F.col(arr).isNotNull() & (F.size(arr) > 0)


def split(log: DataFrame) -> dict[str, DataFrame]:
    """PRJ25-PRJ27: route each record.

    * ``err``: records with an ``err`` object, whole (arrays kept, X14);
      the err object is then removed from the record.
    * ``start``: records with a ``start`` object.
    * ``page``: all other records, with ``displays``/``actions`` removed only
      when non-empty (X14).
    * ``display``: one row per display of a page record: common, page,
      display, ts.
    * ``action``: one row per action of a page record: common, page, action
      (no top-level ts, as in the reference).
    """
    err = log.where(F.col("err").isNotNull())
    rest = log.withColumn("err", F.lit(None).cast(log.schema["err"].dataType))
    start = rest.where(F.col("start").isNotNull())
    pages = rest.where(F.col("start").isNull())
    page = (pages
            .withColumn("displays", F.when(_nonempty("displays"), F.lit(None)).otherwise(F.col("displays")))
            .withColumn("actions", F.when(_nonempty("actions"), F.lit(None)).otherwise(F.col("actions"))))
    keep = [c for c in log.columns if c not in LOG_SCHEMA.fieldNames()]
    display = pages.select(*keep, "common", "page", F.explode("displays").alias("display"), "ts")
    action = pages.select(*keep, "common", "page", F.explode("actions").alias("action"))
    return {"err": err, "start": start, "page": page, "display": display, "action": action}


def fan_out(topics: str = "topics") -> Column:
    """The records one log record turns into, as an array of (topic, value): PRJ25-PRJ27
    in one expression over the columns of ``LOG_SCHEMA``."""
    names = LOG_SCHEMA.fieldNames()
    record = lambda topic, **other: F.struct(F.lit(topic).alias("topic"), F.to_json(F.struct(
        *(other[c].alias(c) if c in other else F.col(c) for c in names))).alias("value"))
    none = F.lit(None).cast(LOG_SCHEMA["err"].dataType)
    left = lambda c: F.when(_nonempty(c), F.lit(None)).otherwise(F.col(c))
    is_page = F.col("start").isNull()
    whole = F.array_compact(F.array(
        F.when(F.col("err").isNotNull(), record("err")),
        F.when(~is_page, record("start", err=none)),
        F.when(is_page, record("page", err=none, displays=left("displays"), actions=left("actions")))))

    def each(array: str, topic: str, *more: str) -> Column:
        one = lambda x: F.struct(F.lit(topic).alias("topic"), F.to_json(F.struct(
            F.col("common"), F.col("page"), x.alias(topic), *(F.col(c) for c in more))).alias("value"))
        return F.coalesce(F.transform(F.when(is_page, F.col(array)), one), F.array().cast("array<struct<topic:string,value:string>>"))

    return F.concat(whole, each("displays", "display", "ts"), each("actions", "action")).alias(topics)


def route_tag(log: DataFrame) -> DataFrame:
    """SNK9 as one write and one pass: every record is exploded into its outputs, tagged
    with their topic, so a single Kafka/file write with a ``topic`` column fans out to all five."""
    return log.select(F.explode(fan_out()).alias("r")).select("r.topic", "r.value")


def route_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``route_tag`` of parsed lines (``ok``, the columns of ``LOG_SCHEMA``, the raw text) with the
    dead letters as a sixth topic (SNK8), in the same pass."""
    dirty = F.array(F.struct(F.lit("dirty").alias("topic"), F.col(col).alias("value")))
    return lines.select(F.explode(F.when(F.col("ok"), fan_out()).otherwise(dirty)).alias("r")).select("r.topic", "r.value")
