"""Record shapes, JSON parsing and the change-envelope gate (SRC2-SRC5, PRJ1-PRJ6).

Two change-envelope dialects exist in the reference: ``op/ts_ms/before/after/
source`` (what the SQL jobs read) and ``table/type/ts/data/old`` (what the
config-routed fact split reads, trap X8). ``normalise`` maps the second onto
the first, so every downstream operator sees one shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMAP = T.MapType(T.StringType(), T.StringType())

CDC_SCHEMA = T.StructType([
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("before", SMAP),
    T.StructField("after", SMAP),
    T.StructField("source", SMAP),
])

CDC_ALT_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("data", SMAP),
    T.StructField("old", SMAP),
])

LOG_SCHEMA = T.StructType([
    T.StructField("common", SMAP),
    T.StructField("page", SMAP),
    T.StructField("start", SMAP),
    T.StructField("err", SMAP),
    T.StructField("displays", T.ArrayType(SMAP)),
    T.StructField("actions", T.ArrayType(SMAP)),
    T.StructField("ts", T.LongType()),
])

PAGE_LOG_SCHEMA = T.StructType([
    T.StructField("common", SMAP),
    T.StructField("page", SMAP),
    T.StructField("ts", T.LongType()),
])

# fact topic re-read as a table (SRC5): 16 strings + ts_ms
ORDER_DETAIL_FACT_FIELDS = ["id", "order_id", "user_id", "sku_id", "sku_name", "province_id",
                            "activity_id", "activity_rule_id", "coupon_id", "date_id",
                            "create_time", "sku_num", "split_original_amount",
                            "split_activity_amount", "split_coupon_amount", "split_total_amount"]
ORDER_DETAIL_FACT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ORDER_DETAIL_FACT_FIELDS]
    + [T.StructField("ts_ms", T.LongType())])

# fixed values: operation codes of the second envelope dialect
ALT_TYPE_TO_OP = {"bootstrap-insert": "r", "insert": "c", "update": "u", "delete": "d"}


def _v(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_strict(df: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    """PRJ1: parse JSON; a malformed record fails the job."""
    parsed = F.from_json(_v(col), schema, {"mode": "FAILFAST"})
    return df.select(parsed.alias("_j")).select("_j.*")


def is_json_object(col: str = "value") -> Column:
    """True when the text parses as a JSON *object* (not an array, scalar,
    ``null`` or garbage)."""
    v = F.try_parse_json(_v(col))
    return v.isNotNull() & F.schema_of_variant(v).startswith("OBJECT")


def parse_tolerant(df: DataFrame, schema: T.StructType, col: str = "value",
                   keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """PRJ2: (good, dirty). Good rows are parsed with ``schema``; dirty rows
    keep the raw text for the dead-letter sink (SNK8)."""
    ok = is_json_object(col)
    tagged = df.withColumn("_ok", ok)
    good = (tagged.where("_ok")
            .select(*keep, F.from_json(_v(col), schema).alias("_j"))
            .select(*keep, "_j.*"))
    dirty = tagged.where(~F.col("_ok")).drop("_ok")
    return good, dirty


def parse_plain(df: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    """PRJ3: plain parse. A malformed record fails the job; it never becomes a
    row of NULLs. A NULL record stays a row of NULLs (see ``parse_skip_null``)."""
    return parse_strict(df, schema, col)


def parse_skip_null(df: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    """PRJ4: drop NULL records, then parse."""
    return parse_plain(df.where(_v(col).isNotNull()), schema, col)


def normalise(df: DataFrame) -> DataFrame:
    """Map ``table/type/ts/data/old`` envelopes onto
    ``op/ts_ms/before/after/source``."""
    mapped = F.coalesce(*[F.when(F.col("type") == k, F.lit(v)) for k, v in ALT_TYPE_TO_OP.items()],
                        F.col("type"))
    return df.select(
        mapped.alias("op"),
        F.col("ts").cast("bigint").alias("ts_ms"),
        F.when(F.col("type") == "delete", F.col("data")).otherwise(F.col("old")).alias("before"),
        F.when(F.col("type") == "delete", F.lit(None).cast(SMAP)).otherwise(F.col("data")).alias("after"),
        F.create_map(F.lit("table"), F.col("table")).alias("source"),
    )


def cdc_gate(df: DataFrame, db: str) -> DataFrame:
    """PRJ5: change rows of database ``db`` with a known op and a non-empty
    ``after`` image (deletes with a NULL ``after`` stop here, trap X7)."""
    return df.where((F.col("source")["db"] == db)
                    & F.col("op").isin("c", "u", "d", "r")
                    & F.col("after").isNotNull()
                    & (F.size("after") > 0))


def config_image(df: DataFrame) -> DataFrame:
    """PRJ6: the effective image of a change: ``before`` for deletes, ``after``
    otherwise, with the op attached."""
    return df.withColumn("image", F.when(F.col("op") == "d", F.col("before"))
                         .otherwise(F.col("after")))


def table_is(name: str) -> Column:
    return F.col("source")["table"] == name
