"""Dimension lookups and dimension maintenance (J11-J18, ST9, SRC8).

A lookup is a left equi-join against a dimension snapshot: a missing row or a
NULL key passes the fact through with NULL (or a default) attributes, exactly
like the cache-aside lookup it replaces, but without one network call per row.

No broadcast hint is placed here. Dimension tables grow with the business, so
the join strategy is left to Spark's size checks: a static broadcast happens
only when the scanned size is under ``spark.sql.autoBroadcastJoinThreshold``,
and AQE re-decides from the measured shuffle size at run time. Large
dimensions fall back to a shuffled join, with AQE splitting skewed keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_dim(df: DataFrame, dim: DataFrame, key_col: str, fields: Mapping[str, str],
               dim_key: str = "id", default: str | None = None) -> DataFrame:
    """Attach ``fields`` (dim column -> output name) of the dimension row
    whose ``dim_key`` equals ``df[key_col]``. Misses and NULL keys keep the row
    with NULL attributes (or ``default``)."""
    prefix = "_dim_"
    d = dim.select(F.col(dim_key).alias(prefix + "key"),
                   *[F.col(src).alias(prefix + dst) for src, dst in fields.items()])
    j = df.join(d, df[key_col] == d[prefix + "key"], "left").drop(prefix + "key")
    for dst in fields.values():
        c = F.col(prefix + dst)
        if default is not None:
            c = F.coalesce(c, F.lit(default))
        j = j.withColumn(dst, c).drop(prefix + dst)
    return j


def enrich_sku(df: DataFrame, sku: DataFrame, spu: DataFrame, trademark: DataFrame,
               category3: DataFrame, category2: DataFrame, category1: DataFrame) -> DataFrame:
    """The snowflake chain. Each hop's key is an output of the hop
    before it; the joins run after the window aggregation, when the fact side
    is already reduced to one row per SKU and window."""
    out = lookup_dim(df, sku, "sku_id", {"sku_name": "sku_name", "spu_id": "spu_id",
                                         "category3_id": "category3_id", "tm_id": "tm_id"})
    out = lookup_dim(out, spu, "spu_id", {"spu_name": "spu_name"})
    out = lookup_dim(out, trademark, "tm_id", {"tm_name": "tm_name"})
    out = lookup_dim(out, category3, "category3_id", {"name": "category3_name",
                                                      "category2_id": "category2_id"})
    out = lookup_dim(out, category2, "category2_id", {"name": "category2_name",
                                                      "category1_id": "category1_id"})
    out = lookup_dim(out, category1, "category1_id", {"name": "category1_name"})
    return out


def point_read(dim: DataFrame, key: str, dim_key: str = "id") -> DataFrame:
    """SRC8: one dimension row by key (ad hoc; pipelines use ``lookup_dim``)."""
    return dim.where(F.col(dim_key) == F.lit(key))


def dim_merge(changes: DataFrame, key: str, columns: Sequence[str],
              seq_col: str = "seq", op_col: str = "op", image_col: str = "after",
              before_col: str | None = "before") -> DataFrame:
    """ST9: merge a dimension change log into the current table.

    Per key, after its last delete: each column takes its latest non-empty
    value (an empty string keeps the old value); a key whose last change is a
    delete disappears. Deletes take their key from the ``before`` image when
    ``after`` is NULL.

    One aggregation does it: per column ``max(struct(seq, value))`` over the
    non-empty values, compared to the last delete's ``seq`` afterwards. Partial
    aggregation keeps a very hot key from reaching a single task unreduced.
    """
    img = F.col(image_col)
    key_expr = img[key]
    if before_col is not None:
        key_expr = F.coalesce(img[key], F.col(before_col)[key])
    rows = changes.select(key_expr.alias("_k"), F.col(seq_col).alias("_seq"),
                          F.col(op_col).alias("_op"), img.alias("_img"))
    is_del = F.col("_op") == "d"
    aggs = [F.max(F.when(is_del, F.col("_seq"))).alias("_del"),
            F.max(F.when(~is_del, F.col("_seq"))).alias("_put")]
    for c in columns:
        v = F.col("_img")[c]
        aggs.append(F.max(F.when(~is_del & v.isNotNull() & (v != ""),
                                 F.struct(F.col("_seq"), v.alias("v")))).alias("_c_" + c))
    agg = rows.where(F.col("_k").isNotNull()).groupBy("_k").agg(*aggs)
    alive = agg.where(F.col("_put").isNotNull()
                      & (F.col("_del").isNull() | (F.col("_put") > F.col("_del"))))
    after_del = lambda c: F.when(
        F.col("_del").isNull() | (F.col(f"_c_{c}._seq") > F.col("_del")), F.col(f"_c_{c}.v"))
    return alive.select(F.col("_k").alias(key), *[after_del(c).alias(c) for c in columns])
