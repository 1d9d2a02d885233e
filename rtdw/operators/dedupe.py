"""Batch forms of the keyed-state operators (ST1-ST7).

The reference keeps one value per key and walks records in arrival order. In
batch the same answers come from aggregations over (time, seq) structs:

* "first record of a key (per day)" = ``min(struct(time, seq, payload))``
* "latest record of a key"          = ``max(struct(order..., seq, payload))``

Both are declarative aggregates, so Spark runs them as partial (map-side)
+ final aggregation (by sorting, as the buffer is a struct): a device or user that
owns a third of all rows collapses to one row per map task before the shuffle.
Window functions are used over such pre-aggregated sets, whose size per key is bounded
(e.g. distinct days), and in ``net_replace_rows`` over the versions of one record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefn import day_gap, previous_day


def _struct_cols(order: Sequence[str], payload: Sequence[str]) -> list[str]:
    seen, out = set(), []
    for c in list(order) + list(payload):
        if c not in seen:
            seen.add(c)
            out.append(c)
    return out


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  payload: Sequence[str] = ()) -> DataFrame:
    """One row per key: the earliest by ``order`` (ties broken by later order
    columns, so pass an explicit ``seq`` last). Returns keys + struct fields."""
    cols = [c for c in _struct_cols(order, payload) if c not in keys]
    agg = df.groupBy(*keys).agg(F.min(F.struct(*cols)).alias("_f"))
    return agg.select(*keys, *[F.col(f"_f.{c}").alias(c) for c in cols])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   payload: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the latest by ``order`` (``max`` of a struct)."""
    if payload is None:
        payload = [c for c in df.columns if c not in keys]
    cols = [c for c in _struct_cols(order, payload) if c not in keys]
    agg = df.groupBy(*keys).agg(F.max(F.struct(*cols)).alias("_l"))
    return agg.select(*keys, *[F.col(f"_l.{c}").alias(c) for c in cols])


def daily_first(df: DataFrame, key: str, date_col: str = "d", time_col: str = "et",
                seq_col: str = "seq", payload: Sequence[str] = ()) -> DataFrame:
    """ST2/ST3/ST5: rows that are the first of their key on their day
    (the reference emits / flags exactly those)."""
    return first_per_key(df, [key, date_col], [time_col, seq_col], payload)


def mark_daily_first(df: DataFrame, key: str, flag: str = "uv_ct", date_col: str = "d",
                     time_col: str = "et", seq_col: str = "seq") -> DataFrame:
    """ST2 with every row kept: ``flag`` = 1 on the first row of (key, day)."""
    firsts = daily_first(df, key, date_col, time_col, seq_col).select(
        key, date_col, seq_col, F.lit(1).alias("_first"))
    return (df.join(firsts, [key, date_col, seq_col], "left")
              .withColumn(flag, F.coalesce(F.col("_first"), F.lit(0)).cast("bigint"))
              .drop("_first"))


def repair_is_new(df: DataFrame, key: str = "mid", flag: str = "is_new", date_col: str = "d",
                  time_col: str = "et", seq_col: str = "seq",
                  out: str = "is_new_fixed") -> DataFrame:
    """ST1 new-visitor repair.

    The first record of a device fixes a date: its own date when it claims to
    be new, otherwise the previous day. Any later record claiming ``is_new=1``
    on a different date is corrected to ``0``. The fixed date never changes.
    """
    first = first_per_key(df, [key], [time_col, seq_col], [flag, date_col]).select(
        key,
        F.when(F.col(flag) == "1", F.col(date_col))
         .otherwise(previous_day(F.col(date_col))).alias("_fixed_date"))
    j = df.join(first, key, "left")
    return j.withColumn(
        out, F.when((F.col(flag) == "1") & (F.col("_fixed_date") != F.col(date_col)), F.lit("0"))
              .otherwise(F.col(flag))).drop("_fixed_date")


def login_days(df: DataFrame, uid: str = "uid", date_col: str = "d", time_col: str = "et",
               seq_col: str = "seq", back_days: int = 8) -> DataFrame:
    """ST4: one row per user and login day (the day's first login), with
    ``uu_ct`` = 1 and ``back_ct`` = 1 when the previous login day is at least
    ``back_days`` earlier. The lag runs over distinct days per user, a set
    whose size is bounded by the calendar, not by the user's traffic."""
    firsts = daily_first(df, uid, date_col, time_col, seq_col)
    w = Window.partitionBy(uid).orderBy(date_col)
    prev = F.lag(date_col).over(w)
    return firsts.select(
        uid, date_col, time_col, seq_col,
        F.lit(1).cast("bigint").alias("uu_ct"),
        F.when(prev.isNotNull() & (day_gap(F.col(date_col), prev) >= back_days), 1)
         .otherwise(0).cast("bigint").alias("back_ct"))


def retract_replace(df: DataFrame, key: str, amount: str, seq_col: str = "seq") -> DataFrame:
    """ST6 literal stream: every row, plus for each row that was replaced
    later (same key) a retraction copy with the amount negated. The copy keeps
    the old row's fields, including its event time."""
    last = df.groupBy(key).agg(F.max(seq_col).alias("_last"))
    j = df.join(last, key)
    retract = (j.where(F.col(seq_col) < F.col("_last"))
                .withColumn(amount, -F.col(amount))
                .withColumn("_retract", F.lit(True)))
    keep = j.withColumn("_retract", F.lit(False))
    return keep.unionByName(retract).drop("_last")


def net_replace_rows(df: DataFrame, key: str, amount: str, seq_col: str = "seq",
                     group_cols: Sequence[str] = ()) -> DataFrame:
    """ST6 netted for aggregation: a retraction shares window and group with
    the row it cancels, so the pair sums to zero there. What remains is every
    row's grouping fields, with its amount only on each key's last row. Grouping
    this with ``sum(amount)`` and distinct counts gives the same result as the
    literal stream from one pass over the input: one exchange on the key, whose
    rows are the few versions of one record."""
    newest = Window.partitionBy(key).orderBy(F.col(seq_col).desc())
    ranked = df.withColumn("_rank", F.row_number().over(newest))
    return ranked.withColumn(amount, F.when(F.col("_rank") == 1, F.col(amount))).drop("_rank")


def latest_within(df: DataFrame, key: str, order_col: str = "ts_ms",
                  seq_col: str = "seq") -> DataFrame:
    """ST7 batch form: the newest record per key (newer-or-equal replaces; a
    tie goes to the later arrival)."""
    return latest_per_key(df, [key], [order_col, seq_col])

