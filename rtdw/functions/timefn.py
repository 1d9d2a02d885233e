"""Date/time helpers (FN1-FN5, FN11, FN16, WIN6).

All helpers return Column expressions evaluated in the session time zone, so
parsing and formatting agree (the reference formats in the machine zone but
parses at +8; we use one zone for both).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FMT = "yyyy-MM-dd"
DATETIME_FMT = "yyyy-MM-dd HH:mm:ss"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def today_int() -> Column:
    """FN1: today as an int ``yyyyMMdd``."""
    return F.date_format(F.current_date(), "yyyyMMdd").cast("int")


def datetime_str_to_ms(s) -> Column:
    """FN2: ``yyyy-MM-dd HH:mm:ss`` string -> epoch milliseconds."""
    return F.unix_millis(F.to_timestamp(_c(s), DATETIME_FMT))


def date_str_to_ms(s) -> Column:
    """FN4: ``yyyy-MM-dd`` string -> epoch milliseconds at midnight."""
    return F.unix_millis(F.to_timestamp(_c(s), DATE_FMT))


def ms_to_ts(ms) -> Column:
    return F.timestamp_millis(_c(ms).cast("bigint"))


def ms_to_date(ms) -> Column:
    """FN3: epoch ms -> ``yyyy-MM-dd``."""
    return F.date_format(ms_to_ts(ms), DATE_FMT)


def ms_to_datetime(ms) -> Column:
    """FN3: epoch ms -> ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(ms_to_ts(ms), DATETIME_FMT)


def ms_to_yyyymmdd(ms) -> Column:
    """FN3: epoch ms -> ``yyyyMMdd``."""
    return F.date_format(ms_to_ts(ms), "yyyyMMdd")


def ms_string_to_date(s) -> Column:
    """FN5: epoch-ms *string* (CDC convention) -> ``yyyy-MM-dd``."""
    return F.date_format(F.timestamp_millis(_c(s).try_cast("bigint")), DATE_FMT)


def ts_to_ms(ts) -> Column:
    """timestamp / timestamp_ntz -> epoch ms (session zone)."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def previous_day(d) -> Column:
    """FN16: the day before a date (ts - 86 400 000 ms)."""
    return F.date_sub(_c(d), 1)


def day_gap(cur, last) -> Column:
    """FN11: whole days between two dates (ms gap / 86 400 000, floored)."""
    return F.datediff(_c(cur), _c(last))


def tumbling(et, length: str) -> Column:
    """WIN1-WIN5: tumbling event-time window struct(start, end)."""
    return F.window(_c(et), length)


MICROS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000,
          "day": 86_400_000_000}


def slot(et, length: str) -> Column:
    """The tumbling window of a time as plain arithmetic, for a second window beside the
    one that Spark closes (it takes one window function per aggregation)."""
    number, unit = length.split()
    size = int(number) * MICROS[unit.rstrip("s")]
    start = F.unix_micros(_c(et)) - F.pmod(F.unix_micros(_c(et)), F.lit(size))
    return F.struct(F.timestamp_micros(start).alias("start"), F.timestamp_micros(start + size).alias("end"))


def window_labels(win: str = "window") -> list[Column]:
    """WIN6: ``stt``, ``edt`` and ``cur_date`` labels of a window struct."""
    return [
        F.date_format(F.col(f"{win}.start"), DATETIME_FMT).alias("stt"),
        F.date_format(F.col(f"{win}.end"), DATETIME_FMT).alias("edt"),
        F.date_format(F.col(f"{win}.start"), DATE_FMT).alias("cur_date"),
    ]


def empty(x) -> Column:
    """FN10: null or empty string."""
    return F.coalesce(_c(x), F.lit("")) == ""
