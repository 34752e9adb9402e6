"""Column expressions. Everything here is a built-in Spark expression, so it
stays inside whole-stage codegen; no Python runs per row."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Exact type that the part of a CU value with up to six decimals is summed in.
#: Double sums depend on the order rows meet in, which differs with
#: partitioning; a fixed-point sum is the same on every rerun and every cluster
#: size. What a value has beyond that part (finer decimals, NaN, numbers too
#: large) is summed apart as double, so nothing is rounded away.
CU_DECIMAL = "decimal(28,6)"

#: Window-bound text format, e.g. ``05 June 2026 07:30``.
WINDOW_FORMAT = "dd MMMM yyyy HH:mm"
_WINDOW_FORMAT_PY = "%d %B %Y %H:%M"

# Synthetic operation-id parts.
SYNTHETIC_PREFIX = "synthetic-"
SYNTHETIC_SEPARATOR = "||"
NULL_START = "NULL_START"
NULL_END = "NULL_END"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_cu(c: str | Column) -> Column:
    """The part of a CU value that the fixed-point type holds; 0 for a value
    that it cannot hold at all, NULL for NULL."""
    v = _c(c).cast("double")
    return F.when(v.isNotNull(), F.coalesce(v.try_cast(CU_DECIMAL), F.lit(0).cast(CU_DECIMAL)))


def residual_cu(c: str | Column) -> Column:
    """What :func:`exact_cu` leaves of a CU value; 0.0 for most values."""
    return _c(c).cast("double") - exact_cu(c).cast("double")


def cu_sum(c: str | Column) -> Column:
    """SUM of a CU column as double: exact parts plus residuals. NULLs are
    skipped, a group of NULLs only is NULL, and NaN makes the sum NaN."""
    return F.sum(exact_cu(c)).cast("double") + F.sum(residual_cu(c))


def synthetic_operation_id(start: str | Column = "Operation_start_time", end: str | Column = "Operation_end_time") -> Column:
    """``synthetic-`` + SHA-256 of ``start||end`` (NULLs spelled out)."""
    return F.concat(
        F.lit(SYNTHETIC_PREFIX),
        F.sha2(
            F.concat_ws(
                SYNTHETIC_SEPARATOR,
                F.coalesce(_c(start).cast("string"), F.lit(NULL_START)),
                F.coalesce(_c(end).cast("string"), F.lit(NULL_END)),
            ),
            256,
        ),
    )


def with_synthetic_operation_id(df: DataFrame) -> DataFrame:
    """Fill NULL ``Operation_Id`` with a synthetic id; skipped when a needed
    column is absent."""
    if not {"Operation_Id", "Operation_start_time", "Operation_end_time"}.issubset(df.columns):
        return df
    return df.withColumn("Operation_Id", F.coalesce(F.col("Operation_Id"), synthetic_operation_id()))


def parse_window_bound(text: str) -> Column:
    """Window bound literal from ``dd MMMM yyyy HH:mm`` text, as TIMESTAMP_NTZ.

    The text is validated on the driver first so a bad bound fails fast
    instead of turning into a NULL bound (which would silently match nothing).
    """
    datetime.strptime(text, _WINDOW_FORMAT_PY)
    return F.to_timestamp_ntz(F.lit(text), F.lit(WINDOW_FORMAT))


def check_window(start: str, end: str) -> None:
    s = datetime.strptime(start, _WINDOW_FORMAT_PY)
    e = datetime.strptime(end, _WINDOW_FORMAT_PY)
    if e < s:
        raise ValueError(f"window end {end!r} is before start {start!r}")


def half_minute_by_text(c: str | Column = "TimePoint") -> Column:
    """``TimePoint LIKE '%:30'`` on the timestamp's text: true only for a whole
    ``:30`` second; fractional seconds do not match."""
    return _c(c).cast("string").like("%:30")


def half_minute_by_format(c: str | Column = "TimePoint") -> Column:
    """``date_format(TimePoint, 'ss') = '30'`` (also catches ``:30.5``)."""
    return F.date_format(_c(c), "ss") == F.lit("30")


def trunc_seconds(c: str | Column, grain_seconds: int = 1) -> Column:
    """Truncate a TIMESTAMP_NTZ to a whole-second grain dividing one minute.

    Built from calendar parts, so it is independent of the session time zone
    and keeps NULL timestamps (``window()`` would drop them).
    """
    if grain_seconds < 1 or 60 % grain_seconds:
        raise ValueError("grain_seconds must divide 60")
    ts = _c(c)
    sec = F.second(ts)
    if grain_seconds > 1:
        sec = sec - sec % F.lit(grain_seconds)
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), sec)


def make_timepoint(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column) -> Column:
    """Timepoint from calendar parts (the model's ``DATE(..) + TIME(..)``)."""
    return F.make_timestamp_ntz(year, month, day, hour, minute, second)


def timepoint_expression_text(c: str | Column = "TimePoint") -> Column:
    """Model-side text of a timepoint: ``DATE(y, m, d) + TIME(h, mi, s)``."""
    ts = _c(c)
    return F.format_string(
        "DATE(%d, %d, %d) + TIME(%d, %d, %d)",
        F.year(ts),
        F.month(ts),
        F.dayofmonth(ts),
        F.hour(ts),
        F.minute(ts),
        F.second(ts),
    )
