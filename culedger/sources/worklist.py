"""Date spines, timepoint work lists and timepoint parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culedger.functions.columns import make_timepoint, timepoint_expression_text
from culedger.operators.filters import drop_half_minute, filter_capacity, filter_window


def date_spine(df: DataFrame, start_col: str, end_col: str, out: str = "Date") -> DataFrame:
    """One row per day between two date columns (inclusive), per input row."""
    return df.withColumn(out, F.explode(F.sequence(F.col(start_col), F.col(end_col), F.expr("INTERVAL 1 DAY"))))


def capacity_date_spine(timepoints: DataFrame) -> DataFrame:
    """Every day from each capacity's first to last timepoint (the days a
    metrics collection for that capacity iterates)."""
    span = timepoints.groupBy("CapacityId").agg(
        F.to_date(F.min("TimePoint")).alias("first_day"), F.to_date(F.max("TimePoint")).alias("last_day")
    )
    return date_spine(span, "first_day", "last_day").select("CapacityId", "Date")


def worklist(
    timepoints: DataFrame,
    capacity_id: str | None,
    start: str | None,
    end: str | None,
    autoscale: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """(CapacityId, TimePoint) units to extract, newest first. Without a window
    (``start`` None) every timepoint is a unit; the capacity id may be given in
    either case.

    Autoscale runs on a one-minute grain, so its list drops ``:30`` points.
    ``ordered=False`` skips the global sort when the list feeds a distributed
    fan-out, where order does not matter.
    """
    wl = timepoints.select("CapacityId", "TimePoint")
    if start is not None:
        wl = filter_window(wl, start, end)
    wl = filter_capacity(wl, capacity_id and capacity_id.upper())
    if autoscale:
        wl = drop_half_minute(wl)
    if ordered:
        wl = wl.orderBy(F.col("CapacityId").asc_nulls_first(), F.col("TimePoint").desc_nulls_last())
    return wl


def timepoint_parts(wl: DataFrame) -> DataFrame:
    """Split each timepoint into calendar parts, rebuild it from them, and
    render the model-side ``DATE(..) + TIME(..)`` text."""
    ts = F.col("TimePoint")
    parts = wl.select(
        "CapacityId",
        "TimePoint",
        F.year(ts).alias("tp_year"),
        F.month(ts).alias("tp_month"),
        F.dayofmonth(ts).alias("tp_day"),
        F.hour(ts).alias("tp_hour"),
        F.minute(ts).alias("tp_minute"),
        F.second(ts).alias("tp_second"),
        F.upper("CapacityId").alias("CapacityIdUpper"),
        timepoint_expression_text(ts).alias("TimepointExpression"),
    )
    return parts.withColumn(
        "RebuiltTimePoint",
        make_timepoint(F.col("tp_year"), F.col("tp_month"), F.col("tp_day"), F.col("tp_hour"), F.col("tp_minute"), F.col("tp_second")),
    )
