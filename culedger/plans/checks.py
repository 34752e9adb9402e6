"""Run-time guards. Each returns a one-row DataFrame or raises; emptiness is
tested with ``limit(1)`` so a guard never scans more than it must."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culedger.operators.filters import filter_capacity, filter_window


class PrerequisiteError(RuntimeError):
    pass


def rows_in_range(df: DataFrame, capacity_id: str | None, start: str, end: str, col: str = "TimePoint") -> DataFrame:
    """COUNT(*) of rows for the capacity inside the inclusive window."""
    return filter_capacity(filter_window(df, start, end, col), capacity_id and capacity_id.upper()).agg(F.count(F.lit(1)).alias("n"))


def require_rows_in_range(df: DataFrame, capacity_id: str | None, start: str, end: str) -> None:
    """Fail fast when the calendar has no timepoint for the request."""
    try:
        empty = filter_capacity(filter_window(df, start, end), capacity_id and capacity_id.upper()).limit(1).count() == 0
    except Exception as ex:  # unreadable table
        raise PrerequisiteError(f"cannot read timepoints: {ex}") from ex
    if empty:
        raise PrerequisiteError(f"no timepoints for capacity {capacity_id} between {start} and {end}")


def table_ready(spark: SparkSession, name: str, required: bool = True) -> bool:
    """Exists and non-empty. Missing + required raises; missing + optional is
    False; an existing empty table is False (its gold step is skipped)."""
    if not spark.catalog.tableExists(name):
        if required:
            raise PrerequisiteError(f"{name} missing; run its collector first")
        return False
    return not spark.table(name).isEmpty()


def require_tables(spark: SparkSession, names: Iterable[str]) -> None:
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise PrerequisiteError(f"missing required tables: {missing}")
