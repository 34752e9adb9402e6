"""Filters and predicates. Literals are bound through the Column API (never
interpolated into SQL text), and every predicate is a plain column expression
so Catalyst can push it to the parquet scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culedger.functions.columns import check_window, half_minute_by_format, half_minute_by_text, parse_window_bound


def filter_capacity(df: DataFrame, capacity_id: str | None, col: str = "CapacityId") -> DataFrame:
    """Exact ``CapacityId = id``; ``None`` means every capacity."""
    if capacity_id is None:
        return df
    return df.filter(F.col(col) == F.lit(capacity_id))


def filter_capacity_ci(df: DataFrame, capacity_id: str | None, col: str = "CapacityId") -> DataFrame:
    """Case-insensitive id match; a falsy id means no filter."""
    if not capacity_id:
        return df
    return df.filter(F.upper(F.col(col)) == F.lit(capacity_id.upper()))


def filter_window(df: DataFrame, start: str | None, end: str | None, col: str = "TimePoint") -> DataFrame:
    """Inclusive ``col BETWEEN start AND end``; bounds are ``dd MMMM yyyy HH:mm``.

    ``None`` for both bounds means the whole table.
    """
    if start is None and end is None:
        return df
    if start is None or end is None:
        raise ValueError("give both window bounds or neither")
    check_window(start, end)
    return df.filter(F.col(col).between(parse_window_bound(start), parse_window_bound(end)))


def scope(df: DataFrame, capacity_id: str | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Capacity and window filter together (the analysis views)."""
    return filter_window(filter_capacity(df, capacity_id), start, end)


def drop_half_minute(df: DataFrame, col: str = "TimePoint") -> DataFrame:
    """Keep rows whose timepoint text does not end in ``:30`` (NULL dropped, as
    in a SQL WHERE)."""
    return df.filter(~half_minute_by_text(col))


def delete_where(df: DataFrame, predicate) -> DataFrame:
    """``DELETE WHERE predicate`` as a rewrite: rows where the predicate is
    NULL are kept, as SQL DELETE keeps them."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def delete_half_minute_text(df: DataFrame, col: str = "TimePoint") -> DataFrame:
    """Gold rule: delete ``TimePoint LIKE '%:30'``."""
    return delete_where(df, half_minute_by_text(col))


def delete_half_minute_format(df: DataFrame, col: str = "TimePoint") -> DataFrame:
    """Silver rule: delete ``date_format(TimePoint, 'ss') = '30'``."""
    return delete_where(df, half_minute_by_format(col))


def exclude_null_key(df: DataFrame, col: str = "Unique_key") -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def filter_operation_id(df: DataFrame, operation_id: str | None, col: str = "Operation_Id") -> DataFrame:
    """Optional id filter: blank or ``None`` means no filter."""
    if operation_id is None or not str(operation_id).strip():
        return df
    return df.filter(F.col(col) == F.lit(str(operation_id).strip()))


def filter_source_type(df: DataFrame, source_type: str) -> DataFrame:
    return df.filter(F.col("SourceType") == F.lit(source_type))


def semi_filter(df: DataFrame, members: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Membership filter (``TREATAS``): keep rows whose keys appear in
    ``members``. A left-semi join, so a large member set shuffles instead of
    being pulled to the driver; a small one is broadcast by the planner."""
    keys = list(keys)
    return df.join(members.select(*keys).distinct(), keys, "left_semi")
