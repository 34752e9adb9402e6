"""The six analysis patterns over gold tables.

Each pattern is a function returning a DataFrame; the reference's temp views
are available through :func:`register_views` for SQL users. Scope filters
(capacity, inclusive time window) are plain predicates, so they reach the
parquet scan of a gold table (``PushedFilters``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culedger.plans.checks import require_tables
from culedger.operators import aggregates as agg
from culedger.operators.filters import filter_operation_id, scope
from culedger.operators.joins import latest_state as _latest_state
from culedger.operators.joins import latest_state_strict as _latest_state_strict
from culedger.operators.union import unified_operations

VIEW_NAMES = {
    "metrics": "vw_capacity_metrics_filtered",
    "standard": "vw_standard_item_consumption",
    "unified": "vw_item_consumption_by_operation_id",
}

TREND_COLUMNS = [
    "CapacityId",
    "TimePoint",
    "TotalCUs",
    "TotalCUUsagePercentage",
    "BackgroundPercentage",
    "InteractivePercentage",
    "AutoscalePercentage",
    "CarryOverCumulativePercentage",
]


@dataclass
class Views:
    metrics: DataFrame | None
    standard: DataFrame | None
    autoscale: DataFrame | None
    unified: DataFrame | None
    autoscale_table: DataFrame | None


def views(
    standard: DataFrame | None,
    autoscale: DataFrame | None = None,
    metrics: DataFrame | None = None,
    capacity_id: str | None = None,
    start: str | None = None,
    end: str | None = None,
    include_autoscale: bool = True,
) -> Views:
    """Scope the gold tables once; every pattern reads these. Tables a
    caller does not need may be ``None`` (the unified view needs the
    standard table). Ids are upper case in every table, so the argument may be
    given in either case."""
    capacity_id = capacity_id and capacity_id.upper()
    std = scope(standard, capacity_id, start, end) if standard is not None else None
    auto = scope(autoscale, capacity_id, start, end) if (include_autoscale and autoscale is not None) else None
    met = scope(metrics, capacity_id, start, end) if metrics is not None else None
    uni = unified_operations(std, auto) if std is not None else None
    return Views(met, std, auto, uni, autoscale if include_autoscale else None)


def lakehouse_views(lh, capacity_id: str | None = None, start: str | None = None, end: str | None = None, include_autoscale: bool = True) -> Views:
    """The views over a lakehouse's gold tables; raises with the list of
    missing tables. The autoscale table is optional."""
    from culedger.plans import tables as T

    require_tables(lh.spark, [lh.name(t) for t in (T.GOLD_METRICS_BY_TIMEPOINT, T.GOLD_TP_METRICS)])
    auto = lh.read(T.GOLD_TP_METRICS_AS) if include_autoscale and lh.exists(T.GOLD_TP_METRICS_AS) else None
    return views(lh.read(T.GOLD_TP_METRICS), auto, lh.read(T.GOLD_METRICS_BY_TIMEPOINT), capacity_id, start, end, include_autoscale)


def register_views(v: Views) -> None:
    for key, df in (("metrics", v.metrics), ("standard", v.standard), ("unified", v.unified)):
        if df is not None:
            df.createOrReplaceTempView(VIEW_NAMES[key])


def capacity_trend(v: Views) -> DataFrame:
    """Pattern 1: utilisation per timepoint, ascending."""
    if v.metrics is None:
        raise ValueError("capacity_trend needs the capacity metrics table")
    return v.metrics.select(*TREND_COLUMNS).orderBy(F.col("TimePoint").asc_nulls_first(), F.col("CapacityId").asc_nulls_first())


def top_items(v: Views, n: int = agg.DEFAULT_TOP_N) -> DataFrame:
    """Pattern 2."""
    return agg.top_items(v.standard, n)


def top_workspaces(v: Views, n: int = agg.DEFAULT_TOP_N) -> DataFrame:
    """Pattern 3."""
    return agg.top_workspaces(v.standard, n)


def top_operations(v: Views, n: int = agg.DEFAULT_TOP_N) -> DataFrame:
    """Pattern 4."""
    return agg.top_operations(v.standard, n)


def _empty_like(df: DataFrame) -> DataFrame:
    return df.limit(0)


def autoscale_latest(v: Views, operation_id: str | None = None, strict: bool = False) -> DataFrame:
    """Pattern 5: latest cumulative state per item-operation.

    ``strict=False`` is the reference's query as written; ``strict=True`` the
    documented intent. Without the autoscale table the result is empty with
    the unified schema.
    """
    if v.autoscale_table is None:
        return _empty_like(v.unified)
    if strict:
        out = _latest_state_strict(v.unified, operation_id)
    else:
        out = _latest_state(v.unified, v.autoscale_table, operation_id)
    return out.orderBy(F.col("TimePoint").desc_nulls_last(), F.col("Item_name").asc_nulls_first())


def inspect_operation(v: Views, operation_id: str | None = None) -> DataFrame:
    """Pattern 6: the unified view, optionally for one operation id."""
    return filter_operation_id(v.unified, operation_id).orderBy(
        F.col("TimePoint").desc_nulls_last(), F.col("SourceType").asc_nulls_first(), F.col("Item_name").asc_nulls_first()
    )
