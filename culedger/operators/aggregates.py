"""Aggregations. All use built-in aggregate functions, so Spark runs a partial
(map-side) aggregate before every shuffle; a hot key costs one row per map
task on the wire, not one row per input row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culedger.functions.columns import cu_sum, half_minute_by_format, half_minute_by_text

DEFAULT_TOP_N = 20


def top_k(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """``ORDER BY ... LIMIT n`` -- planned as TakeOrderedAndProject (a bounded
    heap per partition, then a merge of ``n`` rows per partition)."""
    if n is None or n < 0:
        raise ValueError("n must be a non-negative int")
    return df.orderBy(*order).limit(int(n))


def top_items(detail: DataFrame, n: int = DEFAULT_TOP_N, cu_col: str = "SumTotal_CU_s") -> DataFrame:
    """SUM(CU), COUNT(*) by workspace, item, kind; top ``n`` by CU.

    Group keys break CU ties so the cut at ``n`` is deterministic.
    """
    keys = ["Workspace_name", "Item_name", "Item_kind"]
    agg = detail.groupBy(*keys).agg(cu_sum(cu_col).alias("TotalCU_s"), F.count(F.lit(1)).alias("Samples"))
    return top_k(agg, [F.col("TotalCU_s").desc_nulls_last()] + [F.col(k).asc_nulls_first() for k in keys], n)


def top_workspaces(detail: DataFrame, n: int = DEFAULT_TOP_N, cu_col: str = "SumTotal_CU_s") -> DataFrame:
    agg = detail.groupBy("Workspace_name").agg(
        cu_sum(cu_col).alias("TotalCU_s"),
        F.countDistinct("Item_name").alias("DistinctItems"),
        F.countDistinct("Operation_Id").alias("DistinctOperations"),
    )
    return top_k(agg, [F.col("TotalCU_s").desc_nulls_last(), F.col("Workspace_name").asc_nulls_first()], n)


def top_operations(detail: DataFrame, n: int = DEFAULT_TOP_N, cu_col: str = "SumTotal_CU_s") -> DataFrame:
    agg = detail.groupBy("Operation").agg(
        cu_sum(cu_col).alias("TotalCU_s"),
        F.countDistinct("Operation_Id").alias("DistinctOperationIds"),
        F.countDistinct("Item_name").alias("DistinctItems"),
    )
    return top_k(agg, [F.col("TotalCU_s").desc_nulls_last(), F.col("Operation").asc_nulls_first()], n)


def calendar(timepoints: DataFrame) -> DataFrame:
    """Distinct (CapacityId, TimePoint) with its calendar Date."""
    return timepoints.select("CapacityId", "TimePoint", F.to_date("TimePoint").alias("Date")).distinct()


def latest_cumulative(gold_autoscale: DataFrame) -> DataFrame:
    """Cumulative CU at the latest timepoint: MAX(Acc_CU_s) per capacity and
    operation id."""
    return gold_autoscale.groupBy("CapacityId", "Operation_Id").agg(F.max("Acc_CU_s").alias("MaxAcc_CU_s"))


def _summary(raw: DataFrame, unit: Sequence[str], group_cols: Sequence[str], measures: list[Column], flag: str) -> DataFrame:
    """GROUP BY GROUPING SETS ((unit, cols), (unit)): the detail rows plus one
    grand-total row per unit, all grouping columns NULL and ``flag`` true.

    One Expand + one aggregate: the input is read once.
    """
    sets = [[F.col(c) for c in list(unit) + list(group_cols)], [F.col(c) for c in unit]]
    agg = raw.groupingSets(sets, *[F.col(c) for c in list(unit) + list(group_cols)]).agg(
        F.grouping(group_cols[0]).alias("_g"), *measures
    )
    return agg.withColumn(flag, F.col("_g") == 1).drop("_g")


def detail_summary(raw: DataFrame, unit: Sequence[str] = ("CapacityId", "TimePoint")) -> DataFrame:
    """Standard detail as the capacity model returns it: SUM(duration),
    SUM(CU) per 14 columns, plus the total row (IsGrandTotalRowTotal)."""
    from culedger.schemas import DETAIL_GROUP_COLUMNS

    measures = [cu_sum("SumDuration_s").alias("SumDuration_s"), cu_sum("SumTotal_CU_s").alias("SumTotal_CU_s")]
    out = _summary(raw, unit, DETAIL_GROUP_COLUMNS, measures, "IsGrandTotalRowTotal")
    return out.select(*DETAIL_GROUP_COLUMNS, "IsGrandTotalRowTotal", "SumDuration_s", "SumTotal_CU_s", *unit)


def autoscale_summary(raw: DataFrame, unit: Sequence[str] = ("CapacityId", "TimePoint")) -> DataFrame:
    """Autoscale detail: SUM(CU) per 11 columns + the per-timepoint limit
    measure (constant inside a unit, carried with MAX) + the total row."""
    from culedger.schemas import AUTOSCALE_GROUP_COLUMNS

    measures = [cu_sum("SumCU_s").alias("SumCU_s"), F.max("Timepoint_workload_autoscale_limit").alias("Timepoint_workload_autoscale_limit")]
    out = _summary(raw, unit, AUTOSCALE_GROUP_COLUMNS, measures, "IsGrandTotalRowTotal")
    return out.select(*AUTOSCALE_GROUP_COLUMNS, "IsGrandTotalRowTotal", "SumCU_s", "Timepoint_workload_autoscale_limit", *unit)


def silver_stats(detail: DataFrame) -> DataFrame:
    """Table audit in one pass: rows, NULL-key rows, half-minute rows (text
    and format rules), distinct capacities."""
    return detail.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("Unique_key").isNull()).alias("null_key_rows"),
        F.count_if(F.coalesce(half_minute_by_text("TimePoint"), F.lit(False))).alias("half_minute_text_rows"),
        F.count_if(F.coalesce(half_minute_by_format("TimePoint"), F.lit(False))).alias("half_minute_format_rows"),
        F.countDistinct("CapacityId").alias("capacities"),
    )


def null_key_counts(key: str = "Unique_key") -> list[Column]:
    """Rows a gold build excludes for a NULL key, next to the rows flagged as
    grand totals (the two are reported apart: a key-less genuine row is
    dropped too)."""
    null, total = F.col(key).isNull(), F.coalesce(F.col("IsGrandTotalRowTotal"), F.lit(False))
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(null).alias("null_key_rows"),
        F.count_if(null & total).alias("null_key_total_rows"),
        F.count_if(null & ~total).alias("null_key_detail_rows"),
    ]


def null_key_audit(df: DataFrame, key: str = "Unique_key") -> DataFrame:
    """:func:`null_key_counts` of a table, in one row."""
    return df.agg(*null_key_counts(key))
