"""The unified operation view: standard and autoscale detail in one shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SHARED = ["CapacityId", "TimePoint", "Operation_Id", "Operation", "Workspace_name", "Item_name", "Item_kind", "User", "Unique_key"]


def standard_view(standard: DataFrame) -> DataFrame:
    return standard.select(
        F.lit("standard").alias("SourceType"),
        *_SHARED,
        F.col("SumTotal_CU_s").alias("PointInTimeCU_s"),
        F.lit(None).cast("double").alias("CumulativeCU_s"),
    )


def autoscale_view(autoscale: DataFrame) -> DataFrame:
    return autoscale.select(
        F.lit("autoscale").alias("SourceType"),
        *_SHARED,
        F.col("SumCU_s").alias("PointInTimeCU_s"),
        F.col("Acc_CU_s").alias("CumulativeCU_s"),
    )


def unified_operations(standard: DataFrame, autoscale: DataFrame | None) -> DataFrame:
    """UNION ALL by name; autoscale is optional."""
    out = standard_view(standard)
    if autoscale is not None:
        out = out.unionByName(autoscale_view(autoscale))
    return out
