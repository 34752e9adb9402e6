"""Extracts as the capacity model heads them, written out by hand: the ingest
queries read these, not an inverse of the lists that the ingest itself uses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Measure names of the metric extract, in contract order, for
# model versions v40 to v53 and for v37.
MEASURES_V53 = (
    "Background billable CU %", "Interactive billable CU %", "Background non billable CU %", "Interactive non billable CU %",
    "SKU CU by timepoint %", "CU limit", "Cumulative CU usage % preview", "Cumulative CU usage (s)", "SKU CU by timepoint",
    "Dynamic interactive delay %", "Dynamic interactive rejection %", "Interactive rejection threshold",
    "Dynamic background rejection %", "Background rejection threshold", "Carry over add %", "Carry over burndown %",
    "Cumulative carry over %", "Overage reference line", "Expected burndown in minutes",
)
MEASURES_V37 = (
    "xBackground %", "xInteractive %", "xBackground % Preview", "xInteractive % Preview", "SKU CU by TimePoint %", "CU Limit",
    "Cumulative CU Usage % Preview", "Cumulative CU Usage (s)", "SKU CU by TimePoint", "Dynamic InteractiveDelay %",
    "Dynamic InteractiveRejection %", "Interactive rejection threshold", "Dynamic BackgroundRejection %",
    "Background rejection threshold", "xCarryOver_added %", "xCarryOver_burndown %", "xCarryOver_Cumulative %",
    "Overage reference line", "Expected burndown in minutes",
)
ID_HEADER = {"v53": "Capacities[capacity Id]", "v37": "Capacities[capacityId]"}
# Positions of the two detail extracts.
STANDARD = (
    "Operation_start_time", "Operation_end_time", "Status", "Operation", "User", "Workspace_name", "Item_kind", "Unique_key",
    "Billing_type", "Operation_Id", "Virtualised_workspace", "Start", "End", "Item_name", "IsGrandTotalRowTotal",
    "SumDuration_s", "SumTotal_CU_s",
)
AUTOSCALE = (
    "Operation", "Operation_start_time", "Operation_end_time", "Status", "User", "Workspace_name", "Item_kind", "Unique_key",
    "Operation_Id", "Billing_type", "Item_name", "IsGrandTotalRowTotal", "SumCU_s", "Timepoint_workload_autoscale_limit",
)


def metrics(timepoints: DataFrame, version: str) -> DataFrame:
    """A metric extract with another value in each column (the total plus the
    column's place from 1) and its columns back to front."""
    names = MEASURES_V37 if version == "v37" else MEASURES_V53
    cols = [F.col("CapacityId").alias(ID_HEADER[version]), F.col("TimePoint").alias("TimePoints[TimePoint]")]
    cols += [(F.col("TotalCUs") + k).alias(n) for k, n in enumerate(names, 1)]
    return timepoints.select(*cols[::-1])


def capacities(caps: DataFrame, version: str) -> DataFrame:
    """A capacity list as a version's query returns it."""
    region, state = F.col("Region").alias("Region"), F.col("State").alias("state")
    if version == "v53":
        return caps.select(region, state, F.col("CapacityName").alias("Capacity Name"), F.col("CapacityId").alias("Capacity Id"))
    return caps.select(region, state, F.col("CapacityId").alias("capacity Id"))


def detail(silver: DataFrame, positions: tuple) -> DataFrame:
    """A detail extract: positional columns, the unit, and the load time."""
    cols = [F.col(c).alias(f"c{i:02d}") for i, c in enumerate(positions)]
    return silver.select(*cols, F.lower("CapacityId").alias("unit_capacity_id"), F.col("TimePoint").alias("unit_timepoint"), F.col("insert_date").alias("load_time"))
