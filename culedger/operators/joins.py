"""Joins: latest state per operation (both readings) and the star join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culedger.operators.filters import filter_operation_id, filter_source_type

UNIFIED_COLUMNS = [
    "SourceType",
    "CapacityId",
    "TimePoint",
    "Operation_Id",
    "Operation",
    "Workspace_name",
    "Item_name",
    "Item_kind",
    "User",
    "Unique_key",
    "PointInTimeCU_s",
    "CumulativeCU_s",
]


def latest_state(unified: DataFrame, gold_autoscale: DataFrame, operation_id: str | None = None) -> DataFrame:
    """Latest autoscale observation per item-operation, *as the reference
    writes it*: the MAX(TimePoint) subquery reads the whole autoscale table
    (not the filtered view), groups by Operation, Operation_Id, Unique_key,
    and the join omits CapacityId and Operation, so rows may repeat or vanish.
    NULL ids or keys never match (plain ``=``).

    Sorted by TimePoint desc, Item_name (for display; a sort is a shuffle).
    """
    b = gold_autoscale.groupBy("Operation", "Operation_Id", "Unique_key").agg(F.max("TimePoint").alias("MaxTimePoint"))
    a = filter_operation_id(filter_source_type(unified, "autoscale"), operation_id).alias("a")
    b = b.select(F.col("Operation_Id").alias("b_Operation_Id"), F.col("Unique_key").alias("b_Unique_key"), "MaxTimePoint")
    j = a.join(
        b,
        (F.col("a.Operation_Id") == F.col("b_Operation_Id"))
        & (F.col("a.TimePoint") == F.col("MaxTimePoint"))
        & (F.col("a.Unique_key") == F.col("b_Unique_key")),
        "inner",
    )
    return j.select(*[F.col(f"a.{c}") for c in UNIFIED_COLUMNS])


def latest_state_strict(unified: DataFrame, operation_id: str | None = None) -> DataFrame:
    """Latest autoscale observation per item-operation, *as documented*: one
    row per (CapacityId, Operation, Operation_Id, Unique_key) group at its
    latest timepoint, computed over the same filtered view, joined on every
    group key (null-safe)."""
    a = filter_operation_id(filter_source_type(unified, "autoscale"), operation_id)
    keys = ["CapacityId", "Operation", "Operation_Id", "Unique_key"]
    b = a.groupBy(*keys).agg(F.max("TimePoint").alias("MaxTimePoint"))
    b = b.select(*[F.col(k).alias(f"b_{k}") for k in keys], "MaxTimePoint")
    cond = F.col("TimePoint") == F.col("MaxTimePoint")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"b_{k}"))
    return a.join(b, cond, "inner").select(*UNIFIED_COLUMNS)


def star_facts(facts: DataFrame, calendar: DataFrame, capacities: DataFrame, measure: str = "SumTotal_CU_s") -> DataFrame:
    """capacities -> calendar on CapacityId; calendar -> facts on
    (CapacityId, TimePoint). Dimensions are joined by key; the planner
    broadcasts them only while their measured size is under the threshold."""
    cal = calendar.select("CapacityId", "TimePoint", "Date")
    cap = capacities.select("CapacityId", "CapacityName", "Region")
    f = facts.select("CapacityId", "TimePoint", "Operation", "Operation_Id", "Item_name", measure)
    return f.join(cal, ["CapacityId", "TimePoint"], "inner").join(cap, ["CapacityId"], "inner")


def pruned_star(facts: DataFrame, calendar: DataFrame, capacities: DataFrame, timepoints: DataFrame | None = None, measure: str = "SumTotal_CU_s") -> DataFrame:
    """:func:`star_facts` over a fact table that is partitioned by ``Date``, at
    the (CapacityId, TimePoint) pairs of ``timepoints`` if given.

    The calendar's Date joins the partition column as well, which a fact row
    that matches on TimePoint always equals. Where ``timepoints`` is a filtered
    dimension, Spark then reads only the dates that its rows lie on (dynamic
    partition pruning)."""
    cal = calendar.select("CapacityId", "TimePoint", "Date")
    if timepoints is not None:
        keys = ["CapacityId", "TimePoint"]
        cal = cal.join(timepoints.select(*keys), keys, "left_semi")
    cap = capacities.select("CapacityId", "CapacityName", "Region")
    f = facts.select("CapacityId", "TimePoint", "Date", "Operation", "Operation_Id", "Item_name", measure)
    out = f.join(cal, ["CapacityId", "TimePoint", "Date"], "inner").join(cap, ["CapacityId"], "inner")
    return out.select("CapacityId", "TimePoint", "Operation", "Operation_Id", "Item_name", measure, "Date", "CapacityName", "Region")
