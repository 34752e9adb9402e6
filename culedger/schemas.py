"""Explicit schemas, merge keys and the model-version name maps."""

from __future__ import annotations

from pyspark.sql import types as T

# Merge keys ----------------------------------------------------------------

#: Key of both detail tables. CapacityId and TimePoint compare with ``=``,
#: the other five compare null-safe (``<=>``).
K7 = [
    "CapacityId",
    "TimePoint",
    "Unique_key",
    "Operation",
    "Operation_Id",
    "Operation_start_time",
    "Operation_end_time",
]
K7_EQ = K7[:2]
K7_NULL_SAFE = K7[2:]

#: Key of the capacity-metric and calendar tables.
TIMEPOINT_KEY = ["CapacityId", "TimePoint"]
#: Key of the capacity dimension.
CAPACITY_KEY = ["CapacityId"]

#: Running-total partition of the autoscale gold table (code, not docs).
RUNNING_GROUP = ["CapacityId", "Unique_key", "Operation_Id"]
#: Tie-break after TimePoint so the running total is a total order inside a
#: group (K7 is unique after dedupe, so these complete the order).
RUNNING_TIEBREAK = ["Operation", "Operation_start_time", "Operation_end_time"]

TS = T.TimestampNTZType()
STR = T.StringType()
DBL = T.DoubleType()
BOOL = T.BooleanType()


def _struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The 21-column capacity-metric contract, in contract order.
METRIC_MEASURES = [
    "BackgroundPercentage",
    "InteractivePercentage",
    "BackgroundNonBillablePercentage",
    "InteractiveNonBillablePercentage",
    "AutoscalePercentage",
    "CULimitPercentage",
    "TotalCUUsagePercentage",
    "TotalCUs",
    "SKUCUByTimePoint",
    "InteractiveDelayPercentage",
    "InteractiveRejectionPercentage",
    "InteractiveRejectionThreshold",
    "BackgroundRejectionPercentage",
    "BackgroundRejectionThreshold",
    "CarryOverAddedPercentage",
    "CarryOverBurndownPercentage",
    "CarryOverCumulativePercentage",
    "OverageReferenceLine",
    "ExpectedBurndownInMin",
]
METRIC_COLUMNS = ["CapacityId", "TimePoint"] + METRIC_MEASURES

CAPACITIES = _struct([("CapacityId", STR), ("CapacityName", STR), ("State", STR), ("Region", STR)])

CAPACITY_METRICS = _struct([("CapacityId", STR), ("TimePoint", TS)] + [(m, DBL) for m in METRIC_MEASURES])

CALENDAR = _struct([("CapacityId", STR), ("TimePoint", TS), ("Date", T.DateType())])

# Positional column names of the standard detail extract.
DETAIL_EXTRACT_COLUMNS = [
    "Operation_start_time",
    "Operation_end_time",
    "Status",
    "Operation",
    "User",
    "Workspace_name",
    "Item_kind",
    "Unique_key",
    "Billing_type",
    "Operation_Id",
    "Virtualised_workspace",
    "Start",
    "End",
    "Item_name",
    "IsGrandTotalRowTotal",
    "SumDuration_s",
    "SumTotal_CU_s",
]
_DETAIL_TYPES = {
    "Operation_start_time": TS,
    "Operation_end_time": TS,
    "Start": TS,
    "End": TS,
    "IsGrandTotalRowTotal": BOOL,
    "SumDuration_s": DBL,
    "SumTotal_CU_s": DBL,
}
TIMEPOINT_METRICS = _struct(
    [(c, _DETAIL_TYPES.get(c, STR)) for c in DETAIL_EXTRACT_COLUMNS]
    + [("TimePoint", TS), ("CapacityId", STR), ("insert_date", TS)]
)

# Positional column names of the autoscale detail extract.
AUTOSCALE_EXTRACT_COLUMNS = [
    "Operation",
    "Operation_start_time",
    "Operation_end_time",
    "Status",
    "User",
    "Workspace_name",
    "Item_kind",
    "Unique_key",
    "Operation_Id",
    "Billing_type",
    "Item_name",
    "IsGrandTotalRowTotal",
    "SumCU_s",
    "Timepoint_workload_autoscale_limit",
]
_AUTOSCALE_TYPES = {
    "Operation_start_time": TS,
    "Operation_end_time": TS,
    "IsGrandTotalRowTotal": BOOL,
    "SumCU_s": DBL,
    "Timepoint_workload_autoscale_limit": DBL,
}
TIMEPOINT_METRICS_AUTOSCALE = _struct(
    [(c, _AUTOSCALE_TYPES.get(c, STR)) for c in AUTOSCALE_EXTRACT_COLUMNS]
    + [("TimePoint", TS), ("CapacityId", STR), ("insert_date", TS)]
)
GOLD_AUTOSCALE = T.StructType(TIMEPOINT_METRICS_AUTOSCALE.fields + [T.StructField("Acc_CU_s", DBL, True)])

#: Grouping columns of the standard detail summary (all extract columns but
#: the flag and the two measures).
DETAIL_GROUP_COLUMNS = DETAIL_EXTRACT_COLUMNS[:14]
#: Grouping columns of the autoscale detail summary.
AUTOSCALE_GROUP_COLUMNS = AUTOSCALE_EXTRACT_COLUMNS[:11]

# Model-version adapter -------------------------------------------------------

# Query aliases of the 19 measures (same in every model version).
METRIC_QUERY_ALIASES = [
    "B_P",
    "I_P",
    "B_NB_P",
    "I_NB_P",
    "AS_P",
    "CU_L",
    "T_CU_U_P",
    "C_CU_U_S",
    "SKU_CU_TP",
    "I_Del_P",
    "I_Rej_P",
    "I_Rej_TH",
    "B_Rej_P",
    "B_Rej_TH",
    "CO_A_P",
    "CO_BD_P",
    "CO_C_P",
    "OV_RL",
    "Exp_BD_M",
]

# Measure names of model versions v40, v44, v47 and v53.
MEASURES_V40_TO_V53 = [
    "Background billable CU %",
    "Interactive billable CU %",
    "Background non billable CU %",
    "Interactive non billable CU %",
    "SKU CU by timepoint %",
    "CU limit",
    "Cumulative CU usage % preview",
    "Cumulative CU usage (s)",
    "SKU CU by timepoint",
    "Dynamic interactive delay %",
    "Dynamic interactive rejection %",
    "Interactive rejection threshold",
    "Dynamic background rejection %",
    "Background rejection threshold",
    "Carry over add %",
    "Carry over burndown %",
    "Cumulative carry over %",
    "Overage reference line",
    "Expected burndown in minutes",
]

# Measure names of model version v37.
MEASURES_V37 = [
    "xBackground %",
    "xInteractive %",
    "xBackground % Preview",
    "xInteractive % Preview",
    "SKU CU by TimePoint %",
    "CU Limit",
    "Cumulative CU Usage % Preview",
    "Cumulative CU Usage (s)",
    "SKU CU by TimePoint",
    "Dynamic InteractiveDelay %",
    "Dynamic InteractiveRejection %",
    "Interactive rejection threshold",
    "Dynamic BackgroundRejection %",
    "Background rejection threshold",
    "xCarryOver_added %",
    "xCarryOver_burndown %",
    "xCarryOver_Cumulative %",
    "Overage reference line",
    "Expected burndown in minutes",
]

# Key-column headers per model version.
CAPACITY_ID_HEADER = {"v53": "capacity Id", "v47": "capacity Id", "v44": "capacity Id", "v40": "capacity Id", "v37": "capacityId"}
TIMEPOINT_HEADER = "TimePoint"

MODEL_VERSIONS = ["v53", "v47", "v44", "v40", "v37"]


def metric_header_map(version: str) -> dict[str, str]:
    """Map every accepted extract header of ``version`` to its canonical name.

    Accepted headers are the query aliases (``B_P`` ...), the version's
    measure names, and the same names wrapped as ``'All Measures'[name]`` /
    ``Table[name]`` the way a tabular-model client labels result columns.
    """
    if version not in MODEL_VERSIONS:
        raise ValueError(f"unknown model version {version!r}; expected one of {MODEL_VERSIONS}")
    measures = MEASURES_V37 if version == "v37" else MEASURES_V40_TO_V53
    out: dict[str, str] = {}
    id_name = CAPACITY_ID_HEADER[version]
    for h in (id_name, f"Capacities[{id_name}]", "CapacityId"):
        out[h] = "CapacityId"
    for h in (TIMEPOINT_HEADER, f"TimePoints[{TIMEPOINT_HEADER}]", f"'TimePoints'[{TIMEPOINT_HEADER}]"):
        out[h] = "TimePoint"
    for alias, name, canon in zip(METRIC_QUERY_ALIASES, measures, METRIC_MEASURES):
        for h in (alias, f"[{alias}]", name, f"[{name}]", f"'All Measures'[{name}]", canon):
            out[h] = canon
    return out


# Capacity-list headers per model version (v53 has a name column).
CAPACITY_HEADERS = {
    "v53": ["Capacity Id", "Capacity Name", "state", "Region"],
    "v47": ["capacity Id", "state", "Region"],
    "v44": ["capacity Id", "state", "Region"],
    "v40": ["capacity Id", "state", "Region"],
    "v37": ["capacity Id", "state", "Region"],
}
