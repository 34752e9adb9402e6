"""DuckDB SQL for every registered query -- an independent engine computing
the same result from the same driver tables (the correctness gate).

Every query starts from the same CTE prefix, which re-derives the silver
inputs in SQL. Rules that make the two engines agree bit for bit: CU sums in
DECIMAL(28,6) then DOUBLE; NULL ordering spelled out; group keys as top-k
tie-breaks; load time as data, never the clock.
"""

from __future__ import annotations

from culedger.plans import scenario as S
# Fixed values, written out again so that an error in the library's own lists
# shows: merge key, measures in contract order, and the extracts' columns.
K7 = [
    "CapacityId", "TimePoint", "Unique_key", "Operation", "Operation_Id", "Operation_start_time", "Operation_end_time",
]
K7_EQ, K7_NULL_SAFE = K7[:2], K7[2:]
METRIC_MEASURES = [
    "BackgroundPercentage", "InteractivePercentage", "BackgroundNonBillablePercentage", "InteractiveNonBillablePercentage",
    "AutoscalePercentage", "CULimitPercentage", "TotalCUUsagePercentage", "TotalCUs", "SKUCUByTimePoint",
    "InteractiveDelayPercentage", "InteractiveRejectionPercentage", "InteractiveRejectionThreshold",
    "BackgroundRejectionPercentage", "BackgroundRejectionThreshold", "CarryOverAddedPercentage", "CarryOverBurndownPercentage",
    "CarryOverCumulativePercentage", "OverageReferenceLine", "ExpectedBurndownInMin",
]
DETAIL_EXTRACT_COLUMNS = [
    "Operation_start_time", "Operation_end_time", "Status", "Operation", "User", "Workspace_name", "Item_kind", "Unique_key",
    "Billing_type", "Operation_Id", "Virtualised_workspace", "Start", "End", "Item_name", "IsGrandTotalRowTotal", "SumDuration_s",
    "SumTotal_CU_s",
]
AUTOSCALE_EXTRACT_COLUMNS = [
    "Operation", "Operation_start_time", "Operation_end_time", "Status", "User", "Workspace_name", "Item_kind", "Unique_key",
    "Operation_Id", "Billing_type", "Item_name", "IsGrandTotalRowTotal", "SumCU_s", "Timepoint_workload_autoscale_limit",
]
DETAIL_GROUP_COLUMNS, AUTOSCALE_GROUP_COLUMNS = DETAIL_EXTRACT_COLUMNS[:14], AUTOSCALE_EXTRACT_COLUMNS[:11]

DEC = "DECIMAL(28,6)"


def q(name: str) -> str:
    """Quote an identifier."""
    return '"' + name + '"'


def cols(names, prefix: str = "") -> str:
    return ", ".join(prefix + q(n) for n in names)


def cu_sum(expr: str) -> str:
    return f"CAST(SUM(CAST({expr} AS {DEC})) AS DOUBLE)"


def bound(text: str) -> str:
    return f"strptime('{text}', '%d %B %Y %H:%M')"


def ts(text: str) -> str:
    return f"TIMESTAMP '{text}'"


HALF_TEXT = "(CAST(TimePoint AS VARCHAR) LIKE '%:30')"
HALF_FORMAT = "(strftime(TimePoint, '%S') = '30')"
SYNTH = (
    "concat('synthetic-', sha256(concat_ws('||', coalesce(CAST(Operation_start_time AS VARCHAR), 'NULL_START'), "
    "coalesce(CAST(Operation_end_time AS VARCHAR), 'NULL_END'))))"
)

SILVER_DETAIL_COLS = DETAIL_EXTRACT_COLUMNS + ["TimePoint", "CapacityId", "insert_date"]
SILVER_AUTOSCALE_COLS = AUTOSCALE_EXTRACT_COLUMNS + ["TimePoint", "CapacityId", "insert_date"]

_SEC = "date_trunc('second', e.ts)"
_OPS = f"""
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
ops AS (
  SELECT e.event_id,
    CASE WHEN e.event_id % 11 = 0 THEN NULL ELSE {_SEC} END AS Operation_start_time,
    CASE WHEN e.event_id % 13 = 0 THEN NULL ELSE {_SEC} + to_seconds(e.event_id % 90) END AS Operation_end_time,
    CASE WHEN e.event_type = 'error' THEN 'Failure' ELSE 'Success' END AS Status,
    e.event_type AS Operation,
    c.c_name AS "User",
    c.c_mktsegment AS Workspace_name,
    p.p_type AS Item_kind,
    CASE WHEN e.event_id % 50 = 0 THEN NULL ELSE concat('key-', CAST(e.k % 10 AS VARCHAR)) END AS Unique_key,
    'Billable' AS Billing_type,
    CASE WHEN e.event_id % 7 = 0 THEN NULL ELSE concat('op-', CAST(e.user_id % 50 AS VARCHAR)) END AS Operation_Id,
    'No' AS Virtualised_workspace,
    CASE WHEN e.event_id % 11 = 0 THEN NULL ELSE {_SEC} END AS "Start",
    CASE WHEN e.event_id % 13 = 0 THEN NULL ELSE {_SEC} + to_seconds(e.event_id % 90) END AS "End",
    p.p_name AS Item_name,
    false AS IsGrandTotalRowTotal,
    CAST(e.event_id % 90 AS DOUBLE) AS SumDuration_s,
    e.value AS CU,
    time_bucket(INTERVAL 30 SECOND, e.ts) AS TimePoint,
    concat('CAP-', lpad(CAST(e.user_id % 4 AS VARCHAR), 2, '0')) AS CapacityId,
    e.ts AS insert_date,
    e.event_type
  FROM ev e
  JOIN customer c ON c.c_custkey = e.user_id
  JOIN part p ON p.p_partkey = e.k
),
ops_r AS (
  SELECT * REPLACE (CU * (cp + 1) AS CU, insert_date + to_days(cp) AS insert_date)
  FROM ops, (VALUES (0), (1)) v(cp)
  WHERE cp = 0 OR event_id % 5 = 0
),
silver_detail AS (SELECT {cols(DETAIL_EXTRACT_COLUMNS[:-1])}, CU AS SumTotal_CU_s, TimePoint, CapacityId, insert_date FROM ops_r),
silver_detail_nr AS (SELECT {cols(DETAIL_EXTRACT_COLUMNS[:-1])}, CU AS SumTotal_CU_s, TimePoint, CapacityId, insert_date FROM ops),
silver_autoscale AS (SELECT {cols(AUTOSCALE_EXTRACT_COLUMNS[:-2])}, CU AS SumCU_s, CAST(64.0 AS DOUBLE) AS Timepoint_workload_autoscale_limit, TimePoint, CapacityId, insert_date FROM ops_r),
silver_autoscale_nr AS (SELECT {cols(AUTOSCALE_EXTRACT_COLUMNS[:-2])}, CU AS SumCU_s, CAST(64.0 AS DOUBLE) AS Timepoint_workload_autoscale_limit, TimePoint, CapacityId, insert_date FROM ops),
caps AS (
  SELECT printf('CAP-%02d', s_suppkey) AS CapacityId, s_name AS CapacityName, 'Active' AS State, r_name AS Region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
active_caps AS (
  SELECT DISTINCT CapacityId, CAST(NULL AS VARCHAR) AS CapacityName, 'Provisioning' AS State, CAST(NULL AS VARCHAR) AS Region FROM ops
)"""


def _metrics(src: str, name: str) -> str:
    d = "CAST(1920.0 AS DOUBLE)"
    bg = f"CAST(SUM(CASE WHEN event_type IN ('error', 'view') THEN CAST(CU AS {DEC}) END) AS DOUBLE)"
    it = f"CAST(SUM(CASE WHEN NOT (event_type IN ('error', 'view')) THEN CAST(CU AS {DEC}) END) AS DOUBLE)"
    tot = cu_sum("CU")
    zero, hundred, null = "CAST(0.0 AS DOUBLE)", "CAST(100.0 AS DOUBLE)", "CAST(NULL AS DOUBLE)"
    vals = {
        "BackgroundPercentage": f"{bg} / {d}",
        "InteractivePercentage": f"{it} / {d}",
        "BackgroundNonBillablePercentage": zero,
        "InteractiveNonBillablePercentage": zero,
        "AutoscalePercentage": null,
        "CULimitPercentage": hundred,
        "TotalCUUsagePercentage": f"{tot} / {d}",
        "TotalCUs": tot,
        "SKUCUByTimePoint": d,
        "InteractiveDelayPercentage": zero,
        "InteractiveRejectionPercentage": zero,
        "InteractiveRejectionThreshold": hundred,
        "BackgroundRejectionPercentage": zero,
        "BackgroundRejectionThreshold": hundred,
        "CarryOverAddedPercentage": null,
        "CarryOverBurndownPercentage": null,
        "CarryOverCumulativePercentage": null,
        "OverageReferenceLine": hundred,
        "ExpectedBurndownInMin": null,
    }
    body = ", ".join(f"{vals[m]} AS {m}" for m in METRIC_MEASURES)
    return f"{name} AS (SELECT CapacityId, TimePoint, {body} FROM {src} GROUP BY CapacityId, TimePoint)"


_TP = _metrics("ops", "tp") + ",\n" + _metrics("ops_r", "tp_r")


def dedupe(src: str, keys, all_cols, order_col: str | None = "insert_date") -> str:
    """Latest per key, tie-break every remaining column ascending NULLs first."""
    rest = [c for c in all_cols if c not in set(keys) and c != order_col]
    order = ([f"{order_col} DESC NULLS LAST"] if order_col else []) + [f"{q(c)} ASC NULLS FIRST" for c in rest]
    return (
        f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {cols(keys)} "
        f"ORDER BY {', '.join(order)}) AS _rn FROM {src}) WHERE _rn = 1"
    )


def synth(src: str, where: str = "TRUE") -> str:
    return f"(SELECT * REPLACE (coalesce(Operation_Id, {SYNTH}) AS Operation_Id) FROM {src} WHERE {where})"


RUN_ORDER = "TimePoint ASC NULLS FIRST, Operation ASC NULLS FIRST, Operation_start_time ASC NULLS FIRST, Operation_end_time ASC NULLS FIRST"


def running(src: str) -> str:
    return (
        f"SELECT *, CAST(SUM(CAST(SumCU_s AS {DEC})) OVER (PARTITION BY CapacityId, Unique_key, Operation_Id "
        f"ORDER BY {RUN_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS Acc_CU_s FROM ({src})"
    )


_GOLD = f"""
gstd AS ({dedupe(synth('silver_detail', 'Unique_key IS NOT NULL'), K7, SILVER_DETAIL_COLS)}),
gas AS ({running(dedupe(synth('silver_autoscale', f'Unique_key IS NOT NULL AND NOT {HALF_TEXT}'), K7, SILVER_AUTOSCALE_COLS))}),
uni AS (
  SELECT 'standard' AS SourceType, CapacityId, TimePoint, Operation_Id, Operation, Workspace_name, Item_name, Item_kind, "User", Unique_key,
         SumTotal_CU_s AS PointInTimeCU_s, CAST(NULL AS DOUBLE) AS CumulativeCU_s FROM gstd
  UNION ALL
  SELECT 'autoscale' AS SourceType, CapacityId, TimePoint, Operation_Id, Operation, Workspace_name, Item_name, Item_kind, "User", Unique_key,
         SumCU_s AS PointInTimeCU_s, Acc_CU_s AS CumulativeCU_s FROM gas
)"""

PREFIX = "WITH " + _OPS.strip() + ",\n" + _TP + "," + _GOLD


def with_(body: str, *ctes: str) -> str:
    extra = "".join(",\n" + c for c in ctes)
    return PREFIX + extra + "\n" + body


def match(a: str, b: str, eq, null_safe) -> str:
    parts = [f"{a}.{q(k)} = {b}.{q(k)}" for k in eq] + [f"{a}.{q(k)} IS NOT DISTINCT FROM {b}.{q(k)}" for k in null_safe]
    return " AND ".join(parts)


def upsert(t: str, s: str, eq, null_safe, when_matched: str) -> str:
    if when_matched == "update":
        return f"SELECT * FROM {t} WHERE NOT EXISTS (SELECT 1 FROM {s} WHERE {match(s, t, eq, null_safe)}) UNION ALL SELECT * FROM {s}"
    return f"SELECT * FROM {t} UNION ALL SELECT * FROM {s} WHERE NOT EXISTS (SELECT 1 FROM {t} WHERE {match(t, s, eq, null_safe)})"


def run1(col: str = "insert_date") -> str:
    return f"{col} < {ts(S.RUN1_BEFORE)}"


def run2(col: str = "insert_date") -> str:
    return f"{col} >= {ts(S.RUN2_FROM)}"


def window(start: str, end: str, col: str = "TimePoint") -> str:
    return f"{col} BETWEEN {bound(start)} AND {bound(end)}"


def top(keys, measures: str, src: str, n: int) -> str:
    order = ", ".join(["TotalCU_s DESC NULLS LAST"] + [f"{q(k)} ASC NULLS FIRST" for k in keys])
    return f"SELECT {cols(keys)}, {measures} FROM {src} GROUP BY {cols(keys)} ORDER BY {order} LIMIT {n}"


def summary(src: str, group_cols, measures: str) -> str:
    unit = "CapacityId, TimePoint"
    return (
        f"SELECT {cols(group_cols)}, GROUPING({q(group_cols[0])}) = 1 AS IsGrandTotalRowTotal, {measures}, {unit} "
        f"FROM {src} GROUP BY GROUPING SETS (({unit}, {cols(group_cols)}), ({unit}))"
    )


WL_STD = f"SELECT CapacityId, TimePoint FROM tp WHERE {window(*S.MONTH_WINDOW)} ORDER BY CapacityId ASC NULLS FIRST, TimePoint DESC NULLS LAST"
WL_AUTO = (
    f"SELECT CapacityId, TimePoint FROM tp WHERE {window(*S.MONTH_WINDOW)} AND NOT {HALF_TEXT} "
    "ORDER BY CapacityId ASC NULLS FIRST, TimePoint DESC NULLS LAST"
)
UNIFIED_COLS = ["SourceType", "CapacityId", "TimePoint", "Operation_Id", "Operation", "Workspace_name", "Item_name", "Item_kind", "User", "Unique_key", "PointInTimeCU_s", "CumulativeCU_s"]
TREND = ["CapacityId", "TimePoint", "TotalCUs", "TotalCUUsagePercentage", "BackgroundPercentage", "InteractivePercentage", "AutoscalePercentage", "CarryOverCumulativePercentage"]


def _latest_state() -> str:
    b = "SELECT Operation, Operation_Id, MAX(TimePoint) AS MaxTimePoint, Unique_key FROM gas GROUP BY Operation, Operation_Id, Unique_key"
    return with_(
        f"SELECT {cols(UNIFIED_COLS, 'a.')} FROM uni a JOIN ({b}) b "
        "ON a.Operation_Id = b.Operation_Id AND a.TimePoint = b.MaxTimePoint AND a.Unique_key = b.Unique_key "
        "WHERE a.SourceType = 'autoscale' ORDER BY a.TimePoint DESC NULLS LAST, a.Item_name ASC NULLS FIRST"
    )


def _latest_state_strict() -> str:
    keys = ["CapacityId", "Operation", "Operation_Id", "Unique_key"]
    cond = " AND ".join(["a.TimePoint = b.MaxTimePoint"] + [f"a.{q(k)} IS NOT DISTINCT FROM b.{q(k)}" for k in keys])
    return with_(
        f"SELECT {cols(UNIFIED_COLS, 'a.')} FROM ua a JOIN ub b ON {cond} ORDER BY a.TimePoint DESC NULLS LAST, a.Item_name ASC NULLS FIRST",
        "ua AS (SELECT * FROM uni WHERE SourceType = 'autoscale')",
        f"ub AS (SELECT {cols(keys)}, MAX(TimePoint) AS MaxTimePoint FROM ua GROUP BY {cols(keys)})",
    )


def _detail_runs() -> list[str]:
    return [
        f"t AS ({dedupe(f'(SELECT * FROM silver_detail WHERE {run1()})', K7, SILVER_DETAIL_COLS)})",
        f"s AS ({dedupe(f'(SELECT * FROM silver_detail WHERE {run2()})', K7, SILVER_DETAIL_COLS)})",
    ]


def _metric_runs() -> list[str]:
    return [f"t AS (SELECT * FROM tp WHERE {run1('TimePoint')})", f"s AS (SELECT * FROM tp_r WHERE {run2('TimePoint')})"]


CAL = "SELECT DISTINCT CapacityId, TimePoint, CAST(TimePoint AS DATE) AS Date FROM {src}"

ORACLE: dict[str, str] = {
    "capacity_trend": with_(f"SELECT {cols(TREND)} FROM tp ORDER BY TimePoint ASC NULLS FIRST, CapacityId ASC NULLS FIRST"),
    "top_items": with_(top(["Workspace_name", "Item_name", "Item_kind"], f"{cu_sum('SumTotal_CU_s')} AS TotalCU_s, COUNT(*) AS Samples", "gstd", S.TOP_N)),
    "top_workspaces": with_(
        top(
            ["Workspace_name"],
            f"{cu_sum('SumTotal_CU_s')} AS TotalCU_s, COUNT(DISTINCT Item_name) AS DistinctItems, COUNT(DISTINCT Operation_Id) AS DistinctOperations",
            "gstd",
            S.TOP_N,
        )
    ),
    "top_operations": with_(
        top(
            ["Operation"],
            f"{cu_sum('SumTotal_CU_s')} AS TotalCU_s, COUNT(DISTINCT Operation_Id) AS DistinctOperationIds, COUNT(DISTINCT Item_name) AS DistinctItems",
            "gstd",
            S.TOP_N,
        )
    ),
    "unified_operations": with_("SELECT * FROM uni"),
    "latest_state": _latest_state(),
    "latest_state_strict": _latest_state_strict(),
    "inspect_operation": with_(
        f"SELECT * FROM uni WHERE Operation_Id = '{S.INSPECT_OPERATION_ID}' "
        "ORDER BY TimePoint DESC NULLS LAST, SourceType ASC NULLS FIRST, Item_name ASC NULLS FIRST"
    ),
    "gold_standard": with_("SELECT * FROM gstd"),
    "running_cu": with_("SELECT * FROM gas"),
    "cumulative_by_operation": with_("SELECT CapacityId, Operation_Id, MAX(Acc_CU_s) AS MaxAcc_CU_s FROM gas GROUP BY CapacityId, Operation_Id"),
    "calendar": with_(CAL.format(src="tp")),
    "metrics_by_timepoint": with_("SELECT * FROM tp"),
    "gold_capacities": with_("SELECT * FROM caps"),
    "dedupe_latest": with_(dedupe("silver_detail", K7, SILVER_DETAIL_COLS)),
    "dedupe_any": with_(dedupe("(SELECT * EXCLUDE (insert_date) FROM silver_detail)", K7, SILVER_DETAIL_COLS[:-1], order_col=None)),
    "dedupe_first": with_(
        "SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY "
        + cols(K7)
        + " ORDER BY insert_date ASC NULLS FIRST, SumTotal_CU_s ASC NULLS FIRST) AS _rn FROM silver_detail) WHERE _rn = 1"
    ),
    "duplicate_count": with_(
        "SELECT CAST(coalesce(SUM(n), 0) AS BIGINT) AS total_rows, COUNT(*) AS distinct_keys, "
        "CAST(coalesce(SUM(n), 0) AS BIGINT) - COUNT(*) AS duplicates "
        f"FROM (SELECT COUNT(*) AS n FROM silver_detail GROUP BY {cols(K7)})"
    ),
    "synthetic_id": with_(
        f"SELECT CapacityId, TimePoint, Operation, Operation_start_time, Operation_end_time, coalesce(Operation_Id, {SYNTH}) AS Operation_Id, insert_date "
        "FROM silver_detail"
    ),
    "filter_window": with_(f"SELECT * FROM silver_detail WHERE {window(*S.FILTER_WINDOW)}"),
    "filter_capacity": with_(f"SELECT * FROM silver_detail WHERE CapacityId = '{S.CAPACITY_ID}'"),
    "filter_capacity_ci": with_(f"SELECT * FROM caps WHERE upper(CapacityId) = upper('{S.CI_CAPACITY_ID}')"),
    "drop_half_minute": with_(f"SELECT * FROM silver_autoscale WHERE NOT {HALF_TEXT}"),
    "exclude_null_key": with_("SELECT * FROM silver_detail WHERE Unique_key IS NOT NULL"),
    "half_minute_count": with_(
        f"SELECT COUNT(*) FILTER (WHERE coalesce({HALF_FORMAT}, false)) AS half_minute_rows, "
        f"COUNT(*) FILTER (WHERE coalesce({HALF_TEXT}, false)) AS half_minute_text_rows FROM silver_autoscale"
    ),
    "semi_filter": with_(
        "SELECT * FROM silver_detail d WHERE EXISTS (SELECT 1 FROM wl WHERE wl.CapacityId = d.CapacityId AND wl.TimePoint = d.TimePoint)",
        f"wl AS (SELECT CapacityId, TimePoint FROM tp WHERE NOT {HALF_TEXT})",
    ),
    "upsert_full": with_(upsert("t", "s", K7_EQ, K7_NULL_SAFE, "update"), *_detail_runs()),
    "upsert_insert_only": with_(upsert("t", "s", K7_EQ, K7_NULL_SAFE, "insert"), *_detail_runs()),
    "merge_gold_metrics": with_(upsert("t", "s", ["CapacityId", "TimePoint"], [], "update"), *_metric_runs()),
    "merge_timepoints": with_(upsert("t", "s", ["CapacityId", "TimePoint"], [], "insert"), *_metric_runs()),
    "merge_calendar": with_(
        upsert("ct", "cs", ["CapacityId", "TimePoint"], [], "insert"),
        *_metric_runs(),
        "ct AS (" + CAL.format(src="t") + ")",
        "cs AS (" + CAL.format(src="s") + ")",
    ),
    "merge_capacities": with_(upsert("active_caps", "caps", ["CapacityId"], [], "insert")),
    "merge_gold_standard": with_(
        upsert("t", "s", K7_EQ, K7_NULL_SAFE, "insert"),
        f"t AS ({dedupe(synth('silver_detail', 'Unique_key IS NOT NULL AND ' + run1()), K7, SILVER_DETAIL_COLS)})",
        f"s AS ({dedupe(synth('silver_detail', 'Unique_key IS NOT NULL AND ' + run2()), K7, SILVER_DETAIL_COLS)})",
    ),
    "merge_gold_autoscale": with_(
        f"SELECT * FROM m WHERE NOT coalesce({HALF_TEXT}, false)",
        f"t AS ({running(dedupe(synth('silver_autoscale', 'Unique_key IS NOT NULL AND ' + run1()), K7, SILVER_AUTOSCALE_COLS))})",
        "m AS (" + upsert("t", "gas", K7_EQ, K7_NULL_SAFE, "update") + ")",
    ),
    "merge_gold_autoscale_incremental": with_(
        f"SELECT * FROM m WHERE NOT coalesce({HALF_TEXT}, false)",
        f"t AS ({running(dedupe(synth('silver_autoscale', f'Unique_key IS NOT NULL AND NOT {HALF_TEXT} AND ' + run1()), K7, SILVER_AUTOSCALE_COLS))})",
        "m AS (" + upsert("t", "gas", K7_EQ, K7_NULL_SAFE, "update") + ")",
    ),
    "delete_half_minute": with_(f"SELECT * FROM silver_autoscale WHERE NOT coalesce({HALF_FORMAT}, false)"),
    "detail_summary": with_(
        summary("silver_detail_nr", DETAIL_GROUP_COLUMNS, f"{cu_sum('SumDuration_s')} AS SumDuration_s, {cu_sum('SumTotal_CU_s')} AS SumTotal_CU_s")
    ),
    "autoscale_summary": with_(
        summary(
            "silver_autoscale_nr",
            AUTOSCALE_GROUP_COLUMNS,
            f"{cu_sum('SumCU_s')} AS SumCU_s, MAX(Timepoint_workload_autoscale_limit) AS Timepoint_workload_autoscale_limit",
        )
    ),
    "null_key_audit": with_(
        "SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE Unique_key IS NULL) AS null_key_rows, "
        "COUNT(*) FILTER (WHERE Unique_key IS NULL AND coalesce(IsGrandTotalRowTotal, false)) AS null_key_total_rows, "
        "COUNT(*) FILTER (WHERE Unique_key IS NULL AND NOT coalesce(IsGrandTotalRowTotal, false)) AS null_key_detail_rows FROM silver_detail"
    ),
    "silver_stats": with_(
        "SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE Unique_key IS NULL) AS null_key_rows, "
        f"COUNT(*) FILTER (WHERE coalesce({HALF_TEXT}, false)) AS half_minute_text_rows, "
        f"COUNT(*) FILTER (WHERE coalesce({HALF_FORMAT}, false)) AS half_minute_format_rows, "
        "COUNT(DISTINCT CapacityId) AS capacities FROM silver_autoscale"
    ),
    "star_facts": with_(
        "SELECT f.CapacityId, f.TimePoint, f.Operation, f.Operation_Id, f.Item_name, f.SumTotal_CU_s, c.Date, k.CapacityName, k.Region "
        "FROM gstd f JOIN cal c ON c.CapacityId = f.CapacityId AND c.TimePoint = f.TimePoint JOIN caps k ON k.CapacityId = f.CapacityId",
        "cal AS (" + CAL.format(src="tp") + ")",
    ),
    "worklist_standard": with_(WL_STD),
    "worklist_autoscale": with_(WL_AUTO),
    "date_spine": with_(
        "SELECT s.CapacityId, CAST(g.d AS DATE) AS Date FROM span s, "
        "LATERAL (SELECT unnest(generate_series(CAST(s.f AS TIMESTAMP), CAST(s.l AS TIMESTAMP), INTERVAL 1 DAY)) AS d) g",
        "span AS (SELECT CapacityId, CAST(MIN(TimePoint) AS DATE) AS f, CAST(MAX(TimePoint) AS DATE) AS l FROM tp GROUP BY CapacityId)",
    ),
    "make_timepoint": with_(
        "SELECT CapacityId, TimePoint, CAST(year(TimePoint) AS INTEGER) AS tp_year, CAST(month(TimePoint) AS INTEGER) AS tp_month, "
        "CAST(day(TimePoint) AS INTEGER) AS tp_day, CAST(hour(TimePoint) AS INTEGER) AS tp_hour, CAST(minute(TimePoint) AS INTEGER) AS tp_minute, "
        "CAST(second(TimePoint) AS INTEGER) AS tp_second, upper(CapacityId) AS CapacityIdUpper, "
        "printf('DATE(%d, %d, %d) + TIME(%d, %d, %d)', year(TimePoint), month(TimePoint), day(TimePoint), hour(TimePoint), minute(TimePoint), second(TimePoint)) "
        "AS TimepointExpression, make_timestamp(year(TimePoint), month(TimePoint), day(TimePoint), hour(TimePoint), minute(TimePoint), "
        "CAST(second(TimePoint) AS DOUBLE)) AS RebuiltTimePoint FROM wl",
        "wl AS (SELECT CapacityId, TimePoint FROM tp)",
    ),
    "prereq_count": with_(f"SELECT COUNT(*) AS n FROM tp WHERE {window(*S.MONTH_WINDOW)}"),
    "existing_in_range": with_(f"SELECT COUNT(*) AS n FROM silver_detail WHERE {window(*S.FILTER_WINDOW)} AND CapacityId = '{S.CAPACITY_ID}'"),
    "capacities_ingest": with_("SELECT upper(CapacityId) AS CapacityId, CapacityName, State, Region FROM caps"),
    "capacities_ingest_v47": with_("SELECT upper(CapacityId) AS CapacityId, CAST(NULL AS VARCHAR) AS CapacityName, State, Region FROM caps"),
    "metrics_ingest_v53": with_("SELECT upper(CapacityId) AS CapacityId, TimePoint, " + ", ".join(f"TotalCUs + {k} AS {m}" for k, m in enumerate(METRIC_MEASURES, 1)) + " FROM tp"),
    "metrics_ingest_v37": with_("SELECT upper(CapacityId) AS CapacityId, TimePoint, " + ", ".join(f"TotalCUs + {k} AS {m}" for k, m in enumerate(METRIC_MEASURES, 1)) + " FROM tp"),
    "detail_ingest": with_(dedupe(synth("silver_detail"), K7, SILVER_DETAIL_COLS)),
    "autoscale_ingest": with_(dedupe(synth("silver_autoscale"), K7, SILVER_AUTOSCALE_COLS)),
    "staged_read": with_("SELECT * FROM silver_detail"),
    "views": with_("SELECT * FROM uni WHERE SourceType = 'autoscale'"),
}


def _table_runs() -> tuple[str, str, str]:
    nulled = "dn AS (SELECT * REPLACE (CASE WHEN SumDuration_s = 17 THEN NULL ELSE TimePoint END AS TimePoint) FROM silver_detail)"
    first = dedupe(f"(SELECT * FROM dn WHERE {run1()})", K7, SILVER_DETAIL_COLS)
    second = dedupe(f"(SELECT * FROM dn WHERE {run2()})", K7, SILVER_DETAIL_COLS)
    return nulled, f"t AS ({first})", f"s AS ({second})"


ORACLE |= {
    "table_merge_update": with_(upsert("t", "s", K7_EQ, K7_NULL_SAFE, "update"), *_table_runs()),
    "table_merge_insert": with_(upsert("t", "s", K7_EQ, K7_NULL_SAFE, "insert"), *_table_runs()),
    "table_delete_half_minute": with_(f"SELECT * FROM t WHERE NOT coalesce({HALF_FORMAT}, false)", *_table_runs()),
    "table_refresh": with_("SELECT * FROM s", *_table_runs()),
    "table_append": with_("SELECT * FROM t UNION ALL SELECT * FROM s", *_table_runs()),
}


def _write_counts() -> str:
    rest = [c for c in SILVER_DETAIL_COLS if c not in K7]
    differ = " OR ".join(f"s.{q(c)} IS DISTINCT FROM t.{q(c)}" for c in rest)
    both = match("t", "s", K7_EQ, K7_NULL_SAFE)
    return (
        "SELECT (SELECT COUNT(*) FROM raw2) AS read_rows, (SELECT COUNT(*) FROM raw2) - (SELECT COUNT(*) FROM s) AS duplicates, "
        f"(SELECT COUNT(*) FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {both})) AS inserted, "
        f"(SELECT COUNT(*) FROM s JOIN t ON {both} WHERE {differ}) AS updated, "
        f"(SELECT COUNT(*) FROM m WHERE coalesce({HALF_FORMAT}, false)) AS deleted"
    )


ORACLE |= {
    "table_merge_bucketed": ORACLE["table_merge_update"],
    "carried_balances": ORACLE["merge_gold_autoscale_incremental"],
    "table_write_counts": with_(
        _write_counts(), *_table_runs(), f"raw2 AS (SELECT * FROM dn WHERE {run2()})", f"m AS ({upsert('t', 's', K7_EQ, K7_NULL_SAFE, 'update')})"
    ),
}

ORACLE["star_facts_pruned"] = with_(
    "SELECT f.CapacityId, f.TimePoint, f.Operation, f.Operation_Id, f.Item_name, f.SumTotal_CU_s, CAST(f.TimePoint AS DATE) AS Date, k.CapacityName, k.Region "
    f"FROM gstd f JOIN tp p ON p.CapacityId = f.CapacityId AND p.TimePoint = f.TimePoint AND p.TotalCUs >= {S.BUSY_CU} JOIN caps k ON k.CapacityId = f.CapacityId"
)

ORACLE["sql_top_items"] = with_(
    top(
        ["Workspace_name", "Item_name", "Item_kind"],
        f"{cu_sum('SumTotal_CU_s')} AS TotalCU_s, COUNT(*) AS Samples",
        f"(SELECT * FROM gstd WHERE CapacityId = upper('{S.CI_CAPACITY_ID}') AND {window(*S.FILTER_WINDOW)})",
        S.TOP_N,
    )
)

ORACLE["staged_units"] = with_(
    f"SELECT * REPLACE (CASE WHEN CapacityId = '{S.CAPACITY_ID}' THEN 2 * SumTotal_CU_s ELSE SumTotal_CU_s END AS SumTotal_CU_s) "
    f"FROM silver_detail WHERE CapacityId IS DISTINCT FROM '{S.EMPTIED_CAPACITY_ID}'"
)
