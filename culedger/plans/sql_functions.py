"""The six analysis patterns as SQL table functions, for SQL users:

    SELECT * FROM top_items(n => 10, capacity => 'cap-01',
                            window_start => '05 June 2026 07:30', window_end => '05 June 2026 20:59')

They are functions of the session (Spark calls a table function by a plain name
only), each name behind the lakehouse's prefix. Every argument may be left out.
A function is a query over the gold tables with its arguments in place, which
Spark plans with the query around it: literal arguments fold, so scope filters
are pushed to the scan and a top-n is a heap for each partition, not a sort. Results equal :mod:`culedger.plans.analysis`;
``window_start`` and ``window_end`` are bounds as there, of which one may be
missing. (Arguments are not named like columns, which would hide them.)
"""

from __future__ import annotations

from culedger.functions.columns import CU_DECIMAL, WINDOW_FORMAT
from culedger.operators.aggregates import DEFAULT_TOP_N
from culedger.operators.joins import UNIFIED_COLUMNS
from culedger.plans import tables as T
from culedger.plans.analysis import TREND_COLUMNS

_SCOPE_ARGS = "capacity STRING DEFAULT NULL, window_start STRING DEFAULT NULL, window_end STRING DEFAULT NULL"
_SCOPE = (
    "(capacity IS NULL OR CapacityId = upper(capacity)) "
    f"AND (window_start IS NULL OR TimePoint >= to_timestamp_ntz(window_start, '{WINDOW_FORMAT}')) "
    f"AND (window_end IS NULL OR TimePoint <= to_timestamp_ntz(window_end, '{WINDOW_FORMAT}'))"
)
_OPERATION = "(only_operation IS NULL OR trim(only_operation) = '' OR Operation_Id = trim(only_operation))"


def _exact(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN coalesce(try_cast({c} AS {CU_DECIMAL}), CAST(0 AS {CU_DECIMAL})) END"


def _cu(c: str) -> str:
    """The library's sum of CU: the exact part plus what it leaves."""
    return f"CAST(sum({_exact(c)}) AS DOUBLE) + sum({c} - CAST({_exact(c)} AS DOUBLE))"


def _top(keys: list[str], measures: str, table: str) -> str:
    by = ", ".join(keys)
    order = ", ".join(["TotalCU_s DESC NULLS LAST", *[f"{k} ASC NULLS FIRST" for k in keys]])
    names = ", ".join([*keys, *[m.rsplit(" AS ", 1)[1] for m in measures.split("; ")]])
    grouped = f"SELECT {by}, {', '.join(measures.split('; '))} FROM {table} WHERE {_SCOPE} GROUP BY {by}"
    return f"SELECT {names} FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM ({grouped})) WHERE place <= n ORDER BY place"


def _unified(standard: str, autoscale: str | None) -> str:
    shared = [c for c in UNIFIED_COLUMNS if c not in ("SourceType", "PointInTimeCU_s", "CumulativeCU_s")]
    shown = ", ".join(f"`{c}`" for c in shared)
    out = f"SELECT 'standard' AS SourceType, {shown}, SumTotal_CU_s AS PointInTimeCU_s, CAST(NULL AS DOUBLE) AS CumulativeCU_s FROM {standard} WHERE {_SCOPE}"
    if autoscale:
        out += f" UNION ALL SELECT 'autoscale', {shown}, SumCU_s, Acc_CU_s FROM {autoscale} WHERE {_SCOPE}"
    return "SELECT " + ", ".join(f"`{c}`" for c in UNIFIED_COLUMNS) + f" FROM ({out})"


def _latest(unified: str) -> str:
    """Rows at the latest timepoint of their item-operation (the documented
    reading), NULLs alike."""
    keys = ["CapacityId", "Operation", "Operation_Id", "Unique_key"]
    rows = f"SELECT * FROM ({unified}) WHERE SourceType = 'autoscale' AND {_OPERATION}"
    last = f"SELECT {', '.join(f'{k} AS l_{k}' for k in keys)}, max(TimePoint) AS l_TimePoint FROM ({rows}) GROUP BY {', '.join(keys)}"
    same = " AND ".join([*[f"u.{k} <=> l.l_{k}" for k in keys], "u.TimePoint = l.l_TimePoint"])
    return "SELECT " + ", ".join(f"u.`{c}`" for c in UNIFIED_COLUMNS) + f" FROM ({rows}) u JOIN ({last}) l ON {same}"


def statements(lh: T.Lakehouse) -> dict[str, str]:
    """CREATE FUNCTION text by pattern; the autoscale table is optional."""
    standard, metrics = lh.name(T.GOLD_TP_METRICS), lh.name(T.GOLD_METRICS_BY_TIMEPOINT)
    autoscale = lh.name(T.GOLD_TP_METRICS_AS) if lh.exists(T.GOLD_TP_METRICS_AS) else None
    kinds = {f.name: f.dataType.simpleString() for t in (T.GOLD_METRICS_BY_TIMEPOINT, T.GOLD_TP_METRICS) for f in lh.read(t).schema.fields}
    kinds |= dict(SourceType="string", PointInTimeCU_s="double", CumulativeCU_s="double", TotalCU_s="double", Samples="bigint", DistinctItems="bigint", DistinctOperations="bigint", DistinctOperationIds="bigint")
    cu, unified = f"{_cu('SumTotal_CU_s')} AS TotalCU_s", _unified(standard, autoscale)
    n, operation = f"n INT DEFAULT {DEFAULT_TOP_N}", "only_operation STRING DEFAULT NULL"
    trend = ", ".join(f"`{c}`" for c in TREND_COLUMNS)
    patterns = {
        "capacity_trend": ("", TREND_COLUMNS, f"SELECT {trend} FROM {metrics} WHERE {_SCOPE}"),
        "top_items": (n, ["Workspace_name", "Item_name", "Item_kind", "TotalCU_s", "Samples"], _top(["Workspace_name", "Item_name", "Item_kind"], f"{cu}; count(1) AS Samples", standard)),
        "top_workspaces": (n, ["Workspace_name", "TotalCU_s", "DistinctItems", "DistinctOperations"], _top(["Workspace_name"], f"{cu}; count(DISTINCT Item_name) AS DistinctItems; count(DISTINCT Operation_Id) AS DistinctOperations", standard)),
        "top_operations": (n, ["Operation", "TotalCU_s", "DistinctOperationIds", "DistinctItems"], _top(["Operation"], f"{cu}; count(DISTINCT Operation_Id) AS DistinctOperationIds; count(DISTINCT Item_name) AS DistinctItems", standard)),
        "autoscale_latest": (operation, UNIFIED_COLUMNS, _latest(unified)),
        "inspect_operation": (operation, UNIFIED_COLUMNS, f"SELECT * FROM ({unified}) WHERE {_OPERATION}"),
    }
    out = {}
    for name, (first, columns, body) in patterns.items():
        args = ", ".join(x for x in (first, _SCOPE_ARGS) if x)
        shape = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
        out[name] = f"CREATE OR REPLACE TEMPORARY FUNCTION {lh.prefix}{name}({args}) RETURNS TABLE ({shape}) RETURN {body}"
    return out


def create_functions(lh: T.Lakehouse) -> list[str]:
    """Create the functions over the gold tables; returns their names."""
    made = statements(lh)
    for text in made.values():
        lh.spark.sql(text)
    return [f"{lh.prefix}{name}" for name in made]
