"""Gold transforms: silver DataFrame in, gold rows out. Table IO lives in
:mod:`culedger.plans.tables`; these functions are lazy and side-effect free,
so a caller's filters still reach the silver scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culedger.functions.columns import with_synthetic_operation_id
from culedger.operators.aggregates import calendar
from culedger.operators.dedupe import dedupe_latest
from culedger.operators.filters import delete_half_minute_text, drop_half_minute, exclude_null_key
from culedger.operators.running import running_sum
from culedger.operators.upsert import upsert, upsert_detail
from culedger.schemas import CAPACITY_KEY, K7, RUNNING_GROUP, RUNNING_TIEBREAK, TIMEPOINT_KEY


def gold_capacities(silver_capacities: DataFrame) -> DataFrame:
    """Full refresh: gold capacities are silver capacities."""
    return silver_capacities


def gold_metrics_source(silver_timepoints: DataFrame) -> DataFrame:
    """Silver capacity metrics deduplicated to one row per (CapacityId, TimePoint)."""
    return dedupe_latest(silver_timepoints, TIMEPOINT_KEY)


def gold_calendar_source(silver_timepoints: DataFrame) -> DataFrame:
    return calendar(silver_timepoints)


def gold_standard_source(silver_detail: DataFrame) -> DataFrame:
    """NULL-key rows out, synthetic id in, then latest per K7. The synthetic id
    comes before dedupe, so NULL-id rows with equal times collapse only when
    the rest of K7 is equal too."""
    return dedupe_latest(with_synthetic_operation_id(exclude_null_key(silver_detail)), K7)


def autoscale_rows(silver_autoscale: DataFrame, drop_half: bool = True) -> DataFrame:
    """NULL keys and ``:30`` timepoints out, synthetic id, latest per K7.

    The dedupe's row_number()=1 runs map-side before the K7 shuffle, so a key
    redelivered millions of times is cut down before anything moves."""
    rows = exclude_null_key(silver_autoscale)
    if drop_half:
        rows = drop_half_minute(rows)
    return dedupe_latest(with_synthetic_operation_id(rows), K7)


def accumulate(rows: DataFrame, split_depth: int = 1) -> DataFrame:
    """``Acc_CU_s`` = running SUM(SumCU_s) per (CapacityId, Unique_key,
    Operation_Id) ordered by TimePoint, with Operation and the operation times
    as tie-break so the order is total. The rows are shuffled once more, by
    (group, TimePoint)."""
    return running_sum(rows, RUNNING_GROUP, ["TimePoint"] + RUNNING_TIEBREAK, "SumCU_s", "Acc_CU_s", split_depth=split_depth)


def gold_autoscale_source(silver_autoscale: DataFrame, split_depth: int = 1, drop_half: bool = True) -> DataFrame:
    """Gold autoscale rows of all silver history."""
    return accumulate(autoscale_rows(silver_autoscale, drop_half), split_depth)


def _same(left: str, right: str, columns) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def gold_autoscale_incremental(silver_autoscale: DataFrame, gold_autoscale: DataFrame, split_depth: int = 1) -> DataFrame:
    """Gold autoscale rows to merge after an incremental silver load: every
    row of each running-total group that has a row gold lacks (by K7, load time
    and value, NULLs alike), with ``Acc_CU_s`` recomputed over the group's whole
    history. What gold holds decides, not a load-time watermark, so late rows,
    equal or NULL load times and a build that died half-way are all caught, and
    merging this equals the full rebuild. Lazy; the group semi-join is an
    equi-join on the group keys, and the running total splits a hot group."""
    rows = autoscale_rows(silver_autoscale)
    known = gold_autoscale.select(*K7, "insert_date", "SumCU_s")
    lacking = rows.alias("s").join(known.alias("g"), _same("s", "g", [*K7, "insert_date", "SumCU_s"]), "left_anti")
    groups = lacking.select(*RUNNING_GROUP).distinct()
    return accumulate(rows.alias("s").join(groups.alias("g"), _same("s", "g", RUNNING_GROUP), "left_semi"), split_depth)


# Merges ----------------------------------------------------------------------


def merge_capacities(target: DataFrame, source: DataFrame) -> DataFrame:
    """Silver capacities: insert-only on CapacityId."""
    return upsert(target, source, CAPACITY_KEY, (), "insert")


def merge_timepoints(target: DataFrame, source: DataFrame) -> DataFrame:
    """Silver capacity metrics: insert-only on (CapacityId, TimePoint)."""
    return upsert(target, source, TIMEPOINT_KEY, (), "insert")


def merge_calendar(target: DataFrame, source: DataFrame) -> DataFrame:
    """Gold calendar: insert-only on (CapacityId, TimePoint)."""
    return upsert(target, source, TIMEPOINT_KEY, (), "insert")


def merge_gold_metrics(target: DataFrame, source: DataFrame) -> DataFrame:
    """Gold capacity metrics: update+insert on (CapacityId, TimePoint)."""
    return upsert(target, gold_metrics_source(source), TIMEPOINT_KEY, (), "update")


def merge_silver_detail(target: DataFrame, source: DataFrame) -> DataFrame:
    """Silver detail (both kinds): update+insert on K7."""
    return upsert_detail(target, source, "update")


def merge_gold_standard(target: DataFrame, silver_detail: DataFrame) -> DataFrame:
    """Gold standard detail: insert-only on K7 (corrections in silver do not
    reach rows already in gold -- the reference's rule)."""
    return upsert_detail(target, gold_standard_source(silver_detail), "insert")


def merge_gold_autoscale_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Merge already-built gold autoscale rows (e.g. from
    :func:`gold_autoscale_incremental`): update+insert on K7, then delete
    ``:30`` timepoints."""
    return delete_half_minute_text(upsert_detail(target, rows, "update"))


def merge_gold_autoscale(target: DataFrame, silver_autoscale: DataFrame) -> DataFrame:
    """Gold autoscale: update+insert on K7 with ``Acc_CU_s`` recomputed over
    all silver history, then delete ``:30`` timepoints (they may already be in
    an older gold table)."""
    return delete_half_minute_text(upsert_detail(target, gold_autoscale_source(silver_autoscale), "update"))
