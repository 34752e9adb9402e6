"""Registered queries: each takes ``(spark, sf_dir)`` and returns a lazy
DataFrame over the driver tables. Silver inputs are derived from the tables
(``culedger.sources.fixtures``), then the library operators run on them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culedger.functions.columns import half_minute_by_format, half_minute_by_text, with_synthetic_operation_id
from culedger.operators import aggregates as agg
from culedger.operators.dedupe import dedupe_any, dedupe_first, dedupe_latest, duplicate_count
from culedger.operators.filters import (
    delete_half_minute_format,
    drop_half_minute,
    exclude_null_key,
    filter_capacity,
    filter_capacity_ci,
    filter_window,
    semi_filter,
)
from culedger.operators.joins import star_facts
from culedger.plans import analysis, extracts, gold
from culedger.plans import scenario as S
from culedger.plans.table_queries import TABLE_QUERIES
from culedger.schemas import K7
from culedger.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]


def _ntz(text: str):
    return F.to_timestamp_ntz(F.lit(text))


def _run1(df: DataFrame, col: str = "insert_date") -> DataFrame:
    return df.filter(F.col(col) < _ntz(S.RUN1_BEFORE))


def _run2(df: DataFrame, col: str = "insert_date") -> DataFrame:
    return df.filter(F.col(col) >= _ntz(S.RUN2_FROM))


# Gold inputs -----------------------------------------------------------------


def _gold_standard(spark, sf):
    return gold.gold_standard_source(fx.silver_detail(spark, sf))


def _gold_autoscale(spark, sf):
    return gold.gold_autoscale_source(fx.silver_autoscale(spark, sf))


def _gold_metrics(spark, sf):
    return gold.gold_metrics_source(fx.silver_timepoints(spark, sf))


def _views(spark, sf, standard=True, autoscale=True, metrics=False):
    """Scoped views over only the gold inputs a pattern reads."""
    return analysis.views(
        _gold_standard(spark, sf) if standard else None,
        _gold_autoscale(spark, sf) if autoscale else None,
        _gold_metrics(spark, sf) if metrics else None,
    )


# Analysis patterns -----------------------------------------------------------


def q_capacity_trend(spark, sf):
    return analysis.capacity_trend(_views(spark, sf, standard=False, autoscale=False, metrics=True))


def q_top_items(spark, sf):
    return analysis.top_items(_views(spark, sf, autoscale=False), S.TOP_N)


def q_top_workspaces(spark, sf):
    return analysis.top_workspaces(_views(spark, sf, autoscale=False), S.TOP_N)


def q_top_operations(spark, sf):
    return analysis.top_operations(_views(spark, sf, autoscale=False), S.TOP_N)


def q_unified_operations(spark, sf):
    return _views(spark, sf).unified


def q_latest_state(spark, sf):
    return analysis.autoscale_latest(_views(spark, sf), strict=False)


def q_latest_state_strict(spark, sf):
    return analysis.autoscale_latest(_views(spark, sf), strict=True)


def q_inspect_operation(spark, sf):
    return analysis.inspect_operation(_views(spark, sf), S.INSPECT_OPERATION_ID)


# Gold transforms -------------------------------------------------------------


def q_gold_standard(spark, sf):
    return _gold_standard(spark, sf)


def q_running_cu(spark, sf):
    return _gold_autoscale(spark, sf)


def q_cumulative_by_operation(spark, sf):
    return agg.latest_cumulative(_gold_autoscale(spark, sf))


def q_calendar(spark, sf):
    return gold.gold_calendar_source(fx.silver_timepoints(spark, sf))


def q_metrics_by_timepoint(spark, sf):
    return fx.silver_timepoints(spark, sf)


def q_dedupe_latest(spark, sf):
    return dedupe_latest(fx.silver_detail(spark, sf), K7)


def q_dedupe_any(spark, sf):
    return dedupe_any(fx.silver_detail(spark, sf).drop("insert_date"), K7)


def q_dedupe_first(spark, sf):
    # Keep-first inside each (capacity, timepoint) extract, in load order.
    d = fx.silver_detail(spark, sf)
    return dedupe_first(d, ["CapacityId", "TimePoint"], K7, ["insert_date", "SumTotal_CU_s"])


def q_duplicate_count(spark, sf):
    return duplicate_count(fx.silver_detail(spark, sf), K7)


def q_synthetic_id(spark, sf):
    d = fx.silver_detail(spark, sf)
    return with_synthetic_operation_id(d).select(
        "CapacityId", "TimePoint", "Operation", "Operation_start_time", "Operation_end_time", "Operation_Id", "insert_date"
    )


# Filters ---------------------------------------------------------------------


def q_filter_window(spark, sf):
    return filter_window(fx.silver_detail(spark, sf), *S.FILTER_WINDOW)


def q_filter_capacity(spark, sf):
    return filter_capacity(fx.silver_detail(spark, sf), S.CAPACITY_ID)


def q_filter_capacity_ci(spark, sf):
    return filter_capacity_ci(fx.silver_capacities(spark, sf), S.CI_CAPACITY_ID)


def q_drop_half_minute(spark, sf):
    return drop_half_minute(fx.silver_autoscale(spark, sf))


def q_exclude_null_key(spark, sf):
    return exclude_null_key(fx.silver_detail(spark, sf))


def q_half_minute_count(spark, sf):
    d = fx.silver_autoscale(spark, sf)
    return d.agg(
        F.count_if(F.coalesce(half_minute_by_format("TimePoint"), F.lit(False))).alias("half_minute_rows"),
        F.count_if(F.coalesce(half_minute_by_text("TimePoint"), F.lit(False))).alias("half_minute_text_rows"),
    )


def q_semi_filter(spark, sf):
    # Standard detail at the timepoints of the autoscale work list.
    wl = worklist(fx.silver_timepoints(spark, sf), None, None, None, autoscale=True)
    return semi_filter(fx.silver_detail(spark, sf), wl, ["CapacityId", "TimePoint"])


# Upserts ---------------------------------------------------------------------


def _detail_runs(spark, sf):
    d = fx.silver_detail(spark, sf)
    target = dedupe_latest(_run1(d), K7)
    source = dedupe_latest(_run2(d), K7)
    return target, source


def q_upsert_full(spark, sf):
    t, s = _detail_runs(spark, sf)
    return gold.merge_silver_detail(t, s)


def q_upsert_insert_only(spark, sf):
    t, s = _detail_runs(spark, sf)
    from culedger.operators.upsert import upsert_detail

    return upsert_detail(t, s, "insert")


def _metric_runs(spark, sf):
    target = _run1(fx.silver_timepoints(spark, sf), "TimePoint")
    source = _run2(fx.silver_timepoints(spark, sf, redelivery=True), "TimePoint")
    return target, source


def q_merge_gold_metrics(spark, sf):
    t, s = _metric_runs(spark, sf)
    return gold.merge_gold_metrics(t, s)


def q_merge_timepoints(spark, sf):
    t, s = _metric_runs(spark, sf)
    return gold.merge_timepoints(t, s)


def q_merge_calendar(spark, sf):
    t, s = _metric_runs(spark, sf)
    return gold.merge_calendar(gold.gold_calendar_source(t), gold.gold_calendar_source(s))


def q_merge_capacities(spark, sf):
    return gold.merge_capacities(fx.active_capacities(spark, sf), fx.silver_capacities(spark, sf))


def q_merge_gold_standard(spark, sf):
    d = fx.silver_detail(spark, sf)
    target = gold.gold_standard_source(_run1(d))
    return gold.merge_gold_standard(target, _run2(d))


def q_merge_gold_autoscale(spark, sf):
    a = fx.silver_autoscale(spark, sf)
    # Gold as an older build left it: run 1 only, ``:30`` rows still in.
    old = gold.gold_autoscale_source(_run1(a), drop_half=False)
    return gold.merge_gold_autoscale(old, a)


def q_merge_gold_autoscale_incremental(spark, sf):
    """Gold built from run 1, then only the running-total groups with rows
    that gold lacks are recomputed and merged; the oracle is the full
    rebuild."""
    a = fx.silver_autoscale(spark, sf)
    old = gold.gold_autoscale_source(_run1(a))
    return gold.merge_gold_autoscale_rows(old, gold.gold_autoscale_incremental(a, old))


def q_delete_half_minute(spark, sf):
    return delete_half_minute_format(fx.silver_autoscale(spark, sf))


# Aggregates and audits -------------------------------------------------------


def q_detail_summary(spark, sf):
    return agg.detail_summary(fx.silver_detail(spark, sf, redelivery=False))


def q_autoscale_summary(spark, sf):
    return agg.autoscale_summary(fx.silver_autoscale(spark, sf, redelivery=False))


def q_null_key_audit(spark, sf):
    return agg.null_key_audit(fx.silver_detail(spark, sf))


def q_silver_stats(spark, sf):
    return agg.silver_stats(fx.silver_autoscale(spark, sf))


def q_star_facts(spark, sf):
    tp = fx.silver_timepoints(spark, sf)
    return star_facts(_gold_standard(spark, sf), gold.gold_calendar_source(tp), fx.silver_capacities(spark, sf))


# Work lists --------------------------------------------------------------------


def worklist(timepoints: DataFrame, capacity_id, start, end, autoscale=False) -> DataFrame:
    from culedger.sources.worklist import worklist as _wl

    return _wl(timepoints, capacity_id, start, end, autoscale)


def q_worklist_standard(spark, sf):
    return worklist(fx.silver_timepoints(spark, sf), None, *S.MONTH_WINDOW, autoscale=False)


def q_worklist_autoscale(spark, sf):
    return worklist(fx.silver_timepoints(spark, sf), None, *S.MONTH_WINDOW, autoscale=True)


def q_date_spine(spark, sf):
    from culedger.sources.worklist import capacity_date_spine

    return capacity_date_spine(fx.silver_timepoints(spark, sf))


def q_make_timepoint(spark, sf):
    from culedger.sources.worklist import timepoint_parts

    return timepoint_parts(worklist(fx.silver_timepoints(spark, sf), None, None, None))


def q_prereq_count(spark, sf):
    from culedger.plans.checks import rows_in_range

    return rows_in_range(fx.silver_timepoints(spark, sf), None, *S.MONTH_WINDOW)


def q_existing_in_range(spark, sf):
    from culedger.plans.checks import rows_in_range

    return rows_in_range(fx.silver_detail(spark, sf), S.CAPACITY_ID, *S.FILTER_WINDOW)


# Ingest ----------------------------------------------------------------------


def q_capacities_ingest(spark, sf):
    from culedger.sources.ingest import capacities_from_extract

    return capacities_from_extract(extracts.capacities(fx.silver_capacities(spark, sf), "v53"), "v53")


def q_capacities_ingest_v47(spark, sf):
    from culedger.sources.ingest import capacities_from_extract

    return capacities_from_extract(extracts.capacities(fx.silver_capacities(spark, sf), "v47"), "v47")


def q_metrics_ingest_v53(spark, sf):
    from culedger.sources.ingest import metrics_from_extract

    return metrics_from_extract(extracts.metrics(fx.silver_timepoints(spark, sf), "v53"), "v53")


def q_metrics_ingest_v37(spark, sf):
    from culedger.sources.ingest import metrics_from_extract

    return metrics_from_extract(extracts.metrics(fx.silver_timepoints(spark, sf), "v37"), "v37")


def q_detail_ingest(spark, sf):
    from culedger.sources.ingest import ingest_detail

    return ingest_detail(extracts.detail(fx.silver_detail(spark, sf), extracts.STANDARD), kind="standard", load_time_col="load_time")


def q_autoscale_ingest(spark, sf):
    from culedger.sources.ingest import ingest_detail

    return ingest_detail(extracts.detail(fx.silver_autoscale(spark, sf), extracts.AUTOSCALE), kind="autoscale", load_time_col="load_time")


def q_staged_read(spark, sf):
    """Stage the derived detail batch as parquet parts in the shared work
    folder, then read every staged row back with the declared schema."""
    from culedger.schemas import TIMEPOINT_METRICS
    from culedger.sources.staging import StagedStore

    store = StagedStore(spark, "staged-read", TIMEPOINT_METRICS)
    store.append(fx.silver_detail(spark, sf))
    return store.read()


def q_staged_units(spark, sf):
    """Every unit staged once, then one capacity's units collected again (twice
    the CU), and another's again with nothing in them."""
    from culedger.schemas import TIMEPOINT_METRICS
    from culedger.sources.staging import UnitStore

    store = UnitStore(spark, "staged-units", TIMEPOINT_METRICS, unit=("CapacityId", "TimePoint"))
    d = fx.silver_detail(spark, sf)
    of = lambda capacity: d.filter(F.col("CapacityId") == capacity)
    store.put(d, d)
    store.put(of(S.CAPACITY_ID).withColumn("SumTotal_CU_s", F.col("SumTotal_CU_s") * 2), of(S.CAPACITY_ID))
    store.put(d.limit(0), of(S.EMPTIED_CAPACITY_ID))
    return store.read()


def q_views(spark, sf):
    """The analysis views registered by name and queried with SQL."""
    v = _views(spark, sf, metrics=True)
    analysis.register_views(v)
    return spark.sql(f"SELECT * FROM {analysis.VIEW_NAMES['unified']} WHERE SourceType = 'autoscale'")


QUERIES: dict[str, Query] = {
    # analysis patterns
    "capacity_trend": q_capacity_trend,
    "top_items": q_top_items,
    "top_workspaces": q_top_workspaces,
    "top_operations": q_top_operations,
    "unified_operations": q_unified_operations,
    "latest_state": q_latest_state,
    "latest_state_strict": q_latest_state_strict,
    "inspect_operation": q_inspect_operation,
    # gold transforms
    "gold_standard": q_gold_standard,
    "running_cu": q_running_cu,
    "cumulative_by_operation": q_cumulative_by_operation,
    "calendar": q_calendar,
    "metrics_by_timepoint": q_metrics_by_timepoint,
    # dedupe
    "dedupe_latest": q_dedupe_latest,
    "dedupe_any": q_dedupe_any,
    "dedupe_first": q_dedupe_first,
    "duplicate_count": q_duplicate_count,
    "synthetic_id": q_synthetic_id,
    # filters
    "filter_window": q_filter_window,
    "filter_capacity": q_filter_capacity,
    "filter_capacity_ci": q_filter_capacity_ci,
    "drop_half_minute": q_drop_half_minute,
    "exclude_null_key": q_exclude_null_key,
    "half_minute_count": q_half_minute_count,
    "semi_filter": q_semi_filter,
    # merges
    "upsert_full": q_upsert_full,
    "upsert_insert_only": q_upsert_insert_only,
    "merge_gold_metrics": q_merge_gold_metrics,
    "merge_timepoints": q_merge_timepoints,
    "merge_calendar": q_merge_calendar,
    "merge_capacities": q_merge_capacities,
    "merge_gold_standard": q_merge_gold_standard,
    "merge_gold_autoscale": q_merge_gold_autoscale,
    "merge_gold_autoscale_incremental": q_merge_gold_autoscale_incremental,
    "delete_half_minute": q_delete_half_minute,
    # aggregates, audits, joins
    "detail_summary": q_detail_summary,
    "autoscale_summary": q_autoscale_summary,
    "null_key_audit": q_null_key_audit,
    "silver_stats": q_silver_stats,
    "star_facts": q_star_facts,
    # work lists and checks
    "worklist_standard": q_worklist_standard,
    "worklist_autoscale": q_worklist_autoscale,
    "date_spine": q_date_spine,
    "make_timepoint": q_make_timepoint,
    "prereq_count": q_prereq_count,
    "existing_in_range": q_existing_in_range,
    # ingest
    "capacities_ingest": q_capacities_ingest,
    "capacities_ingest_v47": q_capacities_ingest_v47,
    "metrics_ingest_v53": q_metrics_ingest_v53,
    "metrics_ingest_v37": q_metrics_ingest_v37,
    "detail_ingest": q_detail_ingest,
    "autoscale_ingest": q_autoscale_ingest,
    "staged_read": q_staged_read,
    "staged_units": q_staged_units,
    **TABLE_QUERIES,
    "views": q_views,
}

