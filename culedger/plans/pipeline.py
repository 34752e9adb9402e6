"""End-to-end jobs over catalog tables: ingest (silver), gold build, and the
orchestration that runs them in dependency order.

Every step is a Spark job over whole DataFrames; the driver only sequences
steps. A step reports what its write did (rows read, dropped as duplicates,
inserted, updated, deleted) as Spark observed it on the way, without a pass of
its own. The two detail collectors run side by side.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import InheritableThread
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from culedger.functions.columns import half_minute_by_format, half_minute_by_text
from culedger.operators.aggregates import calendar, null_key_counts
from culedger.operators.filters import semi_filter
from culedger.plans import balances, gold
from culedger.plans import tables as T
from culedger.plans.checks import PrerequisiteError, require_rows_in_range, table_ready
from culedger.schemas import CAPACITY_KEY, K7_EQ, K7_NULL_SAFE, TIMEPOINT_KEY
from culedger.sources.ingest import capacities_from_extract, ingest_detail, metrics_from_extract
from culedger.sources.worklist import worklist

log = logging.getLogger("culedger.pipeline")

#: Columns whose statistics are kept after a write: those that tables are joined
#: on.
STATISTICS = ("CapacityId", "Date", "Region", "Operation_Id", "Unique_key")


@dataclass
class StepReport:
    name: str
    status: str = "skipped"
    detail: dict = field(default_factory=dict)


def _reading(df: DataFrame, *more) -> tuple[DataFrame, Observation]:
    """``df`` with its rows counted as a write reads them."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("read"), *more), seen


def _report(name: str, seen: Observation | None, *writes: T.WriteReport) -> StepReport:
    first = writes[0]
    read = seen.get["read"] if seen else first.read
    detail = {"read": read, "duplicates": read - first.read, "inserted": first.inserted, "updated": first.updated, "deleted": sum(w.deleted for w in writes)}
    return StepReport(name, "ok", detail)


def maintain(lh: T.Lakehouse, table: str, dates: list | None = None) -> None:
    """After a write: dates in too many small files are laid out anew, and the
    planner's statistics refreshed. Failing is not fatal."""
    try:
        lh.compact(table, dates=dates)
        columns = [c for c in STATISTICS if c in lh.read(table).columns]
        lh.analyze(table, columns)
    except Exception as ex:
        log.warning("maintenance skipped for %s: %s", table, ex)


# Ingest (silver) -------------------------------------------------------------


def ingest_capacities(lh: T.Lakehouse, extract: DataFrame, version: str) -> StepReport:
    """Capacity list -> silver.capacities, insert-only on CapacityId."""
    lh.create_schemas()
    done = lh.merge(T.SILVER_CAPACITIES, capacities_from_extract(extract, version), CAPACITY_KEY, (), "insert")
    return _report("ingest_capacities", None, done)


def ingest_metrics(lh: T.Lakehouse, extract: DataFrame, version: str) -> StepReport:
    """Metric extract -> silver.capacity_metrics_timepoints, insert-only on
    (CapacityId, TimePoint), source deduplicated first."""
    lh.create_schemas()
    raw, seen = _reading(metrics_from_extract(extract, version))
    done = lh.merge(T.SILVER_TIMEPOINTS, gold.gold_metrics_source(raw), TIMEPOINT_KEY, (), "insert")
    maintain(lh, T.SILVER_TIMEPOINTS, done.dates)
    return _report("ingest_metrics", seen, done)


def _scoped_extract(lh: T.Lakehouse, extract: DataFrame, capacity_id, start, end, autoscale: bool) -> DataFrame:
    """Keep extract rows of work-list units only (what the collector fetches):
    the work list is the silver calendar in the window for the capacity."""
    timepoints = lh.read(T.SILVER_TIMEPOINTS)
    require_rows_in_range(timepoints, capacity_id, start, end)
    wl = worklist(timepoints, capacity_id, start, end, autoscale=autoscale, ordered=False)
    units = wl.select(F.lower("CapacityId").alias("_cap"), F.col("TimePoint").alias("unit_timepoint"))
    ex = extract.withColumn("_cap", F.lower("unit_capacity_id"))
    return semi_filter(ex, units, ["_cap", "unit_timepoint"]).drop("_cap")


def ingest_standard_detail(lh, extract, capacity_id=None, start=None, end=None, load_time_col=None) -> StepReport:
    """Standard detail extract -> silver.timepoint_metrics, update+insert on K7."""
    if start is not None:
        extract = _scoped_extract(lh, extract, capacity_id, start, end, autoscale=False)
    raw, seen = _reading(extract)
    done = lh.merge(T.SILVER_TP_METRICS, ingest_detail(raw, "standard", load_time_col), K7_EQ, K7_NULL_SAFE, "update")
    maintain(lh, T.SILVER_TP_METRICS, done.dates)
    return _report("ingest_standard_detail", seen, done)


def ingest_autoscale_detail(lh, extract, capacity_id=None, start=None, end=None, load_time_col=None) -> StepReport:
    """Autoscale detail extract -> silver.timepoint_metrics_autoscale,
    update+insert on K7, then the silver half-minute delete. The dates are noted
    down before they change, for the next incremental gold build."""
    if start is not None:
        extract = _scoped_extract(lh, extract, capacity_id, start, end, autoscale=True)
    raw, seen = _reading(extract)
    rows = ingest_detail(raw, "autoscale", load_time_col)
    done = lh.merge(T.SILVER_TP_METRICS_AS, rows, K7_EQ, K7_NULL_SAFE, "update", note=lambda dates: lh.mark(T.SILVER_TP_METRICS_AS, dates))
    gone = lh.delete_where(T.SILVER_TP_METRICS_AS, half_minute_by_format("TimePoint"), done.dates)
    maintain(lh, T.SILVER_TP_METRICS_AS, done.dates)
    return _report("ingest_autoscale_detail", seen, done, gone)


# Gold ------------------------------------------------------------------------


def _audited(name: str, seen: Observation, done: T.WriteReport, deleted: int = 0) -> StepReport:
    """The report of a gold step whose silver rows were counted by key."""
    found = seen.get
    left = found["total_rows"] - found["null_key_rows"]
    return StepReport(name, "ok", {**found, **done.counts(), "read": found["read"], "duplicates": left - done.read, "deleted": deleted})


def _build_standard(lh: T.Lakehouse) -> StepReport:
    silver, seen = _reading(lh.read(T.SILVER_TP_METRICS), *null_key_counts())
    done = lh.merge(T.GOLD_TP_METRICS, gold.gold_standard_source(silver), K7_EQ, K7_NULL_SAFE, "insert")
    maintain(lh, T.GOLD_TP_METRICS, done.dates)
    return _audited("gold_standard", seen, done)


def _build_autoscale(lh: T.Lakehouse, incremental: bool) -> StepReport:
    dates, notes = lh.marked(T.SILVER_TP_METRICS_AS)
    if incremental and lh.exists(T.GOLD_TP_METRICS_AS) and lh.exists(T.GOLD_BALANCES):
        done = balances.carry_forward(lh, dates)
        lh.clear(notes)
        maintain(lh, T.GOLD_TP_METRICS_AS, done.dates)
        return StepReport("gold_autoscale", "ok", done.counts())
    silver, seen = _reading(lh.read(T.SILVER_TP_METRICS_AS), *null_key_counts())
    # Accumulating reads its rows twice; counted and deduplicated once.
    with lh._staged(T.GOLD_TP_METRICS_AS, T.with_date(gold.autoscale_rows(silver))) as (rows, kept, _):
        done = lh.merge(T.GOLD_TP_METRICS_AS, gold.accumulate(rows.drop(T.PARTITION_COL)), K7_EQ, K7_NULL_SAFE, "update")
        gone = lh.delete_where(T.GOLD_TP_METRICS_AS, half_minute_by_text("TimePoint"))
        lh.overwrite(T.GOLD_BALANCES, balances.day_totals(rows))
    lh.clear(notes)
    maintain(lh, T.GOLD_TP_METRICS_AS, done.dates)
    report = _audited("gold_autoscale", seen, done, gone.deleted)
    # Half-minute rows go before the dedupe, so they count among what it drops.
    report.detail["duplicates"] = report.detail["total_rows"] - report.detail["null_key_rows"] - kept
    return report


def build_gold(lh: T.Lakehouse, incremental: bool = False) -> list[StepReport]:
    """All gold tables from silver; idempotent (safe to rerun).

    ``incremental=True`` brings running totals forward from stored balances, on
    the dates that silver changed on since the last build, and shifts later ones
    (same result as the full rebuild)."""
    spark = lh.spark
    lh.create_schemas()
    table_ready(spark, lh.name(T.SILVER_CAPACITIES), required=True)
    table_ready(spark, lh.name(T.SILVER_TIMEPOINTS), required=True)
    has_std = table_ready(spark, lh.name(T.SILVER_TP_METRICS), required=False)
    has_as = table_ready(spark, lh.name(T.SILVER_TP_METRICS_AS), required=False)
    out: list[StepReport] = []

    done = lh.overwrite(T.GOLD_CAPACITIES, gold.gold_capacities(lh.read(T.SILVER_CAPACITIES)))
    out.append(_report("gold_capacities", None, done))
    for name, table, source, how in (
        ("gold_metrics", T.GOLD_METRICS_BY_TIMEPOINT, gold.gold_metrics_source, "update"),
        ("gold_calendar", T.GOLD_CALENDAR_TIMEPOINTS, calendar, "insert"),
    ):
        raw, seen = _reading(lh.read(T.SILVER_TIMEPOINTS))
        done = lh.merge(table, source(raw), TIMEPOINT_KEY, (), how)
        maintain(lh, table, done.dates)
        out.append(_report(name, seen, done))
    out.append(_build_standard(lh) if has_std else StepReport("gold_standard", "skipped"))
    out.append(_build_autoscale(lh, incremental) if has_as else StepReport("gold_autoscale", "skipped"))
    return out


# Orchestration -------------------------------------------------------------------


def side_by_side(lh: T.Lakehouse, branches: dict[str, Callable[[], StepReport]], cancel: bool) -> dict[str, StepReport | Exception]:
    """Run branches in threads of their own, each in a scheduler pool and under
    a job tag of its name. With ``cancel``, the first that fails has the jobs of
    the others cancelled. Returns each branch's report or what it failed with,
    in the order in which they ended."""
    sc = lh.spark.sparkContext
    run = uuid.uuid4().hex[:8]
    tags = {name: f"culedger-{run}-{name}" for name in branches}
    done: dict[str, StepReport | Exception] = {}

    def work(name: str) -> None:
        sc.addJobTag(tags[name])
        sc.setLocalProperty("spark.scheduler.pool", name)
        try:
            done[name] = branches[name]()
        except Exception as ex:
            done[name] = ex

    threads = {name: InheritableThread(target=work, args=(name,)) for name in branches}
    for t in threads.values():
        t.start()
    while any(t.is_alive() for t in threads.values()):
        for name, t in threads.items():
            t.join(0.2)
            # Again and again: a branch may be between two jobs.
            if cancel and t.is_alive() and any(isinstance(x, Exception) for x in list(done.values())):
                sc.cancelJobsWithTag(tags[name])
    return done


def run_pipeline(
    lh: T.Lakehouse,
    capacities_extract: DataFrame,
    metrics_extract: DataFrame,
    version: str,
    standard_extract: DataFrame | None = None,
    autoscale_extract: DataFrame | None = None,
    capacity_id: str | None = None,
    start: str | None = None,
    end: str | None = None,
    load_time_col: str | None = None,
    on_error: str = "fail",
    incremental: bool = False,
) -> list[StepReport]:
    """metrics -> {standard, autoscale} side by side -> gold, built once.

    Each step runs only after its predecessors succeeded; gold only after both
    collectors did. ``on_error``: ``fail`` raises at the first failed step (of
    two collectors, the other is cancelled), ``continue`` records it, lets the
    other collector finish, and skips what depends on it.
    """
    reports: list[StepReport] = []

    def failed(name: str, ex: Exception) -> None:
        reports.append(StepReport(name, "failed", {"error": str(ex)}))

    def step(name, fn, *args, **kw):
        try:
            r = fn(*args, **kw)
        except Exception as ex:
            failed(name, ex)
            if on_error == "fail":
                if isinstance(ex, PrerequisiteError):
                    raise RuntimeError(str(ex)) from ex
                raise
            return False
        reports.extend(r if isinstance(r, list) else [r])
        return True

    ok = step("ingest_capacities", ingest_capacities, lh, capacities_extract, version)
    ok = ok and step("ingest_metrics", ingest_metrics, lh, metrics_extract, version)
    if not ok:
        return reports
    scope = (capacity_id, start, end, load_time_col)
    branches: dict[str, Callable[[], StepReport]] = {}
    if standard_extract is not None:
        branches["ingest_standard_detail"] = lambda: ingest_standard_detail(lh, standard_extract, *scope)
    if autoscale_extract is not None:
        branches["ingest_autoscale_detail"] = lambda: ingest_autoscale_detail(lh, autoscale_extract, *scope)
    results = side_by_side(lh, branches, cancel=on_error == "fail")
    for name in branches:
        if isinstance(results[name], Exception):
            failed(name, results[name])
        else:
            reports.append(results[name])
    broken = [r for r in results.values() if isinstance(r, Exception)]
    if not broken:
        step("build_gold", build_gold, lh, incremental=incremental)
    elif on_error == "fail":
        first = broken[0]  # what others failed with may be their cancelling
        if isinstance(first, PrerequisiteError):
            raise RuntimeError(str(first)) from first
        raise first
    else:
        reports.append(StepReport("build_gold", "skipped", {"reason": "a collector failed"}))
    return reports
