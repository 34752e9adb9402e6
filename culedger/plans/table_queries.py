"""Registered queries that go through catalog tables: each makes a table of
its own from the first run's rows, applies the second run through
:class:`~culedger.plans.tables.Lakehouse`, and reads it back. Rows with a NULL
TimePoint (SumDuration_s = 17) are among both runs. What a query returns is
checkpointed in the shared folder (Spark's cleaner removes it when it is no
longer referenced), and its tables go at once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from culedger.functions.columns import half_minute_by_format
from culedger.operators.dedupe import dedupe_latest
from culedger.operators.joins import pruned_star
from culedger.plans import balances, gold
from culedger.plans import scenario as S
from culedger.plans import tables as T
from culedger.plans.sql_functions import create_functions
from culedger.schemas import K7, K7_EQ, K7_NULL_SAFE
from culedger.session import work_path
from culedger.sources import fixtures as fx


def _lakehouse(spark: SparkSession, **how) -> T.Lakehouse:
    own = uuid.uuid4().hex[:12]
    lh = T.Lakehouse(spark, root=work_path(spark, "table-queries", own), database_prefix=f"q{own}_", **how)
    lh.create_schemas()
    return lh


def _result(lh: T.Lakehouse, df: DataFrame) -> DataFrame:
    """``df`` cut off from the lakehouse's tables, which are dropped."""
    out = df.checkpoint()
    lh.drop_all()
    return out


def _raw_runs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    d = fx.silver_detail(spark, sf)
    d = d.withColumn("TimePoint", F.when(F.col("SumDuration_s") == 17, F.lit(None)).otherwise(F.col("TimePoint")))
    bound = lambda text: F.to_timestamp_ntz(F.lit(text))
    return d.filter(F.col("insert_date") < bound(S.RUN1_BEFORE)), d.filter(F.col("insert_date") >= bound(S.RUN2_FROM))


def _runs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    first, second = _raw_runs(spark, sf)
    return dedupe_latest(first, K7), dedupe_latest(second, K7)


def _merged(spark, sf, when_matched: str, **how) -> DataFrame:
    lh, (first, second) = _lakehouse(spark, **how), _runs(spark, sf)
    lh.merge(T.SILVER_TP_METRICS, first, K7_EQ, K7_NULL_SAFE, when_matched)
    lh.merge(T.SILVER_TP_METRICS, second, K7_EQ, K7_NULL_SAFE, when_matched)
    return _result(lh, lh.read(T.SILVER_TP_METRICS).drop(T.PARTITION_COL))


def table_merge_update(spark, sf):
    return _merged(spark, sf, "update")


def table_merge_insert(spark, sf):
    return _merged(spark, sf, "insert")


def table_merge_bucketed(spark, sf):
    """The update merge over a table bucketed on its ``=`` keys: the target is
    joined as its buckets lie."""
    return _merged(spark, sf, "update", buckets={T.SILVER_TP_METRICS: (8, K7_EQ)})


def table_write_counts(spark, sf):
    """What the second run's load reports: rows read, dropped as duplicates,
    inserted and updated, and rows that the half-minute delete removed."""
    lh, seen = _lakehouse(spark), Observation()
    lh.merge(T.SILVER_TP_METRICS, _runs(spark, sf)[0], K7_EQ, K7_NULL_SAFE, "update")
    raw = _raw_runs(spark, sf)[1].observe(seen, F.count(F.lit(1)).alias("rows"))
    done = lh.merge(T.SILVER_TP_METRICS, dedupe_latest(raw, K7), K7_EQ, K7_NULL_SAFE, "update")
    gone = lh.delete_where(T.SILVER_TP_METRICS, half_minute_by_format("TimePoint"))
    read = seen.get["rows"]
    lh.drop_all()
    row = (read, read - done.read, done.inserted, done.updated, gone.deleted)
    return spark.createDataFrame([row], "read_rows long, duplicates long, inserted long, updated long, deleted long")


def table_delete_half_minute(spark, sf):
    lh, (first, _) = _lakehouse(spark), _runs(spark, sf)
    lh.append(T.SILVER_TP_METRICS, first)
    lh.delete_where(T.SILVER_TP_METRICS, half_minute_by_format("TimePoint"))
    return _result(lh, lh.read(T.SILVER_TP_METRICS).drop(T.PARTITION_COL))


def table_refresh(spark, sf):
    lh, (first, second) = _lakehouse(spark), _runs(spark, sf)
    lh.overwrite(T.SILVER_TP_METRICS, first)
    lh.overwrite(T.SILVER_TP_METRICS, second)
    return _result(lh, lh.read(T.SILVER_TP_METRICS).drop(T.PARTITION_COL))


def table_append(spark, sf):
    lh, (first, second) = _lakehouse(spark), _runs(spark, sf)
    lh.append(T.SILVER_TP_METRICS, first)
    lh.append(T.SILVER_TP_METRICS, second)
    return _result(lh, lh.read(T.SILVER_TP_METRICS).drop(T.PARTITION_COL))


def gold_capacities(spark, sf):
    """Gold capacities by full refresh of a table that an earlier run filled."""
    lh = _lakehouse(spark)
    lh.overwrite(T.GOLD_CAPACITIES, gold.gold_capacities(fx.active_capacities(spark, sf)))
    lh.overwrite(T.GOLD_CAPACITIES, gold.gold_capacities(fx.silver_capacities(spark, sf)))
    return _result(lh, lh.read(T.GOLD_CAPACITIES))


def carried_balances(spark, sf):
    """Gold autoscale after the second run's load, from stored balances: the
    dates that it touches are accumulated, later ones shifted. The oracle is
    the full rebuild."""
    lh, a = _lakehouse(spark), fx.silver_autoscale(spark, sf)
    bound = lambda text: F.to_timestamp_ntz(F.lit(text))
    first, second = a.filter(F.col("insert_date") < bound(S.RUN1_BEFORE)), a.filter(F.col("insert_date") >= bound(S.RUN2_FROM))
    lh.merge(T.SILVER_TP_METRICS_AS, dedupe_latest(first, K7), K7_EQ, K7_NULL_SAFE, "update")
    lh.merge(T.GOLD_TP_METRICS_AS, gold.gold_autoscale_source(lh.read(T.SILVER_TP_METRICS_AS)), K7_EQ, K7_NULL_SAFE, "update")
    balances.start(lh)
    lh.merge(T.SILVER_TP_METRICS_AS, dedupe_latest(second, K7), K7_EQ, K7_NULL_SAFE, "update", note=lambda dates: lh.mark(T.SILVER_TP_METRICS_AS, dates))
    dates, notes = lh.marked(T.SILVER_TP_METRICS_AS)
    balances.carry_forward(lh, dates)
    lh.clear(notes)
    return _result(lh, lh.read(T.GOLD_TP_METRICS_AS).drop(T.PARTITION_COL))


def star_facts_pruned(spark, sf):
    """Fact rows at busy timepoints, from a table that is read only on the dates
    that have any. Rows with a NULL TimePoint are in the table."""
    lh, tp = _lakehouse(spark), fx.silver_timepoints(spark, sf)
    detail = fx.silver_detail(spark, sf)
    undated = detail.filter("SumDuration_s = 17").withColumn("TimePoint", F.lit(None).cast("timestamp_ntz"))
    lh.append(T.GOLD_TP_METRICS, gold.gold_standard_source(detail.unionByName(undated)))
    lh.append(T.GOLD_METRICS_BY_TIMEPOINT, tp)
    busy = lh.read(T.GOLD_METRICS_BY_TIMEPOINT).filter(F.col("TotalCUs") >= S.BUSY_CU)
    return _result(lh, pruned_star(lh.read(T.GOLD_TP_METRICS), gold.gold_calendar_source(tp), fx.silver_capacities(spark, sf), busy))


def sql_top_items(spark, sf):
    """The top items of a capacity and window, by the SQL table function."""
    lh = _lakehouse(spark)
    lh.append(T.GOLD_TP_METRICS, gold.gold_standard_source(fx.silver_detail(spark, sf)))
    lh.append(T.GOLD_METRICS_BY_TIMEPOINT, fx.silver_timepoints(spark, sf))
    create_functions(lh)
    start, finish = S.FILTER_WINDOW
    call = f"{lh.prefix}top_items(n => {S.TOP_N}, capacity => '{S.CI_CAPACITY_ID}', window_start => '{start}', window_end => '{finish}')"
    return _result(lh, spark.sql(f"SELECT * FROM {call}"))


TABLE_QUERIES = {f.__name__: f for f in (table_merge_update, table_merge_insert, table_merge_bucketed, table_write_counts, table_delete_half_minute, table_refresh, table_append, gold_capacities, carried_balances, star_facts_pruned, sql_top_items)}
