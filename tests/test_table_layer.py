"""What the table layer must not lose, resurrect or rewrite."""

import math
import os
import uuid
from datetime import datetime

import pytest
from conftest import SF0001, rows
from pyspark.sql import functions as F

from culedger.functions.columns import cu_sum
from culedger.operators.running import running_sum, running_sum_single_window
from culedger.plans import analysis, gold
from culedger.plans import tables as T
from culedger.plans.checks import PrerequisiteError, require_rows_in_range
from culedger.plans.pipeline import run_pipeline
from culedger.schemas import TIMEPOINT_KEY
from culedger.sources import fixtures as fx
from culedger.sources.ingest import autoscale_extract, capacity_extract, detail_extract, metrics_extract


@pytest.fixture()
def lh(spark, scratch_dir):
    out = T.Lakehouse(spark, root=scratch_dir, database_prefix=f"l{uuid.uuid4().hex[:8]}_")
    out.create_schemas()
    return out


def points(spark, *xs):
    """Rows (CapacityId, TimePoint, v); a day of January 2024 as TimePoint."""
    data = [(c, None if d is None else datetime(2024, 1, d, 8), float(v)) for c, d, v in xs]
    return spark.createDataFrame(data, "CapacityId string, TimePoint timestamp_ntz, v double")


def got(lh, table=T.SILVER_TIMEPOINTS):
    return sorted(((r["CapacityId"], r["TimePoint"] and r["TimePoint"].day, r["v"]) for r in lh.read(table).collect()), key=str)


def files(root):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))


def test_merge_keeps_null_timepoint_rows(lh, spark):
    lh.merge(T.SILVER_TIMEPOINTS, points(spark, ("A", 1, 1), ("A", None, 2), (None, 2, 3)), TIMEPOINT_KEY, (), "update")
    lh.merge(T.SILVER_TIMEPOINTS, points(spark, ("A", 1, 9), ("B", None, 4)), TIMEPOINT_KEY, (), "update")
    assert got(lh) == sorted([("A", 1, 9.0), ("A", None, 2.0), (None, 2, 3.0), ("B", None, 4.0)], key=str)


def test_refresh_drops_null_and_old_dates_with_their_files(lh, spark):
    lh.append(T.SILVER_TIMEPOINTS, points(spark, ("A", 1, 1), ("A", None, 2), ("A", 3, 3)))
    lh.overwrite(T.SILVER_TIMEPOINTS, points(spark, ("B", 3, 4)))
    assert got(lh) == [("B", 3, 4.0)]
    lh.append(T.SILVER_TIMEPOINTS, points(spark, ("C", 1, 5), ("C", None, 6)))
    assert got(lh) == sorted([("B", 3, 4.0), ("C", 1, 5.0), ("C", None, 6.0)], key=str)


def test_deleted_rows_stay_deleted(lh, spark):
    lh.append(T.SILVER_TIMEPOINTS, points(spark, ("A", 1, 1), ("A", 2, 1), ("B", 2, 2), ("A", None, 1)))
    lh.delete_where(T.SILVER_TIMEPOINTS, F.col("v") == 1)
    assert got(lh) == [("B", 2, 2.0)]
    lh.append(T.SILVER_TIMEPOINTS, points(spark, ("N", 1, 7), ("N", None, 8)))
    assert got(lh) == sorted([("B", 2, 2.0), ("N", 1, 7.0), ("N", None, 8.0)], key=str)


def test_duplicate_source_keys_are_refused_before_any_write(lh, spark):
    lh.merge(T.SILVER_TIMEPOINTS, points(spark, ("A", 1, 1)), TIMEPOINT_KEY, (), "update")
    before = files(lh.root)
    for how in ("update", "insert"):
        with pytest.raises(ValueError, match="duplicate keys"):
            lh.merge(T.SILVER_TIMEPOINTS, points(spark, ("A", 1, 2), ("A", 1, 3)), TIMEPOINT_KEY, (), how)
    assert got(lh) == [("A", 1, 1.0)] and files(lh.root) == before


def test_merge_without_change_writes_nothing_and_leaves_no_staging(lh, spark):
    both = points(spark, ("A", 1, 1), ("B", 2, 2), ("C", 3, 3))
    lh.merge(T.SILVER_TIMEPOINTS, both, TIMEPOINT_KEY, (), "update")
    before = files(lh.root)
    lh.merge(T.SILVER_TIMEPOINTS, both, TIMEPOINT_KEY, (), "update")
    lh.merge(T.SILVER_TIMEPOINTS, both, TIMEPOINT_KEY, (), "insert")
    assert files(lh.root) == before
    lh.merge(T.SILVER_TIMEPOINTS, points(spark, ("B", 2, 5)), TIMEPOINT_KEY, (), "update")
    after = files(lh.root)
    assert [f for f in before if "2024-01-02" not in f] == [f for f in after if "2024-01-02" not in f] and after != before
    lh.merge(T.SILVER_TIMEPOINTS, points(spark, ("D", 2, 6)), TIMEPOINT_KEY, (), "insert")
    assert set(after) < set(files(lh.root)) and not files(f"{lh.root}/_staging")


def test_dates_prune_partitions(lh, spark):
    lh.append(T.SILVER_TIMEPOINTS, points(spark, ("A", 1, 1), ("A", 2, 1), ("A", None, 1)))
    df = T.Lakehouse.on_dates(lh.read(T.SILVER_TIMEPOINTS), [datetime(2024, 1, 2).date(), None])
    plan = df._jdf.queryExecution().executedPlan().toString()
    part = plan[plan.index("PartitionFilters:") :]
    assert "2024-01-02" in part.split("PushedFilters")[0] or "19724" in part.split("PushedFilters")[0], plan
    assert df.count() == 2


def test_merge_adds_source_columns(lh, spark):
    lh.merge(T.SILVER_TIMEPOINTS, points(spark, ("A", 1, 1)), TIMEPOINT_KEY, (), "update")
    lh.merge(T.SILVER_TIMEPOINTS, points(spark, ("B", 1, 2)).withColumn("note", F.lit("x")), TIMEPOINT_KEY, (), "update")
    assert sorted((r["CapacityId"], r["note"]) for r in lh.read(T.SILVER_TIMEPOINTS).collect()) == [("A", None), ("B", "x")]


def test_only_folders_under_the_root_are_deleted(lh):
    with pytest.raises(ValueError, match="not under"):
        lh._delete_folder("/tmp/somewhere-else")


def test_sums_lose_nothing(spark):
    small = spark.range(1000).select(F.lit(4e-7).alias("v"))
    assert math.isclose(small.agg(cu_sum("v")).first()[0], 4e-4, rel_tol=1e-9)
    odd = spark.createDataFrame([("n", float("nan")), ("n", 1.0), ("b", 1e20), ("b", 1.5), ("h", 1e30), ("h", 1.0), ("0", None), ("x", 0.1), ("x", 0.2)], "g string, v double")
    sums = {r["g"]: r["s"] for r in odd.groupBy("g").agg(cu_sum("v").alias("s")).collect()}
    assert math.isnan(sums["n"]) and sums["b"] == 1e20 and sums["h"] == 1e30 and sums["0"] is None and sums["x"] == 0.3
    rows_ = spark.createDataFrame([("a", t, k, v) for t, k, v in ((1, 1, 4e-7), (1, 2, None), (2, 1, 0.1), (2, 2, 1e30), (3, 1, float("nan")), (4, 1, 1.0))], "g string, t int, k int, v double")
    split = running_sum(rows_, ["g"], ["t", "k"], "v", "acc")
    whole = running_sum_single_window(rows_, ["g"], ["t", "k"], "v", "acc")
    assert str(rows(split)) == str(rows(whole))  # NaN as text
    acc = [r["acc"] for r in split.orderBy("t", "k").collect()]
    assert math.isclose(acc[0], 4e-7) and math.isclose(acc[1], 4e-7) and math.isclose(acc[2], 0.1000004) and acc[3] == 1e30 and math.isnan(acc[5])


def test_incremental_gold_sees_equal_earlier_and_null_load_times(spark):
    silver = fx.silver_autoscale(spark, SF0001)
    old = gold.gold_autoscale_source(silver.filter("SumCU_s < 50"))
    top = old.agg(F.max("insert_date")).first()[0]
    late = silver.filter("SumCU_s >= 50").withColumn("insert_date", F.when(F.col("SumCU_s") < 60, F.lit(None)).when(F.col("SumCU_s") < 80, F.lit(top)).otherwise(F.lit(datetime(2000, 1, 1))).cast("timestamp_ntz"))
    now = silver.filter("SumCU_s < 50").unionByName(late)
    merged = gold.merge_gold_autoscale_rows(old, gold.gold_autoscale_incremental(now, old))
    assert rows(merged) == rows(gold.merge_gold_autoscale(old, now))


def extracts(spark):
    return dict(
        capacities_extract=capacity_extract(fx.silver_capacities(spark, SF0001), "v53"),
        metrics_extract=metrics_extract(fx.silver_timepoints(spark, SF0001), "v53"),
        standard_extract=detail_extract(fx.silver_detail(spark, SF0001)),
        autoscale_extract=autoscale_extract(fx.silver_autoscale(spark, SF0001)),
    )


def test_pipeline_rules(lh, spark):
    window = dict(start="01 January 2024 00:00", end="31 January 2024 23:59")
    broken = extracts(spark)
    broken["standard_extract"] = broken["standard_extract"].drop("c03")
    reports = {r.name: r for r in run_pipeline(lh, version="v53", load_time_col="load_time", on_error="continue", **window, **broken)}
    assert reports["ingest_standard_detail"].status == "failed" and reports["ingest_autoscale_detail"].status == "ok"
    assert reports["build_gold"].status == "skipped" and not lh.exists(T.GOLD_CAPACITIES)
    with pytest.raises(PrerequisiteError, match="missing"):
        analysis.lakehouse_views(lh)
    reports = run_pipeline(lh, version="v53", load_time_col="load_time", capacity_id="cap-01", **window, **extracts(spark))
    assert all(r.status == "ok" for r in reports)
    assert {r[0] for r in lh.read(T.GOLD_TP_METRICS).select("CapacityId").distinct().collect()} == {"CAP-01"}
    assert analysis.top_items(analysis.lakehouse_views(lh, "cap-01"), 5).count() == 5
    require_rows_in_range(lh.read(T.SILVER_TIMEPOINTS), "cap-01", window["start"], window["end"])
    assert not files(f"{lh.root}/_staging")


def test_appended_files_are_seen_in_the_same_session(spark, scratch_dir):
    for t in ("events", "customer", "part"):
        spark.read.parquet(f"{SF0001}/{t}.parquet").write.parquet(f"{scratch_dir}/{t}.parquet")
    before = fx.operations(spark, scratch_dir).count()
    spark.read.parquet(f"{SF0001}/events.parquet").limit(50).write.mode("append").parquet(f"{scratch_dir}/events.parquet")
    assert fx.operations(spark, scratch_dir).count() == before + 50


# Layout ------------------------------------------------------------------------


def day_files(lh, table):
    return {str(r["Date"]): r["files"] for r in lh.layout(table).collect()}


@pytest.fixture()
def small_files(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    yield
    spark.conf.set(key, before)


def skewed(spark, n=60_000):
    """Nine of ten rows lie on one date, the others on 20."""
    day = F.when(F.col("id") % 10 != 0, 0).otherwise(1 + F.floor(F.col("id") / 10) % 20)
    at = F.expr("timestamp_ntz'2024-01-01 08:00:00'") + F.make_dt_interval(day.cast("int"), F.lit(0), F.lit(0), (F.col("id") / 1000).cast("decimal(10,3)"))
    return spark.range(0, n, 1, 24).select(F.sha2(F.col("id").cast("string"), 256).alias("CapacityId"), at.alias("TimePoint"), F.rand(7).alias("v"))


def test_files_follow_the_size_of_a_date(lh, spark, small_files):
    lh.append(T.SILVER_TIMEPOINTS, skewed(spark))
    n = day_files(lh, T.SILVER_TIMEPOINTS)
    hot = n.pop("2024-01-01")
    assert hot >= 10 and len(n) == 20 and sum(n.values()) <= 2 * len(n), (hot, n)
    # an updating merge and a refresh lay out what they rewrite alike
    lh.merge(T.SILVER_TIMEPOINTS, skewed(spark).withColumn("v", F.lit(1.0)), TIMEPOINT_KEY, (), "update")
    n = day_files(lh, T.SILVER_TIMEPOINTS)
    assert n["2024-01-01"] >= 6 and sum(n.values()) - n["2024-01-01"] <= 40
    assert lh.read(T.SILVER_TIMEPOINTS).filter("v = 1.0").count() == 60_000


def test_compaction_rewrites_only_dates_in_too_many_files(lh, spark, small_files):
    lh.append(T.SILVER_TIMEPOINTS, skewed(spark, 30_000))
    before = files(lh.root)
    assert lh.compact(T.SILVER_TIMEPOINTS) == [] and files(lh.root) == before
    for i in range(8):
        lh.append(T.SILVER_TIMEPOINTS, points(spark, (f"C{i}", 3, i)))
    count = lh.read(T.SILVER_TIMEPOINTS).count()
    assert [str(d) for d in lh.compact(T.SILVER_TIMEPOINTS)] == ["2024-01-03"]
    assert day_files(lh, T.SILVER_TIMEPOINTS)["2024-01-03"] <= 2 and lh.read(T.SILVER_TIMEPOINTS).count() == count
    assert [f for f in before if "2024-01-03" not in f] == [f for f in files(lh.root) if "2024-01-03" not in f]


# Merge -------------------------------------------------------------------------


def explained(df):
    return df._jdf.queryExecution().executedPlan().toString()


def under(plan, first):
    """The lines of the plan below the join's first side."""
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if first in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    side = [lines[at + 1]]
    for x in lines[at + 2 :]:
        if depth(x) <= depth(lines[at + 1]):
            break
        side.append(x)
    return "\n".join(side)


def test_a_bucketed_target_is_not_shuffled(spark, scratch_dir):
    keys = (["CapacityId", "TimePoint"], ["Unique_key", "Operation", "Operation_Id", "Operation_start_time", "Operation_end_time"])
    lh = T.Lakehouse(spark, root=scratch_dir, database_prefix=f"b{uuid.uuid4().hex[:8]}_", buckets={T.GOLD_TP_METRICS: (4, keys[0])})
    lh.create_schemas()
    g = gold.gold_standard_source(fx.silver_detail(spark, SF0001))
    lh.merge(T.GOLD_TP_METRICS, g, *keys, "insert")
    source = g.filter("SumDuration_s > 40").withColumn("SumTotal_CU_s", F.lit(-1.0))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        with lh._staged(T.GOLD_TP_METRICS, T.with_date(source)) as (staged, _, dates):
            target = lh.on_dates(lh.read(T.GOLD_TP_METRICS), dates)
            plan = explained(lh.merged(T.GOLD_TP_METRICS, target, staged, *keys))
            side = under(plan, "SortMergeJoin")
            assert "Bucketed: true" in side and "Exchange" not in side, plan
            assert "Exchange" not in plan.split("SortMergeJoin")[0], plan  # nor is what the merge writes
            plan = explained(lh.changes(T.GOLD_TP_METRICS, staged, target, *keys))
            assert plan.count("Exchange") == 2 and "Bucketed: true" in plan, plan  # the source, and counts by date
        done = lh.merge(T.GOLD_TP_METRICS, source, *keys, "update")
    finally:
        spark.conf.set(key, before)
    assert done.updated == source.count() and done.inserted == 0
    after = lh.read(T.GOLD_TP_METRICS)
    assert after.count() == g.count() and after.filter("SumTotal_CU_s = -1.0").count() == source.count()


def test_the_guard_is_part_of_the_merge(lh, spark):
    lh.merge(T.SILVER_TIMEPOINTS, points(spark, ("A", 1, 1), ("B", 2, 2)), TIMEPOINT_KEY, (), "update")
    rows_ = T.with_date(points(spark, ("A", 1, 5)))
    plan = explained(lh.changes(T.SILVER_TIMEPOINTS, rows_, lh.read(T.SILVER_TIMEPOINTS), TIMEPOINT_KEY))
    assert "raise_error" in plan and plan.count("Window ") == 1
    tracker = spark.sparkContext.statusTracker()

    def jobs(source):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, "merge")
        try:
            lh.merge(T.SILVER_TIMEPOINTS, source, TIMEPOINT_KEY, (), "insert")
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))

    before = files(lh.root)
    with pytest.raises(ValueError, match="duplicate keys .CapacityId, TimePoint.: A, 2024-01-01"):
        lh.merge(T.SILVER_TIMEPOINTS, points(spark, ("A", 1, 2), ("A", 1, 3)), TIMEPOINT_KEY, (), "insert")
    assert files(lh.root) == before
    # staging, and the one job that checks, compares and writes (with its shuffles)
    assert jobs(points(spark, ("C", 1, 2))) <= 5


def test_writes_report_what_they_did(lh, spark):
    first = lh.merge(T.SILVER_TIMEPOINTS, points(spark, ("A", 1, 1), ("A", None, 2), ("B", 2, 3)), TIMEPOINT_KEY, (), "update")
    assert first.counts() == {"read": 3, "inserted": 3, "updated": 0, "deleted": 0}
    done = lh.merge(T.SILVER_TIMEPOINTS, points(spark, ("A", 1, 9), ("B", 2, 3), ("A", None, 2), ("C", 3, 4)), TIMEPOINT_KEY, (), "update")
    assert done.counts() == {"read": 4, "inserted": 2, "updated": 1, "deleted": 0} and len(done.dates) == 3
    assert lh.merge(T.SILVER_TIMEPOINTS, points(spark, ("A", 1, 5), ("D", 1, 1)), TIMEPOINT_KEY, (), "insert").counts() == {"read": 2, "inserted": 1, "updated": 0, "deleted": 0}
    assert lh.delete_where(T.SILVER_TIMEPOINTS, F.col("v") < 4).deleted == 4
    assert got(lh) == [("A", 1, 9.0), ("C", 3, 4.0)]


def test_a_failed_redefinition_loses_nothing(lh, spark):
    lh.append(T.SILVER_TIMEPOINTS, points(spark, ("A", 1, 1), ("B", None, 2)))
    bad = points(spark, ("A", 1, 1), ("C", 2, 2)).select("CapacityId", "TimePoint", F.when(F.col("v") < 2, F.col("v").cast("string")).otherwise(F.raise_error(F.lit("broken")).cast("string")).alias("v"))
    with pytest.raises(Exception, match="broken"):
        lh.overwrite(T.SILVER_TIMEPOINTS, bad)
    assert got(lh) == sorted([("A", 1, 1.0), ("B", None, 2.0)], key=str)
    lh.overwrite(T.SILVER_TIMEPOINTS, lh.read(T.SILVER_TIMEPOINTS).select("CapacityId", "TimePoint", F.concat(F.lit("x"), "v").alias("v")))
    assert sorted(r["v"] for r in lh.read(T.SILVER_TIMEPOINTS).collect()) == ["x1.0", "x2.0"]
    lh.merge(T.SILVER_TIMEPOINTS, points(spark, ("A", 1, 1)).select("CapacityId", "TimePoint", F.lit("y").alias("v")), TIMEPOINT_KEY, (), "update")
    assert sorted(r["v"] for r in lh.read(T.SILVER_TIMEPOINTS).collect()) == ["x2.0", "y"]
