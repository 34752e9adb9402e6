"""Catalog-table behaviours and run-time guards."""

import uuid

import pytest
from conftest import SF0001, rows
from pyspark.sql import functions as F

from culedger.plans import analysis, gold
from culedger.plans import tables as T
from culedger.plans.checks import PrerequisiteError, require_rows_in_range, require_tables, rows_in_range, table_ready
from culedger.sources import fixtures as fx


def _lh(spark, scratch_dir, tag):
    lh = T.Lakehouse(spark, root=scratch_dir, database_prefix=f"{tag}{uuid.uuid4().hex[:6]}_")
    lh.create_schemas()
    return lh


def test_append_adds_columns_and_overwrite_keeps_old_ones(spark, scratch_dir):
    lh = _lh(spark, scratch_dir, "a")
    caps = fx.silver_capacities(spark, SF0001)
    lh.append(T.SILVER_CAPACITIES, caps.limit(3))
    lh.append(T.SILVER_CAPACITIES, caps.limit(2).withColumn("Sku", F.lit("F64")))
    got = lh.read(T.SILVER_CAPACITIES)
    assert "Sku" in got.columns and got.count() == 5
    assert got.filter(F.col("Sku").isNotNull()).count() == 2
    # full refresh without the new column keeps it, as NULL
    lh.overwrite(T.SILVER_CAPACITIES, caps)
    got = lh.read(T.SILVER_CAPACITIES)
    assert "Sku" in got.columns and got.filter(F.col("Sku").isNotNull()).count() == 0
    assert got.count() == caps.count()


def test_merge_touches_only_source_dates(spark, scratch_dir):
    lh = _lh(spark, scratch_dir, "m")
    g = gold.gold_standard_source(fx.silver_detail(spark, SF0001))
    keys = (["CapacityId", "TimePoint"], ["Unique_key", "Operation", "Operation_Id", "Operation_start_time", "Operation_end_time"])
    lh.merge(T.GOLD_TP_METRICS, g, *keys, "insert")
    before = rows(lh.read(T.GOLD_TP_METRICS))
    # a source for one day, with changed values: update replaces only matches
    day = g.filter(F.to_date("TimePoint") == F.lit("2024-01-05").cast("date")).withColumn("SumTotal_CU_s", F.lit(-1.0))
    lh.merge(T.GOLD_TP_METRICS, day, *keys, "update")
    after = lh.read(T.GOLD_TP_METRICS)
    assert after.count() == len(before)
    assert after.filter(F.col("SumTotal_CU_s") == -1.0).count() == day.count()
    assert after.filter((F.col("SumTotal_CU_s") == -1.0) & (F.col("Date") != F.lit("2024-01-05").cast("date"))).count() == 0


def test_delete_where_rewrites_hit_dates_only(spark, scratch_dir):
    lh = _lh(spark, scratch_dir, "d")
    a = gold.gold_autoscale_source(fx.silver_autoscale(spark, SF0001), drop_half=False)
    keys = (["CapacityId", "TimePoint"], ["Unique_key", "Operation", "Operation_Id", "Operation_start_time", "Operation_end_time"])
    lh.merge(T.GOLD_TP_METRICS_AS, a, *keys, "update")
    half = a.filter(F.second("TimePoint") == 30).count()
    assert half > 0
    from culedger.functions.columns import half_minute_by_text

    lh.delete_where(T.GOLD_TP_METRICS_AS, half_minute_by_text("TimePoint"))
    got = lh.read(T.GOLD_TP_METRICS_AS)
    assert got.filter(F.second("TimePoint") == 30).count() == 0
    assert got.count() == a.count() - half


def test_checks(spark, scratch_dir):
    lh = _lh(spark, scratch_dir, "c")
    with pytest.raises(PrerequisiteError):
        table_ready(spark, lh.name(T.SILVER_CAPACITIES), required=True)
    assert table_ready(spark, lh.name(T.SILVER_TP_METRICS), required=False) is False
    lh.append(T.SILVER_CAPACITIES, fx.silver_capacities(spark, SF0001).limit(0))
    assert table_ready(spark, lh.name(T.SILVER_CAPACITIES)) is False  # exists but empty
    with pytest.raises(PrerequisiteError):
        require_tables(spark, [lh.name(T.GOLD_TP_METRICS)])
    tp = fx.silver_timepoints(spark, SF0001)
    assert rows_in_range(tp, "CAP-01", "01 January 2024 00:00", "31 January 2024 23:59").first()["n"] > 0
    require_rows_in_range(tp, "CAP-01", "01 January 2024 00:00", "31 January 2024 23:59")
    with pytest.raises(PrerequisiteError):
        require_rows_in_range(tp, "CAP-01", "01 March 2024 00:00", "02 March 2024 00:00")


def test_named_views_answer_sql(spark):
    std = gold.gold_standard_source(fx.silver_detail(spark, SF0001))
    v = analysis.views(std, None, fx.silver_timepoints(spark, SF0001), capacity_id="CAP-01")
    analysis.register_views(v)
    n = spark.sql(f"SELECT COUNT(*) AS n FROM {analysis.VIEW_NAMES['standard']}").first()["n"]
    assert n == std.filter(F.col("CapacityId") == "CAP-01").count()
    m = spark.sql(f"SELECT COUNT(DISTINCT CapacityId) AS c FROM {analysis.VIEW_NAMES['metrics']}").first()["c"]
    assert m == 1


def test_failed_replace_leaves_table_as_it_was(spark, scratch_dir):
    from culedger.schemas import CAPACITY_KEY

    lh = _lh(spark, scratch_dir, "r")
    caps = fx.silver_capacities(spark, SF0001)
    lh.merge(T.SILVER_CAPACITIES, caps.limit(3), CAPACITY_KEY, (), "insert")
    before = rows(lh.read(T.SILVER_CAPACITIES))
    first_home = lh.location(T.SILVER_CAPACITIES)
    # a source that fails while the new version is being written
    bad = caps.withColumn(caps.columns[-1], F.raise_error(F.lit("lost mid-write")).cast(caps.schema[caps.columns[-1]].dataType))
    with pytest.raises(Exception):
        lh.merge(T.SILVER_CAPACITIES, bad, CAPACITY_KEY, (), "insert")
    assert lh.exists(T.SILVER_CAPACITIES)
    assert rows(lh.read(T.SILVER_CAPACITIES)) == before
    with pytest.raises(Exception):
        lh.overwrite(T.SILVER_CAPACITIES, bad)
    assert rows(lh.read(T.SILVER_CAPACITIES)) == before
    assert lh.location(T.SILVER_CAPACITIES) == first_home
    # the rerun with a good source swaps in a new version; the old one goes
    # only by an explicit call, and the table reads the same
    lh.merge(T.SILVER_CAPACITIES, caps, CAPACITY_KEY, (), "insert")
    assert lh.read(T.SILVER_CAPACITIES).count() == caps.count()
    assert lh.location(T.SILVER_CAPACITIES) != first_home
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(first_home)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert fs.exists(p)
    lh.remove_old_versions(T.SILVER_CAPACITIES)
    assert not fs.exists(p) and lh.read(T.SILVER_CAPACITIES).count() == caps.count()


def test_partitioned_full_refresh_keeps_table_and_drops_old_dates(spark, scratch_dir):
    lh = _lh(spark, scratch_dir, "p")
    g = gold.gold_standard_source(fx.silver_detail(spark, SF0001))
    keys = (["CapacityId", "TimePoint"], ["Unique_key", "Operation", "Operation_Id", "Operation_start_time", "Operation_end_time"])
    lh.merge(T.GOLD_TP_METRICS, g, *keys, "insert")
    home = lh.location(T.GOLD_TP_METRICS)
    day = g.filter(F.to_date("TimePoint") == F.lit("2024-01-05").cast("date")).withColumn("Note", F.lit("x"))
    assert day.count() > 0
    lh.overwrite(T.GOLD_TP_METRICS, day)
    got = lh.read(T.GOLD_TP_METRICS)
    assert lh.location(T.GOLD_TP_METRICS) == home
    assert got.count() == day.count()
    assert [r[0] for r in got.select("Date").distinct().collect()] == [r[0] for r in day.select(F.to_date("TimePoint")).distinct().collect()]
    assert "Note" in got.columns and got.filter(F.col("Note") == "x").count() == day.count()
