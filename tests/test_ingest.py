"""Version adapter, capacity ingest, detail ingest, work lists, date spines."""

from datetime import date, datetime

import pytest
from conftest import SF0001, rows
from pyspark.sql import functions as F

from culedger.schemas import METRIC_COLUMNS, METRIC_MEASURES, MEASURES_V37, METRIC_QUERY_ALIASES
from culedger.sources import fixtures as fx
from culedger.sources.ingest import (
    ExtractSchemaError,
    capacities_from_extract,
    capacity_extract,
    detail_extract,
    ingest_detail,
    metrics_extract,
    metrics_from_extract,
)
from culedger.sources.worklist import capacity_date_spine, timepoint_parts, worklist


def test_metrics_adapter_all_header_styles(spark):
    tp = fx.silver_timepoints(spark, SF0001)
    want = rows(tp)
    for version in ["v53", "v47", "v44", "v40", "v37"]:
        got = metrics_from_extract(metrics_extract(tp, version, by="measure"), version)
        assert got.columns == METRIC_COLUMNS
        assert rows(got) == want
        got = metrics_from_extract(metrics_extract(tp, version, by="alias"), version)
        assert rows(got) == want


def test_metrics_adapter_rejects_unknown_and_missing(spark):
    tp = fx.silver_timepoints(spark, SF0001)
    ex = metrics_extract(tp, "v53")
    with pytest.raises(ExtractSchemaError):
        metrics_from_extract(ex.withColumn("surprise", F.lit(1)), "v53")
    with pytest.raises(ExtractSchemaError):
        metrics_from_extract(ex.drop(ex.columns[5]), "v53")
    # v37 names are not accepted as v53
    with pytest.raises(ExtractSchemaError):
        metrics_from_extract(metrics_extract(tp, "v37"), "v53")
    with pytest.raises(ValueError):
        metrics_from_extract(ex, "v99")
    assert len(MEASURES_V37) == len(METRIC_MEASURES) == len(METRIC_QUERY_ALIASES)


def test_capacity_versions_and_lower_case_ids(spark):
    caps = fx.silver_capacities(spark, SF0001).withColumn("CapacityId", F.lower("CapacityId"))
    v53 = capacities_from_extract(capacity_extract(caps, "v53"), "v53")
    v47 = capacities_from_extract(capacity_extract(caps, "v47"), "v47")
    assert all(r["CapacityId"] == r["CapacityId"].upper() for r in v53.collect())
    assert v47.filter(F.col("CapacityName").isNotNull()).count() == 0
    assert v53.filter(F.col("CapacityName").isNull()).count() == 0
    with pytest.raises(ExtractSchemaError):
        capacities_from_extract(capacity_extract(caps, "v47"), "v53")


def test_detail_ingest_stamps_units_and_dedupes(spark):
    silver = fx.silver_detail(spark, SF0001)
    raw = detail_extract(silver)
    out = ingest_detail(raw, "standard", "load_time")
    assert out.filter(F.col("CapacityId") != F.upper("CapacityId")).count() == 0
    assert out.filter(F.col("Operation_Id").isNull()).count() == 0
    # redelivered rows collapse to one per K7
    assert out.count() == silver.count() - silver.filter(F.col("insert_date") != F.col("insert_date")).count() - fx.operations(spark, SF0001).filter(F.col("event_id") % 5 == 0).count()
    with pytest.raises(ExtractSchemaError):
        ingest_detail(raw.drop("c00"), "standard", "load_time")
    # clock load time when no column is given
    assert ingest_detail(raw.drop("load_time"), "standard").filter(F.col("insert_date").isNull()).count() == 0


def test_worklist_autoscale_drops_half_minutes_newest_first(spark):
    tp = fx.silver_timepoints(spark, SF0001)
    wl = worklist(tp, "CAP-01", "05 January 2024 00:00", "20 January 2024 23:59", autoscale=True).collect()
    assert all(r["TimePoint"].second != 30 for r in wl)
    assert [r["TimePoint"] for r in wl] == sorted((r["TimePoint"] for r in wl), reverse=True)
    assert {r["CapacityId"] for r in wl} == {"CAP-01"}


def test_date_spine_and_parts(spark):
    tp = fx.silver_timepoints(spark, SF0001)
    spine = capacity_date_spine(tp)
    n_days = {r[0]: r[1] for r in spine.groupBy("CapacityId").count().collect()}
    span = {r[0]: (r[2] - r[1]).days + 1 for r in tp.groupBy("CapacityId").agg(F.to_date(F.min("TimePoint")), F.to_date(F.max("TimePoint"))).collect()}
    assert n_days == span
    parts = timepoint_parts(worklist(tp, None, "01 January 2024 00:00", "31 January 2024 23:59")).collect()
    assert all(r["RebuiltTimePoint"] == r["TimePoint"] for r in parts)
    r = parts[0]
    t: datetime = r["TimePoint"]
    assert r["TimepointExpression"] == f"DATE({t.year}, {t.month}, {t.day}) + TIME({t.hour}, {t.minute}, {t.second})"
