"""Staged store, per-unit fan-out with error capture, and the streaming
stage-then-merge."""

import uuid
from datetime import datetime

import pandas as pd
import pytest
from conftest import SF0001, rows
from pyspark.sql import functions as F

from culedger.plans import tables as T
from culedger.schemas import DETAIL_EXTRACT_COLUMNS, TIMEPOINT_METRICS
from culedger.sources import fixtures as fx
from culedger.sources.fanout import fanout
from culedger.sources.ingest import detail_extract, ingest_detail
from culedger.sources.staging import StagedStore, UnitStore
from culedger.sources.worklist import worklist
from culedger.streaming.staged_merge import start_staged_merge


def test_staged_store_empty_then_batches(spark, scratch_dir):
    from pyspark.sql.types import StructType

    schema = StructType(TIMEPOINT_METRICS.fields)
    store = StagedStore(spark, "t", schema, path=scratch_dir + "/stage")
    assert store.read().count() == 0 and store.read().schema == schema
    d = fx.silver_detail(spark, SF0001)
    store.append(d.filter(F.col("CapacityId") == "CAP-00"))
    store.append(d.filter(F.col("CapacityId") != "CAP-00"))
    store.append(d.limit(0))
    assert rows(store.read()) == rows(d.select(*schema.fieldNames()))
    store.delete()
    assert store.read().count() == 0


def test_fanout_calls_each_unit_once_and_keeps_errors(spark, scratch_dir):
    from pyspark.sql.types import StructType

    extract_schema = StructType([f for f in TIMEPOINT_METRICS.fields if f.name in DETAIL_EXTRACT_COLUMNS])
    tp = fx.silver_timepoints(spark, SF0001)
    wl = worklist(tp, "CAP-01", "05 January 2024 00:00", "10 January 2024 23:59", ordered=False)
    units = wl.count()

    def fetch(cap, timepoint):
        if timepoint.minute % 7 == 0:
            raise ConnectionError("model unavailable")
        row = {c: None for c in DETAIL_EXTRACT_COLUMNS}
        row.update(Operation="op", Unique_key="k", SumTotal_CU_s=1.5, SumDuration_s=2.0, IsGrandTotalRowTotal=False,
                   Operation_start_time=timepoint, Operation_end_time=timepoint)
        return pd.DataFrame([row, dict(row, Operation="op2")])[DETAIL_EXTRACT_COLUMNS]

    store = StagedStore(spark, "fan", None, path=scratch_dir + "/fan")
    from culedger.sources.fanout import ERROR_FIELD, UNIT_COLUMNS

    store.schema = StructType(list(extract_schema.fields) + UNIT_COLUMNS + [ERROR_FIELD])
    ok, errors = fanout(wl, fetch, extract_schema, parallelism=4, store=store)
    n_err = wl.filter(F.minute("TimePoint") % 7 == 0).count()
    assert errors.count() == n_err
    assert ok.count() == 2 * (units - n_err)
    assert set(r[0] for r in errors.select("fetch_error").distinct().collect()) == {"ConnectionError: model unavailable"}
    silver = ingest_detail(ok, "standard")
    assert silver.filter(F.col("CapacityId") != "CAP-01").count() == 0


def test_streaming_stage_then_merge(spark, scratch_dir):
    lh = T.Lakehouse(spark, root=scratch_dir + "/lh", database_prefix=f"s{uuid.uuid4().hex[:6]}_")
    raw = detail_extract(fx.silver_detail(spark, SF0001))
    stage = scratch_dir + "/staged"
    # two collector runs land separately
    raw.filter(F.col("load_time") < datetime(2024, 1, 16)).write.mode("append").parquet(stage)
    raw.filter(F.col("load_time") >= datetime(2024, 1, 16)).write.mode("append").parquet(stage)
    q = start_staged_merge(lh, stage, raw.schema, "standard", "load_time", checkpoint=scratch_dir + "/ckpt", max_files_per_trigger=1)
    q.awaitTermination(600)
    got = lh.read(T.SILVER_TP_METRICS).drop("Date")
    want = ingest_detail(raw, "standard", "load_time")
    assert rows(got) == rows(want)
    # restart: nothing new staged, nothing changes
    q = start_staged_merge(lh, stage, raw.schema, "standard", "load_time", checkpoint=scratch_dir + "/ckpt")
    q.awaitTermination(600)
    assert rows(lh.read(T.SILVER_TP_METRICS).drop("Date")) == rows(want)
    # a batch that is noted as merged is not merged again, should Spark replay it
    notes = scratch_dir + "/ckpt-merged"
    from culedger.streaming.staged_merge import _noted

    assert _noted(spark, scratch_dir + "/ckpt", 0) and _noted(spark, scratch_dir + "/ckpt", 1) and not _noted(spark, scratch_dir + "/ckpt", 99), notes


def test_a_unit_staged_twice_leaves_one_copy(spark, scratch_dir):
    schema = "unit_capacity_id string, unit_timepoint timestamp_ntz, k string, v int"
    at = lambda h: datetime(2024, 1, 1, h)
    df = lambda *r: spark.createDataFrame(list(r), schema)
    store = UnitStore(spark, "u", df().schema, path=scratch_dir + "/units")
    assert store.read().count() == 0
    store.append(df(("A", at(1), "x", 1), ("A", at(1), "y", 2), ("B", at(1), "x", 3), (None, None, "z", 4)))
    store.append(df(("A", at(1), "x", 9), (None, None, "z", 5)))
    assert rows(store.read(), ["k", "v"]) == [("x", 3), ("x", 9), ("z", 5)]
    # collected again, with nothing in it
    store.put(df(), df(("B", at(1), None, None)))
    assert rows(store.read(), ["k", "v"]) == [("x", 9), ("z", 5)]
    # an attempt without its list of units has no say
    df(("A", at(1), "x", 0)).write.parquet(f"{store.path}/rows/attempt={2**62}")
    assert rows(store.read(), ["k", "v"]) == [("x", 9), ("z", 5)]
    store.put(df(("C", at(2), "x", 2), ("C", at(2), "x", 1), ("C", at(2), "y", 3)), df(("C", at(2), "", 0)), first_of=["k"])
    assert rows(store.read().filter("unit_capacity_id = 'C'"), ["k", "v"]) == [("x", 1), ("y", 3)]


def test_a_fanout_that_is_repeated_replaces_its_units(spark, scratch_dir):
    from culedger.sources.fanout import ERROR_FIELD, UNIT_COLUMNS
    from pyspark.sql.types import StructField, StructType, IntegerType

    extract = StructType([StructField("v", IntegerType())])
    store = UnitStore(spark, "f", StructType([*extract.fields, *UNIT_COLUMNS, ERROR_FIELD]), path=scratch_dir + "/fan")
    units = spark.createDataFrame([("A", datetime(2024, 1, 1, h)) for h in range(6)], "CapacityId string, TimePoint timestamp_ntz")

    def fetch(cap, at):
        if at.hour == 3:
            raise ConnectionError("busy")
        return pd.DataFrame({"v": [at.hour]})

    ok, errors = fanout(units, fetch, extract, 3, store)
    assert ok.count() == 5 and errors.count() == 1
    ok, errors = fanout(units.filter("hour(TimePoint) in (2, 3)"), lambda cap, at: pd.DataFrame({"v": [10 * at.hour]}), extract, 2, store)
    assert sorted(r.v for r in ok.collect()) == [0, 1, 4, 5, 20, 30] and errors.count() == 0
