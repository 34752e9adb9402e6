"""Planted cases on tiny literal DataFrames: the semantics a derived fixture
does not exercise (NULL keys on every side, ties, fractional seconds, empty
inputs, adapter errors)."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from culedger.functions.columns import half_minute_by_format, half_minute_by_text, synthetic_operation_id, with_synthetic_operation_id
from culedger.operators.dedupe import dedupe_any, dedupe_latest, duplicate_count, require_unique
from culedger.operators.filters import delete_half_minute_text, drop_half_minute, filter_capacity_ci, filter_window
from culedger.operators.running import running_sum, running_sum_single_window
from culedger.operators.upsert import upsert, upsert_detail
from culedger.plans import analysis, gold
from culedger.schemas import K7, TIMEPOINT_METRICS_AUTOSCALE

TS = datetime


def k7_frame(spark, data, extra="v DOUBLE"):
    schema = (
        "CapacityId STRING, TimePoint TIMESTAMP_NTZ, Unique_key STRING, Operation STRING, Operation_Id STRING, "
        f"Operation_start_time TIMESTAMP_NTZ, Operation_end_time TIMESTAMP_NTZ, {extra}"
    )
    return spark.createDataFrame(data, schema)


T0 = TS(2024, 1, 5, 7, 30, 0)
T1 = TS(2024, 1, 5, 7, 31, 0)
S0 = TS(2024, 1, 5, 7, 29, 10)
E0 = TS(2024, 1, 5, 7, 29, 50)


# Upsert ----------------------------------------------------------------------


def test_upsert_null_safe_keys_match_and_eq_keys_never_match_null(spark):
    target = k7_frame(spark, [
        ("C1", T0, None, "op", "id1", S0, E0, 1.0),        # NULL in a null-safe key
        ("C1", T0, "k1", "op", None, None, None, 2.0),     # NULLs in three null-safe keys
        (None, T0, "k1", "op", "id1", S0, E0, 3.0),        # NULL in an = key
        ("C1", T1, "k1", "op", "id1", S0, E0, 4.0),        # target only
    ])
    source = k7_frame(spark, [
        ("C1", T0, None, "op", "id1", S0, E0, 10.0),
        ("C1", T0, "k1", "op", None, None, None, 20.0),
        (None, T0, "k1", "op", "id1", S0, E0, 30.0),
        ("C2", T0, "k1", "op", "id1", S0, E0, 50.0),       # source only
    ])
    upd = {r["v"] for r in upsert_detail(target, source, "update").collect()}
    # matched rows replaced; NULL CapacityId never matches: both copies stay
    assert upd == {10.0, 20.0, 3.0, 30.0, 4.0, 50.0}
    ins = {r["v"] for r in upsert_detail(target, source, "insert").collect()}
    assert ins == {1.0, 2.0, 3.0, 4.0, 30.0, 50.0}


def test_upsert_is_idempotent_and_size_rule(spark):
    target = k7_frame(spark, [("C1", T0, "k", "a", "i", S0, E0, 1.0), ("C1", T1, "k", "a", "i", S0, E0, 2.0)])
    source = k7_frame(spark, [("C1", T1, "k", "a", "i", S0, E0, 9.0), ("C1", T1, "k", "b", "i", S0, E0, 8.0)])
    once = upsert_detail(target, source, "update")
    twice = upsert_detail(once, source, "update")
    assert rows(once) == rows(twice)
    # |upsert| = |t| + |unmatched s|
    assert once.count() == 2 + 1
    ins_once = upsert_detail(target, source, "insert")
    assert rows(upsert_detail(ins_once, source, "insert")) == rows(ins_once)


def test_upsert_adds_new_source_columns(spark):
    t = spark.createDataFrame([("a", 1)], "CapacityId STRING, x INT")
    s = spark.createDataFrame([("b", 2, "new")], "CapacityId STRING, x INT, y STRING")
    out = upsert(t, s, ["CapacityId"], (), "insert")
    assert sorted(out.columns) == ["CapacityId", "x", "y"]
    assert {r["CapacityId"]: r["y"] for r in out.collect()} == {"a": None, "b": "new"}


def test_require_unique_raises_on_duplicate_source(spark):
    s = k7_frame(spark, [("C1", T0, "k", "a", "i", S0, E0, 1.0), ("C1", T0, "k", "a", "i", S0, E0, 2.0)])
    with pytest.raises(ValueError):
        require_unique(s, K7)


# Dedupe ----------------------------------------------------------------------


def test_dedupe_latest_prefers_latest_then_nulls_last_then_tiebreak(spark):
    df = k7_frame(spark, [
        ("C1", T0, "k", "a", "i", S0, E0, 1.0, TS(2024, 1, 6)),
        ("C1", T0, "k", "a", "i", S0, E0, 2.0, TS(2024, 1, 7)),
        ("C1", T0, "k", "a", "i", S0, E0, 3.0, None),
        ("C1", T1, "k", "a", "i", S0, E0, 5.0, TS(2024, 1, 7)),
        ("C1", T1, "k", "a", "i", S0, E0, 4.0, TS(2024, 1, 7)),   # equal insert_date: smaller v wins
        ("C1", T1, None, "a", None, None, None, 6.0, None),
        ("C1", T1, None, "a", None, None, None, 7.0, None),        # all-NULL insert_date, NULL keys group
    ], extra="v DOUBLE, insert_date TIMESTAMP_NTZ")
    got = sorted(r["v"] for r in dedupe_latest(df, K7).collect())
    assert got == [2.0, 4.0, 6.0]
    # order of input rows does not matter
    rev = df.orderBy(F.col("v").desc()).repartition(3)
    assert sorted(r["v"] for r in dedupe_latest(rev, K7).collect()) == got


def test_dedupe_any_without_insert_date(spark):
    df = k7_frame(spark, [("C1", T0, "k", "a", "i", S0, E0, 2.0), ("C1", T0, "k", "a", "i", S0, E0, 1.0)])
    assert [r["v"] for r in dedupe_any(df, K7).collect()] == [1.0]
    # dedupe_latest falls back when there is no insert_date column
    assert [r["v"] for r in dedupe_latest(df, K7).collect()] == [1.0]


def test_duplicate_count_counts_null_keys_as_equal(spark):
    df = k7_frame(spark, [
        ("C1", T0, None, "a", None, None, None, 1.0),
        ("C1", T0, None, "a", None, None, None, 2.0),
        ("C1", T0, "k", "a", None, None, None, 3.0),
    ])
    r = duplicate_count(df, K7).first()
    assert (r["total_rows"], r["distinct_keys"], r["duplicates"]) == (3, 2, 1)


# Synthetic id -------------------------------------------------------------------


def test_synthetic_id_known_value_and_nulls(spark):
    import hashlib

    df = k7_frame(spark, [
        ("C1", T0, "k", "a", None, S0, E0, 1.0),
        ("C1", T0, "k", "a", None, None, E0, 1.0),
        ("C1", T0, "k", "a", None, S0, None, 1.0),
        ("C1", T0, "k", "a", None, None, None, 1.0),
        ("C1", T0, "k", "a", "kept", None, None, 1.0),
    ])
    got = [r["Operation_Id"] for r in with_synthetic_operation_id(df).collect()]
    s, e = "2024-01-05 07:29:10", "2024-01-05 07:29:50"

    def h(a, b):
        return "synthetic-" + hashlib.sha256(f"{a}||{b}".encode()).hexdigest()

    assert got == [h(s, e), h("NULL_START", e), h(s, "NULL_END"), h("NULL_START", "NULL_END"), "kept"]


def test_synthetic_id_skipped_without_columns(spark):
    df = spark.createDataFrame([("x",)], "Operation_Id STRING")
    assert with_synthetic_operation_id(df).collect()[0][0] == "x"
    assert synthetic_operation_id() is not None


# Half-minute rules ------------------------------------------------------------------


def test_half_minute_text_vs_format(spark):
    df = spark.createDataFrame(
        [(TS(2024, 1, 5, 7, 30, 0),), (TS(2024, 1, 5, 7, 0, 30),), (TS(2024, 1, 5, 7, 0, 30, 500000),), (None,)],
        "TimePoint TIMESTAMP_NTZ",
    )
    r = df.select(half_minute_by_text().alias("t"), half_minute_by_format().alias("f")).collect()
    assert [(x["t"], x["f"]) for x in r] == [(False, False), (True, True), (False, True), (None, None)]
    # filter drops NULL (WHERE); delete keeps NULL (DELETE WHERE)
    assert drop_half_minute(df).count() == 2
    assert delete_half_minute_text(df).count() == 3


# Window filter ---------------------------------------------------------------------


def test_window_filter_inclusive_and_validated(spark):
    df = spark.createDataFrame([(TS(2024, 1, 5, 7, 30),), (TS(2024, 1, 5, 20, 59),), (TS(2024, 1, 5, 21, 0),)], "TimePoint TIMESTAMP_NTZ")
    assert filter_window(df, "05 January 2024 07:30", "05 January 2024 20:59").count() == 2
    with pytest.raises(ValueError):
        filter_window(df, "05 January 2024 21:00", "05 January 2024 20:59")
    with pytest.raises(ValueError):
        filter_window(df, "2024-01-05", "05 January 2024 20:59")


def test_capacity_filter_case_insensitive(spark):
    df = spark.createDataFrame([("ABC-1",), ("abc-1",), ("x",)], "CapacityId STRING")
    assert filter_capacity_ci(df, "Abc-1").count() == 2
    assert filter_capacity_ci(df, "").count() == 3


# Running total ------------------------------------------------------------------------


def _running_input(spark):
    g = ("C1", "k", "id")
    data = []
    # ties on TimePoint inside a group, broken by Operation then times
    for i, (tp, op, v) in enumerate([(T0, "b", 1.25), (T0, "a", 2.5), (T1, "a", 4.0), (T1, "a", 8.0), (None, "a", 16.0)]):
        data.append((g[0], tp, g[1], op, g[2], S0 if i != 3 else E0, E0, v))
    data.append(("C2", T0, "k", "a", "id", S0, E0, 100.0))
    data.append((None, T0, "k", "a", "id", S0, E0, 1000.0))
    return k7_frame(spark, data)


def test_running_sum_matches_single_window_and_order(spark):
    df = _running_input(spark)
    order = ["TimePoint", "Operation", "Operation_start_time", "Operation_end_time"]
    split = running_sum(df, ["CapacityId", "Unique_key", "Operation_Id"], order, "v", "acc")
    single = running_sum_single_window(df, ["CapacityId", "Unique_key", "Operation_Id"], order, "v", "acc")
    assert rows(split) == rows(single)
    got = {(r["CapacityId"], r["TimePoint"], r["Operation"], r["Operation_start_time"]): r["acc"] for r in split.collect()}
    assert got[("C1", None, "a", S0)] == 16.0               # NULL TimePoint sorts first
    assert got[("C1", T0, "a", S0)] == 18.5
    assert got[("C1", T0, "b", S0)] == 19.75
    assert got[("C1", T1, "a", S0)] == 23.75
    assert got[("C1", T1, "a", E0)] == 31.75
    assert got[("C2", T0, "a", S0)] == 100.0
    assert got[(None, T0, "a", S0)] == 1000.0


def test_running_sum_split_depth_two_and_hot_group(spark):
    # one group holding most rows, many timepoints: split result == single window
    base = spark.range(0, 3000).select(
        F.lit("HOT").alias("CapacityId"),
        F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(5), (F.col("id") % 24).cast("int"), (F.col("id") % 60).cast("int"), F.lit(0)).alias("TimePoint"),
        F.lit("k").alias("Unique_key"),
        (F.col("id") % 3).cast("string").alias("Operation"),
        F.lit("id").alias("Operation_Id"),
        F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.lit(0), F.lit(0), (F.col("id") % 50).cast("int")).alias("Operation_start_time"),
        F.lit(None).cast("timestamp_ntz").alias("Operation_end_time"),
        (F.col("id") * 0.01).alias("v"),
    ).dropDuplicates(["TimePoint", "Operation", "Operation_start_time"])
    order = ["TimePoint", "Operation", "Operation_start_time", "Operation_end_time"]
    keys = ["CapacityId", "Unique_key", "Operation_Id"]
    single = rows(running_sum_single_window(base, keys, order, "v", "acc"))
    assert rows(running_sum(base, keys, order, "v", "acc", split_depth=1, num_partitions=16)) == single
    assert rows(running_sum(base, keys, order, "v", "acc", split_depth=2, num_partitions=5)) == single


def test_running_total_last_equals_group_sum(spark):
    df = _running_input(spark)
    order = ["TimePoint", "Operation", "Operation_start_time", "Operation_end_time"]
    out = running_sum(df, ["CapacityId", "Unique_key", "Operation_Id"], order, "v", "acc")
    mx = {r[0]: r[1] for r in out.groupBy("CapacityId").agg(F.max("acc")).collect()}
    sm = {r[0]: r[1] for r in df.groupBy("CapacityId").agg(F.sum("v")).collect()}
    assert mx == sm


# Gold autoscale --------------------------------------------------------------------


def test_gold_autoscale_drops_null_keys_and_half_minutes_and_dedupes(spark):
    cols = [f.name for f in TIMEPOINT_METRICS_AUTOSCALE.fields]
    base = dict(Operation="op", Operation_start_time=S0, Operation_end_time=E0, Status="Success", User="u", Workspace_name="w",
                Item_kind="kind", Unique_key="k", Operation_Id=None, Billing_type="b", Item_name="item",
                IsGrandTotalRowTotal=False, SumCU_s=1.0, Timepoint_workload_autoscale_limit=64.0,
                TimePoint=T0, CapacityId="C1", insert_date=TS(2024, 1, 6))

    def row(**kw):
        d = dict(base)
        d.update(kw)
        return tuple(d[c] for c in cols)

    data = [
        row(),
        row(SumCU_s=5.0, insert_date=TS(2024, 1, 7)),          # redelivery wins
        row(TimePoint=TS(2024, 1, 5, 7, 30, 30)),               # half minute: out
        row(Unique_key=None, IsGrandTotalRowTotal=True),        # grand total: out
        row(TimePoint=T1, SumCU_s=2.0),
    ]
    df = spark.createDataFrame(data, TIMEPOINT_METRICS_AUTOSCALE)
    out = gold.gold_autoscale_source(df).orderBy("TimePoint").collect()
    assert [(r["TimePoint"], r["SumCU_s"], r["Acc_CU_s"]) for r in out] == [(T0, 5.0, 5.0), (T1, 2.0, 7.0)]
    assert all(r["Operation_Id"].startswith("synthetic-") for r in out)


# Analysis ----------------------------------------------------------------------------


def test_latest_state_as_written_vs_strict(spark):
    # two capacities share an operation id and key; as written, the join
    # ignores CapacityId, so the capacity whose latest point is earlier loses.
    g = [
        ("C1", T0, "k", "op", "id", S0, E0, 1.0),
        ("C1", T1, "k", "op", "id", S0, E0, 2.0),
        ("C2", T0, "k", "op", "id", S0, E0, 3.0),
    ]
    a = k7_frame(spark, g).withColumnRenamed("v", "SumCU_s").withColumn("Acc_CU_s", F.col("SumCU_s"))
    for c in ["Workspace_name", "Item_name", "Item_kind", "User"]:
        a = a.withColumn(c, F.lit("x"))
    std = a.limit(0).withColumnRenamed("SumCU_s", "SumTotal_CU_s")
    v = analysis.views(std, a)
    loose = analysis.autoscale_latest(v).collect()
    strict = analysis.autoscale_latest(v, strict=True).collect()
    assert sorted((r["CapacityId"], r["TimePoint"]) for r in loose) == [("C1", T1)]
    assert sorted((r["CapacityId"], r["TimePoint"]) for r in strict) == [("C1", T1), ("C2", T0)]
    # no autoscale table: empty result with the unified schema
    v2 = analysis.views(std, None)
    assert analysis.autoscale_latest(v2).count() == 0
    assert analysis.autoscale_latest(v2).columns == v2.unified.columns


def test_empty_inputs_flow_through(spark):
    empty = spark.createDataFrame([], TIMEPOINT_METRICS_AUTOSCALE)
    assert gold.gold_autoscale_source(empty).count() == 0
    assert "Acc_CU_s" in gold.gold_autoscale_source(empty).columns


def test_schema_types(spark):
    assert T.TimestampNTZType() == TIMEPOINT_METRICS_AUTOSCALE["TimePoint"].dataType


def test_hot_group_is_spread_over_partitions(spark):
    """Every row in ONE running-total group: the rows still land on many
    partitions (keyed by group + TimePoint), none holding most of them."""
    n = 4000
    base = spark.range(0, n).select(
        F.lit("HOT").alias("CapacityId"),
        F.make_timestamp_ntz(F.lit(2024), F.lit(1), (F.col("id") % 28 + 1).cast("int"), (F.col("id") % 24).cast("int"),
                             (F.col("id") % 60).cast("int"), F.lit(0)).alias("TimePoint"),
        F.lit("k").alias("Unique_key"),
        F.lit("op").alias("Operation"),
        F.lit("id").alias("Operation_Id"),
        F.col("id").cast("timestamp").cast("timestamp_ntz").alias("Operation_start_time"),
        F.lit(None).cast("timestamp_ntz").alias("Operation_end_time"),
        F.lit(1.0).alias("v"),
    )
    order = ["TimePoint", "Operation", "Operation_start_time", "Operation_end_time"]
    out = running_sum(base, ["CapacityId", "Unique_key", "Operation_Id"], order, "v", "acc", num_partitions=16)
    sizes = [r["c"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("c")).collect()]
    assert sum(sizes) == n
    assert len(sizes) >= 12 and max(sizes) < 0.15 * n
    assert out.agg(F.max("acc")).first()[0] == float(n)
