"""Plan checks: filters reach the scan, no Python evaluation or cartesian
products in any registered query, shuffles where expected."""

import io
import contextlib

import pytest
from conftest import SF001

import __spark_entry__ as E


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_python_eval_or_cartesian(spark, name):
    p = plan_text(E.queries()[name](spark, SF001))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{name}: {bad}"


def test_filters_pushed_to_gold_scan(spark, scratch_dir):
    from culedger.plans import analysis, gold
    from culedger.sources import fixtures as fx

    path = scratch_dir + "/gold_std"
    gold.gold_standard_source(fx.silver_detail(spark, "/root/testdata/sf0.001")).write.parquet(path)
    std = spark.read.parquet(path)
    v = analysis.views(std, None, None, capacity_id="CAP-01", start="05 January 2024 07:30", end="20 January 2024 20:59")
    p = plan_text(analysis.top_items(v, 20))
    scan = p[p.index("Scan parquet"):]
    pushed = scan[scan.index("PushedFilters"):].splitlines()[0]
    assert "EqualTo(CapacityId,CAP-01)" in pushed
    assert "GreaterThanOrEqual(TimePoint" in pushed and "LessThanOrEqual(TimePoint" in pushed
    # only the needed columns are read
    schema = scan[scan.index("ReadSchema"):].splitlines()[0]
    assert "Operation_start_time" not in schema


def test_dedupe_limit_runs_before_shuffle(spark):
    p = plan_text(E.queries()["dedupe_latest"](spark, SF001))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_running_total_plan_shape(spark):
    """Dedupe limit runs before the K7 shuffle; the running total then has
    exactly one full-row exchange (group + TimePoint) and no exchange right
    under its final window."""
    p = plan_text(E.queries()["running_cu"](spark, SF001), "simple")
    assert "WindowGroupLimit" in p and "Partial" in p
    lines = p.splitlines()
    bucket = [ln for ln in lines if "Exchange hashpartitioning(CapacityId" in ln and "REPARTITION_BY_NUM" in ln]
    assert bucket, "rows are hash-partitioned by the bucket keys"
    # no exchange sits directly under the final running window
    assert not any("Exchange" in ln for ln in lines[:4])
