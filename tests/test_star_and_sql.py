"""The pruned star join, SQL table functions, order of results, statistics."""

import uuid

import pytest
from conftest import SF0001, rows
from pyspark.sql import functions as F
from test_plans import plan_text

from culedger.operators.joins import pruned_star, star_facts
from culedger.plans import analysis, gold
from culedger.plans import tables as T
from culedger.plans.sql_functions import create_functions
from culedger.sources import fixtures as fx


@pytest.fixture(scope="module")
def lh(spark, tmp_path_factory):
    out = T.Lakehouse(spark, root=str(tmp_path_factory.mktemp("star")), database_prefix=f"s{uuid.uuid4().hex[:8]}_")
    out.create_schemas()
    detail = fx.silver_detail(spark, SF0001)
    undated = detail.filter("SumDuration_s < 5").withColumn("TimePoint", F.lit(None).cast("timestamp_ntz"))
    out.append(T.GOLD_TP_METRICS, gold.gold_standard_source(detail.unionByName(undated)))
    out.append(T.GOLD_TP_METRICS_AS, gold.gold_autoscale_source(fx.silver_autoscale(spark, SF0001)))
    out.append(T.GOLD_METRICS_BY_TIMEPOINT, fx.silver_timepoints(spark, SF0001))
    out.append(T.GOLD_CALENDAR_TIMEPOINTS, gold.gold_calendar_source(fx.silver_timepoints(spark, SF0001)))
    out.append(T.GOLD_CAPACITIES, fx.silver_capacities(spark, SF0001))
    return out


def dims(lh):
    return lh.read(T.GOLD_CALENDAR_TIMEPOINTS), lh.read(T.GOLD_CAPACITIES)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pruned_star_equals_the_star(lh):
    facts = lh.read(T.GOLD_TP_METRICS)
    assert facts.filter("Date IS NULL").count() > 0
    want = star_facts(facts.drop("Date"), *dims(lh))
    assert rows(pruned_star(facts, *dims(lh))) == rows(want)
    busy = lh.read(T.GOLD_METRICS_BY_TIMEPOINT).filter("TotalCUs >= 180")
    keys = ["CapacityId", "TimePoint"]
    assert rows(pruned_star(facts, *dims(lh), busy)) == rows(want.join(busy.select(*keys), keys, "left_semi"))


def test_star_reads_only_dates_of_the_dimension(lh, spark):
    busy = lh.read(T.GOLD_METRICS_BY_TIMEPOINT).filter("TotalCUs >= 250")
    star = pruned_star(lh.read(T.GOLD_TP_METRICS), *dims(lh), busy)
    scan = next(x for x in plan(star).splitlines() if "FileScan" in x and "SumTotal_CU_s" in x)
    assert "dynamicpruning" in scan.split("PartitionFilters")[1].split("PushedFilters")[0], scan
    days = {r[0] for r in busy.select("Date").distinct().collect()}
    assert 0 < len(days) < lh.read(T.GOLD_TP_METRICS).select("Date").distinct().count()


WINDOW = ("05 January 2024 07:30", "20 January 2024 20:59")


def test_sql_functions_equal_the_python_calls(lh, spark):
    names = create_functions(lh)
    assert len(names) == 6
    call = lambda name, args="": spark.sql(f"SELECT * FROM {lh.prefix}{name}({args})")
    scope = f"capacity => 'cap-01', window_start => '{WINDOW[0]}', window_end => '{WINDOW[1]}'"
    for args, v in (("", analysis.lakehouse_views(lh)), (scope, analysis.lakehouse_views(lh, "cap-01", *WINDOW))):
        more = f"{args}, " if args else ""
        assert rows(call("capacity_trend", args)) == rows(analysis.capacity_trend(v))
        for name in ("top_items", "top_workspaces", "top_operations"):
            got = call(name, f"{more}n => 7")
            want = getattr(analysis, name)(v, 7)
            assert got.columns == want.columns and [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()], name
        assert rows(call("top_items", args)) == rows(analysis.top_items(v))
        assert rows(call("autoscale_latest", args)) == rows(analysis.autoscale_latest(v, strict=True))
        assert rows(call("inspect_operation", f"{more}only_operation => ' op-7 '")) == rows(analysis.inspect_operation(v, "op-7"))


def test_sql_functions_push_their_scope(lh, spark):
    create_functions(lh)
    df = spark.sql(f"SELECT * FROM {lh.prefix}top_items(5, 'cap-01', '{WINDOW[0]}', '{WINDOW[1]}')")
    pushed = next(x for x in plan_text(df).splitlines() if "PushedFilters" in x)
    assert "EqualTo(CapacityId,CAP-01)" in pushed and "GreaterThanOrEqual(TimePoint" in pushed and "LessThanOrEqual(TimePoint" in pushed
    read = next(x for x in plan_text(df).splitlines() if "ReadSchema" in x)
    assert "Operation_start_time" not in read and "TakeOrderedAndProject(limit=5" in plan(df)


def test_results_come_in_order(lh):
    v = analysis.lakehouse_views(lh)
    for df, key in (
        (analysis.top_items(v), lambda r: (-r.TotalCU_s, r.Workspace_name, r.Item_name, r.Item_kind)),
        (analysis.top_workspaces(v), lambda r: (-r.TotalCU_s, r.Workspace_name)),
        (analysis.top_operations(v), lambda r: (-r.TotalCU_s, r.Operation)),
        (analysis.capacity_trend(v), lambda r: (r.TimePoint, r.CapacityId)),
    ):
        got = df.collect()
        assert got and got == sorted(got, key=key)
    for df in (analysis.inspect_operation(v), analysis.autoscale_latest(v), analysis.autoscale_latest(v, strict=True)):
        times = [r.TimePoint for r in df.collect()]
        known = [t for t in times if t is not None]
        assert known == sorted(known, reverse=True) and times == known + [None] * (len(times) - len(known))


def test_statistics_change_the_join_order(spark, lh):
    """Facts joined to two dimensions, written largest first: with statistics of
    columns the selective dimension comes first."""
    for t in (T.GOLD_TP_METRICS, T.GOLD_METRICS_BY_TIMEPOINT, T.GOLD_CAPACITIES):
        lh.analyze(t, [c for c in ("CapacityId", "TimePoint", "CapacityName", "TotalCUs") if c in lh.read(t).columns])
    sql = (
        f"SELECT f.Item_name, c.Region, m.TotalCUs FROM {lh.name(T.GOLD_TP_METRICS)} f "
        f"JOIN {lh.name(T.GOLD_METRICS_BY_TIMEPOINT)} m ON f.CapacityId = m.CapacityId AND f.TimePoint = m.TimePoint "
        f"JOIN {lh.name(T.GOLD_CAPACITIES)} c ON f.CapacityId = c.CapacityId WHERE c.CapacityName = 'Supplier#000000001'"
    )

    def order(cost_based):
        with T.cost_based(spark, cost_based):
            text = spark.sql(sql)._jdf.queryExecution().optimizedPlan().toString()
        return [x.split("Relation ")[1].split(".")[2].split("[")[0] for x in text.splitlines() if "Relation " in x]

    plain, costed = order(False), order(True)
    assert sorted(plain) == sorted(costed) and plain.index("capacities") > costed.index("capacities"), (plain, costed)
