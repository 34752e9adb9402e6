"""End-to-end: extracts -> silver -> gold through catalog tables, twice."""

import uuid

from conftest import SF0001, rows

from culedger.plans import gold
from culedger.plans import tables as T
from culedger.plans.pipeline import run_pipeline
from culedger.sources import fixtures as fx
from culedger.sources.ingest import autoscale_extract, capacity_extract, detail_extract, metrics_extract


def _extracts(spark):
    return dict(
        capacities_extract=capacity_extract(fx.silver_capacities(spark, SF0001), "v53"),
        metrics_extract=metrics_extract(fx.silver_timepoints(spark, SF0001), "v53"),
        standard_extract=detail_extract(fx.silver_detail(spark, SF0001)),
        autoscale_extract=autoscale_extract(fx.silver_autoscale(spark, SF0001)),
    )


def _snapshot(lh):
    out = {}
    for t in (T.GOLD_CAPACITIES, T.GOLD_METRICS_BY_TIMEPOINT, T.GOLD_CALENDAR_TIMEPOINTS, T.GOLD_TP_METRICS, T.GOLD_TP_METRICS_AS,
              T.SILVER_TP_METRICS, T.SILVER_TP_METRICS_AS, T.SILVER_TIMEPOINTS, T.SILVER_CAPACITIES):
        out[t] = rows(lh.read(t))
    return out


def test_pipeline_builds_gold_and_rerun_is_idempotent(spark, scratch_dir):
    lh = T.Lakehouse(spark, root=scratch_dir, database_prefix=f"t{uuid.uuid4().hex[:6]}_")
    ex = _extracts(spark)
    reps = run_pipeline(lh, version="v53", load_time_col="load_time",
                        start="01 January 2024 00:00", end="31 January 2024 23:59", **ex)
    assert not [r for r in reps if r.status == "failed"], reps
    assert [r.status for r in reps[-5:]] == ["ok"] * 5, reps
    first = _snapshot(lh)

    # Gold detail equals the pure transforms over the same silver input.
    want_std = gold.gold_standard_source(fx.silver_detail(spark, SF0001))
    got_std = lh.read(T.GOLD_TP_METRICS).drop("Date")
    assert rows(got_std) == rows(want_std)
    want_as = gold.gold_autoscale_source(fx.silver_autoscale(spark, SF0001))
    assert rows(lh.read(T.GOLD_TP_METRICS_AS).drop("Date")) == rows(want_as)
    assert lh.read(T.GOLD_CAPACITIES).count() == fx.silver_capacities(spark, SF0001).count()

    # Second run over the same extracts changes nothing.
    reps = run_pipeline(lh, version="v53", load_time_col="load_time",
                        start="01 January 2024 00:00", end="31 January 2024 23:59", **ex)
    assert not [r for r in reps if r.status == "failed"], reps
    assert _snapshot(lh) == first


def test_compaction_keeps_rows(spark, scratch_dir):
    lh = T.Lakehouse(spark, root=scratch_dir, database_prefix=f"c{uuid.uuid4().hex[:6]}_")
    lh.create_schemas()
    df = gold.gold_standard_source(fx.silver_detail(spark, SF0001))
    lh.merge(T.GOLD_TP_METRICS, df, ["CapacityId", "TimePoint"], ["Unique_key", "Operation", "Operation_Id", "Operation_start_time", "Operation_end_time"], "insert")
    before = rows(lh.read(T.GOLD_TP_METRICS))
    lh.compact(T.GOLD_TP_METRICS)
    lh.analyze(T.GOLD_TP_METRICS)
    assert rows(lh.read(T.GOLD_TP_METRICS)) == before


def test_incremental_running_totals_equal_full_rebuild(spark, scratch_dir):
    """Load run 1, build gold; load run 2 (overlapping, with late rows and
    redeliveries), build incrementally: equals a full rebuild from scratch."""
    from datetime import datetime

    from pyspark.sql import functions as F

    from culedger.plans.pipeline import build_gold, ingest_autoscale_detail, ingest_capacities, ingest_metrics

    raw = autoscale_extract(fx.silver_autoscale(spark, SF0001))
    cut = datetime(2024, 1, 20)
    # run 2 also carries late rows: old timepoints loaded after the cut
    run1 = raw.filter(F.col("load_time") < cut)
    run2 = raw.filter(F.col("load_time") >= cut).unionByName(
        raw.filter(F.col("load_time") < datetime(2024, 1, 5)).withColumn("load_time", F.lit(datetime(2024, 2, 1)))
        .withColumn("c12", F.col("c12") * 3)
    )
    caps = capacity_extract(fx.silver_capacities(spark, SF0001), "v53")
    mets = metrics_extract(fx.silver_timepoints(spark, SF0001), "v53")

    def fresh(tag):
        lh = T.Lakehouse(spark, root=f"{scratch_dir}/{tag}", database_prefix=f"{tag}{uuid.uuid4().hex[:6]}_")
        ingest_capacities(lh, caps, "v53")
        ingest_metrics(lh, mets, "v53")
        return lh

    inc = fresh("inc")
    ingest_autoscale_detail(inc, run1, load_time_col="load_time")
    build_gold(inc)
    ingest_autoscale_detail(inc, run2, load_time_col="load_time")
    build_gold(inc, incremental=True)

    full = fresh("full")
    ingest_autoscale_detail(full, run1, load_time_col="load_time")
    ingest_autoscale_detail(full, run2, load_time_col="load_time")
    build_gold(full)

    assert rows(inc.read(T.GOLD_TP_METRICS_AS)) == rows(full.read(T.GOLD_TP_METRICS_AS))


def test_steps_report_what_their_writes_did(spark, scratch_dir):
    from culedger.operators.aggregates import null_key_audit

    lh = T.Lakehouse(spark, root=scratch_dir, database_prefix=f"r{uuid.uuid4().hex[:6]}_")
    ex = _extracts(spark)
    reps = {r.name: r.detail for r in run_pipeline(lh, version="v53", load_time_col="load_time", **ex)}
    for kind, table, key in (("standard", T.SILVER_TP_METRICS, "standard_extract"), ("autoscale", T.SILVER_TP_METRICS_AS, "autoscale_extract")):
        d = reps[f"ingest_{kind}_detail"]
        assert d["read"] == ex[key].count() and d["updated"] == 0
        assert d["inserted"] - d["deleted"] == lh.read(table).count() and d["read"] - d["duplicates"] == d["inserted"]
        audit = null_key_audit(lh.read(table)).first().asDict()
        g = reps[f"gold_{kind}"]
        assert {k: g[k] for k in audit} == audit
        assert g["inserted"] == lh.read(T.GOLD_TP_METRICS if kind == "standard" else T.GOLD_TP_METRICS_AS).count()
        assert g["total_rows"] - g["null_key_rows"] - g["duplicates"] == g["inserted"]
    again = {r.name: r.detail for r in run_pipeline(lh, version="v53", load_time_col="load_time", incremental=True, **ex)}
    assert all(again[n]["updated"] == 0 for n in ("ingest_standard_detail", "gold_standard", "gold_autoscale", "gold_metrics"))
    assert again["gold_standard"]["inserted"] == again["gold_autoscale"]["inserted"] == 0


def _branches(spark, lh, tmp, fail):
    """Two branches that write different tables; the second fails or runs on."""
    import time

    from pyspark.sql import functions as F

    times = {}

    def slow(name, rows, broken=False):
        def run():
            times[name] = [time.time(), None]
            if broken:
                time.sleep(1.5)
                raise ValueError("no such column")
            df = spark.range(rows).repartition(4).mapInPandas(lambda it: (b for b in it if not time.sleep(0.3)), "id long")
            for i in range(8):
                df.select(F.col("id").cast("string").alias("CapacityId"), F.lit(name).alias("v")).write.parquet(f"{tmp}/{name}-{i}")
            times[name][1] = time.time()
            return name

        return run

    return {"a": slow("a", 40), "b": slow("b", 40, fail)}, times


def test_branches_overlap(spark, scratch_dir):
    from culedger.plans.pipeline import side_by_side

    lh = T.Lakehouse(spark, root=scratch_dir)
    branches, times = _branches(spark, lh, scratch_dir, False)
    assert side_by_side(lh, branches, True) == {"a": "a", "b": "b"}
    (a0, a1), (b0, b1) = times["a"], times["b"]
    assert max(a0, b0) < min(a1, b1)


def test_a_failing_branch_cancels_the_other(spark, scratch_dir):
    from culedger.plans.pipeline import side_by_side

    lh = T.Lakehouse(spark, root=scratch_dir)
    branches, times = _branches(spark, lh, scratch_dir, True)
    got = side_by_side(lh, branches, True)
    assert list(got) == ["b", "a"] and isinstance(got["b"], ValueError) and "cancel" in str(got["a"]).lower()
    assert times["a"][1] is None
    branches, times = _branches(spark, lh, scratch_dir + "/on", True)
    got = side_by_side(lh, branches, False)
    assert got["a"] == "a" and isinstance(got["b"], ValueError)
