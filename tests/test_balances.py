"""Running totals from stored balances equal the full rebuild."""

import uuid
from datetime import datetime

import pytest
from conftest import rows

from culedger.plans import balances, gold
from culedger.plans import tables as T
from culedger.schemas import K7_EQ, K7_NULL_SAFE, TIMEPOINT_METRICS_AUTOSCALE


@pytest.fixture()
def lh(spark, scratch_dir):
    out = T.Lakehouse(spark, root=scratch_dir, database_prefix=f"c{uuid.uuid4().hex[:8]}_")
    out.create_schemas()
    return out


def spent(spark, *xs):
    """Silver rows (day or None, hour, group, operation id, CU, load hour)."""
    out = []
    for day, hour, group, op, cu, load in xs:
        r = dict.fromkeys(TIMEPOINT_METRICS_AUTOSCALE.fieldNames())
        r |= {"CapacityId": "CAP-1", "Unique_key": group, "Operation_Id": "op", "Operation": op, "SumCU_s": cu, "IsGrandTotalRowTotal": False}
        r |= {"TimePoint": None if day is None else datetime(2024, 1, day, hour), "insert_date": datetime(2024, 2, 1, load)}
        out.append(tuple(r.values()))
    return spark.createDataFrame(out, TIMEPOINT_METRICS_AUTOSCALE)


FIRST = [(1, 1, "a", "x", 1.25, 0), (1, 2, "a", "x", 2.0, 0), (2, 1, "a", "x", 0.1, 0), (2, 1, "a", "y", 0.2, 0), (4, 1, "a", "x", 5.0, 0), (1, 1, "b", "x", 7.0, 0), (4, 9, "b", "x", 0.000001, 0), (None, 0, "a", "x", 0.5, 0), (2, 3, "n", "x", None, 0), (4, 3, "n", "x", None, 0)]
LOADS = {
    "a new day": [(5, 1, "a", "x", 3.0, 1), (5, 2, "c", "x", 1.0, 1)],
    "a late row": [(1, 3, "a", "x", 0.3, 1)],
    "a late row before all others": [(1, 0, "a", "w", 0.7, 1), (3, 1, "b", "x", 0.1, 1)],
    "a corrected row, at an equal time another": [(2, 1, "a", "x", 0.4, 1), (2, 1, "a", "z", 0.6, 1)],
    "a row without a time": [(None, 0, "b", "y", 2.5, 1)],
    "a value where there was none": [(2, 3, "n", "x", 1.5, 1)],
    "no value where there was one": [(1, 1, "b", "x", None, 1)],
    "finer decimals": [(1, 5, "a", "x", 1e-9, 1)],
    "a number beyond exact doubles": [(1, 5, "a", "x", 3e9 + 0.25, 1), (2, 5, "b", "x", 1e30, 1)],
    "not a number": [(2, 5, "a", "x", float("nan"), 1)],
    "nothing new": [(2, 1, "a", "x", 0.1, 0)],
}


def built(lh, spark):
    lh.merge(T.SILVER_TP_METRICS_AS, spent(spark, *FIRST), K7_EQ, K7_NULL_SAFE, "update")
    lh.merge(T.GOLD_TP_METRICS_AS, gold.gold_autoscale_source(lh.read(T.SILVER_TP_METRICS_AS)), K7_EQ, K7_NULL_SAFE, "update")
    balances.start(lh)


def load(lh, spark, xs):
    return lh.merge(T.SILVER_TP_METRICS_AS, spent(spark, *xs), K7_EQ, K7_NULL_SAFE, "update", note=lambda d: lh.mark(T.SILVER_TP_METRICS_AS, d))


def rebuilt(lh):
    """Totals of a full rebuild, as text (NaN is NaN)."""
    full = gold.gold_autoscale_source(lh.read(T.SILVER_TP_METRICS_AS)).drop("Date")
    return [str(r) for r in rows(full)]


def now(lh):
    return [str(r) for r in rows(lh.read(T.GOLD_TP_METRICS_AS).drop("Date"))]


def test_carried_totals_equal_the_rebuild(lh, spark):
    """One load after the other, each on what the last left."""
    built(lh, spark)
    for what, xs in LOADS.items():
        load(lh, spark, xs)
        dates, notes = lh.marked(T.SILVER_TP_METRICS_AS)
        balances.carry_forward(lh, dates)
        lh.clear(notes)
        assert now(lh) == rebuilt(lh), what
        assert lh.marked(T.SILVER_TP_METRICS_AS) == ([], [])
    stored = rows(lh.read(T.GOLD_BALANCES))
    balances.start(lh)
    assert str(rows(lh.read(T.GOLD_BALANCES))) == str(stored)


def test_a_build_that_died_is_repeated(lh, spark, monkeypatch):
    built(lh, spark)
    load(lh, spark, [(1, 3, "a", "x", 0.3, 1), (2, 2, "b", "x", 0.9, 1)])
    dates, _ = lh.marked(T.SILVER_TP_METRICS_AS)
    with monkeypatch.context() as m:  # gold is written, the balances are not
        m.setattr(T.Lakehouse, "replace_dates", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            balances.carry_forward(lh, dates)
    assert now(lh) == rebuilt(lh)
    done = balances.carry_forward(lh, lh.marked(T.SILVER_TP_METRICS_AS)[0])
    assert now(lh) == rebuilt(lh) and (done.inserted, done.updated) == (0, 0)
    # and one of which a single date arrived
    load(lh, spark, [(1, 4, "a", "x", 0.4, 2)])
    before = lh.read(T.GOLD_TP_METRICS_AS).filter("Date = '2024-01-04'").checkpoint()
    balances.carry_forward(lh, lh.marked(T.SILVER_TP_METRICS_AS)[0])
    lh._insert(T.GOLD_TP_METRICS_AS, before, True)
    lh.replace_dates(T.GOLD_BALANCES, balances.day_totals(spent(spark, *[x for x in FIRST if x[0] == 1])), lh._dates(lh.read(T.GOLD_BALANCES).filter("Date = '2024-01-01'")))
    balances.carry_forward(lh, lh.marked(T.SILVER_TP_METRICS_AS)[0])
    assert now(lh) == rebuilt(lh)


def test_earlier_dates_are_not_read(lh, spark):
    built(lh, spark)
    load(lh, spark, [(4, 2, "a", "x", 1.0, 1)])
    dates, _ = lh.marked(T.SILVER_TP_METRICS_AS)
    totals = balances.day_totals(gold.autoscale_rows(lh.on_dates(lh.read(T.SILVER_TP_METRICS_AS), dates)))
    read = set(balances.restated(lh, dates, totals).inputFiles())
    for table in (T.SILVER_TP_METRICS_AS, T.GOLD_TP_METRICS_AS):
        own = {f for f in read if f"/{table.split('.')[1]}/" in f and f"{table.split('.')[0]}/" in f}
        assert all("Date=2024-01-04" in f or "Date=2024-01-05" in f for f in own), own
    # nor later ones of silver, where the difference can be added
    load(lh, spark, [(2, 4, "a", "x", 1.0, 1)])
    restated = balances.restated(lh, [datetime(2024, 1, 2).date()], totals)
    plan = restated._jdf.queryExecution().executedPlan().toString()
    gold_scan = [x for x in plan.splitlines() if "FileScan" in x and "PartitionFilters" in x]
    assert gold_scan and all("2024-01-01" not in x.split("PartitionFilters")[1].split("PushedFilters")[0] for x in gold_scan)


def test_days_are_joined_not_crossed(lh, spark):
    built(lh, spark)
    plan = balances.openings(lh.read(T.GOLD_BALANCES), lh.read(T.GOLD_TP_METRICS_AS).select(*balances.RUNNING_GROUP, "Date"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
