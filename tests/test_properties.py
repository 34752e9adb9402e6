"""Property tests (hypothesis): algebraic rules of the merge, dedupe and
running-total operators on small random inputs, NULLs included."""

from datetime import datetime, timedelta

from conftest import rows
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from culedger.operators.dedupe import dedupe_latest
from culedger.operators.running import running_sum, running_sum_single_window
from culedger.operators.upsert import upsert_detail
from culedger.schemas import K7

SCHEMA = (
    "CapacityId STRING, TimePoint TIMESTAMP_NTZ, Unique_key STRING, Operation STRING, Operation_Id STRING, "
    "Operation_start_time TIMESTAMP_NTZ, Operation_end_time TIMESTAMP_NTZ, v DOUBLE, insert_date TIMESTAMP_NTZ"
)
BASE = datetime(2024, 1, 5, 7, 30)

opt = lambda s: st.one_of(st.none(), s)
tp = st.integers(0, 3).map(lambda i: BASE + timedelta(seconds=30 * i))
row = st.tuples(
    opt(st.sampled_from(["C1", "C2"])),
    tp,
    opt(st.sampled_from(["k1", "k2"])),
    opt(st.sampled_from(["a", "b"])),
    opt(st.sampled_from(["i1", "i2"])),
    opt(tp),
    opt(tp),
    st.integers(0, 10_000).map(lambda c: c / 100),
    opt(st.integers(0, 3).map(lambda d: BASE + timedelta(days=d))),
)
frames = st.lists(row, min_size=0, max_size=12)
# CapacityId and TimePoint compare with ``=``: a NULL there never matches, so
# such a row is inserted again on every rerun (the one documented exception
# to idempotence). The idempotence property is stated for non-NULL ``=`` keys.
keyed_row = row.filter(lambda r: r[0] is not None)
keyed_frames = st.lists(keyed_row, min_size=0, max_size=12)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck), phases=[Phase.explicit, Phase.reuse, Phase.generate])


def _unique(spark, data):
    return dedupe_latest(spark.createDataFrame(data, SCHEMA), K7)


@SETTINGS
@given(t=keyed_frames, s=keyed_frames)
def test_upsert_rules(spark, t, s):
    target, source = _unique(spark, t), _unique(spark, s)
    upd = upsert_detail(target, source, "update")
    ins = upsert_detail(target, source, "insert")
    # idempotent on rerun with the same source
    assert rows(upsert_detail(upd, source, "update")) == rows(upd)
    assert rows(upsert_detail(ins, source, "insert")) == rows(ins)
    # insert-only never changes a target row
    i_rows = rows(ins)
    assert all(r in i_rows for r in rows(target))
    # update keeps every source row
    u_rows = rows(upd)
    assert all(r in u_rows for r in rows(source))
    # both have |t| + |unmatched s| rows
    assert upd.count() == ins.count()


def test_null_eq_key_is_reinserted_on_rerun(spark):
    data = [(None, BASE, "k1", "a", "i1", None, None, 1.0, None)]
    src = _unique(spark, data)
    once = upsert_detail(src.limit(0), src, "update")
    assert upsert_detail(once, src, "update").count() == 2


@SETTINGS
@given(data=frames)
def test_dedupe_invariant_to_order(spark, data):
    a = rows(dedupe_latest(spark.createDataFrame(data, SCHEMA), K7))
    b = rows(dedupe_latest(spark.createDataFrame(list(reversed(data)), SCHEMA).repartition(3), K7))
    assert a == b


@SETTINGS
@given(data=frames)
def test_running_sum_split_equals_single_window(spark, data):
    df = _unique(spark, data)
    keys = ["CapacityId", "Unique_key", "Operation_Id"]
    order = ["TimePoint", "Operation", "Operation_start_time", "Operation_end_time"]
    split = running_sum(df, keys, order, "v", "acc", num_partitions=3)
    assert rows(split) == rows(running_sum_single_window(df, keys, order, "v", "acc"))
