"""Every registered query against its DuckDB oracle at sf0.01 (what the
driver's correctness gate does), and the time-sensitive ones again under a
non-UTC session time zone."""

from conftest import SF001
from oracle_check import compare

from culedger.plans.queries import QUERIES

TIME_SENSITIVE = ["filter_window", "drop_half_minute", "half_minute_count", "calendar", "date_spine", "make_timepoint",
                  "synthetic_id", "running_cu", "worklist_autoscale", "upsert_full"]


def test_all_queries_match_oracle(spark):
    res = compare(spark, SF001, sorted(QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "ok"}
    assert not bad, bad


def test_time_zone_independent(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        res = compare(spark, SF001, TIME_SENSITIVE, verbose=False)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    bad = {k: v for k, v in res.items() if v[0] != "ok"}
    assert not bad, bad
