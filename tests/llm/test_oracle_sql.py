"""The queries that SQL can express, against DuckDB."""

from oracle_check import compare

from culedger.llm.queries import ORACLE

SF = "/root/testdata/sf0.01"


def test_queries_match_oracle(spark):
    res = compare(spark, SF, sorted(ORACLE), verbose=False)
    assert not {k: v for k, v in res.items() if v[0] != "ok"}, res
