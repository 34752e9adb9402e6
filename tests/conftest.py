import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from culedger.session import build_session

    scratch = tempfile.mkdtemp(prefix="culedger-tests-", dir="/tmp")
    s = build_session(
        "local[*]",
        8,
        app="culedger-tests",
        extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")},
    )
    yield s
    s.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="culedger-run-", dir="/tmp")


def rows(df, order=None):
    """Rows as sorted tuples of plain values (order-insensitive compare)."""
    cols = sorted(df.columns) if order is None else order
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
