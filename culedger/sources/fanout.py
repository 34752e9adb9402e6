"""Per-unit extraction fan-out.

The reference calls an external capacity model once per (capacity,
timepoint) from a driver thread pool. Here the work list is a DataFrame;
its rows are spread over ``parallelism`` tasks and each task calls the
user's ``fetch`` for its units (``mapInPandas``: one Arrow batch of units in,
extract rows out). A failing unit becomes one error row instead of failing
the job; callers choose to raise or continue on the error count.

The output is written to a staged store before anything reads it, so reading
rows and errors apart does not call the service again. A call runs at least
once: a task that Spark repeats calls again for its units, and its first output
is discarded. In a :class:`~culedger.sources.staging.UnitStore` a unit that is
collected again, in this run or a later one, replaces what it had.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from culedger.sources.staging import StagedStore, UnitStore

UNIT_COLUMNS = [T.StructField("unit_capacity_id", T.StringType()), T.StructField("unit_timepoint", T.TimestampNTZType())]
ERROR_FIELD = T.StructField("fetch_error", T.StringType())


def _run_units(fetch: Callable, names: list[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for units in batches:
            for cap, tp in zip(units["CapacityId"], units["TimePoint"]):
                tp = tp.to_pydatetime() if hasattr(tp, "to_pydatetime") else tp
                try:
                    got = fetch(str(cap).upper(), tp)
                    if got is None or len(got.index) == 0:
                        continue
                    if len(got.columns) != len(names):
                        raise ValueError(f"fetch returned {len(got.columns)} columns, expected {len(names)}")
                    # positional: the service's own headers do not matter
                    out = got.copy()
                    out.columns = names
                    out["unit_capacity_id"] = cap
                    out["unit_timepoint"] = tp
                    out["fetch_error"] = None
                except Exception as ex:  # one failed unit -> one error row
                    out = pd.DataFrame({n: [None] for n in names})
                    out["unit_capacity_id"] = cap
                    out["unit_timepoint"] = tp
                    out["fetch_error"] = f"{type(ex).__name__}: {ex}"
                yield out

    return run


def fanout(
    worklist: DataFrame,
    fetch: Callable[[str, object], pd.DataFrame],
    extract_schema: T.StructType,
    parallelism: int = 10,
    store: StagedStore | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Call ``fetch(capacity_id, timepoint)`` for every work-list row on the
    executors. Returns ``(rows, errors)`` read back from the staged store:
    ``rows`` carries the extract columns plus the unit columns; ``errors`` one
    row per failed unit.
    """
    names = [f.name for f in extract_schema.fields]
    out_schema = T.StructType(list(extract_schema.fields) + UNIT_COLUMNS + [ERROR_FIELD])
    units = worklist.select("CapacityId", "TimePoint").repartition(max(1, parallelism))
    produced = units.mapInPandas(_run_units(fetch, names), out_schema)
    store = store or UnitStore(worklist.sparkSession, "fanout", out_schema)
    if isinstance(store, UnitStore):
        store.put(produced, worklist.select(F.col("CapacityId").alias("unit_capacity_id"), F.col("TimePoint").alias("unit_timepoint")))
    else:
        store.append(produced)
    staged = store.read()
    ok = staged.filter(F.col("fetch_error").isNull()).drop("fetch_error")
    errors = staged.filter(F.col("fetch_error").isNotNull()).select("unit_capacity_id", "unit_timepoint", "fetch_error")
    return ok, errors
