"""Running totals that do not put a whole group in one task.

``SUM(v) OVER (PARTITION BY g ORDER BY o ROWS UNBOUNDED PRECEDING)`` sends all
rows of a group to one task. With a group holding a third of the data, that
task is the job. Here the order is split at a leading prefix of the order
columns (``TimePoint`` by default) into buckets:

1. per-(group, bucket) totals -- an aggregate with map-side partial sums;
2. per bucket, the sum of all earlier buckets of its group -- a window over
   the bucket totals only; its rows per group are bounded by the number of
   distinct buckets (timepoints), not by the data volume;
3. the bucket offsets enter the row stream as one marker row per bucket,
   ordered first inside the bucket, and a running sum partitioned by
   (group, bucket) adds them to the rows.

The rows are shuffled once, by (group, bucket), so a hot group is spread over
many tasks, and the final window runs on that partitioning: the offsets are
small and shuffled to match, and Union keeps the shared partitioning. The
bucket totals are a partial aggregate of the input (one row per bucket and
map task crosses the network). No join back is needed. Sums run in an exact
decimal type, so the split changes no digit of the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from culedger.functions.columns import exact_cu, residual_cu

_MARK = "_rt_marker"
_VAL = "_rt_value"
_RES = "_rt_residual"
#: Exact type of the sums over buckets.
CU_TOTAL = "decimal(38,6)"


def running_sum(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    value: str,
    out: str,
    split_depth: int = 1,
    num_partitions: int | None = None,
    opening: DataFrame | None = None,
) -> DataFrame:
    """Add ``out`` = running sum of ``value`` per ``partition_by`` in
    ``order_by`` order (all ascending, NULLs first; rows frame).

    ``order_by`` must make the order total inside a group for the result to
    be deterministic (the reference orders by time only; ties there depend on
    row arrival). ``split_depth`` is how many leading ``order_by`` columns form
    a bucket. Values are summed as an exact part plus a residual, so no digit
    is lost and NaN stays NaN from its row on.

    ``opening``: rows (partition_by..., opening, opening_rest) of balances that
    groups start from, exact part and residual; a group without one starts from
    nothing.

    Rows are hash-partitioned once by the bucket keys (``num_partitions``,
    default ``spark.sql.shuffle.partitions``). The offsets are re-partitioned
    the same way, so the union keeps that partitioning and the final window
    needs no shuffle.
    """
    part = list(partition_by)
    order = list(order_by)
    if not 1 <= split_depth <= len(order):
        raise ValueError("split_depth must be between 1 and len(order_by)")
    split, within = order[:split_depth], order[split_depth:]
    bucket_keys = part + split
    n = num_partitions or _default_partitions(df)
    base = df.withColumn(_VAL, exact_cu(value)).withColumn(_RES, residual_cu(value))
    rows = base.repartition(n, *bucket_keys).withColumn(_MARK, F.lit(1))

    # Bucket totals straight from the input: a partial (map-side) sum, so
    # only one row per bucket and map task is shuffled.
    buckets = base.groupBy(*bucket_keys).agg(F.sum(_VAL).alias("_rt_bucket"), F.sum(_RES).alias("_rt_rest"))
    w_prev = (
        Window.partitionBy(*part)
        .orderBy(*[F.col(c).asc_nulls_first() for c in split])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # A first bucket has no sum before it: NULL, which a sum skips.
    before = buckets.select(*bucket_keys, F.sum("_rt_bucket").over(w_prev).cast(CU_TOTAL).alias(_VAL), F.sum("_rt_rest").over(w_prev).alias(_RES))
    if opening is not None:
        before = _opened(before, opening, part)
    offsets = before.withColumn(_MARK, F.lit(0)).repartition(n, *bucket_keys)

    stream = rows.unionByName(offsets, allowMissingColumns=True)
    w_run = (
        Window.partitionBy(*bucket_keys)
        .orderBy(F.col(_MARK).asc(), *[F.col(c).asc_nulls_first() for c in within])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = stream.withColumn(out, F.sum(_VAL).over(w_run).cast("double") + F.sum(_RES).over(w_run))
    return running.filter(F.col(_MARK) == 1).drop(_MARK, _VAL, _RES)


def _opened(before: DataFrame, opening: DataFrame, part: list[str]) -> DataFrame:
    """Sums before each bucket, with the group's opening balance in them."""
    o = opening.select(*[F.col(k).alias(f"_rt_{k}") for k in part], "opening", "opening_rest")
    same = F.lit(True)
    for k in part:
        same = same & F.col(k).eqNullSafe(F.col(f"_rt_{k}"))
    both = before.join(o, same, "left").drop(*[f"_rt_{k}" for k in part])

    def plus(a: str, b: str, kind: str):
        either = F.coalesce(F.col(a), F.col(b)).isNotNull()
        zero = F.lit(0).cast(kind)
        return F.when(either, (F.coalesce(F.col(a).cast(kind), zero) + F.coalesce(F.col(b).cast(kind), zero)).cast(kind))

    both = both.withColumn(_VAL, plus(_VAL, "opening", CU_TOTAL)).withColumn(_RES, plus(_RES, "opening_rest", "double"))
    return both.drop("opening", "opening_rest")


def _default_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running_sum_single_window(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    value: str,
    out: str,
) -> DataFrame:
    """The one-window form, for comparison and for small inputs."""
    w = (
        Window.partitionBy(*partition_by)
        .orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(out, F.sum(exact_cu(value)).over(w).cast("double") + F.sum(residual_cu(value)).over(w))
