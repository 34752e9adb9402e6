"""Deduplication with a deterministic survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str = "insert_date",
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Latest row per key: ``row_number() over (partition by keys order by
    order_col desc nulls last, tiebreak...) = 1``.

    Keys group NULLs together (null-safe). ``tiebreak`` defaults to every other
    column, so the survivor never depends on input order. Catalyst plans the
    ``= 1`` filter as a WindowGroupLimit that also runs before the shuffle, so
    a key repeated millions of times is cut down map-side.

    Without ``order_col`` in the frame this falls back to :func:`dedupe_any`.
    """
    if order_col not in df.columns:
        return dedupe_any(df, keys, tiebreak)
    rest = [c for c in df.columns if c not in set(keys) | {order_col}] if tiebreak is None else list(tiebreak)
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in rest])
    return df.withColumn("_merge_rank", F.row_number().over(w)).filter(F.col("_merge_rank") == 1).drop("_merge_rank")


def dedupe_any(df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per key. Where ``dropDuplicates`` keeps an arbitrary survivor,
    this keeps the first by ``tiebreak`` (default: all other columns)."""
    rest = [c for c in df.columns if c not in set(keys)] if tiebreak is None else list(tiebreak)
    if not rest:
        return df.dropDuplicates(list(keys))
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in rest])
    return df.withColumn("_any_rank", F.row_number().over(w)).filter(F.col("_any_rank") == 1).drop("_any_rank")


def dedupe_first(df: DataFrame, unit: Sequence[str], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep-first within a batch unit (e.g. one capacity/timepoint extract):
    first row per ``unit + keys`` by the batch order columns."""
    part = list(dict.fromkeys(list(unit) + list(keys)))
    w = Window.partitionBy(*part).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("_first_rank", F.row_number().over(w)).filter(F.col("_first_rank") == 1).drop("_first_rank")


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows minus distinct keys, in one aggregate (NULL keys compare equal).

    Aggregates per key first (partial aggregation map-side), then sums, so a
    hot key never travels as individual rows.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
    ).select("total_rows", "distinct_keys", (F.col("total_rows") - F.col("distinct_keys")).alias("duplicates"))


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Guard before a merge: raise if the source repeats a key (a keyed merge
    with two source rows for one target row is ambiguous)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"merge source has duplicate keys {list(keys)}: {dup[0].asDict()}")
