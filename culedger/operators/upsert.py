"""Keyed upsert as a pure DataFrame function.

Semantics of a keyed MERGE with ``whenMatchedUpdateAll`` /
``whenNotMatchedInsertAll``, written with joins Spark plans natively:

- ``update``  : target rows matched by no source row, plus every source row
                (matched rows are replaced whole).
- ``insert``  : every target row, plus source rows matched by no target row
                (matched target rows stay untouched).

Keys compare either with ``=`` (a NULL never matches, so a NULL-key source row
is always inserted) or null-safe ``<=>``. Both are equi-join keys, so the
anti-join is a sort-merge or broadcast hash join, never a nested loop.

The source must be unique on the keys (:func:`culedger.operators.dedupe.require_unique`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WHEN_MATCHED = ("update", "insert")


def _match(left: str, right: str, eq_keys: Sequence[str], null_safe_keys: Sequence[str]):
    # Qualified names, so a source derived from the target (a self-join) still
    # resolves each side correctly.
    L = lambda k: F.col(f"{left}.{k}")
    R = lambda k: F.col(f"{right}.{k}")
    cond = [L(k) == R(k) for k in eq_keys] + [L(k).eqNullSafe(R(k)) for k in null_safe_keys]
    if not cond:
        raise ValueError("upsert needs at least one key")
    out = cond[0]
    for c in cond[1:]:
        out = out & c
    return out


def _keys_only(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Only the keys take part in the anti-join probe side: a narrow shuffle.
    return df.select(*[F.col(k) for k in keys])


def unmatched(rows: DataFrame, others: DataFrame, eq_keys: Sequence[str], null_safe_keys: Sequence[str]) -> DataFrame:
    """The rows that no row of ``others`` matches."""
    probe = _keys_only(others, [*eq_keys, *null_safe_keys]).alias("t")
    return rows.alias("s").join(probe, _match("s", "t", eq_keys, null_safe_keys), "left_anti")


def upsert(
    target: DataFrame,
    source: DataFrame,
    eq_keys: Sequence[str],
    null_safe_keys: Sequence[str] = (),
    when_matched: str = "update",
) -> DataFrame:
    """Merge ``source`` into ``target`` by key; returns the new target rows.

    Column sets are matched by name; a column only in ``source`` is added to
    the result (NULL for old target rows), a column only in ``target`` is kept
    (NULL for inserted rows) -- additive schema evolution.
    """
    if when_matched not in WHEN_MATCHED:
        raise ValueError(f"when_matched must be one of {WHEN_MATCHED}")
    keys = list(eq_keys) + list(null_safe_keys)
    if when_matched == "update":
        probe = _keys_only(source, keys).alias("s")
        kept = target.alias("t").join(probe, _match("t", "s", eq_keys, null_safe_keys), "left_anti")
        return kept.unionByName(source, allowMissingColumns=True)
    return target.unionByName(unmatched(source, target, eq_keys, null_safe_keys), allowMissingColumns=True)


def upsert_detail(target: DataFrame, source: DataFrame, when_matched: str = "update") -> DataFrame:
    """Upsert on K7: CapacityId and TimePoint with ``=``, the rest ``<=>``."""
    from culedger.schemas import K7_EQ, K7_NULL_SAFE

    return upsert(target, source, K7_EQ, K7_NULL_SAFE, when_matched)
