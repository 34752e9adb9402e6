"""Ingest of model extracts into the silver shapes.

An extract is whatever the capacity model returned for a unit of work, as a
DataFrame (read from staged files or produced by a fan-out). The functions
here normalise it: version-specific headers to canonical names, positional
detail columns to names, unit stamps, synthetic ids, load time, dedupe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culedger.functions.columns import with_synthetic_operation_id
from culedger.operators.dedupe import dedupe_latest
from culedger.schemas import (
    AUTOSCALE_EXTRACT_COLUMNS,
    CAPACITIES,
    CAPACITY_HEADERS,
    CAPACITY_ID_HEADER,
    CAPACITY_METRICS,
    DETAIL_EXTRACT_COLUMNS,
    K7,
    MEASURES_V37,
    MEASURES_V40_TO_V53,
    METRIC_MEASURES,
    TIMEPOINT_METRICS,
    TIMEPOINT_METRICS_AUTOSCALE,
    metric_header_map,
)


class ExtractSchemaError(ValueError):
    pass


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


# Capacity dimension ------------------------------------------------------------


def capacities_from_extract(raw: DataFrame, version: str) -> DataFrame:
    """4-column capacity list from a version's capacity query. Versions before
    v53 return no name column; CapacityName is then a typed NULL. Ids are
    upper-cased (they are matched case-insensitively upstream)."""
    headers = CAPACITY_HEADERS[version]
    missing = [h for h in headers if h not in raw.columns]
    if missing:
        raise ExtractSchemaError(f"capacity extract for {version} lacks {missing}")
    name = F.col(headers[1]) if "Capacity Name" in headers else F.lit(None).cast("string")
    out = raw.select(
        F.upper(F.col(headers[0])).alias("CapacityId"),
        name.alias("CapacityName"),
        F.col("state").alias("State"),
        F.col("Region").alias("Region"),
    )
    return _typed(out, CAPACITIES)


def capacity_extract(capacities: DataFrame, version: str) -> DataFrame:
    """The capacity query's result shape for ``version`` (inverse of
    :func:`capacities_from_extract`), used to feed the adapter."""
    headers = CAPACITY_HEADERS[version]
    cols = [F.col("CapacityId").alias(headers[0])]
    if "Capacity Name" in headers:
        cols.append(F.col("CapacityName").alias("Capacity Name"))
    cols += [F.col("State").alias("state"), F.col("Region").alias("Region")]
    return capacities.select(*cols)


# Capacity metrics ----------------------------------------------------------------


def metrics_from_extract(raw: DataFrame, version: str) -> DataFrame:
    """21 canonical columns from an extract headed by query aliases, by the
    version's measure names, or by canonical names. Unknown headers and
    missing measures raise; ids are upper-cased; measures cast to double."""
    mapping = metric_header_map(version)
    unknown = [c for c in raw.columns if c not in mapping]
    if unknown:
        raise ExtractSchemaError(f"unknown columns for model {version}: {unknown}")
    by_canon: dict[str, str] = {}
    for c in raw.columns:
        canon = mapping[c]
        if canon in by_canon:
            raise ExtractSchemaError(f"columns {by_canon[canon]!r} and {c!r} both map to {canon}")
        by_canon[canon] = c
    missing = [c for c in ["CapacityId", "TimePoint"] + METRIC_MEASURES if c not in by_canon]
    if missing:
        raise ExtractSchemaError(f"extract for model {version} lacks {missing}")
    cols: list[Column] = [F.upper(F.col(f"`{by_canon['CapacityId']}`")).alias("CapacityId")]
    cols.append(F.col(f"`{by_canon['TimePoint']}`").alias("TimePoint"))
    cols += [F.col(f"`{by_canon[m]}`").alias(m) for m in METRIC_MEASURES]
    return _typed(raw.select(*cols), CAPACITY_METRICS)


def metrics_extract(metrics: DataFrame, version: str, by: str = "measure") -> DataFrame:
    """Canonical metrics renamed the way ``version`` heads its extract
    (``by='measure'``: measure names; ``by='alias'``: query aliases)."""
    from culedger.schemas import METRIC_QUERY_ALIASES

    names = MEASURES_V37 if version == "v37" else MEASURES_V40_TO_V53
    if by == "alias":
        names = METRIC_QUERY_ALIASES
    cols = [F.col("CapacityId").alias(f"Capacities[{CAPACITY_ID_HEADER[version]}]"), F.col("TimePoint").alias("TimePoints[TimePoint]")]
    cols += [F.col(m).alias(n) for m, n in zip(METRIC_MEASURES, names)]
    return metrics.select(*cols)


# Detail extracts -----------------------------------------------------------------


def _unit_columns() -> list[str]:
    return ["unit_capacity_id", "unit_timepoint"]


def detail_extract(silver_detail: DataFrame, load_time_col: str = "insert_date") -> DataFrame:
    """A standard-detail extract as it arrives: 17 positional columns under
    the model's own headers, the unit it was fetched for (capacity id as the
    caller typed it), and the load time."""
    cols = [F.col(c).alias(f"c{i:02d}") for i, c in enumerate(DETAIL_EXTRACT_COLUMNS)]
    return silver_detail.select(
        *cols,
        F.lower("CapacityId").alias("unit_capacity_id"),
        F.col("TimePoint").alias("unit_timepoint"),
        F.col(load_time_col).alias("load_time"),
    )


def autoscale_extract(silver_autoscale: DataFrame, load_time_col: str = "insert_date") -> DataFrame:
    cols = [F.col(c).alias(f"c{i:02d}") for i, c in enumerate(AUTOSCALE_EXTRACT_COLUMNS)]
    return silver_autoscale.select(
        *cols,
        F.lower("CapacityId").alias("unit_capacity_id"),
        F.col("TimePoint").alias("unit_timepoint"),
        F.col(load_time_col).alias("load_time"),
    )


def ingest_detail(raw: DataFrame, kind: str = "standard", load_time_col: str | None = None) -> DataFrame:
    """Extract -> silver detail rows ready to merge.

    1. positional rename of the extract columns (17 standard / 14 autoscale);
    2. stamp TimePoint and the upper-cased CapacityId of the unit;
    3. synthetic ids for NULL operation ids;
    4. ``insert_date`` = the load-time column, or ``current_timestamp()``;
    5. latest row per K7 (deterministic survivor).
    """
    names = DETAIL_EXTRACT_COLUMNS if kind == "standard" else AUTOSCALE_EXTRACT_COLUMNS
    schema = TIMEPOINT_METRICS if kind == "standard" else TIMEPOINT_METRICS_AUTOSCALE
    payload = [c for c in raw.columns if c not in set(_unit_columns()) | {load_time_col}]
    if len(payload) != len(names):
        raise ExtractSchemaError(f"{kind} extract has {len(payload)} columns, expected {len(names)}")
    load = F.col(load_time_col) if load_time_col else F.current_timestamp().cast("timestamp_ntz")
    df = raw.select(
        *[F.col(f"`{src}`").alias(dst) for src, dst in zip(payload, names)],
        F.col("unit_timepoint").alias("TimePoint"),
        F.upper("unit_capacity_id").alias("CapacityId"),
        load.alias("insert_date"),
    )
    df = with_synthetic_operation_id(_typed(df, schema))
    return dedupe_latest(df, K7)
