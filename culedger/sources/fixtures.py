"""Silver inputs derived from the driver tables (FIXTURES.md section 2).

The reference lands extracts of an external capacity model; here the same
shapes are derived from ``events`` (one operation per event), ``customer``
(user, workspace), ``part`` (item), and ``supplier``/``nation``/``region``
(capacity dimension). Everything is lazy DataFrame code, so callers' filters
and projections reach the parquet scans.

Redelivery (the same operation extracted twice, the second time with doubled
CU and a later load time) is produced with one ``explode`` over a single scan
instead of a self-union, so ``events`` is read and joined once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from culedger.functions.columns import cu_sum, trunc_seconds
from culedger.schemas import AUTOSCALE_EXTRACT_COLUMNS, DETAIL_EXTRACT_COLUMNS, METRIC_MEASURES

# Constants of the derived fixture.
BILLING_TYPE = "Billable"
VIRTUALISED_WORKSPACE = "No"
AUTOSCALE_LIMIT = 64.0
CAPACITY_STATE = "Active"
#: CU-seconds a 64-CU capacity can spend in one 30-second timepoint.
SKU_CU_PER_TIMEPOINT = 1920.0
BACKGROUND_EVENT_TYPES = ["error", "view"]


#: Declared schemas of the driver tables this library reads. Reading with a
#: schema skips footer inference (one footer read per file listing on a
#: cluster) and pins the timestamp type to TIMESTAMP_NTZ.
DRIVER_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event with every derived detail column plus ``event_id``.

    ``customer`` and ``part`` are dimensions: Spark picks a broadcast join when
    their measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and a
    shuffle join otherwise, so nothing here assumes they stay small.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    ev = ev.withColumn("k", _k())
    base = ev.join(cust, ev.user_id == cust.c_custkey, "inner").join(part, F.col("k") == part.p_partkey, "inner")
    sec = trunc_seconds("ts")
    eid = F.col("event_id")
    start = F.when(eid % 11 == 0, F.lit(None)).otherwise(sec)
    end = F.when(eid % 13 == 0, F.lit(None)).otherwise(sec + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (eid % 90).cast("decimal(8,6)")))
    return base.select(
        "event_id",
        start.alias("Operation_start_time"),
        end.alias("Operation_end_time"),
        F.when(F.col("event_type") == "error", "Failure").otherwise("Success").alias("Status"),
        F.col("event_type").alias("Operation"),
        F.col("c_name").alias("User"),
        F.col("c_mktsegment").alias("Workspace_name"),
        F.col("p_type").alias("Item_kind"),
        F.when(eid % 50 == 0, F.lit(None)).otherwise(F.concat(F.lit("key-"), (F.col("k") % 10).cast("string"))).alias("Unique_key"),
        F.lit(BILLING_TYPE).alias("Billing_type"),
        F.when(eid % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("op-"), (F.col("user_id") % 50).cast("string"))).alias("Operation_Id"),
        F.lit(VIRTUALISED_WORKSPACE).alias("Virtualised_workspace"),
        start.alias("Start"),
        end.alias("End"),
        F.col("p_name").alias("Item_name"),
        F.lit(False).alias("IsGrandTotalRowTotal"),
        (eid % 90).cast("double").alias("SumDuration_s"),
        F.col("value").alias("CU"),
        trunc_seconds("ts", 30).alias("TimePoint"),
        F.concat(F.lit("CAP-"), F.lpad((F.col("user_id") % 4).cast("string"), 2, "0")).alias("CapacityId"),
        F.col("ts").alias("insert_date"),
        F.col("event_type"),
    )


def _with_redelivery(ops: DataFrame) -> DataFrame:
    """Every fifth operation is delivered a second time, one day later, with
    doubled CU. ``copy`` is 0 for the first delivery and 1 for the repeat."""
    copies = F.when(F.col("event_id") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = ops.withColumn("copy", F.explode(copies))
    return out.withColumn("CU", F.col("CU") * (F.col("copy") + 1)).withColumn(
        "insert_date", F.col("insert_date") + F.make_dt_interval(F.col("copy"))
    )


def silver_detail(spark: SparkSession, sf_dir: str, redelivery: bool = True, keep_lineage: bool = False) -> DataFrame:
    """``silver.timepoint_metrics`` shape (standard detail).

    ``keep_lineage`` keeps ``event_id`` and ``copy`` for tests that compare rows.
    """
    ops = operations(spark, sf_dir)
    if redelivery:
        ops = _with_redelivery(ops)
    cols = [c if c != "SumTotal_CU_s" else F.col("CU").alias("SumTotal_CU_s") for c in DETAIL_EXTRACT_COLUMNS]
    extra = ["event_id"] + (["copy"] if redelivery else []) if keep_lineage else []
    return ops.select(*cols, "TimePoint", "CapacityId", "insert_date", *extra)


def silver_autoscale(spark: SparkSession, sf_dir: str, redelivery: bool = True, keep_lineage: bool = False) -> DataFrame:
    """``silver.timepoint_metrics_autoscale`` shape (autoscale detail)."""
    ops = operations(spark, sf_dir)
    if redelivery:
        ops = _with_redelivery(ops)
    special = {
        "SumCU_s": F.col("CU").alias("SumCU_s"),
        "Timepoint_workload_autoscale_limit": F.lit(AUTOSCALE_LIMIT).alias("Timepoint_workload_autoscale_limit"),
    }
    cols = [special.get(c, c) for c in AUTOSCALE_EXTRACT_COLUMNS]
    extra = ["event_id"] + (["copy"] if redelivery else []) if keep_lineage else []
    return ops.select(*cols, "TimePoint", "CapacityId", "insert_date", *extra)


def metric_measures(ops: DataFrame) -> DataFrame:
    """Capacity metrics per (CapacityId, TimePoint) from operation rows.

    Measures not derivable from the driver tables are constants or NULL. Sums
    are exact; ratios divide the double sum.
    """
    background = F.col("event_type").isin(*BACKGROUND_EVENT_TYPES)
    bg = cu_sum(F.when(background, F.col("CU")))
    it = cu_sum(F.when(~background, F.col("CU")))
    total = cu_sum("CU")
    sku = F.lit(SKU_CU_PER_TIMEPOINT)
    agg = ops.groupBy("CapacityId", "TimePoint").agg(
        (bg / sku).alias("BackgroundPercentage"),
        (it / sku).alias("InteractivePercentage"),
        total.alias("TotalCUs"),
    )
    values = {
        "BackgroundPercentage": F.col("BackgroundPercentage"),
        "InteractivePercentage": F.col("InteractivePercentage"),
        "BackgroundNonBillablePercentage": F.lit(0.0),
        "InteractiveNonBillablePercentage": F.lit(0.0),
        "AutoscalePercentage": F.lit(None).cast("double"),
        "CULimitPercentage": F.lit(100.0),
        "TotalCUUsagePercentage": F.col("TotalCUs") / sku,
        "TotalCUs": F.col("TotalCUs"),
        "SKUCUByTimePoint": sku,
        "InteractiveDelayPercentage": F.lit(0.0),
        "InteractiveRejectionPercentage": F.lit(0.0),
        "InteractiveRejectionThreshold": F.lit(100.0),
        "BackgroundRejectionPercentage": F.lit(0.0),
        "BackgroundRejectionThreshold": F.lit(100.0),
        "CarryOverAddedPercentage": F.lit(None).cast("double"),
        "CarryOverBurndownPercentage": F.lit(None).cast("double"),
        "CarryOverCumulativePercentage": F.lit(None).cast("double"),
        "OverageReferenceLine": F.lit(100.0),
        "ExpectedBurndownInMin": F.lit(None).cast("double"),
    }
    return agg.select("CapacityId", "TimePoint", *[values[m].alias(m) for m in METRIC_MEASURES])


def silver_timepoints(spark: SparkSession, sf_dir: str, redelivery: bool = False) -> DataFrame:
    """``silver.capacity_metrics_timepoints`` (21 columns)."""
    ops = operations(spark, sf_dir)
    if redelivery:
        ops = _with_redelivery(ops)
    return metric_measures(ops)


def silver_capacities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``silver.capacities`` from supplier, nation and region."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    reg = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = sup.join(nat, sup.s_nationkey == nat.n_nationkey, "inner").join(reg, F.col("n_regionkey") == reg.r_regionkey, "inner")
    return j.select(
        F.format_string("CAP-%02d", F.col("s_suppkey")).alias("CapacityId"),
        F.col("s_name").alias("CapacityName"),
        F.lit(CAPACITY_STATE).alias("State"),
        F.col("r_name").alias("Region"),
    )


def active_capacities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capacities seen in the operations, as an earlier capacity list would
    have them (no name, no region yet)."""
    ops = operations(spark, sf_dir).select("CapacityId").distinct()
    return ops.select(
        "CapacityId",
        F.lit(None).cast("string").alias("CapacityName"),
        F.lit("Provisioning").alias("State"),
        F.lit(None).cast("string").alias("Region"),
    )
