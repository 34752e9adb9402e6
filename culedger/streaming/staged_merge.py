"""Structured Streaming form of stage-then-merge.

Collectors drop extract parts into a staging folder at their own pace; a
streaming query picks up new parts and merges each micro-batch into the
silver table with the same keyed upsert the batch job uses; with
``availableNow`` it drains what is staged and stops, like a scheduled run.

A part is merged at least once. The number of a merged batch is noted beside the
checkpoint, so a restart does not merge it again; only a driver that dies between
a merge and its note does. The merge is by key and repeating it changes nothing,
but for rows with a NULL CapacityId or TimePoint: they match nothing, and such a
repeat inserts them once more.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from culedger.functions.columns import half_minute_by_format
from culedger.plans import tables as T
from culedger.schemas import K7_EQ, K7_NULL_SAFE
from culedger.session import work_path
from culedger.sources.ingest import ingest_detail

TARGET = {"standard": T.SILVER_TP_METRICS, "autoscale": T.SILVER_TP_METRICS_AS}


def merge_staged_batch(lh: T.Lakehouse, batch: DataFrame, kind: str, load_time_col: str | None) -> None:
    """One micro-batch: normalise, dedupe, upsert on K7 (update+insert)."""
    rows = ingest_detail(batch, kind, load_time_col)
    lh.merge(TARGET[kind], rows, K7_EQ, K7_NULL_SAFE, "update")
    if kind == "autoscale":
        lh.delete_where(TARGET[kind], half_minute_by_format("TimePoint"))


def _noted(spark, checkpoint: str, batch: int, write: bool = False) -> bool:
    """Whether a batch is noted as merged; notes it if asked to."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}-merged/{batch}")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if write:
        fs.create(path, True).close()
    return fs.exists(path)


def start_staged_merge(
    lh: T.Lakehouse,
    staging_path: str,
    extract_schema: StructType,
    kind: str = "standard",
    load_time_col: str | None = "load_time",
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream from ``staging_path`` (parquet parts with
    ``extract_schema``) into the silver table of ``kind``."""
    spark = lh.spark
    lh.create_schemas()
    reader = spark.readStream.schema(extract_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(staging_path)
    # One checkpoint for each lakehouse, source folder and kind.
    own = hashlib.sha256(f"{lh.root}|{lh.prefix}|{staging_path.rstrip('/')}".encode()).hexdigest()[:16]
    ckpt = checkpoint or work_path(spark, "streams", f"staged-merge-{kind}-{own}")

    def each(batch: DataFrame, epoch_id: int) -> None:
        if not _noted(spark, ckpt, epoch_id):
            if not batch.isEmpty():
                merge_staged_batch(lh, batch, kind, load_time_col)
            _noted(spark, ckpt, epoch_id, write=True)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
