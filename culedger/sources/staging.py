"""Staged batches: extracts land as parquet parts in the shared work folder,
then one merge reads them all.

The folder is under the cluster's shared area (next to
``spark.checkpoint.dir``), never a machine-local temp folder, so every
executor reads and writes the same files and a lost executor loses nothing.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from culedger.operators.dedupe import dedupe_first
from culedger.session import work_path

UNIT = ("unit_capacity_id", "unit_timepoint")


class StagedStore:
    """An append-only parquet folder with a declared schema."""

    def __init__(self, spark: SparkSession, label: str, schema: StructType, path: str | None = None):
        self.spark = spark
        self.schema = schema
        self.path = path or work_path(spark, "staging", f"{label}-{uuid.uuid4().hex}")

    def append(self, df: DataFrame) -> None:
        """Append one batch (microsecond timestamps, as parquet stores them).
        An empty batch writes no rows."""
        cols = [f.name for f in self.schema.fields]
        df.select(*cols).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        """Every staged row, typed; nothing staged gives an empty frame with
        the schema (not ``None``), so callers need no special case."""
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], self.schema)

    def delete(self) -> None:
        """Remove the folder through the cluster file system."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(p):
            fs.delete(p, True)


class UnitStore(StagedStore):
    """Extracts staged by unit of work: what was staged for a unit last is all
    that it has, however often it is collected.

    Each :meth:`put` is an attempt: its rows go to a folder of its own, then the
    list of units that it covers. Reading takes a unit's rows from the last
    attempt that lists it, so a retried unit replaces itself (by nothing, if it
    is empty now), units of other attempts stay, and an attempt that died before
    its list was written has no say. Folders are as many as attempts, not units.
    """

    def __init__(self, spark: SparkSession, label: str, schema: StructType, path: str | None = None, unit: Sequence[str] = UNIT):
        super().__init__(spark, label, schema, path)
        self.unit = list(unit)

    def put(self, rows: DataFrame, units: DataFrame, first_of: Sequence[str] = ()) -> None:
        """Stage ``rows`` as all that the ``units`` have. ``first_of``: of rows
        of a unit that are equal on these columns, the first stays (by all
        columns in order)."""
        attempt = time.time_ns()
        cols = [f.name for f in self.schema.fields]
        rows = rows.select(*cols)
        if first_of:
            rows = dedupe_first(rows, self.unit, first_of, cols)
        rows.write.parquet(f"{self.path}/rows/attempt={attempt}")
        units.select(*[F.col(c).cast(self.schema[c].dataType) for c in self.unit]).distinct().write.parquet(f"{self.path}/units/attempt={attempt}")

    def append(self, df: DataFrame) -> None:
        """Stage ``df`` for the units that it has rows of."""
        self.put(df, df.select(*self.unit))

    def _all(self, kind: str, schema: StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema.add("attempt", "long")).option("basePath", f"{self.path}/{kind}").parquet(f"{self.path}/{kind}")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        listed = self._all("units", StructType([self.schema[c] for c in self.unit]))
        last = listed.groupBy(*self.unit).agg(F.max("attempt").alias("last"))
        rows = self._all("rows", StructType(list(self.schema.fields)))
        u, r = last.alias("u"), rows.alias("r")
        same = F.col("r.attempt") == F.col("u.last")
        for c in self.unit:
            same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"u.{c}"))
        return r.join(u, same, "left_semi").select(*[f.name for f in self.schema.fields])
