"""Catalog tables for the silver and gold layers, without a transactional
table format.

- A table is an external parquet table under the lakehouse root (a folder in
  the cluster's shared work area, next to ``spark.checkpoint.dir``).
- Detail and metric tables are partitioned by ``Date = to_date(TimePoint)``.
  TimePoint is part of every multi-column merge key, so a source row can only
  match target rows of its own Date. The dates a source touches are read from
  its staged copy (one value a day, bounded by the calendar) and become a
  literal partition predicate, NULL included: only those partitions are listed
  and read.
- A merge compares keys in one shuffle: the guard that refuses a source which
  repeats a key is a window on the partitioning that the join needs, so it
  raises inside the job that finds what changed, before anything is written.
- Insert-only merges append the rows that have no match. Updating merges
  rewrite only the dates that hold a changed or new row, and append where rows
  are new only; a merge that changes nothing writes nothing. What is rewritten
  replaces its partitions by a dynamic partition overwrite, an option of each
  table, so sessions and threads need not agree on a setting: Spark writes the
  new files aside and swaps folders when the job has ended, and a merge that
  died half-way can simply be rerun.
- Files are laid out by size: rows are rebalanced on ``Date``, so a large day is
  cut over as many tasks as ``spark.sql.adaptive.advisoryPartitionSizeInBytes``
  asks for and small days share one.
- A table with ``buckets`` is bucketed on the ``=`` keys of its merges instead:
  a merge joins on the buckets' own distribution, and the target is not
  shuffled at all.
- Each write returns a :class:`WriteReport` with counts that Spark observes
  during the write.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from culedger.operators.dedupe import require_unique
from culedger.session import work_path

PARTITION_COL = "Date"

# Table names of the two layers.
SILVER_SCHEMA = "silver"
GOLD_SCHEMA = "gold"
SILVER_CAPACITIES = "silver.capacities"
SILVER_TIMEPOINTS = "silver.capacity_metrics_timepoints"
SILVER_TP_METRICS = "silver.timepoint_metrics"
SILVER_TP_METRICS_AS = "silver.timepoint_metrics_autoscale"
GOLD_CAPACITIES = "gold.capacities"
GOLD_METRICS_BY_TIMEPOINT = "gold.capacity_metrics_by_timepoint"
GOLD_CALENDAR_TIMEPOINTS = "gold.capacity_calendar_timepoints"
GOLD_TP_METRICS = "gold.timepoint_metrics"
GOLD_TP_METRICS_AS = "gold.timepoint_metrics_autoscale"
GOLD_BALANCES = "gold.autoscale_balances"

#: Tables partitioned by Date (all but the capacity dimension).
PARTITIONED = {
    SILVER_TIMEPOINTS,
    SILVER_TP_METRICS,
    SILVER_TP_METRICS_AS,
    GOLD_METRICS_BY_TIMEPOINT,
    GOLD_CALENDAR_TIMEPOINTS,
    GOLD_TP_METRICS,
    GOLD_TP_METRICS_AS,
    GOLD_BALANCES,
}


#: What the key of a merge is refused with.
REPEATED = "merge source has duplicate keys"
#: Shuffle partitions for each date of a rebalanced write: so many that a small
#: date seldom shares one with a large date, which is cut up; Spark joins them.
PARTITIONS_PER_DATE = 16
#: Helper columns of a merge.
_REST, _COPY, _OLD, _STATE = "_merge_rest", "_merge_copy", "_merge_old", "_merge_state"


@dataclass
class WriteReport:
    """Rows that a write read, inserted, updated and deleted, as observed while
    it ran (a task that Spark repeats may count twice; nothing is decided by
    them)."""

    read: int = 0
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    dates: list = field(default_factory=list)

    def counts(self) -> dict:
        return {"read": self.read, "inserted": self.inserted, "updated": self.updated, "deleted": self.deleted}


@contextmanager
def cost_based(spark: SparkSession, on: bool = True):
    """Queries analysed within order their joins by the statistics that
    :meth:`Lakehouse.analyze` keeps."""
    keys = ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, str(on).lower())
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def with_date(df: DataFrame) -> DataFrame:
    if PARTITION_COL in df.columns:
        return df
    return df.withColumn(PARTITION_COL, F.to_date("TimePoint"))


class Lakehouse:
    """Silver/gold tables in the session catalog, stored under ``root``."""

    def __init__(self, spark: SparkSession, root: str | None = None, database_prefix: str = "", buckets: Mapping[str, tuple[int, Sequence[str]]] | None = None):
        """``buckets``: for tables that are to be bucketed when they are made,
        the number of buckets and the columns (the ``=`` keys of their merges).
        A bucket of a date is one file, so take a large day's bytes over the
        bytes that a task should hold."""
        self.spark = spark
        self.buckets = dict(buckets or {})
        if self.buckets:
            # A bucketed side keeps its distribution in joins on further keys.
            spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        self.root = (root or work_path(spark, "lakehouse")).rstrip("/")
        self.prefix = database_prefix

    # Names and paths ---------------------------------------------------------

    def name(self, table: str) -> str:
        schema, tbl = table.split(".")
        return f"{self.prefix}{schema}.{tbl}"

    def path(self, table: str) -> str:
        schema, tbl = table.split(".")
        return f"{self.root}/{self.prefix}{schema}/{tbl}"

    def staging(self, table: str) -> str:
        return f"{self.root}/_staging/{table.replace('.', '_')}-{uuid.uuid4().hex[:12]}"

    def create_schemas(self) -> None:
        for s in (SILVER_SCHEMA, GOLD_SCHEMA):
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.prefix}{s}")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def is_partitioned(self, table: str) -> bool:
        return table in PARTITIONED

    # Layout --------------------------------------------------------------------

    def _writer(self, table: str, df: DataFrame, mode: str):
        w = df.write.format("parquet").option("path", self.path(table)).option("partitionOverwriteMode", "dynamic").mode(mode)
        if self.is_partitioned(table):
            w = w.partitionBy(PARTITION_COL)
        if table in self.buckets:
            n, columns = self.buckets[table]
            w = w.bucketBy(n, *columns)
        return w

    def _create(self, table: str, df: DataFrame, mode: str = "errorifexists") -> None:
        self._writer(table, df, mode).saveAsTable(self.name(table))

    def _prepare(self, table: str, df: DataFrame) -> DataFrame:
        return with_date(df) if self.is_partitioned(table) else df

    def _clustered(self, table: str, df: DataFrame, dates: int = 1) -> DataFrame:
        """Rows as their files want them: a bucket in one task, or dates
        rebalanced by size."""
        if table in self.buckets:
            n, columns = self.buckets[table]
            return df.repartition(n, *columns)
        if not self.is_partitioned(table):
            return df
        parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), PARTITIONS_PER_DATE * dates)
        return df.hint("rebalance", parts, PARTITION_COL)

    # Folders -------------------------------------------------------------------

    def _folder(self, path: str):
        """Hadoop file system and path of a folder of this lakehouse; refuses
        any folder that is not under its root."""
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
        root = fs.makeQualified(sc._jvm.org.apache.hadoop.fs.Path(self.root)).toString().rstrip("/")
        if not fs.makeQualified(p).toString().startswith(root + "/"):
            raise ValueError(f"{path} is not under {self.root}")
        return fs, p

    def _delete_folder(self, path: str) -> None:
        fs, p = self._folder(path)
        if fs.exists(p):
            fs.delete(p, True)

    @contextmanager
    def _staged(self, table: str, df: DataFrame):
        """(``df`` written to a staging folder and read back with the same
        schema, its number of rows and its dates): the lineage is cut at a
        shared copy, which is removed afterwards. A staged copy is partitioned
        by date where the table is."""
        path = self.staging(table)
        parted = self.is_partitioned(table)
        df, seen = self._observed(table, df)
        w = df.write.partitionBy(PARTITION_COL) if parted else df.write
        try:
            w.parquet(path)
            found = seen.get
            yield self.spark.read.schema(df.schema).parquet(path), found["rows"], self._seen_dates(found)
        finally:
            self._delete_folder(path)

    # Counts --------------------------------------------------------------------

    def _observed(self, table: str, df: DataFrame) -> tuple[DataFrame, Observation]:
        """``df`` with its rows counted and its dates gathered (a value a day)
        as they pass."""
        seen = Observation()
        what = [F.count(F.lit(1)).alias("rows")]
        if self.is_partitioned(table):
            what += [F.collect_set(PARTITION_COL).alias("dates"), F.count_if(F.col(PARTITION_COL).isNull()).alias("undated")]
        return df.observe(seen, *what), seen

    @staticmethod
    def _seen_dates(found: dict) -> list:
        return sorted(found.get("dates") or []) + [None] * bool(found.get("undated"))

    @staticmethod
    def _dates(df: DataFrame) -> list:
        """Distinct dates, NULL included: bounded by the calendar."""
        return [r[0] for r in df.select(PARTITION_COL).distinct().collect()]

    @staticmethod
    def on_dates(df: DataFrame, dates: list) -> DataFrame:
        """Rows of these dates, as a literal partition predicate; NULL is a
        date of its own here."""
        known = [d for d in dates if d is not None]
        keep = F.col(PARTITION_COL).isin(known) if known else F.lit(False)
        if None in dates:
            keep = keep | F.col(PARTITION_COL).isNull()
        return df.filter(keep)

    # Columns -------------------------------------------------------------------

    def _add_columns(self, table: str, df: DataFrame) -> None:
        """Additive evolution: columns that only ``df`` has join the table."""
        have = self.read(table).columns
        added = [f for f in df.schema.fields if f.name not in have]
        if added:
            spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({spec})")
            self.spark.catalog.refreshTable(self.name(table))

    def _shaped(self, table: str, df: DataFrame) -> DataFrame:
        """``df`` with the table's columns; what it lacks is NULL."""
        fields = self.read(table).schema.fields
        return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields])

    # Writes --------------------------------------------------------------------

    def _insert(self, table: str, df: DataFrame, overwrite: bool, dates: int = 1, clustered: bool = False) -> dict:
        """Append, or replace the partitions that ``df`` has rows in; ``df`` may
        read the table. Returns what was observed."""
        df = df.select(*self.read(table).columns)
        df, seen = self._observed(table, df if clustered else self._clustered(table, df, dates))
        df.write.insertInto(self.name(table), overwrite=overwrite)
        self.spark.catalog.refreshTable(self.name(table))
        return seen.get

    def overwrite(self, table: str, df: DataFrame, merge_schema: bool = True) -> WriteReport:
        """Full refresh. With ``merge_schema``, columns the old table had and
        the new rows lack are kept as NULL (additive evolution)."""
        df = self._prepare(table, df)
        if not self.exists(table):
            return self._first(table, df)
        current = self.read(table).schema
        if merge_schema:
            for f in current.fields:
                if f.name not in df.columns:
                    df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
        same = all(f.name in df.columns and df.schema[f.name].dataType == f.dataType for f in current.fields)
        if not (same and self.is_partitioned(table)):
            df, seen = self._observed(table, df)
            self._replace(table, df)
            found = seen.get
            return WriteReport(read=found["rows"], inserted=found["rows"], dates=self._seen_dates(found))
        self._add_columns(table, df)
        before = self._dates(self.read(table))
        found = self._insert(table, self._shaped(table, df), True, len(before) + 1)
        kept = self._seen_dates(found)
        self._drop_dates(table, [d for d in before if d not in kept])
        return WriteReport(read=found["rows"], inserted=found["rows"], dates=kept)

    def _first(self, table: str, df: DataFrame) -> WriteReport:
        df, seen = self._observed(table, self._clustered(table, df))
        self._create(table, df)
        found = seen.get
        return WriteReport(read=found["rows"], inserted=found["rows"], dates=self._seen_dates(found))

    def append(self, table: str, df: DataFrame, merge_schema: bool = True) -> WriteReport:
        """Append rows (create on first write). With ``merge_schema``, columns
        new in ``df`` are added to the table first (additive evolution);
        columns ``df`` lacks are appended as NULL."""
        df = self._prepare(table, df)
        if not self.exists(table):
            return self._first(table, df)
        added = [c for c in df.columns if c not in self.read(table).columns]
        if added and not merge_schema:
            raise ValueError(f"columns {added} are not in {table}")
        self._add_columns(table, df)
        found = self._insert(table, self._shaped(table, df), False)
        return WriteReport(read=found["rows"], inserted=found["rows"], dates=self._seen_dates(found))

    # Merge ---------------------------------------------------------------------

    def _keyed(self, table: str, source: DataFrame, eq_keys: Sequence[str], null_safe_keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
        """(``source`` with the rest of its key as one column, the columns to
        join on). The null-safe keys become one struct: a struct is not null,
        and nulls inside structs are equal. Rows of one key raise if there is a
        second, on the partitioning that a join on the same columns uses."""
        on = [*eq_keys, *([_REST] if null_safe_keys else [])]
        if null_safe_keys:
            source = source.withColumn(_REST, F.struct(*null_safe_keys))
        if table in self.buckets and set(self.buckets[table][1]) <= set(eq_keys):
            n, columns = self.buckets[table]
            source = source.repartition(n, *columns)
        known = F.lit(True)
        for k in eq_keys:
            known = known & F.col(k).isNotNull()
        copy = F.row_number().over(Window.partitionBy(*on).orderBy(*on))
        names = ", ".join([*eq_keys, *null_safe_keys])
        shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in [*eq_keys, *null_safe_keys]])
        refuse = F.raise_error(F.concat(F.lit(f"{REPEATED} [{names}]: "), shown))
        checked = source.withColumn(_COPY, copy).filter(F.when(known & (F.col(_COPY) > 1), refuse).otherwise(F.lit(True)))
        return checked.drop(_COPY), on

    @staticmethod
    @contextmanager
    def _refusing():
        """A refused key as a ValueError."""
        try:
            yield
        except PySparkException as ex:
            at = str(ex).find(REPEATED)
            if at < 0:
                raise
            raise ValueError(str(ex)[at:].split("SQLSTATE")[0].strip()) from ex

    def changes(self, table: str, rows: DataFrame, target: DataFrame, eq_keys: Sequence[str], null_safe_keys: Sequence[str] = ()) -> DataFrame:
        """Rows (Date, inserted, updated): for each date of the merge source
        ``rows``, how many rows are new in ``target`` and how many differ from
        the row they match. Repeated keys raise."""
        checked, on = self._keyed(table, rows, eq_keys, null_safe_keys)
        old = target.withColumn(_REST, F.struct(*null_safe_keys)) if null_safe_keys else target
        rest = [c for c in rows.columns if c not in on]
        old = old.select(*on, F.struct(*rest).alias(_OLD))
        joined = checked.join(old, on, "left")
        alike = F.col(_OLD) == F.struct(*rest)
        state = F.when(F.col(_OLD).isNull(), "new").when(~alike, "changed")
        date = F.col(PARTITION_COL) if self.is_partitioned(table) else F.lit(None).cast("date").alias(PARTITION_COL)
        out = joined.select(date, state.alias(_STATE)).groupBy(PARTITION_COL)
        return out.agg(F.count_if(F.col(_STATE) == "new").alias("inserted"), F.count_if(F.col(_STATE) == "changed").alias("updated"))

    def merged(self, table: str, target: DataFrame, rows: DataFrame, eq_keys: Sequence[str], null_safe_keys: Sequence[str] = (), when_matched: str = "update") -> DataFrame:
        """What the merge writes: the target rows that ``rows`` leaves and all of
        ``rows`` (update), or the rows that no target row matches (insert)."""
        checked, on = self._keyed(table, rows, eq_keys, null_safe_keys)
        old = target.withColumn(_REST, F.struct(*null_safe_keys)) if null_safe_keys else target
        if when_matched == "insert":
            return checked.join(old.select(*on), on, "left_anti").select(*rows.columns)
        kept = old.join(checked.select(*on), on, "left_anti")
        return kept.select(*rows.columns).unionByName(checked.select(*rows.columns))

    def merge(
        self,
        table: str,
        source: DataFrame,
        eq_keys: Sequence[str],
        null_safe_keys: Sequence[str] = (),
        when_matched: str = "update",
        note: Callable[[list], None] | None = None,
    ) -> WriteReport:
        """Keyed upsert of ``source`` into ``table`` (created if missing).
        Columns that only the source has are added to the table; a source that
        repeats a key (NULL in an ``=`` key matches nothing and may repeat)
        raises ValueError before anything is written. ``note`` is called with
        the source's dates before the table is touched."""
        source = self._prepare(table, source)
        parted = self.is_partitioned(table)
        # The source feeds the search for changes and the write: written once,
        # an expensive source plan runs once.
        with self._staged(table, source) as (staged, read, dates), self._refusing():
            if note:
                note(dates)
            if not self.exists(table):
                checked, _ = self._keyed(table, staged, eq_keys, null_safe_keys)
                made = self._first(table, checked.select(*staged.columns))
                return WriteReport(read=read, inserted=made.inserted, dates=dates)
            if [c for c in staged.columns if c not in self.read(table).columns]:
                # The definition changes before the write does: look first.
                keyed = staged.dropna(subset=list(eq_keys))
                require_unique(keyed, [*eq_keys, *null_safe_keys])
                self._add_columns(table, staged)
            rows = self._shaped(table, staged)
            target = self.on_dates(self.read(table), dates) if parted else self.read(table)
            if when_matched == "insert" and parted:
                new = self.merged(table, target, rows, eq_keys, null_safe_keys, "insert")
                found = self._insert(table, new, False, len(dates), table in self.buckets)
                return WriteReport(read=read, inserted=found["rows"], dates=self._seen_dates(found))
            found = self.changes(table, rows, target, eq_keys, null_safe_keys).collect()  # a row a date
            done = WriteReport(read=read, inserted=sum(r["inserted"] for r in found), updated=sum(r["updated"] for r in found) * (when_matched == "update"))
            done.dates = [r[PARTITION_COL] for r in found if r["inserted"] or r["updated"]] if parted else []
            if not done.inserted and not done.updated:
                return done
            if not parted:
                new = self.merged(table, target, rows, eq_keys, null_safe_keys, when_matched)
                self._replace(table, target.unionByName(new) if when_matched == "insert" else new)
                return done
            own = table in self.buckets
            if not done.updated:
                self._insert(table, self.merged(table, target, rows, eq_keys, null_safe_keys, "insert"), False, len(done.dates), own)
                return done
            new = self.merged(table, self.on_dates(target, done.dates), self.on_dates(rows, done.dates), eq_keys, null_safe_keys)
            self._insert(table, new, True, len(done.dates), own)
            return done

    def location(self, table: str) -> str:
        """The folder the catalog currently points ``table`` at."""
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").filter(F.col("col_name") == "Location").collect()
        return rows[0][1] if rows else self.path(table)

    def _replace(self, table: str, df: DataFrame) -> None:
        """New contents for an existing table, swapped in as a whole.

        ``df`` may read the table itself: it is written to a fresh version
        folder, never over the files it reads. Only then the catalog changes: it
        points the table at that folder, or, where columns were dropped or
        retyped, defines it anew there. A job that dies before leaves the table
        exactly as it was, and no step deletes a file. The folder before stays
        for readers that are still on it; :meth:`remove_old_versions` deletes
        such folders.
        """
        name = self.name(table)
        current = self.read(table).schema
        new_path = f"{self.path(table)}-v{uuid.uuid4().hex[:12]}"
        added = [f.name for f in df.schema.fields if f.name not in current.fieldNames()]
        same = all(f.name in df.columns and df.schema[f.name].dataType == f.dataType for f in current.fields)
        if same and not self.is_partitioned(table):
            df.select(*current.fieldNames(), *added).write.parquet(new_path)
            self._add_columns(table, df)
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{new_path}'")
        else:
            # Written as a table of its own first, so files, buckets and
            # partitions are known to the catalog before the names change.
            fresh = f"{name}_{uuid.uuid4().hex[:12]}"
            self._writer(table, self._clustered(table, df), "errorifexists").option("path", new_path).saveAsTable(fresh)
            self.spark.sql(f"DROP TABLE {name}")
            self.spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
        self.spark.catalog.refreshTable(name)

    def remove_old_versions(self, table: str) -> list[str]:
        """Delete version folders of ``table`` under the root that the catalog
        no longer points at; call it when no reader is left on them."""
        fs, home = self._folder(self.path(table))
        current = fs.makeQualified(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.location(table))).toString()
        gone = []
        if not fs.exists(home.getParent()):
            return gone
        for status in fs.listStatus(home.getParent()):
            p, leaf = status.getPath(), status.getPath().getName()
            if (leaf == home.getName() or re.fullmatch(re.escape(home.getName()) + "-v[0-9a-f]{12}", leaf)) and p.toString() != current:
                fs.delete(p, True)
                gone.append(p.toString())
        return gone

    def _drop_dates(self, table: str, dates: list) -> None:
        """Empty whole partitions: out of the catalog, and their files too (the
        tables are external, so the catalog alone would leave them behind)."""
        name, home = self.name(table), self.location(table).rstrip("/")
        for d in dates:
            value, leaf = ("null", "__HIVE_DEFAULT_PARTITION__") if d is None else (f"DATE'{d}'", str(d))
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({PARTITION_COL} = {value})")
            self._delete_folder(f"{home}/{PARTITION_COL}={leaf}")
        if dates:
            self.spark.catalog.refreshTable(name)

    def replace_dates(self, table: str, df: DataFrame, dates: list) -> None:
        """The rows of ``dates`` become those of ``df`` (a date without any is
        emptied); other dates are neither read nor written."""
        df = self._prepare(table, df)
        if not self.exists(table):
            self._first(table, df)
            return
        found = self._insert(table, self._shaped(table, self.on_dates(df, dates)), True, len(dates))
        kept = self._seen_dates(found)
        self._drop_dates(table, [d for d in dates if d not in kept])

    # Dates that a later step has yet to see ------------------------------------

    def mark(self, table: str, dates: list) -> None:
        """Note down that ``dates`` of ``table`` change, for :meth:`marked`."""
        if dates:
            rows = self.spark.createDataFrame([(d,) for d in dates], "Date date").coalesce(1)
            rows.write.mode("append").parquet(f"{self.root}/_changed/{table.replace('.', '_')}/{uuid.uuid4().hex[:12]}")

    def marked(self, table: str) -> tuple[list, list[str]]:
        """(dates noted down and not cleared, the notes)."""
        fs, home = self._folder(f"{self.root}/_changed/{table.replace('.', '_')}")
        if not fs.exists(home):
            return [], []
        done = [s.getPath().toString() for s in fs.listStatus(home) if fs.exists(s.getPath().suffix("/_SUCCESS"))]
        return (self._dates(self.spark.read.schema("Date date").parquet(*done)) if done else []), done

    def clear(self, notes: list[str]) -> None:
        for path in notes:
            self._delete_folder(path)

    def delete_where(self, table: str, predicate, dates: list | None = None) -> WriteReport:
        """``DELETE FROM table WHERE predicate`` for rows where it is true, on
        ``dates`` if given. One pass counts hits by date; only dates with hits
        are rewritten, and dates without a row left are emptied."""
        if not self.exists(table):
            return WriteReport()
        df = self.read(table)
        if dates is not None and self.is_partitioned(table):
            df = self.on_dates(df, dates)
        hit = F.coalesce(predicate, F.lit(False))
        if not self.is_partitioned(table):
            hits = df.filter(hit).count()
            if hits:
                self._replace(table, df.filter(~hit))
            return WriteReport(deleted=hits)
        found = df.groupBy(PARTITION_COL).agg(F.count_if(hit).alias("hits"), F.count(F.lit(1)).alias("rows")).filter("hits > 0").collect()
        some = [r[PARTITION_COL] for r in found if r["hits"] < r["rows"]]
        if some:
            self._insert(table, self.on_dates(df, some).filter(~hit), True, len(some))
        self._drop_dates(table, [r[PARTITION_COL] for r in found if r["hits"] == r["rows"]])
        return WriteReport(deleted=sum(r["hits"] for r in found), dates=[r[PARTITION_COL] for r in found])

    # Maintenance ---------------------------------------------------------------

    def layout(self, table: str, dates: list | None = None) -> DataFrame:
        """Rows (Date, files, bytes): what each date is stored in. Reads no
        column, only where rows are."""
        df = self.read(table)
        parted = self.is_partitioned(table)
        if parted and dates is not None:
            df = self.on_dates(df, dates)
        meta = df.select(F.col(PARTITION_COL) if parted else F.lit(None).cast("date").alias(PARTITION_COL), "_metadata.file_path", "_metadata.file_size").distinct()
        return meta.groupBy(PARTITION_COL).agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"))

    def compact(self, table: str, file_bytes: int | None = None, slack: int = 2, dates: list | None = None) -> list:
        """Rewrite the dates (of ``dates``, if given) that lie in more than ``slack`` times the files that
        their bytes need (the small-file clean-up the reference gets from
        OPTIMIZE), laid out by size as every write is; a date that is well laid
        out is left alone. Returns the dates. Data is unchanged."""
        want = file_bytes or self._advised_bytes()
        own = self.buckets[table][0] if table in self.buckets else 1
        need = F.greatest(F.ceil(F.col("bytes") / want), F.lit(own))
        found = [r[PARTITION_COL] for r in self.layout(table, dates).filter(F.col("files") > slack * need).collect()]  # a row a date
        if not found:
            return []
        if not self.is_partitioned(table):
            self._replace(table, self.read(table).hint("rebalance"))
            return found
        self._insert(table, self.on_dates(self.read(table), found), True, len(found))
        return found

    def _advised_bytes(self) -> int:
        key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
        return int(self.spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(self.spark.conf.get(key, "64m")))

    def drop_all(self) -> None:
        """Drop this lakehouse's tables and schemas, and its folder."""
        for schema in (SILVER_SCHEMA, GOLD_SCHEMA):
            self.spark.sql(f"DROP SCHEMA IF EXISTS {self.prefix}{schema} CASCADE")
            self._delete_folder(f"{self.root}/{self.prefix}{schema}")

    def analyze(self, table: str, columns: Sequence[str] = ()) -> None:
        """``ANALYZE TABLE ... COMPUTE STATISTICS``: row count and size for the
        planner's join choices, and for ``columns`` distinct values, nulls and
        range, which cost-based join order needs (:func:`cost_based`). Columns
        of type TIMESTAMP_NTZ are left out: Spark's join estimate fails on
        their range."""
        name = self.name(table)
        columns = [c for c in columns if self.read(table).schema[c].dataType != TimestampNTZType()]
        what = " FOR COLUMNS " + ", ".join(f"`{c}`" for c in columns) if columns else ""
        self.spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS{what}")
        self.spark.catalog.refreshTable(name)
