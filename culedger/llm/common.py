"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from culedger.session import work_path

#: The six blanks that part words (space, tab, LF, VT, FF, CR).
BLANKS = " \t\n\x0b\x0c\r"
#: A word, and a run of blanks that is not just one space, as
#: regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
UNEVEN_BLANKS = r"\x20*[\x09-\x0D][\x20\x09-\x0D]*|\x20{2,}"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate tables, next to the checkpoints that the
    cluster shares (``spark.checkpoint.dir``)."""
    return work_path(spark, "llm", spark.sparkContext.applicationId, f"{label}-{uuid.uuid4().hex[:12]}")


#: Spark's own setting to drop a query's shuffle files when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later uses neither
    recompute it nor depend on an executor that may be lost, and its shuffle
    files go at once."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; call it once the
    results that read them have been written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_path(spark, "llm", spark.sparkContext.applicationId))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def row_keys(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes that tell rows apart by these columns;
    nulls count, wherever they stand."""
    marked = [x for c in columns for x in (c.isNull(), c)]
    return [F.xxhash64(F.lit(seed), *marked) for seed in (1, 2)]


def n_words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def star_round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step on edges (a, b) with a > b: every
    node moves to the smallest node that it sees."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
    down = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select("a", F.col("m").alias("b")))
    return small.where("a > b").distinct()


def connected(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of the undirected edges (a, b), both long and not
    null: rows (node, root), root being the smallest node of the component.
    Only nodes with an edge to another node are returned. Edges stay in Spark;
    each round is cut off by a table in the shared folder."""
    def mark(df: DataFrame) -> tuple:
        r = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        return tuple(r)

    now = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialize(now, label)
    seen = mark(now)
    while seen[0]:
        after = materialize(star_round(now), label)
        marked = mark(after)
        if marked == seen:
            break
        now, seen = after, marked
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
