"""Mixing sources to target weights (operator 1).

Every document gets a hash-random key. Within a source the keys are cut into
ranges of equal width; a prefix sum over the ranges' token counts gives each
range its base, and a window within each range gives each document its start
in its source's order. A source is read over as often as its budget asks
(epochs), and the last pass is cut exactly where the budget ends.

A range holds about 1 / ranges of its source, so a source with a third of all
rows is spread over all ranges; only one row for each range and source is
summed in one place.

Nulls: a null text has size 0; null sources are one source, last in order; a
null doc_id is an ordinary value. Repeated rows are separate documents. Rows
that tie on the key are ordered by id and size, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from culedger.llm.common import materialize, n_words

#: Weights by source in order, repeating.
WEIGHTS = (5, 2, 1)
#: A source is read over this often at most.
MAX_EPOCHS = 3


def water_fill(sizes: dict, weights: dict, cap: float = MAX_EPOCHS) -> dict:
    """Targets that share the total size by weight, none above ``cap`` times
    its source; what is cut off is shared by weight among the others."""
    open_ = {s for s in sizes if weights[s] > 0}
    target = {s: 0.0 for s in sizes}
    total = float(sum(sizes.values()))
    while open_:
        share = total / sum(weights[s] for s in open_)
        full = {s for s in open_ if share * weights[s] > cap * sizes[s]}
        if not full:
            return target | {s: share * weights[s] for s in open_}
        for s in full:
            target[s] = float(cap * sizes[s])
            total -= target[s]
        open_ -= full
    return target


def targets(sizes: DataFrame, weights=WEIGHTS, cap: float = MAX_EPOCHS) -> dict:
    """Target by source of the rows (source, source_size). Sources are few (a
    name each, not data), so the shares are worked out on the driver."""
    found = {r["source"]: int(r["source_size"] or 0) for r in sizes.collect()}
    order = sorted((s for s in found if s is not None)) + [None] * (None in found)
    return water_fill(found, {s: weights[i % len(weights)] for i, s in enumerate(order)}, cap)


def _key(doc_id: Column, seed: int) -> Column:
    """A hash-random number of 60 bits."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 15), 16, 10).cast("long")


def mix(docs: DataFrame, weights=WEIGHTS, cap: float = MAX_EPOCHS, seed: int = 17, ranges: int = 1024, keep: dict | None = None, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, start, epochs, taken,
    and the columns ``keep``, by name), one for each document.

    ``start``: words before the document in its source's order; ``epochs``:
    whole passes over the source; ``taken``: words that the mix takes of the
    document, repeats counted."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"), _key(F.col(doc_id), seed).alias("key"), *[c.alias(n) for n, c in (keep or {}).items()])
    rows = materialize(rows.withColumn("range", F.floor(F.col("key") / F.lit(2.0**60) * ranges).cast("int")), "mix")
    parts = materialize(rows.groupBy("source", "range").agg(F.sum("size").alias("part")), "mix-ranges")
    by_source = parts.groupBy("source").agg(F.sum("part").alias("source_size"))
    goal = targets(by_source, weights, cap)
    goals = spark.createDataFrame([(s, float(t)) for s, t in goal.items()], "source string, target double")
    order = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.withColumn("base", F.coalesce(F.sum("part").over(order), F.lit(0)))
    base = base.join(by_source, base["source"].eqNullSafe(by_source["source"])).drop(by_source["source"])
    base = base.join(goals, base["source"].eqNullSafe(goals["source"])).drop(goals["source"]).drop("part")
    inner = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size", *(keep or {})).rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("inner", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    b = base.alias("b")
    out = ranked.join(b, ranked["source"].eqNullSafe(F.col("b.source")) & (ranked["range"] == F.col("b.range"))).drop(F.col("b.source"), F.col("b.range"))
    budget = F.floor("target").cast("long")
    out = out.withColumn("start", F.col("base") + F.col("inner")).withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0)).cast("long"))
    rest = budget - F.col("epochs") * F.col("source_size") - F.col("start")
    taken = F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return out.withColumn("taken", taken.cast("long")).select("doc_id", "source", "size", "source_size", "target", "start", "epochs", "taken", *(keep or {}))


def apply(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars", source: str = "source", doc_id: str = "doc_id", **how) -> DataFrame:
    """The mixed corpus, with the columns of ``docs``: each document as often
    as the mix takes it, the last copy cut to the words that its source's
    budget has left. Documents that the mix takes no word of go.

    Rows are numbered in a table of their own first, so each keeps its own
    columns whatever it shares with others."""
    own = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, own, strict=True))
    rows = materialize(docs.toDF(*own).withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    plan = mix(rows, text=at[text], source=at[source], doc_id=at[doc_id], keep={"row": F.col("row")}, **how).where("taken > 0").select("row", F.col("size").alias("size"), "taken")
    rows = rows.join(plan, "row")
    size, taken = F.col("size"), F.col("taken")
    rows = rows.withColumn("left", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.ceil(taken / size) - 1), lambda i: F.least(size, taken - i * size))))
    whole = F.col(at[text])
    short = F.concat_ws(" ", F.slice(F.filter(F.split(whole, r"[\x20\x09-\x0D]+"), lambda w: w != ""), 1, F.col("left").cast("int")))
    rows = rows.withColumn(at[text], F.when(F.col("left") < size, short).otherwise(whole))
    if n_chars in at:
        rows = rows.withColumn(at[n_chars], F.length(at[text]).cast(dict(docs.dtypes)[n_chars]))
    return rows.select(own).toDF(*docs.columns)
