"""Running totals that carry over: gold autoscale kept up to date from stored
balances instead of all history.

``gold.autoscale_balances`` holds what each running-total group spent on each
date (exact part and residual), a row for each group and date, so the balance a
date opens with is a sum over earlier rows of this small table. After silver
changed on some dates,

- rows of those dates are accumulated anew from their opening balance;
- rows of later dates, in groups whose balance moved, get the difference between
  their date's opening balance and the one they show added to their total: a
  join, without a window and without silver. The total is a double, which gives
  its six decimals back exactly up to ``EXACT_BELOW``; groups beyond that, with a
  residual (finer decimals, NaN), or whose total becomes empty are accumulated
  anew from silver instead;
- earlier dates of silver and gold are not read.

The result equals a full rebuild: exactly in the exact part of the sums, and to
the last bits of a double where residuals are summed in another order. Rows
with a NULL TimePoint are a date of their own, before all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culedger.functions.columns import exact_cu, residual_cu
from culedger.operators.running import CU_TOTAL, running_sum
from culedger.plans import gold
from culedger.plans import tables as T
from culedger.schemas import K7_EQ, K7_NULL_SAFE, RUNNING_GROUP, RUNNING_TIEBREAK

DATE = T.PARTITION_COL
#: Totals of less than this have 15 digits at most, so a double keeps them.
EXACT_BELOW = 1e9


def day_totals(rows: DataFrame) -> DataFrame:
    """(group, Date, DaySum, DayRest) of deduplicated autoscale rows; a group
    whose values are all NULL on a date has NULL totals."""
    dated = T.with_date(rows)
    return dated.groupBy(*RUNNING_GROUP, DATE).agg(F.sum(exact_cu("SumCU_s")).cast(CU_TOTAL).alias("DaySum"), F.sum(residual_cu("SumCU_s")).alias("DayRest"))


def _before(a: Column, b: Column) -> Column:
    """Date a before date b, NULL first."""
    return F.coalesce(a < b, a.isNull() & b.isNotNull())


def openings(balances: DataFrame, wanted: DataFrame) -> DataFrame:
    """(group, Date, opening, opening_rest): what each group and date of
    ``wanted`` opens with, from totals of earlier dates. Rows for each group are
    bounded by the calendar."""
    earlier = balances.select(*[F.col(c).alias(f"b_{c}") for c in (*RUNNING_GROUP, DATE)], "DaySum", "DayRest")
    same = _before(F.col(f"b_{DATE}"), F.col(DATE))
    for c in RUNNING_GROUP:
        same = same & F.col(c).eqNullSafe(F.col(f"b_{c}"))
    joined = wanted.select(*RUNNING_GROUP, DATE).distinct().join(earlier, same)
    return joined.groupBy(*RUNNING_GROUP, DATE).agg(F.sum("DaySum").cast(CU_TOTAL).alias("opening"), F.sum("DayRest").alias("opening_rest"))


def accumulate(rows: DataFrame, balances: DataFrame, split_depth: int = 1) -> DataFrame:
    """Deduplicated autoscale rows with ``Acc_CU_s``, each date from its opening
    balance."""
    dated = T.with_date(rows)
    order = ["TimePoint", *RUNNING_TIEBREAK]
    return running_sum(dated, [*RUNNING_GROUP, DATE], order, "SumCU_s", "Acc_CU_s", split_depth=split_depth, opening=openings(balances, dated))


def moved(old: DataFrame, new: DataFrame) -> DataFrame:
    """(group, exact) for groups whose totals on some dates differ; ``exact``
    says that the difference is a plain decimal."""
    marked = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    pick = lambda c, k: F.max(F.when(F.col("_new") == k, F.col(c)))  # noqa: E731  (a row each)
    both = marked.groupBy(*RUNNING_GROUP, DATE).agg(*[pick(c, k).alias(f"{c}{k}") for c in ("DaySum", "DayRest") for k in (0, 1)])
    differ = ~F.col("DaySum0").eqNullSafe(F.col("DaySum1")) | ~F.col("DayRest0").eqNullSafe(F.col("DayRest1"))
    plain = (F.coalesce("DayRest0", F.lit(0.0)) == 0) & (F.coalesce("DayRest1", F.lit(0.0)) == 0) & ~(F.col("DaySum0").isNotNull() & F.col("DaySum1").isNull())
    return both.filter(differ).groupBy(*RUNNING_GROUP).agg(F.bool_and(plain).alias("exact"))


def _on_groups(rows: DataFrame, groups: DataFrame, how: str) -> DataFrame:
    g = groups.select(*[F.col(c).alias(f"g_{c}") for c in RUNNING_GROUP], *[c for c in groups.columns if c not in RUNNING_GROUP])
    same = F.lit(True)
    for c in RUNNING_GROUP:
        same = same & F.col(c).eqNullSafe(F.col(f"g_{c}"))
    return rows.join(g, same, how).drop(*[f"g_{c}" for c in RUNNING_GROUP])


def _exact(c: str | Column) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast(CU_TOTAL), F.lit(0).cast(CU_TOTAL))


def shifted(later: DataFrame, balances: DataFrame) -> DataFrame:
    """Gold rows of later dates, moved by as much as their date's first row is
    away from its opening balance. Rows that are in place already are left out,
    so a build that died between two dates can be repeated."""
    order = F.struct("TimePoint", *RUNNING_TIEBREAK)
    first = later.groupBy(*RUNNING_GROUP, DATE).agg(F.min_by(F.struct("Acc_CU_s", "SumCU_s"), order).alias("first"))
    seen = (_exact(F.col("first.Acc_CU_s")) - _exact(exact_cu(F.col("first.SumCU_s")))).cast(CU_TOTAL)
    opened = openings(balances, first)
    same = F.lit(True)
    for c in (*RUNNING_GROUP, DATE):
        same = same & F.col(f"f.{c}").eqNullSafe(F.col(f"o.{c}"))
    by = first.alias("f").join(opened.alias("o"), same, "left").select(*[F.col(f"f.{c}").alias(f"s_{c}") for c in (*RUNNING_GROUP, DATE)], (_exact("opening") - seen).cast(CU_TOTAL).alias("by"))
    same = F.lit(True)
    for c in (*RUNNING_GROUP, DATE):
        same = same & F.col(c).eqNullSafe(F.col(f"s_{c}"))
    joined = later.join(by.filter("by != 0"), same)
    total = (_exact("Acc_CU_s") + F.col("by")).cast(CU_TOTAL).cast("double")
    return joined.select(*[total.alias(c) if c == "Acc_CU_s" else c for c in later.columns])


def start(lh: T.Lakehouse) -> None:
    """The balances of all silver autoscale rows, after a full gold build."""
    lh.overwrite(T.GOLD_BALANCES, day_totals(gold.autoscale_rows(lh.read(T.SILVER_TP_METRICS_AS))))


def _after(df: DataFrame, dates: list) -> DataFrame:
    """Rows of dates behind the first of ``dates``, those excepted, as partition
    predicates."""
    known = [d for d in dates if d is not None]
    out = df.filter(F.col(DATE).isNotNull() if None in dates else F.col(DATE) > F.lit(min(known)))
    return out.filter(~F.col(DATE).isin(known)) if known else out


def restated(lh: T.Lakehouse, dates: list, totals: DataFrame) -> DataFrame:
    """The gold autoscale rows to merge after silver changed on ``dates``, whose
    totals are now ``totals``; the stored balances are those before."""
    silver, stored = lh.read(T.SILVER_TP_METRICS_AS), lh.read(T.GOLD_BALANCES)
    there = F.col(DATE).isin([d for d in dates if d is not None])
    kept = stored.filter(~F.coalesce(there, F.lit(False)) & ~(F.lit(None in dates) & F.col(DATE).isNull()))
    balances = kept.unionByName(totals)
    groups = moved(lh.on_dates(stored, dates), totals)
    later = _on_groups(_after(lh.read(T.GOLD_TP_METRICS_AS), dates), groups.select(*RUNNING_GROUP), "left_semi")
    # Where a difference cannot be added exactly, the group is accumulated anew.
    odd = F.max(F.coalesce(F.abs("Acc_CU_s") >= EXACT_BELOW, F.lit(False)) | F.coalesce(F.isnan("Acc_CU_s"), F.lit(False)))
    large = later.groupBy(*RUNNING_GROUP).agg(odd.alias("odd")).filter("odd")
    rest = balances.groupBy(*RUNNING_GROUP).agg(F.max(F.coalesce(F.col("DayRest") != 0, F.lit(False))).alias("odd")).filter("odd")
    unsafe = groups.filter("not exact").select(*RUNNING_GROUP)
    for more in (large, rest):
        unsafe = unsafe.unionByName(more.select(*RUNNING_GROUP))
    unsafe = unsafe.distinct()
    columns = later.columns
    shift = shifted(_on_groups(later, unsafe, "left_anti"), balances)
    anew = _on_groups(groups.select(*RUNNING_GROUP), unsafe, "left_semi")
    own = gold.autoscale_rows(lh.on_dates(silver, dates))
    again = _on_groups(gold.autoscale_rows(_after(silver, dates)), anew, "left_semi")
    return accumulate(own.unionByName(again), balances).select(*columns).unionByName(shift.select(*columns))


def carry_forward(lh: T.Lakehouse, dates: list) -> T.WriteReport:
    """Bring gold autoscale and its balances up to date after silver changed on
    ``dates``. The balances come last, so a build that died is repeated as a
    whole, and rows that it had moved stay where they are."""
    if not dates:
        return T.WriteReport()
    rows = gold.autoscale_rows(lh.on_dates(lh.read(T.SILVER_TP_METRICS_AS), dates))
    with lh._staged(T.GOLD_BALANCES, day_totals(rows)) as (totals, _, _):
        done = lh.merge(T.GOLD_TP_METRICS_AS, restated(lh, dates, totals), K7_EQ, K7_NULL_SAFE, "update")
        lh.replace_dates(T.GOLD_BALANCES, totals, dates)
    return done
