"""Exact order statistics per group without holding or ordering a group in one task.

``percentile`` keeps every distinct value of a group in memory.  Here the wanted rank is selected in steps: rows are
counted per value slice, the slice that holds the rank is cut into finer ones between its least and greatest value, and
only the values of the finer slice that holds it are ranked.  Every step counts all rows of what the one before
chose, so nothing is estimated and no rank can be missed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.functions.core import all_of

FINE = 4096


def group_quantile(df: DataFrame, keys: list[str], value: str, p: float, out: str, fine: int = FINE,
                   weight: str | None = None) -> DataFrame:
    """One row per group: the p-quantile of ``value`` with linear interpolation, as ``percentile``; NULLs are left out.

    The two ranks that are interpolated may lie in different slices; then both are followed.  ``weight`` names a count of
    equal rows that a row stands for.
    """
    counted = F.count(F.lit(1)) if weight is None else F.sum("_w")
    rows = df.select(*keys, F.col(value).cast("double").alias("_v"), *([] if weight is None else [F.col(weight).alias("_w")]))
    rows = rows.filter(F.col("_v").isNotNull()).withColumn("_s", value_slice("_v"))
    size = F.sum("_c").over(Window.partitionBy(*keys))
    spot = (F.col("_n") - 1) * F.lit(p)
    # One row per group and slice; the slices of a double are bounded in number, whatever the data.
    coarse = _holding(rows.groupBy(*keys, "_s").agg(counted.alias("_c"), F.min("_v").alias("_min"),
                                                     F.max("_v").alias("_max"))
                      .withColumn("_n", size).withColumns({"_f": F.floor(spot), "_g": F.ceil(spot), "_start": F.lit(0)}),
                      keys, "_s")
    step = F.when(F.col("_max") > F.col("_min"), F.floor(
        (F.col("_v") - F.col("_min")) / (F.col("_max") - F.col("_min")) * fine)).otherwise(F.lit(0))
    inside = _matched(rows, coarse, [*keys, "_s"]).withColumn("_t", step)
    told = [F.first(c).alias(c) for c in ("_n", "_f", "_g", "_start")]
    finer = _holding(inside.groupBy(*keys, "_s", "_t").agg(counted.alias("_c"), *told), [*keys, "_s"], "_t")
    values = _matched(inside.drop(*(c for c in coarse.columns if c not in (*keys, "_s"))), finer, [*keys, "_s", "_t"]).groupBy(
        *keys, "_s", "_t", "_v").agg(counted.alias("_c"), *told)
    last = _holding(values, [*keys, "_s", "_t"], "_v")
    end = F.col("_start") + F.col("_c")
    picked = last.groupBy(*keys).agg(
        F.max(F.when((F.col("_start") <= F.col("_f")) & (end > F.col("_f")), F.col("_v"))).alias("_x"),
        F.max(F.when((F.col("_start") <= F.col("_g")) & (end > F.col("_g")), F.col("_v"))).alias("_y"),
        F.max("_n").alias("_n"))
    return picked.select(*keys, (F.col("_x") + (F.col("_y") - F.col("_x")) * (spot - F.floor(spot))).alias(out))


def _holding(counts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The rows of ``counts`` that hold one of the wanted ranks; ``_start`` becomes the rank of their first value."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_start") + F.coalesce(F.sum("_c").over(before), F.lit(0))
    return counts.withColumn("_start", start).filter(
        (F.col("_start") <= F.col("_g")) & (F.col("_start") + F.col("_c") > F.col("_f")))


def _matched(rows: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """Every row with the one row of ``chosen`` that has its keys, NULL ones too."""
    named = chosen.drop("_c").withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = all_of(F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys)
    return rows.join(named, same).drop(*[f"_k_{k}" for k in keys])


def quantile(df: DataFrame, value: str, p: float) -> Column:
    """The p-quantile of a whole column as a scalar."""
    return group_quantile(df, [], value, p, "q").agg(F.max("q")).scalar()


def value_slice(value: str, per_octave: int = 64) -> Column:
    """A whole number that never falls as the value rises: 64 steps per doubling, on either side of zero."""
    v = F.col(value).cast("double")
    far = 1 << 20  # beyond any step number of a double
    return (F.when(F.isnan(v), F.lit(2 * far))
            .when(F.abs(v) == float("inf"), F.when(v > 0, 2 * far - 1).otherwise(-2 * far))
            .when(v > 0, F.floor(F.log2(v) * per_octave) + far)
            .when(v < 0, -F.floor(F.log2(-v) * per_octave) - far).otherwise(F.lit(0)))


def value_counts(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """Rows per distinct (group, value); NULL values are left out."""
    return df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias(out))


def rank_shares(df: DataFrame, group: str, value: str, out: str, weight: str | None = None) -> DataFrame:
    """Per distinct (group, value): the average rank of the value in its group over the group's size.

    Only distinct counts are ordered, in value slices; each slice starts from the total of the lower
    ones.  Joined back, every row meets exactly one row of this table, so an adaptive skew join can
    split a value that many rows share.  With ``weight``, ``df`` holds ``value_counts`` already.
    """
    counts = value_counts(df, group, value, "_c") if weight is None else df.select(group, value, F.col(weight).alias("_c"))
    counts = counts.withColumn("_s", value_slice(value))
    before = Window.partitionBy(group).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.groupBy(group, "_s").agg(F.sum("_c").alias("_t")).select(
        group, "_s", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_below"),
        F.sum("_t").over(Window.partitionBy(group)).alias("_n"))
    inside = Window.partitionBy(group, "_s").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    # values a tie covers: ranks upto-c+1 .. upto, their mean is upto - (c-1)/2
    mean_rank = F.col("_below") + F.col("_upto") - (F.col("_c") - 1) / F.lit(2.0)
    return (counts.withColumn("_upto", F.sum("_c").over(inside)).join(base, [group, "_s"])
            .select(group, value, (mean_rank / F.col("_n")).alias(out)))
