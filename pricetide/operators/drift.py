"""Population stability between an expected and an actual table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.config import SETTINGS

EPSILON = 1e-6  # fixed value: keeps empty buckets out of the logarithm


def _long(df: DataFrame, features: list[str]) -> DataFrame:
    wide = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    return wide.unpivot([], features, "feature", "value").filter(F.col("value").isNotNull())


def psi_all(expected: DataFrame, actual: DataFrame, features: list[str], buckets: int = 10,
            limit: float = SETTINGS.psi_limit) -> DataFrame:
    """PSI of every feature both tables have: equal-width buckets on the expected range, actual values
    clipped to it.  One row per feature and bucket leaves the map side."""
    both = [f for f in features if f in expected.columns and f in actual.columns]
    ends = expected.agg(*[F.struct(F.min(f).cast("double").alias("lo"), F.max(f).cast("double").alias("hi")).alias(f)
                          for f in both])
    range_map = F.create_map(*[x for f in both for x in (F.lit(f), F.col(f))])
    ranges = ends.select(range_map).scalar()

    def shares(df: DataFrame, side: str) -> DataFrame:
        rows = _long(df, both).withColumn("_e", ranges[F.col("feature")])
        scaled = F.coalesce(F.try_divide(F.col("value") - F.col("_e.lo"), F.col("_e.hi") - F.col("_e.lo")), F.lit(0.0))
        place = F.least(F.floor(F.greatest(F.least(scaled, F.lit(1.0)), F.lit(0.0)) * buckets), F.lit(buckets - 1))
        return rows.groupBy("feature", place.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).withColumn(
            "side", F.lit(side))

    counts = shares(expected, "e").unionByName(shares(actual, "a"))

    def n_of(side: str):
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col("n"))), F.lit(0))

    # at most features x buckets rows from here on; buckets empty on both sides add nothing
    cells = counts.groupBy("feature", "bucket").agg(n_of("e").alias("e"), n_of("a").alias("a"))
    totals = counts.groupBy("feature").agg(n_of("e").alias("_te"), n_of("a").alias("_ta"))
    cells = cells.join(F.broadcast(totals), "feature")
    e, a = F.col("e") / F.col("_te") + EPSILON, F.col("a") / F.col("_ta") + EPSILON
    out = cells.groupBy("feature").agg(F.sum((a - e) * F.ln(a / e)).alias("psi"))
    return out.withColumn("alert", F.col("psi") > limit)


def psi(expected: DataFrame, actual: DataFrame, feature: str, buckets: int = 10) -> DataFrame:
    return psi_all(expected, actual, [feature], buckets)
