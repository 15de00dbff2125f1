"""Live features as a log table: latest valid value, point-in-time join, invalidation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.config import SETTINGS, Settings

# Live features and what a miss gives.
DEFAULTS = {"demand_score_7d": 0.0, "inventory_ratio": 0.5, "competitor_price": None}


def _until() -> Column:
    return F.unix_micros("event_ts") + F.col("ttl_seconds").cast("long") * 1_000_000


def with_ttl(updates: DataFrame, s: Settings = SETTINGS) -> DataFrame:
    """Feature updates with the life time of their feature."""
    ttl = (F.when(F.col("feature") == "demand_score_7d", s.ttl_demand)
           .when(F.col("feature") == "inventory_ratio", s.ttl_inventory).otherwise(s.ttl_competitor))
    return updates.withColumn("ttl_seconds", ttl.cast("int"))


def tombstones(skus: DataFrame) -> DataFrame:
    """Log rows that end every feature of the given (sku_id, event_ts, event_id)."""
    names = F.array(*[F.lit(n) for n in DEFAULTS])
    return skus.select("sku_id", F.explode(names).alias("feature"), F.lit(None).cast("double").alias("value"),
                       "event_ts", F.lit(0).alias("ttl_seconds"), "event_id")


def latest_valid(log: DataFrame, as_of: Column) -> DataFrame:
    """The newest write per SKU and feature up to ``as_of``, if it has not expired or been deleted.

    A maximum, so a SKU with any number of writes combines before the shuffle.  A deletion comes after a write of the
    same event.
    """
    row = F.max_by(F.struct("value", "event_ts", "ttl_seconds"), F.struct(
        "event_ts", "event_id", F.col("value").isNull().alias("deleted"))).alias("_r")
    newest = log.filter(F.col("event_ts") <= as_of).groupBy("sku_id", "feature").agg(row).select(
        "sku_id", "feature", "_r.*")
    return newest.filter(F.col("value").isNotNull() & (_until() > F.unix_micros(as_of)))


def wide_features(valid: DataFrame) -> DataFrame:
    return valid.groupBy("sku_id").agg(*[
        F.max(F.when(F.col("feature") == n, F.col("value"))).alias(n) for n in DEFAULTS])


def feature_lookup(requests: DataFrame, log: DataFrame, as_of: Column) -> DataFrame:
    """The three live features of every requested SKU; misses take the defaults."""
    live = wide_features(latest_valid(log, as_of))
    found = requests.join(live, "sku_id", "left")
    return found.withColumns({n: F.coalesce(n, F.lit(d)) for n, d in DEFAULTS.items() if d is not None})


def merge_live_context(context: DataFrame, live: DataFrame) -> DataFrame:
    """Live values first, then the request's own, then the defaults."""
    renamed = live.select("sku_id", *[F.col(n).alias(f"_live_{n}") for n in DEFAULTS])
    merged = context.join(renamed, "sku_id", "left")
    own = {n: (F.col(n) if n in context.columns else F.lit(None).cast("double")) for n in DEFAULTS}
    return merged.withColumns({
        n: F.coalesce(F.col(f"_live_{n}"), own[n], F.lit(d).cast("double")) for n, d in DEFAULTS.items()
    }).drop(*[f"_live_{n}" for n in DEFAULTS])


def feature_asof(requests: DataFrame, log: DataFrame, ts: str = "ts", seq: str = "event_id") -> DataFrame:
    """Each request with the features valid at its own time.

    No value outlives the longest ``ttl_seconds`` of the log, so time is cut into slices of that length: a write is
    needed in its own slice and the next, and a SKU's history is spread over its slices.
    """
    width = log.agg(F.greatest(F.max("ttl_seconds"), F.lit(1)).cast("long") * 1_000_000).scalar()
    writes = log.withColumn("_us", F.unix_micros("event_ts"))
    home = F.coalesce(F.floor(F.col("_us") / width), F.lit(0))
    writes = writes.select(
        "sku_id", "_us", F.col(seq).alias("_seq"), F.lit(0).alias("_side"), F.explode(F.array(home, home + 1)).alias("_slice"),
        *[F.when(F.col("feature") == n, F.struct(F.col("value").alias("v"), _until().alias("until"))).alias(f"_w_{n}")
          for n in DEFAULTS])
    asks = requests.withColumns({"_us": F.unix_micros(ts), "_side": F.lit(1), "_seq": F.col(seq)})
    asks = asks.withColumn("_slice", F.coalesce(F.floor(F.col("_us") / width), F.lit(0)))
    both = asks.unionByName(writes, allowMissingColumns=True)
    w = Window.partitionBy("sku_id", "_slice").orderBy("_us", "_side", "_seq").rowsBetween(
        Window.unboundedPreceding, 0)
    both = both.withColumns({f"_l_{n}": F.last(f"_w_{n}", ignorenulls=True).over(w) for n in DEFAULTS})
    out = both.filter(F.col("_side") == 1).withColumns({
        n: F.coalesce(F.when(F.col(f"_l_{n}.until") > F.col("_us"), F.col(f"_l_{n}.v")), F.lit(d).cast("double"))
        for n, d in DEFAULTS.items()})
    return out.select(*requests.columns, *DEFAULTS)


def latest_decision(decisions: DataFrame, as_of: Column, ttl: int = SETTINGS.ttl_decision) -> DataFrame:
    """The last decision of each SKU that is not older than the cache life time."""
    rest = [c for c in decisions.columns if c != "sku_id"]
    fresh = decisions.filter((F.col("timestamp") <= as_of)
                             & (F.unix_micros("timestamp") + ttl * 1_000_000 > F.unix_micros(as_of)))
    last = F.max_by(F.struct(*rest), F.struct("timestamp", *[c for c in ("event_id",) if c in rest])).alias("_r")
    return fresh.groupBy("sku_id").agg(last).select("sku_id", "_r.*")
