"""Train, validation and test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.functions.core import keyed_hash, micros
from pricetide.operators.windows import cut_index


def time_split(df: DataFrame, ts: str, valid_from: str, test_from: str) -> DataFrame:
    t = F.col(ts)
    start, end = F.lit(valid_from).cast("timestamp"), F.lit(test_from).cast("timestamp")
    return df.withColumn("split", F.when(t < start, "train").when(t < end, "valid").otherwise("test"))


def _timed(df: DataFrame | None, ts: str) -> DataFrame | None:
    return None if df is None else df.withColumn("_us", micros(ts))


def chrono_split(df: DataFrame, ts: str, seq: list[str], share: float = 0.8, among: DataFrame | None = None) -> DataFrame:
    """The first ``share`` of the rows in time order against the rest.

    Only the order key at the split position is looked for; the table is neither sorted nor shuffled.  ``among`` is a
    stored table of the same rows to look in, where ``df`` itself is dear to read.
    """
    cut = cut_index(_timed(df, ts), "_us", seq, lambda n: [F.floor(n * F.lit(share))], "_after", _timed(among, ts))
    return cut.withColumn("split", F.when(F.col("_after") > 0, "test").otherwise("train")).drop("_after", "_us")


def random_split(df: DataFrame, key: str, share: int = 80, seed: int = 42) -> DataFrame:
    """A keyed hash decides, so a row keeps its side on every run and partitioning."""
    side = keyed_hash(key, seed) % 100 < share
    return df.withColumn("split", F.when(side, "train").otherwise("test"))


def time_series_folds(df: DataFrame, ts: str, seq: list[str], folds: int = 5, among: DataFrame | None = None) -> DataFrame:
    """Expanding-window folds: ``fold`` 0 only trains, rows of fold i test against all folds below.  ``among`` as in
    ``chrono_split``."""
    def starts(n):
        size = F.floor(n / F.lit(folds + 1))
        return [n - size * (folds - i) for i in range(folds)]

    return cut_index(_timed(df, ts), "_us", seq, starts, "fold", _timed(among, ts)).drop("_us")
