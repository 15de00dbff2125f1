"""Running windows against pandas and brute force, with no, some and all keys cut into hours."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricetide.config import MICROS_PER_DAY as DAY
from pricetide.operators.sales_features import add_rolling, units_today
from pricetide.operators.splits import chrono_split, time_series_folds
from pricetide.operators.targets import forward_sums
from pricetide.operators.windows import numbered, drop_internal, heavy_keys, rolling_sums, shift_rows

SPANS = {"7d": 7 * DAY, "30d": 30 * DAY, "all": None}


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    n = 400
    # a third of the rows belongs to one key, and many share an instant
    key = np.where(rng.random(n) < 0.34, "hot", rng.choice(list("abcd"), n))
    us = rng.integers(0, 60, n) * DAY + rng.choice([0, 1, DAY // 2], n)
    return pd.DataFrame({"k": key, "us": us, "seq": np.arange(n), "q": rng.integers(1, 9, n)})


def collected(df, *extra):
    return sorted(tuple(r) for r in df.select("k", "us", "seq", *extra).collect())


def table(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k string")


def brute(rows, width, reverse=False, closed=False):
    out = {}
    for _, g in rows.groupby("k"):
        g = g.sort_values(["us", "seq"])
        g = g.iloc[::-1] if reverse else g
        t, q = g["us"].to_numpy() * (-1 if reverse else 1), g["q"].to_numpy()
        for i in range(len(g)):
            low = -np.inf if width is None else t[i] - width
            inside = (t[:i + 1] >= low) if closed else (t[:i + 1] > low)
            out[int(g["seq"].iloc[i])] = int(q[:i + 1][inside].sum())
    return out


@pytest.mark.parametrize("heavy", [[], ["hot"], list("abcd") + ["hot"]])
@pytest.mark.parametrize("reverse,closed", [(False, False), (True, False), (False, True)])
def test_rolling_sums(spark, rows, heavy, reverse, closed):
    df = spark.createDataFrame(rows)
    got = rolling_sums(df, "k", "us", ["seq"], {"q": F.col("q")}, SPANS, reverse=reverse, closed=closed,
                       heavy=table(spark, heavy))
    got = {r["seq"]: r for r in got.collect()}
    assert len(got) == len(rows)
    for span, width in SPANS.items():
        want = brute(rows, width, reverse, closed)
        assert {s: r[f"q_{span}"] for s, r in got.items()} == want


def test_seven_day_known_values(spark):
    days = [0, 1, 1, 5, 7]
    df = spark.createDataFrame([("p", d * DAY, i, q) for i, (d, q) in enumerate(zip(days, [1, 2, 4, 5, 16]))],
                               "k string, us long, seq long, q long")
    got = rolling_sums(df, "k", "us", ["seq"], {"q": F.col("q")}, {"7d": 7 * DAY}).orderBy("seq").collect()
    assert [r["q_7d"] for r in got] == [1, 3, 7, 12, 27]


@pytest.mark.parametrize("heavy", [[], ["hot"], list("abcd") + ["hot"]])
@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("after_rolling", [False, True])
def test_shift_rows(spark, rows, heavy, reverse, after_rolling):
    df, heavy = spark.createDataFrame(rows), table(spark, heavy)
    if after_rolling:
        df = rolling_sums(df, "k", "us", ["seq"], {"q": F.col("q")}, {"7d": 7 * DAY}, reverse=reverse, heavy=heavy)
    got = shift_rows(df, "k", "us", ["seq"], {"one": ("q", 1), "thirty": ("q", 30)}, reverse=reverse, heavy=heavy)
    got = {r["seq"]: (r["one"], r["thirty"]) for r in drop_internal(got).collect()}
    want = {}
    for _, g in rows.groupby("k"):
        g = g.sort_values(["us", "seq"], ascending=not reverse)
        q = g["q"].tolist()
        for i, s in enumerate(g["seq"]):
            want[s] = (q[i - 1] if i >= 1 else None, q[i - 30] if i >= 30 else None)
    assert got == want


def test_rolling_then_shift_moves_each_row_once(spark, rows):
    """No key is heavy: the plan that ran has one exchange and one sort of the rows, besides the count of keys."""
    df = rolling_sums(spark.createDataFrame(rows), "k", "us", ["seq"], {"q": F.col("q")}, SPANS)
    df = shift_rows(df, "k", "us", ["seq"], {"prev": ("q_7d", 1)})
    assert len(df.collect()) == len(rows)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("REPARTITION_BY_COL") == 1 and final.count("Sort [") == 1 and "SortMergeJoin" not in final
    # rows are multiplied behind the exchange, which carries each once
    assert 0 < final.index("Generate") < final.index("REPARTITION_BY_COL")


def test_heavy_keys_are_found(spark, rows):
    df = spark.createDataFrame(rows).unionByName(spark.createDataFrame(rows).withColumn("k", F.lit(None).cast("string")))
    assert [r["k"] for r in heavy_keys(df, "k", rows=100).collect()] == ["hot"]


def test_missing_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, 0, 0, 2), (None, 1, 1, 3), ("a", 1, 2, 5)], "k string, us long, seq long, q long")
    for heavy in (table(spark, []), table(spark, ["a"])):
        got = rolling_sums(df, "k", "us", ["seq"], {"q": F.col("q")}, {"all": None}, heavy=heavy)
        got = shift_rows(got, "k", "us", ["seq"], {"prev": ("q_all", 1)}, heavy=heavy)
        assert {r["seq"]: (r["q_all"], r["prev"]) for r in got.collect()} == {0: (2, None), 1: (5, 2), 2: (5, None)}
        assert rolling_sums(df.limit(0), "k", "us", ["seq"], {"q": F.col("q")}, SPANS, heavy=heavy).count() == 0


def test_sales_windows_do_not_depend_on_slices(spark, rows):
    """All sales windows, with every product cut into hours and with none: the same rows."""
    sales = spark.createDataFrame(rows).select(
        F.col("k").alias("stock_code"), F.timestamp_micros("us").alias("invoice_date"),
        F.col("seq").cast("string").alias("invoice_no"), F.col("q").alias("quantity"),
        (F.col("q") / 4).alias("unit_price"), (F.col("q") * F.col("q") / 4).alias("revenue"))

    def features(heavy):
        heavy = table(spark, heavy).withColumnRenamed("k", "stock_code")
        df = forward_sums(units_today(add_rolling(sales, heavy=heavy), heavy), heavy=heavy)
        return sorted(str(r) for r in df.select(sorted(df.columns)).collect())

    plain = features([])
    assert plain == features(["hot", "b"]) == features(list("abcd") + ["hot"])
    days = rows.assign(day=rows["us"] // DAY).groupby(["k", "day"])["q"].sum()
    assert sum(f"units_sold_today={v}" in "".join(plain) for v in set(days)) == len(set(days))


def test_split_within_one_heavy_day(spark, rows):
    """All rows on one day: ranked in range slices."""
    one = rows.assign(us=rows["us"] % DAY)
    df = spark.createDataFrame(one).repartition(4).withColumn("ts", F.timestamp_micros("us"))
    order = one.sort_values(["us", "seq"])["seq"].tolist()
    split = {r["seq"]: r["split"] for r in chrono_split(df, "ts", ["seq"]).collect()}
    assert [split[s] for s in order] == ["train"] * 320 + ["test"] * 80


def test_splits_by_position(spark, rows):
    df = spark.createDataFrame(rows).withColumn("ts", F.timestamp_micros("us"))
    order = rows.sort_values(["us", "seq"])["seq"].tolist()
    split = {r["seq"]: r["split"] for r in chrono_split(df, "ts", ["seq"]).collect()}
    assert [split[s] for s in order] == ["train"] * 320 + ["test"] * 80
    fold = {r["seq"]: r["fold"] for r in time_series_folds(df, "ts", ["seq"]).collect()}
    size = 400 // 6
    assert [fold[s] for s in order] == [0] * (400 - 5 * size) + [f for f in range(1, 6) for _ in range(size)]


def test_numbered_in_slices(spark, rows):
    df = spark.createDataFrame(rows).repartition(5)
    order = rows.sort_values(["us", "seq"])["seq"].tolist()
    got = {r["seq"]: r["place"] for r in numbered(df, ["us", "seq"], "place", "t").collect()}
    assert got == {s: i for i, s in enumerate(order)}
    got = {r["seq"]: r["place"] for r in numbered(df, ["us", "seq"], "place", "t", "k").collect()}
    assert got == {s: i for _, g in rows.groupby("k") for i, s in enumerate(g.sort_values(["us", "seq"])["seq"])}
    assert numbered(df.limit(0), ["us"], "place", "t").count() == 0


def test_positions_are_looked_for_in_the_stored_table(spark):
    base = spark.range(100).select(F.timestamp_seconds(F.col("id") * 3600).alias("t"), (F.col("id") % 7).alias("n"))
    dear = base.filter(F.raise_error(F.lit("the rows were built")).cast("int") == F.col("n"))
    for split in (chrono_split, time_series_folds):
        split(dear, "t", ["n"], among=base)  # reads nothing of the table it is for
        rows = base.withColumn("more", F.lit(1))
        assert set(split(rows, "t", ["n"], among=base).collect()) == set(split(rows, "t", ["n"]).collect())
