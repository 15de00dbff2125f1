import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricetide.operators.marketplace import price_table
from pricetide.operators.quantiles import group_quantile, quantile, rank_shares, value_counts


@pytest.mark.parametrize("p", [0.05, 0.5, 0.75, 0.95])
@pytest.mark.parametrize("fine", [1, 4096])
def test_group_quantile_is_exact(spark, p, fine):
    rng = np.random.default_rng(3)
    sizes = {"one": 1, "two": 2, "three": 3, "seven": 7, "many": 5000, "ties": 3000}
    frames = [pd.DataFrame({"g": g, "v": np.round(rng.lognormal(3, 1, n), 1 if g == "ties" else 6)})
              for g, n in sizes.items()]
    rows = pd.concat(frames)
    got = {r["g"]: r["q"] for r in group_quantile(spark.createDataFrame(rows), ["g"], "v", p, "q", fine).collect()}
    for g, x in rows.groupby("g"):
        assert got[g] == pytest.approx(np.quantile(x["v"], p), abs=1e-9), g


def test_missing_values_and_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), ("a", 5.0)], "g string, v double")
    assert {r["g"]: r["q"] for r in group_quantile(df, ["g"], "v", 0.5, "q").collect()} == {None: 2.0, "a": 5.0}
    assert spark.range(1).select(quantile(df, "v", 0.5)).first()[0] == 3.0


def test_rank_shares_match_pandas(spark):
    rng = np.random.default_rng(5)
    rows = pd.DataFrame({"g": rng.choice(["a", "b"], 500), "v": rng.choice([-3.5, 0.0, 0.01, 1.0, 2.5, 900.0, 901.0], 500)})
    rows["want"] = rows.groupby("g")["v"].rank(pct=True)
    got = {(r["g"], r["v"]): r["s"] for r in rank_shares(spark.createDataFrame(rows), "g", "v", "s").collect()}
    for g, v, want in rows[["g", "v", "want"]].itertuples(index=False):
        assert got[(g, v)] == pytest.approx(want)


def test_ranks_between_far_values(spark):
    """Neighbouring ranks in different slices, values of both signs, zeros and infinities."""
    values = [-1e300, -5.0, -5.0, -1e-300, 0.0, 0.0, 2.0, 1e9, 1e300, float("inf")]
    df = spark.createDataFrame([(v,) for v in values * 7], "v double")
    ordered = sorted(values * 7)
    for p in (0.0, 0.1, 0.33, 0.5, 0.7, 0.89):
        spot = (len(ordered) - 1) * p
        low = ordered[int(spot)]
        want = low + (ordered[-int(-spot // 1)] - low) * (spot - int(spot))
        assert group_quantile(df, [], "v", p, "q").first()[0] == pytest.approx(want)


def test_no_group_is_ordered_whole(spark):
    """What a task ranks is one value slice at most, and of values only those of one fine slice."""
    df = spark.range(200_000).selectExpr("id % 3 = 0 or id % 7 = 1 hot", "cast(id * 7919 % 200003 as double) v")
    plan = group_quantile(df, ["hot"], "v", 0.5, "q")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in text and "raise_error" not in text
    want = {r.hot: r.q for r in df.groupBy("hot").agg(F.expr("percentile(v, 0.5)").alias("q")).collect()}
    assert {r.hot: r.q for r in plan.collect()} == want


def test_weights_stand_for_rows(spark):
    rng = np.random.default_rng(7)
    rows = spark.createDataFrame(pd.DataFrame({"g": rng.choice(["a", "b"], 3000), "v": np.round(rng.lognormal(1, 1, 3000), 1)}))
    counts = value_counts(rows, "g", "v", "n")
    assert counts.count() < 1000
    for p in (0.05, 0.5):
        want = {r["g"]: r["q"] for r in group_quantile(rows, ["g"], "v", p, "q").collect()}
        assert {r["g"]: r["q"] for r in group_quantile(counts, ["g"], "v", p, "q", weight="n").collect()} == want
    want = {(r["g"], r["v"]): r["s"] for r in rank_shares(rows, "g", "v", "s").collect()}
    assert {(r["g"], r["v"]): r["s"] for r in rank_shares(counts, "g", "v", "s", "n").collect()} == want


def test_price_table_reads_the_rows_once(spark, tmp_path):
    spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 3.0), ("b", 5.0), ("b", None)], "category string, price double").write.parquet(
        str(tmp_path / "base"))
    table = price_table(spark.read.parquet(str(tmp_path / "base")))
    assert str(tmp_path) not in " ".join(table.inputFiles())  # what follows reads the stored counts
    got = {(r["category"], r["price"]): (r["price_percentile_in_category"], r["competitor_delta"]) for r in table.collect()}
    assert got == {("a", 1.0): (pytest.approx(1 / 3), pytest.approx(-2 / 3)), ("a", 3.0): (pytest.approx(2.5 / 3), 0.0),
                   ("b", 5.0): (1.0, 0.0)}
