"""Known answers of the price rules."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pricetide.functions import calendar
from pricetide.functions import rules as R
from pricetide.functions.core import clip, py_round
from pricetide.operators import pricing as P


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def lit(x):
    return F.lit(x).cast("double")


def test_known_answers(spark):
    v = lambda c: value(spark, c)
    assert v(lit(100) * R.inventory_multiplier(lit(0.05))) == 120.0
    assert v(lit(100) * R.inventory_multiplier(lit(0.95))) == 85.0
    assert v(R.competitor_blend(lit(100), lit(200))) == 130.0
    assert v(R.competitor_blend(lit(100), lit(None))) == 100.0
    assert v(R.competitor_blend(lit(100), lit(float("nan")))) == 100.0
    assert v(R.guardrails(lit(90), lit(100), lit(200))) == 105.0
    assert v(R.guardrails(lit(200), lit(50), lit(100))) == 150.0
    assert v(lit(100) * R.flash_multiplier(F.lit(True))) == 125.0
    assert v(R.demand_multiplier(lit(500))) == pytest.approx(1.125)
    assert [v(R.segment_multiplier(F.lit(s))) for s in (0, 4, 9)] == [0.95, 1.10, 1.0]
    assert [v(R.severity(lit(r))) for r in (1.6, 2.0, 3.0, 5.0)] == ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
    assert v(py_round(R.spike_multiplier(lit(2.4)), 2)) == 1.09
    assert v(R.bound_and_round(lit(10.125), lit(1), lit(100), lit(10))) == 10.1
    assert v(clip(lit(None), 0.0, 1.0)) is None
    assert v(R.live_inventory_ratio(lit(70), lit(0.2))) == 10.0


def test_python_rounding(spark):
    for x, n in ((2.675, 2), (0.145, 2), (2.125, 2), (1.325, 2), (-0.5, 0), (12345.678, 1)):
        assert value(spark, py_round(lit(x), n)) == round(x, n)


def test_decision_chain(spark):
    df = spark.createDataFrame(
        [("S", 100.0, 0.05, 100.0, 100.0, False, None, 50.0, 200.0), ("T", 100.0, 0.5, 0.0, None, True, 9, None, None)],
        "sku_id string, base_price double, inventory_ratio double, demand_score_7d double, competitor_price double, "
        "is_flash_sale boolean, customer_segment int, cost double, msrp double")
    s, t = P.price_decision(df).orderBy("sku_id").collect()
    demand = 0.90 + 0.45 / (1 + 2.718281828459045 ** 2)
    assert s["multipliers_applied"] == {"inventory": 1.2, "demand": round(demand, 3), "segment": 1.0}
    assert s["final_price"] == pytest.approx(0.7 * 120 * demand + 30) and s["final_price"] >= 100
    assert s["reasoning"].startswith("Base ML: INR 100.00. Inventory adjustment: 1.2x. Demand adjustment: 0.954x. ")
    assert s["confidence_interval"]["low"] == pytest.approx(s["final_price"] * 0.95)
    assert t["multipliers_applied"]["flash_sale"] == 1.25 and 105 >= t["final_price"] * 0.7
    assert "Flash sale boost applied." in t["reasoning"] and not t["applied_guardrail"]


def test_business_adjustments(spark):
    df = spark.createDataFrame([(100.0, (0.8, True, 0.9)), (100.0, (0.7, False, 0.7)), (100.0, None)],
                               "p double, f struct<stockout_risk:double,flash_sale:boolean,inventory_excess:double>")
    rows = df.select(R.business_price("p", "f").alias("p"), R.business_notes("f").alias("n")).collect()
    assert rows[0]["p"] == pytest.approx(100 * 1.16 * 0.85 * 0.865)
    assert rows[0]["n"] == ["Stockout Risk (+16.0%)", "Flash Sale (-15%)", "Inventory Excess (-13.5%)"]
    assert [(r["p"], r["n"]) for r in rows[1:]] == [(100.0, []), (100.0, [])]


def test_explanations(spark):
    df = spark.createDataFrame([("a", 100.0, 125.0, 450.0, 0.15, 0.0), ("b", 50.0, 45.0, 150.0, 0.6, -0.1),
                                ("c", 50.0, 45.0, 50.0, 0.9, 0.0), ("d", 50.0, 55.0, 150.0, 0.5, 0.0)],
                               "sku_id string, old_price double, new_price double, demand_score double, "
                               "inventory_ratio double, competitor_delta double")
    a, b, c, d = [r["explanation"] for r in P.explain(df).collect()]
    assert a.startswith("The price for a was increased by 25.0% to balance") and "(15% remaining)" in a
    assert b.startswith("We decreased the price of b by 10.0%") and "by 10.0%, and" in b
    assert c.startswith("The price was strategically decreased by 10.0%") and "at 90%" in c
    assert d.startswith("The algorithm gently increased the price of d by 10.0%")


def test_validation(spark):
    rules = "sku_id string, inventory_level double, demand_score double, customer_segment int, cost_price double, msrp double"
    df = spark.createDataFrame([("a", 0.5, 100.0, 1, 50.0, 150.0), ("b", 1.1, 1001.0, 5, 1.0, 1.0)], rules)
    good, bad = P.split_valid(P.validate_rule_requests(df))
    assert [r["sku_id"] for r in good.collect()] == ["a"]
    assert bad.first()["broken_rules"] == ["inventory_level", "demand_score", "customer_segment"]
    sizes = P.batch_sizes(spark.range(501).selectExpr("if(id < 500, 'x', 'y') as b").unionByName(
        spark.createDataFrame([("z",)] * 3, "b string")), "b")
    assert all(r["accepted"] for r in sizes.collect())
    assert not P.batch_sizes(spark.range(501).selectExpr("'x' as b"), "b").first()["accepted"]


def test_calendar(spark):
    stamps = [datetime(2011, 12, 25, 0, 0), datetime(2011, 12, 25, 0, 1), datetime(2011, 12, 24, 12, 0)]
    df = spark.createDataFrame([(t,) for t in stamps], "t timestamp")
    assert [r[0] for r in df.select(calendar.days_to_christmas("t")).collect()] == [0, 365, 0]
    hours = spark.range(24).select(F.make_timestamp(F.lit(2011), F.lit(1), F.lit(1), F.col("id").cast("int"),
                                                    F.lit(0), F.lit(0)).alias("t"))
    got = [r[0] for r in hours.select(calendar.time_of_day("t")).collect()]
    assert got == [3] * 7 + [0] * 6 + [1] * 5 + [2] * 4 + [3] * 2
    easter = spark.createDataFrame([(2016,), (2017,), (2018,), (2024,)], "y int").select(calendar.easter_sunday("y"))
    assert [r[0] for r in easter.collect()] == [date(2016, 3, 27), date(2017, 4, 16), date(2018, 4, 1), date(2024, 3, 31)]
    days = {r[0] for r in calendar.holiday_calendar(spark, 2017, 2018).collect()}
    assert {date(2017, 4, 14), date(2018, 3, 30), date(2017, 9, 7)} <= days and date(2017, 11, 20) not in days
