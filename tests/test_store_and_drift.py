import os
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from pricetide.operators import drift
from pricetide.operators import feature_store as FS
from tests.harness import compare, duck

T0 = datetime(2024, 1, 1)
LOG = "sku_id string, feature string, value double, event_ts timestamp, ttl_seconds int, event_id long"


def at(seconds):
    return F.lit(T0 + timedelta(seconds=seconds)).cast("timestamp")


def log(spark, *rows):
    return spark.createDataFrame([(s, f, v, T0 + timedelta(seconds=t), ttl, i)
                                  for i, (s, f, v, t, ttl) in enumerate(rows)], LOG)


def look(spark, table, when, *skus):
    asks = spark.createDataFrame([(s,) for s in skus], "sku_id string")
    return {r["sku_id"]: (r["demand_score_7d"], r["inventory_ratio"], r["competitor_price"])
            for r in FS.feature_lookup(asks, table, at(when)).collect()}


def test_lookup_round_trip_and_expiry(spark):
    table = log(spark, ("A", "demand_score_7d", 450.0, 0, 30), ("A", "inventory_ratio", 0.25, 0, 60),
                ("B", "demand_score_7d", 200.0, 5, 30))
    assert look(spark, table, 10, "A", "B", "X") == {
        "A": (450.0, 0.25, None), "B": (200.0, 0.5, None), "X": (0.0, 0.5, None)}
    assert look(spark, table, 30, "A") == {"A": (0.0, 0.25, None)}
    assert look(spark, table, 60, "A") == {"A": (0.0, 0.5, None)}


def test_invalidate(spark):
    marks = spark.createDataFrame([("A", T0 + timedelta(seconds=3), 99)], "sku_id string, event_ts timestamp, event_id long")
    table = log(spark, ("A", "demand_score_7d", 500.0, 0, 30)).unionByName(FS.tombstones(marks))
    assert look(spark, table, 2, "A")["A"][0] == 500.0
    assert look(spark, table, 4, "A")["A"][0] == 0.0


def test_ttl_by_feature(spark):
    rows = FS.with_ttl(spark.createDataFrame([("demand_score_7d",), ("inventory_ratio",), ("competitor_price",)],
                                             "feature string")).collect()
    assert [r["ttl_seconds"] for r in rows] == [30, 60, 300]


def test_asof_against_brute_force(spark):
    rng = np.random.default_rng(1)
    names = list(FS.DEFAULTS)
    writes = [(str(rng.integers(3)), names[rng.integers(3)], float(i), int(rng.integers(1000)), int(rng.choice([30, 60, 90])))
              for i in range(300)]
    asks = [(str(rng.integers(3)), T0 + timedelta(seconds=int(rng.integers(1000))), 1000 + i) for i in range(100)]
    df = spark.createDataFrame(asks, "sku_id string, ts timestamp, event_id long")
    got = FS.feature_asof(df, log(spark, *writes)).collect()
    assert len(got) == 100
    for r in got:
        for n in names:
            before = [(t, i, v, ttl) for i, (s, f, v, t, ttl) in enumerate(writes)
                      if s == r["sku_id"] and f == n and T0 + timedelta(seconds=t) <= r["ts"]]
            want = FS.DEFAULTS[n]
            if before:
                t, _, v, ttl = max(before)
                if T0 + timedelta(seconds=t + ttl) > r["ts"]:
                    want = v
            assert r[n] == want


def test_latest_decision(spark):
    df = spark.createDataFrame([("A", 1.0, T0), ("A", 2.0, T0 + timedelta(seconds=20)), ("B", 3.0, T0)],
                               "sku_id string, final_price double, timestamp timestamp")
    got = {r["sku_id"]: r["final_price"] for r in FS.latest_decision(df, at(40)).collect()}
    assert got == {"A": 2.0}


def numpy_psi(e, a):
    bins = [np.minimum(np.floor(np.clip((x - e.min()) / (e.max() - e.min()), 0, 1) * 10), 9) for x in (e, a)]
    p, q = [np.array([(b == i).mean() for i in range(10)]) + 1e-6 for b in bins]
    return float(((q - p) * np.log(q / p)).sum())


def test_psi(spark):
    rng = np.random.default_rng(0)
    base, moved = rng.normal(100, 10, 1000), rng.normal(150, 20, 1000)
    frame = lambda x: spark.createDataFrame([(float(v),) for v in x], "x double")
    same = drift.psi(frame(base), frame(base), "x").first()
    assert same["psi"] < 0.001 and not same["alert"]
    got = drift.psi(frame(base), frame(moved), "x").first()
    assert got["alert"] and got["psi"] == pytest.approx(numpy_psi(base, moved))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables here")
@pytest.mark.parametrize("name", ["psi_all_rows", "feature_invalidate_all_writes"])
def test_no_rows_left_out(spark, name):
    folder = "/root/testdata/sf0.001"
    assert compare(queries()[name](spark, folder), duck(folder), oracle_sql()[name]) is None


def test_deletion_beats_write_of_its_event(spark):
    rows = [("a", "inventory_ratio", 1.0, T0, 60, 7), ("a", "inventory_ratio", None, T0, 0, 7)]
    for order in (rows, rows[::-1]):
        assert FS.latest_valid(spark.createDataFrame(order, LOG).coalesce(1), at(1)).count() == 0
