import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricetide.config import Settings
from pricetide.streaming import routing, spikes, windows

T0 = datetime(2024, 1, 1)
SALE = "stock_code string, ts timestamp, seq string, quantity int"


def sales(spark, *rows):
    return spark.createDataFrame([(k, T0 + timedelta(seconds=s), f"{i:03d}", q) for i, (k, s, q) in enumerate(rows)], SALE)


def baselines(spark, **rates):
    return spark.createDataFrame(list(rates.items()), "stock_code string, baseline_rate double")


def streamed(spark, df, tmp_path, make, parts=1):
    """Batch rows through files into a stream and back."""
    for i, part in enumerate(df.randomSplit([1.0] * parts, 1) if parts > 1 else [df]):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    routing.run_to_files(make(stream), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    return spark.read.parquet(str(tmp_path / "out"))


CASES = [("T", 0, 2), ("T", 10, 10), ("E", 0, 3), ("E", 300, 3), ("E", 601, 3), ("R", 0, 3), ("N", 0, 2), ("N", 5, 1)]


def test_known_alert(spark):
    df = sales(spark, *CASES)
    out = spikes.event_spikes(df, baselines(spark, T=5.0, E=4.0, R=2.0), ["seq"])
    rows = {(r["stock_code"], r["seq"]): r for r in out.collect()}
    assert not rows[("T", "000")]["is_alert"]
    alert = rows[("T", "001")]
    assert (alert["current_rate"], alert["spike_ratio"], alert["severity"], alert["multiplier"]) == (12.0, 2.4, "MEDIUM", 1.09)
    assert rows[("E", "003")]["current_rate"] == 6.0 and not rows[("E", "003")]["is_alert"]  # 300 s old stays; 1.5 is no spike
    assert rows[("E", "004")]["current_rate"] == 3.0 and not rows[("R", "005")]["is_alert"]
    assert rows[("N", "007")]["baseline_rate"] == 1.0 and rows[("N", "007")]["severity"] == "HIGH"
    assert {r["stock_code"] for r in spikes.active_alerts(out, ["seq"]).collect()} == {"T", "N"}
    assert spikes.alert_records(out).filter("stock_code = 'T'").first()["detected_at"] == "2024-01-01T00:00:10"


def test_event_spike_stream_equals_batch(spark, tmp_path):
    df = sales(spark, *CASES, ("Z", 7200, 1))
    base = baselines(spark, T=5.0, E=4.0, R=2.0)
    out = streamed(spark, df, tmp_path, lambda s: spikes.event_spike_stream(s, base, "seq"))
    names = ["stock_code", "current_rate", "baseline_rate", "spike_ratio", "multiplier", "severity", "is_alert"]
    want = spikes.event_spikes(df, base, ["seq"]).filter("stock_code <> 'Z'")
    assert sorted(map(tuple, out.select(*names, "event_seq").collect())) == sorted(
        map(tuple, want.select(*names, "seq").collect()))


def orders(spark, *rows):
    return spark.createDataFrame([(k, T0 + timedelta(seconds=s), p) for k, s, p in rows], "sku_id string, ts timestamp, price double")


def test_sliding_demand_and_ema(spark, tmp_path):
    burst = [("a", 30 + i, 2.0) for i in range(1)] + [("a", 400 + i, None) for i in range(9)] + [("b", 30, 1.0)]
    df = orders(spark, *burst, ("end", 9000, 0.0))
    win = windows.sliding_demand(df)
    first = win.filter("sku_id = 'a'").orderBy("window_end").first()
    assert (first["order_count"], first["revenue"], first["avg_price"]) == (1, 2.0, 2.0)
    rows = spikes.ema_baseline(win).filter("sku_id = 'a'").orderBy("window_end").collect()
    b, want = None, []
    for r in win.filter("sku_id = 'a'").orderBy("window_end").collect():
        n = r["order_count"]
        spike = b is not None and n > 3 * b
        b = float(n) if b is None else 0.8 * b + (1.0 - 0.8) * n
        want.append((n, spike, round(b, 2)))
    assert [(r["order_count"], r["spike_detected"], r["baseline"]) for r in rows] == want
    assert any(s for _, s, _ in want)
    out = streamed(spark, df, tmp_path, spikes.ema_spike_stream)
    batch = spikes.ema_baseline(win).filter("sku_id <> 'end'").select(*out.columns)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))


def test_late_rows_are_dropped_and_restart_goes_on(spark, tmp_path):
    path, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))

    def run(*rows):
        df = orders(spark, *rows)
        df.coalesce(1).write.mode("append").parquet(path)
        stream = windows.sliding_demand(spark.readStream.schema(df.schema).parquet(path)).drop("window")
        routing.run_to_files(stream, out, ckpt)

    run(("a", 0, 1.0), ("end", 9000, 0.0))
    run(("a", 10, 1.0), ("a", 9001, 1.0), ("end", 20000, 0.0))
    got = spark.read.parquet(out).filter("sku_id = 'a'").collect()
    assert sum(r["order_count"] for r in got) == 10  # five windows each for the two rows in time


def test_velocity(spark):
    df = orders(spark, *[("a", s, 1.0) for s in (0, 30, 60, 119, 121)]).withColumn("event_id", F.unix_seconds("ts"))
    rows = spikes.velocity_spikes(df, ["event_id"]).orderBy("ts").collect()
    assert [r["velocity"] for r in rows] == [0.5, 1.0, 1.5, 2.0, 2.0]
    assert [r["is_flash_sale"] for r in rows] == [False, False, False, True, True]
    assert rows[3]["flag_until"] == rows[3]["ts"] + timedelta(minutes=10)


def test_clicks_count_a_time_once(spark, tmp_path):
    day = 86400
    df = orders(spark, ("a", 0, 1.0), ("a", 1, 2.0), ("a", 1, 2.0), ("a", 60, 1.0), ("a", day, 1.0), ("a", day + 1, 1.0),
                ("b", 7 * day, 1.0), ("b", 7 * day + 1, 1.0), ("end", 9 * day, 1.0)).drop("price")
    stream = streamed(spark, df, tmp_path, windows.click_days)
    for days in (1, 2, 7, 8):
        as_of = F.lit(T0 + timedelta(days=days)).cast("timestamp")
        want = {tuple(r) for r in windows.click_demand(df, as_of).collect()}
        assert {tuple(r) for r in windows.click_demand_of_days(stream, as_of).collect()} == want
        assert {tuple(r) for r in windows.click_demand_of_days(windows.click_days(df), as_of).collect()} == want
    assert want == {("a", 1), ("b", 2)}


def state_of(spark, tmp_path, variable):
    return spark.read.format("statestore").option("path", str(tmp_path / "ckpt")).option("stateVarName", variable).load()


def test_idle_products_have_no_state(spark, tmp_path):
    hot = [("H", s / 4, 1) for s in range(0, 4000)]
    df = sales(spark, *CASES, *hot, ("Z", 7200, 1))
    base = baselines(spark, T=5.0, E=4.0, R=2.0, H=100.0)
    out = streamed(spark, df, tmp_path, lambda s: spikes.event_spike_stream(s, base, "seq"))
    want = spikes.event_spikes(df, base, ["seq"]).filter("stock_code <> 'Z'")
    assert sorted(map(tuple, out.select("stock_code", "event_seq", "current_rate").collect())) == sorted(
        map(tuple, want.select("stock_code", "seq", "current_rate").collect()))
    assert [r.key.stock_code for r in state_of(spark, tmp_path, "events").select("key").collect()] == ["Z"]
    assert state_of(spark, tmp_path, "whole").count() == 0


def test_state_calls_grow_with_batches_not_with_events():
    """The processor alone, on a state that counts its calls; batches and watermarks as the engine hands them over."""
    calls, timers = [], set()

    class Kept(dict):
        def clear(self):
            calls.append("clear")
            dict.clear(self)

        def get(self):
            calls.append("get")
            return dict.get(self, "v")

        def update(self, value):
            calls.append("update")
            self["v"] = value

        def exists(self):
            calls.append("exists")
            return "v" in self

        def containsKey(self, key):
            calls.append("containsKey")
            return key in self

        def updateValue(self, key, value):
            calls.append("updateValue")
            self[key] = value

        def getValue(self, key):
            calls.append("getValue")
            return self[key]

        def removeKey(self, key):
            calls.append("removeKey")
            del self[key]

    class Handle:
        kept = {}

        def getValueState(self, name, schema):
            return self.kept.setdefault(name, Kept())

        def getMapState(self, name, key, value):
            return self.getValueState(name, value)

        def registerTimer(self, at):
            timers.add(at)

        def deleteTimer(self, at):
            timers.discard(at)

    class At:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: ms

    p = spikes.RateProcessor(300)
    p.init(Handle())
    rng = random.Random(4)
    events = sorted((rng.randrange(3000) * 500_000, f"{i:05d}", rng.randrange(-1, 9)) for i in range(4000))
    got = []
    for step in range(0, 1501, 250):
        batch = [e for e in events if step <= e[0] // 1_000_000 < step + 250]
        rng.shuffle(batch)
        if batch:
            p.handleInputRows(("K",), iter([pd.DataFrame([(*e, 2.0) for e in batch], columns=[
                "us", "seq", "quantity", "baseline_rate"])]), At(0))
        now = step + 100 if step < 1500 else 9000  # the last watermark leaves nothing
        for at in sorted(timers):
            if at < now * 1000 and at in timers:
                timers.remove(at)
                for frame in p.handleExpiredTimer(("K",), At(now * 1000), At(at)):
                    got += frame[["event_us", "event_seq", "current_rate"]].itertuples(index=False, name=None)
    want = [(us, seq, float(sum(q for u, s, q in events if us - 300_000_000 <= u and (u, s) <= (us, seq)))) for us, seq, _ in events]
    assert sorted(got) == want
    assert not timers and not any(Handle.kept.values())
    assert len(calls) < 100


def test_baseline_of_an_idle_sku_ends(spark, tmp_path):
    path, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    for rows in ([("a", 30, 1.0), ("b", 30, 1.0)], [("end", 10 * 86400, 0.0), *[("b", 86400 * 0.9, 1.0)]],
                 [("a", 20 * 86400 + i, 1.0) for i in range(9)], [("end", 30 * 86400, 0.0)]):
        df = orders(spark, *rows)
        df.coalesce(1).write.mode("append").parquet(path)
        stream = spikes.ema_spike_stream(spark.readStream.schema(df.schema).parquet(path), Settings(ema_life_days=1))
        routing.run_to_files(stream, out, ckpt)
    got = spark.read.parquet(out).filter("sku_id = 'a'").orderBy("window_end").collect()
    assert [r.order_count for r in got] == [1] * 5 + [9] * 5 and not any(r.spike_detected for r in got)
    assert [r.baseline for r in got] == [1.0] * 5 + [9.0] * 5


def test_skus_of_a_group_keep_their_own_baselines(spark, tmp_path):
    path, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    rng, days = random.Random(3), []
    for day in range(3):
        skus = [None, *"abcdefghij"][day:8 + day]
        rows = [(rng.choice(skus), day * 86400 + rng.randrange(3000), 1.0) for _ in range(120)]
        days.append(orders(spark, *rows, ("end", day * 86400 + 9000, 0.0)))
        days[-1].coalesce(1).write.mode("append").parquet(path)
        stream = spikes.ema_spike_stream(spark.readStream.schema(days[-1].schema).parquet(path), groups=3)
        routing.run_to_files(stream, out, ckpt)
    got = spark.read.parquet(out)
    every = spikes.ema_baseline(windows.sliding_demand(days[0].union(days[1]).union(days[2])))
    last = F.col("window_end") > F.lit(T0 + timedelta(seconds=2 * 86400 + 9000)).cast("timestamp")
    want = every.filter(~last).select(*got.columns)
    assert {(r.sku_id, r.window_end): r for r in got.collect()} == {(r.sku_id, r.window_end): r for r in want.collect()}
    assert got.count() == want.count() and got.filter("spike_detected").count() and got.filter("sku_id is null").count()
    records = state_of(spark, tmp_path, "record").select("value.skus").collect()
    assert len(records) <= 3 and sum(len(r.skus) for r in records) == 11


def test_one_sku_of_a_group_ends(spark, tmp_path):
    path, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    day = 86400
    for rows in ([("a", 30, 1.0), ("b", 30, 1.0)], [("b", int(0.9 * day), 1.0), ("end", int(1.5 * day), 0.0)],
                 [(k, int(1.6 * day) + i, 1.0) for i in range(9) for k in "ab"], [("end", 30 * day, 0.0)]):
        df = orders(spark, *rows)
        df.coalesce(1).write.mode("append").parquet(path)
        stream = spikes.ema_spike_stream(spark.readStream.schema(df.schema).parquet(path), Settings(ema_life_days=1), groups=1)
        routing.run_to_files(stream, out, ckpt)
    got = {k: spark.read.parquet(out).filter(F.col("sku_id") == k).orderBy("window_end").collect() for k in "ab"}
    assert [(r.baseline, r.spike_detected) for r in got["a"]] == [(1.0, False)] * 5 + [(9.0, False)] * 5
    assert [r.baseline for r in got["b"]][:12] == [1.0] * 10 + [2.6, 3.88] and [r.spike_detected for r in got["b"]][10:12] == [True] * 2
    assert state_of(spark, tmp_path, "record").count() == 0


def test_baseline_calls_grow_with_groups_not_with_skus():
    """The processor alone: 500 SKUs of one group, two batches."""
    calls, kept = [], {}

    class Record:
        def exists(self):
            calls.append("exists")
            return "v" in kept

        def get(self):
            calls.append("get")
            return kept.get("v")

        def update(self, value):
            calls.append("update")
            kept["v"] = value

    class Handle:
        def getValueState(self, name, schema):
            return Record()

        def registerTimer(self, at):
            calls.append("registerTimer")

        def deleteTimer(self, at):
            calls.append("deleteTimer")

    p = spikes.EmaProcessor(0.8, 3.0, 90)
    p.init(Handle())
    out = []
    for n, end in ((1, 60), (4, 120)):
        rows = pd.DataFrame({"skus": 7, "sku_id": [f"s{i}" for i in range(500)], "end": end * 1_000_000, "order_count": n})
        out += p.handleInputRows((7,), iter([rows[:300], rows[300:]]), None)
    assert [set(f["baseline"]) for f in out] == [{1.0}, {1.6}] and all(out[1]["spike_detected"]) and len(out[1]) == 500
    assert len(calls) < 10


def test_route_to_pricing(spark, tmp_path):
    df = orders(spark, *[("a", i, 1.0) for i in range(5)], ("end", 9000, 0.0))
    catalogue = spark.createDataFrame([("a", 100.0, 50.0, 150.0, 2, False)], "sku_id string, base_price double, "
                                      "cost double, msrp double, customer_segment int, is_flash_sale boolean")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    sent = []

    def run():
        stream = windows.sliding_demand(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
        routing.route_to_pricing(stream, catalogue, str(tmp_path / "audit"), str(tmp_path / "ckpt"),
                                 lambda m, batch: sent.extend((batch, r["key"]) for r in m.collect()),
                                 metrics_path=str(tmp_path / "metrics")).start().awaitTermination()

    run()
    logged = spark.read.json(str(tmp_path / "audit")).collect()
    assert [k for _, k in sent] == ["a"] and len(logged) == 1 and logged[0]["final_price"] == pytest.approx(93.5, abs=0.5)
    routing.forget_commit(spark, str(tmp_path / "ckpt"))
    run()  # the same batch again
    assert len(sent) == 2 and sent[0] == sent[1]
    assert [r.asDict() for r in spark.read.json(str(tmp_path / "audit")).collect()] == [r.asDict() for r in logged]
    metrics = {r["name"]: r["value"] for r in spark.read.parquet(str(tmp_path / "metrics")).collect()}
    assert metrics == {"decisions": 1.0, "mean_price": logged[0]["final_price"]}
