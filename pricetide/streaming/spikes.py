"""Demand spikes: batch forms in columns, stream forms with keyed state."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pricetide.config import SETTINGS, Settings
from pricetide.functions.core import py_round
from pricetide.functions.rules import severity, spike_multiplier
from pricetide.operators.windows import drop_internal, rolling_sums
from pricetide.streaming.windows import late_after, sliding_demand

SECOND = 1_000_000


def spike_baseline(events: DataFrame, key: str = "stock_code", s: Settings = SETTINGS) -> DataFrame:
    """Median units per non-empty interval.  Summed per interval first, so the calendar bounds the values
    that one product's median holds."""
    slot = F.floor(F.unix_micros("ts") / F.lit(s.spike_seconds * SECOND))
    return (events.groupBy(key, slot.alias("_slot")).agg(F.sum("quantity").alias("_q"))
            .groupBy(key).agg(F.median("_q").alias("baseline_rate")))


# ---- exponential baseline over sliding windows

def ema_baseline(windows: DataFrame, s: Settings = SETTINGS) -> DataFrame:
    """Spike flag and running baseline of each SKU over its successive windows.

    The first window sets the baseline; later ones are a spike above three times it and then move it by
    a fifth.  Windows are already one row per SKU and minute, so the calendar bounds a SKU's rows (1440 a
    day) whatever its traffic.  They are sorted behind one exchange and walked through in batches, with one number
    carried from row to row: no SKU's history is held, and the sums round as in a walk row by row.
    """
    keep, limit = s.ema_keep, s.ema_spike

    def walk(frames):
        known, baseline = object(), 0.0
        for frame in frames:
            spikes, after = [], []
            for sku, n in zip(frame["sku_id"].tolist(), frame["order_count"].tolist()):
                if sku != known:
                    known, baseline = sku, float(n)
                    spikes.append(False)
                else:
                    spikes.append(n > baseline * limit)
                    baseline = baseline * keep + n * (1.0 - keep)
                after.append(baseline)
            yield frame.assign(spike_detected=spikes, after=after)

    rows = windows.select("sku_id", F.unix_micros("window_end").alias("end"), F.col("order_count").cast("long"))
    walked = rows.repartition("sku_id").sortWithinPartitions("sku_id", "end").mapInPandas(
        walk, "sku_id string, end long, order_count long, spike_detected boolean, after double")
    return walked.select("sku_id", F.timestamp_micros("end").alias("window_end"), "order_count", "spike_detected",
                         py_round("after", 2).alias("baseline"))


EMA_OUT = "sku_id string, end long, order_count long, spike_detected boolean, baseline double"
# Fixed value: groups of SKUs that share one record of state.  A stream that goes on from a checkpoint needs the same number.
EMA_GROUPS = 4_096


class EmaProcessor(StatefulProcessor):
    """Keeps one number per SKU, the running baseline, until the SKU has been idle for its life time.

    SKUs come in groups by hash.  A group's state is one record, the name, baseline and end of life of each of its SKUs, and one
    timer for the first of these ends.  So calls to the state and frames grow with groups, not with SKUs, and a
    batch holds the windows of one group's SKUs at a time, which the calendar bounds.
    """

    def __init__(self, keep: float, limit: float, life_days: int):
        self.keep, self.limit, self.life = keep, limit, life_days * 86_400_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.record = handle.getValueState("record", "due long, skus array<string>, baselines array<double>, ends array<long>")

    def handleInputRows(self, key, rows, timerValues):
        due, known = self._read()
        # the windows of a batch arrive in any order
        frame = pd.concat(list(rows), ignore_index=True)
        codes, skus = pd.factorize(frame["sku_id"], use_na_sentinel=False)
        frame = frame.iloc[np.lexsort((frame["end"], codes))]
        spikes, after = [], []
        ends, counts = frame["end"].tolist(), frame["order_count"].tolist()
        first = 0
        for sku, size in zip(skus, np.bincount(codes).tolist()):
            sku = None if pd.isna(sku) else sku
            before = known[sku][0] if sku in known else None
            for n in counts[first:first + size]:
                spikes.append(before is not None and n > self.limit * before)
                before = float(n) if before is None else self.keep * before + (1.0 - self.keep) * float(n)
                after.append(round(before, 2))
            first += size
            known[sku] = before, ends[first - 1] // 1000 + self.life
        self._write(due, known)
        yield frame[["sku_id", "end", "order_count"]].assign(spike_detected=spikes, baseline=after)

    def _read(self):
        """The time of the timer, and baseline and end of life by SKU."""
        due, skus, baselines, ends = self.record.get() or (None, (), (), ())
        return due, dict(zip(skus, zip(baselines, ends)))

    def _write(self, due, known) -> None:
        """Write the record and set the timer to the first end of life; one that goes off earlier than that may stay."""
        first = min(end for _, end in known.values())
        if due is None or first < due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(first)
            due = first
        self.record.update((due, list(known), *map(list, zip(*known.values()))))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        known = {sku: state for sku, state in self._read()[1].items() if state[1] > passed}
        if known:
            self._write(None, known)
        else:
            self.record.clear()
        return iter(())

    def close(self) -> None:
        pass


def ema_spike_stream(events: DataFrame, s: Settings = SETTINGS, groups: int = EMA_GROUPS) -> DataFrame:
    """Closed sliding windows of a stream through ``EmaProcessor``.  Needs the RocksDB state store and
    append mode, so that only final windows move the baseline."""
    windows = sliding_demand(events).select(F.pmod(F.xxhash64("sku_id"), F.lit(groups)).cast("int").alias("skus"), "sku_id",
                                            F.unix_micros("window_end").alias("end"), "order_count")
    walked = windows.groupBy("skus").transformWithStateInPandas(
        EmaProcessor(s.ema_keep, s.ema_spike, s.ema_life_days), EMA_OUT, "Append", "EventTime", eventTimeColumnName="")
    return walked.select("sku_id", F.timestamp_micros("end").alias("window_end"), "order_count", "spike_detected", "baseline")


# ---- per-event rate against the historical baseline

def alert_columns(rate, baseline, s: Settings = SETTINGS) -> dict[str, Column]:
    base = F.coalesce(baseline, F.lit(1.0))
    spike = rate / F.greatest(base, F.lit(0.1))
    return {"current_rate": rate.cast("double"), "baseline_rate": base, "_ratio": spike,
            "spike_ratio": py_round(spike, 2), "multiplier": py_round(spike_multiplier(spike), 2),
            "severity": severity(spike)}


def trailing_rates(events: DataFrame, seq: list[str], key: str = "stock_code", s: Settings = SETTINGS,
                   heavy: DataFrame | None = None) -> DataFrame:
    """Units of the key in the closed 300 seconds that end at each event."""
    df = rolling_sums(events.withColumn("us", F.unix_micros("ts")), key, "us", seq, {"rate": F.col("quantity")},
                      {"w": s.spike_seconds * SECOND}, closed=True, heavy=heavy)
    return drop_internal(df).withColumnRenamed("rate_w", "trailing_rate").drop("us")


def event_spikes(events: DataFrame, baselines: DataFrame, seq: list[str], s: Settings = SETTINGS,
                 heavy: DataFrame | None = None) -> DataFrame:
    """Every event with its rate, ratio, severity and whether it raises an alert (strictly above)."""
    df = trailing_rates(events, seq, "stock_code", s, heavy).join(baselines, "stock_code", "left")
    df = df.withColumns(alert_columns(F.col("trailing_rate"), F.col("baseline_rate"), s)).drop("trailing_rate")
    return df.withColumn("is_alert", F.col("_ratio") > s.spike_ratio).drop("_ratio")


def alert_records(spikes: DataFrame) -> DataFrame:
    return spikes.filter("is_alert").select(
        F.lit("FLASH_SALE_DETECTED").alias("type"), "stock_code",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("detected_at"),
        F.col("current_rate").alias("current_rate_units_per_window"), "baseline_rate", "spike_ratio",
        F.col("multiplier").alias("recommended_price_multiplier"), "severity")


def active_alerts(spikes: DataFrame, seq: list[str]) -> DataFrame:
    """Products whose newest event is an alert (a maximum, combined before the shuffle)."""
    row = F.struct("ts", "current_rate", "baseline_rate", "spike_ratio", "multiplier", "severity", "is_alert")
    last = spikes.groupBy("stock_code").agg(F.max_by(row, F.struct("ts", *seq)).alias("_r"))
    return last.select("stock_code", "_r.*").filter("is_alert").drop("is_alert")


SPIKE_OUT = ("stock_code string, event_us long, event_seq string, current_rate double, baseline_rate double")
# Events of one entry of the state's map.
HELD_EVENTS = 1000


class RateProcessor(StatefulProcessor):
    """Holds events back until the watermark passes their second, then adds them up in event-time order.

    State per product: its events as they came, in entries of ``HELD_EVENTS`` that are never written again; one record,
    the timer's time with first, last and next untold time of each entry; and, once some are told, how far and the units
    of the window that ends there.  The timer goes off once the watermark has passed the next second, and then tells all seconds passed:
    it reads the entries of untold events and those that leave the window meanwhile.  So calls to the state grow with
    batches and entries, not with events or seconds, a hot product reads what is due only, and a product without events for
    the length of the window has no state.
    """

    def __init__(self, seconds: int):
        self.seconds, self.span = seconds, seconds * SECOND

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getMapState("events", "entry long",
                                         "us array<bigint>, seq array<string>, quantity array<bigint>, baseline double")
        self.record = handle.getValueState("record", "due long, entries array<array<bigint>>")
        self.whole = handle.getValueState("whole", "told long, units long")

    def handleInputRows(self, key, rows, timerValues):
        new = pd.concat(list(rows), ignore_index=True).sort_values("us", kind="stable")
        due, entries = self.record.get() or (None, [])
        entries = [list(e) for e in entries]
        name = max((e[0] for e in entries), default=-1) + 1
        for at in range(0, len(new), HELD_EVENTS):
            part = new.iloc[at:at + HELD_EVENTS]
            us = part["us"].tolist()
            self.events.updateValue((name,), (us, part["seq"].tolist(), part["quantity"].tolist(),
                                              float(part["baseline_rate"].iloc[0])))
            entries.append([name, us[0], us[-1], us[0]])
            name += 1
        self._keep(due, entries)
        return iter(())

    def _keep(self, due, entries) -> None:
        """Write the record, and set the timer to the end of the next untold second or, without one, of the window."""
        untold = [e[3] for e in entries if e[3] is not None]
        if untold:
            at = (min(untold) // SECOND + 1) * 1000
        elif entries:
            at = (max(e[2] for e in entries) // SECOND + self.seconds + 1) * 1000
        else:
            at = None
        if at != due:
            if due is not None:
                self.handle.deleteTimer(due)
            if at is not None:
                self.handle.registerTimer(at)
        if at is None:
            self.record.clear()
        else:
            self.record.update((at, entries))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        fired = expiredTimerInfo.getExpiryTimeInMs()
        _, entries = self.record.get()
        before = self.whole.get()
        told, units = before or (None, 0)
        # whole seconds that the watermark has passed
        upto = max(fired, timerValues.getCurrentWatermarkInMs() - 1) // 1000 * SECOND
        edge = upto - self.span
        due, leaving, kept = [], [], []
        for name, first, last, untold in map(list, entries):
            enters = untold is not None and untold < upto
            if enters or first < edge:
                held = self.events.getValue((name,))
                us = np.array(held[0], np.int64)
                quantity = np.array(held[2], np.int64)
                if enters:
                    fresh = us < upto if told is None else (us < upto) & (us >= told)
                    due += [(us[i].item(), held[1][i], quantity[i].item(), held[3]) for i in np.flatnonzero(fresh)]
                    untold = us[us >= upto].min().item() if last >= upto else None
                out = us < edge if told is None else (us < edge) & (us >= told - self.span)
                leaving += zip(us[out].tolist(), quantity[out].tolist())
            if last < edge:
                self.events.removeKey((name,))
            else:
                kept.append([name, first, last, untold])
        gone, lost = (np.array(x, np.int64) for x in zip(*sorted(leaving))) if leaving else (np.zeros(0, np.int64),) * 2
        lost = np.concatenate([[0], lost.cumsum()])
        if due:
            due.sort(key=lambda e: e[:3])
            us, names, quantity, base = zip(*due)
            inside = units + np.array(quantity, np.int64).cumsum()
            # closed at both ends: an event as old as the window is in
            left = lost[np.searchsorted(gone, np.array(us, np.int64) - self.span, side="left")]
            units = int(inside[-1])
            out = pd.DataFrame({"stock_code": key[0], "event_us": us, "event_seq": names,
                                "current_rate": (inside - left).astype(float), "baseline_rate": base})
        if any(first < upto for _, first, _, _ in kept):
            self.whole.update((upto, units - int(lost[-1])))
        elif before:
            self.whole.clear()
        self._keep(None, kept)
        if due:
            yield out

    def close(self) -> None:
        pass


def event_spike_stream(events: DataFrame, baselines: DataFrame, seq: str, s: Settings = SETTINGS) -> DataFrame:
    """``event_spikes`` over a stream: a static join brings the baseline, state holds the window."""
    df = late_after(events, s).join(baselines, "stock_code", "left").select(
        "stock_code", "ts", F.unix_micros("ts").alias("us"), F.col(seq).cast("string").alias("seq"),
        F.coalesce(F.col("quantity").cast("long"), F.lit(0)).alias("quantity"),
        F.coalesce("baseline_rate", F.lit(1.0)).alias("baseline_rate")).filter(F.col("ts").isNotNull())
    rates = df.groupBy("stock_code").transformWithStateInPandas(
        RateProcessor(s.spike_seconds), SPIKE_OUT, "Append", "EventTime", eventTimeColumnName="")
    spikes = rates.withColumns(alert_columns(F.col("current_rate"), F.col("baseline_rate"), s))
    return spikes.withColumns({"is_alert": F.col("_ratio") > s.spike_ratio,
                               "ts": F.timestamp_micros("event_us")}).drop("_ratio", "event_us")


# ---- order velocity

def velocity_spikes(events: DataFrame, seq: list[str], s: Settings = SETTINGS, heavy: DataFrame | None = None) -> DataFrame:
    """Orders per minute of the SKU in the last two minutes; above three times the baseline the SKU is
    flagged for ten minutes from that event on."""
    df = rolling_sums(events.withColumn("us", F.unix_micros("ts")), "sku_id", "us", seq, {"orders": F.lit(1)},
                      {"w": s.velocity_seconds * SECOND}, heavy=heavy)
    df = drop_internal(df).drop("us")
    rate = F.col("orders_w") / F.lit(s.velocity_seconds / 60.0)
    until = F.timestamp_micros(F.unix_micros("ts") + s.velocity_flag_seconds * SECOND)
    df = df.withColumn("velocity", rate).drop("orders_w").withColumn(
        "is_flash_sale", F.col("velocity") > 3 * s.velocity_baseline)
    return df.withColumn("flag_until", F.when(F.col("is_flash_sale"), until))
