"""Calendar columns of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.config import MICROS_PER_DAY
from pricetide.functions.core import clip, col, flag


def calendar_parts(ts) -> dict[str, Column]:
    t = col(ts)
    return {
        "hour": F.hour(t), "day_of_week": F.weekday(t), "day_of_month": F.dayofmonth(t),
        "week_of_year": F.weekofyear(t), "month": F.month(t), "quarter": F.quarter(t), "year": F.year(t),
    }


def calendar_flags(ts) -> dict[str, Column]:
    p = calendar_parts(ts)
    month, week, day = p["month"], p["week_of_year"], p["day_of_month"]
    return {
        "is_weekend": flag(p["day_of_week"] >= 5),
        "is_month_start": flag(day <= 3),
        "is_month_end": flag(day >= 28),
        "is_christmas_season": flag(month >= 11),
        "is_valentine_week": flag((month == 2) & (week == 7)),
        "is_easter_approx": flag((month == 4) & week.between(14, 15)),
        "is_summer": flag(month.between(6, 8)),
        "is_new_year": flag((month == 1) & (day <= 7)),
    }


def days_to_christmas(ts) -> Column:
    """Whole days until the next 25 December 00:00."""
    t = col(ts)

    def xmas(year):
        return F.make_timestamp(year, F.lit(12), F.lit(25), F.lit(0), F.lit(0), F.lit(0))

    target = F.when(t > xmas(F.year(t)), xmas(F.year(t) + 1)).otherwise(xmas(F.year(t)))
    gap = F.floor((F.unix_micros(target) - F.unix_micros(t)) / F.lit(MICROS_PER_DAY))
    return clip(gap, 0, 365).cast("int")


def time_of_day(ts) -> Column:
    """0 morning (7-12), 1 afternoon (13-17), 2 evening (18-21), 3 night."""
    h = F.hour(col(ts))
    return (F.when(h.between(7, 12), 0).when(h.between(13, 17), 1).when(h.between(18, 21), 2).otherwise(3)
            .cast("int"))


def cyclic(value, period: float) -> tuple[Column, Column]:
    angle = F.lit(2.0) * F.pi() * col(value) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def marketplace_flags(ts) -> dict[str, Column]:
    """Weekend, and month end by the calendar (the last day, unlike ``calendar_flags``)."""
    t = col(ts)
    return {"is_weekend": flag(F.weekday(t) >= 5), "is_month_end": flag(F.to_date(t) == F.last_day(t))}


# Brazilian national holidays with a fixed date (month, day, first year observed) ...
FIXED_HOLIDAYS = [(1, 1, 1900), (4, 21, 1900), (5, 1, 1925), (9, 7, 1900), (10, 12, 1980), (11, 2, 1900),
                  (11, 15, 1900), (11, 20, 2024), (12, 25, 1922)]
# ... and one that moves with Easter: Good Friday.
EASTER_OFFSETS = [-2]


def easter_sunday(year) -> Column:
    """Gregorian Easter by the anonymous algorithm, in integer arithmetic."""
    y = col(year)

    def div(a, b):
        return F.floor(a / F.lit(b))

    golden, century, rest = y % 19, div(y, 100), y % 100
    epact = (century - div(century, 4) - div(century - div(century + 8, 25) + 1, 3) + golden * 19 + 15) % 30
    weekday = (F.lit(32) + (century % 4) * 2 + div(rest, 4) * 2 - epact - rest % 4) % 7
    shift = div(golden + epact * 11 + weekday * 22, 451)
    total = epact + weekday - shift * 7 + 114
    return F.make_date(y.cast("int"), div(total, 31).cast("int"), (total % 31 + 1).cast("int"))


def holiday_calendar(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One row per holiday date; about ten rows a year."""
    return _holidays(spark.range(first_year, last_year + 1).select(F.col("id").alias("year")))


def _holidays(years: DataFrame) -> DataFrame:
    fixed = [F.when(F.col("year") >= since, F.make_date(F.col("year").cast("int"), F.lit(m), F.lit(d)))
             for m, d, since in FIXED_HOLIDAYS]
    moving = [F.date_add(easter_sunday("year"), n) for n in EASTER_OFFSETS]
    return (years.select(F.explode(F.array(*fixed, *moving)).alias("holiday"))
            .filter(F.col("holiday").isNotNull()).distinct())


def holidays_of(df: DataFrame, ts: str) -> DataFrame:
    """The holiday dates of all years in which the rows lie."""
    return _holidays(df.select(F.year(ts).cast("long").alias("year")).filter(F.col("year").isNotNull()).distinct())


def add_holiday_flag(df: DataFrame, ts: str, calendar: DataFrame, out: str = "is_holiday") -> DataFrame:
    """The calendar has some ten dates per year, so it is broadcast."""
    known = calendar.select("holiday", F.lit(1).alias("_h"))
    return (df.join(F.broadcast(known), F.to_date(ts) == F.col("holiday"), "left")
            .withColumn(out, F.coalesce("_h", F.lit(0))).drop("holiday", "_h"))
